"""Quality rules: how far a document's histograms lie from those of its language.

The references are, for each language, the shares of character classes and of common
words, summed over all documents that pass the base rules. A language is a reference from
``min_reference_docs`` such documents with ``min_reference_words`` words on; documents of
others, of no language, or of a code that names none (``NO_LANGUAGE``) are judged by the
references there are. A document is kept if some language is near in both by Jensen-Shannon distance (base 2, so 0 to 1). The histogram of
common words is judged from ``min_word_sample`` words on and that of characters from
``min_char_sample`` word characters on; shorter documents are not judged by it.

The base rules reject documents of fewer than 50 words and those in which more than half
of the words lie in a three-word run that occurs twice. A null or empty text has no words
and fails. Rows are kept as they are, repeated ones or those with a null id too. Without
a reference (empty table, no language that is large enough) the method rejects nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smeltery.llm import arrays
from smeltery.llm.shared import and_fields, small_batches

# Frequent function words by language, as any stop-word list has them.
COMMON_WORDS = {
    "de": "auf das dem den der die ein eine für ich in ist mit nicht sich sie und von zu",
    "en": "a and are as at be by for from in is it of on that the this to was with",
    "es": "con de del el en es la las los no para por que se su un una y",
    "fr": "avec dans de des du en est et la le les pas pour que qui sur un une",
}
WORD_LIST = sorted({w for words in COMMON_WORDS.values() for w in words.split()})
# Codes of ISO 639 for texts of no, of several, of other and of unknown languages.
NO_LANGUAGE = ("", "und", "zxx", "mul", "mis")
SYMBOLS = b"#*$%&|<>"
CLASSES = 9


def _class_table() -> np.ndarray:
    out = np.full(256, 7)
    out[97:123], out[65:91], out[48:58] = 0, 1, 2
    out[arrays.SPACE] = 3
    out[list(b".,;:!?")] = 4
    out[list(b"'\"()-")] = 5
    out[list(SYMBOLS)] = 6
    out[192:] = 8
    out[128:192] = CLASSES  # inside a character: not counted
    return out


_CLASS = _class_table()
_SYMBOL = _CLASS == 6
_PUNCTUATION = (_CLASS == 4) | (_CLASS == 5)
_LISTED = np.array(
    [
        arrays.hash_spans(np.frombuffer(w.encode(), np.uint8), *np.array([[0], [len(w.encode())]]))
        for w in WORD_LIST
    ]
).ravel()
_BY_HASH = np.argsort(_LISTED)


@dataclass(frozen=True)
class Limits:
    """Largest distances, and the sizes from which a histogram is judged.

    A histogram of n words strays from its language's by about 1 / sqrt(n), so a limit is
    its base plus its noise over the root of the number of words. References of
    ``min_reference_words`` stray by a tenth of a limit; ``min_reference_docs`` keeps a
    document, or a few, from being their own reference.
    """

    chars: float = 0.21
    words: float = 0.26
    chars_noise: float = 0.6
    words_noise: float = 0.9
    min_char_sample: int = 200
    min_word_sample: int = 50
    min_reference_docs: int = 10
    min_reference_words: int = 2_000


BASE = {
    "n_words": "long",
    "word_chars": "long",
    "n_symbols": "long",
    "n_dup_lines": "long",
    "n_repeat_words": "long",
    "base_failed": "boolean",
}


def base_counts(w: arrays.Words) -> dict[str, np.ndarray]:
    """The base measures of each text."""
    n_words = w.per_text
    lead = ((w.data & 0xC0) != 0x80) & ~arrays.SPACE[w.data]
    hashes = arrays.hash_spans(w.data, w.starts, w.ends)
    runs, doc = arrays.shingles(hashes, w.first, 3)
    full = n_words[doc] >= 3
    runs, doc = runs[full], doc[full]
    start = np.flatnonzero(np.arange(len(hashes)) + 3 <= w.first[1:][w.doc])
    order = np.lexsort((runs, doc))
    same = (runs[order][1:] == runs[order][:-1]) & (doc[order][1:] == doc[order][:-1])
    again = np.zeros(len(runs), bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    covered = np.zeros(len(hashes) + 3, bool)
    for k in range(3):
        covered[start[again] + k] = True
    n_repeat = arrays.total_per_text(covered[: len(hashes)], w.first)
    return {
        "n_words": n_words,
        "word_chars": arrays.total_per_text(lead, w.offsets),
        "n_symbols": arrays.total_per_text(_SYMBOL[w.data], w.offsets),
        "n_dup_lines": _repeated_lines(w),
        "n_repeat_words": n_repeat,
        "base_failed": (n_words < 50) | (100 * n_repeat > 50 * n_words),
    }


def _repeated_lines(w: arrays.Words) -> np.ndarray:
    starts, ends = arrays.spans(w.data != 10, w.offsets)
    sums = np.concatenate([[0], np.cumsum(~arrays.SPACE[w.data])])
    worded = sums[ends] > sums[starts]
    starts, ends = starts[worded], ends[worded]
    doc = np.searchsorted(w.offsets, starts, "right") - 1
    hashes = arrays.hash_spans(w.data, starts, ends)
    _, kept = arrays.distinct_per_text(hashes, doc)
    n = len(w.offsets) - 1
    return np.bincount(doc, minlength=n) - np.bincount(kept, minlength=n)


def histograms(w: arrays.Words) -> tuple[np.ndarray, np.ndarray]:
    """Counts of character classes and of common words, the other words last, by text."""
    n = len(w.offsets) - 1
    owner = np.repeat(np.arange(n), np.diff(w.offsets))
    wide = CLASSES + 1
    chars = np.bincount(owner * wide + _CLASS[w.data], minlength=n * wide).reshape(n, wide)
    lowered = arrays.LOWER[w.data]
    ends = w.ends.copy()
    for _ in range(2):
        trim = _PUNCTUATION[w.data[np.maximum(ends - 1, 0)]] & (ends - w.starts > 1)
        ends -= trim
    hashes = arrays.hash_spans(lowered, w.starts, ends)
    place = np.minimum(np.searchsorted(_LISTED[_BY_HASH], hashes), len(_LISTED) - 1)
    known = _LISTED[_BY_HASH][place] == hashes
    column = np.where(known, _BY_HASH[place], len(_LISTED))
    wide = len(_LISTED) + 1
    common = np.bincount(w.doc * wide + column, minlength=n * wide).reshape(n, wide)
    return chars[:, :CLASSES], common


def distance(counts: np.ndarray, reference: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance of each row of counts to the reference."""

    def shares(x: np.ndarray) -> np.ndarray:
        total = x.sum(axis=-1, keepdims=True)
        return x / np.where(total == 0, 1, total)

    p, q = shares(counts.astype(float)), shares(reference.astype(float))
    m = (p + q) / 2

    def entropy(x: np.ndarray) -> np.ndarray:
        return -(x * np.log2(np.where(x > 0, x, 1))).sum(axis=-1)

    return np.sqrt(np.clip(entropy(m) - (entropy(p) + entropy(q)) / 2, 0, 1))


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, arrays.Words]]:
    for batch in batches:
        for low, high in arrays.blocks(batch.column("text")):
            part = batch.slice(low, high - low)
            yield part, arrays.words(*arrays.texts(part.column("text")))


def references(docs: DataFrame, limits: Limits = Limits()) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """Histograms of each language that is large enough, over all documents that pass the
    base rules."""
    last = CLASSES + len(WORD_LIST) + 1

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for part, w in _words(batches):
            passed = ~base_counts(w)["base_failed"]
            # The last bin counts documents.
            both = np.concatenate([*histograms(w), np.ones((part.num_rows, 1), np.int64)], axis=1)
            langs = part.column("lang").to_pylist()
            for lang in set(langs):
                own = passed & np.array([x == lang for x in langs])
                sums[lang] = sums.get(lang, 0) + both[own].sum(axis=0)
        for lang, counts in sums.items():
            yield pa.RecordBatch.from_pydict(
                {"lang": [lang] * len(counts), "bin": np.arange(len(counts)), "n": counts}
            )

    bins = (
        docs.where(~F.lower(F.trim("lang")).isin(*NO_LANGUAGE))
        .select("text", "lang")
        .mapInArrow(partial, "lang string, bin long, n long")
        .groupBy("lang", "bin")
        .agg(F.sum("n").alias("n"))
        .groupBy("lang")
        .agg(
            F.sort_array(F.collect_list(F.struct("bin", "n"))).alias("bins"),
            F.sum(F.when(F.col("bin") == last, F.col("n"))).alias("docs"),
            F.sum(F.when(F.col("bin").between(CLASSES, last - 1), F.col("n"))).alias("words"),
        )
        .where((F.col("docs") >= limits.min_reference_docs) & (F.col("words") >= limits.min_reference_words))
    )
    out = {}
    for row in bins.collect():
        counts = np.array([x.n for x in row.bins])
        if counts.sum():
            out[row.lang] = counts[:CLASSES], counts[CLASSES:last]
    return out


def judge(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """The columns of ``docs`` and, behind them, the base measures, distances and verdict.

    Columns of these names in ``docs`` are replaced. ``docs`` needs text and lang.
    """
    small_batches(docs.sparkSession)
    known = references(docs, limits)
    added = BASE | {"chars_distance": "double", "words_distance": "double", "kept": "boolean"}
    others = [c for c in docs.columns if c not in added]

    def verdict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, w in _words(batches):
            measures = base_counts(w)
            chars, common = histograms(w)
            n = part.num_rows
            best_chars, best_words = np.zeros(n), np.zeros(n)
            judged_chars = measures["word_chars"] >= limits.min_char_sample
            judged_words = measures["n_words"] >= limits.min_word_sample
            worst = np.full(n, np.inf) if known else np.zeros(n)
            root = np.sqrt(np.maximum(measures["n_words"], 1))
            chars_limit = limits.chars + limits.chars_noise / root
            words_limit = limits.words + limits.words_noise / root
            for reference_chars, reference_words in known.values():
                by_chars = distance(chars, reference_chars)
                by_words = distance(common, reference_words)
                excess = np.maximum(
                    np.where(judged_chars, by_chars / chars_limit, 0),
                    np.where(judged_words, by_words / words_limit, 0),
                )
                nearer = excess < worst
                worst = np.where(nearer, excess, worst)
                best_chars = np.where(nearer, by_chars, best_chars)
                best_words = np.where(nearer, by_words, best_words)
            measures |= {"chars_distance": best_chars, "words_distance": best_words}
            measures["kept"] = ~measures["base_failed"] & (worst <= 1)
            columns = [part.column(c) for c in others] + [pa.array(measures[c]) for c in added]
            yield pa.RecordBatch.from_arrays(columns, names=[*others, *added])

    kept = docs.select(*(F.col(f"`{c}`") for c in others))
    more = ", ".join(f"{k} {v}" for k, v in added.items())
    return kept.mapInArrow(verdict, and_fields(kept.schema.fields, more))
