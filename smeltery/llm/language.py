"""Language ID by hyperdimensional profiles.

Every letter has a random vector of ones and minus ones. An n-gram binds the vectors of
its letters, each turned by its place, by multiplication; a text bundles its n-grams by
addition; a language is the bundle of its texts, each at equal weight. A text belongs to
the language whose bundle has the largest cosine with its own.

Texts without a letter, empty and null ones included, get ``und`` and score 0. Rows are
kept as they are, repeated or with a null id; columns other than those named are ignored.
Ties go to the language that comes first by name. Without learnable rows all is ``und``.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smeltery.llm import arrays
from smeltery.llm.shared import and_fields

UNKNOWN = "und"
DIMENSIONS = 1024
GRAM = 3
BLOCK_BYTES = 128 << 10
#: Texts of a block: it has a row of counts for each, over all grams of the block.
BLOCK_TEXTS = 256
_MOST_GRAMS = 1 << 16
_GAP = 32


class Vectors:
    """Vectors of n-grams, made when first met. Those held are bounded; what was let go
    is made again the same."""

    def __init__(self, dimensions: int = DIMENSIONS):
        self.dimensions = dimensions
        self.letters: dict[int, np.ndarray] = {}
        self._empty()

    def _empty(self) -> None:
        self.keys = np.empty(0, np.int64)
        self.rows = np.empty((0, self.dimensions), np.int8)
        self.places = np.empty(0, np.int64)

    def _letter(self, code: int) -> np.ndarray:
        if code not in self.letters:
            draw = np.random.Generator(np.random.PCG64(code)).integers(0, 2, self.dimensions)
            self.letters[code] = (2 * draw - 1).astype(np.int8)
        return self.letters[code]

    def _bind(self, keys: np.ndarray) -> np.ndarray:
        codes, which = np.unique(
            (keys[:, None] >> np.array([21 * k for k in range(GRAM)])) & 0x1FFFFF,
            return_inverse=True,
        )
        which = which.reshape(len(keys), GRAM)
        base = np.stack([self._letter(int(c)) for c in codes])
        out = np.ones((len(keys), self.dimensions), np.int8)
        for place in range(GRAM):
            out *= np.roll(base, place, axis=1)[which[:, place]]
        return out

    def of(self, keys: np.ndarray) -> np.ndarray:
        """A row for each of the sorted, distinct ``keys``."""
        if len(self.keys) + len(keys) > _MOST_GRAMS:
            self._empty()
        new = keys[~np.isin(keys, self.keys, assume_unique=True)]
        if len(new):
            places = np.concatenate([self.places, len(self.rows) + np.arange(len(new))])
            self.rows = np.concatenate([self.rows, self._bind(new)])
            held = np.concatenate([self.keys, new])
            order = np.argsort(held)
            self.keys, self.places = held[order], places[order]
        return self.rows[self.places[np.searchsorted(self.keys, keys)]].astype(np.float32)


@cache
def _is_letter() -> np.ndarray:
    known = np.zeros(sys.maxunicode + 1, bool)
    known[[c for c in range(sys.maxunicode + 1) if chr(c).isalpha()]] = True
    return known


def grams(values: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts, n-grams and counts; words are lower-cased and set between gaps."""
    joined = "\n".join(["", *(v.replace("\n", " ") for v in values), ""])
    codes = np.frombuffer(joined.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = codes.astype(np.int64)
    doc = np.cumsum(codes == 10) - 1
    codes = np.where(_is_letter()[codes], codes, _GAP)
    keep = np.ones(len(codes), bool)
    keep[1:] = (codes[1:] != _GAP) | (codes[:-1] != _GAP)
    codes, doc = codes[keep], doc[keep]
    count = max(0, len(codes) - GRAM + 1)
    key = sum(codes[k : count + k] << (21 * k) for k in range(GRAM))
    middle = codes[1 : count + 1] != _GAP
    key, owner = key[middle], doc[1 : count + 1][middle]
    order = np.lexsort((key, owner))
    key, owner = key[order], owner[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(new)
    return owner[at], key[at], np.diff(np.append(at, len(key)))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    for batch in batches:
        column = batch.column("text")
        for low, high in arrays.blocks(column, BLOCK_BYTES):
            for at in range(low, high, BLOCK_TEXTS):
                part = batch.slice(at, min(BLOCK_TEXTS, high - at))
                yield part, arrays.strings(part.column("text"))


def learn(docs: DataFrame, dimensions: int = DIMENSIONS) -> dict[str, np.ndarray]:
    """The bundle of each language of ``docs`` (text, lang), over all of its texts.

    A task sends one vector for each language and batch; adding them is one aggregate. The
    driver gets one vector per language.
    """

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors = Vectors(dimensions)
        bundles: dict[str, np.ndarray] = {}
        for part, values in _blocks(batches):
            langs = part.column("lang").to_pylist()
            doc, key, count = grams(values)
            if not len(key):
                continue
            weight = count / np.bincount(doc, count, len(values))[doc]
            known, which = np.unique(key, return_inverse=True)
            rows = vectors.of(known)
            for lang in sorted(set(langs)):
                own = np.array([x == lang for x in langs])[doc]
                share = np.bincount(which[own], weight[own], len(known))
                bundles[lang] = bundles.get(lang, 0) + share @ rows
        for lang, bundle in bundles.items():
            yield pa.RecordBatch.from_pydict(
                {"lang": [lang] * dimensions, "at": np.arange(dimensions), "value": bundle}
            )

    rows = docs.where(F.col("lang").isNotNull()).select("text", "lang")
    sums = (
        rows.mapInArrow(partial, "lang string, at long, value double")
        .groupBy("lang", "at")
        .agg(F.sum("value").alias("value"))
        .groupBy("lang")
        .agg(F.sort_array(F.collect_list(F.struct("at", "value"))).alias("bundle"))
    )
    return {
        r.lang: np.array([x.value for x in r.bundle]) for r in sums.orderBy("lang").collect()
    }


def predict(docs: DataFrame, profiles: dict[str, np.ndarray]) -> DataFrame:
    """``docs`` with lang_pred and score, the cosine from 0 on, in place of the text."""
    names = sorted(profiles)
    dimensions = len(profiles[names[0]]) if names else DIMENSIONS
    table = np.array([profiles[n] / (np.linalg.norm(profiles[n]) or 1) for n in names])
    table = table.reshape(len(names), dimensions).astype(np.float32)
    others = [c for c in docs.columns if c not in ("text", "lang_pred", "score")]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors = Vectors(dimensions)
        for part, values in _blocks(batches):
            doc, key, count = grams(values)
            langs, scores = [UNKNOWN] * len(values), np.zeros(len(values))
            if len(key) and names:
                known, which = np.unique(key, return_inverse=True)
                counts = np.zeros((len(values), len(known)), np.float32)
                counts[doc, which] = count
                bundles = counts @ vectors.of(known)
                norms = np.linalg.norm(bundles, axis=1)
                cosines = (bundles @ table.T) / np.where(norms == 0, 1, norms)[:, None]
                lettered = np.bincount(doc, minlength=len(values)) > 0
                best = np.argmax(cosines, axis=1)
                langs = [names[b] if ok else UNKNOWN for b, ok in zip(best, lettered, strict=True)]
                scores = np.clip(np.where(lettered, cosines.max(axis=1), 0), 0, 1).astype(float)
            columns = [part.column(c) for c in others]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(langs, pa.string()), pa.array(scores)],
                names=[*others, "lang_pred", "score"],
            )

    kept = docs.select(*(F.col(f"`{c}`") for c in others), "text")
    shape = and_fields(kept.schema.fields[:-1], "lang_pred string, score double")
    return kept.mapInArrow(score, shape)
