"""Toxicity by weak supervision.

1. Terms are mined from up to ``mined`` labelled rows of each class: words and word beginnings
   whose log odds between the classes, smoothed, lie beyond ``odds`` by ``spread`` deviations.
   That bears wrong labels: a term needs not be without rows of the other class. Terms of toxic
   rows are dealt to many lexicon voters, terms of clean rows to some that vote against; pattern
   voters (share of capitals, of exclamation marks, direct address) join them. A voter fires
   on a text or abstains. Only ids of labelled rows move, no texts: they are few enough to be
   broadcast by that bound. How many rows of each class there are comes from all labels.
2. A generative label model sees votes only. One pass over all documents sums how often
   every pair of voters fires together (a table as large as the voters squared). With a
   known share of toxic rows, the rank-one part of the covariance tells how often each
   voter fires on either class; pairs that go together far more or less than that explains
   are correlated: they are left out of the fit and share their weight.
3. The posterior of each row of a bounded sample trains a linear classifier on hashed word
   and word-beginning shares and the voters' shares, which then scores every whole text.

Rows may repeat and ids may be null; every row gets a score. Null and empty texts score as
a text without words does. Without labelled rows, or with one class only, scores are 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from smeltery.llm import arrays
from smeltery.llm.shared import and_fields, small_batches, written

PREFIXES = (4, 5)
TOXIC_VOTERS = 24
LEXICON_VOTERS = TOXIC_VOTERS + 4
VOTERS = LEXICON_VOTERS + 4
BUCKETS = 1 << 15
HELD_TERMS = 1 << 19
SENT_ROWS = 1 << 16
_EDGE = np.zeros(256, bool)
_EDGE[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True

# Words of direct address.
ADDRESS = "du dich dir ihr tu toi vous tú usted you your u ur".split()


@dataclass(frozen=True)
class Settings:
    """``sample`` and ``sample_bytes`` bound the texts that the classifier is trained on,
    ``mined`` the labelled rows of each class that terms are taken from, and ``lexicon`` the
    terms of each sign. Terms against toxic are in ``common`` of the rows at most."""

    sample: int = 6_000
    sample_bytes: int = 1 << 25
    mined: int = 200_000
    lexicon: int = 4_096
    odds: float = 3.0
    spread: float = 2.0
    common: float = 0.2
    steps: int = 150
    rate: float = 0.5
    decay: float = 1e-4


@dataclass
class Model:
    terms: np.ndarray = field(default_factory=lambda: np.empty(0, np.uint64))
    voter: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))
    fires: np.ndarray = field(default_factory=lambda: np.empty((2, 0)))
    correlated: list[tuple[int, int]] = field(default_factory=list)
    weights: np.ndarray | None = None


def _hash(values: list[str]) -> np.ndarray:
    raw = [v.encode() for v in values]
    ends = np.cumsum([len(r) for r in raw])
    data = np.frombuffer(b"".join(raw), np.uint8)
    return arrays.hash_spans(data, np.concatenate([[0], ends[:-1]]), ends)


_ADDRESS = np.sort(_hash(ADDRESS))


def _is_in(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(values), bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def tokens(w: arrays.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of each word without case and outer marks, and of its beginnings.

    Capitals beyond ASCII are not lowered. A beginning is cut between characters and is
    salted by its length; a word not longer than it has none.
    """
    lowered = arrays.LOWER[w.data]
    starts, ends = w.starts.copy(), w.ends.copy()
    for _ in range(3):
        ends -= _EDGE[w.data[ends - 1]] & (ends - starts > 1)
        starts += _EDGE[w.data[starts]] & (ends - starts > 1)
    sums = arrays.prefix(lowered)
    words = arrays.between(sums, starts, ends)
    lead = np.concatenate([[0], np.cumsum((w.data & 0xC0) != 0x80)])
    position = np.flatnonzero((w.data & 0xC0) != 0x80)
    position = np.append(position, len(w.data))
    beginnings = []
    for n in PREFIXES:
        cut = position[np.minimum(lead[starts] + n, len(position) - 1)]
        at = arrays.between(sums, starts, np.minimum(cut, ends)) + np.uint64(n)
        beginnings.append(np.where(cut < ends, arrays.mixed(at), np.uint64(0)))
    return words, beginnings[0], beginnings[1]


def _counts(w: arrays.Words, flags: np.ndarray) -> np.ndarray:
    return arrays.total_per_text(flags, w.first)


def _voter_hits(w: arrays.Words, found: tuple[np.ndarray, ...], model: Model) -> np.ndarray:
    n = len(w.offsets) - 1
    hits = np.zeros((n, LEXICON_VOTERS), np.int64)
    for kind in found:
        if len(model.terms) and len(kind):
            place = np.minimum(np.searchsorted(model.terms, kind), len(model.terms) - 1)
            known = (model.terms[place] == kind) & (kind != 0)
            cell = w.doc[known] * LEXICON_VOTERS + model.voter[place[known]]
            hits += np.bincount(cell, minlength=n * LEXICON_VOTERS).reshape(n, LEXICON_VOTERS)
    return hits


def votes(
    w: arrays.Words, model: Model, found: tuple[np.ndarray, ...] | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Which voters fire, and the lexicon hits of each text."""
    found = tokens(w) if found is None else found
    hits = _voter_hits(w, found, model)
    n_words = np.maximum(w.per_text, 1)
    capital = arrays.total_per_text((w.data >= 65) & (w.data <= 90), w.offsets)
    letters = arrays.total_per_text(arrays.LOWER[w.data] >= 97, w.offsets)
    loud = arrays.total_per_text(w.data == 33, w.offsets)
    address = _counts(w, _is_in(found[0], _ADDRESS))
    patterns = [
        2 * capital > np.maximum(letters, 1),
        4 * loud > n_words,
        20 * address > n_words,
        100 * hits[:, :TOXIC_VOTERS].sum(axis=1) > n_words,
    ]
    return np.concatenate([hits > 0, np.stack(patterns, axis=1)], axis=1), hits


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, arrays.Words]]:
    for batch in batches:
        for low, high in arrays.blocks(batch.column("text")):
            part = batch.slice(low, high - low)
            yield part, arrays.words(*arrays.texts(part.column("text")))


def learned(labels: DataFrame) -> DataFrame:
    """One row per labelled id."""
    known = labels.where("toxic is not null and doc_id is not null")
    return known.groupBy("doc_id").agg((F.max("toxic") > 0).alias("toxic"))


def _drawn(toxic: float, clean: float) -> Column:
    """Whether a row's id is among these shares of its class, by its hash."""
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 31)) / float(1 << 31)
    return place < F.when(F.col("toxic"), toxic).otherwise(clean)


def bounded(docs: DataFrame, known: DataFrame, toxic: int, clean: int, settings: Settings) -> DataFrame:
    """Text and label of at most ``sample`` documents, of each class those whose hashed ids
    are smallest: half of them toxic, or what there is of the smaller class.

    The texts of a class hold half of ``sample_bytes`` and one more text at most. The ids
    are cut to that many before they meet the texts, so they can be broadcast.
    """
    half = settings.sample // 2
    most = min(toxic, max(half, settings.sample - clean))
    known = known.join(docs.select("doc_id"), "doc_id", "left_semi")
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    bad = known.where("toxic").orderBy(*order).limit(most)
    good = known.where("not toxic").orderBy(*order).limit(settings.sample - most)
    earlier = Window.partitionBy("toxic").orderBy(*order, F.xxhash64("text"))
    earlier = earlier.rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum(F.octet_length("text")).over(earlier), F.lit(0))
    rows = docs.join(F.broadcast(bad.unionByName(good)), "doc_id").select("doc_id", "text", "toxic")
    rows = rows.withColumn("before", before).where(F.col("before") < settings.sample_bytes // 2)
    return rows.select("text", "toxic").limit(settings.sample)


def _summed(parts: list[np.ndarray]) -> np.ndarray:
    """Rows of (term, toxic, rows) summed by term."""
    rows = np.concatenate(parts, axis=1)
    terms, at = np.unique(rows[0], return_inverse=True)
    sums = [np.bincount(at, x, len(terms)).astype(np.int64) for x in rows[1:]]
    return np.stack([terms, *sums])


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many rows, and toxic rows, have each term; term 0 stands for all rows."""
    parts: list[np.ndarray] = []

    def sent(sums: np.ndarray) -> Iterator[pa.RecordBatch]:
        for low in range(0, sums.shape[1], SENT_ROWS):
            columns = [pa.array(x[low : low + SENT_ROWS]) for x in sums]
            yield pa.RecordBatch.from_arrays(columns, names=["term", "bad", "held"])

    for part, w in _words(batches):
        label = part.column("toxic").to_numpy(zero_copy_only=False).astype(np.int64)
        terms, bad = [np.zeros(len(label), np.uint64)], [label]
        for kind in tokens(w):
            values, doc = arrays.distinct_per_text(kind, w.doc)
            terms.append(values[values != 0])
            bad.append(label[doc[values != 0]])
        term = np.concatenate(terms).view(np.int64)
        parts.append(_summed([np.stack([term, np.concatenate(bad), np.ones(len(term), np.int64)])]))
        if sum(x.shape[1] for x in parts) > HELD_TERMS:
            parts = [_summed(parts)]
            if parts[0].shape[1] > HELD_TERMS // 2:
                yield from sent(parts.pop())
    if parts:
        yield from sent(_summed(parts))


def mine(rows: DataFrame, settings: Settings) -> tuple[Model, int, int]:
    """Terms that tell the classes apart, dealt to the lexicon voters in turn, and how many
    of ``rows`` (text, toxic) are toxic and clean."""
    counts = rows.select("text", "toxic").mapInArrow(_term_counts, "term long, bad long, held long")
    counts = counts.groupBy("term").agg(F.sum("bad").alias("bad"), F.sum("held").alias("held"))
    counts = written(counts)
    whole = counts.where("term = 0").first()
    toxic, clean = (whole["bad"], whole["held"] - whole["bad"]) if whole else (0, 0)
    if not toxic or not clean:
        return Model(), toxic, clean
    a, b = F.col("bad") + 0.5, F.col("held") - F.col("bad") + 0.5
    c, d = toxic - F.col("bad") + 0.5, clean - F.col("held") + F.col("bad") + 0.5
    odds, deviation = F.log(a / c) - F.log(b / d), F.sqrt(1 / a + 1 / b + 1 / c + 1 / d)
    least, margin = float(np.log(settings.odds)), settings.spread * deviation
    told = counts.where("term != 0").withColumns({"up": odds - margin, "down": -odds - margin})
    rare = F.col("held") <= settings.common * (toxic + clean)
    terms, voter = [], []
    for sign, more, first, last in (("up", F.lit(True), 0, TOXIC_VOTERS), ("down", rare, TOXIC_VOTERS, LEXICON_VOTERS)):
        best = told.where((F.col(sign) > least) & more).orderBy(F.desc(sign), "term").limit(settings.lexicon)
        found = best.select("term").toArrow().column("term").to_numpy().view(np.uint64)
        terms.append(found)
        voter.append(first + np.arange(len(found)) % (last - first))
    terms, voter = np.concatenate(terms), np.concatenate(voter)
    order = np.argsort(terms)
    return Model(terms[order], voter[order]), toxic, clean


def together(docs: DataFrame, model: Model) -> np.ndarray:
    """How often each two voters fire on the same text of ``docs``; a last voter always does."""
    wide = VOTERS + 1

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((wide, wide))
        for _, w in _words(batches):
            cast = votes(w, model)[0].astype(np.float64)
            cast = np.concatenate([cast, np.ones((len(cast), 1))], axis=1)
            sums += cast.T @ cast
        flat = sums.ravel()
        yield pa.RecordBatch.from_pydict({"cell": np.arange(len(flat)), "value": flat})

    sums = (
        docs.select("text")
        .mapInArrow(partial, "cell long, value double")
        .groupBy("cell")
        .agg(F.sum("value").alias("value"))
    )
    out = np.zeros(wide**2)
    for row in sums.collect():
        out[row.cell] = row.value
    return out.reshape(wide, wide)


def _of_threes(correlation: np.ndarray, use: np.ndarray, k: int) -> float:
    """The factor of voter ``k``: the median over the pairs of voters that it meets."""
    others = np.flatnonzero(use[k])
    i, j = np.triu_indices(len(others), 1)
    i, j = others[i], others[j]
    known = use[i, j] & (abs(correlation[i, j]) > 1e-6)
    i, j = i[known], j[known]
    if not len(i):
        return 0.0
    square = np.median(correlation[k, i] * correlation[k, j] / correlation[i, j])
    sign = -1 if np.median(correlation[k, others]) < 0 else 1
    return float(sign * np.sqrt(np.clip(square, 0, 0.98)))


def label_model(
    sums: np.ndarray, prior: float, spread: float = 3.0, rounds: int = 60
) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """How often each voter fires on clean and on toxic texts, and the correlated pairs.

    Given the class, voters that are independent have covariance p (1 - p) d_i d_j, where
    d is the difference of their rates. Each three voters give d of one of them; the median
    over all threes is not bent by the correlated pairs. Pairs that it does not explain are
    set apart, and alternating least squares fits d to the others.
    """
    n = len(sums) - 1
    mean = sums[:n, n] / max(sums[n, n], 1)
    covariance = sums[:n, :n] / max(sums[n, n], 1) - np.outer(mean, mean)
    deviation = np.sqrt(np.maximum(mean * (1 - mean), 1e-9))
    correlation = covariance / np.outer(deviation, deviation)
    lives = mean > 0
    use = np.outer(lives, lives) & ~np.eye(n, dtype=bool)
    factor = np.array([_of_threes(correlation, use, k) for k in range(n)])
    misfit = np.where(use, abs(correlation - np.outer(factor, factor)), 0)
    limit = max(spread * np.median(misfit[use]) if use.any() else 0, 0.05)
    apart = misfit > limit
    # A third of a voter's pairs stay in the fit, so that its rates are still known.
    fit = use & ~apart
    for k in np.flatnonzero(apart.sum(axis=1) > 2 * n / 3):
        nearest = np.argsort(misfit[k])[: n // 3]
        fit[k, nearest] = fit[nearest, k] = use[k, nearest]
    for _ in range(rounds):
        square = fit @ factor**2
        fitted = (fit * correlation) @ factor / np.where(square == 0, 1, square)
        factor = np.clip((factor + np.where(square == 0, 0, fitted)) / 2, -0.99, 0.99)
    difference = factor * deviation / np.sqrt(prior * (1 - prior))
    clean = np.clip(mean - prior * difference, 1e-4, 0.98)
    toxic = np.clip(mean + (1 - prior) * difference, 2e-4, 0.98)
    pairs = [(int(i), int(j)) for i, j in np.argwhere(apart) if i < j]
    return np.stack([clean, toxic]), pairs


def posterior(cast: np.ndarray, model: Model, prior: float) -> np.ndarray:
    """Probability of toxic, given which voters fire. Correlated voters that fire together
    count as one."""
    linked = np.eye(cast.shape[1])
    for i, j in model.correlated:
        linked[i, j] = linked[j, i] = 1
    weight = 1 / np.maximum(cast @ linked, 1)
    clean, toxic = model.fires
    fired, silent = np.log(toxic / clean), np.log((1 - toxic) / (1 - clean))
    odds = np.where(cast, weight * fired, silent).sum(axis=1) + np.log(prior / (1 - prior))
    return 1 / (1 + np.exp(-odds))


def features(w: arrays.Words, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, column and value of the features of each text that are not zero."""
    found = tokens(w)
    hits = votes(w, model, found)[1]
    n, share = len(w.offsets) - 1, 1 / np.sqrt(np.maximum(w.per_text, 1))
    rows, columns, values = [], [], []
    for salt, kind in enumerate((found[0], found[2])):
        used = kind != 0
        column = (kind[used] % np.uint64(BUCKETS)).astype(np.int64) + salt * BUCKETS
        cell, count = np.unique(w.doc[used] * (2 * BUCKETS) + column, return_counts=True)
        rows.append(cell // (2 * BUCKETS))
        columns.append(cell % (2 * BUCKETS))
        values.append(np.sqrt(count) * share[rows[-1]])
    dense = np.concatenate(
        [
            np.minimum(hits, 3) / 3,
            np.minimum(hits[:, :TOXIC_VOTERS].sum(axis=1, keepdims=True), 2),
            np.ones((n, 1)),
        ],
        axis=1,
    )
    at = np.argwhere(dense)
    rows.append(at[:, 0])
    columns.append(2 * BUCKETS + at[:, 1])
    values.append(dense[at[:, 0], at[:, 1]])
    return np.concatenate(rows), np.concatenate(columns), np.concatenate(values)


_WIDTH = 2 * BUCKETS + LEXICON_VOTERS + 2


def train(texts: list[str], model: Model, prior: float, settings: Settings) -> np.ndarray:
    """Weights of a logistic regression on the posterior of the votes on ``texts``."""
    column = pa.array(texts, pa.large_string())
    rows, columns, values, target = [], [], [], []
    for low, high in arrays.blocks(column):
        w = arrays.words(*arrays.texts(column.slice(low, high - low)))
        r, c, v = features(w, model)
        rows.append((r + low).astype(np.int32))
        columns.append(c.astype(np.int32))
        values.append(v.astype(np.float32))
        target.append(posterior(votes(w, model)[0], model, prior))
    r, c, v = np.concatenate(rows), np.concatenate(columns), np.concatenate(values)
    y = np.concatenate(target)
    weights, speed = np.zeros(_WIDTH), np.full(_WIDTH, 1e-8)
    for _ in range(settings.steps):
        score = 1 / (1 + np.exp(-np.bincount(r, v * weights[c], len(y))))
        slope = np.bincount(c, v * (score - y)[r], _WIDTH) / len(y) + settings.decay * weights
        speed += slope**2
        weights -= settings.rate * slope / np.sqrt(speed)
    return weights


def fit(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model:
    """``docs`` has doc_id and text; ``labels`` has doc_id and toxic, for rows to learn from.

    Of several labels of one id the toxic one holds.
    """
    small_batches(docs.sparkSession)
    known = learned(labels)
    sizes = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    if len(sizes) < 2:
        return Model()
    shares = {k: min(1.0, settings.mined / n) for k, n in sizes.items()}
    ids = F.broadcast(known.where(_drawn(shares[True], shares[False])))
    rows = docs.select("doc_id", "text").join(ids, "doc_id")
    model, toxic, clean = mine(rows, settings)
    if not len(model.terms):
        return model
    prior = float(np.clip(sizes[True] / (sizes[True] + sizes[False]), 1e-4, 0.5))
    model.fires, model.correlated = label_model(together(docs, model), prior)
    texts = [r.text or "" for r in bounded(docs, known, toxic, clean, settings).collect()]
    model.weights = train(texts, model, prior, settings)
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """The columns of ``docs`` but its text, with score (0 to 1) and predicted (0 or 1)."""
    small_batches(docs.sparkSession)
    others = [c for c in docs.columns if c not in ("text", "score", "predicted")]

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, w in _words(batches):
            result = np.zeros(part.num_rows)
            if model.weights is not None:
                r, c, v = features(w, model)
                total = np.bincount(r, v * model.weights[c], part.num_rows)
                result = 1 / (1 + np.exp(-total))
            predicted = pa.array((result >= 0.5).astype(np.int32))
            columns = [part.column(k) for k in others] + [pa.array(result), predicted]
            yield pa.RecordBatch.from_arrays(columns, names=[*others, "score", "predicted"])

    kept = docs.select(*(F.col(f"`{c}`") for c in others), "text")
    shape = and_fields(kept.schema.fields[:-1], "score double, predicted int")
    return kept.mapInArrow(scored, shape)
