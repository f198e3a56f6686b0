"""Benchmark passages in documents, found by CGK embedding and bit-sampling LSH.

Words are the symbols: A to Z lower-cased, outer ASCII marks left out, words of marks only
skipped. An item of n words is in a document if some window of n words of it is within
``edits`` * n word edits (Levenshtein, rounded down). A random walk embeds window and item
in strings of 3n symbols whose Hamming distance follows the edit distance: step t writes
the symbol it stands at and moves on if a random bit of that step and symbol is set. Several
walks, each sampled at several sets of steps, give the LSH keys. Each item size has as many
walks as find, at the target recall, copies of its items with all the edits of the limit,
be they replaced words or words put in and left out. Where the most walks are too few, or
the recall is 1, the candidates are instead all items that share as many grams with a window
as a match must: none is lost. Candidates are verified by exact edit distance.

Only windows that can match are embedded: a window within k edits shares at least
n - 2 - 3k of its three-word runs with the item, so windows with fewer runs of the items of
their size are left out without loss. Where that is less than one run, none is left out.

Items are taken to the driver and the tasks in blocks of at most ``block_words`` words,
with one pass over the documents each. Null or wordless items and texts match nothing;
rows with null or repeated ids are searched like others. Items of one text both match.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smeltery.llm import arrays
from smeltery.llm.anchors import ranges
from smeltery.llm.shared import small_batches

EDITS = 0.2
RECALL = 0.995
SETS = 8
SAMPLED = 4
RUN = 3
BLOCK_WORDS = 1 << 20
MOST_WALKS = 64
AT_ONCE = 1 << 12
PAIR_WORDS = 1 << 18

_EDGE = np.zeros(256, bool)
_EDGE[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True


def symbols(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A hash per word of each text, and where those of each text begin, with the end."""
    data, offsets = arrays.texts(column)
    starts, ends = arrays.spans(~arrays.SPACE[data], offsets)
    # Marks at either end of a word go, however many there are.
    plain = np.concatenate([[0], np.cumsum(~_EDGE[data])])
    some = plain[ends] > plain[starts]
    starts, ends = starts[some], ends[some]
    at = np.flatnonzero(~_EDGE[data])
    starts, ends = at[plain[starts]], at[plain[ends] - 1] + 1
    hashes = arrays.hash_spans(arrays.LOWER[data], starts, ends)
    return hashes, np.searchsorted(starts, offsets, "left")


def runs_of(hashes: np.ndarray) -> np.ndarray:
    """A hash per run of three words, by its first."""
    if len(hashes) < RUN:
        return np.empty(0, np.uint64)
    at = np.arange(len(hashes) - RUN + 1)
    return arrays.between(arrays.prefix(hashes), at, at + RUN)


def least_runs(n: int, edits: float) -> int:
    return max(0, n - RUN + 1 - RUN * int(edits * n))


def walk(flat: np.ndarray, starts: np.ndarray, n: int, seed: int, steps: np.ndarray) -> np.ndarray:
    """The symbols that a walk over each window of ``n`` writes at the given sorted steps."""
    place, out = np.zeros(len(starts), np.int64), []
    sampled, bits, word = set(steps.tolist()), None, -1
    for t in range(int(steps[-1]) + 1):
        over = place >= n
        at = starts + np.minimum(place, n - 1)
        if t // 64 != word:
            word = t // 64
            bits = arrays.mixed(flat + np.uint64((seed * 64 + word + 1) * 0x632BE59BD9B4E019 % (1 << 64)))
        if t in sampled:
            out.append(np.where(over, np.uint64(0), flat[at]))
        place += ((bits[at] >> np.uint64(t % 64)) & np.uint64(1)).astype(np.int64)
    return np.stack(out, axis=1) if out else np.empty((len(starts), 0), np.uint64)


def keys_of(flat: np.ndarray, starts: np.ndarray, n: int, seed: int) -> np.ndarray:
    """LSH keys of one walk: a column per set of sampled steps, apart for n and walk."""
    rng = np.random.Generator(np.random.PCG64([n, seed]))
    chosen = rng.integers(0, max(1, 2 * n), (SETS, SAMPLED))
    steps = np.unique(chosen)
    written = walk(flat, starts, n, seed, steps)
    column = np.searchsorted(steps, chosen)
    out = np.empty((len(starts), SETS), np.uint64)
    for s in range(SETS):
        key = np.full(len(starts), (n * 4096 + seed) * SETS + s, np.uint64)
        for c in column[s]:
            key = arrays.mixed(key * np.uint64(0x9E3779B97F4A7C15) + written[:, c])
        out[:, s] = key
    return out


def distances(own: np.ndarray, far: np.ndarray) -> np.ndarray:
    """Levenshtein distance of each row of ``own`` to the row of ``far``, both [m, n]."""
    m, n = own.shape
    row = np.broadcast_to(np.arange(n + 1), (m, n + 1)).copy()
    steps = np.arange(n + 1)
    for i in range(n):
        cost = own[:, i, None] != far
        best = np.minimum(row[:, 1:] + 1, row[:, :-1] + cost)
        new = np.concatenate([np.full((m, 1), i + 1), best], axis=1)
        row = np.minimum.accumulate(new - steps, axis=1) + steps
    return row[:, -1]


@dataclass
class Index:
    ids: list
    flat: np.ndarray
    first: np.ndarray
    runs: np.ndarray
    edits: float
    walks: dict[int, int]
    by_size: dict[int, np.ndarray]
    runs_of_size: dict[int, np.ndarray | None]
    keys: dict[int, tuple[np.ndarray, np.ndarray]]


def index(ids: list, column: pa.Array, edits: float = EDITS, recall: float = RECALL) -> Index:
    """Items by size, their runs and LSH keys; enough walks for the recall."""
    flat, first = symbols(column)
    sizes = np.diff(first)
    by_size = {int(n): np.flatnonzero(sizes == n) for n in np.unique(sizes) if n}
    runs = [runs_of(flat[first[i] : first[i + 1]]) for i in range(len(ids))]
    none = np.empty(0, np.uint64)
    # Where no run must be shared, as with items shorter than one, every window is looked at.
    of_size = {
        n: np.unique(np.concatenate([runs[i] for i in items])) if least_runs(n, edits) else None
        for n, items in by_size.items()
    }
    runs = np.unique(np.concatenate([none, *(x for x in of_size.values() if x is not None)]))
    walks = {n: _walks(flat, first[items], n, edits, recall) for n, items in by_size.items()}
    out = Index(list(ids), flat, first, runs, edits, walks, by_size, of_size, {})
    for n, items in by_size.items():
        if walks[n]:
            keys = [keys_of(flat, first[items], n, seed) for seed in range(walks[n])]
            keys = np.concatenate(keys, axis=1)
            item = np.repeat(items, keys.shape[1])
            order = np.argsort(keys.ravel(), kind="stable")
            out.keys[n] = keys.ravel()[order], item[order]
        else:
            grams = grams_of(flat[first[items][:, None] + np.arange(n)], _gram(n, edits)[0])
            held = np.empty(grams.size, [("gram", np.uint64), ("item", np.int64)])
            held["gram"], held["item"] = grams.ravel(), np.repeat(items, grams.shape[1])
            held = np.unique(held)
            out.keys[n] = held["gram"].copy(), held["item"].copy()
    return out


def _gram(n: int, edits: float) -> tuple[int, int]:
    """The size of grams to look for, and how many of them a window within the limit shares."""
    by_run = least_runs(n, edits)
    return (RUN, by_run) if by_run else (1, max(1, n - int(edits * n)))


def grams_of(words: np.ndarray, size: int) -> np.ndarray:
    """A hash per gram of each row of ``words``, [m, n]."""
    m, n = words.shape
    at = (np.arange(m)[:, None] * n + np.arange(n - size + 1)).ravel()
    return arrays.between(arrays.prefix(words.ravel()), at, at + size).reshape(m, -1)


def _walks(flat: np.ndarray, starts: np.ndarray, n: int, edits: float, recall: float) -> int:
    """The walks that find copies of the items of ``n`` words at the recall, by one standard
    error more, for each kind of edits; 0 if MOST_WALKS are too few."""
    limit = int(edits * n)
    if not limit:
        return 1
    if recall >= 1:
        return 0
    many = min(2000, max(500, 100_000 // n))
    rng = np.random.Generator(np.random.PCG64([7, n]))
    original = flat[np.resize(starts, many)[:, None] + np.arange(n)]
    copies = [_replaced(original, limit, rng), _shifted(original, limit, rng)]
    missed = np.ones((len(copies), many), bool)
    least = 1 - recall - np.sqrt(recall * (1 - recall) / many)
    at = np.arange(many) * n
    for walks in range(1, MOST_WALKS + 1):
        own = keys_of(original.ravel(), at, n, walks - 1)
        for miss, copy in zip(missed, copies, strict=True):
            miss &= (own != keys_of(copy.ravel(), at, n, walks - 1)).all(axis=1)
        if walks % 4 and walks > 2:
            continue
        left = missed.mean(axis=1).max()
        if left <= least:
            return walks
        # Copies that one walk misses are missed by others rather more often than that.
        if left ** (MOST_WALKS / walks) > 1 - recall:
            return 0
    return 0


def _replaced(words: np.ndarray, count: int, rng: np.random.Generator) -> np.ndarray:
    out = words.copy()
    at = rng.random(words.shape).argsort(axis=1)[:, :count]
    np.put_along_axis(out, at, rng.integers(1, 1 << 62, at.shape).astype(np.uint64), axis=1)
    return out


def _shifted(words: np.ndarray, count: int, rng: np.random.Generator) -> np.ndarray:
    """Words put in or left out; that shifts the window's end: two edits of ``count``."""
    m, n = words.shape
    out, place = _replaced(words, count % 2, rng), np.arange(n)
    for _ in range(count // 2):
        at, more = rng.integers(0, n, (m, 1)), rng.integers(0, 2, (m, 1)) > 0
        source = place + np.where(more, -(place > at).astype(np.int64), place >= at)
        out = np.take_along_axis(out, np.minimum(source, n - 1), axis=1)
        new = rng.integers(1, 1 << 62, (m, 1)).astype(np.uint64)
        np.put_along_axis(out, np.where(more, at, n - 1), new, axis=1)
    return out


def windows(known: Index, column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each size of item, the words and the texts of the windows that can match one."""
    flat, first = symbols(column)
    if not len(flat) or not known.by_size:
        return
    runs = runs_of(flat)
    at = np.flatnonzero(_is_in(runs, known.runs))
    for n, own in known.runs_of_size.items():
        if own is None:
            starts = np.arange(len(flat))
        else:
            starts = _starts(at[_is_in(runs[at], own)], least_runs(n, known.edits), n)
        doc = np.searchsorted(first, starts, "right") - 1
        inside = (starts >= 0) & (doc >= 0) & (doc < len(column))
        starts, doc = starts[inside], doc[inside]
        inside = starts + n <= first[1:][doc]
        starts, doc = starts[inside], doc[inside]
        for low in range(0, len(starts), AT_ONCE):
            part = starts[low : low + AT_ONCE]
            yield n, flat[part[:, None] + np.arange(n)], doc[low : low + AT_ONCE]


def _is_in(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known) or not len(values):
        return np.zeros(len(values), bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def _starts(hits: np.ndarray, least: int, n: int) -> np.ndarray:
    """Starts of the windows of ``n`` words with at least ``least`` of the runs at ``hits``."""
    if len(hits) < least:
        return np.empty(0, np.int64)
    first, last = hits[: len(hits) - least + 1], hits[least - 1 :]
    low = last - (n - RUN)
    near = low <= first
    return np.unique(ranges(low[near], first[near] - low[near] + 1)[0])


def matches(known: Index, column: pa.Array) -> list[dict]:
    """For each text, the items in it with their smallest distance.

    Windows of all blocks are gathered by size, so that one walk serves many.
    """
    found: list[dict] = [{} for _ in range(len(column))]
    held: dict[int, list] = {}
    for low, high in arrays.blocks(column):
        for n, words, doc in windows(known, column.slice(low, high - low)):
            held.setdefault(n, []).append((words, doc + low))
            if sum(len(d) for _, d in held[n]) >= AT_ONCE:
                _search(known, n, held.pop(n), found)
    for n, parts in held.items():
        _search(known, n, parts, found)
    return found


def _search(known: Index, n: int, parts: list, found: list[dict]) -> None:
    words, doc = (np.concatenate(x) for x in zip(*parts, strict=True))
    pairs = _sharing(known, n, words) if not known.walks[n] else _meeting(known, n, words)
    limit = int(known.edits * n)
    step = min(AT_ONCE, max(1, PAIR_WORDS // n))
    for low in range(0, len(pairs), step):
        window, item = np.divmod(pairs[low : low + step], len(known.ids))
        far = known.flat[known.first[item][:, None] + np.arange(n)]
        distance = distances(words[window], far)
        near = distance <= limit
        rows = doc[window[near]].tolist()
        for row, i, d in zip(rows, item[near].tolist(), distance[near].tolist(), strict=True):
            found[row][i] = min(d, found[row].get(i, d))


def _meeting(known: Index, n: int, words: np.ndarray) -> np.ndarray:
    """Pairs of window and item with an LSH key in common, as window * items + item."""
    flat, at = words.ravel(), np.arange(len(words)) * n
    pairs = []
    for seed in range(known.walks[n]):
        own = keys_of(flat, at, n, seed).ravel()
        window, item = _held(known.keys[n], own)
        pairs.append(window // SETS * len(known.ids) + item)
    return np.unique(np.concatenate(pairs))


def _sharing(known: Index, n: int, words: np.ndarray) -> np.ndarray:
    """All pairs with as many grams in common as a match has at least."""
    size, least = _gram(n, known.edits)
    # A window meets each item at most once per gram.
    step = max(1, AT_ONCE * 512 // (n * len(known.by_size[n])))
    pairs = []
    for low in range(0, len(words), step):
        grams = grams_of(words[low : low + step], size)
        window, item = _held(known.keys[n], grams.ravel())
        window = window // grams.shape[1] + low
        pair, count = np.unique(window * len(known.ids) + item, return_counts=True)
        pairs.append(pair[count >= least])
    return np.concatenate(pairs)


def _held(keys: tuple[np.ndarray, np.ndarray], own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places in ``own`` of keys that items have, and these items."""
    known, owner = keys
    low, high = np.searchsorted(known, own, "left"), np.searchsorted(known, own, "right")
    count = high - low
    offset = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    return np.repeat(np.arange(len(own)), count), owner[np.repeat(low, count) + offset]


def marked(
    docs: DataFrame, benchmark: DataFrame, edits: float = EDITS, recall: float = RECALL, block_words: int = BLOCK_WORDS
) -> DataFrame:
    """``docs`` with ``items``: the (item_id, distance) of ``benchmark`` found in each text."""
    small_batches(docs.sparkSession)
    blank = F.size(F.split(F.coalesce("text", F.lit("")), r"\s+"))
    total = benchmark.agg(F.sum(blank.cast("long"))).first()[0] or 0
    parts = max(1, -(-total // block_words))
    kind = benchmark.schema["item_id"].dataType.simpleString()
    shape = f"array<struct<item_id: {kind}, distance: int>>"
    out = docs.withColumn("items", F.array().cast(shape))
    # Rows of one item_id may lie in any part: each part holds about block_words words.
    numbered = benchmark.select("item_id", "text", F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)).alias("part"))
    for part in range(parts):
        rows = numbered.where(F.col("part") == part).orderBy("item_id", "text").collect()
        known = index([r.item_id for r in rows], pa.array([r.text for r in rows], pa.large_string()), edits, recall)
        out = out.mapInArrow(_marking(known), out.schema)
    return out


def _marking(known: Index):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = matches(known, batch.column("text"))
            place = batch.schema.get_field_index("items")
            kind = batch.schema.field("items").type
            held = [
                [*before, *({"item_id": known.ids[i], "distance": d} for i, d in sorted(new.items()))]
                for before, new in zip(batch.column("items").to_pylist(), found, strict=True)
            ]
            yield batch.set_column(place, batch.schema.field("items"), pa.array(held, kind))

    return run
