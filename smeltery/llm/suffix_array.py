"""Suffix-array dedup: every byte goes that lies in a 200-byte string that occurs elsewhere.

Texts are compared as UTF-8 bytes and matches stay within a text. Of all suffixes only those
can matter whose first 200 bytes have an anchor gram that occurs twice (``anchors``), and
equal ones share that gram. So anchors part the suffixes over tasks: a group is the text
around all places of one gram, and equal strings always meet.

A task sorts the suffixes of its groups by difference cover: suffixes at places 1 and 2
modulo 3 are named by their sorted triples, the string of names is sorted the same way until
names differ or reach over 200 bytes, and the suffixes at the other places are merged in by
their first symbol and the rank behind it. Neighbours in that order are then compared over
200 bytes. Places whose whole surroundings are equal are known to repeat; one of them goes
into the sort for all. Groups are bounded: strings around a gram with more than ``group``
places are counted by a 64-bit code instead, before rows move.

Documents with a null id lose and cause nothing. Rows that repeat an id and text are one
document; where texts differ under one id, equal places count as one. Null is empty.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smeltery.llm import anchors, arrays, clusters
from smeltery.llm.shared import parted, written

WINDOW = 200
GRAM = 64
GROUP = 32_768
TEXT_BYTES = 1 << 20


def _names(keys: np.ndarray) -> tuple[np.ndarray, int]:
    """Dense names from 1 on in the order of ``keys``, and how many there are."""
    order = np.argsort(keys, kind="stable")
    new = np.ones(len(keys), bool)
    new[1:] = keys[order][1:] != keys[order][:-1]
    out = np.empty(len(keys), np.int64)
    out[order] = np.cumsum(new)
    return out, int(new.sum())


def _packed(*parts: np.ndarray) -> np.ndarray:
    """One key of up to three parts in their order of weight."""
    top = max(int(p.max(initial=0)) for p in parts) + 1
    if top ** len(parts) < 1 << 63:
        key = parts[0].astype(np.int64)
        for p in parts[1:]:
            key = key * top + p
        return key
    key = _names(parts[0])[0]
    for p in parts[1:]:
        key = _names(key * top + p)[0]
    return key


def ranks(text: np.ndarray, depth: int) -> np.ndarray:
    """Ranks of all suffixes of ``text`` (integers from 1 on; 0 stands behind its end).

    Suffixes that agree in ``depth`` symbols or more may have equal ranks.
    """
    n = len(text)
    if depth <= 1 or n < 3:
        tail = np.concatenate([text, np.zeros(3, np.int64)])
        return _names(_packed(*(tail[k : k + n] for k in range(3))))[0]
    tail = np.concatenate([text, np.zeros(4, np.int64)])
    one, two = np.arange(1, n, 3), np.arange(2, n, 3)
    sample = np.concatenate([one, two])
    named, distinct = _names(_packed(tail[sample], tail[sample + 1], tail[sample + 2]))
    if distinct < len(sample) and depth > 3:
        # The two strings of names, apart by a symbol that is smaller than any name.
        joined = np.concatenate([named[: len(one)], [0], named[len(one) :]])
        deeper = ranks(joined + 1, -(-depth // 3))
        named = np.delete(deeper, len(one))
        named = _names(named)[0]
    rank = np.zeros(n + 4, np.int64)
    rank[sample] = named
    rest = np.arange(0, n, 3)
    return _merged(tail, rank, one, two, rest, n)


def _merged(tail, rank, one, two, rest, n) -> np.ndarray:
    """Ranks of all suffixes from those of the sample: each other suffix is counted into
    the sampled ones at 1 by (symbol, rank behind) and at 2 by (symbol, symbol, rank)."""
    after = 1 + int(rank.max(initial=0))
    symbols = 1 + int(tail.max(initial=0))
    if symbols * symbols * after >= 1 << 63:
        tail = np.concatenate([_names(tail[:n])[0], np.zeros(len(tail) - n, np.int64)])
        symbols = 1 + int(tail.max(initial=0))

    def by_one(i: np.ndarray) -> np.ndarray:
        return tail[i] * after + rank[i + 1]

    def by_two(i: np.ndarray) -> np.ndarray:
        return (tail[i] * symbols + tail[i + 1]) * after + rank[i + 2]

    one, two = one[np.argsort(rank[one], kind="stable")], two[np.argsort(rank[two], kind="stable")]
    rest = rest[np.argsort(by_one(rest), kind="stable")]
    both = np.concatenate([one, two])
    both = both[np.argsort(rank[both], kind="stable")]
    before = np.searchsorted(by_one(one), by_one(rest)) + np.searchsorted(by_two(two), by_two(rest))
    order = np.insert(both, before, rest)
    # Neighbours keep one rank where nothing known tells them apart.
    out = np.empty(n, np.int64)
    first, second = order[:-1], order[1:]
    same = _alike(first, second, tail, rank)
    out[order] = np.concatenate([[1], 1 + np.cumsum(~same)]) if n else order
    return out


def _alike(a: np.ndarray, b: np.ndarray, tail: np.ndarray, rank: np.ndarray) -> np.ndarray:
    ka, kb = a % 3, b % 3
    sampled = (ka > 0) & (kb > 0) & (rank[a] == rank[b])
    one = (ka + kb < 3) & (ka != 2) & (kb != 2) & ((ka == 0) | (kb == 0))
    by_one = one & (tail[a] == tail[b]) & (rank[a + 1] == rank[b + 1])
    two = (np.minimum(ka, kb) == 0) & (np.maximum(ka, kb) == 2)
    by_two = two & (tail[a] == tail[b]) & (tail[a + 1] == tail[b + 1]) & (rank[a + 2] == rank[b + 2])
    return sampled | by_one | by_two


def repeats(text: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """Which of the ``starts`` begin a string of ``length`` bytes that another begins too.

    ``text`` holds bytes; strings from the starts must not run over its end.
    """
    rank = ranks(text.astype(np.int64) + 1, length)
    order = np.lexsort((starts, rank[starts]))
    place = starts[order]
    wide = np.concatenate([text, np.zeros(8, np.uint8)])
    words = sum(wide[k : k + len(text)].astype(np.uint64) << np.uint64(56 - 8 * k) for k in range(8))
    equal = np.ones(max(len(place) - 1, 0), bool)
    for k in [*range(0, length - 7, 8), max(length - 8, 0)]:
        live = np.flatnonzero(equal)
        equal[live] = words[place[live] + k] == words[place[live + 1] + k]
    found = np.zeros(len(starts), bool)
    found[order[1:][equal]] = True
    found[order[:-1][equal]] = True
    return found


def _light(window: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per light anchor the text of its strings: (key, doc, low, count, around)."""
        for batch in batches:
            for values, first, ids, found in anchors.chosen(batch, arrays.texts, window, gram, False):
                if not len(found.at):
                    continue
                size = found.count + window - 1
                offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
                held = values[anchors.ranges(found.low, size)[0]]
                around = pa.Array.from_buffers(
                    pa.binary(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(held)]
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(found.gram.view(np.int64)),
                        pa.array(ids[found.doc].astype(np.int64)),
                        pa.array(found.low - first[found.doc]),
                        pa.array(found.count.astype(np.int32)),
                        around,
                    ],
                    names=["key", "doc", "low", "count", "around"],
                )

    return run


def _heavy(window: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per string of a heavy anchor a code: (key, doc, low, high, known).

        One string of a code goes on from each batch under its key. Where a batch has it
        at several places all are known to repeat, and the others go as ranges without key.
        """
        for batch in batches:
            held: list[tuple] = []
            for values, first, ids, found in anchors.chosen(batch, arrays.texts, window, gram, True):
                start, owner = anchors.ranges(found.low, found.count)
                key = arrays.between(arrays.prefix(values), start, start + window)
                doc = found.doc[owner]
                held.append((key.view(np.int64), ids[doc].astype(np.int64), start - first[doc]))
            if held:
                key, doc, low = (np.concatenate(x) for x in zip(*held, strict=True))
                order = np.lexsort((low, doc, key))
                key, doc, low = key[order], doc[order], low[order]
                new = np.ones(len(key), bool)
                new[1:] = (key[1:] != key[:-1]) | (doc[1:] != doc[:-1]) | (low[1:] != low[:-1])
                key, doc, low = key[new], doc[new], low[new]
                again = np.zeros(len(key) + 1, bool)
                again[1:-1] = key[1:] == key[:-1]
                known, sent = again[:-1] | again[1:], ~again[:-1]
                yield rows(key[sent], doc[sent], low[sent], low[sent] + window, known[sent])
                doc, low = doc[~sent], low[~sent]
                order = np.lexsort((low, doc))
                doc, low = doc[order], low[order]
                head = np.ones(len(doc), bool)
                head[1:] = (doc[1:] != doc[:-1]) | (low[1:] > low[:-1] + 1)
                last = np.append(head[1:], True) if len(doc) else head
                yield rows(None, doc[head], low[head], low[last] + window, np.ones(int(head.sum()), bool))

    def rows(key, doc, low, high, known) -> pa.RecordBatch:
        keys = pa.nulls(len(doc), pa.int64()) if key is None else pa.array(key)
        columns = [keys, *(pa.array(x) for x in (doc, low, high, known))]
        return pa.RecordBatch.from_arrays(columns, names=["key", "doc", "low", "high", "known"])

    return run


def _group_spans(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(doc, low, high) that go, from rows in order of key."""
        for held in clusters.whole_groups(batches):
            yield from _spans_of(held, window)

    return run


def _spans_of(held: pa.Table, window: int) -> Iterator[pa.RecordBatch]:
    key, doc, low, count = (
        held.column(c).to_numpy().astype(np.int64) for c in ("key", "doc", "low", "count")
    )
    around = np.frombuffer(arrays.raw(held.column("around").chunk(0)), np.uint8)
    # Rows of one place are one place.
    order = np.lexsort((low, doc, key))
    new = np.ones(len(order), bool)
    new[1:] = (key[order][1:] != key[order][:-1]) | (doc[order][1:] != doc[order][:-1])
    new[1:] |= low[order][1:] != low[order][:-1]
    size = count + window - 1
    base = np.cumsum(size) - size
    rows = np.sort(order[new])
    code = arrays.hash_spans(around, base, base + size)
    # Equal surroundings: all their strings repeat, and one of them stands for the rest.
    order = rows[np.lexsort((code[rows], count[rows], key[rows]))]
    head = np.ones(len(order), bool)
    head[1:] = (code[order][1:] != code[order][:-1]) | (count[order][1:] != count[order][:-1])
    head[1:] |= key[order][1:] != key[order][:-1]
    leader = order[np.flatnonzero(head)]
    group = np.cumsum(head) - 1
    shared = np.bincount(group) > 1
    # Groups with one kind of surroundings need no sort.
    kinds = key[leader]
    alone = np.ones(len(kinds), bool)
    alone[1:] &= kinds[1:] != kinds[:-1]
    alone[:-1] &= kinds[:-1] != kinds[1:]
    flags: dict[int, np.ndarray] = {}
    todo = np.flatnonzero(~alone)
    sizes = np.cumsum(size[leader[todo]])
    cuts = _whole_groups(kinds[todo], sizes)
    for a, b in cuts:
        part = leader[todo[a:b]]
        at, _ = anchors.ranges(base[part], size[part])
        text = around[at]
        own = np.cumsum(size[part]) - size[part]
        starts, owner = anchors.ranges(own, count[part])
        found = repeats(text, starts, window)
        edge = np.cumsum(count[part]) - count[part]
        for k, member in enumerate(part.tolist()):
            flags[member] = found[edge[k] : edge[k] + count[member]]
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    whole = order[shared[group]]
    if len(whole):
        out.append((doc[whole], low[whole], low[whole] + count[whole] - 1 + window))
    for k in np.flatnonzero(~alone & ~shared).tolist():
        member = leader[k]
        runs, ends = arrays.spans(flags[member], np.zeros(1, np.int64))
        if len(runs):
            out.append((np.full(len(runs), doc[member]), low[member] + runs, low[member] + ends - 1 + window))
    if out:
        columns = [np.concatenate(x) for x in zip(*out, strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["doc", "low", "high"])


def _whole_groups(kinds: np.ndarray, sizes: np.ndarray) -> list[tuple[int, int]]:
    """Ranges of rows of about TEXT_BYTES that do not part a group."""
    out, low = [], 0
    while low < len(kinds):
        before = sizes[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(sizes, before + TEXT_BYTES, "right")))
        while high < len(kinds) and kinds[high] == kinds[high - 1]:
            high += 1
        out.append((low, high))
        low = high
    return out


def repeated(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, group: int = GROUP) -> DataFrame:
    """(doc_id, gone) of the documents that lose bytes: the ranges that go."""
    near = anchors.with_repeated(docs, arrays.texts, window, gram, group)
    light = near.mapInArrow(_light(window, gram), "key long, doc long, low long, count int, around binary")
    arranged = light.repartition("key").sortWithinPartitions("key")
    spans = arranged.mapInArrow(_group_spans(window), "doc long, low long, high long")
    some_heavy = near.where(F.exists("anchors", lambda a: a["heavy"]))
    strings = written(
        some_heavy.mapInArrow(
            _heavy(window, gram), "key long, doc long, low long, high long, known boolean"
        )
    )
    sent = strings.where("key is not null")
    # One place may be sent by several rows of one document.
    often = sent.groupBy("key").agg(
        (F.max("known") | (F.min(F.struct("doc", "low")) != F.max(F.struct("doc", "low")))).alias("often")
    )
    # Stored, so that the join is one of two tables, of which Spark splits a hot key's rows.
    often = written(often.where("often").select("key"))
    more = sent.where("not known").join(often, "key").select("doc", "low", "high")
    more = more.unionByName(strings.where("known").select("doc", "low", "high"))
    gone = spans.unionByName(more).groupBy(F.col("doc").alias("doc_id"))
    return written(gone.agg(F.collect_list(F.struct("low", "high")).alias("gone")))


def deduplicated(
    docs: DataFrame, window: int = WINDOW, gram: int = GRAM, group: int = GROUP, with_bytes: bool = True
) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, with ``with_bytes``, what stays.

    What stays may begin or end inside a character, so it is binary.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    own = docs.select("doc_id", "text")
    gone = repeated(own, window, gram, group)
    near, rest = parted(own, gone)
    near = near.join(gone, "doc_id", "left").select("doc_id", "text", "gone")
    empty = F.lit(None).cast("array<struct<low: bigint, high: bigint>>")
    shape = f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    shape += ", kept binary" if with_bytes else ""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            places = batch.column("gone")
            for k, text in enumerate(arrays.strings(batch.column("text"))):
                raw, spans = text.encode(), []
                if places[k].is_valid:
                    spans = _joined(places[k].values, len(raw))
                kept, at = [], 0
                for low, high in spans:
                    kept.append(raw[at:low])
                    at = high
                left = b"".join([*kept, raw[at:]])
                digest = hashlib.sha256(left).hexdigest()
                rows.append((len(raw), len(raw) - len(left), len(spans), digest, left))
            columns = list(zip(*rows, strict=True)) or [()] * 5
            types = [pa.int64()] * 3 + [pa.string(), pa.binary()]
            held = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
            held = [batch.column("doc_id"), *held][: 5 + with_bytes]
            yield pa.RecordBatch.from_arrays(held, names=names[: 5 + with_bytes])

    return near.unionByName(rest.withColumn("gone", empty)).mapInArrow(cut, shape)


def _joined(ranges: pa.StructArray, size: int) -> list[tuple[int, int]]:
    """Maximal runs of bytes that the ranges cover, within the text."""
    low = ranges.field("low").to_numpy(zero_copy_only=False)
    high = ranges.field("high").to_numpy(zero_copy_only=False)
    low, high = low[high <= size], high[high <= size]
    order = np.argsort(low, kind="stable")
    low, reach = low[order], np.maximum.accumulate(high[order]) if len(low) else high
    head = np.ones(len(low), bool)
    head[1:] = low[1:] > reach[:-1]
    last = np.append(head[1:], True) if len(low) else head
    return list(zip(low[head].tolist(), reach[last].tolist(), strict=True))
