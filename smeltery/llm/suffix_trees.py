"""Substring dedup over words by groups of suffixes that share an anchor.

A window of 20 words goes if its words also stand earlier: in a document of a smaller id or
earlier in its own. Only suffixes that start at a window whose anchor gram occurs twice can
repeat (``anchors``); the others are left out without loss.

This is not a forest of suffix trees parted by prefixes of variable length, and it tells no
maximal repeats: suffixes are parted by the 5-word gram of their anchor, which may lie
anywhere in the window, or, where that has more suffixes than a group may hold, by a code of
all 20 words. A group of a gram is bounded; a task sorts the first 20 words of its suffixes
and compares neighbours, and of equal ones the first in document order stays. Of the equal
ones of a code the first is an aggregate that is taken before rows move, however many there
are. See the README for why.

Words are compared by 32-bit codes, 20 at a time, in groups of equal 64-bit grams; the
longest prefixes by 64-bit codes. Documents with a null id lose and cause nothing; rows that
repeat an id and text are one document, and where texts differ under one id, windows at one
place are one. Null and empty texts have no words.
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

WINDOW = 20
GRAM = 5
GROUP = 16_384
BITS = 62


def word_codes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    w = arrays.words(*arrays.texts(column))
    return arrays.hash_spans(w.data, w.starts, w.ends), w.first


def _light(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per light anchor its windows' words: (key, doc, low, count, codes)."""
    for batch in batches:
        for values, first, ids, found in anchors.chosen(batch, word_codes, WINDOW, GRAM, False):
            if not len(found.at):
                continue
            size = found.count + WINDOW - 1
            codes = (values >> np.uint64(32)).astype(np.uint32)[anchors.ranges(found.low, size)[0]]
            offsets = np.concatenate([[0], np.cumsum(4 * size)]).astype(np.int32)
            binary = pa.Array.from_buffers(
                pa.binary(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(codes)]
            )
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(found.gram.view(np.int64)),
                    pa.array(ids[found.doc].astype(np.int64)),
                    pa.array(found.low - first[found.doc]),
                    pa.array(found.count.astype(np.int32)),
                    binary,
                ],
                names=["key", "doc", "low", "count", "codes"],
            )


def _heavy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per window of a heavy anchor a code of all its words: (key, doc, low, mask).

    Only the first window of a code in each batch goes on under its key; the others stand
    later than it, so they need not meet any other and go as masks without a key.
    """
    for batch in batches:
        held: list[tuple] = []
        for values, first, ids, found in anchors.chosen(batch, word_codes, WINDOW, GRAM, True):
            start, owner = anchors.ranges(found.low, found.count)
            key = arrays.between(arrays.prefix(values), start, start + WINDOW)
            doc = found.doc[owner]
            held.append((key.view(np.int64), ids[doc].astype(np.int64), start - first[doc]))
        if held:
            key, doc, low = (np.concatenate(x) for x in zip(*held, strict=True))
            order = np.lexsort((low, doc, key))
            key, doc, low = key[order], doc[order], low[order]
            new = np.ones(len(key), bool)
            new[1:] = (key[1:] != key[:-1]) | (doc[1:] != doc[:-1]) | (low[1:] != low[:-1])
            key, doc, low = key[new], doc[new], low[new]
            later = np.zeros(len(key), bool)
            later[1:] = key[1:] == key[:-1]
            ones = np.ones(int((~later).sum()), np.int64)
            yield _rows(key[~later], doc[~later], low[~later], ones)
            doc, low = doc[later], low[later]
            order = np.lexsort((low, doc))
            doc, run, bit = doc[order], low[order] // BITS, low[order] % BITS
            head = np.ones(len(doc), bool)
            head[1:] = (doc[1:] != doc[:-1]) | (run[1:] != run[:-1])
            if len(doc):
                mask = np.bitwise_or.reduceat(np.int64(1) << bit, np.flatnonzero(head))
                yield _rows(None, doc[head], run[head] * BITS, mask)


def _rows(key, doc, low, mask) -> pa.RecordBatch:
    keys = pa.nulls(len(doc), pa.int64()) if key is None else pa.array(key)
    columns = [keys, pa.array(doc), pa.array(low), pa.array(mask)]
    return pa.RecordBatch.from_arrays(columns, names=["key", "doc", "low", "mask"])


def subtree(key, doc, low, count, codes) -> np.ndarray:
    """For complete groups: which windows of each member stand earlier, as a bit mask."""
    size = count + WINDOW - 1
    base = np.cumsum(size) - size
    at, owner = anchors.ranges(base, count)
    offset = at - base[owner]
    suffixes = np.ascontiguousarray(codes[at[:, None] + np.arange(WINDOW)])
    columns = suffixes.view(np.uint64)
    order = np.lexsort((low[owner] + offset, doc[owner], *columns.T[::-1], key[owner]))
    ordered, group = suffixes[order], key[owner][order]
    # The common prefix of neighbours is the depth of the node that they hang from.
    differs = ordered[1:] != ordered[:-1]
    depth = np.where(differs.any(axis=1), differs.argmax(axis=1), WINDOW)
    deep = (depth >= WINDOW) & (group[1:] == group[:-1])
    # Suffixes of one node at the same place are one window of a repeated row.
    place_doc, place = doc[owner][order], (low[owner] + offset)[order]
    head = np.concatenate([[True], ~deep])
    leader = np.flatnonzero(head)[np.cumsum(head) - 1]
    earlier = (place_doc != place_doc[leader]) | (place != place[leader])
    mask = np.zeros(len(key), np.int64)
    np.bitwise_or.at(mask, owner[order][earlier], np.int64(1) << offset[order][earlier])
    return mask


def _trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc, low, mask) from rows in order of key."""
    for held in clusters.whole_groups(batches):
        yield from _grown(held)


def _grown(held: pa.Table) -> Iterator[pa.RecordBatch]:
    key, doc, low, count = (held.column(c).to_numpy() for c in ("key", "doc", "low", "count"))
    chunk = held.column("codes").chunk(0)
    codes = np.frombuffer(arrays.raw(chunk), np.uint32)
    mask = subtree(key, doc, low, count.astype(np.int64), codes)
    use = mask != 0
    if use.any():
        yield pa.RecordBatch.from_pydict({"doc": doc[use], "low": low[use], "mask": mask[use]})


def repeated(docs: DataFrame, group: int = GROUP) -> DataFrame:
    """(doc_id, gone) of the documents that lose windows: first start and mask of each run."""
    near = anchors.with_repeated(docs, word_codes, WINDOW, GRAM, group)
    light = near.mapInArrow(_light, "key long, doc long, low long, count int, codes binary")
    arranged = light.repartition("key").sortWithinPartitions("key")
    trees = arranged.mapInArrow(_trees, "doc long, low long, mask long")
    some_heavy = near.where(F.exists("anchors", lambda a: a["heavy"]))
    shape = "key long, doc long, low long, mask long"
    windows = written(some_heavy.mapInArrow(_heavy, shape))
    known = windows.where("key is not null")
    place = F.struct("doc", "low")
    first = known.groupBy("key").agg(F.min(place).alias("first"), F.max(place).alias("last"))
    # Stored, so that the join is one of two tables, of which Spark splits a hot key's rows.
    first = written(first.where("first != last").drop("last"))
    later = known.join(first, "key").where(F.struct("doc", "low") != F.col("first")).drop("first")
    later = later.unionByName(windows.where("key is null")).drop("key")
    gone = trees.unionByName(later).groupBy(F.col("doc").alias("doc_id"))
    return written(gone.agg(F.collect_list(F.struct("low", "mask")).alias("gone")))


def deduplicated(docs: DataFrame, with_text: bool = True, group: int = GROUP) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and, with ``with_text``, the kept words."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    own = docs.select("doc_id", "text")
    gone = repeated(own, group)
    near, rest = parted(own, gone)
    near = near.join(gone, "doc_id", "left").select("doc_id", "text", "gone")
    empty = F.lit(None).cast("array<struct<low: bigint, mask: bigint>>")
    shape = f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string"
    shape += ", text string" if with_text else ""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, n_removed, digests, kept = [], [], [], []
            places = batch.column("gone").to_pylist()
            for text, gone in zip(arrays.strings(batch.column("text")), places, strict=True):
                words = text.encode().split()
                n_words.append(len(words))
                if gone:
                    words = _left(words, gone)
                n_removed.append(n_words[-1] - len(words))
                raw = b" ".join(words)
                digests.append(hashlib.sha256(raw).hexdigest())
                if with_text:
                    kept.append(raw.decode())
            columns = [batch.column("doc_id"), pa.array(n_words), pa.array(n_removed)]
            columns += [pa.array(digests)] + ([pa.array(kept, pa.string())] if with_text else [])
            names = ["doc_id", "n_words", "n_removed", "kept_sha256", "text"]
            yield pa.RecordBatch.from_arrays(columns, names=names[: len(columns)])

    return near.unionByName(rest.withColumn("gone", empty)).mapInArrow(cut, shape)


def _left(words: list[bytes], gone: list[dict]) -> list[bytes]:
    step = np.zeros(len(words) + 1, np.int64)
    for run in gone:
        mask, start = run["mask"], run["low"]
        while mask:
            if mask & 1 and start + WINDOW <= len(words):
                step[start] += 1
                step[start + WINDOW] -= 1
            mask, start = mask >> 1, start + 1
    return [w for w, covered in zip(words, np.cumsum(step), strict=False) if not covered]
