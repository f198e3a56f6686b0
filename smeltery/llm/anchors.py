"""Where the same run of units (words or bytes) may occur twice.

Of every window of units the gram with the smallest hash is its anchor; equal windows have
equal anchors at equal places. So a window can only occur twice if the gram at its anchor
does, and only those windows go on. One long per anchor is moved, and each batch sends a
repeated gram once (``clusters``), so a gram that a third of all texts share stays cheap.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smeltery.llm import arrays, clusters
from smeltery.llm.shared import parted, small_batches, written


@dataclass
class Anchors:
    """Anchors of a block: gram, text, place in the block, and the windows that have it."""

    gram: np.ndarray
    doc: np.ndarray
    at: np.ndarray
    low: np.ndarray
    count: np.ndarray


def find(units: np.ndarray, first: np.ndarray, window: int, gram: int) -> Anchors:
    """Anchors of the windows of ``window`` units that lie in one text."""
    n = len(units)
    if n < window:
        none = np.empty(0, np.int64)
        return Anchors(np.empty(0, np.uint64), none, none, none, none)
    at = np.arange(n - gram + 1)
    grams = arrays.between(arrays.prefix(units), at, at + gram)
    place = arrays.minimizers(grams, window - gram + 1)
    size = np.diff(first)
    doc = np.repeat(np.arange(len(size)), size)[: len(place)]
    inside = np.arange(len(place)) + window <= first[1:][doc]
    start, place, doc = np.flatnonzero(inside), place[inside], doc[inside]
    new = np.ones(len(place), bool)
    new[1:] = place[1:] != place[:-1]
    head = np.flatnonzero(new)
    count = np.diff(np.append(head, len(place)))
    return Anchors(grams[place[head]], doc[head], place[head], start[head], count)


Units = Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]


def _sent(units: Units, window: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            held = []
            for low, high in arrays.blocks(batch.column("text")):
                values, first = units(batch.column("text").slice(low, high - low))
                found = find(values, first, window, gram)
                doc = ids[low:high][found.doc].astype(np.int64)
                held.append((doc, found.at - first[found.doc], found.gram.view(np.int64)[:, None]))
            if held:
                yield clusters.stars_of_batch(*map(np.concatenate, zip(*held, strict=True)))

    return run


def with_repeated(docs: DataFrame, units: Units, window: int, gram: int, group: int) -> DataFrame:
    """(doc_id, text, anchors) of the documents with grams that occur twice: a table.

    ``anchors`` lists the place of each such anchor and whether it is heavy: one that occurs
    more than ``group`` times, whose windows are not gathered into a group.
    """
    small_batches(docs.sparkSession)
    own = docs.where("doc_id is not null").select(F.col("doc_id").cast("long"), "text")
    members = clusters.buckets(own.mapInArrow(_sent(units, window, gram), clusters.STARRED))
    places = members.select("key", *clusters.NODE).unionByName(clusters.centres(members)).distinct()
    heavy = places.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > group)
    listed = (
        places.join(heavy, "key", "left")
        .groupBy(F.col("doc").alias("doc_id"))
        .agg(F.collect_list(F.struct("at", F.col("n").isNotNull().alias("heavy"))).alias("anchors"))
    )
    listed = written(listed)
    return written(parted(own, listed)[0].join(listed, "doc_id").select("doc_id", "text", "anchors"))


def chosen(
    batch: pa.RecordBatch, units: Units, window: int, gram: int, heavy: bool
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, Anchors]]:
    """Units, text offsets, ids and the listed light or heavy anchors, block by block."""
    ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
    listed = batch.column("anchors")
    for low, high in arrays.blocks(batch.column("text")):
        values, first = units(batch.column("text").slice(low, high - low))
        found = find(values, first, window, gram)
        part = listed.slice(low, high - low)
        flat = part.flatten()
        owner = np.repeat(np.arange(high - low), part.value_lengths().to_numpy(zero_copy_only=False))
        place = flat.field("at").to_numpy(zero_copy_only=False) + first[:-1][owner]
        wanted = place[flat.field("heavy").to_numpy(zero_copy_only=False) == heavy]
        use = np.isin(found.at, wanted)
        kept = (found.gram, found.doc, found.at, found.low, found.count)
        yield values, first, ids[low:high], Anchors(*(x[use] for x in kept))


def ranges(low: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All positions of the ranges, and the range of each."""
    owner = np.repeat(np.arange(len(low)), count)
    before = np.cumsum(count) - count
    return low[owner] + np.arange(len(owner)) - before[owner], owner
