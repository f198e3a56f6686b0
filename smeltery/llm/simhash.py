"""Near-duplicate documents by SimHash, found by pigeonhole blocks.

A to Z are lower-cased, words cut at ASCII white space, and every run of three words, repeats
included, joined by spaces and hashed with XXH64 (seed 42); a shorter text with words is one
run. A bit of the fingerprint is 1 if it is set in over half of the hashes. Texts without words
and null texts have the fingerprint zero, and are linked like any other.

Fingerprints are linked at two or fewer differing bits. Equal ones are folded into a class
first, so copies cost a row. Of four blocks of 16 bits, linked fingerprints share two at least:
classes meet by each pair of blocks, 32 bits. A bucket that holds more than ``LIMIT`` classes
is parted further by the same rule, with the bits that are left cut into three blocks of which
one must be shared, until all are small; as classes differ, that ends. Inside a bucket every
pair's Hamming distance is taken, and tasks send a star for each component they see, so no more
rows than members. Nothing is lost or capped.

Rows that repeat an id are one document, linked through any of their texts. Documents with
a null id are linked with nothing and have a null component. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smeltery.llm import arrays, clusters
from smeltery.llm.shared import small_batches, written

WORDS = 3
SEED = 42
DISTANCE = 2
BLOCKS = 4
LIMIT = 1024
#: Rows whose buckets are compared at once.
ROWS = 1 << 16


def _joined(data: np.ndarray, w: arrays.Words) -> tuple[bytes, np.ndarray, np.ndarray]:
    """All words, lower-cased and joined by single spaces, with the span of each."""
    sizes = w.ends - w.starts
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    out = np.full(int(ends[-1]) + 1 if len(ends) else 0, 32, np.uint8)
    at = np.arange(int(sizes.sum()))
    word = np.repeat(np.arange(len(sizes)), sizes)
    before = np.cumsum(sizes) - sizes
    out[at + word] = arrays.LOWER[data[at - before[word] + w.starts[word]]]
    return out.tobytes(), starts, ends


def runs_of(column: pa.Array, words: int = WORDS) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """The words of a column as one text, and the span and text of each run of ``words``."""
    w = arrays.words(*arrays.texts(column))
    text, starts, ends = _joined(w.data, w)
    at = np.arange(len(starts))
    last = w.first[1:][w.doc]
    use = np.flatnonzero((at + words <= last) | ((at == w.first[:-1][w.doc]) & (last - at < words)))
    return text, starts[use], ends[np.minimum(use + words, last[use]) - 1], w.doc[use]


def bits_of(hashes: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """The fingerprint of each of ``n`` texts from the hashes of its runs, in order of text.

    Eight counters of a byte fit into a number: up to 255 hashes of a text are added at once.
    """
    total = np.bincount(doc, minlength=n)
    counts = np.zeros((n, 64), np.int64)
    if len(hashes):
        place = np.arange(len(hashes)) - (np.cumsum(total) - total)[doc]
        cut = np.flatnonzero(place % 255 == 0)
        lanes = np.uint64(0x0101010101010101)
        for k in range(8):
            sums = np.add.reduceat((hashes >> np.uint64(k)) & lanes, cut)
            parts = sums.view(np.uint8).reshape(-1, 8).astype(np.int64)
            owner = doc[cut]
            first = np.flatnonzero(np.diff(owner, prepend=-1))
            counts[owner[first], k::8] = np.add.reduceat(parts, first, axis=0)
    over = (2 * counts > total[:, None]).astype(np.uint64)
    return (over << np.arange(64, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)


def fingerprints(column: pa.Array, words: int = WORDS) -> np.ndarray:
    """The fingerprint of each text of a column, as unsigned numbers."""
    out = [np.empty(0, np.uint64)]
    digest = xxhash.xxh64_intdigest
    for low, high in arrays.blocks(column):
        text, starts, ends, doc = runs_of(column.slice(low, high - low), words)
        spans = zip(starts.tolist(), ends.tolist(), strict=True)
        hashes = np.fromiter((digest(text[a:b], SEED) for a, b in spans), np.uint64, len(starts))
        out.append(bits_of(hashes, doc, high - low))
    return np.concatenate(out)


def fingerprinted(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """doc_id and fingerprint, a long, of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = fingerprints(batch.column("text"), words).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found)], ["doc_id", "fingerprint"])

    small_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, fingerprint long")


def _masks(bits: list[int], blocks: int, shared: int) -> list[int]:
    """Masks of each choice of ``shared`` out of ``blocks`` blocks of some bits."""
    cut = [len(bits) * k // blocks for k in range(blocks + 1)]
    parts = [sum(1 << b for b in bits[a:b]) for a, b in zip(cut, cut[1:])]
    return [sum(chosen) for chosen in combinations(parts, shared)]


@cache
def _finer(mask: int, distance: int) -> list[int]:
    """Masks that part a bucket of ``mask``: it and one of the blocks of what is left."""
    rest = [b for b in range(64) if not mask >> b & 1]
    return [mask | more for more in _masks(rest, distance + 1, 1)]


BUCKETED = "mask long, bits long, fingerprint long, node long"


def _bucketed(distance: int, blocks: int):
    """Rows of each class in the buckets that it belongs to, at first or one step finer."""
    first = _masks(list(range(64)), blocks, blocks - distance)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fingerprint = batch.column("fingerprint").to_numpy().astype(np.int64)
            node = batch.column("node").to_numpy()
            mask = batch.column("mask").to_numpy()
            for now in np.unique(mask).tolist():
                own = mask == now
                finer = first if now == 0 else _finer(now & (1 << 64) - 1, distance)
                for more in finer:
                    wide = np.uint64(more).view(np.int64)
                    columns = [np.full(own.sum(), wide), fingerprint[own] & wide, fingerprint[own], node[own]]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c) for c in columns], ["mask", "bits", "fingerprint", "node"]
                    )

    return run


def _stars(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The smallest member of the component of each of ``n`` nodes under the links a - b."""
    label = np.arange(n)
    while len(a):
        least = np.minimum(label[a], label[b])
        after = label.copy()
        np.minimum.at(after, label[a], least)
        np.minimum.at(after, label[b], least)
        after = after[after]
        if (after == label).all():
            return label
        label = after
    return label


def _links(bucket: np.ndarray, fingerprint: np.ndarray, node: np.ndarray, distance: int) -> pa.RecordBatch:
    """Stars of the nodes that rows of one bucket link. Rows are in order of bucket."""
    nodes, own = np.unique(node, return_inverse=True)
    at, step, found = np.arange(len(bucket)), 1, []
    while len(at := at[at + step < len(bucket)]):
        at = at[bucket[at] == bucket[at + step]]
        near = at[np.bitwise_count(fingerprint[at] ^ fingerprint[at + step]) <= distance]
        if len(near):
            # Small numbers of nodes: of each link its ends, and none twice.
            found.append(np.unique(own[near] * len(nodes) + own[near + step]))
        if len(found) > 64:
            found = [np.unique(np.concatenate(found))]
        step += 1
    links = np.concatenate(found) if found else np.empty(0, np.int64)
    label = _stars(links // len(nodes), links % len(nodes), len(nodes)) if len(nodes) else own
    moved = np.flatnonzero(label != np.arange(len(nodes)))
    zero = pa.array(np.zeros(len(moved), np.int64))
    return pa.RecordBatch.from_arrays(
        [pa.array(nodes[moved]), zero, pa.array(nodes[label[moved]]), zero], names=clusters.PAIR
    )


def _met(distance: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in clusters.whole_groups(batches):
            columns = [held.column(c).to_numpy() for c in ("key", "mask", "bits", "fingerprint", "node")]
            order = np.lexsort(columns[2::-1])
            key, mask, bits, fingerprint, node = (c[order] for c in columns)
            bucket = np.cumsum(clusters._first_of_run(key, mask, bits))
            cut = np.searchsorted(bucket, bucket[np.arange(0, len(bucket), ROWS)])
            for low, high in zip(cut, [*cut[1:], len(bucket)]):
                links = _links(bucket[low:high], fingerprint[low:high].view(np.uint64), node[low:high], distance)
                if links.num_rows:
                    yield links

    return run


def links(classes: DataFrame, distance: int = DISTANCE, blocks: int = BLOCKS, limit: int = LIMIT) -> DataFrame:
    """Edges (doc, at, to_doc, to_at) that join the nodes of linked fingerprints.

    ``classes`` is a stored table (fingerprint, node) with each fingerprint once.
    """
    # A bucket of which no more bits are left than may differ cannot be parted.
    limit = max(limit, 2 << distance)
    key = F.xxhash64("mask", "bits").alias("key")
    found = []
    rows = classes.select("fingerprint", "node", F.lit(0).cast("long").alias("mask"))
    rows = rows.mapInArrow(_bucketed(distance, blocks), BUCKETED)
    while True:
        rows = written(rows)
        sizes = rows.groupBy("mask", "bits").agg(F.count("*").alias("n")).where("n > 1")
        sizes = written(sizes.select("mask", "bits", (F.col("n") > limit).alias("hot")))
        # Most buckets hold one class: what is alone meets nobody.
        both = rows.join(sizes, ["mask", "bits"])
        cool = both.where("not hot").select(key, "mask", "bits", "fingerprint", "node")
        cool = cool.repartition("key").sortWithinPartitions("key")
        found.append(written(cool.mapInArrow(_met(distance), "doc long, at long, to_doc long, to_at long")))
        if not sizes.where("hot").take(1):
            break
        # Two buckets may have a finer one in common: its rows count once.
        rows = both.where("hot").select("fingerprint", "node", "mask")
        rows = rows.mapInArrow(_bucketed(distance, blocks), BUCKETED).distinct()
    edges = found[0]
    for more in found[1:]:
        edges = edges.unionByName(more)
    return edges


def marked(docs: DataFrame, words: int = WORDS, distance: int = DISTANCE, blocks: int = BLOCKS, limit: int = LIMIT) -> DataFrame:
    """A row per row of ``docs``: doc_id, fingerprint (16 hex digits) and component_id."""
    if not 0 < distance < blocks <= 64:
        raise ValueError("there must be more blocks than bits that may differ")
    own = written(fingerprinted(docs, words))
    known = own.where("doc_id is not null").withColumn("doc_id", F.col("doc_id").cast("long"))
    classes = written(known.groupBy("fingerprint").agg(F.min("doc_id").alias("node")))
    several = known.groupBy("doc_id").agg(F.min("fingerprint").alias("a"), F.max("fingerprint").alias("b"))
    several = known.join(several.where("a != b").select("doc_id"), "doc_id").join(classes, "fingerprint")
    zero = F.lit(0).cast("long")
    same = several.select(
        F.col("doc_id").alias("doc"), zero.alias("at"), F.col("node").alias("to_doc"), zero.alias("to_at")
    )
    edges = links(classes, distance, blocks, limit).unionByName(same.where("doc != to_doc").distinct())
    reached = clusters.components(edges).select(F.col("doc").alias("node"), F.col("to_doc").alias("to"))
    component = F.coalesce("to", "node").alias("component")
    reached = written(classes.join(reached, "node", "left").select("fingerprint", component))
    kind = docs.schema["doc_id"].dataType
    return own.join(reached, "fingerprint", "left").select(
        "doc_id",
        F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        F.when(F.col("doc_id").isNotNull(), F.col("component").cast(kind)).alias("component_id"),
    )
