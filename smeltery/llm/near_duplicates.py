"""Near-duplicate documents by MinHash over word shingles.

A document's set is its distinct shingles of four words, A to Z lower-cased; fewer words
are one shingle, and a document without words has an empty set. One-permutation hashing
with optimal densification gives 192 bins, banded by 6: two sets of similarity 0.8 share
one of the 32 bands with probability 0.99994. Candidates are stars (``clusters``), and a
link counts when 100 * intersection >= 80 * union holds on the full sets of the texts.

Rows that repeat an id are one document, linked through any of their texts. Documents with
a null id are linked with nothing and kept, with a null component. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smeltery.llm import arrays, clusters
from smeltery.llm.shared import released, small_batches

WORDS = 4
BINS = 192
BAND_ROWS = 6
PERCENT = 80


def shingles_of(column: pa.Array, size: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """The shingles of each text, repeated ones too, and the text of each."""
    w = arrays.words(*arrays.texts(column))
    hashes = arrays.hash_spans(arrays.LOWER[w.data], w.starts, w.ends)
    return arrays.shingles(hashes, w.first, size)


def _starred(size: int, bins: int, rows: int, slots: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, keys = [], []
            for low, high in arrays.blocks(batch.column("text")):
                values, doc = shingles_of(batch.column("text").slice(low, high - low), size)
                found = np.unique(doc)
                signatures = arrays.one_permutation(values, doc, high - low, bins)
                keys.append(arrays.band_keys(signatures[found], rows))
                ids = batch.column("doc_id").slice(low, high - low)
                docs.append(ids.to_numpy(zero_copy_only=False)[found].astype(np.int64))
            if docs:
                doc = np.concatenate(docs)
                yield clusters.packed_stars(doc, np.zeros_like(doc), np.concatenate(keys), slots)

    return run


COMPARED = "doc long, at long, to_doc long, to_at long, common long, union long"


def with_overlap(batch: pa.RecordBatch, sets) -> pa.RecordBatch:
    """The pairs of a batch with the sizes of intersection and union of their texts' sets,
    or 1 and 1 for equal texts. ``sets`` gives values and their texts for a column of texts.
    """
    text, other = batch.column("text"), batch.column("to_text")
    # Equal texts have equal sets, which are not empty: a node has shared a bucket.
    equal = pc.fill_null(pc.equal(text, other), False).to_numpy(zero_copy_only=False)
    common, union = equal.astype(np.int64), equal.astype(np.int64)
    rest = np.flatnonzero(~equal)
    text, other = text.take(pa.array(rest)), other.take(pa.array(rest))
    for low, high in arrays.blocks(text, clusters.SET_BYTES):
        for a, b in arrays.blocks(other.slice(low, high - low), clusters.SET_BYTES):
            n, at = b - a, rest[low + a : low + b]
            own, far = sets(text.slice(low + a, n)), sets(other.slice(low + a, n))
            common[at], union[at] = arrays.overlaps(own, far, n)
    columns = [batch.column(c) for c in clusters.PAIR] + [pa.array(common), pa.array(union)]
    return pa.RecordBatch.from_arrays(columns, names=[*clusters.PAIR, "common", "union"])


def grouped(
    docs: DataFrame, size: int = WORDS, bins: int = BINS, rows: int = BAND_ROWS, percent: int = PERCENT
) -> DataFrame:
    """(doc_id, component_id) of the documents that are linked with a smaller one."""
    small_batches(docs.sparkSession)
    own = docs.where("doc_id is not null").select(F.col("doc_id").cast("long"), "text")
    slots = clusters.slots_of(docs.sparkSession)
    pairs = clusters.star_pairs(own.mapInArrow(_starred(size, bins, rows, slots), clusters.PACKED))
    # What has been shuffled is gone before more is.
    released(docs.sparkSession)

    def overlaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield with_overlap(batch, lambda column: shingles_of(column, size))

    def compare(pairs: DataFrame, texts: DataFrame) -> DataFrame:
        far = texts.select(F.col("doc").alias("to_doc"), F.col("text").alias("to_text"))
        both = pairs.join(texts.drop("at"), "doc").join(far, "to_doc").select(*clusters.PAIR, "text", "to_text")
        return both.mapInArrow(overlaps, COMPARED)

    nodes = own.select(F.col("doc_id").alias("doc"), F.lit(0).cast("long").alias("at"), "text")
    copies = clusters.copies_of(nodes, clusters.nodes(pairs))
    released(docs.sparkSession)
    found = clusters.linked(pairs, compare, nodes, copies, lambda c: shingles_of(c, size), percent, bins, rows)
    found = clusters.with_copies(found, copies)
    return found.select(F.col("doc").alias("doc_id"), F.col("to_doc").alias("component_id"))


def sizes(docs: DataFrame, size: int = WORDS) -> DataFrame:
    """doc_id and n_shingles of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = [np.empty(0, np.int64)]
            for low, high in arrays.blocks(batch.column("text")):
                found = shingles_of(batch.column("text").slice(low, high - low), size)
                counts.append(arrays.set_sizes(*found, high - low))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.concatenate(counts))], ["doc_id", "n_shingles"]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_shingles long")


def marked(docs: DataFrame, **settings: int) -> DataFrame:
    """A row per row of ``docs``: doc_id, n_shingles, component_id and kept."""
    found = grouped(docs, **settings)
    own = sizes(docs, settings.get("size", WORDS)).join(found, "doc_id", "left")
    component = F.coalesce("component_id", "doc_id")
    return own.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )
