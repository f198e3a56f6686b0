"""Fuzzy dedup of lines by MinHash over character shingles.

Lines are what lies between line feeds. For comparison A to Z are lower-cased and white
space around a line is left out; a line's set is its distinct runs of 8 characters, and a
shorter line is one run. Lines without a word are never compared nor removed. 56 bins,
banded by 4: lines of similarity 0.8 share one of the 14 bands with probability 0.9994.
Candidates are stars (``clusters``), links are confirmed on the full sets of the lines, and
of each component the line that comes first, by doc_id and place, stays.

Rows that repeat an id and text are one document; where their texts differ, lines at one
place count as one. Documents with a null id keep all lines and remove none elsewhere; a
null text has no lines and stays null.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smeltery.llm import arrays, clusters
from smeltery.llm.near_duplicates import COMPARED, with_overlap
from smeltery.llm.shared import and_fields, parted, released, small_batches, written

CHARS = 8
BINS = 56
BAND_ROWS = 4
PERCENT = 80
#: Texts whose hashes are held at once: they stay in a core's cache.
CUT_BYTES = 1 << 18
#: The lines with the most copies; these are taken out of a text without moving it.
COMMON = 1 << 15


def _bounds(
    data: np.ndarray, offsets: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Spans of all lines, with the text and place of each."""
    breaks = np.flatnonzero(data == 10)
    before = np.searchsorted(breaks, offsets)
    count = np.diff(before) + 1
    doc = np.repeat(np.arange(len(count)), count)
    first = np.cumsum(count) - count
    line = np.arange(len(doc)) - first[doc]
    starts, ends = np.empty((2, len(doc)), np.int64)
    later = line > 0
    starts[first], ends[first + count - 1] = offsets[:-1], offsets[1:]
    starts[later] = breaks + 1
    ends[:-1][later[1:]] = breaks
    return starts, ends, doc, line


#: Bytes of white space that are looked at one by one at either end of a line.
STEPS = 8


def _trimmed(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """The spans of lines without white space around them; one without a word ends at its start."""
    starts, ends = starts.copy(), ends.copy()
    for at, step in ((starts, 1), (ends, -1)):
        rest = np.flatnonzero(starts < ends)
        for _ in range(STEPS):
            rest = rest[arrays.SPACE[data[at[rest] - (step < 0)]]]
            at[rest] += step
            rest = rest[starts[rest] < ends[rest]]
        if len(rest):
            solid = np.flatnonzero(~arrays.SPACE[data])
            if step > 0:
                far = np.append(solid, len(data))[np.searchsorted(solid, at[rest])]
                at[rest] = np.minimum(far, ends[rest])
            else:
                far = np.append(-1, solid)[np.searchsorted(solid, at[rest])] + 1
                at[rest] = np.maximum(far, starts[rest])
    return starts, ends


def lines_of(
    data: np.ndarray, offsets: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Trimmed spans of the lines with a word, with the text and place of each."""
    starts, ends, doc, line = _bounds(data, offsets)
    starts, ends = _trimmed(data, starts, ends)
    word = starts < ends
    return starts[word], ends[word], doc[word], line[word]


def shingles_of(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray, size: int = CHARS
) -> tuple[np.ndarray, np.ndarray]:
    """Hash and line of each run of ``size`` characters; a shorter line is one run.

    Lines are spans with a word, in order. Those of ASCII alone that are no shorter come first:
    there a character is a byte.
    """
    if not len(starts):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    sums = arrays.prefix(arrays.LOWER[data])
    wide = np.logical_or.reduceat(data > 127, starts)
    long = ends - starts >= size
    plain, rest = np.flatnonzero(long & ~wide), np.flatnonzero(~long | wide)
    runs = ends[plain] - starts[plain] - (size - 1)
    line = np.repeat(plain, runs)
    at = np.arange(len(line)) + np.repeat(starts[plain] - (np.cumsum(runs) - runs), runs)
    values = arrays.between_all(sums, size, at) if len(at) else np.empty(0, np.uint64)
    if len(rest):
        first, last, own = _wide_runs(data, starts[rest], ends[rest], size)
        values = np.concatenate([values, arrays.between(sums, first, last)])
        line = np.concatenate([line, rest[own]])
    return values, line


def _wide_runs(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray, size: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans of ``size`` characters of UTF-8, or of whole shorter lines, and the line of each."""
    inside = np.zeros(len(data) + 1, np.int8)
    inside[starts] += 1
    inside[ends] -= 1
    at = np.flatnonzero(((data & 0xC0) != 0x80) & (np.cumsum(inside[:-1], dtype=np.int8) > 0))
    # Characters come line by line; the last of a line begin no run of their own.
    first = np.searchsorted(at, starts)
    count = np.diff(np.append(first, len(at)))
    opens = np.ones(len(at), bool)
    for k in range(1, size):
        opens[(first + count - k)[count > k]] = False
    end = np.empty(len(at), np.int64)
    end[: max(0, len(at) - size)] = at[size:]
    filled = count > 0
    end[(first + np.maximum(count - size, 0))[filled]] = ends[filled]
    runs = np.maximum(count - size, -1) + 1
    runs[filled & (runs == 0)] = 1
    return at[opens], end[opens], np.repeat(np.arange(len(starts)), runs)


def _starred(size: int, bins: int, rows: int, slots: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: list[tuple] = []
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            for low, high in arrays.blocks(batch.column("text"), 4 << 20):
                data, offsets = arrays.texts(batch.column("text").slice(low, high - low))
                for a, b in _cut(offsets):
                    part = data[offsets[a] : offsets[b]]
                    starts, ends, doc, line = lines_of(part, offsets[a : b + 1] - offsets[a])
                    if len(starts):
                        values, owner = shingles_of(part, starts, ends, size)
                        signatures = arrays.one_permutation(values, owner, len(starts), bins)
                        keys = arrays.band_keys(signatures, rows)
                        held.append((ids[low + a + doc].astype(np.int64), line, keys))
                if held:
                    yield clusters.packed_stars(*map(np.concatenate, zip(*held, strict=True)), slots)
                    held = []

    return run


def _cut(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    low = 0
    while low < len(offsets) - 1:
        top = offsets[low] + CUT_BYTES
        high = max(low + 1, int(np.searchsorted(offsets, top, "right")) - 1)
        yield low, high
        low = high


def _picked(marked: Broadcast):
    """The lines that are ``marked``, trimmed; those without a word are empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            for low, high in arrays.blocks(batch.column("text")):
                data, offsets = arrays.texts(batch.column("text").slice(low, high - low))
                starts, ends, doc, line = _bounds(data, offsets)
                doc = ids[low + doc].astype(np.int64)
                use = np.flatnonzero(clusters.is_marked(marked, doc, line))
                starts, ends = _trimmed(data, starts[use], ends[use])
                held = data.tobytes()
                text = [held[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                columns = [pa.array(doc[use]), pa.array(line[use]), pa.array(text, pa.binary()).cast(pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc", "at", "text"])

    return run


def _sets(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The runs of characters of a column of single lines, and the line of each."""
    data, offsets = arrays.texts(column)
    starts, ends, doc, _ = lines_of(data, offsets)
    values, line = shingles_of(data, starts, ends, size)
    return values, doc[line]


def _overlaps(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield with_overlap(batch, lambda column: _sets(column, size))

    return run


def _repeats(docs: DataFrame, size: int, bins: int, rows: int, percent: int) -> tuple[DataFrame, ...]:
    """What ``clusters.linked`` finds among the lines, the copies of its nodes, and ``_common``."""
    small_batches(docs.sparkSession)
    own = docs.where("doc_id is not null").select(F.col("doc_id").cast("long"), "text")
    slots = clusters.slots_of(docs.sparkSession)
    pairs = clusters.star_pairs(own.mapInArrow(_starred(size, bins, rows, slots), clusters.PACKED))
    # What has been shuffled is gone before more is.
    released(docs.sparkSession)
    # Lines are picked where their texts lie: no whole text moves.
    marked = clusters.marked_nodes(pairs)
    texts = written(own.mapInArrow(_picked(marked), "doc long, at long, text string"))
    marked.destroy()
    released(docs.sparkSession)

    def compare(pairs: DataFrame, texts: DataFrame) -> DataFrame:
        far = texts.select(
            F.col("doc").alias("to_doc"), F.col("at").alias("to_at"), F.col("text").alias("to_text")
        )
        both = pairs.join(texts, clusters.NODE).join(far, ["to_doc", "to_at"])
        return both.select(*clusters.PAIR, "text", "to_text").mapInArrow(_overlaps(size), COMPARED)

    copies = clusters.copies_of(texts)
    common = _common(copies, texts)
    released(docs.sparkSession)
    found = clusters.linked(
        pairs, compare, texts, copies, lambda c: _sets(c, size), percent, bins, rows, True
    )
    return found, copies, common


def repeated(
    docs: DataFrame, size: int = CHARS, bins: int = BINS, rows: int = BAND_ROWS, percent: int = PERCENT
) -> DataFrame:
    """(doc_id, at, first_doc, first_at) of each line that goes and the line that stays."""
    found, copies, _ = _repeats(docs, size, bins, rows, percent)
    return clusters.with_copies(found, copies).toDF("doc_id", "at", "first_doc", "first_at")


#: What tells texts of different lengths apart.
_LENGTHS = arrays.mixed(np.arange(1, 66, dtype=np.uint64))


def _looks(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A code of each span, equal for equal ones, from its length up to 64, its ends and its
    quarters; others with the same code are told apart by their digests."""
    length = ends - starts
    held = np.append(data, np.zeros(8, np.uint8))
    held = np.ndarray(len(data) + 1, "<u8", held, strides=(1,))
    code = held[starts]
    short = np.flatnonzero(length < 8)
    code[short] &= np.uint64((1 << 64) - 1) >> (8 * (8 - length[short])).astype(np.uint64)
    code = arrays.mixed(code ^ _LENGTHS[np.minimum(length, 64)])
    rest = np.flatnonzero(length > 8)
    a, room = starts[rest], length[rest] - 8
    for k in (1, 2, 3, 4):
        code[rest] = arrays.mixed(code[rest] + held[a + k * room // 4])
    return code.view(np.int64)


def _common(copies: DataFrame, texts: DataFrame) -> DataFrame:
    """(doc, at, code, digest) of the nodes with the most copies, with a code and a digest of
    their texts. There are ``COMMON`` at most, so they can go to every task, which takes such
    lines out of a text where that lies."""
    to = ["to_doc", "to_at"]
    most = copies.groupBy(*to).count().orderBy(F.desc("count"), *to).limit(COMMON).select(*to)

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = arrays.texts(batch.column("text"))
            codes = _looks(data, offsets[:-1], offsets[1:])
            held = [_digest(text.encode()) for text in arrays.strings(batch.column("text"))]
            columns = [batch.column("doc"), batch.column("at"), pa.array(codes), pa.array(held, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc", "at", "code", "digest"])

    own = texts.join(F.broadcast(most.toDF(*clusters.NODE)), clusters.NODE)
    return written(own.mapInArrow(digests, "doc long, at long, code long, digest binary").hint("coalesce", 1))


def _stays(found: DataFrame, common: DataFrame) -> dict[bytes, tuple[int, int, int]]:
    """By digest, the code of a ``common`` text and which of the nodes that have it, or are
    like it, stays."""
    root = found.join(F.broadcast(common.select(*clusters.NODE).distinct()), clusters.NODE)
    to = {(r.doc, r.at): (r.to_doc, r.to_at) for r in root.collect()}
    return {
        bytes(r.digest): (r.code, *to.get((r.doc, r.at), (r.doc, r.at))) for r in common.collect()
    }


def _digest(text: bytes) -> bytes:
    return hashlib.blake2b(text, digest_size=16).digest()


def _taken(known: dict):
    """Lines of a column of texts with a ``known`` text, but for that which stays, as places
    by text. ``ids`` are those of the texts; a text without one keeps its lines."""
    codes = np.sort(np.array([code for code, _, _ in known.values()], np.int64))

    def places(column: pa.Array, ids: list[int | None]) -> dict[int, set[int]]:
        out: dict[int, set[int]] = {}
        for low, high in arrays.blocks(column, CUT_BYTES) if len(codes) else ():
            data, offsets = arrays.texts(column.slice(low, high - low))
            starts, ends, doc, line = lines_of(data, offsets)
            code = _looks(data, starts, ends)
            near = codes[np.minimum(np.searchsorted(codes, code), len(codes) - 1)] == code
            held = memoryview(data)
            for k in np.flatnonzero(near).tolist():
                text, at = low + int(doc[k]), int(line[k])
                stays = known.get(_digest(held[starts[k] : ends[k]]))
                if ids[text] is not None and stays and stays[1:] != (ids[text], at):
                    out.setdefault(text, set()).add(at)
        return out

    return places


def deduplicated(
    docs: DataFrame, size: int = CHARS, bins: int = BINS, rows: int = BAND_ROWS, percent: int = PERCENT
) -> DataFrame:
    """``docs`` with its text without the lines that go, n_lines and n_removed.

    Lines that stay keep their order and are joined by line feeds.
    """
    found, copies, common = _repeats(docs, size, bins, rows, percent)
    known = _stays(found, common)
    most = common.select(F.col("doc").alias("to_doc"), F.col("at").alias("to_at"))
    copies = copies.join(F.broadcast(most), most.columns, "left_anti")
    gone = clusters.with_copies(found, copies).select(F.col("doc").alias("doc_id"), "at")
    gone = written(gone.groupBy("doc_id").agg(F.collect_list("at").alias("gone")))
    released(docs.sparkSession)
    taken = _taken(known)
    others = [c for c in docs.columns if c not in ("text", "n_lines", "n_removed")]
    # The other columns travel as one, so that their names meet no others.
    held = F.struct(*(F.col(f"`{c}`") for c in others)).alias("row")
    kept = docs.select("doc_id", "text", held, F.col("doc_id").cast("long").alias("own"))
    shape = and_fields([kept.schema["row"]], "text string, n_lines long, n_removed long")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text, gone = batch.column("text"), batch.column("gone")
            n_lines = pc.add(pc.count_substring(text, "\n").cast(pa.int64()), 1)
            n_removed = np.zeros(batch.num_rows, np.int64)
            common = taken(text, batch.column("own").to_pylist())
            some = {*np.flatnonzero(gone.is_valid().to_numpy(zero_copy_only=False)).tolist(), *common}
            rows, left = [], []
            for row in sorted(some):
                places = {*(gone[row].as_py() or ()), *common.get(row, ())}
                if not text[row].is_valid or not places:
                    continue
                parts = text[row].as_py().split("\n")
                stay = [x for k, x in enumerate(parts) if k not in places]
                rows.append(row)
                left.append("\n".join(stay))
                n_removed[row] = len(parts) - len(stay)
            cuts = np.zeros(batch.num_rows, bool)
            cuts[rows] = True
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"),
                    pc.replace_with_mask(text, pa.array(cuts), pa.array(left, text.type)),
                    pc.fill_null(n_lines, 0),
                    pa.array(n_removed),
                ],
                names=["row", "text", "n_lines", "n_removed"],
            )

    near, rest = parted(kept, gone)
    near = near.join(gone, "doc_id", "left").select("row", "text", "own", "gone")
    rest = rest.select("row", "text", "own", F.lit(None).cast("array<bigint>").alias("gone"))
    done = near.unionByName(rest).mapInArrow(cut, shape)
    return done.select("row.*", "text", "n_lines", "n_removed")
