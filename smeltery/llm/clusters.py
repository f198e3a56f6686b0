"""Groups of similar things from band keys: buckets, star-shaped candidates, components.

A node is two longs, ``doc`` and ``at``. Things that share a band key are in one bucket.
Candidates of a bucket are a star around its smallest node, so there are no more than
members. Before keys move, each batch of a task makes stars of its own and sends one row
per key, so that a key that a third of all rows share costs a row per batch.

A star may miss a link between two leaves of which neither is similar to the centre.
``linked`` therefore goes on: in each bucket of more than one component, the nodes outside of
its largest meet all others of it, in blocks inside tasks, by sketches of 256 bins. Pairs whose estimate is no
more than 0.1 (four standard deviations) below a link are compared on their full sets, until
their components are joined. So every two nodes of a bucket are compared, lie in one
component or are told apart by their sketches.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from smeltery.llm import arrays
from smeltery.llm.shared import forget, parted, released, written

NODE = ["doc", "at"]
PAIR = ["doc", "at", "to_doc", "to_at"]
#: Bytes of a sketch, how far its estimate may lie below a link, and a block's size.
SKETCH = 256
MARGIN = 0.1
#: Bins that are looked at first; a link is not seen there with a probability of 1e-5.
QUICK = 128
DEVIATIONS = 4.5
BLOCK = 1024
BLOCK_BYTES = 8 << 20
#: Texts whose sets are made at once.
SET_BYTES = 1 << 18
#: Pairs that are met at once, and those whose sketches are looked at together.
MET = 1 << 16
LOOKED = 1 << 12
#: Bits of the outline of a set, and texts whose outlines are made at once.
OUTLINE = 1 << 14
OUTLINED = 64


Sets = Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]


def _first_of_run(*columns: np.ndarray) -> np.ndarray:
    new = np.ones(len(columns[0]), bool)
    new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return new


def stars_of_batch(doc: np.ndarray, at: np.ndarray, keys: np.ndarray) -> pa.RecordBatch:
    """Rows (route, key, doc, at, to_doc, to_at) of the nodes of a batch and their keys.

    The smallest node of each key is sent on under that key, without a centre. The others
    have it as their centre and need no meeting: their route spreads them.
    """
    n, bands = keys.shape
    key = keys.ravel()
    doc, at = np.repeat(doc, bands), np.repeat(at, bands)
    order = np.lexsort((at, doc, key))
    key, doc, at = key[order], doc[order], at[order]
    keep = _first_of_run(key, doc, at)
    key, doc, at = key[keep], doc[keep], at[keep]
    first = _first_of_run(key)
    centre = np.flatnonzero(first)[np.cumsum(first) - 1]
    route = np.where(first, key, arrays.mixed((doc + at).astype(np.uint64)).view(np.int64))
    return pa.RecordBatch.from_arrays(
        [
            pa.array(route),
            pa.array(key, mask=first),
            pa.array(doc),
            pa.array(at),
            pa.array(doc[centre], mask=first),
            pa.array(at[centre], mask=first),
        ],
        names=["route", "key", *PAIR],
    )


STARRED = "route long, key long, doc long, at long, to_doc long, to_at long"


def whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows in order of ``key``, cut between keys; the last key waits for its end."""
    left: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        held = pa.Table.from_batches([batch])
        held = held if left is None else pa.concat_tables([left, held])
        key = held.column("key").to_numpy()
        other = np.flatnonzero(key != key[-1])
        cut = int(other[-1]) + 1 if len(other) else 0
        left = held.slice(cut)
        if cut:
            yield held.slice(0, cut).combine_chunks()
    if left is not None:
        yield left.combine_chunks()


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stars of buckets from rows in order of route; a bucket may run over many batches."""
    before: dict | None = None  # the last bucket's key and centre, and if that was sent
    for batch in batches:
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(4)]
        inner = batch.column(1).is_valid().to_numpy(zero_copy_only=False)
        sent = [batch.filter(pa.array(inner)).select(["key", *PAIR])]
        route, doc, at = (columns[k][~inner] for k in (0, 2, 3))
        if len(route):
            if before is not None:
                route = np.append(before["key"], route)
                doc, at = np.append(before["doc"], doc), np.append(before["at"], at)
            first = _first_of_run(route)
            start = np.flatnonzero(first)
            group = np.cumsum(first) - 1
            size = np.diff(np.append(start, len(route)))
            use = size[group] > 1
            carried = before is not None and before["sent"]
            if carried:
                use[0] = False
            centre = start[group[use]]
            held = [route[use], doc[use], at[use], doc[centre], at[centre]]
            sent.append(pa.RecordBatch.from_arrays([pa.array(x) for x in held], ["key", *PAIR]))
            last = start[-1]
            was_sent = size[-1] > 1 or (carried and last == 0)
            before = {"key": route[last], "doc": doc[last], "at": at[last], "sent": was_sent}
        for part in sent:
            if part.num_rows:
                yield part


def buckets(starred: DataFrame) -> DataFrame:
    """Members (key, doc, at) of the buckets of at least two nodes, with a centre of each.

    The centre of a bucket has itself as its centre; that of a batch may have no row.
    """
    arranged = starred.repartition("route").sortWithinPartitions("route", *NODE)
    return written(arranged.mapInArrow(_stars, "key long, doc long, at long, to_doc long, to_at long"))


def _settled(links: DataFrame) -> bool:
    """Whether every node points to one that points nowhere."""
    ends = links.select(
        F.explode(
            F.array(
                F.struct(F.col("a").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("into")),
                F.struct(F.col("b").alias("node"), F.lit(0).alias("out"), F.lit(1).alias("into")),
            )
        ).alias("x")
    )
    ends = ends.groupBy("x.node").agg(F.sum("x.out").alias("out"), F.max("x.into").alias("into"))
    return not ends.where("out > 1 or (out = 1 and into = 1)").take(1)


def components(edges: DataFrame) -> DataFrame:
    """The smallest node that each linked node reaches, as (doc, at, to_doc, to_at).

    Large and small stars in turn, each round a table in the shared folder; the smallest
    node of a component has no row. What is smallest is found by an aggregate, one row per
    task and node, and stored: the joins with it are plain joins of two tables, of which Spark
    splits a hot node's rows over tasks.
    """
    node, to = F.struct(*NODE), F.struct(F.col("to_doc").alias("doc"), F.col("to_at").alias("at"))
    links = edges.select(F.greatest(node, to).alias("a"), F.least(node, to).alias("b"))
    current = written(links.where("a != b").distinct())
    while not _settled(current):
        # The large star: what is above b goes to the smallest below it, a row for each row.
        below = written(current.groupBy("a").agg(F.min("b").alias("m")))
        large = current.join(below.withColumnRenamed("a", "b"), "b", "left")
        large = written(large.select("a", F.coalesce("m", "b").alias("b")))
        # The small star: a and what is below it go to the smallest of those.
        least = written(large.groupBy("a").agg(F.min("b").alias("m")))
        small = large.join(least, "a").select(
            F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("x")
        )
        after = written(small.select("x.*").where("a != b").distinct())
        for table in (current, below, large, least):
            forget(table)
        current = after
        released(current.sparkSession)
    return current.select("a.doc", "a.at", F.col("b.doc").alias("to_doc"), F.col("b.at").alias("to_at"))


def centres(members: DataFrame) -> DataFrame:
    return members.select("key", F.col("to_doc").alias("doc"), F.col("to_at").alias("at"))


def nodes(pairs: DataFrame) -> DataFrame:
    """The distinct nodes of ``star_pairs``."""
    to = pairs.select(F.col("to_doc").alias("doc"), F.col("to_at").alias("at"))
    return pairs.select(*NODE).unionByName(to).distinct()


#: Bits in which the nodes of pairs are marked, and those of one row of them.
MARKS = 1 << 27
MARKS_OF_ROW = 1 << 15


def _mark(doc: np.ndarray, at: np.ndarray) -> np.ndarray:
    code = arrays.mixed(arrays.mixed(doc.astype(np.uint64)) + at.astype(np.uint64))
    return (code % np.uint64(MARKS)).astype(np.int64)


def _node_marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns = [batch.column(c).to_numpy() for c in PAIR if c in batch.schema.names]
        marks = np.unique(np.concatenate([_mark(*columns[k : k + 2]) for k in range(0, len(columns), 2)]))
        yield pa.RecordBatch.from_arrays([pa.array(marks)], names=["mark"])


def marked_nodes(pairs: DataFrame) -> Broadcast:
    """Bits in which every node of pairs, or of a table of nodes, is marked, for ``is_marked``.

    They are as many whatever the tables hold. What is marked may be no node, but few are.
    """
    marks = pairs.select(*(c for c in PAIR if c in pairs.columns)).mapInArrow(_node_marks, "mark long")
    row = F.shiftright("mark", 15).alias("row")
    marks = marks.select(row, F.col("mark").bitwiseAND(MARKS_OF_ROW - 1).alias("bit")).repartition("row")
    rows = marks.groupBy("row").agg(F.bitmap_construct_agg("bit").alias("bits")).collect()
    held = bytearray(MARKS // 8)
    for row, bits in rows:
        held[row * len(bits) : (row + 1) * len(bits)] = bits
    return pairs.sparkSession.sparkContext.broadcast(bytes(held))


def is_marked(marked: Broadcast, doc: np.ndarray, at: np.ndarray) -> np.ndarray:
    mark = _mark(doc, at)
    return (np.frombuffer(marked.value, np.uint8)[mark >> 3] >> (mark & 7).astype(np.uint8)) & 1 == 1


def _where_marked(marked: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(is_marked(marked, *(batch.column(c).to_numpy() for c in NODE))))

    return run


#: A member of a bucket, and a pair, as they are packed into the bytes of a row.
MEMBER = np.dtype([("key", "<i8"), ("doc", "<i8"), ("at", "<i8")])
PACKED = "key int, members binary, pairs binary"
#: Of a key that is dealt to a slot so much is sent; what meets by chance is compared in full.
KEY_BITS = (1 << 48) - 1


def slots_of(spark: SparkSession) -> int:
    """Into how many slots keys are dealt: a few for each partition of a shuffle."""
    return 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))


def _by_byte(members: np.ndarray, width: int) -> bytes:
    """The first bytes of all members, then the second ones: those of ids that lie near each
    other are runs, which the compression of a shuffle takes out."""
    return members.view(np.uint8).reshape(-1, width).T.tobytes()


def _members(column: pa.Array) -> np.ndarray:
    parts = [np.empty(0, MEMBER)]
    for value in column:
        if value.is_valid and (held := np.frombuffer(value.as_buffer(), np.uint8)).size:
            parts.append(np.ascontiguousarray(held.reshape(MEMBER.itemsize, -1).T).view(MEMBER).ravel())
    return np.concatenate(parts)


def packed_stars(doc: np.ndarray, at: np.ndarray, keys: np.ndarray, slots: int) -> pa.RecordBatch:
    """What ``stars_of_batch`` sends, as a row for each slot of keys and one for the pairs.

    Most keys are alone in the world: as rows of their own they would cost far more than the
    bytes that they hold.
    """
    n, bands = keys.shape
    by_place = np.lexsort((at, doc))
    doc, at = doc[by_place], at[by_place]
    key, owner = keys[by_place].ravel(), np.repeat(np.arange(n), bands)
    order = np.argsort(key)
    key, owner = key[order], owner[order]
    start = np.flatnonzero(_first_of_run(key))
    least = np.minimum.reduceat(owner, start) if n else owner
    centre = np.repeat(least, np.diff(np.append(start, len(key))))
    # The others of a key go to its first, once each and not to themselves.
    leaf = np.flatnonzero((doc[owner] != doc[centre]) | (at[owner] != at[centre]))
    both = np.unique(owner[leaf] * n + centre[leaf])
    pairs = np.stack([doc[both // n], at[both // n], doc[both % n], at[both % n]], axis=1)
    members = np.empty(len(start), MEMBER)
    members["key"], members["doc"], members["at"] = key[start], doc[least], at[least]
    slot = (members["key"].view(np.uint64) >> np.uint64(20)) % np.uint64(slots)
    members["key"] &= KEY_BITS
    by_slot = np.argsort(slot.astype(np.int64) * n + least)
    members, slot = members[by_slot], slot[by_slot]
    start = np.flatnonzero(_first_of_run(slot)) if len(slot) else np.empty(0, np.int64)
    count = len(start) + 1
    ends = np.append(start, [len(members)] * 2) * MEMBER.itemsize
    held = b"".join(_by_byte(part, MEMBER.itemsize) for part in np.split(members, start[1:]))
    held = pa.Array.from_buffers(
        pa.binary(), count, [None, pa.py_buffer(ends.astype(np.int32).tobytes()), pa.py_buffer(held)]
    )
    routes = np.append(slot[start].astype(np.int64), int(doc[0]) % slots if n else 0)
    sent = pa.array([None] * (count - 1) + [pairs.astype("<i8").tobytes()], pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(routes, pa.int32()), held, sent], ["key", "members", "pairs"])


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs of a node and the centre of a bucket, slot by slot."""
    for held in whole_groups(batches):
        pairs = [np.frombuffer(arrays.raw(held.column("pairs").chunk(0)), "<i8").reshape(-1, 4)]
        members = _members(held.column("members").chunk(0))
        order = np.argsort(members["key"])
        key = members["key"][order]
        again = np.append(key[1:] == key[:-1], False) if len(key) else np.empty(0, bool)
        again[1:] |= again[:-1].copy()
        members = members[order[again]]
        members = members[np.lexsort((members["at"], members["doc"], members["key"]))]
        if len(members):
            first = _first_of_run(members["key"])
            centre = members[np.flatnonzero(first)[np.cumsum(first) - 1]]
            found = np.stack([members["doc"], members["at"], centre["doc"], centre["at"]], axis=1)
            pairs.append(found[(found[:, 0] != found[:, 2]) | (found[:, 1] != found[:, 3])])
        together = np.concatenate(pairs)
        if len(together):
            together = together[np.lexsort(together.T)]
            together = together[_first_of_run(*together.T)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in together.T.copy()], names=PAIR)


def star_pairs(packed: DataFrame) -> DataFrame:
    """The distinct pairs of a node and a centre that shares a bucket with it.

    ``packed`` has the rows of ``packed_stars``; a task holds the members of one slot.
    """
    arranged = packed.repartition("key").sortWithinPartitions("key")
    return written(arranged.mapInArrow(_unpacked, "doc long, at long, to_doc long, to_at long").distinct())


def linked(
    pairs: DataFrame,
    compare: Callable[[DataFrame, DataFrame], DataFrame],
    texts: DataFrame,
    copies: DataFrame,
    sets: Sets,
    percent: int,
    bins: int,
    rows: int,
    owned: bool = False,
) -> DataFrame:
    """Components of the ``star_pairs`` with ``percent`` of their union in common.

    ``compare`` takes distinct pairs (doc, at, to_doc, to_at) and the texts of their nodes
    and returns the pairs with the sizes ``common`` and ``union`` of their sets; ``texts`` has
    (doc, at, text) and ``sets`` gives the values of a column of texts and the text of each.
    Pairs are of nodes that share a band of ``rows`` of ``bins``. ``owned`` texts are
    a table of the nodes of the pairs and few others, which is deleted here.

    Nodes of equal texts are in the same buckets: the smallest stands for its ``copies``, so
    only its text moves and only it takes part in what follows. ``with_copies`` adds them to
    what is returned.
    """
    spark = pairs.sparkSession
    own = written(_folded(pairs, copies))
    forget(pairs)
    released(spark)
    near = texts if owned else parted(texts, nodes(own), *NODE)[0]
    marked = marked_nodes(own)
    needed = written(near.mapInArrow(_where_marked(marked), near.schema))
    marked.destroy()
    if owned:
        forget(texts)
    released(spark)
    compared = written(compare(own, needed))
    released(spark)
    links = compared.where(F.expr(f"100 * common >= {percent} * union")).select(*PAIR)
    found = written(components(links))
    # A node with the set of a smaller centre is in all of that node's buckets: one is enough.
    node, to = F.struct(*NODE), F.struct(F.col("to_doc").alias("doc"), F.col("to_at").alias("at"))
    same = compared.where(F.col("common") == F.col("union")).where(node > to).select(node.alias("node")).distinct()
    more = written(_missed(own, same, found, needed, sets, percent, bins, rows))
    for table in (own, compared):
        forget(table)
    released(spark)
    if more.take(1):
        found = _joined(found, more)
    return found


def with_copies(found: DataFrame, copies: DataFrame) -> DataFrame:
    """``found`` and the same for the ``copies`` of its nodes and of others."""
    root = found.toDF("to_doc", "to_at", "new_doc", "new_at")
    others = copies.join(root, ["to_doc", "to_at"], "left").select(
        *NODE, F.coalesce("new_doc", "to_doc").alias("to_doc"), F.coalesce("new_at", "to_at").alias("to_at")
    )
    return found.unionByName(others)


def copies_of(texts: DataFrame, wanted: DataFrame | None = None) -> DataFrame:
    """(doc, at, to_doc, to_at) of the ``wanted`` nodes with a text that a smaller one has as
    well, and the smallest of those. A node of several texts has no copies and is none."""
    code = texts.where("text is not null").select(
        *NODE, F.xxhash64("text").alias("a"), F.xxhash64(F.lit(1), "text").alias("b"), F.octet_length("text").alias("size")
    )
    if wanted is not None:
        code = code.join(wanted, NODE, "left_semi")
    ends = [f(c).alias(f"{f.__name__}_{c}") for c in "ab" for f in (F.min, F.max)]
    code = code.groupBy(*NODE).agg(*ends, F.max(F.col("size") == 0).alias("blank"))
    code = code.where("min_a = max_a and min_b = max_b and not blank")
    code = written(code.select(*NODE, F.col("min_a").alias("a"), F.col("min_b").alias("b")))
    first = code.groupBy("a", "b").agg(F.min(F.struct(*NODE)).alias("to"), F.count("*").alias("n"))
    first = written(first.where("n > 1").select("a", "b", F.col("to.doc").alias("to_doc"), F.col("to.at").alias("to_at")))
    both = code.join(first, ["a", "b"]).where("doc != to_doc or at != to_at")
    copies = written(both.select(*PAIR))
    for table in (code, first):
        forget(table)
    return copies


def _folded(pairs: DataFrame, copies: DataFrame) -> DataFrame:
    """The distinct ``pairs`` of the nodes that stand for theirs."""
    near = copies.toDF(*NODE, "new_doc", "new_at")
    far = copies.toDF("to_doc", "to_at", "new_to_doc", "new_to_at")
    both = pairs.join(near, NODE, "left").join(far, ["to_doc", "to_at"], "left")
    both = both.select(*(F.coalesce(f"new_{c}", c).alias(c) for c in PAIR))
    return both.where("doc != to_doc or at != to_at").distinct()


def _joined(found: DataFrame, more: DataFrame) -> DataFrame:
    """The components ``found``, of which links ``more`` join some.

    Only the smallest nodes of components are linked anew.
    """
    node, to = F.struct(*NODE).alias("node"), F.struct("to_doc", "to_at")
    own = found.select(node, to.cast("struct<doc:bigint,at:bigint>").alias("root"))
    ends = more.select(node, to.cast("struct<doc:bigint,at:bigint>").alias("far"))
    ends = ends.join(own, "node", "left").select(F.coalesce("root", "node").alias("a"), "far")
    ends = ends.join(own.toDF("far", "root"), "far", "left").select("a", F.coalesce("root", "far").alias("b"))
    edges = ends.select("a.doc", "a.at", F.col("b.doc").alias("to_doc"), F.col("b.at").alias("to_at"))
    moved = written(components(edges))
    again = moved.toDF("to_doc", "to_at", "new_doc", "new_at")
    after = found.join(again, ["to_doc", "to_at"], "left").select(
        *NODE, F.coalesce("new_doc", "to_doc").alias("to_doc"), F.coalesce("new_at", "to_at").alias("to_at")
    )
    return after.unionByName(moved)


def _missed(
    pairs: DataFrame,
    same: DataFrame,
    found: DataFrame,
    texts: DataFrame,
    sets: Sets,
    percent: int,
    bins: int,
    rows: int,
) -> DataFrame:
    """Links between nodes of buckets that hold more than one component.

    The buckets of the nodes around centres, but for ``same``, are taken from their texts
    once more. Those outside of a bucket's largest component meet the others in blocks, inside
    tasks, which compare what looks alike on the full sets. Only links become rows, and one
    of two components is enough in a block. A node is in no more buckets than there are bands.
    """
    node, to = F.struct(*NODE), F.struct(F.col("to_doc").alias("doc"), F.col("to_at").alias("at"))
    own = found.select(node.alias("node"), to.alias("component"))
    of_hub = own.select(F.col("node").alias("hub"), F.col("component").alias("hub_component"))
    every = pairs.select(to.alias("hub"), node.alias("node"))
    told = every.join(same, "node", "left_anti").join(own, "node", "left").join(of_hub, "hub", "left")
    differ = F.coalesce("component", "node") != F.coalesce("hub_component", "hub")
    # Only where a pair lies in two components, at one step or two, may a link be missed.
    open_hubs = written(told.where(differ).select("hub").distinct())
    outer = every.join(open_hubs.withColumnRenamed("hub", "node"), "node", "left_semi").select("hub")
    hubs = written(open_hubs.unionByName(outer).distinct())
    near = every.join(hubs, "hub", "left_semi").select("node")
    near = written(near.unionByName(hubs.withColumnRenamed("hub", "node")).distinct())
    far = every.join(near.withColumnRenamed("node", "hub"), "hub", "left_semi").select("node")
    wanted = near.unionByName(far).distinct().join(same, "node", "left_anti")
    wanted = written(wanted.join(own, "node", "left").select("node.*", F.coalesce("component", "node").alias("component")))
    marked = marked_nodes(wanted)
    for table in (open_hubs, hubs, near):
        forget(table)
    released(pairs.sparkSession)
    looks = written(sketched(texts, sets, bins, rows, marked))
    marked.destroy()
    forget(texts)
    # Components join the keys alone, without the texts.
    placed = looks.select(*NODE, "keys", F.octet_length("text").alias("bytes")).join(wanted, NODE)
    placed = written(placed.select(node.alias("node"), "component", "keys", "bytes"))
    forget(wanted)
    released(looks.sparkSession)
    member = placed.select(F.explode("keys").alias("key"), "node", "component", "bytes")
    parts = member.groupBy("key", "component").agg(
        F.count("*").alias("n"), F.sum("bytes").alias("bytes"), F.bit_xor(F.xxhash64("node")).alias("who")
    )
    sizes = parts.groupBy("key").agg(
        F.max(F.struct("n", "component", "bytes")).alias("most"),
        F.sum("n").alias("n"),
        F.sum("bytes").alias("bytes"),
        F.bit_xor("who").alias("who"),
    )
    sizes = sizes.withColumn("inner", F.col("most.component"))
    sizes = sizes.withColumns({"n_out": F.col("n") - F.col("most.n"), "bytes_out": F.col("bytes") - F.col("most.bytes")})
    # Buckets of the same members meet once.
    sizes = sizes.where("n_out > 0").groupBy("who", "n").agg(F.min_by(F.struct("*"), "key").alias("x")).select("x.*")
    sizes = written(sizes.select("key", "inner", _blocks("n", "bytes", "blocks"), _blocks("n_out", "bytes_out", "out_blocks")))
    sketch = looks.select(node.alias("node"), "same", "sketch", "text")
    held = member.drop("bytes").join(sizes, "key").withColumn("outside", F.expr("component != inner"))
    held = written(held.select("key", "node", "component", "outside", "blocks", "out_blocks"))
    released(looks.sparkSession)
    held = held.join(sketch, "node")
    block = F.pmod(F.xxhash64("node"), F.col("blocks"))
    out_block = F.pmod(F.xxhash64("node"), F.col("out_blocks"))
    all_in = F.sequence(F.lit(0), F.col("blocks") - 1)
    all_out = F.sequence(F.lit(0), F.col("out_blocks") - 1)
    columns = ["key", "node.*", F.col("component.doc").alias("c_doc"), F.col("component.at").alias("c_at")]
    columns += ["same", "sketch", "text"]
    # In a bucket of one block a node is sent once: outsiders meet each other as well.
    right = F.when(F.expr("not outside or blocks > 1 or out_blocks > 1"), F.transform(all_out, lambda j: F.struct(F.lit(False).alias("out"), block.alias("i"), j.alias("j"))))
    left = F.when(F.col("outside"), F.transform(all_in, lambda i: F.struct(F.lit(True).alias("out"), i.alias("i"), out_block.alias("j"))))
    empty = F.array().cast("array<struct<out:boolean,i:bigint,j:bigint>>")
    kind = "array<struct<out:boolean,i:bigint,j:bigint>>"
    places = F.concat(F.coalesce(right.cast(kind), empty), F.coalesce(left.cast(kind), empty))
    dealt = held.select(*columns, F.explode(places).alias("p")).select(
        F.xxhash64("key", "p.i", "p.j").alias("key"), *NODE, "c_doc", "c_at", "same", "p.out", "sketch", "text"
    )
    dealt = dealt.repartition("key").sortWithinPartitions("key")
    met = dealt.mapInArrow(_meeting(sets, percent), "doc long, at long, to_doc long, to_at long")
    return met.distinct()


def _blocks(count: str, size: str, name: str) -> F.Column:
    by_count, by_size = F.ceil(F.col(count) / BLOCK), F.ceil(F.col(size) / BLOCK_BYTES)
    return F.greatest(by_count, by_size, F.lit(1)).alias(name)


def _meeting(sets: Sets, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in whole_groups(batches):
            names = ("key", "doc", "at", "c_doc", "c_at", "same", "out")
            columns = [held.column(c).to_numpy() for c in names]
            sketch = np.frombuffer(arrays.raw(held.column("sketch").chunk(0)), np.uint8)
            # Of equal texts of one component one stands for all.
            order = np.lexsort([columns[k] for k in (2, 1, 5, 4, 3, 6, 0)])
            order = order[_first_of_run(*(columns[k][order] for k in (5, 4, 3, 6, 0)))]
            key, doc, at, c_doc, c_at, _, out = (x[order] for x in columns)
            sketch = sketch.reshape(len(columns[0]), -1)[order]
            texts = held.column("text").combine_chunks().take(pa.array(order))
            component = _numbered(c_doc, c_at) - 1
            x, y = _links(key, out, component, sketch, texts, sets, percent)
            if len(x):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v) for v in (doc[x], at[x], doc[y], at[y])], names=PAIR
                )

    return run


def _numbered(*columns: np.ndarray) -> np.ndarray:
    """A number for each distinct row of ``columns``."""
    order = np.lexsort(columns)
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(_first_of_run(*(c[order] for c in columns)))
    return out


def _met(key: np.ndarray, out: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of an outsider and another member of its group, each once, some at a time."""
    first = _first_of_run(key)
    start = np.flatnonzero(first)
    group = np.cumsum(first) - 1
    low, size = start[group], np.diff(np.append(start, len(key)))[group]
    outer = np.flatnonzero(out)
    total = np.cumsum(size[outer])
    begin = 0
    while begin < len(outer):
        before = total[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(total, before + MET, "right")))
        own = outer[begin:end]
        x = np.repeat(own, size[own])
        y = np.arange(len(x)) + np.repeat(low[own] - (total[begin:end] - size[own] - before), size[own])
        use = ~out[y] | (x < y)
        yield x[use], y[use]
        begin = end


def _alike(sketch: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """How many bytes of their sketches the rows of pairs have in common."""
    found = np.empty(len(x), np.int64)
    for low in range(0, len(x), LOOKED):
        part = slice(low, low + LOOKED)
        found[part] = np.count_nonzero(sketch[x[part]] == sketch[y[part]], axis=1)
    return found


def _outlines(texts: pa.Array, sets: Sets) -> tuple[np.ndarray, np.ndarray]:
    """Bits at which a text has a value of its set, and how many values each set holds."""
    sizes = np.empty(len(texts), np.int64)
    bits = np.empty((len(texts), OUTLINE // 64), np.uint64)
    for low, high in arrays.blocks(texts, SET_BYTES):
        n = high - low
        keys, shift = arrays.set_keys(*sets(texts.slice(low, n)), n)
        of = (keys >> shift).astype(np.int64)
        sizes[low:high] = np.bincount(of, minlength=n)
        # The upper bits of a value, which are the same whatever texts it is held with.
        keys <<= np.uint64(64) - shift
        place = (keys >> np.uint64(65 - OUTLINE.bit_length())).astype(np.int64)
        ends = np.searchsorted(of, np.arange(0, n + OUTLINED, OUTLINED))
        for k, first in enumerate(range(0, n, OUTLINED)):
            held = np.zeros((min(OUTLINED, n - first), OUTLINE), bool)
            part = slice(ends[k], ends[k + 1])
            held[of[part] - first, place[part]] = True
            bits[low + first : low + first + len(held)] = np.packbits(held, axis=1).view(np.uint64)
    return bits, sizes


def _may_link(
    bits: np.ndarray, sizes: np.ndarray, x: np.ndarray, y: np.ndarray, percent: int
) -> np.ndarray:
    """Whether as many values as a link asks for can be in both sets of a pair.

    Each value of both sets has its bit in both outlines, alone or with others of its set: so
    no more are common than the common bits and the values that share theirs in one set.
    """
    shared = sizes - np.bitwise_count(bits).sum(axis=1, dtype=np.int64)
    most = np.minimum(shared[x], shared[y])
    for low in range(0, len(x), LOOKED):
        part = slice(low, low + LOOKED)
        most[part] += np.bitwise_count(bits[x[part]] & bits[y[part]]).sum(axis=1, dtype=np.int64)
    return 100 * most >= percent * (sizes[x] + sizes[y] - most)


def _confirmed(
    texts: pa.Array, sets: Sets, x: np.ndarray, y: np.ndarray, percent: int
) -> np.ndarray:
    """Whether the full sets of pairs are linked; texts are held for some pairs at a time."""
    length = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    total = np.cumsum(length[x] + length[y])
    found = np.zeros(len(x), bool)
    low = 0
    while low < len(x):
        before = total[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(total, before + SET_BYTES, "right")))
        own, far = (sets(texts.take(pa.array(z[low:high]))) for z in (x, y))
        common, union = arrays.overlaps(own, far, high - low)
        found[low:high] = 100 * common >= percent * union
        low = high
    return found


def _links(
    key: np.ndarray,
    out: np.ndarray,
    component: np.ndarray,
    sketch: np.ndarray,
    texts: pa.Array,
    sets: Sets,
    percent: int,
) -> tuple[np.ndarray, np.ndarray]:
    """Links of the outsiders of groups with all of their group, until components are joined.

    Rows lie in order of ``key``; components are numbers from 0 on. What looks alike is
    compared in rounds, the pairs that look most alike of each component first and twice as many
    from round to round; what a round joins, the next ones need not compare.
    """
    root = np.arange(component.max(initial=-1) + 1)
    quick, share = np.ascontiguousarray(sketch[:, :QUICK]), percent / 100
    enough = QUICK * share - DEVIATIONS * np.sqrt(QUICK * share * (1 - share))
    least = (share - MARGIN) * sketch.shape[1]
    links = [(np.empty(0, np.int64),) * 2]
    for x, y in _met(key, out):
        for look, needed in ((quick, enough), (sketch, least)):
            apart = root[component[x]] != root[component[y]]
            x, y = x[apart], y[apart]
            alike = _alike(look, x, y)
            x, y, alike = x[alike >= needed], y[alike >= needed], alike[alike >= needed]
        if not len(x):
            continue
        rows, place = np.unique(np.concatenate([x, y]), return_inverse=True)
        outlines = _outlines(texts.take(pa.array(rows)), sets)
        may = _may_link(*outlines, place[: len(x)], place[len(x) :], percent)
        x, y, alike = x[may], y[may], alike[may]
        most = 1
        while len(x):
            own, far = root[component[x]], root[component[y]]
            order = np.flatnonzero(own != far)
            order = order[np.lexsort((-alike[order], own[order]))]
            x, y, alike, own = x[order], y[order], alike[order], own[order]
            first = _first_of_run(own)
            rank = np.arange(len(own)) - np.flatnonzero(first)[np.cumsum(first) - 1]
            now = rank < most
            a, b = x[now], y[now]
            linked = _confirmed(texts, sets, a, b, percent)
            a, b = a[linked], b[linked]
            links.append((a, b))
            for mine, other in zip(component[a].tolist(), component[b].tolist(), strict=True):
                if root[mine] != root[other]:
                    root[root == root[other]] = root[mine]
            x, y, alike = x[~now], y[~now], alike[~now]
            most *= 2
    return tuple(map(np.concatenate, zip(*links, strict=True)))


def sketched(texts: DataFrame, sets: Sets, bins: int, rows: int, marked: Broadcast) -> DataFrame:
    """The ``marked`` of ``texts`` with band keys and sketches; ``same`` is a code of the text but
    for its case."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _where_marked(marked)(batches):
            parts, same = [], [np.empty(0, np.uint64)]
            keys = [np.empty((0, bins // rows), np.int64)]
            for low, high in arrays.blocks(batch.column("text"), SET_BYTES):
                part = batch.column("text").slice(low, high - low)
                found = sets(part)
                looks = arrays.one_permutation(*found, high - low, SKETCH)
                parts += [row.tobytes() for row in looks.astype(np.uint8)]
                keys.append(arrays.band_keys(arrays.one_permutation(*found, high - low, bins), rows))
                data, offsets = arrays.texts(part)
                same.append(arrays.hash_spans(arrays.LOWER[data], offsets[:-1], offsets[1:]))
            code = pa.array(np.concatenate(same).view(np.int64))
            key = np.concatenate(keys)
            ends = pa.array(np.arange(len(key) + 1, dtype=np.int32) * (bins // rows))
            held = pa.ListArray.from_arrays(ends, pa.array(key.ravel()))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, code, pa.array(parts, pa.binary()), held],
                names=[*NODE, "text", "same", "sketch", "keys"],
            )

    shape = "doc long, at long, text string, same long, sketch binary, keys array<bigint>"
    return texts.select(*NODE, "text").mapInArrow(run, shape)
