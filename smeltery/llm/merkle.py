"""A Merkle manifest of a dataset, with a proof for every row, by time-forward processing.

Every row is a leaf: the hash of its fields. Leaves of a group (a language) ascend by doc_id,
and runs of eight become their hash until one node is left, the group's subroot; subroots
make the root in the same way, ordered by group. Nodes are labelled by level and place, so a
child's label lies before its parent's.

Digests go forward as messages under the label of the parent. Between tasks the queue is
external: messages are rows of a table that Spark parts by chunks of 512 nodes and sorts by
label. Inside a chunk it is a heap of 512 messages at most. Each round raises the nodes by
three levels, so there are as many rounds as the largest group has digits to the base 512.
A reversed sweep over the stored rounds then delivers to each chunk the siblings on the way
above it, and from there to its nodes, down to the leaves. No task holds more than a chunk.

Places are counts: rows are dealt by range and sorted, and a row's place is its place in the
partition plus the sizes of the ones before. Rows that repeat an id stand in order of their
hashes; equal rows are leaves of their own, next to each other. A null doc_id comes first in
its language, a null language is a group of its own that comes first. Null fields count as
such, empty texts do not. An empty table has no rows in its manifest. Other columns than the
fields named are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from smeltery.llm.shared import and_fields, written

FAN = 8
CHUNK_LEVELS = 3
CHUNK = FAN**CHUNK_LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

#: The siblings on the way up: for each level, those to the left and those to the right.
Proof = list[tuple[str, str]]
PROOF = "array<struct<left: string, right: string>>"
NODE = ("grp", "chunk", "idx", "n", "digest")
MESSAGE = f"grp string, idx long, proof {PROOF}, subroot string, root string"


def hashed(parts: Sequence[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(*fields: Column) -> Column:
    """The hash of a row: each field as its byte count and value, a null as a dash."""
    parts = []
    for field in fields:
        text = field.cast("string")
        counted = F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
        parts.append(F.coalesce(counted, F.lit("-")))
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def levels_over(n: int) -> int:
    """How many levels lie above ``n`` nodes until one is left."""
    levels = 0
    while n > 1:
        n, levels = -(-n // FAN), levels + 1
    return levels


def forward(leaves: list[str], levels: int) -> list[list[str]]:
    """The digests of each level above ``leaves``, which come first.

    A node waits in the queue as messages of its children under its own label; as labels
    ascend, all of them are there when it is its turn.
    """
    made = [leaves, *([] for _ in range(levels))]
    queue = [(1, k // FAN, k, digest) for k, digest in enumerate(leaves)] if levels else []
    while queue:
        level, node = queue[0][:2]
        children = []
        while queue and queue[0][:2] == (level, node):
            children.append(heapq.heappop(queue)[3])
        digest = hashed(children)
        made[level].append(digest)
        if level < levels:
            heapq.heappush(queue, (level + 1, node // FAN, node, digest))
    return made


def backward(made: list[list[str]], above: Proof) -> list[Proof]:
    """The proof of each leaf of ``forward``, given that of its top: labels descend."""
    proofs = [above]
    for nodes in reversed(made[:-1]):
        below = []
        for k in range(len(nodes)):
            run = k - k % FAN
            siblings = ("".join(nodes[run:k]), "".join(nodes[k + 1 : run + FAN]))
            below.append([siblings, *proofs[k // FAN]])
        proofs = below
    return proofs


def folded(digest: str, proof: Proof) -> str:
    """The root that a leaf and the siblings on its way give."""
    for left, right in proof:
        digest = hashed((left, digest, right))
    return digest


def _height(n: int) -> int:
    return CHUNK_LEVELS if n > CHUNK else levels_over(n)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """Rows of one (grp, chunk) after the other, as they are sorted."""
    key, held = None, []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if row[:2] != key and held:
                yield held
                held = []
            key = row[:2]
            held.append(row)
    if held:
        yield held


def _dealt(rows: DataFrame) -> DataFrame:
    return rows.repartition("grp", "chunk").sortWithinPartitions("grp", "chunk", "idx")


def _in_chunks(nodes: DataFrame) -> DataFrame:
    return nodes.withColumn("chunk", F.expr(f"idx div {CHUNK}"))


def placed(rows: DataFrame, *order: str) -> DataFrame:
    """``rows`` of a stored table, with ``idx``, the place in the group, and its size ``n``.

    ``grp`` is not null. Equal rows are dealt apart by their place in the table.
    """
    # Ties end here, so that a group of equal rows may be dealt over partitions.
    marked = written(rows.withColumn("spot", F.monotonically_increasing_id()))
    keys = ["grp", *order, "spot"]
    arranged = marked.repartitionByRange(*keys).sortWithinPartitions(*keys)
    arranged = written(
        arranged.withColumns({"pid": F.spark_partition_id(), "at": F.monotonically_increasing_id()})
    )
    # A row for each group and partition.
    parts = arranged.groupBy("grp", "pid").agg(F.count("*").alias("size"), F.min("at").alias("low"))
    whole = Window.partitionBy("grp")
    before = whole.orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        "grp",
        "pid",
        (F.coalesce(F.sum("size").over(before), F.lit(0)) - F.col("low")).alias("shift"),
        F.sum("size").over(whole).alias("n"),
    )
    found = arranged.join(parts, ["grp", "pid"])
    return found.withColumn("idx", F.col("at") + F.col("shift")).drop("pid", "at", "shift", "spot")


def _raised(nodes: DataFrame) -> DataFrame:
    """The tops of the chunks of ``nodes``: the nodes of the next round."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tops = []
        for rows in _chunks(batches):
            grp, chunk, _, n, _ = rows[0]
            top = forward([r[4] for r in rows], _height(n))[-1][0]
            tops.append((grp, chunk, -(-n // CHUNK), top))
        yield from _batches(tops, "grp string, idx long, n long, digest string")

    shape = "grp string, idx long, n long, digest string"
    return _dealt(_in_chunks(nodes).select(*NODE)).mapInArrow(run, shape)


ARROW = {
    "string": pa.string(),
    "long": pa.int64(),
    "boolean": pa.bool_(),
    "proof": pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())])),
}


def _batches(rows: list[tuple], shape: str, size: int = 4096) -> Iterator[pa.RecordBatch]:
    """``rows`` as batches of columns "name type, ..."."""
    fields = [x.split() for x in shape.split(", ")]
    for low in range(0, len(rows), size):
        columns = zip(*rows[low : low + size], strict=True)
        arrays = [pa.array(c, ARROW[kind]) for c, (_, kind) in zip(columns, fields, strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, names=[name for name, _ in fields])


def rounds_of(nodes: DataFrame) -> list[DataFrame]:
    """The stored nodes (grp, idx, n, digest) of each round; the last has one for each group."""
    rounds = [nodes]
    most = nodes.agg(F.max("n")).first()[0] or 0
    while most > 1:
        rounds.append(written(_raised(rounds[-1])))
        most = -(-most // CHUNK)
    return rounds


def _delivered(nodes: DataFrame, messages: DataFrame, last: Callable | None, shape: T.StructType | str) -> DataFrame:
    """The messages to the nodes of a round, from those to the tops of its chunks.

    ``last`` makes of the rows of a chunk, their proofs, subroot and root what goes out
    instead. Nodes may have a ``row``, which is passed to it.
    """
    own = _in_chunks(nodes)
    if "row" not in own.columns:
        own = own.withColumn("row", F.lit(None).cast("string"))
    told = messages.withColumnRenamed("idx", "chunk").withColumn("idx", F.lit(-1).cast("long"))
    both = own.select(*NODE, "row").unionByName(told, allowMissingColumns=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for message, *rows in _chunks(batches):
            above = [(x["left"], x["right"]) for x in message[6]]
            made = forward([r[4] for r in rows], _height(rows[0][3]))
            proofs = backward(made, above)
            if last is not None:
                yield last(rows, proofs, *message[7:])
                continue
            sent = [[{"left": a, "right": b} for a, b in p] for p in proofs]
            out += [(r[0], r[2], p, *message[7:]) for r, p in zip(rows, sent, strict=True)]
        yield from _batches(out, "grp string, idx long, proof proof, subroot string, root string")

    return _dealt(both.select(*NODE, "row", "proof", "subroot", "root")).mapInArrow(run, shape)


def _down(rounds: list[DataFrame], messages: DataFrame, last: Callable, shape: T.StructType) -> DataFrame:
    """The reversed sweep: messages to the tops of the last round, delivered to the leaves."""
    for nodes in reversed(rounds[1:-1]):
        messages = written(_delivered(nodes, messages, None, MESSAGE))
    return _delivered(rounds[0], messages, last, shape)


def _to_group(rows: list[tuple], proofs: list[Proof], subroot: str, root: str) -> pa.RecordBatch:
    """What the tree of subroots sends to the top of each group, whose name is in ``row``."""
    sent = [[{"left": a, "right": b} for a, b in p] for p in proofs]
    told = [(r[5], 0, p, r[4], root) for r, p in zip(rows, sent, strict=True)]
    shape = "grp string, idx long, proof proof, subroot string, root string"
    return next(_batches(told, shape, len(told)))


def manifest(
    docs: DataFrame,
    fields: Sequence[str] = FIELDS,
    group: str = "lang",
    key: str = "doc_id",
    found: Column | None = None,
    with_proof: bool = True,
) -> DataFrame:
    """(key, leaf, subroot, root, proof, proof_sha256, folded_root, verified) of every row.

    ``found`` is the hash that the row has now, the leaf itself if not given: it is folded with
    the siblings of the leaf, and the row is verified if that gives the root.
    """
    leaf = leaf_of(*(F.col(c) for c in fields))
    grp = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))
    row = F.struct(F.col(key).alias("key"), (leaf if found is None else found).alias("found"))
    rows = docs.select(grp.alias("grp"), F.col(key).alias("key"), leaf.alias("digest"), row.alias("row"))
    leaves = written(placed(rows, "key", "digest").select("grp", "idx", "n", "digest", "row"))
    rounds = rounds_of(leaves)
    subroots = rounds[-1].select(F.lit("").alias("grp"), F.col("grp").alias("key"), "digest")
    tops = written(placed(subroots.withColumn("row", F.col("key")), "key"))
    tops = tops.select("grp", "idx", "n", "digest", "row")
    above = rounds_of(tops)
    root = above[-1].select("grp", "idx", F.array().cast(PROOF).alias("proof"), "digest")
    root = root.select("grp", "idx", "proof", F.col("digest").alias("subroot"), F.col("digest").alias("root"))
    messages = written(_down(above, root, _to_group, MESSAGE))

    def told(rows: list[tuple], proofs: list[Proof], subroot: str, root: str) -> pa.RecordBatch:
        now = [folded(r[5]["found"], p) for r, p in zip(rows, proofs, strict=True)]
        sent = [[{"left": a, "right": b} for a, b in p] for p in proofs] if with_proof else [None] * len(rows)
        columns = {
            "key": pa.array([r[5]["key"] for r in rows], kind),
            "leaf": pa.array([r[4] for r in rows]),
            "subroot": pa.array([subroot] * len(rows)),
            "root": pa.array([root] * len(rows)),
            "proof": pa.array(sent, ARROW["proof"]),
            "proof_sha256": pa.array([hashed([x for pair in p for x in pair]) for p in proofs]),
            "folded_root": pa.array(now),
            "verified": pa.array([x == root for x in now]),
        }
        return pa.RecordBatch.from_pydict(columns)

    field = leaves.schema["row"].dataType["key"]
    kind = _arrow_type(field.dataType)
    shape = and_fields(
        [T.StructField("key", field.dataType)],
        f"leaf string, subroot string, root string, proof {PROOF}, proof_sha256 string, folded_root string, verified boolean",
    )
    out = _down(rounds, messages, told, shape).withColumnRenamed("key", key)
    return out if with_proof else out.drop("proof")


def _arrow_type(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)
