"""Groups of spelling variants, found by a trie over letter counts.

Words are maximal runs of the letters A to Z and U+00C0 to U+00FF with A to Z lower-cased, of
seven code points and two occurrences at least. Where the crc32 of "doc_id:run" is divisible by
31, the run loses a code point first. Words are near if one code point is inserted, deleted or
replaced; a word's form is its near word of largest count, if that is ten times its own at
least; its root is the last of the forms that follow each other.

A word's vector holds its counts of eight groups of letters, then those of single letters; the
trie arranges words by successive counts. Near words differ by a surplus of one and a deficit
of one at most, so a depth-first search spends a budget of one each, over the groups and again
over the letters, and compares the words it ends at. The top of the trie is parted by Spark:
a word goes as a member to its own path of some levels, and as a query to the paths in reach
where it finds a surplus first, so that of two words one asks for the other.
Paths with more than ``LIMIT`` members are made longer by a level, until they hold fewer, and
queries of a path are dealt over tasks, each with its members. Below, a task searches for all
queries at once. A path that has no more levels holds words of the same letters, which are cut
into blocks; all blocks are searched. Nothing is lost or capped.

Null texts have no words; a null doc_id counts as an empty one; rows that repeat an id count
each. Other columns are ignored. An empty table has no words.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smeltery.llm import arrays, clusters
from smeltery.llm.shared import small_batches, written

LEAST = 7
TIMES = 10
DRAWN = 31
GROUPS = 8
LETTERS = 26 + 64
LEVELS = GROUPS + LETTERS
#: Members of a path, and queries that one task searches for.
LIMIT = 16384
QUERIES = 131072
#: Letters by which a path of all groups grows at once.
MORE = 15
#: Words of a task that are counted before they are sent on.
HELD = 1 << 18
#: Pairs of members and queries that are compared without going deeper.
CUT = 1 << 15
#: Words up to this length are compared many at once.
SHORT = 32

# The letters of English from the most frequent on are dealt to the groups in turn.
_ORDER = b"etaoinshrdlucmfwypvbgkqjxz"
_INDEX = np.zeros(256, np.int64)
_INDEX[97:123] = np.arange(26)
_INDEX[192:256] = np.arange(26, LETTERS)
_GROUP = np.arange(LETTERS) % GROUPS
_GROUP[[x - 97 for x in _ORDER]] = np.arange(26) % GROUPS
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), 0xC3]] = True


def _runs(column: pa.Array, least: int) -> tuple[list[bytes], np.ndarray]:
    """The lower-cased runs of ``least`` code points or more, and where each text's begin."""
    data, offsets = arrays.texts(column)
    # In UTF-8 the letters from U+00C0 to U+00FF are the byte C3 and the one that follows it.
    lead = data == 0xC3
    mask = _LETTER[data]
    mask[1:] |= lead[:-1]
    starts, ends = arrays.spans(mask, offsets)
    leads = np.append(0, np.cumsum(lead))
    use = (ends - starts) - (leads[ends] - leads[starts]) >= least
    starts, ends = starts[use], ends[use]
    lowered = arrays.LOWER[data].tobytes()
    runs = [lowered[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
    return runs, np.searchsorted(starts, offsets)


def altered(run: bytes, crc: int) -> bytes:
    text = run.decode()
    at = crc % len(text)
    return (text[:at] + text[at + 1 :]).encode()


def words(docs: DataFrame, least: int = LEAST, drawn: int = DRAWN) -> DataFrame:
    """(word, n) of the words that occur at least twice in all texts together."""

    def sent(total: dict[bytes, int]) -> pa.RecordBatch:
        found = [(w.decode(), n) for w, n in total.items()]
        known = [(w, n) for w, n in found if len(w) >= least]
        columns = [pa.array([w for w, _ in known], pa.string()), pa.array([n for _, n in known], pa.int64())]
        return pa.RecordBatch.from_arrays(columns, ["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            ids = batch.column("id").to_pylist()
            for low, high in arrays.blocks(batch.column("text")):
                runs, first = _runs(batch.column("text").slice(low, high - low), least)
                for k in range(high - low):
                    if first[k] == first[k + 1]:
                        continue
                    begin = zlib.crc32(f"{ids[low + k]}:".encode())
                    for word, n in Counter(runs[first[k] : first[k + 1]]).items():
                        crc = zlib.crc32(word, begin)
                        total[altered(word, crc) if crc % drawn == 0 else word] += n
                if len(total) > HELD:
                    yield sent(total)
                    total = Counter()
        if total:
            yield sent(total)

    small_batches(docs.sparkSession)
    own = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), "text")
    counted = own.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where("n >= 2")


def vectors(found: list[bytes]) -> np.ndarray:
    """The counts of each word, of the groups and then of the letters; 255 stands for more.

    Words are in Latin-1, a byte for each code point.
    """
    out = np.empty((len(found), LEVELS), np.uint8)
    for low in range(0, len(found), 4096):
        part = found[low : low + 4096]
        owner = np.repeat(np.arange(len(part)), [len(w) for w in part])
        letter = _INDEX[np.frombuffer(b"".join(part), np.uint8)]
        counts = np.bincount(owner * LETTERS + letter, minlength=len(part) * LETTERS).reshape(-1, LETTERS)
        groups = np.stack([counts[:, g == _GROUP].sum(axis=1) for g in range(GROUPS)], axis=1)
        out[low : low + 4096] = np.minimum(np.concatenate([groups, counts], axis=1), 255)
    return out


def _latin(column: pa.Array) -> list[bytes]:
    return [w.encode("latin-1") for w in column.to_pylist()]


ROUTED = "path binary, member boolean, word string, n long"


def _routes(path: np.ndarray, member: bool, batch: pa.RecordBatch, own: np.ndarray) -> pa.RecordBatch:
    """Rows of a batch on their way to ``path``, a row of bytes each."""
    n, width = path.shape
    fixed = pa.Array.from_buffers(
        pa.binary(width), n, [None, pa.py_buffer(np.ascontiguousarray(path, np.uint8).tobytes())]
    )
    at = pa.array(own)
    columns = [fixed.cast(pa.binary()), pa.array(np.full(n, member)), batch.column("word").take(at)]
    return pa.RecordBatch.from_arrays([*columns, batch.column("n").take(at)], ["path", "member", "word", "n"])


def _first_routes(depth: int):
    """Members at their path of ``depth`` levels, and queries at those in reach.

    Of two words on different paths one asks for the other: the one that finds a surplus where
    the paths first differ.
    """
    steps = [(None, None), *((u, None) for u in range(depth))]
    steps += [(u, d) for u in range(depth) for d in range(u + 1, depth)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = vectors(_latin(batch.column("word")))[:, :depth].astype(np.int16)
            yield _routes(own, True, batch, np.arange(len(own)))
            for up, down in steps:
                path = own.copy()
                if up is not None:
                    path[:, up] += 1
                if down is not None:
                    path[:, down] -= 1
                use = np.flatnonzero(((path >= 0) & (path <= 255)).all(axis=1))
                yield _routes(path[use], False, batch, use)

    return run


def _longer(levels: int):
    """The same rows at paths of some more levels."""

    def one(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        flat = np.frombuffer(arrays.raw(batch.column("path")), np.uint8)
        path = flat.reshape(batch.num_rows, -1).astype(np.int16)
        depth = path.shape[1]
        own = vectors(_latin(batch.column("word")))[:, : depth + 1].astype(np.int16)
        member = batch.column("member").to_numpy(zero_copy_only=False)
        step = path[:, 0 if depth < GROUPS else GROUPS :] - own[:, 0 if depth < GROUPS else GROUPS : depth]
        rises, falls = (step > 0).any(axis=1), (step < 0).any(axis=1)
        differs = rises | (path[:, :GROUPS] != own[:, :depth][:, :GROUPS]).any(axis=1)
        every = np.ones(len(own), bool)
        for more, free in ((0, every), (1, ~rises & ~member), (-1, ~falls & differs & ~member)):
            last = own[:, depth] + more
            use = free & (last >= 0) & (last <= 255)
            longer = np.concatenate([path, last[:, None]], axis=1)
            for kind in (True, False):
                rows = np.flatnonzero(use & (member == kind))
                if len(rows):
                    yield _routes(longer[rows], kind, batch, rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [batch] if batch.num_rows else []
            for _ in range(levels):
                made = [x for part in made for x in one(part)]
            yield from made

    return run


def ends_of(found: list[bytes], size: int) -> np.ndarray:
    """The first and the last ``size`` code points of each word, three at most, as numbers."""
    heads = np.array([w[:size] for w in found], "S4").view(np.int32)
    return np.stack([heads, np.array([w[len(w) - size :] for w in found], "S4").view(np.int32)])


def searched(
    members: np.ndarray, queries: np.ndarray, m_ends: np.ndarray, q_ends: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of members and queries that may be near: all that are, and some others.

    Both are vectors; members are in their order, which makes a trie of them: a node is a range
    and a level. The search goes down with all queries that still have a way. Where few pairs
    are left, those go on that begin or end alike: one edit leaves one of both as it is.
    """
    found = [np.empty((2, 0), np.int64)]
    none = np.zeros(len(queries), bool)
    stack = [(0, len(members), 0, np.arange(len(queries)), none, none)]
    columns = np.ascontiguousarray(queries.T.astype(np.int16))
    while stack:
        low, high, level, own, up, down = stack.pop()
        if level == GROUPS:
            up, down = np.zeros(len(own), bool), np.zeros(len(own), bool)
        if (high - low) * len(own) <= CUT or level == LEVELS:
            most = max(1, CUT // (high - low))
            for a in range(0, len(own), most):
                part = own[a : a + most]
                alike = m_ends[0, low:high, None] == q_ends[0, part]
                alike |= m_ends[1, low:high, None] == q_ends[1, part]
                x, y = np.nonzero(alike)
                found.append(np.stack([x + low, part[y]]))
            continue
        values = members[low:high, level]
        cuts = np.flatnonzero(np.diff(values)) + 1
        asked = columns[level, own]
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), high - low], strict=True):
            step = int(values[a]) - asked
            use = np.flatnonzero((step == 0) | ((step == 1) & ~up) | ((step == -1) & ~down))
            if len(use):
                step = step[use]
                stack.append((low + a, low + b, level + 1, own[use], up[use] | (step == 1), down[use] | (step == -1)))
    x, y = np.concatenate(found, axis=1)
    return x, y


def one_edit(a: bytes, b: bytes) -> bool:
    """Whether one code point was inserted, deleted or replaced between words in Latin-1."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    low, high = 0, len(a)
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if a[:mid] == b[:mid] else (low, mid - 1)
    return a[low + (len(a) == len(b)) :] == b[low + 1 :]


def _equal_bytes(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many bytes are equal before the first that is not, row by row."""
    other = a != b
    return np.where(other.any(axis=1), other.argmax(axis=1), a.shape[1])


def near(a: list[bytes], b: list[bytes], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Of the pairs of words a[x] and b[y] those that are one edit apart."""
    sizes = [np.array([len(w) for w in side], np.int64) for side in (a, b)]
    out = np.zeros(len(x), bool)
    both = np.maximum(sizes[0][x], sizes[1][y])
    for k in np.flatnonzero(both > SHORT).tolist():
        out[k] = one_edit(a[x[k]], b[y[k]])
    ahead, behind = ([], [])
    for side in (a, b):
        cut = [w[:SHORT] for w in side]
        ahead.append(np.array(cut, f"S{SHORT}").view(np.uint8).reshape(-1, SHORT))
        behind.append(np.array([w[::-1] for w in cut], f"S{SHORT}").view(np.uint8).reshape(-1, SHORT))
    short = np.flatnonzero(both <= SHORT)
    for low in range(0, len(short), 1 << 16):
        at = short[low : low + (1 << 16)]
        i, j = x[at], y[at]
        # Equal from the front and from the back, but for a byte of the longer word.
        equal = _equal_bytes(ahead[0][i], ahead[1][j]) + _equal_bytes(behind[0][i], behind[1][j])
        long, least = both[at], np.minimum(sizes[0][i], sizes[1][j])
        out[at] = (long - least <= 1) & (equal >= long - 1) & (equal < 2 * SHORT)
    return out


PARTIAL = "word string, n_near long, best_n long, best string"


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For the words of each path: how many are near, and the most frequent of them."""
    for held in clusters.whole_groups(batches):
        # Should two keys be equal, paths and blocks still tell.
        group = held.group_by(["path", "salt", "block"], use_threads=False).aggregate([])
        for path, salt, block in zip(*(group.column(c).to_pylist() for c in ("path", "salt", "block"))):
            rows = held
            if group.num_rows > 1:
                same = [p == path for p in held.column("path").to_pylist()]
                rows = held.filter(pa.array(same))
                rows = rows.filter(pa.array(np.asarray(rows.column("salt")) == salt))
                rows = rows.filter(pa.array(np.asarray(rows.column("block")) == block))
            member = np.asarray(rows.column("member"))
            count = np.asarray(rows.column("n"))
            found = np.array(_latin(rows.column("word")), object)
            own, asked = found[member], found[~member]
            if not len(own) or not len(asked):
                continue
            known, sought = vectors(own.tolist()), vectors(asked.tolist())
            order = np.lexsort(known.T[::-1])
            own, known, n = own[order], known[order], (count[member][order], count[~member])
            size = min(3, min(map(len, found)) // 2)
            x, y = searched(known, sought, ends_of(own.tolist(), size), ends_of(asked.tolist(), size))
            # Words on this path ask for each other: once is enough.
            here = (sought[:, : len(path)] == np.frombuffer(path, np.uint8)).all(axis=1)
            once = ~here[y] | (asked[y] < own[x])
            x, y = x[once], y[once]
            keep = near(own.tolist(), asked.tolist(), x, y)
            x, y = x[keep], y[keep]
            if len(x):
                yield _partial(asked, y, own, x, n[0])
                yield _partial(own, x, asked, y, n[1])


def _partial(words: np.ndarray, a: np.ndarray, others: np.ndarray, b: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    """For each of words[a]: how many others[b] there are, and the one of largest ``n``."""
    rank = np.empty(len(others), np.int64)
    rank[sorted(range(len(others)), key=others.__getitem__)] = np.arange(len(others))
    order = np.lexsort((rank[b], -n[b], a))
    a, b = a[order], b[order]
    first = np.flatnonzero(np.diff(a, prepend=-1))
    columns = [
        pa.array([w.decode("latin-1") for w in words[a[first]]]),
        pa.array(np.diff(np.append(first, len(a)))),
        pa.array(n[b[first]]),
        pa.array([w.decode("latin-1") for w in others[b[first]]]),
    ]
    return pa.RecordBatch.from_arrays(columns, ["word", "n_near", "best_n", "best"])


def neighbours(known: DataFrame, limit: int = LIMIT, queries: int = QUERIES, depth: int | None = None) -> DataFrame:
    """(word, n_near, best_n, best) of the words that have near ones.

    ``known`` is a stored table (word, n) with each word once. The top of the trie begins with
    ``depth`` levels; by default as many as would part the words evenly.
    """
    if depth is None:
        depth = math.ceil(math.log(max(1, known.count() / limit), 2.5))
    depth = min(max(1, depth), GROUPS)
    rows = known.mapInArrow(_first_routes(depth), ROUTED)
    found = None
    while True:
        rows = written(rows)
        sizes = rows.groupBy("path").agg(
            F.count_if("member").alias("members"), F.count_if(~F.col("member")).alias("queries")
        )
        # Where nobody is a member, no way leads on; a word alone meets itself.
        sizes = written(sizes.where("members > 0 and queries > 1"))
        hot = (F.col("members") > limit) & F.lit(depth < LEVELS)
        met = _dealt(rows.join(sizes.where(~hot), "path"), limit, queries).mapInArrow(_met, PARTIAL)
        met = written(met)
        found = met if found is None else found.unionByName(met)
        if not sizes.where(hot).take(1):
            break
        # Most single letters are in few words: they are taken several at once.
        more = 1 if depth < GROUPS else min(MORE, LEVELS - depth)
        rows = rows.join(sizes.where(hot).select("path"), "path").select("path", "member", "word", "n")
        rows = rows.mapInArrow(_longer(more), ROUTED)
        depth += more
    best = F.min(F.struct(-F.col("best_n"), F.col("best"))).alias("best")
    found = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best)
    return found.select("word", "n_near", (-F.col("best.col1")).alias("best_n"), F.col("best.best").alias("best"))


def _dealt(rows: DataFrame, limit: int, queries: int) -> DataFrame:
    """Rows by path, salt and block: queries are cut by salt, members by block."""
    salts = F.ceil(F.col("queries") / queries).cast("int")
    blocks = F.ceil(F.col("members") / limit).cast("int")
    mine = F.xxhash64("word")
    every = F.explode(F.sequence(F.lit(0), salts - 1)).alias("salt")
    members = rows.where("member").select("path", "member", "word", "n", every, F.pmod(mine, blocks).cast("int").alias("block"))
    every = F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block")
    asked = rows.where("not member").select(
        "path", "member", "word", "n", F.pmod(mine, salts).cast("int").alias("salt"), every
    )
    both = members.unionByName(asked).withColumn("key", F.xxhash64("path", "salt", "block"))
    return both.repartition("key").sortWithinPartitions("key")


def roots(links: DataFrame) -> DataFrame:
    """(word, root) of the words of the stored ``links`` (word, root), by doubling their ways.

    Every form is ``TIMES`` as frequent as its word, so a few rounds reach the end.
    """
    while True:
        further = links.select(F.col("word").alias("root"), F.col("root").alias("further"))
        after = links.join(further, "root", "left")
        after = written(after.select("word", F.coalesce("further", "root").alias("root"), "further"))
        if not after.where("further is not null").take(1):
            return after.select("word", "root")
        links = after.select("word", "root")


def grouped(docs: DataFrame, least: int = LEAST, times: int = TIMES, **settings: int) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word."""
    known = written(words(docs, least))
    near_words = neighbours(known, **settings)
    formed = F.col("best_n") >= times * F.col("n")
    told = known.join(near_words, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(formed, F.col("best")).alias("form"),
        F.when(formed, F.col("best_n")).alias("form_n"),
    )
    told = written(told)
    ends = roots(told.where("form is not null").select("word", F.col("form").alias("root")))
    root = F.coalesce("root", "word").alias("root")
    return told.join(ends, "word", "left").select("word", "form", root, "n", "n_near", "form_n")
