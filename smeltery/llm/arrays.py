"""Texts of an Arrow column as flat arrays: words, spans and hashes of a whole block at once.

A word is a run of bytes other than the ASCII white space; null texts read as empty.
Work goes block by block, so that memory follows a block and the longest text.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache, lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))

SPACE = np.zeros(256, bool)
SPACE[[32, *range(9, 14)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges whose texts hold ``limit`` bytes together, or one longer text.

    Behind the last one, memory that the process has freed goes back to the system: Python
    workers live on between tasks, beside each other.
    """
    total = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False))
    low = 0
    while low < len(total):
        before = total[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(total, before + limit, "right")))
        yield low, high
        low = high
    give_back()


@cache
def _trim():
    try:
        return ctypes.CDLL(None).malloc_trim
    except (OSError, AttributeError):  # another C library
        return lambda _: 0


def give_back() -> None:
    pa.default_memory_pool().release_unused()
    _trim()(0)


def texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column, and where each text begins, with the end last."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    held = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return held[at[0] : at[-1]], at - at[0]


@dataclass
class Words:
    """Spans of words in ``data``, the text of each, and how many words come before each text."""

    data: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    doc: np.ndarray
    first: np.ndarray

    @property
    def per_text(self) -> np.ndarray:
        return np.diff(self.first)


def spans(mask: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of set positions; runs end where a text ends."""
    if not len(mask):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    opens, closes = mask.copy(), mask.copy()
    opens[1:] &= ~mask[:-1]
    closes[:-1] &= ~mask[1:]
    inner = offsets[(offsets > 0) & (offsets < len(mask))]
    opens[inner] = mask[inner]
    closes[inner - 1] = mask[inner - 1]
    return np.flatnonzero(opens), np.flatnonzero(closes) + 1


def words(data: np.ndarray, offsets: np.ndarray) -> Words:
    starts, ends = spans(~SPACE[data], offsets)
    first = np.searchsorted(starts, offsets, "left")
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    return Words(data, offsets, starts, ends, doc, first)


@lru_cache(maxsize=1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for base in (_BASE, _INVERSE):
        steps = np.full(size, base, np.uint64)
        steps[0] = 1
        out.append(np.multiply.accumulate(steps))
    return out[0], out[1]


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers up to the ``n``-th at least. They stay in the process: functions travel to the
    tasks with the values of a module, but not with those of a cache."""
    usual = BLOCK_BYTES + (1 << 17)
    return _powers(usual if n <= usual else 1 << n.bit_length())


def prefix(values: np.ndarray) -> np.ndarray:
    """Sums from which ``between`` takes the hash of any span."""
    rising = _power(len(values) + 1)[0]
    held = values.astype(np.uint64)
    held += np.uint64(1)
    held *= rising[: len(values)]
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(held, out=out[1:])
    return out


def between(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span, equal wherever its values are."""
    falling = _power(len(sums))[1]
    out = sums[ends]
    out -= sums[starts]
    out *= falling[starts]
    return mixed(out)


def between_all(sums: np.ndarray, size: int, starts: np.ndarray) -> np.ndarray:
    """What ``between`` gives for spans of one size that begin nearly everywhere."""
    out = sums[size:] - sums[:-size]
    out *= _power(len(sums))[1][: len(out)]
    return mixed(out[starts])


def mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return between(prefix(data), starts, ends)


def shingles(hashes: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text of each run of ``size`` words; a shorter text with words is one run."""
    count = np.diff(first)
    doc = np.repeat(np.arange(len(count)), count)
    sums = prefix(hashes)
    at = np.arange(len(hashes))
    whole = at + size <= first[1:][doc]
    short = (at == first[:-1][doc]) & (count[doc] < size)
    at = at[whole | short]
    doc = doc[whole | short]
    return between(sums, at, np.minimum(at + size, first[1:][doc])), doc


def distinct_per_text(values: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values and their texts, each value once per text, in order of text and value."""
    order = np.lexsort((values, doc))
    values, doc = values[order], doc[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (doc[1:] != doc[:-1])
    return values[new], doc[new]


def set_keys(values: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.uint64]:
    """Sorted distinct keys of the values of ``n`` texts, and the shift that gives the text.

    A key holds the text and the upper bits of a 64-bit hash: one plain sort, and no fewer
    than 64 - log2(n) bits of the hash.
    """
    bits = np.uint64(max(1, int(n).bit_length()))
    shift = np.uint64(64) - bits
    keys = np.sort((doc.astype(np.uint64) << shift) | (values >> bits))
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    return keys[new], shift


def set_sizes(values: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    keys, shift = set_keys(values, doc, n)
    return np.bincount((keys >> shift).astype(np.int64), minlength=n)


def overlaps(own: tuple, far: tuple, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Sizes of intersection and union of the sets (values, texts) of ``n`` pairs."""
    a, shift = set_keys(*own, n)
    b, _ = set_keys(*far, n)
    both = np.sort(np.concatenate([a, b]))
    again = both[1:][both[1:] == both[:-1]]
    common = np.bincount((again >> shift).astype(np.int64), minlength=n)
    sizes = np.bincount((both >> shift).astype(np.int64), minlength=n)
    return common, sizes - common


def total_per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of per-position values over each text."""
    sums = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=sums[1:])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def minimizers(hashes: np.ndarray, width: int) -> np.ndarray:
    """For each run of ``width`` hashes, the position of its smallest, the leftmost of equals."""
    n = len(hashes)
    if n < width:
        return np.empty(0, np.int64)
    bits = np.uint64(max(1, int(n).bit_length()))
    mask = (np.uint64(1) << bits) - np.uint64(1)
    held = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    held[:n] = (hashes & ~mask) | np.arange(n, dtype=np.uint64)
    rows = held.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    low = np.minimum(behind[: n - width + 1], ahead[width - 1 : n])
    return (low & mask).astype(np.int64)


def strings(column: pa.Array) -> list[str]:
    return pc.fill_null(column.cast(pa.large_string()), "").to_pylist()


def one_permutation(values: np.ndarray, doc: np.ndarray, n: int, bins: int) -> np.ndarray:
    """MinHash signatures by one hash per value: the smallest in each bin of each text.

    Empty bins are densified optimally: bin k tries the bins that a fixed random table
    lists for it until one holds a value, so equal sets of tries borrow equal values. A
    text without values keeps the largest number everywhere.
    """
    empty = np.iinfo(np.uint64).max
    held = np.full(n * bins, empty, np.uint64)
    values = mixed(values)
    place = values >> np.uint64(32)
    place *= np.uint64(bins)
    place >>= np.uint64(32)
    place = place.view(np.int64)
    place += doc * bins
    np.minimum.at(held, place, values)
    out = held.reshape(n, bins).copy()
    cells = np.flatnonzero(held == empty)
    cells = cells[(out != empty).any(axis=1)[cells // bins]]
    rng = np.random.Generator(np.random.PCG64(bins))
    flat = out.ravel()
    while len(cells):
        tries = rng.integers(0, bins, bins)
        at = cells % bins
        lent = held[cells - at + tries[at]]
        flat[cells] = lent
        cells = cells[lent == empty]
    return flat.reshape(n, bins)


def band_keys(signatures: np.ndarray, rows: int) -> np.ndarray:
    """A key for each run of ``rows`` bins, apart for different bands."""
    n, bins = signatures.shape
    bands = bins // rows
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), (n, bands)).copy()
    for k in range(rows):
        key = mixed(key * _BASE + signatures[:, k : bands * rows : rows])
    return key.view(np.int64)


def raw(column: pa.Array) -> memoryview:
    """The bytes of a binary column, one value after the other."""
    wide = pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)
    low, high = at[column.offset], at[column.offset + len(column)]
    return memoryview(data)[low:high]
