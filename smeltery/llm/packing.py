"""Packing documents into training windows by the sum-of-squares rule, online.

A document is its token ids and one closing id. What exceeds a window is cut off in whole
windows. The rest is placed, as it arrives, where the sum over fill levels of the squared
number of partially filled windows grows least; a level array holds these numbers. Each
task packs the rows it reads, with an array and open windows of its own: no shuffle, and
memory bounded by ``most_open`` windows. When more are open, and at the end, the emptiest
windows are cut up to fill the fullest; what is left over at the end is cut at powers of
two, which need no padding.

A null text is an empty one: its document has the closing id only. Rows with a null or a
repeated id are documents of their own. An empty table gives no rows. Tokens of a word do
not depend on its neighbours, so words are encoded once per task while they are remembered.
Added tokens of the tokenizer are matched in the raw text, so texts that hold one go whole.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smeltery.llm import arrays
from smeltery.llm.shared import small_batches

WINDOW = 4096
CLOSING = 2
_REMEMBERED = 600_000
_AT_ONCE = 4_000

_KIND = np.full(256, 3, np.uint8)
_KIND[arrays.SPACE] = 0
_KIND[97:123] = _KIND[65:91] = _KIND[128:] = 1
_KIND[48:58] = 2


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class Encoder:
    """Ids of whole blocks of texts, for a tokenizer that parts words at white space."""

    def __init__(self, path: str):
        # One thread: a task has one core, and threads would keep memory of their own.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = list(self.tokenizer.get_added_tokens_decoder().values())
        self.added = [arrays.LOWER[np.frombuffer(t.content.encode(), np.uint8)].tobytes() for t in added if t.content]
        # Where tokens are matched after normalization, bytes do not tell which texts hold one.
        self.all_whole = any(t.normalized for t in added)
        # A word of plain letters may go straight to the model, if that gives the same ids.
        letters = "abcdefghijklmnopqrstuvwxyz"
        probes = [*letters, *(a + b for a in letters for b in letters), "internationalization", letters * 3]
        whole = self.tokenizer.encode_batch_fast(probes, add_special_tokens=False)
        tokenize = self.tokenizer.model.tokenize
        self.direct = all(e.ids == [t.id for t in tokenize(p)] for e, p in zip(whole, probes, strict=True))
        self._forget()

    def _forget(self) -> None:
        self.known: dict[int, int] = {}
        self.begin = np.zeros(0, np.int64)
        self.count = np.zeros(0, np.int64)
        self.pool = np.zeros(0, np.uint32)

    def _learn(self, hashes: list[int], values: list[str]) -> None:
        ids: list[list[int]] = [[]] * len(values)
        tokenize, rest = self.tokenizer.model.tokenize, []
        for k, value in enumerate(values):
            if self.direct and value.isascii() and value.isalpha():
                ids[k] = [t.id for t in tokenize(value)]
            else:
                rest.append(k)
        for low in range(0, len(rest), _AT_ONCE):
            some = rest[low : low + _AT_ONCE]
            found = self.tokenizer.encode_batch_fast([values[k] for k in some], add_special_tokens=False)
            for k, e in zip(some, found, strict=True):
                ids[k] = e.ids
        count = np.fromiter(map(len, ids), np.int64, len(ids))
        self.known.update(zip(hashes, range(len(self.count), len(self.count) + len(ids))))
        begin = len(self.pool) + np.cumsum(count) - count
        flat = np.fromiter((i for x in ids for i in x), np.uint32, int(count.sum()))
        self.begin = np.concatenate([self.begin, begin])
        self.count = np.concatenate([self.count, count])
        self.pool = np.concatenate([self.pool, flat])

    def encode(self, w: arrays.Words) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, and where those of each text begin, with the end last."""
        lowered = arrays.LOWER[w.data]
        whole = self._whole(w, lowered)
        starts, ends = _pieces(w)
        if len(whole):
            cut = ~np.isin(np.searchsorted(w.offsets, starts, "right") - 1, whole)
            starts, ends = starts[cut], ends[cut]
        hashes = arrays.hash_spans(lowered, starts, ends)
        distinct, at, which = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.known) + len(distinct) > _REMEMBERED:
            self._forget()
        keys = distinct.tolist()
        new = [k for k, h in enumerate(keys) if h not in self.known]
        if new:
            raw, spans = lowered.tobytes(), zip(starts[at[new]].tolist(), ends[at[new]].tolist())
            values = [raw[a:b].decode("utf-8", "replace") for a, b in spans]
            self._learn([keys[k] for k in new], values)
        place = np.array(list(map(self.known.__getitem__, keys)), np.int64)[which]
        count = self.count[place]
        before = np.concatenate([[0], np.cumsum(count)])
        flat = np.repeat(self.begin[place] - before[:-1], count) + np.arange(before[-1])
        first = before[np.searchsorted(starts, w.offsets)]
        return self._with_whole(w, whole, self.pool[flat], first)

    def _whole(self, w: arrays.Words, lowered: np.ndarray) -> np.ndarray:
        """The texts that hold an added token, in any case of its letters: pieces are lower-cased."""
        if self.all_whole:
            return np.arange(len(w.offsets) - 1)
        raw, found = lowered.tobytes(), set()
        for content in self.added:
            at = raw.find(content)
            while at >= 0:
                k = int(np.searchsorted(w.offsets, at, "right")) - 1
                # What begins in one text and ends in the next is no token.
                if at + len(content) <= w.offsets[k + 1]:
                    found.add(k)
                    at = int(w.offsets[k + 1]) - 1
                at = raw.find(content, at + 1)
        return np.array(sorted(found), np.int64)

    def _with_whole(
        self, w: arrays.Words, whole: np.ndarray, flat: np.ndarray, first: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """Put the ids of the texts that were left out between the others."""
        if not len(whole):
            return flat, first
        texts = [w.data[w.offsets[k] : w.offsets[k + 1]].tobytes().decode("utf-8", "replace") for k in whole]
        ids = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        count = np.zeros(len(first), np.int64)
        count[whole + 1] = [len(x) for x in ids]
        own = np.fromiter((i for x in ids for i in x), np.uint32, int(count.sum()))
        return np.insert(flat, np.repeat(first[whole], count[whole + 1]), own), first + np.cumsum(count)


@cache
def encoder(path: str) -> Encoder:
    """The encoder of this process, which later tasks use again."""
    return Encoder(path)


def _pieces(w: arrays.Words) -> tuple[np.ndarray, np.ndarray]:
    """Spans that are encoded apart from each other: runs of letters, digits or marks.

    Words with an apostrophe, or with characters beyond Latin-1 letters, stay whole.
    """
    data, n = w.data, len(w.data)
    if not n:
        return w.starts, w.ends
    odd = data >= 0x80
    if odd.any():
        latin = data == 0xC3
        follows = np.zeros(n, bool)
        follows[1:] = latin[:-1] & (data[1:] != 0x97) & (data[1:] != 0xB7)
        odd &= ~latin & ~follows
    odd |= data == 0x27
    kind = _KIND[data]
    cut = np.zeros(n + 1, bool)
    cut[1:n] = (kind[1:] != kind[:-1]) & (kind[1:] > 0) & (kind[:-1] > 0)
    for k in np.unique(np.searchsorted(w.starts, np.flatnonzero(odd), "right") - 1):
        cut[w.starts[k] : w.ends[k]] = False
    starts, ends = cut.copy(), cut
    starts[w.starts] = True
    # A word may begin where a text without white space before it ends.
    ends[w.starts] = False
    ends[w.ends] = True
    return np.flatnonzero(starts), np.flatnonzero(ends)


@dataclass
class Piece:
    doc: object
    start: int
    ids: np.ndarray
    doc_tokens: int


@dataclass
class Window:
    number: int
    fill: int = 0
    pieces: list[Piece] = field(default_factory=list)

    def add(self, piece: Piece) -> None:
        self.pieces.append(piece)
        self.fill += len(piece.ids)


class Packer:
    """Open windows by fill level, and how many there are at each level."""

    def __init__(self, size: int, most_open: int, first_number: int):
        self.size, self.most_open, self.number = size, most_open, first_number
        self._clear()

    def _clear(self) -> None:
        self.levels = np.zeros(self.size + 1, np.int64)
        self.open: dict[int, list[Window]] = {}
        self.n_open = 0

    def _window(self) -> Window:
        self.number += 1
        return Window(self.number - 1)

    def _best(self, s: int) -> int:
        """The level whose window, with ``s`` more, lowers the sum of squares most; 0 is a
        new window. Of equals the fullest."""
        levels = self.levels
        here = levels[1 : self.size - s + 1]
        if not len(here):
            return 0
        growth = 2 * (levels[s + 1 : self.size + 1] - here) + 2
        growth[-1] = 1 - 2 * here[-1]  # a full window leaves the sum
        growth = np.where(here > 0, growth, np.iinfo(np.int64).max)
        best = len(growth) - 1 - int(np.argmin(growth[::-1]))
        return best + 1 if growth[best] <= 2 * levels[s] + 1 else 0

    def place(self, piece: Piece) -> Iterator[Window]:
        """Put a piece into a window; yields windows that are done."""
        s = len(piece.ids)
        level = self._best(s) if s < self.size else 0
        if level:
            window = self.open[level].pop()
            self.levels[level] -= 1
            self.n_open -= 1
        else:
            window = self._window()
        window.add(piece)
        if window.fill == self.size:
            yield window
            return
        self._keep(window)
        if self.n_open > self.most_open:
            yield from self._settle()

    def _keep(self, window: Window) -> None:
        self.open.setdefault(window.fill, []).append(window)
        self.levels[window.fill] += 1
        self.n_open += 1

    def _settle(self) -> Iterator[Window]:
        """Fill the fullest windows with cut pieces of the emptiest; one may stay open."""
        held = [x for level in sorted(self.open, reverse=True) for x in self.open[level]]
        self._clear()
        low, high = 0, len(held) - 1
        while low < high:
            target, source = held[low], held[high]
            piece = source.pieces.pop()
            taken = min(self.size - target.fill, len(piece.ids))
            rest = len(piece.ids) - taken
            source.fill -= taken
            target.add(Piece(piece.doc, piece.start + rest, piece.ids[rest:], piece.doc_tokens))
            if rest:
                source.pieces.append(Piece(piece.doc, piece.start, piece.ids[:rest], piece.doc_tokens))
            if target.fill == self.size:
                yield target
                low += 1
            if not source.pieces:
                high -= 1
        if low == high and held[low].fill:
            self._keep(held[low])

    def finish(self) -> Iterator[Window]:
        """Close all windows; the last one is cut at powers of two."""
        yield from self._settle()
        for level in list(self.open):
            for window in self.open[level]:
                pieces = window.pieces
                while pieces:
                    fill = sum(len(p.ids) for p in pieces)
                    part, room = self._window(), 1 << (fill.bit_length() - 1)
                    while part.fill < room:
                        p = pieces.pop(0)
                        n = min(room - part.fill, len(p.ids))
                        part.add(Piece(p.doc, p.start, p.ids[:n], p.doc_tokens))
                        if n < len(p.ids):
                            pieces.insert(0, Piece(p.doc, p.start + n, p.ids[n:], p.doc_tokens))
                    yield part
        self._clear()


def pack(
    docs: DataFrame,
    path: str | None = None,
    size: int = WINDOW,
    most_open: int = 512,
    with_ids: bool = False,
) -> DataFrame:
    """A row per piece of a document of ``docs`` (doc_id, text): its place in the document
    and in its window, and with ``with_ids`` its ids."""
    small_batches(docs.sparkSession)
    where = path or tokenizer_path()
    kind = docs.schema["doc_id"].dataType
    schema = pa.schema(
        [("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
        + [("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())]
        + [("ids", pa.list_(pa.int32()))] * with_ids
    )

    def rows(windows: list[Window], doc_type: pa.DataType) -> pa.RecordBatch:
        columns: list[list] = [[] for _ in range(8)]
        for window in windows:
            offset = 0
            for p in window.pieces:
                crc = zlib.crc32(p.ids.astype("<u4").tobytes())
                row = (p.doc, p.start, len(p.ids), crc, p.doc_tokens, window.number, offset)
                for column, value in zip(columns, row, strict=False):
                    column.append(value)
                if with_ids:
                    columns[7].append(p.ids.astype(np.int32))
                offset += len(p.ids)
        types = [doc_type, *(f.type for f in schema)]
        names = ["doc_id", *schema.names]
        held = [pa.array(c, t) for c, t in zip(columns, types, strict=False)]
        return pa.RecordBatch.from_arrays(held, names=names)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(where)
        packer = Packer(size, most_open, TaskContext.get().partitionId() << 40)
        done: list[Window] = []
        doc_type = None
        for batch in batches:
            doc_type = batch.schema.field("doc_id").type
            for low, high in arrays.blocks(batch.column("text")):
                part = batch.slice(low, high - low)
                w = arrays.words(*arrays.texts(part.column("text")))
                flat, first = own.encode(w)
                closing = np.array([CLOSING], np.uint32)
                for k, doc in enumerate(part.column("doc_id").to_pylist()):
                    ids = np.concatenate([flat[first[k] : first[k + 1]], closing])
                    for start in range(0, len(ids), size):
                        piece = Piece(doc, start, ids[start : start + size], len(ids))
                        done.extend(packer.place(piece))
                if len(done) >= 256:
                    yield rows(done, doc_type)
                    done = []
        done.extend(packer.finish())
        if done:
            yield rows(done, doc_type)

    fields = ["start long", "length long", "ids_crc32 long", "doc_tokens long"]
    fields += ["sequence_id long", "offset long"] + ["ids array<int>"] * with_ids
    shape = ", ".join([f"doc_id {kind.simpleString()}", *fields])
    return docs.select(F.col("doc_id"), F.col("text")).mapInArrow(packed, shape)
