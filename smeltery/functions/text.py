"""Text conforming: any Unicode text to letters, digits, spaces and ``_``."""

from __future__ import annotations

import codecs
import unicodedata
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The characters that stay, and the one that replaces the rest.
KEPT = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789 ")
REPLACEMENT = "_"


# What each byte of ASCII text becomes.
_BYTES = bytes(b if chr(b) in KEPT else ord(REPLACEMENT) for b in range(256))

# Name under which the rule for other characters is registered as an encoding error.
_BEYOND_ASCII = "smeltery.beyond_ascii"


class _Cleaned(dict):
    """Clean form of a code point beyond ASCII, learned when first met.

    Compatibility decomposition works on single characters and reordering only
    moves combining marks, which go anyway, so a string cleans to the joined
    clean forms of its characters.
    """

    def __missing__(self, code: int) -> str:
        parts = unicodedata.normalize("NFKD", chr(code))
        self[code] = "".join(
            p if p in KEPT else REPLACEMENT for p in parts if not unicodedata.combining(p)
        )
        return self[code]


def _register() -> None:
    """Make encoding to ASCII clean what ASCII lacks."""
    table = _Cleaned()

    def clean_run(error: UnicodeEncodeError) -> tuple[str, int]:
        start, end = error.start, error.end
        if end - start == 1:
            return table[ord(error.object[start])], end
        return error.object[start:end].translate(table), end

    codecs.register_error(_BEYOND_ASCII, clean_run)


def _clean_batch(batch: pa.Array) -> pa.Array:
    """Clean the distinct values of a batch: few rows in Python, all bytes in one call."""
    coded = batch.dictionary_encode()
    texts = coded.dictionary
    if len(texts) == 0:
        return batch
    beyond = pc.invert(pc.string_is_ascii(texts))
    if pc.any(beyond).as_py():
        rows = texts.filter(beyond).to_pylist()
        ascii_rows = [row.encode("ascii", _BEYOND_ASCII).decode("ascii") for row in rows]
        texts = pc.replace_with_mask(texts, beyond, pa.array(ascii_rows, texts.type))
    _, offsets, data = texts.buffers()
    cleaned = pa.py_buffer(data.to_pybytes().translate(_BYTES))
    texts = pa.Array.from_buffers(
        texts.type, len(texts), [None, offsets, cleaned], offset=texts.offset
    )
    return texts.take(coded.indices)


@F.arrow_udf(T.StringType())
def _clean_batches(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    _register()
    for batch in batches:
        yield _clean_batch(batch)


# Declared non-deterministic so that a later filter on the cleaned column reuses
# the projected value; otherwise the optimizer pushes a second evaluation below
# it. Filters on raw columns must therefore be placed before the cleaning.
_clean_once = _clean_batches.asNondeterministic()


def clean_text(column: Column | str) -> Column:
    """ASCII form of a text column; null stays null.

    Bytes that are not UTF-8 count as unknown characters instead of ending the job.
    """
    return _clean_once(F.make_valid_utf8(column))


def upper_clean(column: Column | str) -> Column:
    """Upper-case ASCII form of a text column."""
    return F.upper(clean_text(column))


def clean_together(columns: Sequence[str]) -> Column:
    """A struct of the ASCII forms of several columns, in one trip to Python."""
    fields = [T.StructField(c, T.StringType()) for c in columns]

    @F.arrow_udf(T.StructType(fields))
    def clean_rows(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        _register()
        for batch in batches:
            yield pa.StructArray.from_arrays([_clean_batch(c) for c in batch], columns)

    return clean_rows.asNondeterministic()(
        *[F.make_valid_utf8(f"`{c}`") for c in columns]
    )
