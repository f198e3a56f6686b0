import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from smeltery.llm import arrays, packing

TEXTS = [
    "Hello, World! don't STOP 3.14 and 2024",
    "",
    None,
    "é É naïve ÷× “quoted” — dash́ x́ ﬁ ½ ß µ",
    "a b c　d e\tf\ng\r\nh\x0bi\x0cj",
    "''s 's ''' it's'the !'s Ω σς İI",
    "word " * 3000,
    "日本語 テキスト 한국어",
    "tokens\x00with\x00zeros __init__ a_b-c/d",
    "don't word Don't WORD",
]


def direct(text):
    tokenizer = Tokenizer.from_file(packing.tokenizer_path())
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, packing.CLOSING]


def check(rows, texts, size):
    by_doc, by_window = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_window.setdefault(r.sequence_id, []).append(r)
    assert sorted(by_doc) == list(range(len(texts)))
    for doc, pieces in by_doc.items():
        ids, at = direct(texts[doc]), 0
        for r in sorted(pieces, key=lambda r: r.start):
            own = ids[r.start : r.start + r.length]
            assert r.start == at and r.doc_tokens == len(ids) and len(own) == r.length > 0
            assert r.ids_crc32 == zlib.crc32(np.array(own, "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    fills = []
    for pieces in by_window.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= size
        fills.append(at)
    return fills


@pytest.mark.parametrize("size", [8, 64, 4096])
@pytest.mark.parametrize("most_open", [2, 512])
def test_every_id_lies_in_one_piece_and_windows_are_gapless(documents, size, most_open):
    rows = packing.pack(documents(TEXTS * 3), size=size, most_open=most_open).collect()
    fills = check(rows, TEXTS * 3, size)
    assert all(f == size or f & (f - 1) == 0 for f in fills)


def test_ids_come_with_the_pieces(documents):
    for r in packing.pack(documents(TEXTS), with_ids=True).collect():
        assert r.ids == direct(TEXTS[r.doc_id])[r.start : r.start + r.length]


def test_words_are_encoded_as_in_their_text():
    import pyarrow as pa

    encoder = packing.Encoder(packing.tokenizer_path())
    flat, first = encoder.encode(arrays.words(*arrays.texts(pa.array(TEXTS, pa.string()))))
    for k, text in enumerate(TEXTS):
        assert flat[first[k] : first[k + 1]].tolist() == direct(text)[:-1]


ADDED = [
    "a <|endoftext|> b",
    "Plain words",
    "<|startoftext|>Hello<|ENDOFTEXT|> don't<|EndOfText|>'s",
    "don't<|endoftext|>'S 'T<|STARTOFTEXT|>",
    "e<|endoftext|>\u0301  <|endoftext|>",
    "<|endof",
    "text|> <|endoftext |>",
    "",
    None,
    "日<|ENDOFTEXT|>本 <|endoftext|><|endoftext|>",
    "\"it's<|ENDOFTEXT|>\"",
    "word " * 300 + "<|endoftext|>",
]


@pytest.mark.parametrize("size", [8, 4096])
def test_added_tokens_are_matched_in_the_raw_text(documents, size):
    check(packing.pack(documents(ADDED * 2), size=size).collect(), ADDED * 2, size)


def test_added_tokens_that_match_normalized_text(tmp_path):
    import pyarrow as pa
    from tokenizers import AddedToken

    tokenizer = Tokenizer.from_file(packing.tokenizer_path())
    tokenizer.add_tokens([AddedToken("two words", normalized=True)])
    tokenizer.save(f"{tmp_path}/t.json")
    texts = ["Two\t WORDS", None, "two", "words"]
    encoder = packing.Encoder(f"{tmp_path}/t.json")
    flat, first = encoder.encode(arrays.words(*arrays.texts(pa.array(texts, pa.string()))))
    for k, text in enumerate(texts):
        want = tokenizer.encode(text or "", add_special_tokens=False).ids
        assert flat[first[k] : first[k + 1]].tolist() == want


def test_the_level_that_lowers_the_sum_of_squares_is_chosen():
    rng = np.random.default_rng(3)
    packer = packing.Packer(50, 10_000, 0)
    for s in rng.integers(1, 50, 400).tolist():
        levels = packer.levels.copy()

        def after(level, s=s, levels=levels):
            moved = levels.copy()
            if level:
                moved[level] -= 1
            moved[level + s] += 1
            return (moved[1:50] ** 2).sum()

        options = [0, *(h for h in range(1, 51 - s) if levels[h])]
        assert after(packer._best(s)) == min(map(after, options))
        list(packer.place(packing.Piece(0, 0, np.zeros(s, np.uint32), s)))


def test_odd_rows(spark, documents):
    assert packing.pack(documents([])).count() == 0
    rows = [(None, "a b", "en"), (None, "a b", "en"), (5, None, None)]
    odd = documents(rows).withColumnRenamed("source", "start").withColumnRenamed("lang", "ids")
    found = packing.pack(odd).collect()
    assert sum(r.length for r in found) == 7 and {r.doc_tokens for r in found} == {1, 3}
