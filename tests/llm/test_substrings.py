import hashlib

import numpy as np
import pytest
from brute import corpus, words

from smeltery.llm import suffix_array, suffix_trees


def sha(raw):
    return hashlib.sha256(raw).hexdigest()


def words_left(texts, size=20):
    seen, out = set(), {}
    for doc, text in enumerate(texts):
        found = words(text)
        covered = [False] * len(found)
        for k in range(len(found) - size + 1):
            window = tuple(found[k : k + size])
            if window in seen:
                covered[k : k + size] = [True] * size
            seen.add(window)
        out[doc] = found, [w for w, c in zip(found, covered, strict=True) if not c]
    return out


def bytes_covered(texts, size):
    raws = [(t or "").encode() for t in texts]
    count = {}
    for raw in raws:
        for k in range(len(raw) - size + 1):
            count[raw[k : k + size]] = count.get(raw[k : k + size], 0) + 1
    out = []
    for raw in raws:
        covered = np.zeros(len(raw), bool)
        for k in range(len(raw) - size + 1):
            if count[raw[k : k + size]] > 1:
                covered[k : k + size] = True
        out.append((raw, covered))
    return out


@pytest.mark.parametrize(("parts", "group"), [(1, 10_000), (5, 10_000), (1, 2), (5, 2)])
def test_windows_of_words_that_stand_earlier_go(documents, parts, group):
    texts = corpus(6)
    docs = documents(texts).repartition(parts)
    rows = suffix_trees.deduplicated(docs, group=group).collect()
    want = words_left(texts)
    assert len(rows) == len(texts)
    for r in rows:
        found, left = want[r.doc_id]
        assert (r.n_words, r.n_removed) == (len(found), len(found) - len(left))
        assert r.kept_sha256 == sha(b" ".join(left)) and r.text.encode() == b" ".join(left)


@pytest.mark.parametrize(("parts", "group"), [(1, 10_000), (5, 10_000), (1, 2), (5, 2)])
def test_strings_of_bytes_that_stand_elsewhere_go(documents, parts, group):
    texts = [t if t is None else t[:3_000] for t in corpus(7, families=4)]
    docs = documents(texts).repartition(parts)
    rows = suffix_array.deduplicated(docs, group=group).collect()
    want = bytes_covered(texts, 200)
    assert len(rows) == len(texts)
    for r in rows:
        raw, covered = want[r.doc_id]
        left = bytes(np.frombuffer(raw, np.uint8)[~covered])
        runs = int((np.diff(np.concatenate([[0], covered.astype(int)])) == 1).sum())
        assert (r.n_bytes, r.n_removed, r.n_spans) == (len(raw), int(covered.sum()), runs)
        assert r.kept_sha256 == sha(left) and bytes(r.kept) == left


def test_suffixes_are_sorted_by_difference_cover():
    rng = np.random.default_rng(0)
    for _ in range(200):
        text = rng.integers(1, rng.integers(2, 5), rng.integers(1, 60))
        rank = suffix_array.ranks(text, 10**6)
        order = sorted(range(len(text)), key=lambda k: text[k:].tolist())
        assert np.argsort(rank).tolist() == order


def test_repeats_of_any_length():
    rng = np.random.default_rng(1)
    for length in (8, 9, 15, 16, 40):
        for _ in range(40):
            text = rng.integers(0, 3, 200).astype(np.uint8)
            at = int(rng.integers(0, 100))
            text[100 : 100 + length] = text[at : at + length]
            starts = np.arange(0, 200 - length + 1)
            strings = [text[k : k + length].tobytes() for k in starts]
            want = [strings.count(s) > 1 for s in strings]
            assert suffix_array.repeats(text, starts, length).tolist() == want


def test_odd_rows(documents):
    text = " ".join(f"word{k}" for k in range(60))
    rows = [(2, text, "en"), (2, text, "en"), (None, text, None), (1, None, "en"), (3, f"{text} end", "en")]
    odd = documents(rows).withColumnRenamed("lang", "gone").withColumnRenamed("source", "low")
    by_words = sorted((r.doc_id or 0, r.n_removed) for r in suffix_trees.deduplicated(odd).collect())
    assert by_words == [(0, 0), (1, 0), (2, 0), (2, 0), (3, 60)]
    by_bytes = sorted((r.doc_id or 0, r.n_removed) for r in suffix_array.deduplicated(odd).collect())
    n = len(text)
    assert by_bytes == [(0, 0), (1, 0), (2, n), (2, n), (3, n)]
    for operator in (suffix_trees, suffix_array):
        assert operator.deduplicated(documents([])).collect() == []
