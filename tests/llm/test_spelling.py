import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from brute import LOWER
from pyspark.sql import functions as F

from smeltery.llm import spelling


def known(rows, least=7):
    total = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = run.encode().translate(LOWER).decode()
            crc = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if crc % 31 == 0:
                word = word[: crc % len(word)] + word[crc % len(word) + 1 :]
            if len(word) >= least:
                total[word] += 1
    return {w: n for w, n in total.items() if n >= 2}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) - len(a) == 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def plain(words):
    told = {}
    for w, n in words.items():
        others = [x for x in words if near(w, x)]
        best = min(others, key=lambda x: (-words[x], x), default=None)
        form = best if best is not None and words[best] >= 10 * n else None
        told[w] = (form, n, len(others), words[form] if form else None)
    out = set()
    for w, (form, n, n_near, form_n) in told.items():
        root = w
        while told[root][0] is not None:
            root = told[root][0]
        out.add((w, form, root, n, n_near, form_n))
    return out


def changed(rng, word):
    k, letter = rng.randrange(len(word)), rng.choice("abcdeé")
    return rng.choice([word[:k] + word[k + 1 :], word[:k] + letter + word[k:], word[:k] + letter + word[k + 1 :]])


def vocabulary(seed, n):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abcdeéöst") for _ in range(rng.randrange(7, 13))) for _ in range(n)]
    words = list(base)
    for _ in range(3 * n):
        words.append(changed(rng, rng.choice(words)))
    return rng, words


def test_words_forms_and_roots(documents):
    rng, words = vocabulary(3, 60)
    texts = [" ".join(rng.choice([words[0], words[1], *words])[:40].title() for _ in range(120)) for _ in range(60)]
    texts += [" ".join([words[0]] * 900), " ".join([changed(rng, words[0])] * 70), "abc-DEFGHIJKL_÷×abcdefg" * 3]
    rows = list(enumerate(texts))
    docs = documents([(k, t, "en") for k, t in rows]).repartition(4)
    got = {tuple(r) for r in spelling.grouped(docs).select("word", "form", "root", "n", "n_near", "form_n").collect()}
    want = plain(known(rows))
    assert len(want) > 100 and any(x[1] for x in want)
    assert got == want


@pytest.mark.parametrize("depth, limit, queries", [(1, 90, 64), (3, 200, 1000), (8, 30, 500)])
def test_however_the_trie_is_parted(spark, depth, limit, queries):
    rng, words = vocabulary(depth, 70)
    words = {w: 2 + rng.randrange(60) ** 2 for w in words if len(w) >= 7}
    # Words of the same letters, words with a hundred equal ones, and one of many thousand.
    words |= {"".join(rng.sample("aabbcdee", 8)): 5 for _ in range(40)}
    words |= {"aé" * 300: 9, "aé" * 300 + "e": 900, "ab" * 9000: 3, "ab" * 8999 + "a": 30, "a" * 254: 4, "a" * 255: 5, "a" * 256: 6}
    known = spark.createDataFrame(list(words.items()), "word string, n long").repartition(3)
    found = spelling.neighbours(known, limit, queries, depth).collect()
    want = {}
    for w in words:
        others = [x for x in words if near(w, x)]
        if others:
            best = min(others, key=lambda x: (-words[x], x))
            want[w] = (len(others), words[best], best)
    assert {r.word: (r.n_near, r.best_n, r.best) for r in found} == want


def test_pairs_of_words():
    rng, words = vocabulary(9, 40)
    words += ["a" * 31, "a" * 32, "a" * 33, "a" * 34, "a" * 31 + "b", "aab", "ab", "a"]
    latin = [w.encode("latin-1") for w in words]
    x, y = (v.ravel() for v in np.indices((len(words), len(words))))
    got = spelling.near(latin, latin, x, y)
    for a, b, one in zip(x.tolist(), y.tolist(), got.tolist()):
        assert one == near(words[a], words[b]) == spelling.one_edit(latin[a], latin[b])


def test_odd_rows(spark, documents):
    assert spelling.grouped(documents([])).collect() == []
    assert spelling.grouped(documents([None, "", "kurz", "einmalig"])).collect() == []
    rows = [(None, "Straßen STRAßEN"), (4, "straßen  naïveté"), (4, "straßen  naïveté"), (5, "x" * 100_000 + " " + "x" * 100_000)]
    docs = documents([(k, t, "en") for k, t in rows])
    for name in ("word", "n", "path", "member", "salt"):
        docs = docs.withColumn(name, F.lit("q"))
    assert {tuple(r) for r in spelling.grouped(docs).select("word", "form", "root", "n", "n_near", "form_n").collect()} == plain(known(rows))
