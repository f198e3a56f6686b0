import random

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from brute import LOWER, components, corpus, edited, prose, words
from pyspark.sql import functions as F

from smeltery.llm import simhash


def fingerprint(text):
    found = [w.translate(LOWER) for w in words(text)]
    runs = [found] if 0 < len(found) < 3 else [found[k : k + 3] for k in range(len(found) - 2)]
    hashes = [xxhash.xxh64_intdigest(b" ".join(run), seed=42) for run in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def linked(prints, distance=2):
    nodes = sorted(prints)
    for i, a in enumerate(nodes):
        for b in nodes[i + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= distance:
                yield a, b


def check(rows, texts):
    prints = {k: fingerprint(t) for k, t in enumerate(texts)}
    want = components(linked(prints), prints)
    assert len(rows) == len(texts)
    for r in rows:
        assert r.fingerprint == f"{prints[r.doc_id]:016x}"
        assert r.component_id == want[r.doc_id]


@pytest.mark.parametrize("parts, limit", [(1, 1024), (7, 4)])
def test_components_are_those_of_all_links(documents, parts, limit):
    rng = random.Random(2)
    base = prose(rng, 400)
    texts = corpus(5) + [edited(rng, base, 1 + k % 3) for k in range(60)]
    docs = documents(texts).repartition(parts)
    check(simhash.marked(docs, limit=limit).collect(), texts)


def test_hashes_are_those_of_spark(spark, documents):
    runs = ["a b c", "é ü", "x" * 100, "one two three"]
    rows = spark.createDataFrame([(r,) for r in runs], "r string").select(F.xxhash64("r").alias("h")).collect()
    assert [x.h % (1 << 64) for x in rows] == [fingerprint(r.replace(" ", "  ")) if len(words(r)) < 4 else 0 for r in runs]


@pytest.mark.parametrize("distance, blocks, limit", [(2, 4, 8), (2, 3, 8), (1, 2, 5), (3, 6, 8)])
def test_no_link_is_lost_however_buckets_are_parted(spark, distance, blocks, limit):
    rng = np.random.default_rng(4)
    seeds = rng.integers(0, 1 << 63, 6, dtype=np.uint64)
    flips = [np.uint64(sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 5), replace=False))) for _ in range(400)]
    values = sorted({int(rng.choice(seeds) ^ f) for f in flips} | {(1 << 64) - 1, 0, 3})
    rows = [(v - (1 << 64) if v >> 63 else v, k) for k, v in enumerate(values)]
    classes = spark.createDataFrame(rows, "fingerprint long, node long")
    found = simhash.links(classes, distance, blocks, limit).collect()
    for r in found:
        assert r.doc > r.to_doc
    nodes = dict(enumerate(values))
    want = components(linked(nodes, distance), nodes)
    assert components([(r.doc, r.to_doc) for r in found], nodes) == want


def test_bits_of_many_runs():
    rng = np.random.default_rng(1)
    sizes = [0, 1, 254, 255, 256, 0, 700, 2]
    hashes = rng.integers(0, 1 << 63, sum(sizes), dtype=np.uint64) * np.uint64(2)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    got = simhash.bits_of(hashes, doc, len(sizes))
    for k, n in enumerate(sizes):
        own = [int(h) for h in hashes[doc == k]]
        assert int(got[k]) == sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in own) > n)


def test_odd_rows(documents):
    assert simhash.marked(documents([])).collect() == []
    text = "one two three four"
    rows = [(7, text, "en"), (7, "other words here now", "en"), (None, text, "en"), (9, "OTHER words\there  now", None)]
    rows += [(3, text.upper(), None), (12, None, "en"), (11, "", "en"), (10, " \n", "en"), (5, "z " * 200_000, "en")]
    odd = documents(rows).withColumnRenamed("lang", "component_id").withColumnRenamed("source", "fingerprint")
    got = {(r.doc_id, r.fingerprint, r.component_id) for r in simhash.marked(odd.withColumn("node", F.lit(1))).collect()}
    f = lambda t: f"{fingerprint(t):016x}"
    assert got == {
        (7, f(text), 3),
        (7, f("other words here now"), 3),
        (None, f(text), None),
        (9, f("other words here now"), 3),
        (3, f(text), 3),
        (12, "0" * 16, 10),
        (11, "0" * 16, 10),
        (10, "0" * 16, 10),
        (5, f("z z z"), 5),
    }


def test_a_column_in_blocks(monkeypatch):
    rng = random.Random(3)
    texts = [prose(rng, rng.randrange(0, 40)) for _ in range(50)]
    want = [fingerprint(t) for t in texts]
    assert simhash.fingerprints(pa.array(texts)).tolist() == want
