import random

import numpy as np
import pytest
from brute import components, corpus, edited, prose, similar, words, LOWER

from smeltery.llm import clusters, near_duplicates


def shingles(text, size=4):
    found = [w.translate(LOWER) for w in words(text)]
    if len(found) < size:
        return {tuple(found)} if found else set()
    return {tuple(found[k : k + size]) for k in range(len(found) - size + 1)}


def check(rows, texts, size=4):
    sets = {k: shingles(t, size) for k, t in enumerate(texts)}
    want = components(similar(sets), sets)
    assert len(rows) == len(texts)
    for r in rows:
        assert r.n_shingles == len(sets[r.doc_id])
        assert r.component_id == want[r.doc_id], (texts[r.doc_id] or "")[:80]
        assert r.kept == (r.doc_id == want[r.doc_id])


@pytest.mark.parametrize("parts", [1, 9])
def test_components_are_those_of_all_links(documents, parts):
    texts = corpus(3)
    check(near_duplicates.marked(documents(texts).repartition(parts)).collect(), texts)


def test_a_large_group_with_drifting_copies(documents):
    rng = random.Random(5)
    base = prose(rng, 150)
    texts = [base] * 40
    for _ in range(120):
        texts.append(edited(rng, rng.choice(texts), rng.randrange(1, 7)))
    check(near_duplicates.marked(documents(texts).repartition(7)).collect(), texts)


def test_five_words(documents):
    texts = corpus(8, families=3)
    check(near_duplicates.marked(documents(texts), size=5).collect(), texts, 5)


def test_odd_rows(spark, documents):
    assert near_duplicates.marked(documents([])).collect() == []
    text = "one two three four five six"
    rows = [(7, text, "en"), (7, text, "en"), (None, text, "en"), (3, text.upper(), None), (9, None, "en")]
    odd = documents(rows).withColumnRenamed("lang", "component_id").withColumnRenamed("source", "kept")
    got = sorted((r.doc_id is None, r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_duplicates.marked(odd).collect())
    assert got == [
        (False, 3, 3, 3, True),
        (False, 7, 3, 3, False),
        (False, 7, 3, 3, False),
        (False, 9, 0, 9, True),
        (True, None, 3, None, True),
    ]


def test_equal_texts_are_not_fetched_to_be_compared(documents, monkeypatch):
    rng = random.Random(3)
    base = prose(rng, 60)
    texts = [base] * 30 + [edited(rng, base, 1)] * 2
    compared, linked = [], clusters.linked

    def counted(pairs, compare, *more):
        def fewer(pairs, *texts):
            compared.append(pairs.count())
            return compare(pairs, *texts)

        return linked(pairs, fewer, *more)

    monkeypatch.setattr(clusters, "linked", counted)
    check(near_duplicates.marked(documents(texts).repartition(5)).collect(), texts)
    assert sum(compared) <= 10


def test_copies_of_a_text_take_no_part_in_linking(documents, monkeypatch):
    rng = random.Random(4)
    base = prose(rng, 60)
    texts = [base] * 30 + [edited(rng, base, 1)] * 20 + [base.upper()] * 10
    seen, missed = [], clusters._missed

    def counted(pairs, *more):
        seen.append(clusters.nodes(pairs).count())
        return missed(pairs, *more)

    monkeypatch.setattr(clusters, "_missed", counted)
    check(near_duplicates.marked(documents(texts).repartition(5)).collect(), texts)
    assert seen == [3]


def test_an_id_of_several_texts_links_through_each(documents):
    rng = random.Random(6)
    a, b = prose(rng, 60), prose(rng, 60)
    rows = [(k, t, "en") for k, t in ((1, a), (2, a), (2, b), (3, b), (4, a), (5, b), (6, prose(rng, 60)))]
    got = near_duplicates.marked(documents(rows).repartition(3)).select("doc_id", "component_id").distinct()
    assert sorted(got.collect()) == [(1, 1), (2, 1), (3, 1), (4, 1), (5, 1), (6, 6)]


def test_members_travel_byte_by_byte(spark):
    doc, at = np.array([7, 9, 1 << 40]), np.array([0, 3, 70_000])
    keys = np.array([[5, 1 << 62], [5, -8], [-1, 1 << 62]])
    packed = spark.createDataFrame(clusters.packed_stars(doc, at, keys, 4).to_pandas(), clusters.PACKED)
    other = clusters.packed_stars(np.array([8]), np.array([2]), np.array([[-1, -8]]), 4).to_pandas()
    both = packed.unionByName(spark.createDataFrame(other, clusters.PACKED))
    found = sorted(tuple(r) for r in clusters.star_pairs(both).collect())
    assert found == [(9, 3, 7, 0), (9, 3, 8, 2), (1 << 40, 70_000, 7, 0), (1 << 40, 70_000, 8, 2)]
