import hashlib
import random

import pytest
from brute import prose
from pyspark.sql import functions as F

from smeltery.llm import merkle


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def tree(nodes):
    """Each node's siblings level by level, and the root, by folding whole levels."""
    proofs = [[] for _ in nodes]
    at = list(range(len(nodes)))
    while len(nodes) > 1:
        for k, a in enumerate(at):
            run = a - a % 8
            proofs[k].append(("".join(nodes[run:a]), "".join(nodes[a + 1 : run + 8])))
        nodes = [h(*nodes[k : k + 8]) for k in range(0, len(nodes), 8)]
        at = [a // 8 for a in at]
    return proofs, nodes[0] if nodes else None


def plain(rows):
    """(doc_id, leaf, subroot, root, proof) of rows (doc_id, text, lang, source, n_chars)."""
    groups = {}
    for doc_id, text, lang, source, n in rows:
        leaf = h(*map(field, (doc_id, source, lang, n, text)))
        groups.setdefault("" if lang is None else "=" + lang, []).append((doc_id is not None, doc_id or 0, leaf, doc_id))
    names = sorted(groups, key=str.encode)
    found = {g: (sorted(groups[g], key=lambda x: x[:3]), tree([x[2] for x in sorted(groups[g], key=lambda x: x[:3])])) for g in names}
    above, root = tree([found[g][1][1] for g in names])
    return sorted(
        (str(leaf[3]), leaf[2], subroot, root, [*p, *up])
        for g, up in zip(names, above)
        for leaves, (proofs, subroot) in [found[g]]
        for leaf, p in zip(leaves, proofs)
    )


def got(frame):
    return sorted(
        (str(r.doc_id), r.leaf, r.subroot, r.root, [(p.left, p.right) for p in r.proof]) for r in frame.collect()
    )


def rows_of(frame):
    return [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in frame.collect()]


@pytest.mark.parametrize("sizes", [[1], [8], [9, 1, 64, 65], [1300, 3, 520], [2] * 70])
def test_trees_are_those_of_whole_levels(documents, sizes):
    rng = random.Random(1)
    rows = [(rng.randrange(10**6), prose(rng, 4), f"l{g}") for g, n in enumerate(sizes) for _ in range(n)]
    rng.shuffle(rows)
    docs = documents(rows).repartition(5)
    found = merkle.manifest(docs)
    assert got(found) == plain(rows_of(docs))
    for r in found.collect():
        assert r.verified and r.folded_root == r.root
        assert r.proof_sha256 == h(*(x for p in r.proof for x in p))


def test_what_was_changed_is_not_verified(documents):
    texts = [f"Text {k}" if k % 3 else f"text {k}" for k in range(100)]
    docs = documents(texts)
    low = merkle.leaf_of(*(F.lower(c) if c == "text" else F.col(c) for c in merkle.FIELDS))
    for r in merkle.manifest(docs, found=low, with_proof=False).collect():
        assert r.verified == (r.doc_id % 3 == 0) == (r.folded_root == r.root)


def test_odd_rows(documents):
    assert merkle.manifest(documents([])).collect() == []
    rows = [(5, "a", None), (5, "a", None), (5, "a", ""), (None, "a", "en"), (None, None, "en"), (7, "", "én")]
    rows += [(7, "x" * 300_000, "en"), (7, "é" * 3, "en")] + [(9, "same", "de")] * 700
    docs = documents(rows).repartition(3)
    assert got(merkle.manifest(docs)) == plain(rows_of(docs))
    names = ["grp", "idx", "n", "digest", "row", "key", "leaf", "chunk", "spot", "pid", "at", "proof", "root"]
    more = docs.withColumns({c: F.lit(1) for c in names})
    assert got(merkle.manifest(more)) == plain(rows_of(docs))
