import numpy as np
import pyarrow as pa
import pytest
from brute import LOWER, components, corpus, similar

from smeltery.llm import clusters, lines


def sets_of(texts, size=8):
    out = {}
    for doc, text in enumerate(texts):
        for at, line in enumerate((text or "").split("\n")):
            plain = line.encode().strip(b" \t\n\r\x0b\x0c").translate(LOWER).decode()
            if plain:
                runs = {plain[k : k + size] for k in range(len(plain) - size + 1)}
                out[doc, at] = runs or {plain}
    return out


@pytest.mark.parametrize("parts", [1, 6])
def test_one_line_of_each_component_stays(documents, parts):
    texts = [t if t is None or len(t) < 20_000 else t[:2_000] for t in corpus(4, families=4)]
    sets = sets_of(texts)
    first = components(similar(sets), sets)
    gone = {n for n in sets if first[n] != n}
    rows = lines.deduplicated(documents(texts).repartition(parts)).collect()
    assert len(rows) == len(texts) and len(gone) > 20
    for r in rows:
        parts_of = [] if texts[r.doc_id] is None else texts[r.doc_id].split("\n")
        left = [x for k, x in enumerate(parts_of) if (r.doc_id, k) not in gone]
        assert r.text == (None if texts[r.doc_id] is None else "\n".join(left))
        assert (r.n_lines, r.n_removed) == (len(parts_of), len(parts_of) - len(left))


def test_odd_rows(documents):
    assert lines.deduplicated(documents([])).collect() == []
    same = "a line that several documents have in common"
    rows = [(4, same, "en"), (4, same, "en"), (None, same, None), (5, f"x\n{same} \n\n", "en")]
    odd = documents(rows).withColumnRenamed("lang", "gone").withColumnRenamed("source", "slot")
    odd = odd.withColumnRenamed("n_chars", "n_lines")
    got = sorted((r.doc_id or 0, r.text, r.n_removed) for r in lines.deduplicated(odd).collect())
    assert got == [(0, same, 0), (4, same, 0), (4, same, 0), (5, "x\n\n", 1)]
    assert lines.deduplicated(odd).columns == ["doc_id", "gone", "slot", "text", "n_lines", "n_removed"]


def test_common_lines_go_where_their_texts_lie(documents, monkeypatch):
    moved, parted = [], lines.parted

    def counted(docs, ids, *names):
        moved.append(ids.count())
        return parted(docs, ids, *names)

    monkeypatch.setattr(lines, "parted", counted)
    same, near = "a line that several documents have in common", "A line that several documents have in common."
    texts = [f"{same} \n\nline {k} of its own, {'xyz'[k % 3] * 30}" for k in range(12)]
    texts[3] += f"\n{same}\n{near}"
    got = {r.doc_id: (r.text, r.n_removed) for r in lines.deduplicated(documents(texts).repartition(4)).collect()}
    assert got[0] == (texts[0], 0)
    assert all(same not in got[k][0] and near not in got[k][0] for k in range(1, 12))
    # Of texts, only those with lines that are alike, not equal, meet a table of what goes.
    assert sum(moved) < 11 and got[3][1] >= 3


def test_a_place_with_several_texts_goes_from_each_row(documents):
    same = "a line that several documents have in common"
    rows = [(k, f"{same}\nrest", "en") for k in range(3)] + [(7, f"{same}\nx", "en"), (7, "\ny", "en"), (7, "other\nz", "en")]
    got = sorted((r.doc_id, r.text) for r in lines.deduplicated(documents(rows).repartition(3)).collect())
    assert got[:3] == [(0, f"{same}\nrest"), (1, ""), (2, "")]
    assert got[3:] == [(7, "x"), (7, "y"), (7, "z")]


def test_whole_texts_are_not_joined_to_pick_lines(documents, monkeypatch):
    def refused(*args):
        raise AssertionError("texts are dealt out to pick lines")

    monkeypatch.setattr(lines, "parted", refused)
    same = "a line that several documents have in common"
    found = lines.repeated(documents([f"x{k}\n{same}" for k in range(4)]).repartition(2)).collect()
    assert sorted(map(tuple, found)) == [(k, 1, 0, 1) for k in (1, 2, 3)]


def test_every_node_is_marked_and_few_others(spark):
    pairs = spark.createDataFrame([(k, 1, k + 5000, 2) for k in range(1000)], "doc long, at long, to_doc long, to_at long")
    marked = clusters.marked_nodes(pairs)
    doc = np.arange(1000)
    assert clusters.is_marked(marked, doc, np.full(1000, 1)).all()
    assert clusters.is_marked(marked, doc + 5000, np.full(1000, 2)).all()
    assert clusters.is_marked(marked, doc, np.full(1000, 3)).sum() < 10
    assert len(marked.value) == clusters.MARKS // 8


def test_runs_and_spans_are_those_of_the_texts():
    texts = ["  ab\tc \n\n \x0b\nABCDEFGHIJ é漢\r\n" + " " * 30 + "x" + " " * 30, "", "\n", "short\nabcdefgh\nabcdefg\x00"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.cumsum([0] + [len(t.encode()) for t in texts])
    starts, ends, doc, line = lines.lines_of(data, offsets)
    values, owner = lines.shingles_of(data, starts, ends)
    want = [(d, k, x.encode().strip(b" \t\n\r\x0b\x0c")) for d, t in enumerate(texts) for k, x in enumerate(t.split("\n"))]
    want = [w for w in want if w[2]]
    got = [(d, k, data[a:b].tobytes()) for a, b, d, k in zip(starts, ends, doc, line)]
    assert got == want
    codes = {}
    for k, (_, _, text) in enumerate(got):
        plain = text.translate(LOWER).decode()
        runs = [plain[j : j + 8] for j in range(len(plain) - 7)] or [plain]
        found = values[owner == k].tolist()
        assert len(found) == len(runs)
        assert all(codes.setdefault(run, code) == code for run, code in zip(runs, found))
    assert len(set(codes.values())) == len(codes)


def bucket(texts, out, component):
    sketches = [lines.arrays.one_permutation(*lines._sets(pa.array([t]), 8), 1, clusters.SKETCH) for t in texts]
    zeros = np.zeros(len(texts), np.int64)
    columns = [zeros, np.arange(len(texts)), zeros, component, zeros, np.arange(len(texts)), np.array(out)]
    held = [pa.array(c) for c in columns]
    held += [pa.array([s.astype(np.uint8).tobytes() for s in sketches], pa.binary()), pa.array(texts)]
    return pa.RecordBatch.from_arrays(held, ["key", "doc", "at", "c_doc", "c_at", "same", "out", "sketch", "text"])


def test_what_cannot_be_a_link_is_not_compared_in_full(monkeypatch):
    rng = np.random.default_rng(3)
    base = rng.integers(97, 123, 400)
    texts = []
    for _ in range(60):
        other = base.copy()
        other[300 + rng.integers(-9, 9) :] = rng.integers(97, 123, 400)[:1]
        other[340:] = rng.integers(97, 123, 60)
        texts.append(bytes(other.astype(np.uint8)).decode())
    linked = bytes(base.astype(np.uint8)).decode()
    texts += [linked, linked[:-3] + "___"]
    asked = []

    def sets(column):
        asked.append(len(column))
        return lines._sets(column, 8)

    one_by_one = np.intersect1d
    monkeypatch.setattr(np, "intersect1d", lambda *a, **k: (asked.append(2), one_by_one(*a, **k))[1])
    found = clusters._meeting(sets, 80)(iter([bucket(texts, [True] * 62, np.arange(62))]))
    rows = [r for batch in found for r in batch.to_pylist()]
    truth = {n for n in similar(sets_of(texts))}
    first = components([(a[0], b[0]) for a, b in truth], range(62))
    assert components([(r["doc"], r["to_doc"]) for r in rows], range(62)) == first
    assert sum(asked) < 150


def test_links_join_what_a_bucket_holds(monkeypatch):
    monkeypatch.setattr(clusters, "MET", 50)
    monkeypatch.setattr(clusters, "SET_BYTES", 2_000)
    monkeypatch.setattr(clusters, "OUTLINED", 3)
    texts = [t[:300] for t in corpus(6, families=4) if t and t.strip() and "\n" not in t.strip()]
    texts = [t.strip() for t in texts if t.strip()]
    n = len(texts)
    assert n > 20
    found = clusters._meeting(lambda c: lines._sets(c, 8), 80)(iter([bucket(texts, [True] * n, np.arange(n))]))
    rows = [r for batch in found for r in batch.to_pylist()]
    first = components([(a[0], b[0]) for a, b in similar(sets_of(texts))], range(n))
    assert components([(r["doc"], r["to_doc"]) for r in rows], range(n)) == first
