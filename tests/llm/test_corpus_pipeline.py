import __spark_entry__
import corpus_pipeline
from brute import corpus
from pyspark.sql import functions as F

from smeltery.llm.queries import QUERIES, SQL
from smeltery.llm.shared import written


def english(k, stems=97):
    common = "the of and to in is that it was for".split()
    return " ".join(common[j % 10] if j % 3 else f"stem{(j * 7 + k) % stems}er" for j in range(120)) + "."


def test_stages_take_effect(spark, saved):
    clean = [english(k) for k in range(12)]
    leak = "a passage of the benchmark that no document should have had in its text at all"
    texts = [*clean, f"{english(40)} {leak} {english(41)}", clean[3], "too short", None]
    folder = saved(texts, benchmark=spark.createDataFrame([(1, leak)], "item_id long, text string"))
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    left = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
        if name != "packing":
            assert docs.columns == list(corpus_pipeline.COLUMNS)
            left[name] = {r.doc_id for r in docs.collect()}
    assert left["quality rules"] == set(range(14))
    assert left["line dedup"] == set(range(13))
    assert left["decontamination"] == left["near-dedup"] - {12}
    rows = corpus_pipeline.run(spark, folder).collect()
    assert {r.doc_id for r in rows} == left["decontamination"]


def test_empty_tables(spark, saved):
    empty = spark.createDataFrame([], "item_id long, text string")
    folder = saved([], benchmark=empty, labels=spark.createDataFrame([], "doc_id long, toxic int"),
                   pages=spark.createDataFrame([], "page_id long, url string, html string"))
    for query in QUERIES.values():
        assert query(spark, folder).collect() == []
    assert corpus_pipeline.run(spark, folder).collect() == []


def test_all_queries_are_registered():
    registered = __spark_entry__.queries()
    assert set(QUERIES) | {"pipeline"} <= set(registered)
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert set(SQL) <= set(__spark_entry__.oracle_sql())


def test_queries_run_over_odd_documents(spark, saved):
    texts = corpus(9, families=2)
    folder = saved(
        texts,
        benchmark=spark.createDataFrame([(1, texts[0] or "x")], "item_id long, text string"),
        labels=spark.createDataFrame([(k, k % 2) for k in range(20)], "doc_id long, toxic int"),
        pages=spark.createDataFrame([(k, f"u{k}", t) for k, t in enumerate(texts)], "page_id long, url string, html string"),
    )
    for name, query in QUERIES.items():
        rows = query(spark, folder).collect()
        if name not in ("op2_decontaminate", "op8_packing", "op12_spelling"):
            assert len(rows) == len(texts), name


def plain(rows, leak):
    """Which documents the first four stages leave, and with which text, of texts whose lines
    and word sets are equal or far apart."""
    kept, lines, sets = {}, set(), []
    for doc_id, text in rows:
        if doc_id is None:
            continue
        own = (text or "").split("\n")
        left = []
        for x in own:
            bare = x.strip().lower()
            if not bare.split() or bare not in lines:
                left.append(x)
            if bare.split():
                lines.add(bare)
        if left != own and not " ".join(left).split():
            continue
        found = "\n".join(left).lower().split()
        grams = {tuple(found[k : k + 5]) for k in range(max(1, len(found) - 4))} if found else set()
        if grams in [g for g in sets if g]:
            continue
        sets.append(grams)
        if leak not in "\n".join(left):
            kept[doc_id] = "\n".join(left)
    return kept


def test_stages_are_those_of_a_plain_version_on_odd_rows(spark, saved):
    leak = "a passage of the benchmark that no document should have had in its text at all"
    long = "\n".join(english(1000 * k, 10**9) for k in range(300, 700))
    rows = [(k, english(k)) for k in range(0, 30, 2)]
    rows += [(31, english(2) + "\n" + english(31)), (32, english(4)), (33, f"{english(33)}\n{leak}")]
    rows += [(40, long), (41, english(41) + "\n" + long[: len(long) // 2])]
    odd = [(None, english(900)), (None, english(900)), (50, None), (51, ""), (52, "short"), (53, "\n" * 70)]
    folder = saved([(i, t, "en") for i, t in rows + odd], benchmark=spark.createDataFrame([(1, leak), (None, None)], "item_id long, text string"))
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name in ("gone", "items", "slot", "row", "component_id", "n_removed", "kept"):
        docs = docs.withColumn(name, F.lit("clash"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert docs.columns == list(corpus_pipeline.COLUMNS), name
        docs = written(docs).withColumn("kept", F.lit(0)) if name != "decontamination" else docs
    got = docs.collect()
    want = plain(rows, leak)
    assert {r.doc_id: r.text for r in got if r.doc_id is not None} == want
    assert all(r.n_chars == len(r.text) for r in got)
    # Rows without an id are no documents: they pass what tells documents apart.
    assert [r.text for r in got if r.doc_id is None] == [english(900)] * 2
    # Packing loses nothing of what is left.
    tokens = {}
    for r in corpus_pipeline.packed(spark, docs, folder).collect():
        tokens.setdefault((r.doc_id, r.doc_tokens), []).append((r.start, r.length))
    for (doc_id, n), pieces in tokens.items():
        assert sum(length for _, length in pieces) == n * (2 if doc_id is None else 1)
    assert {doc_id for doc_id, _ in tokens} == {*want, None}
