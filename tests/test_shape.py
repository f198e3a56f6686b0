from __future__ import annotations

from datetime import datetime, timezone

import pytest
from plans_of import plan_of
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from smeltery.functions.columns import day_folder, day_path, ingestion_stamp
from smeltery.operators.shape import conform, keep_required, project, stamp
from smeltery.spec import CountSpec, TableSpec

SPEC = TableSpec(
    "places",
    {"id": "string", "kind": "string", "note": "string", "state": "string"},
    key=("id",),
    required=("state", "id", "kind"),
    clean=("state",),
    partition_by=("state",),
)
RAW = "state string, id string, kind string, note string, extra int"


def test_required_filter(spark):
    rows = [("a", 1), (None, 2), ("", 3), (" ", 4), ("b", None)]
    df = spark.createDataFrame(rows, "s string, n int")
    assert [r.s for r in keep_required(df, ["s", "n"]).collect()] == ["a", " "]
    assert keep_required(df, []).count() == 5


def test_missing_column_is_an_analysis_error(spark):
    df = spark.range(1)
    with pytest.raises(AnalysisException):
        keep_required(df, ["absent"])
    with pytest.raises(AnalysisException):
        project(df, ["absent"])


def test_projection_orders_and_drops(spark):
    df = spark.createDataFrame([(1, "x", 2.0)], "a int, `b.c` string, d double")
    assert project(df, ["d", "b.c"]).columns == ["d", "b.c"]


def test_conform(spark, as_of):
    rows = [
        ("Kärnten", "1", "micro", None, 7),
        ("́", "2", "micro", "marks only: cleaned to nothing", 7),
        (" ", "3", "micro", "blank is present", 7),
        ("", "4", "micro", None, 7),
        (None, "5", "micro", None, 7),
        ("Texas", "", "micro", None, 7),
        ("Texas", "6", None, None, 7),
        ("straße", "7", "bar", "é stays", 7),
    ]
    out = conform(spark.createDataFrame(rows, RAW), SPEC, as_of)
    assert out.columns == ["id", "kind", "note", "state", "dt_ingestion"]
    assert sorted(map(tuple, out.collect())) == [
        ("1", "micro", None, "KARNTEN", as_of),
        ("3", "micro", "blank is present", " ", as_of),
        ("7", "bar", "é stays", "STRA_E", as_of),
    ]


def test_text_is_cleaned_once_and_raw_rules_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "raw")
    spark.createDataFrame([("é", "1", "k", None, 1)], RAW).write.parquet(path)
    raw = spark.read.parquet(path)
    both = ("state", "note")
    two = TableSpec("t", SPEC.schema, required=SPEC.required, clean=both, stamp=None)
    for spec in (SPEC, two):
        out = conform(raw, spec).filter(F.col("state") != "X")
        plan = plan_of(out)
        assert plan.count("ArrowEvalPython") == 1
        assert plan_of(out.hint("rebalance", "state")).count("ArrowEvalPython") == 1
        for rule in ("IsNotNull(id)", "IsNotNull(kind)", "IsNotNull(state)"):
            assert rule in plan
        assert "extra" not in plan


def test_two_cleaned_columns(spark):
    columns = {"a": "string", "b": "string", "n": "integer"}
    spec = TableSpec("t", columns, required=("a",), clean=("a", "b"), stamp=None)
    rows = [("é", None, 1), ("́", "ü", 2), ("x", "ü", 3)]
    df = spark.createDataFrame(rows, "a string, b string, n int")
    assert sorted(map(tuple, conform(df, spec).collect()), key=lambda r: r[2]) == [
        ("E", None, 1),
        ("X", "U", 3),
    ]


def test_stamp(spark, as_of):
    df = stamp(spark.range(3), "at", as_of)
    assert {r["at"] for r in df.collect()} == {as_of}
    aware = as_of.replace(tzinfo=timezone.utc)
    assert spark.range(1).select(ingestion_stamp(aware)).first()[0] == as_of
    now = stamp(spark.range(1000).repartition(8), "at")
    assert dict(now.dtypes)["at"] == "timestamp"
    assert now.select("at").distinct().count() == 1


def test_day_paths(spark):
    day = datetime(2024, 3, 7, 23, 59)
    assert day_folder("/lake/", day) == "/lake/2024/03/07"
    df = spark.createDataFrame([(day,)], "t timestamp")
    assert df.select(day_path("t")).first()[0] == "2024/03/07"


def test_spec_rejects_contradictions():
    with pytest.raises(ValueError, match="undeclared"):
        TableSpec("t", {"a": "string"}, key=("b",))
    with pytest.raises(ValueError, match="only text"):
        TableSpec("t", {"a": "long"}, clean=("a",))
    with pytest.raises(ValueError, match="must be required"):
        TableSpec("t", {"a": "string"}, partition_by=("a",))


def test_count_spec_table():
    table = CountSpec("c", ("state", "kind"), "n", T.ShortType()).table(SPEC)
    assert [(f.name, f.dataType.simpleString()) for f in table.published_schema] == [
        ("state", "string"),
        ("kind", "string"),
        ("n", "smallint"),
        ("dt_ingestion", "timestamp"),
    ]
