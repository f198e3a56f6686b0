from __future__ import annotations

import pytest
from plans_of import plan_of
from pyspark.sql import functions as F
from pyspark.sql import types as T

from smeltery.operators.aggregate import (
    count_by,
    count_conformed,
    duplicate_groups,
    null_counts,
    preview,
    row_count,
)
from smeltery.operators.shape import conform
from smeltery.spec import CountSpec, TableSpec

SPEC = TableSpec(
    "places",
    {"id": "string", "kind": "string", "city": "string", "state": "string"},
    key=("id",),
    required=("state", "id", "kind", "city"),
    clean=("state", "city"),
)
COUNTS = CountSpec("per_state", ("state", "kind"), quantity_type=T.IntegerType())


@pytest.fixture(scope="module")
def places(spark):
    n = F.col("id")
    states = F.array(*[F.lit(s) for s in ("é", "É", "E", "́", "", "ü x", "Ü X")])
    # A third of all rows share one state.
    state = F.when(n % 3 == 0, "Kärnten").otherwise(F.element_at(states, (n % 7 + 1).cast("int")))
    return spark.range(0, 20_000, 1, 16).select(
        F.when(n % 11 != 0, n.cast("string")).alias("id"),
        F.when(n % 13 != 0, F.concat(F.lit("k"), n % 4)).alias("kind"),
        F.when(n % 17 == 0, "̂").otherwise("Łódź").alias("city"),
        F.when(n % 19 != 0, state).alias("state"),
    )


def as_dict(df):
    return {tuple(r[:-1]): r[-1] for r in df.collect()}


def test_counting_before_cleaning_changes_nothing(places):
    slow = as_dict(count_by(conform(places, SPEC), COUNTS))
    fast = as_dict(count_conformed(places, SPEC, COUNTS))
    assert fast == slow and ("KARNTEN", "k0") in fast
    assert set(k[0] for k in fast) == {"KARNTEN", "E", "U X"}
    assert sum(fast.values()) == conform(places, SPEC).count()


def test_count_by(spark):
    df = spark.createDataFrame([("a", "x")] * 3 + [("a", None)] * 2, "state string, kind string")
    out = count_by(df, COUNTS)
    assert as_dict(out) == {("a", "x"): 3, ("a", None): 2}
    assert dict(out.dtypes)["quantity"] == "int"
    long = count_by(df, CountSpec("per_state", ("state", "kind")))
    assert dict(long.dtypes)["quantity"] == "bigint"
    assert as_dict(long) == as_dict(out)


def test_one_shuffle_after_partial_counts(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([("a", "x", 1)], "state string, kind string, other int")
    df.write.parquet(path)
    plan = plan_of(count_by(spark.read.parquet(path), COUNTS))
    assert plan.count("Exchange") == 1
    assert "partial_count" in plan
    assert "other" not in plan


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_more_rows_than_the_declared_type_holds(spark, ansi):
    # A byte stands in for the integer, a hundred rows for two billion.
    spec = CountSpec("c", ("k",), quantity_type=T.ByteType(), stamp=None)
    source = TableSpec("t", {"k": "string"}, required=("k",), clean=("k",))
    df = spark.range(0, 128, 1, 4).select(F.lit("é").alias("k"))
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        for counted in (count_by, lambda d, s: count_conformed(d, source, s)):
            assert counted(df.limit(127), spec).first().quantity == 127
            with pytest.raises(Exception, match="128 rows do not fit tinyint|CAST_OVERFLOW"):
                counted(df, spec).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_row_count(spark):
    assert row_count(spark.range(17)).first().n == 17


def test_duplicates_treat_nulls_as_equal(spark):
    rows = [(None, 1), (None, 1), ("a", None), ("a", 2), ("b", 3)]
    df = spark.createDataFrame(rows, "k string, n int")
    assert as_dict(duplicate_groups(df, ["k"])) == {(None,): 2, ("a",): 2}
    assert as_dict(duplicate_groups(df, ["k", "n"])) == {(None, 1): 2}


def test_null_counts(spark):
    nan = float("nan")
    rows = [("NaN", nan, 1), (None, None, None), ("", 1.0, 2)]
    df = spark.createDataFrame(rows, "s string, d double, i int")
    assert null_counts(df, ["s", "d", "i"]).first().asDict() == {"s": 1, "d": 2, "i": 1}
    assert null_counts(df.limit(0), ["s"]).first().asDict() == {"s": 0}


def test_preview_is_a_top_k(spark):
    df = spark.range(0, 1000, 1, 8).select((999 - F.col("id")).alias("n"))
    out = preview(df, ["n"], 30)
    assert [r.n for r in out.collect()] == list(range(30))
    assert "TakeOrderedAndProject" in plan_of(out)
