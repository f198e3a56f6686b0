from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace
from threading import Barrier
from pathlib import Path
from uuid import uuid4

import pytest
from plans_of import plan_of
from pyspark.sql import functions as F
from pyspark.sql import types as T

from smeltery.operators import quality
from smeltery.plans import silver
from smeltery.sources import tables
from smeltery.spec import CountSpec, TableSpec


def spec_of(**options):
    options = {"key": ("id",), "required": ("id", "part"), "partition_by": ("part",), **options}
    columns = {"id": "string", "part": "string", "note": "string"}
    return TableSpec(f"t_{uuid4().hex}", columns, stamp=None, **options)


def frame(spark, rows):
    return spark.createDataFrame(rows, "id string, part string, note string")


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def data_files(path):
    return [p for p in Path(path).rglob("part-*")]


ROWS = [("1", "01", "x"), ("2", "02", None), ("3", "A/B C", "")]


def test_create_is_repeatable(spark, tmp_path):
    spec, location = spec_of(), str(tmp_path / "t")
    tables.create_table(spark, spec, location)
    tables.create_table(spark, spec, location)
    assert spark.table(spec.name).columns == ["id", "note", "part"]
    assert spark.table(spec.name).count() == 0


@pytest.mark.parametrize("declared_first", [True, False])
def test_overwrite_keeps_location_values_and_rows(spark, tmp_path, declared_first):
    spec, location = spec_of(), str(tmp_path / "t")
    if declared_first:
        tables.create_table(spark, spec, location)
    for _ in range(2):
        tables.overwrite_table(frame(spark, ROWS), spec, location)
        assert rows_of(spark.table(spec.name).select(*spec.columns)) == ROWS
        assert rows_of(tables.load(spark, spec, location)) == ROWS
    assert data_files(location)
    pruned = spark.table(spec.name).filter(F.col("part") == "01").select("id")
    assert rows_of(pruned) == [("1",)]
    assert "PartitionFilters: [isnotnull(part" in plan_of(pruned)


def test_overwrite_replaces_every_partition(spark, tmp_path):
    spec, location = spec_of(), str(tmp_path / "t")
    tables.overwrite_table(frame(spark, ROWS), spec, location)
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        tables.overwrite_table(frame(spark, ROWS[:1]), spec, location)
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert rows_of(spark.table(spec.name).select(*spec.columns)) == ROWS[:1]


def test_overwrite_replaces_the_schema(spark, tmp_path):
    spec, location = spec_of(), str(tmp_path / "t")
    tables.overwrite_table(frame(spark, ROWS), spec, location)
    columns = {"id": "long", "part": "string", "note": "string", "more": "integer"}
    wider = replace(spec, schema=columns)
    more = frame(spark, ROWS).selectExpr("cast(id as bigint) id", "part", "note", "1 as more")
    tables.overwrite_table(more, wider, location)
    assert dict(spark.table(spec.name).dtypes)["id"] == "bigint"
    assert spark.table(spec.name).count() == 3


def test_files_do_not_multiply_with_tasks(spark, tmp_path):
    df = spark.range(0, 80_000, 1, 16).selectExpr(
        "cast(id as string) id", "concat('p', id % 50) part", "'n' note"
    )
    spec, location = spec_of(), str(tmp_path / "t")
    tables.overwrite_table(df, spec, location)
    assert len(data_files(location)) == 50
    assert spark.table(spec.name).count() == 80_000


def test_hot_partition_is_split_over_tasks(spark, tmp_path):
    # A third of all rows share a value; a task may take about 100 kB of them.
    df = spark.range(0, 120_000, 1, 16).selectExpr(
        "cast(id as string) id", "if(id % 3 = 0, 'hot', concat('p', id % 50)) part", "uuid() note"
    )
    spec, location = spec_of(), str(tmp_path / "t")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "100k")
    try:
        tables.overwrite_table(df, spec, location)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(data_files(f"{location}/part=hot")) > 4
    stored = tables.load(spark, spec, location)
    assert stored.count() == 120_000 and stored.select("id").distinct().count() == 120_000
    assert stored.filter("part = 'hot'").count() == 40_000


def test_path_overwrite_enforces_the_schema(spark, tmp_path):
    counts = CountSpec("c", ("part",), quantity_type=T.IntegerType(), stamp=None)
    spec = counts.table(spec_of())
    path = str(tmp_path / "c")
    good = spark.createDataFrame([("a", 1), ("b", 2)], "part string, quantity int")
    tables.overwrite_path(good, spec, path)
    tables.overwrite_path(good, spec, path)
    assert rows_of(tables.load(spark, spec, path)) == [("a", 1), ("b", 2)]
    with pytest.raises(ValueError, match="not the declared"):
        wide = good.withColumn("quantity", F.col("quantity").cast("bigint"))
        tables.overwrite_path(wide, spec, path)
    assert tables.load(spark, spec, path).count() == 2


def test_publish_and_attach(spark, tmp_path, as_of):
    spec, location = spec_of(), str(tmp_path / "t")
    for rows in (ROWS[:1], ROWS):
        run = tables.new_run(as_of)
        staged = tables.stage(frame(spark, rows), spec, location, run)
        assert staged.count() == len(rows)
        published = tables.publish(spark, spec, location, run)
        assert published.columns == spec.columns
        assert rows_of(published) == rows
    # Another session knows the location only.
    other = replace(spec, name=f"u_{uuid4().hex}")
    attached = tables.attach(spark.newSession(), other, location)
    assert rows_of(attached) == ROWS
    pruned = attached.filter(F.col("part") == "01").select("id")
    assert "PartitionFilters: [isnotnull(part" in plan_of(pruned)
    assert rows_of(tables.attach(spark, other, location)) == ROWS


def test_nothing_published(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="nothing was published"):
        tables.attach(spark, spec_of(), str(tmp_path / "t"))


def test_the_order_of_publishing_decides_not_the_clock(spark, tmp_path, as_of):
    spec, location = spec_of(), str(tmp_path / "t")
    runs = [tables.new_run(as_of) for _ in range(3)]
    for run in runs:
        tables.stage(frame(spark, ROWS), spec, location, run)
    tables.publish(spark, spec, location, runs[0])
    # An entry by a driver whose clock is a year ahead.
    ahead = spark.sql(
        f"select '{runs[1]}' as run, now() + interval 1 year as published_at"
    )
    ahead.write.parquet(f"{location}/published/number=2")
    assert tables.published_run(spark, location) == runs[1]
    tables.publish(spark, spec, location, runs[2])
    assert tables.published_run(spark, location) == runs[2]


def test_unpublished_versions_stay_invisible(spark, tmp_path, as_of):
    spec, location = spec_of(), str(tmp_path / "t")
    silver.refresh(frame(spark, ROWS), spec, location, as_of)
    with pytest.raises(quality.QualityError, match=r"unique_rows \(1\)"):
        silver.refresh(frame(spark, [*ROWS, ROWS[0]]), spec, location, as_of)
    with pytest.raises(quality.QualityError, match="not_empty"):
        silver.refresh(frame(spark, []), spec, location, as_of)
    assert rows_of(spark.table(spec.name)) == ROWS
    assert rows_of(tables.attach(spark, replace(spec, name=f"u_{uuid4().hex}"), location)) == ROWS


def test_odd_names(spark, tmp_path):
    spec = TableSpec(
        f"default.odd_{uuid4().hex}",
        {"a b": "string", "c-d": "string"},
        required=("c-d",),
        partition_by=("c-d",),
        stamp=None,
    )
    location = str(tmp_path / "it's")
    tables.create_table(spark, spec, location)
    df = spark.createDataFrame([("x", "y")], "`a b` string, `c-d` string")
    tables.overwrite_table(df, spec, location)
    assert rows_of(tables.load(spark, spec, location)) == [("x", "y")]


def test_a_run_that_was_never_staged_is_not_published(spark, tmp_path, as_of):
    spec, location = spec_of(), str(tmp_path / "t")
    silver.refresh(frame(spark, ROWS), spec, location, as_of)
    before = tables.published_run(spark, location)
    with pytest.raises(FileNotFoundError, match="was not staged"):
        tables.publish(spark, spec, location, tables.new_run(as_of))
    assert tables.published_run(spark, location) == before
    assert rows_of(tables.attach(spark, spec, location)) == ROWS


def test_a_run_staged_in_another_session_is_published(spark, tmp_path, as_of):
    spec, location = spec_of(), str(tmp_path / "t")
    run = tables.new_run(as_of)
    tables.stage(frame(spark, ROWS), spec, location, run)
    spark.sql(f"drop table {tables._named(tables.version(spec, run))}")
    assert rows_of(tables.publish(spark, spec, location, run)) == ROWS


def test_a_publisher_that_looked_before_another_wrote_is_refused(spark, tmp_path, as_of, monkeypatch):
    spec, location = spec_of(), str(tmp_path / "t")
    first, second = tables.new_run(as_of), tables.new_run(as_of)
    for run in (first, second):
        tables.stage(frame(spark, ROWS), spec, location, run)
    tables.publish(spark, spec, location, first)
    monkeypatch.setattr(tables, "_numbers", lambda *_: [])
    with pytest.raises(FileExistsError):
        tables.publish(spark, spec, location, second)
    monkeypatch.undo()
    assert tables.published_run(spark, location) == first


def test_one_of_two_publishers_at_a_time_succeeds(spark, tmp_path, monkeypatch):
    together = Barrier(2)
    numbers = tables._numbers

    def at_once(*args):
        found = numbers(*args)
        together.wait(30)  # both have looked, none has written
        return found

    monkeypatch.setattr(tables, "_numbers", at_once)

    def publish(run):
        try:
            return tables.log_run(spark, log, run)
        except FileExistsError:
            return None

    log = str(tmp_path / "log")
    with ThreadPoolExecutor(2) as pool:
        for k in range(100):
            got = list(pool.map(publish, [f"{k}a", f"{k}b"]))
            assert sorted(got, key=str) == [k + 1, None]
            won = f"{k}{'ab'[got.index(k + 1)]}"
            if k % 20 == 0:
                assert tables.newest_run(spark, log)["run"] == won
    assert spark.read.schema(tables.LOG_SCHEMA).parquet(log).count() == 100


def test_a_number_whose_publisher_died_is_passed_over(spark, tmp_path):
    log = tmp_path / "log"
    assert tables.log_run(spark, str(log), "a") == 1
    (log / tables.CLAIMS / "00000000000000000002").touch()
    assert tables.newest_run(spark, str(log))["run"] == "a"
    assert tables.log_run(spark, str(log), "b") == 3
    assert tables.newest_run(spark, str(log))["run"] == "b"


@pytest.mark.parametrize("value", ["", None])
def test_a_partition_value_that_files_cannot_keep_ends_the_write(spark, tmp_path, value):
    spec = replace(spec_of(), stamp=None)
    rows = frame(spark, ROWS).select(*spec.columns)
    column = spec.partition_by[0]
    spoiled = rows.unionByName(rows.limit(1).withColumn(column, F.lit(value).cast("string")))
    with pytest.raises(Exception, match="is null or empty"):
        tables.overwrite_table(spoiled, spec, str(tmp_path / "t"))
