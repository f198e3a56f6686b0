"""Landed records: JSON in a folder per day.

Two file layouts exist and must be named when reading, because reading one as
the other loses records without an error: ``lines`` holds one record per line
and splits across tasks; ``array`` holds one page, a JSON array, per file.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from smeltery.functions.columns import day_folder
from smeltery.operators.quality import CORRUPT

LAYOUTS = ("lines", "array")

# How many records a page has, and the name of the total.
PAGE_ROWS = 200
TOTAL = "total"

# Times are written with all their digits; Spark's default keeps milliseconds.
JSON_WRITING = {
    "ignoreNullFields": "false",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}

# Spark's increasing ids hold the row's place within its task in the lower 33 bits.
ROW_IN_TASK = (1 << 33) - 1


def run_folder(base: str, as_of: datetime, run: str | None) -> str:
    """The day's folder, or that of one run below it."""
    day = day_folder(base, as_of)
    return day if run is None else f"{day}/run={run}"


def land_rows(
    df: DataFrame,
    base: str,
    as_of: datetime,
    records_per_file: int | None = None,
    run: str | None = None,
) -> str:
    """Write rows as JSON lines to the folder of the day or run, replacing what it held.

    Null fields are written out, so every column stays visible to a reader.
    """
    folder = run_folder(base, as_of, run)
    writer = df.write.mode("overwrite").options(**JSON_WRITING)
    if records_per_file:
        writer = writer.option("maxRecordsPerFile", records_per_file)
    writer.json(folder)
    return folder


def land_records(
    df: DataFrame,
    base: str,
    as_of: datetime,
    records_per_file: int | None = None,
    run: str | None = None,
) -> str:
    """Write the ``record`` column, JSON text, one record per line, as ``land_rows`` does.

    Line breaks become blanks: in JSON they stand between the parts of a record,
    never within a text, so nothing else changes.
    """
    folder = run_folder(base, as_of, run)
    line = F.col("record")
    for line_break in ("\n", "\r"):
        line = F.replace(line, F.lit(line_break), F.lit(" "))
    writer = df.select(line.alias("record")).write.mode("overwrite")
    if records_per_file:
        writer = writer.option("maxRecordsPerFile", records_per_file)
    writer.text(folder)
    return folder


def write_pages(df: DataFrame, root: str, per_page: int = PAGE_ROWS) -> str:
    """Write the ``record`` column, JSON text, as numbered arrays of ``per_page`` records.

    Every page but the last is full, whatever the records hold: a page is cut by
    position, not by key. Positions are stored once, as ``<root>/records``, so a
    recomputed task cannot number its rows anew; ``<root>/meta`` has the total.
    Returns the folder of the pages, one subfolder ``page=<n>`` each.
    """
    spark = df.sparkSession
    tagged = df.select(
        "record", F.spark_partition_id().alias("task"), F.monotonically_increasing_id().alias("at")
    )
    tagged.write.mode("overwrite").parquet(f"{root}/records")
    stored = spark.read.schema("record string, task int, at bigint").parquet(f"{root}/records")

    # One row per writing task, stored, so that the size of the join's small side
    # is known: where the task's first record stands among all records.
    sizes = stored.groupBy("task").agg(F.count("*").alias("size"))
    sizes.write.mode("overwrite").parquet(f"{root}/tasks")
    sizes = spark.read.schema("task int, size bigint").parquet(f"{root}/tasks")
    total = sizes.agg(F.coalesce(F.sum("size"), F.lit(0)).alias(TOTAL))
    total.write.mode("overwrite").json(f"{root}/meta")
    earlier = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("size").over(earlier), F.lit(0))
    starts = sizes.select("task", start.alias("start"))

    # A page has at most ``per_page`` records and is one row: this is for records of a
    # service's size, as in tests, not for copying a lake.
    position = F.col("start") + F.col("at").bitwiseAND(F.lit(ROW_IN_TASK))
    numbered = stored.join(starts, "task").select(position.alias("position"), "record")
    arrays = numbered.groupBy(F.expr(f"position div {per_page} + 1").alias("page")).agg(
        F.array_sort(F.collect_list(F.struct("position", "record"))).alias("rows")
    )
    text = F.concat(F.lit("["), F.array_join("rows.record", ","), F.lit("]"))
    folder = f"{root}/pages"
    pages = arrays.select("page", text.alias("value"))
    pages.write.mode("overwrite").partitionBy("page").text(folder)
    return folder


def read_pages(
    spark: SparkSession,
    folder: str,
    schema: T.StructType | None,
    layout: str = "lines",
    corrupt: bool = False,
) -> DataFrame:
    """All records of a folder, under ``schema`` or, if None, an inferred one.

    With ``corrupt`` the text of each unreadable record is kept in a further
    column; otherwise such a record only shows as nulls.
    """
    if layout not in LAYOUTS:
        raise ValueError(f"layout must be one of {LAYOUTS}, not {layout!r}")
    reader = (
        spark.read.option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("recursiveFileLookup", "true")
    )
    if schema is not None:
        extra = [T.StructField(CORRUPT, T.StringType())] if corrupt else []
        reader = reader.schema(T.StructType(schema.fields + extra))
    return reader.json(folder, multiLine=layout == "array")


#: The column of ``read_with_names`` that holds a record's names.
NAMES = "_names"


def read_with_names(
    spark: SparkSession, folder: str, schema: T.StructType, layout: str = "lines"
) -> DataFrame:
    """The records of ``read_pages`` with ``corrupt``, and the names that each has, in one scan.

    A record that is no JSON object has null names.
    """
    if layout not in LAYOUTS:
        raise ValueError(f"layout must be one of {LAYOUTS}, not {layout!r}")
    whole = layout == "array"
    text = spark.read.text(folder, wholetext=whole, recursiveFileLookup=True)
    if whole:
        # A page that cannot be read goes on as it is, and is found to be corrupt.
        records = F.coalesce(F.from_json("value", "array<string>"), F.array("value"))
        text = text.select(F.explode(records).alias("value"))
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    full = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    parsed = text.where(F.col("value").rlike(r"\S")).select(
        F.from_json("value", full, options).alias("record"), F.json_object_keys("value").alias(NAMES)
    )
    return parsed.select("record.*", NAMES)


def inferred_columns(spark: SparkSession, folder: str, layout: str = "lines") -> list[str]:
    """The names that occur in at least one record, found by a scan of all of them."""
    return [c for c in read_pages(spark, folder, None, layout).columns if c != CORRUPT]
