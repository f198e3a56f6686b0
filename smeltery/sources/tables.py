"""Tables in the catalog and at a path, and write, audit, publish.

A published table lives at one location as ``versions/run=<run>``, one folder per
run, and ``published``, a log to which a run adds an entry once its audit passed.
Readers see the run of the newest entry, so a failed or lost run changes nothing.

Before an entry is added, its number is claimed by creating a file below ``_claims``, which
the file system lets one publisher do and refuses all others. So of those that go on from one
state of the log one is published. This asks for a file system whose create is exclusive, as
that of HDFS and of local disks is; stores without it need a committer that has it.
"""

from __future__ import annotations

import re
import uuid
from dataclasses import replace
from datetime import datetime

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from smeltery.spec import TableSpec

# Formats that keep schema and partitions themselves; others are told both.
SELF_DESCRIBING = ("delta",)

# The folder of claimed numbers below a log; readers pass over it by its name.
CLAIMS = "_claims"
LOG_SCHEMA = "number bigint, run string, published_at timestamp"


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _named(spec: TableSpec) -> str:
    return ".".join(map(_quoted, spec.name.split(".")))


def create_table(spark: SparkSession, spec: TableSpec, location: str) -> None:
    """Create the declared table at ``location`` unless the name exists."""
    columns = ", ".join(
        f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in spec.published_schema
    )
    partitioned = ""
    if spec.partition_by:
        partitioned = f"PARTITIONED BY ({', '.join(map(_quoted, spec.partition_by))})"
    path = location.replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {_named(spec)} ({columns}) "
        f"USING {spec.format} {partitioned} LOCATION '{path}'"
    )


def _whole(spec: TableSpec, name: str) -> Column:
    """The partition column, ending the job at a value that files cannot keep apart."""
    column = F.col(_quoted(name))
    lost = column.isNull()
    if isinstance(spec.published_schema[name].dataType, T.StringType):
        lost = lost | (column == "")
    complaint = f"{spec.name}: partition column {name} is null or empty"
    return F.when(lost, F.raise_error(F.lit(complaint))).otherwise(column)


def overwrite_table(df: DataFrame, spec: TableSpec, location: str) -> None:
    """Replace all rows, and the schema, of the table at ``location``.

    Rows of a partition value are brought together first, so files do not
    multiply with tasks; adaptive execution splits a value that holds too much
    for one task over several.
    """
    if spec.partition_by:
        df = df.withColumns({c: _whole(spec, c) for c in spec.partition_by})
        df = df.hint("rebalance", *map(_quoted, spec.partition_by))
    writer = (
        df.write.format(spec.format)
        .mode("overwrite")
        .option("overwriteSchema", "true")
        .option("partitionOverwriteMode", "static")
        .option("path", location)
    )
    if spec.partition_by:
        writer = writer.partitionBy(*spec.partition_by)
    writer.saveAsTable(_named(spec))


def _shape(schema: T.StructType) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in schema]


def overwrite_path(df: DataFrame, spec: TableSpec, path: str) -> None:
    """Replace the rows at ``path``; the schema must be the declared one."""
    if _shape(df.schema) != _shape(spec.published_schema):
        raise ValueError(
            f"{spec.name}: schema {_shape(df.schema)} is not the declared "
            f"{_shape(spec.published_schema)}"
        )
    df.write.format(spec.format).mode("overwrite").save(path)


def load(spark: SparkSession, spec: TableSpec, path: str) -> DataFrame:
    """The table at ``path`` under its declared types, columns in declared order."""
    reader = spark.read.format(spec.format)
    if spec.format not in SELF_DESCRIBING:
        reader = reader.schema(spec.published_schema)
    return reader.load(path).select(*map(_quoted, spec.published_schema.names))


def new_run(as_of: datetime) -> str:
    return f"{as_of:%Y%m%dT%H%M%S}_{uuid.uuid4().hex[:12]}"


def version(spec: TableSpec, run: str) -> TableSpec:
    return replace(spec, name=f"{spec.name}__{run}")


def version_path(location: str, run: str) -> str:
    return f"{location.rstrip('/')}/versions/run={run}"


def stage(df: DataFrame, spec: TableSpec, location: str, run: str) -> DataFrame:
    """Write a version that no reader sees yet, and return it as stored."""
    staged = version(spec, run)
    overwrite_table(df, staged, version_path(location, run))
    return df.sparkSession.table(_named(staged))


def publish(spark: SparkSession, spec: TableSpec, location: str, run: str) -> DataFrame:
    """Make a staged version the one that readers see.

    The version must exist, and is registered, before the log names it. Of publishers that
    go on from the same state of the log one succeeds; the others get a FileExistsError, and
    readers see nothing of theirs.
    """
    _register(spark, spec, location, run)
    log_run(spark, _log_path(location), run)
    return _show(spark, spec, run)


def _register(spark: SparkSession, spec: TableSpec, location: str, run: str) -> None:
    stored = version(spec, run)
    try:
        load(spark, stored, version_path(location, run))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        raise FileNotFoundError(f"{spec.name}: run {run} was not staged at {location}") from error
    create_table(spark, stored, version_path(location, run))
    if spec.partition_by and spec.format not in SELF_DESCRIBING:
        spark.catalog.recoverPartitions(_named(stored))


def log_run(spark: SparkSession, log: str, run: str) -> int:
    """Add a run to a log under the next number, which is returned.

    A number that another publisher claims first is refused with a FileExistsError. One that
    dies between its claim and its entry leaves a number that is not given again.
    """
    # Numbered, so that the clocks of different drivers need not agree.
    number = max(_numbers(spark, log), default=0) + 1
    _claim(spark, f"{log}/{CLAIMS}/{number:020d}")
    entry = spark.range(0, 1, 1, 1).select(
        F.lit(run).alias("run"), F.current_timestamp().alias("published_at")
    )
    entry.write.mode("errorifexists").parquet(f"{log}/number={number}")
    return number


def _files(spark: SparkSession, path: str):
    """The Hadoop path of ``path`` and its file system."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    held = jvm.org.apache.hadoop.fs.Path(path)
    return held, held.getFileSystem(conf)


def _numbers(spark: SparkSession, log: str) -> list[int]:
    """All numbers that were claimed or have an entry."""
    names = []
    for folder in (log, f"{log}/{CLAIMS}"):
        path, files = _files(spark, folder)
        if files.exists(path):
            names += [status.getPath().getName() for status in files.listStatus(path)]
    return [int(m[1]) for name in names if (m := re.fullmatch(r"(?:number=)?(\d+)", name))]


def _claim(spark: SparkSession, path: str) -> None:
    """Create a file that must not exist yet; of several that try one succeeds."""
    path, files = _files(spark, path)
    files.mkdirs(path.getParent())
    if files.getUri().getScheme() == "file":
        # Hadoop looks before it creates on a local disk; the system does both at once.
        taken = not spark.sparkContext._jvm.java.io.File(path.toUri().getPath()).createNewFile()
    else:
        try:
            files.create(path, False).close()
            taken = False
        except Py4JJavaError as error:
            if "AlreadyExists" not in error.java_exception.getClass().getName():
                raise
            taken = True
    if taken:
        raise FileExistsError(f"{path}: another publisher came first")


def _log_path(location: str) -> str:
    return f"{location.rstrip('/')}/published"


def newest_run(spark: SparkSession, log: str) -> Row | None:
    """The newest entry of a log, if there is one."""
    try:
        entries = spark.read.schema(LOG_SCHEMA).parquet(log)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    newest = F.max(F.struct("number", "published_at", "run"))
    return entries.agg(newest.alias("entry")).first()["entry"]


def published_run(spark: SparkSession, location: str) -> str:
    """The run that readers see."""
    newest = newest_run(spark, _log_path(location))
    if newest is None:
        raise FileNotFoundError(f"nothing was published at {location}")
    return newest["run"]


def attach(spark: SparkSession, spec: TableSpec, location: str) -> DataFrame:
    """Show a published table in a session that did not write it."""
    run = published_run(spark, location)
    _register(spark, spec, location, run)
    return _show(spark, spec, run)


def _show(spark: SparkSession, spec: TableSpec, run: str) -> DataFrame:
    # The view restores the declared column order; files keep partition columns last.
    columns = ", ".join(map(_quoted, spec.published_schema.names))
    stored = _named(version(spec, run))
    spark.sql(f"CREATE OR REPLACE VIEW {_named(spec)} AS SELECT {columns} FROM {stored}")
    return spark.table(_named(spec))
