"""Tables written to the folder that the cluster shares, to cut lineage between stages."""

from __future__ import annotations

import gc

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from smeltery.session import shared_folder, small_batches as small_batches


def written(df: DataFrame) -> DataFrame:
    """``df`` as a table in the shared folder; what is lost with an executor is read again."""
    spark = df.sparkSession
    path = shared_folder(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def released(spark: SparkSession) -> None:
    """Let Spark delete shuffles that no plan refers to any more.

    It does so when the driver collects its garbage, which in a long chain of small jobs
    comes late: until then their files stay, and so do their plans.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def forget(df: DataFrame) -> None:
    """Delete the files of a table of ``written`` that nothing reads any more."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    for folder in {name.rpartition("/")[0] for name in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def and_fields(fields: list[T.StructField], more: str) -> T.StructType:
    """A schema of ``fields`` and those of the DDL ``more``; names may be any."""
    return T.StructType([*fields, *T.StructType.fromDDL(more).fields])


def remainder(column: str, by: int) -> F.Column:
    """crc32 of a column as text, modulo ``by``; a null counts as the empty text."""
    text = F.coalesce(F.col(column).cast("string"), F.lit(""))
    return F.crc32(F.encode(text, "UTF-8")) % by


SLOTS = 1 << 20


def _slot(*ids: str) -> F.Column:
    return F.pmod(F.xxhash64(*ids), F.lit(SLOTS)).alias("slot")


def parted(docs: DataFrame, ids: DataFrame, *names: str) -> tuple[DataFrame, DataFrame]:
    """``docs`` whose doc_id may be among ``ids`` (doc_id), and those whose is surely not.

    Other ``names`` of columns may stand for doc_id. Ids are hashed to a fixed number of slots,
    so what is broadcast is bounded whatever the tables hold; the join that follows then moves
    fewer texts.
    """
    slot = _slot(*(names or ("doc_id",)))
    slots = F.broadcast(ids.select(slot).distinct().hint("coalesce", 1))
    own = docs.withColumn("slot", slot)
    return own.join(slots, "slot", "left_semi").drop("slot"), own.join(slots, "slot", "left_anti").drop("slot")
