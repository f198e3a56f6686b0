"""The corpus pipeline: quality rules, line dedup, near-dedup, decontamination, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as Parquet
to the shared folder and reads it again as the documents of the next stage. All stages but
the last return the columns of ``documents``; other columns are left out. Rows with a null
doc_id pass the stages that tell documents apart by it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from smeltery.llm import decontaminate, divergence, lines, near_duplicates, packing
from smeltery.llm.shared import parted, written

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Near-duplicates of this pipeline agree in runs of five words.
SHINGLE_WORDS = 5


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and lie near a language go on."""
    return divergence.judge(docs.select(*COLUMNS)).where("kept").select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each line that is like an earlier one goes, and documents that lose all their words.

    Where lines went, n_chars is counted anew.
    """
    kept = lines.deduplicated(docs.select(*COLUMNS))
    kept = kept.where((F.col("n_removed") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    counted = F.when(F.col("n_removed") > 0, F.char_length("text").cast("long"))
    return kept.withColumn("n_chars", F.coalesce(counted, "n_chars")).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id stays."""
    docs = docs.select(*COLUMNS)
    gone = near_duplicates.grouped(docs, size=SHINGLE_WORDS).select("doc_id")
    near, rest = parted(docs, gone)
    return near.join(gone, "doc_id", "left_anti").unionByName(rest)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of ``benchmark`` go."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate.marked(docs.select(*COLUMNS), benchmark.select("item_id", "text"))
    return found.where(F.size("items") == 0).select(*COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents that are left, in windows of 4096 tokens."""
    return packing.pack(docs.select("doc_id", "text"))


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("near-dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", packed),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir))
    return docs
