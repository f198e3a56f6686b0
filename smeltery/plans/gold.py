"""Gold: counts per group, audited before readers see them."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smeltery.operators import quality
from smeltery.operators.aggregate import count_by
from smeltery.operators.shape import stamp
from smeltery.sources import tables
from smeltery.spec import CountSpec, TableSpec


def audit(counts: DataFrame, spec: CountSpec) -> DataFrame:
    """Report: the input has rows, groups are unique and no value is missing.

    One pass over the counts, which are small; their sum is the number of input rows.
    """
    missing = quality.no_nulls(counts, [*spec.keys, spec.quantity])
    groups = counts.groupBy(*spec.keys).agg(
        F.sum(spec.quantity).alias("rows"),
        F.count("*").alias("size"),
        missing.measure.alias("missing"),
    )
    rows = F.coalesce(F.sum("rows"), F.lit(0))
    absent = F.coalesce(F.sum("missing"), F.lit(0))
    twice = F.count_if(F.col("size") > 1)
    return quality.measured(
        groups,
        [
            quality.Check("input_not_empty", rows, rows > 0),
            quality.Check("unique_rows", twice, twice == 0),
            quality.Check("no_nulls", absent, absent == 0),
        ],
    )


def refresh(
    silver: DataFrame, source: TableSpec, spec: CountSpec, location: str, as_of: datetime
) -> DataFrame:
    """Count, stage the counts once, audit what was stored, publish."""
    table = spec.table(source)
    counts = count_by(silver, spec)
    if table.stamp is not None:
        counts = stamp(counts, table.stamp, as_of)
    run = tables.new_run(as_of)
    staged = tables.stage(counts, table, location, run)
    quality.gate(audit(staged, spec))
    return tables.publish(silver.sparkSession, table, location, run)
