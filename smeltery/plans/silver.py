"""Silver: conformed rows, audited before readers see them."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame

from smeltery.operators import quality
from smeltery.operators.shape import conform
from smeltery.sources import tables
from smeltery.spec import TableSpec


def audit(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Report: rows exist and the key is unique."""
    return quality.keyed(df, spec.key)


def refresh(df: DataFrame, spec: TableSpec, location: str, as_of: datetime) -> DataFrame:
    """Conform raw rows, stage them, audit what was stored, publish.

    Where ``df`` has the text of unreadable records, they are counted by the write itself
    and stop the run before anything is shown.
    """
    run, watched = tables.new_run(as_of), None
    if quality.CORRUPT in df.columns:
        watched = quality.Watch(quality.no_corrupt_records(spec.columns))
        df = watched.over(df).drop(quality.CORRUPT)
    staged = tables.stage(conform(df, spec, as_of), spec, location, run)
    if watched is not None:
        watched.gate()
    quality.gate(audit(staged, spec))
    return tables.publish(df.sparkSession, spec, location, run)
