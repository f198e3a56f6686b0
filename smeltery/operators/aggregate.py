"""Counts: per group, of a whole table, of duplicate keys and of missing values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from smeltery.functions.columns import null_or_nan
from smeltery.operators.shape import conform, fields_of, keep_required
from smeltery.spec import CountSpec, TableSpec


def narrowed(total: Column, to: T.DataType) -> Column:
    """A count as the declared type. One that does not fit ends the job, with or without ANSI."""
    if isinstance(to, T.LongType):
        return total
    value = total.cast(to)
    excess = F.format_string(f"%d rows do not fit {to.simpleString()}", total)
    return F.when(value.cast("bigint") == total, value).otherwise(F.raise_error(excess))


def count_by(df: DataFrame, spec: CountSpec) -> DataFrame:
    """Rows per group. Counted before the shuffle, so a hot group moves as one row per task."""
    total = narrowed(F.count("*"), spec.quantity_type)
    return df.groupBy(*spec.keys).agg(total.alias(spec.quantity))


def count_conformed(df: DataFrame, source: TableSpec, spec: CountSpec) -> DataFrame:
    """Rows per conformed group, straight from raw rows.

    Equal to ``count_by(conform(df, source), spec)``, but the raw groups are
    counted first, so text is cleaned once per distinct value, not per row.
    """
    cleaned = [c for c in source.required if c in source.clean]
    raw_keys = list(dict.fromkeys([*spec.keys, *cleaned]))
    rows = T.StructField("__rows", T.LongType())
    groups = (
        keep_required(df, source.required).groupBy(*raw_keys).agg(F.count("*").alias(rows.name))
    )
    total = narrowed(F.sum(rows.name), spec.quantity_type)
    return (
        conform(groups, source.narrowed(raw_keys, rows))
        .groupBy(*spec.keys)
        .agg(total.alias(spec.quantity))
    )


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n"))


def duplicate_groups(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key groups of more than one row, with their size. Null keys equal each other."""
    return df.groupBy(*keys).agg(F.count("*").alias("quantity")).filter(F.col("quantity") > 1)


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: how many values of each column are null or NaN."""
    return df.agg(*[F.count_if(null_or_nan(f)).alias(f.name) for f in fields_of(df, columns)])


def preview(df: DataFrame, keys: Sequence[str], rows: int = 30) -> DataFrame:
    """The first ``rows`` rows by ``keys``."""
    return df.orderBy(*keys).limit(rows)
