"""Row filters and projections driven by a table spec."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import datetime
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from smeltery.functions.columns import ingestion_stamp, present
from smeltery.functions.text import clean_text, clean_together
from smeltery.spec import TableSpec


def fields_of(df: DataFrame, columns: Iterable[str]) -> list[T.StructField]:
    """The named fields; an unknown name is an analysis error."""
    return project(df, columns).schema.fields


def keep_required(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Keep the rows in which every one of ``columns`` is present."""
    rules = [present(f) for f in fields_of(df, columns)]
    return df.filter(reduce(and_, rules)) if rules else df


def project(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Exactly ``columns``, in that order."""
    return df.select(*[F.col(f"`{c}`") for c in columns])


def stamp(df: DataFrame, column: str, as_of: datetime | None = None) -> DataFrame:
    """Append the ingestion timestamp."""
    return df.withColumn(column, ingestion_stamp(as_of))


def with_cleaned(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Replace each of ``columns`` by its ASCII form."""
    if len(columns) == 1:
        return df.withColumn(columns[0], clean_text(f"`{columns[0]}`"))
    cleaned = df.select("*", clean_together(columns).alias("__cleaned"))
    return cleaned.withColumns({c: F.col("__cleaned")[c] for c in columns}).drop("__cleaned")


def conform(df: DataFrame, spec: TableSpec, as_of: datetime | None = None) -> DataFrame:
    """Clean, filter, upper-case, project and stamp, in that order.

    Text that is null or empty is still so once cleaned, so the required rule is
    first applied to the raw columns, where it reaches the scan. Cleaning can
    also empty a text, so it is applied again to the cleaned ones.
    """
    raw = project(keep_required(df, spec.required), spec.columns)
    if spec.clean:
        raw = with_cleaned(raw, spec.clean)
        raw = keep_required(raw, [c for c in spec.required if c in spec.clean])
        raw = raw.withColumns({c: F.upper(f"`{c}`") for c in spec.clean})
    return raw if spec.stamp is None else stamp(raw, spec.stamp, as_of)
