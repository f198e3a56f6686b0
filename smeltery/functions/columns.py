"""Predicates, stamps and day paths."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

DAY_FORMAT = "yyyy/MM/dd"


def present(field: T.StructField) -> Column:
    """Not null and, for text, not empty. Blanks count as present."""
    column = F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.StringType):
        return column.isNotNull() & (column != "")
    return column.isNotNull()


def null_or_nan(field: T.StructField) -> Column:
    """Null, or NaN where the type has one."""
    column = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.FloatType, T.DoubleType)):
        return column.isNull() | F.isnan(column)
    return column.isNull()


def ingestion_stamp(as_of: datetime | None = None) -> Column:
    """The fixed ``as_of`` of a run in the session's zone, else the query's own time."""
    if as_of is None:
        return F.current_timestamp()
    return F.lit(as_of.isoformat(sep=" ")).cast("timestamp")


def day_path(column: Column | str) -> Column:
    """Zero-padded landing path of a day, as in ``2024/01/05``."""
    return F.date_format(column, DAY_FORMAT)


def day_folder(base: str, as_of: datetime) -> str:
    """Landing folder of a run's day below ``base``."""
    return f"{base.rstrip('/')}/{as_of:%Y/%m/%d}"
