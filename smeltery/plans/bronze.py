"""Bronze: land raw records by day and audit what was landed."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from smeltery.functions.columns import day_folder
from smeltery.operators import quality
from smeltery.sources import pages, tables
from smeltery.spec import TableSpec


def audit(
    spark: SparkSession,
    folder: str,
    spec: TableSpec,
    layout: str = "lines",
    landed: int | None = None,
    names: Sequence[str] | None = None,
) -> DataFrame:
    """Report: rows exist, no declared column is absent, no record is unreadable.

    One scan parses every declared column and, unless the ``names`` that occur in the
    records are given, tells which of the declared ones do. ``landed`` is the number of
    records the source had, if known.
    """
    checks = [quality.not_empty(), *quality.no_corrupt_records(spec.columns)]
    if landed is not None:
        checks.append(quality.at_least(landed))
    if names is None:
        records = pages.read_with_names(spark, folder, spec.schema, layout)
        return quality.measured(records, [*checks, quality.all_named(spec.columns, pages.NAMES)])
    records = pages.read_pages(spark, folder, spec.schema, layout, corrupt=True)
    return quality.combined(
        [
            quality.measured(records, checks),
            quality.no_missing_columns(spark, spec.columns, names),
        ]
    )


def ingest(
    df: DataFrame,
    base: str,
    spec: TableSpec,
    as_of: datetime,
    records_per_file: int | None = None,
    landed: int | None = None,
    raw: bool = False,
) -> str:
    """Land rows, or with ``raw`` the text of a ``record`` column, as a run of the day.

    The run is audited where no reader looks; only then the day's log names it. A refused
    run leaves the day as it was.
    """
    spark, run = df.sparkSession, tables.new_run(as_of)
    if raw:
        folder = pages.land_records(df, base, as_of, records_per_file, run)
        names = None
    else:
        # Rows are landed with every field, so the names need no scan.
        folder = pages.land_rows(df, base, as_of, records_per_file, run)
        names = df.columns
    quality.gate(audit(spark, folder, spec, landed=landed, names=names))
    tables.log_run(spark, _log(base, as_of), run)
    return folder


def _log(base: str, as_of: datetime) -> str:
    return f"{day_folder(base, as_of)}/_landed"


def landed_folder(spark: SparkSession, base: str, as_of: datetime) -> str:
    """The folder of the run that the day's log names last."""
    newest = tables.newest_run(spark, _log(base, as_of))
    if newest is None:
        raise FileNotFoundError(f"nothing was landed at {day_folder(base, as_of)}")
    return pages.run_folder(base, as_of, newest["run"])
