"""Data-quality checks as small frames, and the gate that stops a run.

A check is a row ``(check_name, passed, measure)``. Every check has the same polarity:
``passed`` is true when the data is good.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import add, and_

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from smeltery.functions.columns import null_or_nan
from smeltery.operators.aggregate import duplicate_groups, null_counts
from smeltery.operators.shape import fields_of

CORRUPT = "_corrupt_record"


class QualityError(Exception):
    """Raised by the gate, naming every check that failed."""


@dataclass(frozen=True)
class Check:
    """A check measured by one aggregate over a frame."""

    name: str
    measure: Column
    passed: Column


def _none(name: str, bad: Column) -> Check:
    return Check(name, F.count_if(bad), F.count_if(bad) == 0)


def not_empty(name: str = "not_empty") -> Check:
    return Check(name, F.count("*"), F.count("*") > 0)


def at_least(rows: int, name: str = "all_rows_landed") -> Check:
    return Check(name, F.count("*"), F.count("*") >= rows)


def no_nulls(df: DataFrame, columns: Sequence[str], name: str = "no_nulls") -> Check:
    bad = reduce(add, [F.count_if(null_or_nan(f)) for f in fields_of(df, columns)])
    return Check(name, bad, bad == 0)


def no_corrupt_records(columns: Sequence[str]) -> list[Check]:
    """Records lost as a whole, and records that lost some of ``columns``.

    Every column is referenced, so that none is pruned from the parse and an
    unreadable value is noticed wherever it is.
    """
    corrupt = F.col(CORRUPT).isNotNull()
    blank = reduce(and_, [F.col(f"`{c}`").isNull() for c in columns])
    return [
        _none("no_lost_records", corrupt & blank),
        _none("no_unreadable_values", corrupt & ~blank),
    ]


def all_named(columns: Sequence[str], names: str, name: str = "no_missing_columns") -> Check:
    """Each of ``columns`` is in the array ``names`` of at least one row, by exact spelling.

    One flag per column is merged, whatever names and how many rows there are.
    """
    seen = [F.coalesce(F.bool_or(F.array_contains(names, c)), F.lit(False)) for c in columns]
    absent = reduce(add, [F.when(s, 0).otherwise(1) for s in seen])
    return Check(name, absent, absent == 0)


def measured(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """The report of several checks over ``df``, in a single pass."""
    results = [
        F.struct(
            F.lit(c.name).alias("check_name"),
            c.passed.alias("passed"),
            c.measure.cast("bigint").alias("measure"),
        ).alias(f"check_{i}")
        for i, c in enumerate(checks)
    ]
    return df.agg(*results).select(
        F.inline(F.array(*[f"check_{i}" for i in range(len(checks))]))
    )


def keyed(df: DataFrame, keys: Sequence[str], not_empty_too: bool = True) -> DataFrame:
    """Report on duplicate keys, measuring the groups of more than one row.

    An empty frame has none. That rows exist at all follows from the same group
    sizes, so both checks share one scan and one shuffle of the key.
    """
    sizes = df.groupBy(*keys).agg(F.count("*").alias("quantity"))
    rows = F.coalesce(F.sum("quantity"), F.lit(0))
    unique = _none("unique_rows", F.col("quantity") > 1)
    checks = [Check("not_empty", rows, rows > 0)] if not_empty_too else []
    return measured(sizes, [*checks, unique])


def missing_columns(expected: Sequence[str], actual: Sequence[str]) -> list[str]:
    """Expected names that are absent, by exact spelling. Extra names do not matter."""
    known = set(actual)
    return [c for c in expected if c not in known]


def missing_columns_frame(df: DataFrame, expected: Sequence[str]) -> DataFrame:
    """The absent names, one per row."""
    names = F.array_except(
        F.array(*[F.lit(c) for c in expected]), F.array(*[F.lit(c) for c in df.columns])
    )
    return df.sparkSession.range(0, 1, 1, 1).select(F.explode(names).alias("missing_column"))


def no_missing_columns(
    spark: SparkSession,
    expected: Sequence[str],
    actual: Sequence[str],
    name: str = "no_missing_columns",
) -> DataFrame:
    absent = len(missing_columns(expected, actual))
    return spark.range(0, 1, 1, 1).select(
        F.lit(name).alias("check_name"),
        F.lit(absent == 0).alias("passed"),
        F.lit(absent).cast("bigint").alias("measure"),
    )


def combined(reports: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, reports)


def gate(report: DataFrame) -> list[Row]:
    """Evaluate every check, then raise if any failed. Collects one row per check."""
    rows = report.collect()
    failed = [f"{r['check_name']} ({r['measure']})" for r in rows if not r["passed"]]
    if failed:
        raise QualityError("failed checks: " + ", ".join(failed))
    return rows


class Watch:
    """Checks that are measured while a frame is written, without a scan of their own.

    Each check must count what is bad.
    """

    def __init__(self, checks: Sequence[Check]) -> None:
        self.checks, self.seen = checks, Observation()

    def over(self, df: DataFrame) -> DataFrame:
        return df.observe(self.seen, *[c.measure.alias(c.name) for c in self.checks])

    def gate(self) -> None:
        failed = [f"{name} ({bad})" for name, bad in self.seen.get.items() if bad]
        if failed:
            raise QualityError("failed checks: " + ", ".join(failed))


# Plain answers for interactive use.


def has_rows(df: DataFrame) -> bool:
    return not df.isEmpty()


def has_columns(expected: Sequence[str], actual: Sequence[str]) -> bool:
    return not missing_columns(expected, actual)


def has_unique_rows(df: DataFrame, keys: Sequence[str]) -> bool:
    return duplicate_groups(df, keys).isEmpty()


def has_no_nulls(df: DataFrame, columns: Sequence[str]) -> bool:
    return not any(null_counts(df, columns).first())
