"""Bronze, silver, silver audit, gold: a stage that fails stops the rest."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from smeltery.operators import quality
from smeltery.plans import bronze, gold, silver
from smeltery.sources import pages, tables
from smeltery.spec import CountSpec, TableSpec


@dataclass(frozen=True)
class Pipeline:
    """The tables of a pipeline and where they live below ``lake``.

    Each stage can run in an application of its own, finding what the previous
    one published; ``run`` chains them in one.
    """

    lake: str
    table: TableSpec
    counts: CountSpec

    def path(self, layer: str, name: str) -> str:
        return f"{self.lake.rstrip('/')}/{layer}/{name}"

    @property
    def bronze_base(self) -> str:
        return self.path("bronze", self.table.name)

    @property
    def silver_location(self) -> str:
        return self.path("silver", self.table.name)

    @property
    def gold_location(self) -> str:
        return self.path("gold", self.counts.name)

    def ingest(
        self,
        source: DataFrame,
        as_of: datetime,
        records_per_file: int | None = None,
        landed: int | None = None,
        raw: bool = False,
    ) -> str:
        """Land rows, or with ``raw`` records, as the day's audited run."""
        return bronze.ingest(
            source, self.bronze_base, self.table, as_of, records_per_file, landed, raw
        )

    def landed(self, spark: SparkSession, as_of: datetime) -> str:
        """The folder of the day's audited run."""
        return bronze.landed_folder(spark, self.bronze_base, as_of)

    def conform(
        self,
        spark: SparkSession,
        as_of: datetime,
        layout: str = "lines",
        folder: str | None = None,
    ) -> DataFrame:
        """Publish the records of the day's run, or of ``folder``, as the silver table."""
        folder = folder or self.landed(spark, as_of)
        records = pages.read_pages(spark, folder, self.table.schema, layout, corrupt=True)
        return silver.refresh(records, self.table, self.silver_location, as_of)

    def silver(self, spark: SparkSession) -> DataFrame:
        return tables.attach(spark, self.table, self.silver_location)

    def audit(self, spark: SparkSession) -> None:
        """Audit the published silver table once more."""
        quality.gate(silver.audit(self.silver(spark), self.table))

    def count(self, silver_rows: DataFrame, as_of: datetime) -> DataFrame:
        """Publish the counts of the silver table."""
        return gold.refresh(silver_rows, self.table, self.counts, self.gold_location, as_of)

    def gold(self, spark: SparkSession) -> DataFrame:
        return tables.attach(spark, self.counts.table(self.table), self.gold_location)

    def run(
        self,
        source: DataFrame,
        as_of: datetime,
        records_per_file: int | None = None,
        landed: int | None = None,
        raw: bool = False,
    ) -> DataFrame:
        """All stages. ``as_of`` names the day's folder and stamps every row."""
        self.ingest(source, as_of, records_per_file, landed, raw)
        return self.count(self.conform(source.sparkSession, as_of), as_of)
