"""Paged record sources as Python data sources.

Executors request the pages; the driver asks only for the total. A source is a
``PagedSource`` whose ``fetcher`` says how to get the total and one page.
"""

from __future__ import annotations

import json
from abc import ABC, abstractmethod
from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from urllib.parse import quote
from urllib.request import urlopen

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from smeltery.operators.quality import CORRUPT
from smeltery.session import small_batches
from smeltery.sources.pages import PAGE_ROWS, TOTAL

# Beyond this many tasks per core, neighbouring pages share a task.
TASKS_PER_CORE = 2


class PageFetcher(ABC):
    """How to reach the records; shipped to executors."""

    @abstractmethod
    def total(self) -> int:
        """How many records there are."""

    @abstractmethod
    def page(self, number: int) -> str:
        """A page, counted from 1: the text of a JSON array. Raises if it cannot be had."""


@dataclass
class UrlFetcher(PageFetcher):
    """Pages behind URLs; ``{page}`` and ``{per_page}`` are filled in."""

    meta_url: str
    page_url: str
    per_page: int
    timeout: float = 60.0

    def _get(self, url: str) -> str:
        with urlopen(url, timeout=self.timeout) as response:
            return response.read().decode("utf-8")

    def total(self) -> int:
        return int(json.loads(self._get(self.meta_url))[TOTAL])

    def page(self, number: int) -> str:
        return self._get(self.page_url.format(page=number, per_page=self.per_page))


@dataclass
class FolderFetcher(PageFetcher):
    """Pages in a shared folder, laid out as by ``write_pages``.

    ``root`` is a full URI, or a path if every machine mounts the folder.
    """

    root: str

    def _get(self, child: str) -> str:
        import pyarrow.fs as pafs  # only where pages are read

        fs, path = pafs.FileSystem.from_uri(self.root.replace("s3a://", "s3://", 1))
        found = fs.get_file_info(pafs.FileSelector(f"{path}/{child}"))
        files = [f.path for f in found if f.is_file and f.base_name[0] not in "._"]
        if len(files) != 1:
            raise FileNotFoundError(f"{self.root}/{child}: expected one file, found {len(files)}")
        with fs.open_input_stream(files[0]) as stream:
            return stream.read().decode("utf-8")

    def total(self) -> int:
        return int(json.loads(self._get("meta"))[TOTAL])

    def page(self, number: int) -> str:
        return self._get(f"pages/page={number}")


@dataclass
class PageRange(InputPartition):
    first: int
    last: int


class PagedReader(DataSourceReader):
    def __init__(
        self, fetcher: PageFetcher, per_page: int, max_tasks: int, total: int | None = None
    ) -> None:
        self.fetcher = fetcher
        self.per_page = per_page
        self.max_tasks = max_tasks
        self.total = fetcher.total() if total is None else total

    def partitions(self) -> list[PageRange]:
        pages = -(-self.total // self.per_page)
        width = max(1, -(-pages // self.max_tasks))
        ranges = [PageRange(p, min(p + width - 1, pages)) for p in range(1, pages + 1, width)]
        return ranges or [PageRange(1, 0)]

    def read(self, partition: PageRange) -> Iterator[pa.RecordBatch]:
        for number in range(partition.first, partition.last + 1):
            due = min(self.per_page, self.total - (number - 1) * self.per_page)
            yield pa.RecordBatch.from_pydict(
                {
                    "page": pa.array([number], pa.int64()),
                    "due": pa.array([due], pa.int64()),
                    "body": pa.array([self.fetcher.page(number)], pa.string()),
                }
            )


class PagedSource(DataSource):
    """One row per page: its number, the records due on it and its text.

    Options: ``maxTasks`` and ``perPage``, plus what the fetcher needs. ``total`` is the
    number of records if it was asked for already.
    """

    def schema(self) -> str:
        return "page bigint, due bigint, body string"

    @property
    def per_page(self) -> int:
        return int(self.options.get("perPage", PAGE_ROWS))

    def fetcher(self) -> PageFetcher:
        raise NotImplementedError

    def reader(self, schema) -> PagedReader:
        known = self.options.get("total")
        tasks = int(self.options["maxTasks"])
        return PagedReader(self.fetcher(), self.per_page, tasks, known and int(known))


class UrlPages(PagedSource):
    """Options ``metaUrl`` and ``pageUrl``."""

    @classmethod
    def name(cls) -> str:
        return "url_pages"

    def fetcher(self) -> PageFetcher:
        return UrlFetcher(self.options["metaUrl"], self.options["pageUrl"], self.per_page)


class FolderPages(PagedSource):
    """Option ``root``, a folder that every executor can reach."""

    @classmethod
    def name(cls) -> str:
        return "folder_pages"

    def fetcher(self) -> PageFetcher:
        return FolderFetcher(self.options["root"])


def read_source(
    spark: SparkSession,
    source: type[PagedSource],
    options: Mapping[str, object],
    schema: T.StructType | None = None,
) -> DataFrame:
    """The records of all pages: under ``schema`` if given, else as they came.

    As they came means rows of ``(page, record)``, each record as its own JSON
    text, character by character. A page that cannot be read or holds fewer records than
    due ends the job, and so does a record that ``schema`` cannot read whole.
    """
    spark.dataSource.register(source)
    # However many pages a task has, few are in memory at once.
    small_batches(spark)
    tasks = TASKS_PER_CORE * spark.sparkContext.defaultParallelism
    options = {"maxTasks": tasks, **options}
    fetched = spark.read.format(source.name()).options(**options).load()
    cut = fetched.mapInArrow(_cut, "page bigint, record string")
    if schema is None:
        return cut
    full = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
    row = F.from_json("record", full, {"columnNameOfCorruptRecord": CORRUPT})
    complaint = F.format_string("page %d has a record that cannot be read: %s", "page", "record")
    lost = F.col("row").isNull() | F.col(f"row.{CORRUPT}").isNotNull()
    whole = F.when(lost, F.raise_error(complaint)).otherwise(F.col("row"))
    parsed = cut.select("page", "record", row.alias("row")).select(whole.alias("row"))
    return parsed.select("row.*").drop(CORRUPT)


def records_in(body: str) -> list[str]:
    """The texts of the records of a JSON array, character by character as they came."""
    decoder, at, out = json.JSONDecoder(), _past_space(body, 0), []
    if body[at : at + 1] != "[":
        raise ValueError("no JSON array")
    at = _past_space(body, at + 1)
    while body[at : at + 1] != "]":
        end = decoder.raw_decode(body, at)[1]
        out.append(body[at:end])
        at = _past_space(body, end)
        if body[at : at + 1] == ",":
            at = _past_space(body, at + 1)
            if body[at : at + 1] == "]":
                raise ValueError("a record is missing")
        elif body[at : at + 1] != "]":
            raise ValueError("the array has no end")
    return out


def _past_space(body: str, at: int) -> int:
    while body[at : at + 1] in (" ", "\t", "\n", "\r"):
        at += 1
    return at


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The records of each page; a page with fewer than are due ends the job."""
    for batch in batches:
        for k in range(batch.num_rows):
            page = batch.slice(k, 1).to_pylist()[0]
            try:
                found = records_in(page["body"])
            except ValueError as error:
                raise ValueError(f"page {page['page']} has no whole array: {error}") from error
            if len(found) < page["due"]:
                raise ValueError(
                    f"page {page['page']} has {len(found)} records, expected {page['due']}"
                )
            yield pa.RecordBatch.from_pydict(
                {
                    "page": pa.array([page["page"]] * len(found), pa.int64()),
                    "record": pa.array(found, pa.string()),
                }
            )


def read_folder(
    spark: SparkSession, root: str, per_page: int = PAGE_ROWS, schema: T.StructType | None = None
) -> DataFrame:
    """The records that ``write_pages`` left below ``root``, on any file system Spark knows."""
    # Spark resolves the path; tasks see its full URI.
    meta = spark.read.text(f"{root}/meta").inputFiles()[0]
    full = quote(meta[: meta.rindex("/meta/")], safe=":/%")
    return read_source(spark, FolderPages, {"root": full, "perPage": per_page}, schema)


def folder_total(spark: SparkSession, root: str) -> int:
    """How many records ``write_pages`` left below ``root``."""
    return spark.read.json(f"{root}/meta").first()[TOTAL]
