"""Entry points: the flagship query, every registered query and its SQL oracle.

Each query takes a session and a folder of Parquet tables. Queries about landing
or storing write below the session's shared folder, each to a path of its own.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from smeltery.functions.columns import day_path, null_or_nan
from smeltery.functions.text import clean_text, upper_clean
from smeltery.operators import quality
from smeltery.operators.aggregate import (
    count_by,
    count_conformed,
    duplicate_groups,
    null_counts,
    preview,
    row_count,
)
from smeltery.operators.shape import conform, keep_required, project, stamp
from smeltery.plans import bronze, gold, silver
from smeltery.plans.pipeline import Pipeline
from smeltery.session import shared_folder
from smeltery.sources import pages, paged, tables
from smeltery.spec import CountSpec, TableSpec

SMOKE_DIR = "/root/testdata/sf0.001"
AS_OF = datetime(2024, 1, 5)
PER_PAGE = 4_000

DOCUMENTS = TableSpec(
    "documents",
    {"doc_id": "long", "text": "string", "lang": "string", "source": "string", "n_chars": "long"},
    key=("doc_id",),
    required=("doc_id", "lang", "source"),
    clean=("source",),
    partition_by=("source",),
)
BY_LANG = replace(DOCUMENTS, clean=(), partition_by=("lang",), stamp=None)
QUANTITY = CountSpec("documents_by_source", ("source", "lang"))
NARROW = replace(QUANTITY, quantity_type=T.IntegerType())
CONVERSATIONS = TableSpec(
    "conversations",
    {"conv_id": "long", "turn": "long", "role": "string", "text": "string"},
    key=("conv_id", "turn"),
    stamp=None,
)
WEB_PAGES = TableSpec(
    "pages",
    {"page_id": "long", "url": "string", "html": "string"},
    key=("page_id",),
    required=("page_id", "url", "html"),
    clean=("url", "html"),
    stamp=None,
)
CUSTOMER = TableSpec(
    "customer",
    {
        "c_custkey": "long",
        "c_name": "string",
        "c_nationkey": "integer",
        "c_acctbal": "double",
        "c_mktsegment": "string",
    },
    key=("c_custkey",),
    required=("c_custkey", "c_mktsegment"),
    stamp=None,
)
ORDERS = TableSpec(
    "orders",
    {
        "o_orderkey": "long",
        "o_custkey": "long",
        "o_orderstatus": "string",
        "o_totalprice": "double",
        "o_orderdate": "timestamp_ntz",
        "o_orderpriority": "string",
    },
    key=("o_orderkey",),
    required=("o_orderkey",),
    stamp=None,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _renamed(spec: TableSpec) -> TableSpec:
    """The spec under a catalog name that no other query uses."""
    return replace(spec, name=f"{spec.name}_{uuid.uuid4().hex}")


def _records(df: DataFrame) -> DataFrame:
    """Each row as the JSON text of a record."""
    return df.select(F.to_json(F.struct("*"), pages.JSON_WRITING).alias("record"))


# Conforming


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_conformed(_table(spark, sf_dir, "documents"), DOCUMENTS, QUANTITY)


def clean_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _table(spark, sf_dir, "conversations")
    return df.select("conv_id", "turn", clean_text("text").alias("text_clean"))


def clean_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _table(spark, sf_dir, "documents")
    return df.select("doc_id", clean_text("text").alias("text_clean"))


def upper_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents").select(
        "doc_id", upper_clean("source").alias("source")
    )


def silver_conform(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform(_table(spark, sf_dir, "pages"), WEB_PAGES)


def silver_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_by(conform(_table(spark, sf_dir, "documents"), DOCUMENTS, AS_OF), QUANTITY)


def required_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    segment = F.col("c_mktsegment")
    df = _table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.when(segment == "MACHINERY", "")
        .when(segment != "BUILDING", segment)
        .alias("seg"),
    )
    return keep_required(df, ["c_custkey", "seg"])


def project_spec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project(
        _table(spark, sf_dir, "orders"), ["o_custkey", "o_orderkey", "o_orderstatus"]
    )


def ingestion_stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = stamp(_orders(spark, sf_dir), "dt_ingestion", AS_OF)
    return df.withColumn("dt_ingestion", F.col("dt_ingestion").cast("timestamp_ntz"))


def day_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    by_day = CountSpec("events_by_day", ("day",))
    return count_by(_table(spark, sf_dir, "events").select(day_path("ts").alias("day")), by_day)


# Landing and reading JSON


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All columns of ``orders``, its date as the stored clock time."""
    orders = _table(spark, sf_dir, "orders")
    return orders.withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp_ntz"))


def land_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times come back from a landing with all their digits."""
    events = _table(spark, sf_dir, "events")
    events = events.withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    folder = pages.land_rows(events, shared_folder(spark), AS_OF)
    return pages.read_pages(spark, folder, events.schema)


def refused_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A landing with cut records is refused, and the day's earlier one is read."""
    rows = _table(spark, sf_dir, "customer")
    base = shared_folder(spark)
    bronze.ingest(rows, base, CUSTOMER, AS_OF)
    spoiled = _records(rows).select(F.expr("left(record, length(record) - 9)").alias("record"))
    try:
        bronze.ingest(spoiled, base, CUSTOMER, AS_OF, raw=True)
    except quality.QualityError:
        return pages.read_pages(spark, bronze.landed_folder(spark, base, AS_OF), CUSTOMER.schema)
    raise AssertionError("spoiled records were landed")


def pipeline_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages, landing, audit, silver, audit, gold, at the pages' usual size."""
    documents, root = _table(spark, sf_dir, "documents"), shared_folder(spark)
    pages.write_pages(_records(documents), root)
    records = paged.read_folder(spark, root)
    counts = replace(QUANTITY, name=f"{QUANTITY.name}_{uuid.uuid4().hex}")
    whole = Pipeline(shared_folder(spark), _renamed(DOCUMENTS), counts)
    total = paged.folder_total(spark, root)
    return whole.run(records, AS_OF, landed=total, raw=True).drop(QUANTITY.stamp)


def run_stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The query's own time, which all its rows share."""
    stamped = stamp(_table(spark, sf_dir, "orders"), "dt_ingestion")
    return stamped.agg(F.count("*").alias("n"), F.count_distinct("dt_ingestion").alias("n_stamps"))


def land_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = pages.land_rows(_table(spark, sf_dir, "customer"), shared_folder(spark), AS_OF)
    return pages.read_pages(spark, folder, CUSTOMER.schema)


def land_again(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = _table(spark, sf_dir, "customer")
    base = shared_folder(spark)
    pages.land_rows(customer, base, AS_OF)
    smaller = customer.filter(F.col("c_mktsegment") == "BUILDING")
    return pages.read_pages(spark, pages.land_rows(smaller, base, AS_OF), CUSTOMER.schema)


def land_raw_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = _records(_table(spark, sf_dir, "conversations"))
    folder = pages.land_records(records, shared_folder(spark), AS_OF)
    return pages.read_pages(spark, folder, CONVERSATIONS.schema)


def read_json_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _records(_orders(spark, sf_dir))
    folder = pages.write_pages(orders, shared_folder(spark), PER_PAGE)
    return pages.read_pages(spark, folder, ORDERS.schema, layout="array")


def read_json_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = pages.land_rows(_table(spark, sf_dir, "customer"), shared_folder(spark), AS_OF)
    return pages.read_pages(spark, folder, None)


def src_paged(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, root = _orders(spark, sf_dir), shared_folder(spark)
    pages.write_pages(_records(orders), root, PER_PAGE)
    return paged.read_folder(spark, root, PER_PAGE, ORDERS.schema)


def ingest_paged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages are requested, landed by day unchanged, audited against the total, and read."""
    customer, root = _table(spark, sf_dir, "customer"), shared_folder(spark)
    pages.write_pages(_records(customer), root, PER_PAGE)
    records = paged.read_folder(spark, root, PER_PAGE)
    total = paged.folder_total(spark, root)
    folder = bronze.ingest(
        records, shared_folder(spark), CUSTOMER, AS_OF, landed=total, raw=True
    )
    return pages.read_pages(spark, folder, CUSTOMER.schema)


def corrupt_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns of the user are landed with a brace too many, so that they cannot be read, and
    the first turn of each conversation with a number that is none."""
    text = F.to_json(F.struct("*"))
    spoiled = (
        F.when(F.col("role") == "user", F.concat(F.lit("{"), text))
        .when(F.col("turn") <= 1, F.replace(text, F.lit('"turn":'), F.lit('"turn":"x",  "n":')))
        .otherwise(text)
    )
    records = _table(spark, sf_dir, "conversations").select(spoiled.alias("record"))
    folder = pages.land_records(records, shared_folder(spark), AS_OF)
    landed = pages.read_pages(spark, folder, CONVERSATIONS.schema, corrupt=True)
    checks = [quality.not_empty(), *quality.no_corrupt_records(CONVERSATIONS.columns)]
    return quality.measured(landed, checks)


# Tables


def table_create_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec, location = _renamed(BY_LANG), shared_folder(spark)
    tables.create_table(spark, spec, location)
    documents = project(_table(spark, sf_dir, "documents"), spec.columns)
    tables.overwrite_table(documents, spec, location)
    return spark.table(spec.name).select(*spec.columns)


def overwrite_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec, location = _renamed(BY_LANG), shared_folder(spark)
    documents = project(_table(spark, sf_dir, "documents"), spec.columns)
    tables.overwrite_table(documents, spec, location)
    tables.overwrite_table(documents, spec, location)
    return tables.load(spark, spec, location)


def partition_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table_create_write(spark, sf_dir)
    return df.filter(F.col("lang") == "de").select("doc_id")


def publish_attach(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two published versions; the later one is what a new reader attaches."""
    spec, location = _renamed(BY_LANG), shared_folder(spark)
    documents = project(_table(spark, sf_dir, "documents"), spec.columns)
    for rows in (documents.filter(F.col("lang") == "en"), documents):
        run = tables.new_run(AS_OF)
        tables.stage(rows, spec, location, run)
        tables.publish(spark, spec, location, run)
    return tables.attach(spark, _renamed(BY_LANG), location)


# Counts


def gold_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_by(_table(spark, sf_dir, "documents"), NARROW)


def gold_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = replace(NARROW, stamp=None).table(DOCUMENTS)
    path = shared_folder(spark)
    counts = count_by(_table(spark, sf_dir, "documents"), NARROW)
    tables.overwrite_path(counts, spec, path)
    tables.overwrite_path(counts, spec, path)
    return tables.load(spark, spec, path)


def preview_30(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preview(gold_count(spark, sf_dir), ["lang", "source"], 30)


def rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return row_count(_table(spark, sf_dir, "events"))


# Quality

LINE = ("l_orderkey", "l_linenumber")


def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_groups(_table(spark, sf_dir, "lineitem"), LINE)


def check_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.keyed(_table(spark, sf_dir, "lineitem"), LINE)


def null_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _table(spark, sf_dir, "documents")
    df = df.withColumn("lang", F.nullif("lang", F.lit("en")))
    return null_counts(df, ["doc_id", "lang", "n_chars"])


def null_nan_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = (
        F.when(F.col("event_type") == "error", float("nan"))
        .when(F.col("event_type") != "view", F.col("value"))
        .alias("value")
    )
    df = _table(spark, sf_dir, "events").select("event_type", value)
    return df.groupBy("event_type").agg(
        F.count_if(null_or_nan(df.schema["value"])).alias("bad"), F.count("*").alias("n")
    )


def check_not_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _table(spark, sf_dir, "events").filter(F.col("value") < 0)
    return quality.measured(events, [quality.not_empty()])


def missing_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    folder = pages.land_rows(documents, shared_folder(spark), AS_OF)
    landed = pages.read_pages(spark, folder, None)
    return quality.missing_columns_frame(landed, ["doc_id", "text", "url", "zzz"])


#: Values that the checks of missing values are to miss, by column.
SPOILED = {"lang": "en", "source": "src0"}


def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    spoiled = documents.withColumns({c: F.nullif(c, F.lit(v)) for c, v in SPOILED.items()})
    nulls = quality.no_nulls(spoiled, DOCUMENTS.required)
    return quality.combined(
        [
            quality.measured(spoiled, [quality.not_empty(), nulls]),
            quality.keyed(_table(spark, sf_dir, "lineitem"), LINE, not_empty_too=False),
        ]
    )


def audit_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of one source are cut, numbers of another are words, a column is renamed."""
    documents = _table(spark, sf_dir, "documents").withColumnRenamed("lang", "language")
    text = F.to_json(F.struct("*"), pages.JSON_WRITING)
    spoiled = (
        F.when(F.col("source") == "src1", F.concat(F.lit("{"), text))
        .when(F.col("source") == "src0", F.replace(text, F.lit('"n_chars":'), F.lit('"n_chars":"x", "n":')))
        .otherwise(text)
    )
    records = documents.select(spoiled.alias("record"))
    folder = pages.land_records(records, shared_folder(spark), AS_OF)
    # The source has announced its benchmark as well, which does not come.
    total = documents.count() + _table(spark, sf_dir, "benchmark").count()
    return bronze.audit(spark, folder, DOCUMENTS, landed=total)


def audit_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A conformed table as it was stored, whose key is the source: not unique."""
    spec = replace(_renamed(DOCUMENTS), key=("source", "lang"))
    documents, location = _table(spark, sf_dir, "documents"), shared_folder(spark)
    staged = tables.stage(conform(documents, spec, AS_OF), spec, location, tables.new_run(AS_OF))
    return silver.audit(staged, spec)


def audit_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts stored with one group twice and without the names of another."""
    documents, location = _table(spark, sf_dir, "documents"), shared_folder(spark)
    table = _renamed(replace(QUANTITY, stamp=None).table(DOCUMENTS))
    counts = count_by(documents, QUANTITY)
    counts = counts.unionByName(counts.where("lang = 'de'"))
    counts = counts.withColumn("source", F.nullif("source", F.lit("src0")))
    staged = tables.stage(counts, table, location, tables.new_run(AS_OF))
    return gold.audit(staged, QUANTITY)


def stages_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    table = _renamed(DOCUMENTS)
    counts = replace(QUANTITY, name=f"{QUANTITY.name}_{uuid.uuid4().hex}")
    published = Pipeline(shared_folder(spark), table, counts).run(documents, AS_OF)
    return published.drop(QUANTITY.stamp)


# SQL


def _clean(column: str) -> str:
    return f"regexp_replace(strip_accents({column}), '[^a-zA-Z0-9 ]', '_', 'g')"


_CONFORMED_COUNT = f"""
    select upper({_clean('source')}) as source, lang, count(*) as quantity
    from documents where source <> '' and lang <> '' group by 1, 2"""
_DOCUMENTS = "select doc_id, text, lang, source, n_chars from documents"
_CUSTOMER = "select c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment from customer"
_ORDERS = """
    select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
    from orders"""
_COUNT = "select lang, source, count(*)::int as quantity from documents group by 1, 2"
_LINE_SIZES = "(select count(*) as c from lineitem group by l_orderkey, l_linenumber)"
_UNIQUE_LINES = f"""
    select 'unique_rows' as check_name, count(*) filter (c > 1) = 0 as passed,
           count(*) filter (c > 1) as measure from {_LINE_SIZES}"""
_HAS_DOCUMENTS = """
    select 'not_empty' as check_name, count(*) > 0 as passed, count(*) as measure from documents"""


# Missing values are counted, not rows that have any.
_MISSING = """(count(*) filter (doc_id is null)
               + count(*) filter (nullif(lang, 'en') is null)
               + count(*) filter (nullif(source, 'src0') is null))"""
_TURNED = "count(*) filter (source = 'src0')"
_LOST = "count(*) filter (source = 'src1')"


_CATALOGUE: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {
    "flagship": (flagship, _CONFORMED_COUNT),
    "clean_text": (
        clean_conversations,
        f"select conv_id, turn, {_clean('text')} as text_clean from conversations",
    ),
    "clean_documents": (
        clean_documents,
        f"select doc_id, {_clean('text')} as text_clean from documents",
    ),
    "upper_clean": (
        upper_sources,
        f"select doc_id, upper({_clean('source')}) as source from documents",
    ),
    "silver_conform": (
        silver_conform,
        f"""select page_id, upper({_clean('url')}) as url, upper({_clean('html')}) as html
            from pages where url <> '' and html <> ''""",
    ),
    "silver_count": (silver_count, _CONFORMED_COUNT),
    "required_filter": (
        required_filter,
        """select c_custkey, c_mktsegment as seg from customer
           where c_mktsegment not in ('BUILDING', 'MACHINERY')""",
    ),
    "project_spec": (project_spec, "select o_custkey, o_orderkey, o_orderstatus from orders"),
    "ingestion_stamp": (
        ingestion_stamp,
        f"select *, timestamp '2024-01-05 00:00:00' as dt_ingestion from ({_ORDERS})",
    ),
    "day_folders": (
        day_folders,
        "select strftime(ts, '%Y/%m/%d') as day, count(*) as quantity from events group by 1",
    ),
    "land_json": (land_json, _CUSTOMER),
    "land_events": (land_events, "select * from events"),
    "refused_landing": (refused_landing, _CUSTOMER),
    "pipeline_run": (pipeline_run, _CONFORMED_COUNT),
    "run_stamp": (run_stamp, "select count(*) as n, least(count(*), 1) as n_stamps from orders"),
    "land_again": (land_again, f"{_CUSTOMER} where c_mktsegment = 'BUILDING'"),
    "land_raw_records": (
        land_raw_records,
        "select conv_id, turn, role, text from conversations",
    ),
    "read_json_pages": (read_json_pages, _ORDERS),
    "read_json_inferred": (
        read_json_inferred,
        """select c_acctbal, c_custkey, c_mktsegment, c_name,
                  c_nationkey::bigint as c_nationkey from customer""",
    ),
    "src_paged": (src_paged, _ORDERS),
    "ingest_paged": (ingest_paged, _CUSTOMER),
    "corrupt_records": (
        corrupt_records,
        """select 'not_empty' as check_name, count(*) > 0 as passed, count(*) as measure
           from conversations
           union all
           select 'no_lost_records', count(*) filter (role = 'user') = 0,
                  count(*) filter (role = 'user') from conversations
           union all
           select 'no_unreadable_values', count(*) filter (role <> 'user' and turn <= 1) = 0,
                  count(*) filter (role <> 'user' and turn <= 1) from conversations""",
    ),
    "table_create_write": (table_create_write, _DOCUMENTS),
    "overwrite_idempotent": (overwrite_idempotent, _DOCUMENTS),
    "partition_pruned": (partition_pruned, "select doc_id from documents where lang = 'de'"),
    "publish_attach": (publish_attach, _DOCUMENTS),
    "gold_count": (gold_count, _COUNT),
    "gold_overwrite": (gold_overwrite, _COUNT),
    "preview_30": (preview_30, f"{_COUNT} order by 1, 2 limit 30"),
    "row_count": (rows, "select count(*) as n from events"),
    "duplicate_keys": (
        duplicate_keys,
        """select l_orderkey, l_linenumber, count(*) as quantity from lineitem
           group by 1, 2 having count(*) > 1""",
    ),
    "check_unique": (
        check_unique,
        f"""select 'not_empty' as check_name, count(*) > 0 as passed, count(*) as measure
            from lineitem union all {_UNIQUE_LINES}""",
    ),
    "null_counts": (
        null_count,
        """select count(*) filter (doc_id is null) as doc_id,
                  count(*) filter (nullif(lang, 'en') is null) as lang,
                  count(*) filter (n_chars is null) as n_chars from documents""",
    ),
    "null_nan_counts": (
        null_nan_count,
        """select event_type, count(*) filter (event_type in ('error', 'view')) as bad,
                  count(*) as n from events group by 1""",
    ),
    "check_not_empty": (
        check_not_empty,
        """select 'not_empty' as check_name, count(*) > 0 as passed, count(*) as measure
           from events where value < 0""",
    ),
    "missing_columns": (
        missing_columns,
        """select c as missing_column from (select unnest(['doc_id', 'text', 'url', 'zzz']) as c)
           where c not in (select column_name from (describe documents))""",
    ),
    "quality_report": (
        quality_report,
        f"""{_HAS_DOCUMENTS} union all {_UNIQUE_LINES} union all
            select 'no_nulls', {_MISSING} = 0, {_MISSING} from documents""",
    ),
    "audit_bronze": (
        audit_bronze,
        f"""{_HAS_DOCUMENTS}
            union all select 'no_lost_records', {_LOST} = 0, {_LOST} from documents
            union all select 'no_unreadable_values', {_TURNED} = 0, {_TURNED} from documents
            union all select 'all_rows_landed',
                count(*) >= count(*) + (select count(*) from benchmark), count(*) from documents
            union all select 'no_missing_columns', count(*) = 0, count(*)
            from (select unnest(['doc_id', 'text', 'lang', 'source', 'n_chars']) as c)
            where c not in (select replace(column_name, 'lang', 'language')
                            from (describe documents))""",
    ),
    "audit_silver": (
        audit_silver,
        f"""{_HAS_DOCUMENTS} union all
            select 'unique_rows', count(*) = 0, count(*)
            from (select 1 from documents group by upper({_clean('source')}), lang
                  having count(*) > 1)""",
    ),
    "audit_gold": (
        audit_gold,
        """with counts as (
               select nullif(source, 'src0') as source, lang, count(*) as n
               from documents group by documents.source, lang),
           stored as (select * from counts union all select * from counts where lang = 'de')
           select 'input_not_empty' as check_name, sum(n) > 0 as passed,
                  sum(n)::bigint as measure from stored
           union all select 'unique_rows', count(*) = 0, count(*)
           from (select 1 from stored group by source, lang having count(*) > 1)
           union all select 'no_nulls', count(*) filter (source is null) = 0,
                  count(*) filter (source is null) from stored""",
    ),
    "stages_in_order": (stages_in_order, _CONFORMED_COUNT),
}


def entry(spark: SparkSession) -> DataFrame:
    """The flagship query on the smoke-test tables."""
    return flagship(spark, SMOKE_DIR)


def _of_llm() -> tuple[dict[str, Callable[[SparkSession, str], DataFrame]], dict[str, str]]:
    """Queries and SQL of the ``llm`` subpackage and of the corpus pipeline, where present."""
    try:
        import corpus_pipeline
        from smeltery.llm.queries import QUERIES, SQL
    except ImportError as error:
        if error.name not in ("corpus_pipeline", "smeltery.llm", "smeltery.llm.queries"):
            raise
        return {}, {}
    found, sql = {**QUERIES, "pipeline": corpus_pipeline.run}, dict(SQL)
    if corpus_pipeline.ORACLE_SQL is not None:
        sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found, sql


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: query for name, (query, _) in _CATALOGUE.items()} | _of_llm()[0]


def oracle_sql() -> dict[str, str]:
    own = {name: sql for name, (_, sql) in _CATALOGUE.items() if sql is not None}
    return own | _of_llm()[1]
