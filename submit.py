"""spark-submit entry point: one stage of the brewery pipeline, or all of them.

    spark-submit submit.py run --lake hdfs:///lake --meta-url 'https://host/meta' \\
        --page-url 'https://host/list?page={page}&per_page={per_page}'
    spark-submit submit.py show --lake hdfs:///lake
"""

from __future__ import annotations

import argparse
from datetime import UTC, datetime

from pyspark.sql import SparkSession

from smeltery.operators.aggregate import preview
from smeltery.plans.pipeline import Pipeline
from smeltery.presets import BREWERIES, BREWERIES_PER_STATE
from smeltery.session import configured
from smeltery.sources import paged, pages

STAGES = ("bronze", "silver", "audit", "gold", "run", "show")


def parse(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description="Run a stage of the brewery pipeline.")
    parser.add_argument("stage", choices=STAGES)
    parser.add_argument("--lake", required=True, help="folder that every executor can reach")
    parser.add_argument("--as-of", type=datetime.fromisoformat, default=None)
    parser.add_argument("--shuffle-bytes", type=int, help="most that one shuffle will move")
    parser.add_argument("--meta-url", help="URL of the record with the total")
    parser.add_argument("--page-url", help="URL of a page, with {page} and {per_page}")
    args = parser.parse_args(argv)
    if args.stage in ("bronze", "run") and not (args.meta_url and args.page_url):
        parser.error("--meta-url and --page-url are needed to land records")
    if args.stage in ("silver", "gold") and args.as_of is None:
        parser.error("--as-of is needed to go on with a run: the time that bronze was given")
    return args


def main(spark: SparkSession, args: argparse.Namespace) -> None:
    # The session's zone is UTC, and so is the day that names the folder.
    as_of = args.as_of or datetime.now(UTC).replace(microsecond=0, tzinfo=None)
    pipeline = Pipeline(args.lake, BREWERIES, BREWERIES_PER_STATE)
    if args.stage in ("bronze", "run"):
        urls = {"metaUrl": args.meta_url, "pageUrl": args.page_url}
        total = paged.UrlFetcher(args.meta_url, args.page_url, pages.PAGE_ROWS).total()
        records = paged.read_source(spark, paged.UrlPages, urls | {"total": total})
        stage = pipeline.run if args.stage == "run" else pipeline.ingest
        stage(records, as_of, landed=total, raw=True)
    elif args.stage == "silver":
        pipeline.conform(spark, as_of)
    elif args.stage == "audit":
        pipeline.audit(spark)
    elif args.stage == "gold":
        pipeline.count(pipeline.silver(spark), as_of)
    else:
        preview(pipeline.gold(spark), BREWERIES_PER_STATE.keys).show(30)


if __name__ == "__main__":
    arguments = parse()
    builder = SparkSession.builder.appName("smeltery")
    session = configured(builder, arguments.shuffle_bytes).getOrCreate()
    main(session, arguments)
    session.stop()
