from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import pytest

from smeltery.session import partitions_for, shared_folder

REPO = Path(__file__).resolve().parents[1]


def test_shared_folder_is_the_clusters_and_new_each_time(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    first, second = shared_folder(spark), shared_folder(spark)
    assert first.startswith(f"{base}/") and first != second


class Session:
    """What ``shared_folder`` looks at, without the setting."""

    def __init__(self, master):
        self.sparkContext = type("Context", (), {"master": master})()
        self.conf = type("Conf", (), {"get": staticmethod(lambda key, default: default)})()


def test_a_cluster_must_name_its_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Session("spark://master:7077"))
    assert "smeltery-" in shared_folder(Session("local[2]"))


def test_shuffles_start_with_enough_partitions():
    assert partitions_for(0) == 200
    assert partitions_for(30 << 40) == 122_880


def test_specs_and_queries_import_without_a_session():
    code = "import __spark_entry__ as e, submit; print(len(e.queries()))"
    done = subprocess.run(
        [sys.executable, "-c", code], cwd=REPO, capture_output=True, text=True, check=True
    )
    assert int(done.stdout) > 30


def test_workers_need_no_installed_package(tmp_path):
    """The text function reaches workers that cannot import this package."""
    code = f"""
import sys
sys.path.insert(0, {str(REPO)!r})
from pyspark.sql import SparkSession
from smeltery.functions.text import clean_text
spark = (SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false")
         .getOrCreate())
df = spark.createDataFrame([("é",)], "t string")
print("got", df.select(clean_text("t")).first()[0])
"""
    done = subprocess.run(
        [sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, check=True
    )
    assert "got e" in done.stdout


def test_a_failed_task_is_repeated_without_loss_or_doubling(tmp_path):
    """Page 2 cannot be had at first; the task that wanted it runs again."""
    code = f"""
import json, sys
from datetime import datetime
from pathlib import Path
sys.path.insert(0, {str(REPO)!r})
from pyspark.sql import SparkSession
from smeltery.sources import paged, pages

class Flaky(paged.PageFetcher):
    def total(self):
        return 40
    def page(self, number):
        mark = Path({str(tmp_path)!r}) / "failed-once"
        if number == 2 and not mark.exists():
            mark.touch()
            raise OSError("gone")
        return json.dumps([{{"id": str(10 * number + i)}} for i in range(10)])

class FlakyPages(paged.PagedSource):
    @classmethod
    def name(cls):
        return "flaky_pages"
    def fetcher(self):
        return Flaky()

spark = (SparkSession.builder.master("local[2,3]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "4").getOrCreate())
df = paged.read_source(spark, FlakyPages, {{"perPage": 10, "maxTasks": 2}})
folder = pages.land_records(df, {str(tmp_path / "lake")!r}, datetime(2024, 1, 5))
ids = sorted(int(r.id) for r in pages.read_pages(spark, folder, None).collect())
print("whole", ids == list(range(10, 50)), (Path({str(tmp_path)!r}) / "failed-once").exists())
"""
    done = subprocess.run(
        [sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, check=True
    )
    assert "whole True True" in done.stdout
