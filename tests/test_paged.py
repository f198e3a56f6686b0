from __future__ import annotations

import json
from datetime import datetime

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from smeltery.sources import paged, pages
from smeltery.spec import schema_of


def put_pages(folder, sizes, total=None):
    """Numbered records in files that URLs can name."""
    folder.mkdir()
    (folder / "meta.json").write_text(json.dumps({"total": total or sum(sizes)}))
    n = 0
    for page, size in enumerate(sizes, 1):
        records = [{"id": str(n + i), "name": "é", "x": 1.5} for i in range(size)]
        (folder / f"{page}.json").write_text(json.dumps(records))
        n += size
    site = folder.as_uri()
    return {"metaUrl": f"{site}/meta.json", "pageUrl": f"{site}/{{page}}.json"}


def ids(df):
    return sorted(int(r[0]) for r in df.select(F.get_json_object("record", "$.id")).collect())


def test_url_pages(spark, tmp_path):
    options = put_pages(tmp_path / "p", [10, 10, 10, 4])
    df = paged.read_source(spark, paged.UrlPages, {**options, "perPage": 10})
    assert ids(df) == list(range(34))
    assert df.rdd.getNumPartitions() == 4
    record = json.loads(df.filter("page = 4").first().record)
    assert record["name"] == "é" and record["x"] == 1.5


def test_many_pages_share_few_tasks(spark, tmp_path):
    options = put_pages(tmp_path / "p", [3] * 25 + [1])
    df = paged.read_source(spark, paged.UrlPages, {**options, "perPage": 3, "maxTasks": 4})
    assert df.rdd.getNumPartitions() == 4
    assert ids(df) == list(range(76))
    assert {r.page for r in df.collect()} == set(range(1, 27))


def test_page_ranges_cover_every_page_once():
    class Fixed(paged.PageFetcher):
        def __init__(self, n):
            self.n = n

        def total(self):
            return self.n

        def page(self, number):
            return "[]"

    for total in (0, 1, 199, 200, 201, 123_457):
        for tasks in (1, 3, 10_000):
            ranges = paged.PagedReader(Fixed(total), 200, tasks).partitions()
            covered = [p for r in ranges for p in range(r.first, r.last + 1)]
            assert covered == list(range(1, -(-total // 200) + 1))
            assert len(ranges) <= max(tasks, 1)


def test_typed_records(spark, tmp_path):
    options = put_pages(tmp_path / "p", [3, 3, 1])
    schema = schema_of({"x": "double", "id": "string", "absent": "string"})
    df = paged.read_source(spark, paged.UrlPages, {**options, "perPage": 3}, schema)
    assert df.columns == ["x", "id", "absent"]
    assert sorted(map(tuple, df.collect()), key=str) == [(1.5, str(n), None) for n in range(7)]
    short = put_pages(tmp_path / "q", [3, 2], total=6)
    df = paged.read_source(spark, paged.UrlPages, {**short, "perPage": 3}, schema)
    with pytest.raises(Exception, match="page 2 has 2 records, expected 3"):
        df.collect()


@pytest.mark.parametrize("sizes", [[10, 9, 10], [10, 10, 0], [10, 10]])
def test_fewer_records_than_announced_fail(spark, tmp_path, sizes):
    options = put_pages(tmp_path / "p", sizes, total=30)
    df = paged.read_source(spark, paged.UrlPages, {**options, "perPage": 10})
    with pytest.raises(Exception, match="records, expected 10|No such file"):
        df.count()


@pytest.mark.parametrize("body", ["", "[{", '{"message":"busy"}', "null"])
def test_a_page_that_is_no_array_fails(spark, tmp_path, body):
    options = put_pages(tmp_path / "p", [2, 2])
    (tmp_path / "p" / "2.json").write_text(body)
    df = paged.read_source(spark, paged.UrlPages, {**options, "perPage": 2})
    with pytest.raises(Exception, match="page 2 has|MALFORMED"):
        df.collect()


def test_records_of_pretty_printed_pages(spark, tmp_path):
    options = put_pages(tmp_path / "p", [2])
    one = '{"id": 1,\r\n   "x": 2.50, "t": "a\\nb"}'
    two = '{"id":2, "u":"\\u00e9", "v":[1,{"w":null}]}'
    (tmp_path / "p" / "1.json").write_bytes(f"[\n  {one},\n {two}]".encode())
    df = paged.read_source(spark, paged.UrlPages, {**options, "perPage": 2})
    first, second = sorted(r.record for r in df.collect())
    assert json.loads(first) == {"id": 1, "x": 2.5, "t": "a\nb"}
    assert json.loads(second) == {"id": 2, "u": "é", "v": [1, {"w": None}]}


def test_nothing_to_read(spark, tmp_path):
    options = put_pages(tmp_path / "p", [])
    assert paged.read_source(spark, paged.UrlPages, options).count() == 0


def test_folder_pages(spark, tmp_path):
    root = str(tmp_path / "shared folder é")
    rows = spark.range(0, 1050, 1, 5)
    pages.write_pages(rows.select(F.to_json(F.struct("id")).alias("record")), root)
    df = paged.read_source(spark, paged.FolderPages, {"root": root})
    assert ids(df) == list(range(1050))
    assert df.rdd.getNumPartitions() == 6
    for named in (root, f"file:{root}", f"file://{root}"):
        assert ids(paged.read_folder(spark, named)) == list(range(1050))
        assert paged.folder_total(spark, named) == 1050


def test_pages_land_and_read_back(spark, tmp_path, as_of):
    options = put_pages(tmp_path / "p", [5, 5, 2])
    df = paged.read_source(spark, paged.UrlPages, {**options, "perPage": 5})
    folder = pages.land_records(df, str(tmp_path / "lake"), as_of)
    assert pages.read_pages(spark, folder, None).dtypes == [
        ("id", "string"),
        ("name", "string"),
        ("x", "double"),
    ]


def test_records_come_character_by_character(spark, tmp_path):
    options = put_pages(tmp_path / "p", [3])
    records = [
        '{"a":0.1234567890123456789,"b":1.10,"c":1e400,"c":-0.0}',
        '{ "t":"\\u00e9 \\/ [,]{}\\"" , "t":null}',
        "[1,  2]",
    ]
    body = "[ " + " ,\n".join(records) + "\t]"
    (tmp_path / "p" / "1.json").write_text(body)
    df = paged.read_source(spark, paged.UrlPages, {**options, "perPage": 3})
    assert [r.record for r in df.collect()] == records
    folder = pages.land_records(df, str(tmp_path / "lake"), datetime(2024, 1, 5))
    assert sorted(r.value for r in spark.read.text(folder).collect()) == sorted(records)


@pytest.mark.parametrize("bad", ['{"v":"abc","k":1}', '{"v":1.5,"k":"zz"}', "7", '{"k":1e400}'])
def test_a_record_that_its_schema_cannot_read_ends_the_job(spark, tmp_path, bad):
    options = put_pages(tmp_path / "p", [2, 2])
    good = '{"v":1.5,"k":1,"more":[]}'
    (tmp_path / "p" / "1.json").write_text(f"[{good},{good}]")
    (tmp_path / "p" / "2.json").write_text(f"[{good},{good}]")
    schema = T.StructType().add("v", "double").add("k", "long")
    df = paged.read_source(spark, paged.UrlPages, {**options, "perPage": 2}, schema)
    assert [tuple(r) for r in df.collect()] == [(1.5, 1)] * 4
    (tmp_path / "p" / "2.json").write_text(f"[{good},{bad}]")
    with pytest.raises(Exception, match="page 2 has a record that cannot be read"):
        df.collect()


def test_a_total_that_is_known_is_not_asked_for_again(spark, tmp_path):
    options = put_pages(tmp_path / "p", [2, 2])
    known = {**options, "perPage": 2, "total": 2, "metaUrl": "file:///nowhere"}
    assert paged.read_source(spark, paged.UrlPages, known).count() == 2


def test_few_pages_are_in_memory_at_once(spark, tmp_path, monkeypatch):
    options = put_pages(tmp_path / "p", [1] * 24)
    for k in range(1, 25):
        (tmp_path / "p" / f"{k}.json").write_text(json.dumps([{"t": "x" * (1 << 20)}]))

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"page": [batch.num_rows], "record": [str(batch.nbytes)]})

    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    monkeypatch.setattr(paged, "_cut", sizes)
    found = paged.read_source(spark, paged.UrlPages, {**options, "perPage": 1, "maxTasks": 1}).collect()
    assert sum(r.page for r in found) == 24
    assert max(int(r.record) for r in found) <= 6 << 20
