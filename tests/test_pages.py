from __future__ import annotations

import json
from pathlib import Path

import pytest
from plans_of import plan_of
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from smeltery.operators import quality
from smeltery.plans import bronze
from smeltery.sources import pages
from smeltery.spec import TableSpec

SPEC = TableSpec(
    "t",
    {"id": "string", "longitude": "string", "state": "string"},
    key=("id",),
    required=("id",),
)


def put(folder: Path, *texts: str) -> str:
    folder.mkdir(parents=True)
    for i, text in enumerate(texts):
        (folder / f"page_{i}.json").write_text(text, encoding="utf-8")
    return str(folder)


def array(*records: dict) -> str:
    return json.dumps(list(records), indent=4)


def files(folder: str) -> list[Path]:
    return [p for p in Path(folder).rglob("part-*") if p.is_file()]


def lines(folder: str) -> list[str]:
    return [line for p in files(folder) for line in p.read_text(encoding="utf-8").splitlines()]


def report(spark, folder, layout, **options):
    rows = bronze.audit(spark, folder, SPEC, layout, **options).collect()
    return {r["check_name"]: (r["passed"], r["measure"]) for r in rows}


def test_arrays_of_several_pages(spark, tmp_path):
    a, b = {"id": "1", "state": "é"}, {"id": "2", "longitude": 2.5, "extra": {"x": 1}}
    folder = put(tmp_path / "p", array(a, b), "[]", array({"id": "3", "longitude": "2.50"}))
    rows = pages.read_pages(spark, folder, SPEC.schema, "array").collect()
    assert sorted(map(tuple, rows)) == [
        ("1", None, "é"),
        ("2", "2.5", None),
        ("3", "2.50", None),
    ]


def test_inference(spark, tmp_path):
    folder = put(tmp_path / "p", array({"z": 1, "a": "x", "n": None}), array({"a": 2.5, "m": True}))
    df = pages.read_pages(spark, folder, None, "array")
    assert df.dtypes == [("a", "string"), ("m", "boolean"), ("n", "string"), ("z", "bigint")]
    assert df.count() == 2


def test_only_empty_pages_fail_the_audit(spark, tmp_path):
    folder = put(tmp_path / "p", "[]", "[]")
    got = report(spark, folder, "array")
    assert got["not_empty"] == (False, 0)
    assert got["no_missing_columns"] == (False, 3)


def test_no_folder(spark, tmp_path):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        pages.read_pages(spark, str(tmp_path / "none"), SPEC.schema)


def test_unknown_layout(spark, tmp_path):
    with pytest.raises(ValueError, match="layout"):
        pages.read_pages(spark, str(tmp_path), SPEC.schema, "rows")


def test_truncated_page_is_counted_and_stopped(spark, tmp_path):
    whole = array({"id": "1", "longitude": "x", "state": "s"}, {"id": "2"})
    folder = put(tmp_path / "p", whole, whole[:-30])
    got = report(spark, folder, "array")
    assert got["no_lost_records"] == (False, 1)
    assert got["no_unreadable_values"] == (True, 0)
    with pytest.raises(quality.QualityError, match="no_lost_records"):
        quality.gate(bronze.audit(spark, folder, SPEC, "array"))


def test_unreadable_value_in_any_column(spark, tmp_path):
    typed = TableSpec("t", {"id": "string", "n": "integer", "state": "string"})
    unreadable, good = '{"id":"1","n":"many","state":"x"}', '{"id":"2","n":5,"state":"y"}'
    folder = put(tmp_path / "p", f"{unreadable}\n{good}\n")
    rows = bronze.audit(spark, folder, typed).collect()
    got = {r["check_name"]: r["measure"] for r in rows}
    assert got["no_unreadable_values"] == 1 and got["no_lost_records"] == 0


def test_reading_in_the_wrong_layout_is_noticed(spark, tmp_path):
    records = [{"id": str(i), "longitude": "0", "state": "s"} for i in range(5)]
    folder = put(tmp_path / "lines", "\n".join(map(json.dumps, records)))
    got = report(spark, folder, "array", landed=5)
    assert got["all_rows_landed"] == (False, 1)
    arrays = put(tmp_path / "arrays", array({"id": "1", "longitude": "0", "state": "s"}))
    assert not report(spark, arrays, "lines")["no_lost_records"][0]


def test_absent_and_extra_columns(spark, tmp_path):
    folder = put(tmp_path / "p", array({"id": "1", "state": "s", "extra": 1}))
    assert report(spark, folder, "array")["no_missing_columns"] == (False, 1)
    folder = put(tmp_path / "q", array({"id": "1", "state": "s", "extra": 1, "longitude": None}))
    assert all(passed for passed, _ in report(spark, folder, "array").values())


@pytest.mark.parametrize("layout", ["lines", "array"])
def test_the_audit_is_one_scan(spark, tmp_path, layout):
    text = '{"id":"1","state":"s"}'
    folder = put(tmp_path / "p", text if layout == "lines" else f"[{text}]")
    plan = plan_of(bronze.audit(spark, folder, SPEC, layout))
    assert plan.count("Scan") == 1
    assert plan.count("Exchange") == 1


def test_names_and_corruption_are_told_in_one_scan_as_in_two(spark, tmp_path):
    rows = ['{"id":"1","longitude":"0","state":"s"}', "", "  ", '{"id":', '{"ID":"2"}', "null", "7", '["x"]']
    rows += ['{"id":"3","extra":{"a":1}} ', '{"longitude":2.5,"longitude":3}', '{"n":"\\u00e9"}']
    folder = put(tmp_path / "p", "\n".join(rows))
    two = pages.read_pages(spark, folder, SPEC.schema, corrupt=True)
    one = pages.read_with_names(spark, folder, SPEC.schema)
    key = lambda r: str(r)
    assert sorted(one.drop(pages.NAMES).collect(), key=key) == sorted(two.collect(), key=key)
    names = {n for r in one.collect() for n in r[pages.NAMES] or ()}
    assert names == {"id", "longitude", "state", "ID", "extra", "n"}


def test_landing_by_day(spark, tmp_path, as_of):
    df = spark.range(0, 1500, 1, 3).selectExpr(
        "cast(id as string) as id", "cast(null as string) as longitude", "'é' as state"
    )
    folder = pages.land_rows(df, str(tmp_path), as_of, records_per_file=200)
    assert folder == f"{tmp_path}/2024/01/05"
    assert max(len(p.read_text().splitlines()) for p in files(folder)) == 200
    assert sorted(pages.read_pages(spark, folder, SPEC.schema).collect()) == sorted(df.collect())
    # A column without any value is still visible.
    assert pages.inferred_columns(spark, folder) == ["id", "longitude", "state"]
    # A smaller second landing of the day leaves nothing of the first.
    pages.land_rows(df.limit(3), str(tmp_path), as_of)
    assert pages.read_pages(spark, folder, SPEC.schema).count() == 3


def test_raw_records_are_landed_unchanged(spark, tmp_path, as_of):
    texts = ['{"id":"1","longitude":2.50,"extra":[1,{"y":"é"}]}', '{"state":null,"id":"2"}']
    df = spark.createDataFrame([(t,) for t in texts], "record string")
    folder = pages.land_records(df, str(tmp_path), as_of)
    assert sorted(lines(folder)) == sorted(texts)
    pretty = json.dumps(json.loads(texts[0]), indent=4).replace("\n", "\r\n")
    folder = pages.land_records(
        spark.createDataFrame([(pretty,)], "record string"), str(tmp_path / "pretty"), as_of
    )
    (line,) = lines(folder)
    assert json.loads(line) == json.loads(texts[0])
    folder = pages.land_records(df, str(tmp_path), as_of)
    rows = pages.read_pages(spark, folder, SPEC.schema).collect()
    assert sorted(map(tuple, rows)) == [("1", "2.50", None), ("2", None, None)]


def test_ingest_audits_what_it_landed(spark, tmp_path, as_of):
    df = spark.createDataFrame([("1", None, "s")], SPEC.schema)
    folder = bronze.ingest(df, str(tmp_path / "a"), SPEC, as_of)
    assert pages.read_pages(spark, folder, SPEC.schema).count() == 1
    with pytest.raises(quality.QualityError, match="no_missing_columns"):
        bronze.ingest(df.drop("state"), str(tmp_path / "b"), SPEC, as_of)
    with pytest.raises(quality.QualityError, match="not_empty"):
        bronze.ingest(df.limit(0), str(tmp_path / "c"), SPEC, as_of)
    with pytest.raises(quality.QualityError, match="not_empty.*no_missing_columns"):
        nothing = spark.createDataFrame([], "record string")
        bronze.ingest(nothing, str(tmp_path / "e"), SPEC, as_of, raw=True)
    records = spark.createDataFrame([('{"id":"1"}',)], "record string")
    with pytest.raises(quality.QualityError, match=r"no_missing_columns \(2\)"):
        bronze.ingest(records, str(tmp_path / "d"), SPEC, as_of, raw=True)


def test_pages_are_full_whatever_they_hold(spark, tmp_path):
    # A third of the records are alike and tasks differ in size, some are empty.
    df = spark.range(0, 1001, 1, 7).filter("id < 300 or id > 600").select(
        F.when(F.col("id") % 3 == 0, '{"id":"hot"}')
        .otherwise(F.to_json(F.struct("id")))
        .alias("record")
    )
    folder = pages.write_pages(df, str(tmp_path / "r"), 64)
    sizes = {
        int(p.parent.name.removeprefix("page=")): len(json.loads(p.read_text()))
        for p in files(folder)
    }
    assert sizes == {n: 64 for n in range(1, 11)} | {11: 700 - 640}
    # Records keep their order, within a page and from page to page.
    in_order = sorted(files(folder), key=lambda p: int(p.parent.name.removeprefix("page=")))
    texts = [r for p in in_order for r in json.loads(p.read_text())]
    assert texts == [json.loads(r.record) for r in df.collect()]
    back = pages.read_pages(spark, folder, SPEC.schema, "array")
    assert back.count() == 700
    assert sorted(r.id for r in back.collect()) == sorted(
        str(json.loads(r.record)["id"]) for r in df.collect()
    )


def test_no_records_make_no_pages(spark, tmp_path):
    df = spark.createDataFrame([], "record string")
    folder = pages.write_pages(df, str(tmp_path / "r"))
    assert not files(folder)
    (meta,) = files(str(tmp_path / "r" / "meta"))
    assert json.loads(meta.read_text()) == {"total": 0}


def test_values_of_all_types_survive_a_landing(spark, tmp_path, as_of):
    df = spark.sql(
        """select timestamp '2024-01-05 01:02:03.123456' as t,
                  timestamp_ntz '2024-01-05 01:02:03.123456' as n,
                  timestamp_ntz '1900-12-31 23:59:59.000001' as o,
                  date '2024-02-29' as d, 12345678901234567890.1234567890BD as m,
                  double('NaN') as f, 0.1 + 0.2D as g, X'00FF0A' as b, true as q,
                  'a\\n"é' as s, 9223372036854775807L as l, null as z"""
    ).withColumn("z", F.lit(None).cast("string"))
    folder = pages.land_rows(df, str(tmp_path / "rows"), as_of)
    assert repr(pages.read_pages(spark, folder, df.schema).collect()) == repr(df.collect())
    records = df.select(F.to_json(F.struct("*"), pages.JSON_WRITING).alias("record"))
    folder = pages.land_records(records, str(tmp_path / "records"), as_of)
    assert repr(pages.read_pages(spark, folder, df.schema).collect()) == repr(df.collect())
    folder = pages.write_pages(records, str(tmp_path / "pages"))
    got = pages.read_pages(spark, folder, df.schema, layout="array")
    assert repr(got.collect()) == repr(df.collect())
