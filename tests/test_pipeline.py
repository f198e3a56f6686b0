from __future__ import annotations

import json
from dataclasses import replace
from datetime import datetime
from uuid import uuid4

import pytest

import submit
from smeltery.operators import quality
from smeltery.plans.pipeline import Pipeline
from smeltery.presets import BREWERIES, BREWERIES_PER_STATE
from smeltery.sources import pages


def pipeline_of(lake):
    tag = uuid4().hex
    return Pipeline(
        str(lake),
        replace(BREWERIES, name=f"{BREWERIES.name}_{tag}"),
        replace(BREWERIES_PER_STATE, name=f"{BREWERIES_PER_STATE.name}_{tag}"),
    )


def brewery(n, **fields):
    record = {c: None for c in BREWERIES.columns}
    record |= {"id": str(n), "brewery_type": "micro", "state": "Kärnten"}
    return record | {"longitude": 13.5, "extra": 1} | fields


BREWERY_LIST = [
    brewery(1),
    brewery(2, state="KARNTEN"),
    brewery(3, state="São Paulo", brewery_type="bar"),
    brewery(4, state=""),
    brewery(5, brewery_type=None),
    brewery(6, state=" "),
]
WANT = {(" ", "micro"): 1, ("KARNTEN", "micro"): 2, ("SAO PAULO", "bar"): 1}


def records(spark, rows):
    texts = [(json.dumps(r, ensure_ascii=False),) for r in rows]
    return spark.createDataFrame(texts, "record string")


def counts(df):
    return {(r.state, r.brewery_type): r.brewery_quantity for r in df.collect()}


def test_run(spark, tmp_path, as_of):
    pipeline = pipeline_of(tmp_path)
    gold = pipeline.run(records(spark, BREWERY_LIST), as_of, landed=6, raw=True)
    assert gold.dtypes == [
        ("state", "string"),
        ("brewery_type", "string"),
        ("brewery_quantity", "int"),
        ("dt_ingestion", "timestamp"),
    ]
    assert counts(gold) == WANT
    assert {r.dt_ingestion for r in gold.collect()} == {as_of}
    silver = pipeline.silver(spark)
    assert silver.columns == [*BREWERIES.columns, "dt_ingestion"]
    assert silver.count() == sum(WANT.values())
    assert {r.longitude for r in silver.collect()} == {"13.5"}
    # The same run again gives the same table.
    again = pipeline.run(records(spark, BREWERY_LIST), as_of, raw=True)
    assert sorted(again.collect()) == sorted(gold.collect())


def test_a_failed_stage_stops_the_rest(spark, tmp_path, as_of):
    pipeline = pipeline_of(tmp_path)
    pipeline.run(records(spark, BREWERY_LIST), as_of, raw=True)
    later = datetime(2024, 1, 6)
    cut = records(spark, BREWERY_LIST).selectExpr(
        "if(record like '%Paulo%', left(record, 40), record) as record"
    )
    with pytest.raises(quality.QualityError, match=r"no_(lost_records|unreadable_values) \(1\)"):
        pipeline.run(cut, later, raw=True)
    with pytest.raises(quality.QualityError, match=r"unique_rows \(1\)"):
        pipeline.run(records(spark, [*BREWERY_LIST, brewery(1)]), later, raw=True)
    with pytest.raises(quality.QualityError, match="all_rows_landed"):
        pipeline.run(records(spark, BREWERY_LIST), later, landed=7, raw=True)
    assert counts(pipeline.gold(spark)) == WANT
    assert {r.dt_ingestion for r in pipeline.silver(spark).collect()} == {as_of}


def test_array_pages_conform_as_well(spark, tmp_path, as_of):
    pipeline = pipeline_of(tmp_path)
    day = tmp_path / "elsewhere"
    day.mkdir()
    (day / "page_1.json").write_text(json.dumps(BREWERY_LIST[:3], indent=4))
    (day / "page_2.json").write_text(json.dumps(BREWERY_LIST[3:], indent=4))
    silver = pipeline.conform(spark, as_of, layout="array", folder=str(day))
    assert counts(pipeline.count(silver, as_of)) == WANT


def test_submitted_stages(spark, tmp_path, capsys):
    site = tmp_path / "site"
    site.mkdir()
    total = 450
    (site / "meta.json").write_text(json.dumps({"total": str(total)}))
    for page in (1, 2, 3):
        rows = [brewery(n) for n in range((page - 1) * 200, min(page * 200, total))]
        (site / f"{page}.json").write_text(json.dumps(rows))
    uri = site.as_uri()
    urls = ["--meta-url", f"{uri}/meta.json", "--page-url", f"{uri}/{{page}}.json"]
    where = ["--lake", str(tmp_path / "lake"), "--as-of", "2024-01-05"]
    submit.main(spark, submit.parse(["bronze", *where, *urls]))
    folder = Pipeline(str(tmp_path / "lake"), BREWERIES, BREWERIES_PER_STATE).landed(
        spark, datetime(2024, 1, 5)
    )
    assert "/2024/01/05/run=" in folder
    assert pages.read_pages(spark, folder, BREWERIES.schema).count() == total
    for stage in ("silver", "audit", "gold", "show"):
        submit.main(spark, submit.parse([stage, *where]))
    assert f"|KARNTEN|       micro|{total:>16}|" in capsys.readouterr().out
    # All of them at once, on a later day.
    where[-1] = "2024-01-06"
    submit.main(spark, submit.parse(["run", *where, *urls]))
    submit.main(spark, submit.parse(["show", *where]))
    assert "2024-01-06 00:00:00" in capsys.readouterr().out
    with pytest.raises(SystemExit):
        submit.parse(["run", *where])


def test_gold_sums_to_silver(spark, tmp_path, as_of):
    pipeline = pipeline_of(tmp_path)
    rows = [brewery(n, state=f"s{n % 5}é", brewery_type=f"t{n % 3}") for n in range(100)]
    gold = pipeline.run(records(spark, rows), as_of, raw=True)
    assert sum(counts(gold).values()) == pipeline.silver(spark).count() == 100


def test_a_refused_landing_leaves_the_day_as_it_was(spark, tmp_path, as_of):
    pipeline = pipeline_of(tmp_path)
    good = [brewery(n) for n in range(100)]
    pipeline.ingest(records(spark, good), as_of, raw=True)
    cut = records(spark, good).selectExpr("left(record, 40) as record")
    with pytest.raises(quality.QualityError, match=r"no_lost_records|no_unreadable_values"):
        pipeline.ingest(cut, as_of, raw=True)
    assert pipeline.conform(spark, as_of).count() == 100


def test_a_cut_page_stops_the_silver_stage(spark, tmp_path, as_of):
    pipeline = pipeline_of(tmp_path)
    day = tmp_path / "elsewhere"
    day.mkdir()
    (day / "page_1.json").write_text(json.dumps([brewery(n) for n in range(200)]))
    (day / "page_2.json").write_text(json.dumps([brewery(n) for n in range(200, 400)])[:-70])
    with pytest.raises(quality.QualityError, match="no_(lost_records|unreadable_values)"):
        pipeline.conform(spark, as_of, layout="array", folder=str(day))
    with pytest.raises(FileNotFoundError):
        pipeline.silver(spark)


def test_rows_that_look_like_records_are_landed_as_rows(spark, tmp_path, as_of):
    from smeltery.spec import TableSpec

    spec = TableSpec(f"t_{uuid4().hex}", {"page": "long", "record": "string"}, stamp=None)
    pipeline = Pipeline(str(tmp_path), spec, BREWERIES_PER_STATE)
    rows = spark.createDataFrame([(1, "text")], "page long, record string")
    folder = pipeline.ingest(rows, as_of)
    assert pages.read_pages(spark, folder, spec.schema).collect() == rows.collect()
