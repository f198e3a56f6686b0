import gzip
import hashlib
import io
import random
from pathlib import Path

import pytest

from smeltery.llm import warc

LONG = "<p>" + "x" * 200


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


ROWS = [
    (5, "http://a/ü b\r\nX: y", LONG),
    (3, "http://b", LONG),
    (None, "http://c", LONG),
    (3, "http://b", LONG),
    (1, None, None),
    (2, "u", ""),
    (7, "u", "short"),
    (8, "u", "short"),
    (9, "u", "é" * 50),
    (10, "u", "é" * 50),
    (None, "u", "n" * 150),
    (11, "u", "\x00\r\n\r\nWARC/1.1" * 30_000),
]


def test_round_trip_in_any_split(spark):
    source = pages(spark, ROWS)
    manifest = warc.write(source.repartition(3))
    for split in (97, 1000, 1 << 20):
        rows = warc.read(manifest, split).collect()
        assert len(rows) == len(ROWS)
        got = sorted(
            ((r.page_id and int(r.page_id)), r.n_bytes, r.digest, r.record_type, r.refers_to)
            for r in rows
            if r.page_id
        )
        want = []
        for page, _, html in ROWS:
            raw = (html or "").encode()
            first = {LONG: 3, "é" * 50: 9}.get(html)
            again = first is not None and first != page
            if page is not None:
                want.append(
                    (page, len(raw), hashlib.sha256(raw).hexdigest(),
                     "revisit" if again else "response", str(first) if again else None)
                )
        assert got == sorted(want, key=lambda x: (x[0], x[1]))
        for r in rows:
            if r.record_type == "response":
                assert hashlib.sha256(bytes(r.payload)).hexdigest() == r.digest
        nulls = sorted((r.n_bytes, r.record_type, r.refers_to) for r in rows if not r.page_id)
        assert nulls == [(150, "response", None), (203, "revisit", "3")]


def test_archives_are_plain_gzip_of_warc_records(spark, tmp_path):
    for row in warc.write(pages(spark, ROWS), f"file://{tmp_path}/w").collect():
        whole = gzip.decompress(Path(row.path.removeprefix("file://")).read_bytes())
        assert whole.startswith(b"WARC/1.1\r\n") and b"\r\nX: y" not in whole


def test_magic_inside_a_record_begins_none():
    inner = gzip.compress(b"no archive") + warc.MAGIC * 5
    raw = b"".join(
        warc.record(k, "u", inner * 20 if k % 2 else b"", "0" * 64) for k in range(9)
    )
    store = io.BytesIO(raw)
    for step in (1, 13, 200, 10_000):
        found = []
        for low in range(0, len(raw), step):
            found += warc.members(store, len(raw), low, min(low + step, len(raw)))
        assert [warc.parsed(c)[0]["x-page-id"] for _, c in found] == [str(k) for k in range(9)]


def test_an_archive_inside_a_payload_is_not_read():
    rng = random.Random(4)
    inner = warc.record(99, "u", rng.randbytes(900), "0" * 64)
    payloads = [b"a" * 50, rng.randbytes(60_000) + inner + rng.randbytes(60_000), rng.randbytes(300), inner, b""]
    raw = b"".join(warc.record(k, "u", p, "0" * 64) for k, p in enumerate(payloads))
    assert inner[:200] in raw  # what cannot be packed is stored as it is
    store = io.BytesIO(raw)
    for step in (61, 500, 3001, 100_000):
        found = []
        for low in range(0, len(raw), step):
            found += warc.members(store, len(raw), low, min(low + step, len(raw)))
        assert [warc.parsed(c)[0]["x-page-id"] for _, c in found] == [str(k) for k in range(5)]


def test_damage_behind_the_start_of_a_range_is_told():
    whole = [warc.record(k, "u", random.Random(k).randbytes(2000), "0" * 64) for k in range(4)]
    bad = whole[2][:1500] + b"\x00" * 400 + whole[2][1900:]
    raw = b"".join([whole[0], whole[1], bad, whole[3]])
    low = len(whole[0]) - 10
    with pytest.raises(ValueError, match="damaged"):
        list(warc.members(io.BytesIO(raw), len(raw), low, len(raw)))


def test_damage_is_told(spark):
    raw = warc.record(1, "u", b"abc" * 50_000, "0" * 64)
    with pytest.raises(ValueError, match="damaged"):
        list(warc.members(io.BytesIO(raw[:-9]), len(raw) - 9, 0, len(raw) - 9))


def test_no_pages(spark):
    assert warc.read(warc.write(pages(spark, []))).count() == 0
