from __future__ import annotations

import re
import unicodedata

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from smeltery.functions.text import _clean_batch, _register, clean_text, clean_together, upper_clean

CASES = [
    (None, None),
    ("", ""),
    ("plain ASCII 09", "plain ASCII 09"),
    ("a-b.c\td\n", "a_b_c_d_"),
    ("Kärnten", "Karnten"),
    ("São Paulo", "Sao Paulo"),
    ("Łódź", "_odz"),
    ("Øst", "_st"),
    ("ß", "_"),
    ("İ", "I"),
    ("ı", "_"),
    ("’", "_"),
    ("ﬁ", "fi"),
    ("½", "1_2"),
    ("™", "TM"),
    ("²", "2"),
    ("…", "___"),
    ("가", "__"),
    ("각", "___"),
    ("́", ""),
    ("🍺", "_"),
    (" ", " "),
]


def test_cases(spark):
    rows = [(i, text) for i, (text, _) in enumerate(CASES)]
    df = spark.createDataFrame(rows, "i int, t string")
    got = {r.i: r.c for r in df.select("i", clean_text("t").alias("c")).collect()}
    assert [got[i] for i in range(len(CASES))] == [clean for _, clean in CASES]


def test_upper(spark):
    df = spark.createDataFrame([("straße",), (None,)], "t string")
    got = [r[0] for r in df.select(upper_clean("t")).collect()]
    assert got == ["STRA_E", None]


def test_bytes_that_are_no_text(spark):
    df = spark.sql("select cast(unhex('41C342E282') as string) as t, 'é' as u")
    assert df.select(clean_text("t")).first()[0] == "A_B_"
    assert tuple(df.select(clean_together(["t", "u"])).first()[0]) == ("A_B_", "e")


def test_several_columns_in_one_trip(spark):
    rows = [("é", "ü", 1), (None, "½", 2), ("x", None, 3)]
    df = spark.createDataFrame(rows, "a string, `b c` string, i int")
    out = df.select("i", clean_together(["a", "b c"]).alias("s")).select("i", "s.*")
    assert sorted(map(tuple, out.collect())) == [(1, "e", "u"), (2, None, "1_2"), (3, "x", None)]
    assert out.columns == ["i", "a", "b c"]


def test_repeated_values_over_many_batches(spark):
    df = spark.range(50_000).select(
        F.when(F.col("id") % 3 != 0, F.concat(F.lit("é"), F.col("id") % 7)).alias("t")
    )
    counted = df.select(clean_text("t").alias("c")).groupBy("c").count()
    got = {r.c: r["count"] for r in counted.collect()}
    want = {}
    for i in range(50_000):
        key = None if i % 3 == 0 else f"e{i % 7}"
        want[key] = want.get(key, 0) + 1
    assert got == want


@pytest.mark.skipif(unicodedata.unidata_version != "15.1.0", reason="counted for Unicode 15.1")
def test_every_code_point(spark):
    """How many characters beyond ASCII vanish, become one other or several."""
    points = [(chr(c),) for c in range(0x80, 0x110000) if not 0xD800 <= c <= 0xDFFF]
    df = spark.createDataFrame(points, "t string").select(clean_text("t").alias("c"))
    got = df.agg(
        F.count_if(F.col("c") == "").alias("gone"),
        F.count_if((F.length("c") == 1) & (F.col("c") != "_")).alias("one"),
        F.count_if(F.length("c") > 1).alias("several"),
        F.count_if(~F.col("c").rlike("^[a-zA-Z0-9 _]*$")).alias("other"),
    ).first()
    assert (got.gone, got.one, got.several, got.other) == (927, 1553, 12325, 0)


def clean(text: str) -> str:
    _register()
    return _clean_batch(pa.array([None, text])).to_pylist()[1]


TEXT = st.text(st.characters(exclude_categories=["Cs"]))


@settings(max_examples=500, deadline=None)
@given(TEXT)
def test_only_kept_characters_and_stable(text):
    once = clean(text)
    assert re.fullmatch("[a-zA-Z0-9 _]*", once)
    assert clean(once) == once


@settings(max_examples=500, deadline=None)
@given(TEXT)
def test_normal_form_of_the_input_does_not_matter(text):
    # Whole-string decomposition also reorders marks; the result is the same.
    for form in ("NFC", "NFD", "NFKD"):
        assert clean(unicodedata.normalize(form, text)) == clean(text)


@settings(deadline=None)
@given(TEXT, TEXT)
def test_concatenation(left, right):
    assert clean(left + right) == clean(left) + clean(right)


@settings(deadline=None)
@given(st.lists(st.one_of(st.none(), TEXT)), st.integers(0, 3))
def test_batches(texts, skipped):
    _register()
    batch = pa.array(texts, pa.string())[skipped:]
    cleaned = _clean_batch(batch)
    cleaned.validate(full=True)
    assert cleaned.to_pylist() == [None if t is None else clean(t) for t in texts[skipped:]]


def test_wide_offsets_are_kept():
    _register()
    batch = pa.array(["é-é", None, "x"], pa.large_string())
    assert _clean_batch(batch).equals(pa.array(["e_e", None, "x"], pa.large_string()))
