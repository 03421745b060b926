import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from daymark.functions import (
    cell_text,
    difference,
    parse_decimal_comma,
    parse_grouped_long,
    partition_date,
    strip,
)


def values(spark, texts, function, type_="string"):
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, f"i int, x {type_}")
    return [r.y for r in df.select("i", function("x").alias("y")).orderBy("i").collect()]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_parse_grouped_long(spark, ansi):
    texts = ["1.234.567", "9", "", "-", "n/d", " 12 ", None, "-1.000", "99.999.999.999.999.999.999"]
    expected = [1234567, 9, None, None, None, 12, None, -1000, None]
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        assert values(spark, texts, parse_grouped_long) == expected
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_parse_decimal_comma(spark, ansi):
    texts = ["1,25", "0,5", "1.234,56", "", None, "7"]
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        assert values(spark, texts, parse_decimal_comma) == [1.25, 0.5, None, None, None, 7.0]
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


@settings(max_examples=5, deadline=None)
@given(st.lists(st.integers(-(2**63), 2**63 - 1), min_size=1, max_size=50))
def test_grouped_numbers_come_back(spark, numbers):
    texts = [f"{n:,}".replace(",", ".") for n in numbers]
    assert values(spark, texts, parse_grouped_long) == numbers


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(st.sampled_from(" \t\n\x0b\x1c\x85\xa0   \u3000ab<"), max_size=8), min_size=1))
def test_strip_is_python_strip(spark, texts):
    assert values(spark, texts, strip) == [t.strip() for t in texts]


def test_partition_date(spark):
    paths = [
        "dt_ptcm=20250915",
        "dt_ptcm=2025091",
        "dt_ptcm=2025091x",
        "tmp",
        "dt_ptcm=20259999",
        "s3://b/raw/dt_ptcm=20250915/part-0.parquet",
        "root/old_dt_ptcm=20250915/f",
        "root/dt_ptcm=202509151/f",
        None,
    ]
    day = "20250915"
    assert values(spark, paths, partition_date) == [
        day, None, None, None, "20259999", day, None, None, None,
    ]
    strict = values(spark, paths, lambda c: partition_date(c, strict=True))
    assert strict == [day, None, None, None, None, day, None, None, None]


def test_difference_overflow_and_nulls(spark):
    df = spark.createDataFrame(
        [(0, 5, 3), (1, None, 3), (2, 5, None), (3, 2**63 - 1, -1)], "i int, a long, b long"
    )
    rows = df.select("i", difference("a", "b").alias("d")).orderBy("i").collect()
    assert [r.d for r in rows] == [2, None, None, None]


def test_cell_text(spark):
    markup = ["<b>A</b>ção ", "a<br/>b", " 1\n  2 ", "&amp;lt; &lt;x&gt;&nbsp;", "", "<i></i>"]
    assert values(spark, markup, cell_text) == ["Ação", "a\nb", "1 2", "&lt; <x>", "", ""]


def test_character_references(spark):
    markup = [
        "A&ccedil;&atilde;o &middot; &copy;", "&#231;&#xe7;&#XE7; &#8364; &#150;", "&#128512;",
        "&#0; &#xD800; &#x110000;", "a & b &nosuch; &amp;amp; &", "&apos;&lt;&amp;lt;", "&#99999999;",
    ]
    assert values(spark, markup, cell_text) == [
        "Ação \xb7 ©", "ççç € –", "\U0001f600",
        "\ufffd \ufffd \ufffd", "a & b &nosuch; &amp; &", "'<&lt;", "&#99999999;",
    ]


def test_functions_stay_out_of_python(spark):
    df = spark.range(1).select(F.lit("1,5").alias("x"))
    plan = df.select(parse_decimal_comma("x"), strip("x"), cell_text("x"))._jdf.queryExecution()
    assert "Python" not in plan.executedPlan().toString()
