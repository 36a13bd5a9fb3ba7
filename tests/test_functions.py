"""Scalar expressions against Python's own string/number semantics."""
import datetime as dt
import sys

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from verdant.functions import (iso_timestamp, parse_number, parse_timestamp, round_to_second,
                               strip, title_case)
from verdant.functions.text import WHITESPACE

ALPHABET = st.sampled_from(list("abcXYZ -'_1209éÉßǆİ中\t .,") + ["ﬁ", "Σ", "σ"])


def test_whitespace_set_is_pythons():
    assert WHITESPACE == "".join(c for c in map(chr, range(sys.maxunicode + 1)) if c.isspace())


@settings(max_examples=1, deadline=None)
@given(st.lists(st.text(alphabet=ALPHABET, max_size=12), min_size=200, max_size=200))
def test_strip_and_title_match_python(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    got = df.select("s", title_case(strip("s")).alias("t")).collect()
    for row in got:
        assert row.t == row.s.strip().title(), (row.s, row.t)


def test_title_examples(spark):
    cases = {"plant-1a": "Plant-1A", "o'neil basil": "O'Neil Basil", "3d": "3D",
             "éclair": "Éclair", "PLANT-A 7": "Plant-A 7", "": ""}
    df = spark.createDataFrame([(k,) for k in cases] + [(None,)], "s string")
    got = {r.s: r.t for r in df.select("s", title_case("s").alias("t")).collect()}
    assert got.pop(None) is None
    assert got == cases


def test_parse_number(spark):
    cases = {"12": 12.0, " 12.5 ": 12.5, " 7 ": 7.0, "-3": -3.0, "+4.": 4.0,
             ".5": 0.5, "1e3": 1000.0, "1d": None, "1f": None, "inf": None, "nan": None,
             "NaN": None, "1,000": None, "91.99%": None, "n/a": None, "": None, "0x10": None}
    df = spark.createDataFrame([(k,) for k in cases], "s string")
    got = {r.s: r.v for r in df.select("s", parse_number("s").alias("v")).collect()}
    assert got == cases


def test_parse_timestamp_formats_and_rounding(spark):
    cases = {
        "2025-04-15 02:28:40": dt.datetime(2025, 4, 15, 2, 28, 40),
        "2025-04-15T02:28:40": dt.datetime(2025, 4, 15, 2, 28, 40),
        "2025-04-15 02:28:40.6": dt.datetime(2025, 4, 15, 2, 28, 41),
        "4/15/2025 2:28:40": dt.datetime(2025, 4, 15, 2, 28, 40),
        " 2025-04-15 02:28:40\t": dt.datetime(2025, 4, 15, 2, 28, 40),
        "NOT A DATE": None, "2025": None, "2025-04": None, "": None,
    }
    df = spark.createDataFrame([(k,) for k in cases], "s string")
    got = {r.s: r.v for r in df.select("s", parse_timestamp("s").alias("v")).collect()}
    assert got == cases


def test_round_and_iso(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 0, 7, 500000),),
                                (dt.datetime(2024, 1, 1, 0, 0, 7, 499999),)], "ts timestamp_ntz")
    got = df.select(round_to_second("ts").alias("r"), iso_timestamp("ts").alias("i")).collect()
    assert [r.r for r in got] == [dt.datetime(2024, 1, 1, 0, 0, 8), dt.datetime(2024, 1, 1, 0, 0, 7)]
    assert [r.i for r in got] == ["2024-01-01T00:00:07.500000", "2024-01-01T00:00:07.499999"]


def test_sql_text_and_column_forms_agree(spark):
    """Named columns take a SQL-text path; Column inputs take the Column API."""
    from verdant.functions import clean_text, exact_avg, to_decimal
    vals = ["12", " 12.5 ", " 7　", "-3", "+4.", ".5", "1e3", "1d", "inf", "nan", "1,000",
            "91.99%", "n/a", "", None, "0x10", "a'b", "\\1", "123456.789", "  plant-1a\t",
            "2025-04-15 02:28:40", "2025-04-15T02:28:40", "2025-04-15 02:28:40.6",
            "4/15/2025 2:28:40", " 2025-04-15 02:28:40\t", "NOT A DATE", "2025"]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    c = F.col("s")
    rows = df.select(
        parse_number("s").alias("n1"), parse_number(c).alias("n2"),
        parse_timestamp("s").alias("t1"), parse_timestamp(c).alias("t2"),
        clean_text("s").alias("c1"), clean_text(c).alias("c2"),
        to_decimal(parse_number(c), 6).alias("d2"),
    ).collect()
    for r in rows:
        assert (r.n1, r.t1, r.c1) == (r.n2, r.t2, r.c2)
    d = df.select(parse_number(c).alias("x")).select(to_decimal("x", 6).alias("d1"),
                                                      to_decimal(F.col("x"), 6).alias("d2"))
    assert all(r.d1 == r.d2 for r in d.collect())
    nums = spark.createDataFrame([(x,) for x in ["1.01", "2.02", "3.5", None]], "s string") \
        .select(to_decimal(parse_number("s"), 8).alias("v"))
    a = nums.agg(exact_avg("v").alias("a1"), exact_avg(F.col("v")).alias("a2")).first()
    assert a.a1 == a.a2 == 6.53 / 3
