"""Chat formatting: layouts, hostile texts, the way back, the mask."""
import hashlib
import time

import pytest
from pyspark.sql import functions as F

from verdant.llm import chat as C

ASSISTANT = "\\### Assistant: </turn> ok"


def _format(spark, rows):
    df = spark.createDataFrame(rows, "id int, j string")
    df = C.with_turns(df.withColumn("record", F.try_parse_json("j")), "record")
    out = C.format_turns(df)
    out = out.select("id", "layout", "fingerprint", "formatted", "loss_spans",
                     C.parse_formatted(F.col("formatted")).alias("back"),
                     C.masked_text(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    return {r.id: r for r in out.collect()}


def test_layouts_become_the_same_turns(spark):
    got = _format(spark, [
        (1, '{"messages":[{"role":"user","content":"q"},{"role":"assistant","content":"a"}]}'),
        (2, '{"conversations":[{"from":"human","value":"q"},{"from":"gpt","value":"a"}],"source":"x"}'),
        (3, '{"instruction":"q","output":"a"}'),
        (4, '{"instruction":"q","input":"","output":"a"}'),
        (5, '{"prompt":"q","completion":"a"}'),
        (6, '{"question":"q","answer":"a"}'),
        (7, '{"chat":{"messages":[{"role":"user","content":"q"},{"role":"assistant","content":"a"}]}}'),
    ])
    for r in got.values():
        assert [tuple(t) for t in r.back] == [("user", "q"), ("assistant", "a")], r
        assert r.loss == "a"
    assert got[1].fingerprint != got[2].fingerprint and got[3].layout == got[4].layout == "instruction"


def test_unknown_null_and_broken_records(spark):
    got = _format(spark, [(1, '{"foo":[1]}'), (2, None), (3, "not json"), (4, '{"messages":[]}'),
                          (5, '{"messages":[{"role":null,"content":null}]}')])
    for i in (1, 2, 3, 4):
        assert got[i].layout is None and got[i].formatted == "" and got[i].back == []
    assert [tuple(t) for t in got[5].back] == [("", "")]


@pytest.mark.parametrize("text", [ASSISTANT, "", "\\", "\\b\\h\\l", "### user: x</turn>\n### assistant: y</turn>\n",
                                  "</turn>\n", "a" * 200_000, "é😀<#\\" * 50, "\n\n: :"])
def test_hostile_texts_come_back(spark, text):
    rows = [(1, 0, "user", text), (1, 1, "assistant", text), (1, 2, "a: b#<", text)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = C.format_turns(C.with_turns(C.records_from_rows(df), "record"))
    r = out.select("formatted", "loss_spans", C.parse_formatted(F.col("formatted")).alias("back"),
                   C.masked_text(F.col("formatted"), F.col("loss_spans")).alias("loss")).first()
    assert [tuple(t) for t in r.back] == [("user", text), ("assistant", text), ("a: b#<", text)]
    assert r.loss == text and len(r.loss_spans) == 1


def test_rows_nulls_ties_repeats_empty_and_extra_columns(spark):
    schema = "conv_id long, turn long, role string, text string, record string, turns int, formatted string"
    rows = [(1, 1, "user", None, "x", 1, "y"), (1, 0, "system", "s", "x", 1, "y"), (1, 1, "assistant", "t", "x", 1, "y"),
            (1, 1, "user", None, "x", 1, "y"), (None, None, None, None, None, None, None)]
    out = C.format_turns(C.with_turns(C.records_from_rows(spark.createDataFrame(rows, schema)), "record"))
    got = {r.conv_id: [tuple(t) for t in r.turns] for r in out.collect()}
    assert got[1] == [("system", "s"), ("assistant", "t"), ("user", ""), ("user", "")]
    assert got[None] == [("", "")]
    assert C.records_from_rows(spark.createDataFrame([], schema)).count() == 0


def test_fingerprint_is_the_hash_of_the_sorted_paths():
    paths = "messages[].content|messages[].role"
    assert C.LAYOUTS[0].fingerprints() == [hashlib.sha256(paths.encode()).hexdigest()]


def test_conversations_of_very_many_turns(spark):
    n = 50_000
    df = spark.range(n).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"),
                               F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"),
                               F.concat(F.lit("é#<"), F.col("id")).alias("text"))
    out = C.format_turns(C.with_turns(C.records_from_rows(df), "record"))
    begun = time.monotonic()
    r = out.select("formatted", "loss_spans", F.size(C.parse_formatted(F.col("formatted"))).alias("n"),
                   C.masked_text(F.col("formatted"), F.col("loss_spans")).alias("loss")).first()
    took = time.monotonic() - begun
    assert r.n == n and r.loss == "".join(f"é#<{i}" for i in range(1, n, 2))
    assert [r.formatted[s.start:s.start + s.len] for s in r.loss_spans[:3]] == ["é\\h\\l1", "é\\h\\l3", "é\\h\\l5"]
    assert len(r.loss_spans) == n // 2 and took < 40


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 5, 9, 10, 101])
def test_starts_are_the_sums_before(spark, n):
    sizes = [(i * 7) % 5 for i in range(n)]
    df = spark.createDataFrame([(sizes,)], "sizes array<int>")
    assert df.select(C.starts_of(F.col("sizes"))).first()[0] == [sum(sizes[:i]) for i in range(n)]


def test_spans_that_are_not_a_turns_text(spark):
    df = spark.createDataFrame([("### user: abc</turn>\n### assistant: de</turn>\n",)], "formatted string")
    for spans, loss in (([(10, 3)], "abc"), ([(10, 1), (12, 1)], "ac"), ([(0, 8), (36, 2)], "### userde"),
                        ([(10, 11)], "abc</turn>\n"), ([], "")):
        one = F.array(*[F.struct(F.lit(a).cast("long").alias("start"), F.lit(b).cast("long").alias("len")) for a, b in spans])
        one = one.cast("array<struct<start:bigint,len:bigint>>")
        assert df.select(C.masked_text(F.col("formatted"), one)).first()[0] == loss
