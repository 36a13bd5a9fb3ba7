"""Grid sources; the first four mirror the source system's extract tests."""
import json
import os

from pyspark.sql import functions as F

from conftest import HEADER, RUN_TS, SAMPLE_ROWS
from verdant.operators import clean as CL
from verdant.plans.pipeline import extract
from verdant.sources import grid as G
from verdant.sources import json_records as J
from verdant import contract as K


def _write(spark, path, lines):
    spark.createDataFrame([(l,) for l in lines], "value string").coalesce(1).write.text(path)


def _csv(rows):
    return [",".join(HEADER)] + [",".join(r) for r in rows]


def test_full_load_returns_all_rows(spark, scratch):
    p = scratch("grid")
    _write(spark, p, _csv(SAMPLE_ROWS))
    assert G.read_grid(spark, p).count() == 3


def test_strict_watermark(spark, scratch):
    p = scratch("grid")
    _write(spark, p, _csv(SAMPLE_ROWS))
    import datetime as dt
    batch = extract(G.read_grid(spark, p).drop(G.EXTRA_COL), dt.datetime(2025, 4, 15, 2, 28, 40))
    assert [r.plant_name for r in batch.collect()] == ["Plant 1"]


def test_headers_in_order_and_trimmed(spark, scratch):
    p = scratch("grid")
    _write(spark, p, [",".join(f" {h} " for h in HEADER)] + [",".join(SAMPLE_ROWS[0])])
    df = G.read_grid(spark, p)
    assert df.columns == [K.ROW_NO, *HEADER, G.EXTRA_COL]


def test_empty_source_gives_empty_frame(spark, scratch):
    p = scratch("grid")
    spark.createDataFrame([], "value string").write.text(p)
    df = G.read_grid(spark, p)
    assert df.count() == 0
    assert CL.clean(df, run_ts=RUN_TS).count() == 0


def test_short_rows_padded_and_long_rows_flagged(spark, scratch):
    p = scratch("grid")
    short = ",".join(SAMPLE_ROWS[0][:12])
    long_ = ",".join(SAMPLE_ROWS[1] + ["surplus"])
    _write(spark, p, [",".join(HEADER), short, long_])
    rows = sorted(G.read_grid(spark, p).collect(), key=lambda r: r["Plant Name"])
    assert rows[0]["Inside Humidity"] == "" and rows[0]["Outside Humidity"] == ""
    assert rows[0][G.EXTRA_COL] is None and rows[1][G.EXTRA_COL] == '["surplus"]'
    assert G.overlong_rows(G.read_grid(spark, p)).count() == 1


def test_ordinal_follows_file_order(spark, scratch):
    p = scratch("grid")
    first = list(SAMPLE_ROWS[0])
    second = list(SAMPLE_ROWS[0])
    second[2] = "Wilted"
    _write(spark, p, _csv([first, second]))
    out = CL.clean(G.read_grid(spark, p).drop(G.EXTRA_COL), run_ts=RUN_TS).collect()
    assert [r.status for r in out] == ["Wilted"]


def test_write_then_read_grid_round_trip(spark, scratch, grid):
    p = scratch("grid")
    raw = grid(SAMPLE_ROWS).withColumn("Row", F.col(K.ROW_NO).cast("string"))
    G.write_grid(raw, p, ["Row", *HEADER])
    back = G.read_grid(spark, p).select("Row", *HEADER).orderBy("Row").collect()
    assert [list(r)[1:] for r in back] == SAMPLE_ROWS


def test_json_records_keep_text_types(spark, scratch, grid):
    p = scratch("json")
    clean = CL.clean(grid(SAMPLE_ROWS), run_ts=RUN_TS)
    J.write_records(clean, p)
    back = J.read_records(spark, p, K.TARGET_SCHEMA)
    assert sorted(back.collect()) == sorted(clean.collect())
    assert {r.reading_time for r in back.collect()} == {"02:28", "16:04"}


def test_surplus_of_any_length_is_kept(spark, scratch):
    path = scratch("g").removeprefix("file:")
    base = SAMPLE_ROWS[0]
    extras = {"none": [], "empty": [""] * 40, "one": ["s"], "late": [""] * 16 + ["seventeenth"],
              "forty": [f"c{i}" for i in range(40)], "quoted": ['"a,b"', "", '"x ""y"""'] + ["z"] * 30,
              "wide": [""] * 3000 + ["end"]}
    lines = [",".join([base[0], name, *base[2:], *cells]) for name, cells in extras.items()]
    os.makedirs(path)
    with open(os.path.join(path, "a.csv"), "w") as f:
        f.write("\n".join([",".join(HEADER), *lines, ",".join(base[:3])]) + "\n")
    got = {r["Plant Name"]: r[G.EXTRA_COL] for r in G.read_grid(spark, path).collect()}
    assert got.pop("Plant 1") is None and got.pop("none") is None and got.pop("empty") is None
    got = {k: json.loads(v) for k, v in got.items()}
    assert got.pop("quoted")[0] == "a,b"
    assert got == {"one": ["s"], "late": ["seventeenth"], "forty": extras["forty"], "wide": ["end"]}
    assert G.overlong_rows(G.read_grid(spark, path)).count() == 5
    rows = G.overlong_rows(G.read_grid(spark, path, multi_line=True)).select("Plant Name").collect()
    assert sorted(r[0] for r in rows) == ["forty", "late", "one", "quoted", "wide"]
