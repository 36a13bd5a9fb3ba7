"""Cleaning steps; the first eight mirror the source system's transform tests."""
import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import HEADER, RUN_TS, SAMPLE_ROWS
from verdant import contract as K
from verdant.operators import clean as CL


def test_rename_columns(spark, grid):
    df = CL.rename_columns(grid(SAMPLE_ROWS))
    assert set(K.RENAME_MAP.values()) <= set(df.columns)
    assert "Plant Name" not in df.columns


def test_timestamp_is_datetime(spark, grid):
    out = CL.clean(grid(SAMPLE_ROWS), run_ts=RUN_TS)
    assert out.schema["timestamp"].dataType == T.TimestampNTZType()


def test_numerics_are_decimals(spark, grid):
    out = CL.clean(grid(SAMPLE_ROWS), run_ts=RUN_TS)
    assert out.schema["confidence_score_pct"].dataType == T.DecimalType(6, 2)
    assert out.schema["moisture_sensor"].dataType == T.DecimalType(8, 2)
    row = out.where("plant_name = 'Plant 1' and status = 'Healthy'").first()
    assert row.confidence_score_pct == Decimal("61.07") and row.inside_humidity is None


def test_status_title_case(spark, grid):
    out = CL.clean(grid(SAMPLE_ROWS), run_ts=RUN_TS)
    assert {r.status for r in out.collect()} == {"Healthy", "Séchée", "Wilted"}


def test_duplicates_removed(spark, grid):
    rows = [SAMPLE_ROWS[0], SAMPLE_ROWS[0]]
    assert CL.clean(grid(rows), run_ts=RUN_TS).count() == 1


def test_bad_timestamp_dropped(spark, grid):
    bad = ["NOT A DATE", *SAMPLE_ROWS[0][1:]]
    out = CL.clean(grid([bad, SAMPLE_ROWS[1]]), run_ts=RUN_TS).collect()
    assert [r.plant_name for r in out] == ["Plant 2"]


def test_metadata_added(spark, grid):
    out = CL.clean(grid(SAMPLE_ROWS), run_ts=RUN_TS)
    assert {r.etl_inserted_at for r in out.collect()} == {dt.datetime(2025, 5, 1, 10)}


def test_empty_in_empty_out(spark, grid):
    out = CL.clean(grid([]), run_ts=RUN_TS)
    assert out.count() == 0 and out.columns == K.TARGET_COLUMNS


# -- behaviour the source tests leave open -----------------------------------------

def test_keep_last_of_differing_duplicates(spark, grid):
    later = list(SAMPLE_ROWS[0])
    later[2] = "Wilted"
    out = CL.clean(grid([SAMPLE_ROWS[0], later]), run_ts=RUN_TS).collect()
    assert [r.status for r in out] == ["Wilted"]


def test_names_collide_after_cleaning(spark, grid):
    other = list(SAMPLE_ROWS[0])
    other[1] = "  plant 1 "
    out = CL.clean(grid([SAMPLE_ROWS[0], other]), run_ts=RUN_TS).collect()
    assert len(out) == 1 and out[0].plant_name == "Plant 1"


def test_all_empty_last_duplicate_removes_key(spark, grid):
    empty = list(SAMPLE_ROWS[0])
    for i in (3, 4, 5, 6, 7, 8, 9, 11, 12, 13, 14):
        empty[i] = ""
    out = CL.clean(grid([SAMPLE_ROWS[0], empty]), run_ts=RUN_TS)
    assert out.count() == 0


def test_all_null_row_dropped_and_rejected(spark, grid):
    empty = list(SAMPLE_ROWS[2])
    for i in (3, 4, 5, 6, 7, 8, 9, 11, 12, 13, 14):
        empty[i] = "n/a"
    raw = grid([SAMPLE_ROWS[0], empty])
    assert CL.clean(raw, run_ts=RUN_TS).count() == 1
    rej = {r._row_no: r.reject_reason for r in CL.rejects(raw).collect()}
    assert rej == {1: K.ALL_NULL}


def test_rejects_and_clean_partition_the_input(spark, grid):
    bad = ["NOT A DATE", *SAMPLE_ROWS[0][1:]]
    no_name = list(SAMPLE_ROWS[1])
    no_name[1] = None
    rows = [SAMPLE_ROWS[0], SAMPLE_ROWS[0], bad, no_name, SAMPLE_ROWS[2]]
    raw = grid(rows)
    reasons = {r._row_no: r.reject_reason for r in CL.rejects(raw).collect()}
    assert reasons == {0: K.DUPLICATE, 2: K.BAD_TIMESTAMP, 3: K.NULL_PLANT}
    counts = CL.stage_counts(raw).first().asDict()
    assert counts["rows_extracted"] == 5 and counts["rows_clean"] == 2


def test_counts_add_up_with_every_reason(spark, grid):
    def row(**cells):
        out = list(SAMPLE_ROWS[2])
        for i, v in cells.items():
            out[int(i[1:])] = v
        return out

    empty = {f"c{i}": "" for i in (3, 4, 5, 6, 7, 8, 9, 11, 12, 13, 14)}
    raw = grid([row(), row(), row(c0="never"), row(c1=None), row(c0="2031-01-01 00:00:00"), row(c9="123456"),
                row(c1="other", **empty)])
    raw = raw.withColumn(K.EXTRA_COL, F.when(F.col(K.ROW_NO) == 1, '["x"]'))
    counts = CL.stage_counts(raw, run_ts=RUN_TS, max_future="30 days").first().asDict()
    assert counts == {"rows_extracted": 7, f"rows_{K.BAD_TIMESTAMP}": 1, f"rows_{K.NULL_PLANT}": 1,
                      f"rows_{K.TOO_MANY_CELLS}": 1, f"rows_{K.OVERFLOW}": 1, f"rows_{K.FUTURE_TIMESTAMP}": 1,
                      f"rows_{K.DUPLICATE}": 0, f"rows_{K.ALL_NULL}": 1, "rows_clean": 1}
    assert CL.rejects(raw, run_ts=RUN_TS, max_future="30 days").count() == 6
    assert CL.stage_counts(raw.limit(0)).first().rows_extracted == 0


def test_building_the_typed_plan_starts_no_job(spark, grid):
    raw = grid(SAMPLE_ROWS).groupBy(*grid(SAMPLE_ROWS).columns).count().drop("count")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("typed-plan", "no job")
    CL.clean_typed(CL.typed(raw))
    assert not tracker.getJobIdsForGroup("typed-plan")
    with pytest.raises(ValueError):
        CL.typed(raw.drop(K.ROW_NO))


@pytest.mark.parametrize("text,want", [
    ("2025-04-15", "2025-04-15 00:00:00"), ("2025-04-15 02:28", "2025-04-15 02:28:00"),
    ("2025/04/15 02:28:40", "2025-04-15 02:28:40"), ("2025-04-15T02:28:40Z", "2025-04-15 02:28:40"),
    ("2025-04-15T02:28:40+02:00", "2025-04-15 00:28:40"), ("4/15/2025 2:28", "2025-04-15 02:28:00"),
    ("4/15/2025 2:28:40 PM", "2025-04-15 14:28:40"), ("4/15/2025", "2025-04-15 00:00:00"),
    ("2025-04-15 02:28:39.999999999", "2025-04-15 02:28:40"), ("12:30", None), ("2025", None), ("2025-13-01", None),
    ("2025-04/15", None), ("", None), ("NOT A DATE", None)])
def test_timestamp_layouts(spark, text, want):
    from verdant.functions import parse_timestamp
    df = spark.createDataFrame([(text,)], "t string")
    r = df.select(parse_timestamp("t").cast("string").alias("a"), parse_timestamp(F.col("t")).cast("string").alias("b")).first()
    assert r.a == r.b == want


def test_numeric_edge_cases(spark, grid):
    row = list(SAMPLE_ROWS[0])
    row[3], row[4], row[5], row[6], row[7] = "1d", "inf", " 12 ", "1,000", "91.99%"
    out = CL.clean(grid([row]), run_ts=RUN_TS).first()
    assert out.confidence_score_pct is None and out.moisture_sensor is None
    assert out.humidity == Decimal("12.00") and out.nitrogen is None and out.phosphorus is None
    row[9] = "9999.995"             # rounds past DECIMAL(6,2): the row is refused
    assert CL.clean(grid([row]), run_ts=RUN_TS).count() == 0
    assert [r.reject_reason for r in CL.rejects(grid([row])).collect()] == [K.OVERFLOW]


def test_fractional_seconds_rounded_before_dedup(spark, grid):
    a = ["2025-04-15 02:28:39.7", *SAMPLE_ROWS[0][1:]]
    out = CL.clean(grid([a, SAMPLE_ROWS[0]]), run_ts=RUN_TS).collect()
    assert len(out) == 1 and out[0].timestamp == dt.datetime(2025, 4, 15, 2, 28, 40)


def test_future_rows_rejected_when_bounded(spark, grid):
    future = ["2031-01-01 00:00:00", *SAMPLE_ROWS[0][1:]]
    raw = grid([future, SAMPLE_ROWS[2]])
    out = CL.clean(raw, run_ts=RUN_TS, max_future="30 days").collect()
    assert [r.timestamp.year for r in out] == [2025]
    reasons = {r.reject_reason for r in CL.rejects(raw, run_ts=RUN_TS, max_future="30 days").collect()}
    assert reasons == {K.FUTURE_TIMESTAMP}


def test_missing_column_added_and_extra_kept(spark, grid):
    header = [h for h in HEADER if h != "Inside Humidity"] + ["Note"]
    rows = [r[:-1] + ["x"] for r in SAMPLE_ROWS]
    df = CL.rename_columns(grid(rows, header=header))
    assert "inside_humidity" in df.columns and "Note" in df.columns
    assert CL.clean(grid(rows, header=header), run_ts=RUN_TS).count() == 3


def test_missing_timestamp_raises(spark, grid):
    header = [h for h in HEADER if h != "Timestamp"]
    with pytest.raises(KeyError):
        CL.rename_columns(grid([r[1:] for r in SAMPLE_ROWS], header=header))


def test_header_whitespace_trimmed(spark, grid):
    header = [f" {h} " for h in HEADER]
    assert CL.clean(grid(SAMPLE_ROWS, header=header), run_ts=RUN_TS).count() == 3
