"""End-to-end runs: incremental vs full, late rows, run log."""
import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from conftest import HEADER, RUN_TS, SAMPLE_ROWS
from verdant import contract as K
from verdant.functions import parse_timestamp
from verdant.operators import hwm as H
from verdant.operators import upsert as UP
from verdant.operators.upsert import read_table
from verdant.plans import pipeline as P
from verdant.sources.fixtures import raw_readings
from verdant.sources.grid import read_grid

SF = "/root/testdata/sf0.001"


def _table(spark, path):
    return sorted(UP.read_table(spark, path).drop(K.AUDIT_COL).collect())


def test_incremental_runs_equal_one_full_run(spark, scratch):
    raw = raw_readings(spark, SF)
    ts = parse_timestamp(F.col("Timestamp"))
    full_t, full_s = scratch("fact"), scratch("hwm")
    P.run(spark, raw, full_t, full_s, full=True, run_ts=RUN_TS)
    inc_t, inc_s = scratch("fact"), scratch("hwm")
    for i, cut in enumerate(["2024-01-08 00:00:00", "2024-01-21 12:00:00", None]):
        sheet = raw if cut is None else raw.where(
            ts.isNull() | (ts <= F.lit(cut).cast("timestamp_ntz")))
        P.run(spark, sheet, inc_t, inc_s, run_ts=f"2025-05-01 1{i}:00:00")
    assert _table(spark, inc_t) == _table(spark, full_t)
    assert UP.read_table(spark, full_t).count() == 976          # FIXTURES.md §4
    assert H.read_hwm(spark, inc_s) == H.read_hwm(spark, full_s) == dt.datetime(2024, 1, 30, 23, 26, 16)
    assert H.state_log(spark, inc_s).count() == 3


def test_rerun_without_new_data_is_a_no_op(spark, scratch):
    raw = raw_readings(spark, SF)
    t, s, log = scratch("fact"), scratch("hwm"), scratch("log")
    P.run(spark, raw, t, s, run_log_path=log, run_ts=RUN_TS)
    r2 = P.run(spark, raw, t, s, run_log_path=log, run_ts="2025-05-01 11:00:00")
    assert r2.rows_loaded == 0 and r2.new_watermark is None and r2.status == "SUCCESS"
    assert H.state_log(spark, s).count() == 1
    rows = P.read_run_log(spark, log).orderBy("started_at").collect()
    assert [r.status for r in rows] == ["SUCCESS", "SUCCESS"]
    hist = P.read_run_log(spark, log, history=True).orderBy("started_at", "finished_at").collect()
    assert [r.status for r in hist] == ["RUNNING", "SUCCESS", "RUNNING", "SUCCESS"]
    assert rows[0].rows_loaded == 976 and rows[0].rows_extracted == 1035


def test_equal_timestamp_late_row_dropped_unless_overlap(spark, grid, scratch):
    from conftest import SAMPLE_ROWS
    t, s = scratch("fact"), scratch("hwm")
    P.run(spark, grid(SAMPLE_ROWS[:1]), t, s, run_ts=RUN_TS)
    late = grid(SAMPLE_ROWS[:2])                         # Plant 2 arrives later, same time
    assert P.run(spark, late, t, s, run_ts="2025-05-01 11:00:00").rows_loaded == 0
    r = P.run(spark, late, t, s, run_ts="2025-05-01 12:00:00", overlap="1 minute")
    assert r.rows_loaded == 2 and r.rows_inserted == 1 and UP.read_table(spark, t).count() == 2


def test_rejects_written_with_reason(spark, scratch):
    raw = raw_readings(spark, SF)
    t, s, rej = scratch("fact"), scratch("hwm"), scratch("rej")
    P.run(spark, raw, t, s, rejects_path=rej, run_ts=RUN_TS)
    got = {r.reject_reason: r["count"] for r in
           spark.read.parquet(rej).groupBy(K.REJECT_COL).count().collect()}
    assert got == {K.BAD_TIMESTAMP: 11, K.DUPLICATE: 34, K.ALL_NULL: 14}


def test_crash_after_commit_is_recovered_by_rerun(spark, scratch, monkeypatch):
    """Fact table committed, HWM not written: the run is FAILED, the rerun
    re-processes the same batch and the keyed upsert leaves the table equal."""
    raw = raw_readings(spark, SF)
    t, s, log = scratch("fact"), scratch("hwm"), scratch("log")

    def boom(*a, **k):
        raise RuntimeError("lost before the mark was written")

    monkeypatch.setattr(H, "update_hwm", boom)
    try:
        P.run(spark, raw, t, s, run_log_path=log, run_ts=RUN_TS)
    except RuntimeError:
        pass
    monkeypatch.undo()
    first = _table(spark, t)
    assert len(first) == 976 and H.read_hwm(spark, s) is None
    assert P.read_run_log(spark, log).first().status == "FAILED"
    r = P.run(spark, raw, t, s, run_log_path=log, run_ts="2025-05-01 11:00:00")
    assert r.rows_updated == 976 and r.rows_inserted == 0
    assert _table(spark, t) == first
    assert H.read_hwm(spark, s) == dt.datetime(2024, 1, 30, 23, 26, 16)


def _of(src, name, rows):
    path = os.path.join(src.removeprefix("file:"), name)
    os.makedirs(path)
    with open(os.path.join(path, "a.csv"), "w") as f:
        f.writelines(",".join(r) + "\n" for r in [HEADER, *rows])
    return path


def test_file_with_a_stored_reject_still_gives_its_late_rows(spark, scratch):
    src, t, s, rej = (scratch(n) for n in ("src", "fact", "hwm", "rej"))
    newest, late, bad = list(SAMPLE_ROWS[2]), list(SAMPLE_ROWS[0]), ["never", *SAMPLE_ROWS[0][1:]]
    other, huge = list(SAMPLE_ROWS[1]), list(SAMPLE_ROWS[1])
    huge[5] = "12345678901"
    P.run(spark, read_grid(spark, _of(src, "1", [newest])), t, s, rejects_path=rej, run_ts=RUN_TS)
    path = _of(src, "2", [late, bad, other, huge])
    r = P.run(spark, read_grid(spark, path), t, s, rejects_path=rej, run_ts=RUN_TS)   # strict mark: late rows skipped
    assert (r.rows_extracted, r.rows_rejected, r.rows_loaded) == (1, 1, 0)
    kw = dict(rejects_path=rej, run_ts=RUN_TS, overlap="60 days")
    r = P.run(spark, read_grid(spark, path), t, s, **kw)
    assert (r.rows_extracted, r.rows_rejected, r.rows_loaded) == (3, 1, 2)           # the bad row isn't new
    r = P.run(spark, read_grid(spark, path), t, s, **kw)
    assert (r.rows_rejected, r.rows_inserted) == (0, 0)
    assert read_table(spark, t).count() == 3
    assert sorted(x.reject_reason for x in spark.read.parquet(rej).collect()) == ["bad_timestamp", "number_overflow"]


def test_a_run_that_dies_before_the_upsert_is_repeated_in_full(spark, scratch, monkeypatch):
    src, t, s, rej = (scratch(n) for n in ("src", "fact", "hwm", "rej"))
    P.run(spark, read_grid(spark, _of(src, "1", [SAMPLE_ROWS[2]])), t, s, rejects_path=rej, run_ts=RUN_TS)
    path = _of(src, "2", [SAMPLE_ROWS[0], ["never", *SAMPLE_ROWS[0][1:]]])
    kw = dict(rejects_path=rej, run_ts=RUN_TS, overlap="60 days")
    with monkeypatch.context() as m:
        m.setattr(P, "stage_and_upsert", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            P.run(spark, read_grid(spark, path), t, s, **kw)
    r = P.run(spark, read_grid(spark, path), t, s, **kw)
    assert (r.rows_loaded, r.rows_rejected) == (1, 0)
    assert read_table(spark, t).count() == 2 and spark.read.parquet(rej).count() == 1
