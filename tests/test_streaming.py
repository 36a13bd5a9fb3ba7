"""File-stream ingestion: micro-batches, later batch wins, replay is harmless."""
import os
import time

from conftest import HEADER, RUN_TS, SAMPLE_ROWS
from verdant.operators import upsert as UP
from verdant.streaming import ingest as S


def _write(spark, path, rows):
    lines = [",".join(HEADER)] + [",".join(r) for r in rows]
    spark.createDataFrame([(l,) for l in lines], "value string").coalesce(1).write.text(path)


def test_stream_batches_and_later_batch_wins(spark, scratch):
    src, target, ckpt = scratch("landing"), scratch("fact"), scratch("ckpt")
    _write(spark, os.path.join(src, "b1"), SAMPLE_ROWS[:2])
    time.sleep(1.1)                                  # file source orders by modification time
    changed = list(SAMPLE_ROWS[0])
    changed[2] = "Wilted"
    _write(spark, os.path.join(src, "b2"), [changed, SAMPLE_ROWS[2]])
    kw = dict(names=HEADER, max_files_per_trigger=1, run_ts=RUN_TS, checkpoint=ckpt)
    spark.conf.set("spark.sql.streaming.fileSource.log.compactInterval", "10")
    q = S.start_ingest(spark, src, target, **kw)
    q.awaitTermination()
    assert q.exception() is None
    assert len(q.recentProgress) >= 2
    table = {(r.plant_name, r.timestamp.day): r.status for r in UP.read_table(spark, target).collect()}
    assert table == {("Plant 1", 15): "Wilted", ("Plant 2", 15): "Séchée", ("Plant 1", 5): "Wilted"}
    # Restart on the same checkpoint: nothing new, table unchanged.
    q2 = S.start_ingest(spark, src, target, **kw)
    q2.awaitTermination()
    assert UP.read_table(spark, target).count() == 3
    # Replaying a batch by hand (what a retried epoch does) changes nothing.
    fn = S.process_batch(target, HEADER, RUN_TS)
    b = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(os.path.join(src, "b2"))
         .select("path", "modificationTime", "length"))
    fn(b, 99)
    assert UP.read_table(spark, target).count() == 3


def test_stream_keeps_rejects_maps_headers_and_goes_on_from_its_own_checkpoint(spark, scratch):
    src, target, rej, log = (scratch(n) for n in ("landing", "fact", "rejects", "log"))
    bad, long_ = ["never", *SAMPLE_ROWS[0][1:]], SAMPLE_ROWS[1] + ["surplus"]
    _write(spark, os.path.join(src, "b1"), [SAMPLE_ROWS[0], bad, long_])
    order = list(reversed(range(len(HEADER))))
    lines = [",".join(HEADER[i] for i in order), ",".join(SAMPLE_ROWS[2][i] for i in order)]
    spark.createDataFrame([(l,) for l in lines], "value string").coalesce(1).write.text(os.path.join(src, "b2"))
    kw = dict(run_ts=RUN_TS, rejects_path=rej, run_log_path=log)
    S.ingest_available(spark, src, target, **kw)
    assert {(r.plant_name, r.status) for r in UP.read_table(spark, target).collect()} == {
        ("Plant 1", "Healthy"), ("Plant 1", "Wilted")}
    kept = {r.reject_reason: r._extra for r in spark.read.parquet(rej).collect()}
    assert kept == {S.K.BAD_TIMESTAMP: None, S.K.TOO_MANY_CELLS: '["surplus"]'}
    runs = S.P.read_run_log(spark, log).collect()
    assert sum(r.rows_extracted for r in runs) == 4 and sum(r.rows_rejected for r in runs) == 2
    S.ingest_available(spark, src, target, **kw)      # no --checkpoint: it lies beside the table
    assert spark.read.parquet(rej).count() == 2 and S.P.read_run_log(spark, log).count() == len(runs)


def test_stream_refuses_overlong_rows_of_a_wide_file(spark, scratch):
    """A file with 20 further columns: its own width counts, not that of the names."""
    src, target, rej = (scratch(n) for n in ("landing", "fact", "rejects"))
    more = [f"More {i}" for i in range(20)]
    rows = [SAMPLE_ROWS[0] + ["m"] * 20, SAMPLE_ROWS[1] + ["m"] * 20 + [""] * 17 + ["surplus"]]
    lines = [",".join([*HEADER, *more])] + [",".join(r) for r in rows]
    spark.createDataFrame([(l,) for l in lines], "value string").coalesce(1).write.text(os.path.join(src, "b 1"))
    S.ingest_available(spark, src, target, run_ts=RUN_TS, rejects_path=rej)
    assert [r.plant_name for r in UP.read_table(spark, target).collect()] == ["Plant 1"]
    assert [(r.reject_reason, r._extra) for r in spark.read.parquet(rej).collect()] == [
        (S.K.TOO_MANY_CELLS, '["surplus"]')]


def test_processing_time_trigger(spark, scratch):
    import datetime as dt
    from verdant.operators import hwm as H
    src, target, state = scratch("landing"), scratch("fact"), scratch("hwm")
    _write(spark, os.path.join(src, "b1"), SAMPLE_ROWS)
    q = S.start_ingest(spark, src, target, names=HEADER, run_ts=RUN_TS, state_path=state,
                       available_now=False, processing_time="1 second")
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert q.exception() is None
    assert UP.read_table(spark, target).count() == 3
    assert H.read_hwm(spark, state) == dt.datetime(2025, 5, 5, 16, 4, 32)
