"""Streaming state, replay of rejects, averages from changes, marks per plant, JSON matrices, changed files."""
import datetime as dt
import json
import os
import time

import pytest

from conftest import HEADER, RUN_TS, SAMPLE_ROWS
from verdant import contract as K
from verdant.operators import clean as CL
from verdant.operators import hwm as H
from verdant.operators import rollup as RU
from verdant.operators import upsert as UP
from verdant.plans import pipeline as P
from verdant.plans import replay as RP
from verdant.plans import views as V
from verdant.sources import grid as G
from verdant.sources import matrix as MX
from verdant.session import path_exists
from verdant.streaming import state as ST

NAMES = ["No", *HEADER]


def row(no, ts, plant, moisture="10", status="Healthy"):
    base = dict(zip(HEADER, SAMPLE_ROWS[0]))
    base |= {"Timestamp": ts, "Plant Name": plant, "Status": status, "Moisture Sensor": moisture}
    return [str(no), *[base[c] for c in HEADER]]


def land(spark, path, rows, header=NAMES):
    lines = [",".join(header)] + [",".join(r) for r in rows]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)


def local(path):
    """The folder behind a path of the shared scratch root, created."""
    path = path.removeprefix("file:")
    os.makedirs(path)
    return path


# -- streaming state ------------------------------------------------------------

def test_windows_close_once_late_rows_are_kept_and_state_survives_restarts(spark, scratch):
    src, feed, rej, out = (scratch(n) for n in ("landing", "feed", "rejects", "daily"))
    sizes = []

    def deliver(k, rows):
        land(spark, f"{src}/{k}", rows)
        q = ST.finish(ST.start_feed(spark, src, feed, rej, "1 day", names=NAMES, ordinal="No", run_ts=RUN_TS))
        assert q.exception() is None
        q = ST.finish(ST.start_daily_windows(spark, feed, out, "1 day"))  # a new query on the old checkpoint
        sizes.append([o["numRowsTotal"] for o in q.lastProgress["stateOperators"]])
        assert all(o["numRowsDroppedByWatermark"] == 0 for p in q.recentProgress for o in p["stateOperators"])
        return sorted((str(r.reading_date), r.plant_name, r.reading_count, r.avg_moisture)
                      for r in spark.read.schema("reading_date date, plant_name string, reading_count long, "
                                                 "avg_moisture double").parquet(out).collect()) if path_exists(spark, out) else []

    # the day of the first batch is open: its second row for the same key is earlier in the source
    assert deliver(0, [row(5, "2025-04-01 10:00:00", "A", "10"), row(2, "2025-04-01 10:00:00", "A", "90"),
                       row(3, "2025-04-01 11:00:00", "A", "20"), row(4, "bad", "A")]) == []
    # a day later it is still open for late rows, and the first batch's state is there
    assert deliver(1, [row(6, "2025-04-01 12:00:00", "A", "30"), row(7, "2025-04-02 09:00:00", "B")]) == []
    got = deliver(2, [row(8, "2025-04-03 08:00:00", "B", "")])
    assert got == [("2025-04-01", "A", 3, 20.0)]
    # now the first of April is closed
    got = deliver(3, [row(9, "2025-04-01 13:00:00", "A", "99"), row(10, "2025-04-02 10:00:00", "A", "7"),
                      row(11, "2025-04-05 00:00:00", "A")])
    assert got == [("2025-04-01", "A", 3, 20.0), ("2025-04-02", "A", 1, 7.0), ("2025-04-02", "B", 1, 10.0),
                   ("2025-04-03", "B", 1, None)]
    assert max(sizes[-1]) <= 2 and sum(sizes[1]) > sum(sizes[-1])  # closed days leave the state
    late = spark.read.parquet(rej).where(f"{K.REJECT_COL} = '{K.LATE_EVENT}'").collect()
    assert [r[K.ROW_NO] for r in late] == [9] and json.loads(late[0][K.CELLS_COL])["Moisture Sensor"] == "99"
    assert spark.read.parquet(rej).where(f"{K.REJECT_COL} = '{K.BAD_TIMESTAMP}'").count() == 1


def test_keep_last_state_orders_by_the_source_and_is_bounded(spark, scratch):
    src, feed, rej, target = (scratch(n) for n in ("landing", "feed", "rejects", "fact"))
    batches = [[row(9, "2025-04-01 10:00:00", "A", "3"), row(1, "2025-04-01 11:00:00", "A", "1")],
               [row(2, "2025-04-01 10:00:00", "A", "1"), row(4, "2025-04-01 11:00:00", "A", "2")],
               [row(3, "2025-04-01 10:00:00", "A", "2"), row(8, "2025-05-01 10:00:00", "B", "5")],
               [row(12, "2025-05-02 10:00:00", "B", "6")]]
    for k, rows in enumerate(batches):
        land(spark, f"{src}/{k}", rows)
        ST.finish(ST.start_feed(spark, src, feed, rej, "10 days", names=NAMES, ordinal="No", run_ts=RUN_TS))
        q = ST.finish(ST.start_keep_last(spark, feed, target, "10 days", RUN_TS))
    got = {(str(r.timestamp), r.plant_name): float(r.moisture_sensor) for r in UP.read_table(spark, target).collect()}
    assert got == {("2025-04-01 10:00:00", "A"): 3.0, ("2025-04-01 11:00:00", "A"): 2.0,
                   ("2025-05-01 10:00:00", "B"): 5.0, ("2025-05-02 10:00:00", "B"): 6.0}
    assert q.lastProgress["stateOperators"][0]["numRowsTotal"] == 2  # April's keys are gone


def test_a_repeated_feed_batch_replaces_what_it_wrote(spark, scratch):
    src, feed, rej = (scratch(n) for n in ("landing", "feed", "rejects"))
    land(spark, src, [row(1, "2025-04-01 10:00:00", "A"), row(2, "bad", "A")])
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(src)
             .select("path", "modificationTime", "length"))
    fn = ST.feed_batch(feed, rej, NAMES, "1 day", "No", K.TIMESTAMP_FORMATS, None, RUN_TS)
    for _ in range(2):
        fn(files, 0)
    assert ST.read_feed(spark, feed).count() == 1 and spark.read.parquet(rej).count() == 1
    fn(files.limit(0), 1)
    assert ST.read_feed(spark, feed).count() == 1 and str(ST._newest_before(spark, feed, 9)) == "2025-04-01 10:00:00"


# -- replay ------------------------------------------------------------------------

def rejected(spark, path):
    return sorted((r[K.ROW_NO], r[K.REJECT_COL]) for r in P.stored_rejects(spark, path).collect())


def refused_run(spark, grid, scratch):
    cells = [r[1:] for r in (row(0, "2025-04-15 10:00:00", "A", "1"), row(0, "15.4.2025 10:00:00", "A", "2"),
                             row(0, "16.4.2025 10:00:00", "A", "3"), row(0, "16.4.2025 10:00:00", "A", "4"),
                             row(0, "nothing", "A"), row(0, "17.4.2025 10:00:00", None))]
    target, state, rej = (scratch(n) for n in ("fact", "hwm", "rejects"))
    P.run(spark, grid(cells), target, state, run_ts=RUN_TS, rejects_path=rej)
    return target, rej


LAYOUTS = [*K.TIMESTAMP_FORMATS, "d.M.yyyy H:mm:ss"]
AFTER = [(1, K.DUPLICATE), (2, K.DUPLICATE), (4, K.BAD_TIMESTAMP), (5, K.NULL_PLANT)]


def moisture(spark, target):
    return {str(r.timestamp): float(r.moisture_sensor) for r in UP.read_table(spark, target).collect()}


def test_replay_moves_what_now_parses_and_never_replaces_a_reading(spark, grid, scratch):
    target, rej = refused_run(spark, grid, scratch)
    assert [n for n, _ in rejected(spark, rej)] == [1, 2, 3, 4, 5]
    cells = {r[K.ROW_NO]: json.loads(r[K.CELLS_COL])["Timestamp"] for r in P.stored_rejects(spark, rej).collect()}
    assert cells[4] == "nothing" and cells[1] == "15.4.2025 10:00:00"
    assert RP.replay(spark, rej, target, run_ts=RUN_TS).rows_moved == 0  # no new layout: nothing moves
    res = RP.replay(spark, rej, target, LAYOUTS, run_ts=RUN_TS)
    assert (res.rows_tried, res.rows_moved, res.rows_kept) == (5, 1, 4)
    assert moisture(spark, target) == {"2025-04-15 10:00:00": 1.0, "2025-04-16 10:00:00": 4.0}
    assert rejected(spark, rej) == AFTER
    assert RP.replay(spark, rej, target, LAYOUTS, run_ts=RUN_TS).rows_moved == 0 and rejected(spark, rej) == AFTER


def test_replay_after_a_crash(spark, grid, scratch, monkeypatch):
    for point in ("upsert", "finish_replay"):
        target, rej = refused_run(spark, grid, scratch)
        real = getattr(RP, point)

        def die(*a, **kw):
            if point == "finish_replay" and not kw.get("stored"):
                return real(*a, **kw)
            raise RuntimeError("lost")
        with monkeypatch.context() as m:
            m.setattr(RP, point, die)
            with pytest.raises(RuntimeError):
                RP.replay(spark, rej, target, LAYOUTS, run_ts=RUN_TS)
        RP.replay(spark, rej, target, LAYOUTS, run_ts=RUN_TS)
        assert rejected(spark, rej) == AFTER and moisture(spark, target)["2025-04-16 10:00:00"] == 4.0


# -- averages from changes -------------------------------------------------------------

def test_averages_follow_every_kind_of_change(spark, grid, scratch):
    target, sums = scratch("fact"), scratch("rollup")
    steps = [[row(0, "2025-04-15 10:00:00", "A", "10"), row(0, "2025-04-15 11:00:00", "A", ""), row(0, "2025-04-16 10:00:00", "B", "5")],
             [row(0, "2025-04-15 10:00:00", "A", ""), row(0, "2025-04-15 11:00:00", "A", "7"), row(0, "2025-04-15 12:00:00", "C", "1")],
             [row(0, "2025-04-15 10:00:00", "A", "2.5"), row(0, "2025-04-17 10:00:00", "A", "1")]]
    for rows in steps:
        source = P.stage(CL.with_partition(CL.clean(grid([r[1:] for r in rows]), RUN_TS)), partition=False)
        change = RU.stage_changes(spark, source, target)
        UP.upsert(spark, source, target)
        RU.apply_changes(spark, change, sums, keep=True)
        RU.apply_changes(spark, change, sums)  # what a run repeated after a crash does
        want = sorted(map(str, V.daily_averages(UP.read_table(spark, target)).collect()))
        assert sorted(map(str, RU.daily_averages(RU.read_rollup(spark, sums)).collect())) == want


# -- marks per plant ----------------------------------------------------------------------

def test_a_fast_plant_hides_no_other(spark, grid, scratch):
    first = [row(0, "2030-01-01 00:00:00", "Fast"), row(0, "2025-04-01 00:00:00", "Slow")]
    second = [*first, row(0, "2025-04-02 00:00:00", "Slow"), row(0, "2029-01-01 00:00:00", "Fast"),
              row(0, "2025-03-01 00:00:00", "New"), row(0, "bad", "Slow")]
    results = {}
    for kind in ("marks", "single"):
        target, state, rej = scratch("fact"), scratch("hwm"), scratch("rejects")
        kw = {"marks_path": scratch("marks")} if kind == "marks" else {}
        for rows in (first, second):
            P.run(spark, grid([r[1:] for r in rows]), target, state, run_ts=RUN_TS, rejects_path=rej, **kw)
        results[kind] = sorted((str(r.timestamp.date()), r.plant_name) for r in UP.read_table(spark, target).collect())
        assert str(H.read_hwm(spark, state)) == "2030-01-01 00:00:00"
        assert [x for _, x in rejected(spark, rej)] == [K.BAD_TIMESTAMP]
    assert results["single"] == [("2025-04-01", "Slow"), ("2030-01-01", "Fast")]
    assert results["marks"] == [("2025-03-01", "New"), ("2025-04-01", "Slow"), ("2025-04-02", "Slow"), ("2030-01-01", "Fast")]
    marks = {r.plant_name: str(r.last_watermark.date()) for r in H.current_marks(spark, kw.get("marks_path", "/nowhere")).collect()}
    assert marks == {}


# -- JSON matrices ---------------------------------------------------------------------------

def test_matrix_documents(spark, scratch):
    path = local(scratch("matrix"))
    docs = {"a.json": {"range": "S!A1:C", "values": [[" Timestamp ", "Plant Name", "Status"], ["t1", "A", "ok", "", "more", 5], ["t2"], []]},
            "b.json": [["Status", "Timestamp", "Status"], ["x", "t3", "y"], [None, 7, True]],
            "c.json": {"range": "S!A1"}, "d.json": {"values": []}, "e.json": {"values": [["Timestamp"]]}, "f.json": [], "g.json": "broken"}
    for k, (name, doc) in enumerate(docs.items()):
        text = doc if isinstance(doc, str) else json.dumps(doc)
        with open(f"{path}/{name}", "w") as f:
            f.write(text)
        os.utime(f"{path}/{name}", (1_700_000_000 + k,) * 2)
    g = MX.read_matrix(spark, path, ["Timestamp", "Plant Name", "Status"]).orderBy(K.ROW_NO)
    assert [tuple(r)[1:] for r in g.collect()] == [
        ("t1", "A", "ok", '["more","5"]'), ("t2", "", "", None), ("", "", "", None),
        ("t3", None, "x", None), ("7", None, "", None)]
    assert "Python" not in g._jdf.queryExecution().executedPlan().toString()
    after = dt.datetime(2023, 11, 14, 22, 13, 20)  # the first document's change
    assert MX.read_matrix(spark, path, ["Timestamp"], modified_after=after).count() == 2


# -- files ----------------------------------------------------------------------------------------

def jobs(spark, fn):
    sc = spark.sparkContext
    group = f"g{time.monotonic_ns()}"
    sc.setJobGroup(group, group)
    out = fn()
    sc.setJobGroup("none", "none")
    return out, len(sc.statusTracker().getJobIdsForGroup(group))


def test_headers_cost_no_job_a_file(spark, scratch):
    counts = {}
    for n in (3, 60):
        path = scratch("many")
        path = local(path)
        for i in range(n):
            with open(f"{path}/{i}.csv", "w") as f:
                f.write('﻿\n' if i % 3 == 0 else "")
                f.write('"Plant, Name",Timestamp\n"a, b",t\n' if i % 2 else " Timestamp ,Other\nt,o\n")
        grid, counts[n] = jobs(spark, lambda: G.read_grid(spark, path))
        assert set(grid.columns) == {K.ROW_NO, "Plant, Name", "Timestamp", "Other", K.EXTRA_COL}
        assert grid.where("Timestamp = 't'").count() == n
    assert counts[3] == counts[60] <= 2


def test_a_run_opens_only_changed_files(spark, scratch):
    path, target, state, log = (scratch(n) for n in ("landing", "fact", "hwm", "log"))
    path = local(path)
    now = time.time()

    def put(name, rows, age):
        with open(f"{path}/{name}", "w") as f:
            f.write("\n".join([",".join(HEADER), *[",".join(r[1:]) for r in rows]]) + "\n")
        os.utime(f"{path}/{name}", (now - age,) * 2)

    put("old.csv", [row(0, "2025-04-01 00:00:00", "A")], 7 * 86400)
    assert P.changed_since(spark, log) is None
    P.run(spark, G.read_grid(spark, path), target, state, run_log_path=log)
    after = P.changed_since(spark, log, overlap="1 hour")
    put("late.csv", [row(0, "2025-04-02 00:00:00", "A")], 1800)   # finished late, within the overlap
    put("new.csv", [row(0, "2025-04-03 00:00:00", "A")], 0)
    grid = G.read_grid(spark, path, modified_after=after)
    assert {os.path.basename(f) for f in grid.inputFiles()} == {"late.csv", "new.csv"}
    P.run(spark, grid, target, state, run_log_path=log)
    assert UP.read_table(spark, target).count() == 3
