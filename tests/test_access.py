"""Cells under headers without a column; layouts for one plant and one status."""
import datetime as dt
import glob

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from conftest import RUN_TS, SAMPLE_ROWS
from verdant import contract as K
from verdant.operators import access as AC
from verdant.operators import clean as CL
from verdant.operators import compact as CP
from verdant.operators import upsert as UP
from verdant.plans import pipeline as P
from verdant.plans import replay as RP

HEADER = [*K.RAW_COLUMNS, " Note ", "unmapped", "Sensor Serial"]


def _cells(spark, path):
    rows = UP.read_table(spark, path, unmapped=True).select(
        "plant_name", F.dayofmonth("timestamp").alias("day"), F.col(K.UNMAPPED_COL).cast("string").alias("other"))
    return {(r.plant_name, r.day): r.other for r in rows.collect()}


def _wide(grid, extra, rows=SAMPLE_ROWS):
    return grid([[*r, *x] for r, x in zip(rows, extra)], HEADER)


def test_cells_without_a_column_reach_the_table(spark, grid, scratch):
    raw = _wide(grid, [("first", "x", ""), ("", None, ""), ("", "", "SN 1")])
    t, s = scratch("fact"), scratch("hwm")
    P.run(spark, raw, t, s, run_ts=RUN_TS, keep_unmapped=True, rejects_path=scratch("rej"))
    want = {("Plant 1", 15): '{"Note":"first","unmapped":"x"}', ("Plant 2", 15): None,
            ("Plant 1", 5): '{"Sensor Serial":"SN 1"}'}
    assert _cells(spark, t) == want
    assert UP.read_table(spark, t).columns == [*K.TARGET_COLUMNS, K.PARTITION_COL]

    # a row that is replaced has the new row's cells, its neighbour of the same day keeps its own
    more = _wide(grid, [("second", "", "")], [["2025-04-15 02:28:40", "Plant 2", *SAMPLE_ROWS[1][2:]]])
    P.run(spark, more, t, s, run_ts=RUN_TS, keep_unmapped=True, full=True)
    want["Plant 2", 15] = '{"Note":"second"}'
    assert _cells(spark, t) == want

    # a batch that does not keep them drops only those of the rows it replaces
    P.run(spark, more, t, s, run_ts=RUN_TS, full=True)
    want["Plant 2", 15] = None
    assert _cells(spark, t) == want
    assert CP.compact_days(spark, t, at_least=1) and _cells(spark, t) == want


def test_no_unknown_header_and_none_kept_before(spark, grid, scratch):
    t, s = scratch("fact"), scratch("hwm")
    P.run(spark, grid(SAMPLE_ROWS[:2]), t, s, run_ts=RUN_TS)                 # files without the column
    P.run(spark, grid(SAMPLE_ROWS), t, s, run_ts=RUN_TS, keep_unmapped=True)
    assert set(_cells(spark, t).values()) == {None} and len(_cells(spark, t)) == 3
    assert not CL.holds_unmapped(_wide(grid, [("", "text", "")]))            # a sheet's own column of that name


def test_replay_keeps_cells(spark, grid, scratch):
    late = [["15.04.2025 02:28:40", *SAMPLE_ROWS[0][1:]]]
    t, s, rej = scratch("fact"), scratch("hwm"), scratch("rej")
    P.run(spark, _wide(grid, [("kept", "", "")], late), t, s, run_ts=RUN_TS, rejects_path=rej, keep_unmapped=True)
    assert K.UNMAPPED_COL not in [c for c, kind in spark.read.parquet(rej).dtypes if kind == "variant"]
    got = RP.replay(spark, rej, t, [K.ISO, "d.M.yyyy H:mm:ss"], run_ts=RUN_TS, keep_unmapped=True)
    assert got.rows_moved == 1 and _cells(spark, t) == {("Plant 1", 15): '{"Note":"kept"}'}


DAYS, PLANTS = 28, 120


def _month(spark):
    """A month of readings, eight a plant and day."""
    r = spark.range(DAYS * PLANTS * 8)
    at = F.expr(f"timestamp_ntz'2025-02-01' + make_interval(0, 0, 0, cast(id div {PLANTS * 8} as int), "
                f"cast(id % 8 * 3 as int), 0, cast(id div 8 % {PLANTS} % 60 as int))")
    rows = r.select(at.alias("timestamp"), F.expr(f"concat('Plant ', id div 8 % {PLANTS})").alias("plant_name"),
                    F.expr("case when id % 13 = 0 then 'Wilted' else 'Healthy' end").alias("status"),
                    F.lit("50").alias("confidence_score_pct"))
    return CL.with_partition(CL.to_target(rows))


def _files(path):
    local = path.removeprefix("file:")
    return [pq.ParquetFile(f) for f in glob.glob(f"{local}/**/*.parquet", recursive=True)]


def _row_groups(path, column, value):
    """(row groups that hold the value, all row groups) of a table's files."""
    hold = every = 0
    for file in _files(path):
        every += file.num_row_groups
        hold += sum(value in file.read_row_group(i, [column])[column].to_pylist() for i in range(file.num_row_groups))
    return hold, every


def test_fewer_row_groups_for_a_plant_and_a_status(spark, scratch):
    table, plants, statuses = scratch("fact"), scratch("plants"), scratch("statuses")
    UP.write_partitions(_month(spark), table)
    size = {"parquet.block.row.count.limit": "960"}     # a day's rows, as in the table's files
    assert AC.refresh(spark, table, plants, AC.BY_PLANT, **size) == ["2025-02"]
    AC.refresh(spark, table, statuses, AC.BY_STATUS, **size)

    (by_day, _), (by_plant, every) = (_row_groups(p, "plant_name", "Plant 7") for p in (table, plants))
    assert every >= DAYS and by_day == DAYS and by_plant <= DAYS / 2
    (by_day, _), (by_status, _) = (_row_groups(p, "status", "Wilted") for p in (table, statuses))
    assert by_day == DAYS and by_status <= DAYS / 6

    # a span of time does not need every row group either
    spans = [file.metadata for file in _files(plants)]
    stats = [m.row_group(i).column(0).statistics for m in spans for i in range(m.num_row_groups)]
    day = dt.datetime(2025, 2, 20)
    assert sum(s.min <= day + dt.timedelta(days=1) and s.max >= day for s in stats) <= every / 2

    want = UP.read_table(spark, table)
    one = AC.of_plant(AC.read_layout(spark, plants, AC.BY_PLANT), "Plant 7", "2025-02-03 00:00:00", "2025-02-05 00:00:00")
    assert sorted(one.select(*K.TARGET_COLUMNS).collect()) == sorted(want.where(
        "plant_name = 'Plant 7' and timestamp >= '2025-02-03' and timestamp < '2025-02-05'").select(*K.TARGET_COLUMNS).collect())
    assert AC.read_layout(spark, statuses, AC.BY_STATUS).where("status = 'Wilted'").count() == want.where("status = 'Wilted'").count()
    plan = one._jdf.queryExecution().toString()
    assert "EqualTo(plant_name,Plant 7)" in plan and "PartitionFilters: [isnotnull(reading_month" in plan


def test_layout_follows_upserts(spark, grid, scratch):
    table, copy = scratch("fact"), scratch("layout")
    assert AC.refresh(spark, table, copy, AC.BY_STATUS) == []           # no table yet
    rows = CL.clean(grid(SAMPLE_ROWS), run_ts=RUN_TS)
    UP.upsert(spark, rows, table)
    assert AC.refresh(spark, table, copy, AC.BY_STATUS, []) == ["2025-04", "2025-05"]
    res = UP.upsert(spark, rows.where("status = 'Wilted'").withColumn("status", F.lit(None).cast("string")), table)
    assert AC.refresh(spark, table, copy, AC.BY_STATUS, res.touched_dates) == ["2025-05"]
    assert AC.refresh(spark, table, copy, AC.BY_STATUS, []) == []

    def state(df):
        return sorted((str(r.timestamp), r.plant_name, str(r.status)) for r in df.collect())
    assert state(AC.read_layout(spark, copy, AC.BY_STATUS)) == state(UP.read_table(spark, table))


def test_z_value(spark):
    got = spark.range(16).selectExpr("cast(id div 4 as int) a", "cast(id % 4 as int) b").selectExpr(
        "a", "b", f"{AC.z_value('a', 'b', 2)} z").collect()
    assert all(r.z == sum(((r.a >> i) & 1) << (2 * i + 1) | ((r.b >> i) & 1) << (2 * i) for i in range(2)) for r in got)
