"""Compaction, layouts by vote, column defaults."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import RUN_TS, SAMPLE_ROWS
from verdant import contract as K
from verdant.functions import parse_timestamp
from verdant.operators import clean as CL
from verdant.operators import compact as CP
from verdant.operators import hwm as H
from verdant.operators import layouts as LY
from verdant.operators import upsert as UP
from verdant.plans import pipeline as P
from verdant.plans import sql as SQ
from verdant.sources.grid import read_grid


def _marks(spark, path, n):
    """A log of ``n`` runs, a file each."""
    rows = spark.range(n).select(F.lit("p").alias("pipeline_name"), F.expr(
        "timestamp_ntz'2025-01-01' + make_interval(0, 0, 0, int(id))").alias("last_watermark"), F.expr(
        "timestamp_ntz'2025-01-01' + make_interval(0, 0, 0, int(id))").alias("updated_at"), "id")
    rows.repartitionByRange(n, "id").drop("id").write.mode("append").parquet(path)


def test_two_hundred_runs_become_few_files(spark, scratch):
    path = scratch("hwm")
    _marks(spark, path, 200)
    before = sorted(map(tuple, H.state_log(spark, path).collect()))
    assert len(H.state_log(spark, path).inputFiles()) == 200 == len(before)
    assert CP.compact_log(spark, path, K.STATE_SCHEMA) == 200
    assert len(H.state_log(spark, path).inputFiles()) < 10
    assert sorted(map(tuple, H.state_log(spark, path).collect())) == before
    H.update_hwm(spark, path, dt.datetime(2026, 1, 1), "p")
    assert H.read_hwm(spark, path, "p") == dt.datetime(2026, 1, 1)


def test_crash_between_append_and_delete(spark, scratch, monkeypatch):
    path = scratch("hwm")
    _marks(spark, path, 5)

    def dies(*_):
        raise RuntimeError("gone")
    with monkeypatch.context() as m:
        m.setattr(CP, "delete_files", dies)
        with pytest.raises(RuntimeError):
            CP.compact_log(spark, path, K.STATE_SCHEMA)
    assert H.read_hwm(spark, path, "p") == dt.datetime(2025, 1, 5) and H.current_state(spark, path).count() == 1
    CP.compact_log(spark, path, K.STATE_SCHEMA)
    assert H.state_log(spark, path).count() == 5


def test_nothing_to_pack(spark, scratch):
    path = scratch("hwm")
    assert CP.compact_log(spark, path, K.STATE_SCHEMA) == 0 and CP.compact_days(spark, path) == []
    H.update_hwm(spark, path, dt.datetime(2026, 1, 1))
    assert CP.compact_log(spark, path, K.STATE_SCHEMA) == 0


def test_days_of_many_files(spark, grid, scratch, monkeypatch):
    path = scratch("fact")
    rows = CL.with_partition(CL.clean(grid(SAMPLE_ROWS), run_ts=RUN_TS))
    rows.repartitionByRange(3, "plant_name", "timestamp").write.partitionBy(K.PARTITION_COL).parquet(path)
    before = sorted(map(str, UP.read_table(spark, path).collect()))
    files = {str(r[0]): r[1] for r in CP.files_per_day(UP.read_table(spark, path)).collect()}
    assert files == {"2025-04-15": 2, "2025-05-05": 1}

    def dies(*_):
        raise RuntimeError("gone")
    with monkeypatch.context() as m:
        m.setattr(UP, "_replace", dies)
        with pytest.raises(RuntimeError):
            CP.compact_days(spark, path, at_least=2)
    # the whole copy that the crash left is put in place by the next one
    assert CP.compact_days(spark, path, at_least=2) == []
    assert {r.files for r in CP.files_per_day(UP.read_table(spark, path)).collect()} == {1}
    assert sorted(map(str, UP.read_table(spark, path).collect())) == before


def _settled(spark, rows):
    df = spark.createDataFrame(rows, "src string, `Timestamp` string, layouts int")
    out = LY.settle(df, F.col("src"))
    assert out.columns == df.columns
    return {(r.src, r.raw): r.t and str(r.t) for r in out.withColumn("raw", F.col("layouts")).select(
        "src", "raw", parse_timestamp("Timestamp", [K.ISO]).alias("t")).collect()}


def test_each_source_reads_its_own_order(spark):
    got = _settled(spark, [
        ("a", "03/04/2025 10:00", 1), ("a", " 25/04/2025 10:00 ", 2), ("a", "junk", 3), ("a", None, 4), ("a", "", 5),
        ("b", "03/04/2025 10:00", 1), ("b", "04/25/2025 10:00", 2), ("b", "2025-04-03 09:00:00", 3),
        ("tie", "03/04/2025", 1), ("tie", "05/05/2025", 2), (None, "13/01/2025", 1), (None, "02/01/2025", 2),
        ("mixed", "13/01/2025", 1), ("mixed", "01/13/2025", 2), ("none", "junk", 1)])
    assert got["a", 1] == "2025-04-03 10:00:00" and got["a", 2] == "2025-04-25 10:00:00"
    assert got["b", 1] == "2025-03-04 10:00:00" and got["b", 3] == "2025-04-03 09:00:00"
    assert got["tie", 1] is None and got["tie", 2] == "2025-05-05 00:00:00"
    assert got[None, 2] == "2025-01-02 00:00:00"
    assert got["mixed", 1] is got["mixed", 2] is got["none", 1] is got["a", 3] is got["a", 4] is got["a", 5] is None


def test_votes_of_an_empty_grid(spark):
    df = spark.createDataFrame([], "src string, `Timestamp` string")
    assert LY.votes(df, F.col("Timestamp"), F.col("src")).count() == 0 == LY.settle(df, F.col("src")).count()


def test_files_of_opposite_order_in_one_run(spark, scratch):
    import os
    landing = scratch("landing").replace("file:", "")
    os.makedirs(landing)
    for name, first, second in (("a", "03/04/2025 10:00", "25/04/2025 10:00"), ("b", "03/04/2025 10:00", "04/25/2025 11:00")):
        with open(f"{landing}/{name}.csv", "w") as f:
            f.write("Timestamp,Plant Name,Humidity\n" + f"{first},plant {name},1\n{second},plant {name},2\n")
    raw = read_grid(spark, landing)
    fact, rejects = scratch("fact"), scratch("rejects")
    P.run(spark, LY.settle(raw, LY.file_of(raw)), fact, scratch("hwm"), rejects_path=rejects, formats=[K.ISO], run_ts=RUN_TS)
    got = sorted((r.plant_name, str(r.timestamp)) for r in UP.read_table(spark, fact).collect())
    assert got == [("Plant A", "2025-04-03 10:00:00"), ("Plant A", "2025-04-25 10:00:00"),
                   ("Plant B", "2025-03-04 10:00:00"), ("Plant B", "2025-04-25 11:00:00")]


def test_insert_without_the_audit_column(spark, scratch):
    path = scratch("state")
    spark.sql(SQ.ddl("marks_with_default", K.STATE_SCHEMA, path))
    spark.sql("INSERT INTO marks_with_default (pipeline_name, last_watermark) VALUES ('p', timestamp_ntz'2025-01-01')")
    r = spark.table("marks_with_default").first()
    assert r.updated_at is not None and r.updated_at.microsecond == 0
    assert H.read_hwm(spark, path, "p") == dt.datetime(2025, 1, 1)
    spark.sql("DROP TABLE marks_with_default")
