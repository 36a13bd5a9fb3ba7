"""Physical-plan shape: the properties the design relies on at scale."""
import re

from verdant.operators import clean as CL
from verdant.operators import upsert as UP
from verdant.plans import metrics as M
from verdant.plans import views as V
from verdant.sources.fixtures import raw_readings
from verdant import contract as K

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_dedup_limits_rows_before_the_shuffle(spark):
    p = plan(CL.clean(raw_readings(spark, SF), run_ts="2025-05-01 10:00:00"))
    assert "WindowGroupLimit" in p and "Partial" in p and "Final" in p


def test_latest_per_plant_partial_limit(spark):
    c = CL.clean(raw_readings(spark, SF), run_ts="2025-05-01 10:00:00")
    p = plan(V.latest_per_plant(c))
    assert p.count("WindowGroupLimit") >= 2


def test_daily_averages_partial_aggregate(spark):
    c = CL.clean(raw_readings(spark, SF), run_ts="2025-05-01 10:00:00")
    p = plan(V.daily_averages(c))
    assert "partial_sum" in p and "partial_count" in p


def test_stored_table_prunes_and_pushes(spark, scratch):
    path = scratch("fact")
    c = CL.clean(raw_readings(spark, SF), run_ts="2025-05-01 10:00:00")
    UP.upsert(spark, c, path)
    fact = UP.read_table(spark, path)
    scan = plan(V.time_range_scan(fact, "2024-01-10 06:00:00", "2024-01-12 18:00:00"))
    assert "PartitionFilters: [isnotnull(reading_date" in scan
    assert "PushedFilters: [IsNotNull(timestamp), GreaterThanOrEqual(timestamp" in scan
    inc = plan(V.since(fact, "2024-01-15 00:00:00"))
    assert "PartitionFilters: [isnotnull(reading_date" in inc and "GreaterThanOrEqual(reading_date" not in inc.split("PushedFilters")[1][:40]
    assert "PushedFilters: [IsNotNull(timestamp), GreaterThan(timestamp" in inc
    assert V.since(fact, "2024-01-15 00:00:00").count() == 493            # FIXTURES.md §4
    daily = plan(V.daily_averages(fact))
    assert "ReadSchema: struct<plant_name:string,confidence_score_pct" in daily
    assert "status" not in daily.split("ReadSchema:")[1].split(">")[0]


def test_parse_stays_above_the_spread(spark):
    # The validity flag must not drag the parse expression below the window.
    p = optimized(CL.clean(raw_readings(spark, SF), run_ts="2025-05-01 10:00:00"))
    window_at = p.index("Window [")
    assert "gettimestamp" not in p[window_at:].split("Project")[0]


def test_health_share_reuses_the_status_shuffle(spark):
    c = CL.clean(raw_readings(spark, SF), run_ts="2025-05-01 10:00:00")
    df = M.health_distribution(c)
    df.collect()
    p = plan(df)
    assert "Subquery" in p and "ReusedExchange" in p


def test_pruned_latest_equals_window_and_prunes(spark, scratch):
    path = scratch("fact")
    UP.upsert(spark, CL.clean(raw_readings(spark, SF), run_ts="2025-05-01 10:00:00"), path)
    fact = UP.read_table(spark, path)
    cols = fact.columns
    pruned = V.latest_per_plant_pruned(fact).select(*cols)
    assert sorted(pruned.collect()) == sorted(V.latest_per_plant(fact).select(*cols).collect())
    p = plan(pruned)
    assert re.search(r"PartitionFilters: \[[^\]]*reading_date#\d+ IN \(", p)
    assert "ReadSchema: struct<timestamp:timestamp_ntz,plant_name:string>" in p


def test_a_hot_key_is_cut_before_the_upserts_exchange(spark, scratch):
    path = scratch("fact")
    c = CL.clean(raw_readings(spark, SF), run_ts="2025-05-01 10:00:00", keep_row_no=True)
    UP.upsert(spark, c, path)
    days = UP.touched_dates(c)
    p = plan(UP.merge_plan(UP.read_partitions(spark, path, days), c, days))
    assert "WindowGroupLimit" in p and "Partial" in p and "FullOuter" in p
    assert "rangepartitioning" not in p and p.count("FileScan parquet") <= 3


def test_rows_of_a_repeated_key_meet_it_in_parts(spark):
    """Half of the rows are of one key: their join is dealt over SALTS parts, other keys are not joined."""
    from pyspark.sql import functions as F
    rows = spark.range(4000).select(
        F.col("id").alias(K.ROW_NO), F.lit("2025-04-15 02:28:40").alias("Timestamp"),
        F.when(F.col("id") < 2000, F.lit("Hot")).otherwise(F.concat(F.lit("Plant "), F.col("id"))).alias("Plant Name"),
        F.lit("Healthy").alias("Status"), *[F.lit("1").alias(c) for c in K.RAW_COLUMNS[3:]])
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        r = CL.rejects(rows)
        p = plan(r)
        assert re.search(r"hashpartitioning\(timestamp#\d+, plant_name#\d+, _part#", p)
        got = r.collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len(got) == 1999 and {x.reject_reason for x in got} == {K.DUPLICATE}
    assert {x[K.ROW_NO] for x in got} == set(range(1999))


def test_counts_need_no_join(spark):
    assert "Join" not in plan(CL.stage_counts(raw_readings(spark, SF)))


def test_only_files_changed_since_are_opened(spark, scratch):
    import os
    import time
    from verdant.sources import grid as G
    path = scratch("grid")
    G.write_grid(raw_readings(spark, SF).limit(5), f"{path}/one", K.RAW_COLUMNS)
    seen = max(f.modified for f in G.list_files(spark, path))
    time.sleep(1.1)
    G.write_grid(raw_readings(spark, SF).limit(3), f"{path}/two", K.RAW_COLUMNS)
    new = G.read_grid(spark, path, modified_after=seen)
    assert new.count() == 3 and all("/two/" in f for f in new.inputFiles())
    assert G.read_grid(spark, path).count() == 8 and os.sep in path


def test_scratch_needs_a_shared_folder_unless_local(monkeypatch):
    import pytest
    from verdant import session as S

    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(ValueError):
        S.scratch_root(Session())


def test_filters_by_time_run_in_the_dealt_tasks(spark):
    """A filter that parses the time stays above the shuffle that deals the rows over tasks."""
    import datetime as dt

    from verdant import catalog as C
    from verdant.plans import pipeline as P

    sheet = C._sheet(spark, SF).where(C._until(C.CUTOFFS[0]))
    typed = P.extract_typed(CL.typed(raw_readings(spark, SF), parse_partitions=4), dt.datetime(2024, 1, 10))
    for df in (sheet, typed):
        above, *below = re.split(r"\bExchange\b", plan(df))
        assert below and "gettimestamp" in above
        assert not any("gettimestamp" in part for part in below)
    ts = C.parse_timestamp("Timestamp")
    plain = raw_readings(spark, SF)
    kept = plain.where(ts.isNull() | (ts <= C._ts_col(C.CUTOFFS[0])))
    assert sorted(sheet.collect()) == sorted(kept.collect())


def test_sheet_is_dealt_by_its_events(spark, monkeypatch):
    from verdant import catalog as C

    monkeypatch.setattr(C, "TASK_EVENTS", 100)
    assert C._sheet(spark, SF).rdd.getNumPartitions() == 20      # 1,000 events, and as many tasks of copies


def test_parse_has_no_method_that_the_jvm_leaves_uncompiled(spark):
    from verdant.session import configure

    assert configure(spark).conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"
