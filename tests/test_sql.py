"""Catalog tables from the contract, loaded by the pipeline, read with SQL."""
from conftest import RUN_TS, SAMPLE_ROWS
from verdant.plans import pipeline as P
from verdant.plans import sql as SQ


def test_tables_and_views_via_sql(spark, grid, scratch):
    fact, state, log = scratch("fact"), scratch("hwm"), scratch("log")
    SQ.create_tables(spark, fact, state, log)
    assert spark.sql(f"SELECT count(*) AS n FROM {SQ.FACT_TABLE}").first().n == 0
    P.run(spark, grid(SAMPLE_ROWS), fact, state, run_log_path=log, run_ts=RUN_TS)
    SQ.refresh(spark)
    assert spark.sql(f"SELECT count(*) AS n FROM {SQ.FACT_TABLE}").first().n == 3
    assert str(spark.sql(f"SELECT max(last_watermark) AS w FROM {SQ.STATE_TABLE}").first().w) \
        == "2025-05-05 16:04:32"
    statuses = sorted(r.status for r in spark.sql(f"SELECT status FROM {SQ.RUN_LOG_TABLE}").collect())
    assert statuses == ["RUNNING", "SUCCESS"]
    SQ.register_views(spark.table(SQ.FACT_TABLE))
    latest = {r.plant_name: r.status for r in spark.sql(f"SELECT * FROM {SQ.LATEST_VIEW}").collect()}
    assert latest == {"Plant 1": "Wilted", "Plant 2": "Séchée"}
    daily = spark.sql(f"SELECT * FROM {SQ.DAILY_VIEW} ORDER BY reading_date, plant_name").collect()
    assert [(r.plant_name, r.reading_count) for r in daily] == [("Plant 1", 1), ("Plant 2", 1), ("Plant 1", 1)]
    for t in (SQ.FACT_TABLE, SQ.STATE_TABLE, SQ.RUN_LOG_TABLE):
        spark.sql(f"DROP TABLE {t}")
