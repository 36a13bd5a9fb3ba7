"""Driver contract: entry smoke check, query/oracle registry, a DuckDB spot check."""
import os

import duckdb

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[:3] == ["reading_date", "plant_name", "reading_count"]


def test_every_query_has_an_oracle():
    from verdant.catalog import REGISTRY
    assert set(REGISTRY) <= set(E.oracle_sql()) <= set(E.queries())


def test_fast_queries_match_duckdb(spark):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    con.execute(f"create view events as select * from read_parquet('{os.path.join(SF, 'events.parquet')}')")
    for name in ["clean_readings", "daily_averages", "latest_per_plant", "rejects",
                 "health_distribution", "metric_kpis", "wilting_risk"]:
        sdf = E.queries()[name](spark, SF)
        got = sorted(tuple(str(v) for v in r) for r in sdf.select(sorted(sdf.columns)).collect())
        res = con.execute(E.oracle_sql()[name])
        cols = [d[0] for d in res.description]
        order = sorted(range(len(cols)), key=lambda i: cols[i])
        exp = sorted(tuple(str(r[i]) for i in order) for r in res.fetchall())
        assert got == exp, name
