"""A key, a plant, or a date holding a third of all rows."""
import datetime as dt

from pyspark.sql import functions as F

from conftest import RUN_TS
from verdant import contract as K
from verdant.operators import clean as CL
from verdant.operators import upsert as UP
from verdant.plans import views as V

N = 3000


def _rows(spark, hot_key: bool):
    """N rows; a third are copies of one key (hot_key) or readings of one plant."""
    base = spark.range(N).select(F.col("id").alias(K.ROW_NO))
    hot = F.col(K.ROW_NO) < N // 3
    minute = F.when(hot & F.lit(hot_key), F.lit(0)).otherwise(F.col(K.ROW_NO))
    ts = F.date_format(F.timestamp_seconds(F.lit(1704067200) + minute * 60), "yyyy-MM-dd HH:mm:ss")
    plant = F.when(hot, F.lit("Plant Hot")).otherwise(F.concat(F.lit("Plant "), F.col(K.ROW_NO) % 50))
    cells = {c: F.lit("1") for c in K.RAW_COLUMNS}
    cells.update({"Timestamp": ts, "Plant Name": plant, "Status": F.lit("healthy"),
                  "Moisture Sensor": F.col(K.ROW_NO).cast("string"), "Time": F.lit("00:00")})
    return base.select(K.ROW_NO, *[v.alias(k) for k, v in cells.items()])


def test_hot_duplicate_key_keeps_only_the_last(spark):
    raw = _rows(spark, hot_key=True)
    out = CL.clean(raw, run_ts=RUN_TS)
    hot = out.where("plant_name = 'Plant Hot'").collect()
    assert len(hot) == 1 and int(hot[0].moisture_sensor) == N // 3 - 1
    assert out.count() == N - N // 3 + 1
    reasons = {r.reject_reason: r["count"] for r in
               CL.rejects(raw).groupBy(K.REJECT_COL).count().collect()}
    assert reasons == {K.DUPLICATE: N // 3 - 1}


def test_hot_plant_latest_and_upsert(spark, scratch):
    raw = _rows(spark, hot_key=False)
    clean = CL.clean(raw, run_ts=RUN_TS)
    latest = {r.plant_name: r.timestamp for r in V.latest_per_plant(clean).collect()}
    assert latest["Plant Hot"] == dt.datetime(2024, 1, 1) + dt.timedelta(minutes=N // 3 - 1)
    path = scratch("fact")
    res = UP.upsert(spark, clean, path)
    assert res.rows_inserted == N
    again = UP.upsert(spark, clean.withColumn("status", F.lit("Wilted")), path)
    assert again.rows_updated == N and again.rows_inserted == 0
    t = UP.read_table(spark, path)
    assert t.count() == N and t.where("status = 'Wilted'").count() == N


def test_dedup_over_given_partitions(spark):
    """As many tasks as asked for, a hot key split by the source's tasks, the same rows."""
    raw = _rows(spark, hot_key=True).repartition(6, K.ROW_NO)
    t = CL.typed(raw)
    dealt = CL.dedup_keep_last(t, partitions=13)
    assert dealt.rdd.getNumPartitions() == 13
    p = dealt._jdf.queryExecution().executedPlan().toString()
    assert "_task" in p.split("hashpartitioning(")[2].split("REPARTITION")[0]
    assert sorted(dealt.collect()) == sorted(CL.dedup_keep_last(t).collect())
    assert dealt.count() == N - N // 3 + 1


def test_tasks_follow_the_bytes_of_the_files(spark, scratch, monkeypatch):
    from verdant.sources import grid as G

    path = scratch("grid")
    G.write_grid(_rows(spark, hot_key=False), path, K.RAW_COLUMNS)
    total = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).agg(F.sum("length")).first()[0]
    assert G.tasks_for(spark, path) == spark.sparkContext.defaultParallelism
    monkeypatch.setattr(G, "TASK_BYTES", total // 9)
    assert G.tasks_for(spark, path) >= 9
