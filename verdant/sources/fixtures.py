"""``raw_readings``: a dirty sensor grid derived from the ``events`` table.

Each event becomes one spreadsheet-like row of 15 text cells plus the
``_row_no`` ordinal.  Dirt is injected deterministically from the event id
(unparseable timestamps, padded/mixed-case names, 'n/a' and empty cells,
all-empty sensor rows), and a second, later copy of some events with status
'dead' makes keep-last deduplication observable.  The same rows are
produced by ``RAW_READINGS_SQL`` in DuckDB (the oracle side).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contract import ROW_NO
from ..operators.clean import pinned

# Copies of every event with event_id % COPY_MOD = 0 re-appear later in the grid.
# The ordinal of an event is twice its id, that of its copy one more: copies are
# later than their event, and no ordinal is used twice at any scale.
COPY_MOD = 29


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _cells(e: DataFrame) -> DataFrame:
    eid = F.col("event_id")
    blank = (eid % 71) == 0

    def num(expr: F.Column) -> F.Column:
        return F.when(blank, F.lit("")).otherwise(expr.cast("string"))

    ts_txt = F.when(eid % 101 == 0, F.lit("NOT A DATE")).otherwise(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    uid = F.col("user_id").cast("string")
    plant = (F.when(eid % 3 == 0, F.concat(F.lit("  plant-a "), uid))
             .when(eid % 3 == 1, F.concat(F.lit("PLANT-A "), uid, F.lit(" ")))
             .otherwise(F.concat(F.lit("Plant-A "), uid)))
    status = (F.when(F.col("event_type") == "error", F.lit("wilted"))
              .when(F.col("event_type") == "signup", F.lit(" WILTED "))
              .otherwise(F.lit("healthy")))
    conf = (F.when(((eid % 53) == 0) & ~blank, F.lit("n/a"))
            .when(blank, F.lit(""))
            .otherwise(F.least(F.col("value"), F.lit(100.0)).cast("string")))
    return e.select(
        (eid * 2).alias(ROW_NO),
        ts_txt.alias("Timestamp"),
        plant.alias("Plant Name"),
        status.alias("Status"),
        conf.alias("Confidence Score (%)"),
        num(F.col("value")).alias("Moisture Sensor"),
        num(eid * 7 % 100).alias("Humidity"),
        num(eid % 22).alias("Nitrogen"),
        num(F.lit(19)).alias("Phosphorus"),
        num(eid % 19).alias("Potassium"),
        num(eid * 3 % 40).alias("Temperature"),
        F.date_format("ts", "HH:mm").alias("Time"),
        num(eid % 15 + 15).alias("Outside Temperature"),
        num(eid % 40 + 50).alias("Outside Humidity"),
        num(eid % 17 + 17).alias("Inside Temperature"),
        F.when(((eid % 2) == 0) | blank, F.lit("")).otherwise(
            (eid % 45 + 45).cast("string")).alias("Inside Humidity"),
    )


def raw_readings(spark: SparkSession, sf_dir: str, tasks: int | None = None) -> DataFrame:
    """The dirty grid R (see module doc); reads only the columns it needs.

    ``tasks`` deals the events over so many tasks, which then make the grid's rows and run
    what the caller does with them, filters too."""
    e = read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    if tasks:
        e = e.repartition(tasks, "event_id")
    base = _cells(e)
    copies = (base.where((F.col(ROW_NO) % (2 * COPY_MOD)) == 0)
              .withColumn(ROW_NO, F.col(ROW_NO) + 1)
              .withColumn("Status", F.lit("dead")))
    grid = base.unionByName(copies)
    return pinned(grid) if tasks else grid


# DuckDB text of the same grid (oracle side).
RAW_READINGS_SQL = f"""
with base as (
  select 2 * event_id as _row_no,
       case when event_id%101=0 then 'NOT A DATE' else strftime(ts,'%Y-%m-%d %H:%M:%S') end as "Timestamp",
       case event_id%3 when 0 then '  plant-a '||user_id when 1 then 'PLANT-A '||user_id||' ' else 'Plant-A '||user_id end as "Plant Name",
       case when event_type='error' then 'wilted' when event_type='signup' then ' WILTED ' else 'healthy' end as "Status",
       case when event_id%53=0 and event_id%71<>0 then 'n/a' when event_id%71=0 then '' else cast(least(value,100.0) as varchar) end as "Confidence Score (%)",
       case when event_id%71=0 then '' else cast(value as varchar) end as "Moisture Sensor",
       case when event_id%71=0 then '' else cast(event_id*7%100 as varchar) end as "Humidity",
       case when event_id%71=0 then '' else cast(event_id%22 as varchar) end as "Nitrogen",
       case when event_id%71=0 then '' else cast(19 as varchar) end as "Phosphorus",
       case when event_id%71=0 then '' else cast(event_id%19 as varchar) end as "Potassium",
       case when event_id%71=0 then '' else cast(event_id*3%40 as varchar) end as "Temperature",
       strftime(ts,'%H:%M') as "Time",
       case when event_id%71=0 then '' else cast(event_id%15+15 as varchar) end as "Outside Temperature",
       case when event_id%71=0 then '' else cast(event_id%40+50 as varchar) end as "Outside Humidity",
       case when event_id%71=0 then '' else cast(event_id%17+17 as varchar) end as "Inside Temperature",
       case when event_id%2=0 or event_id%71=0 then '' else cast(event_id%45+45 as varchar) end as "Inside Humidity"
  from events)
select * from base
union all
select * replace (_row_no + 1 as _row_no, 'dead' as "Status")
from base where _row_no % {2 * COPY_MOD} = 0
"""
