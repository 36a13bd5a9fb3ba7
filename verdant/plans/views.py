"""Analytic views over the fact table, and access patterns.

All functions take the fact table as a DataFrame (``spark.read`` of the
partitioned Parquet table, or any frame of the same shape) and return a
lazy DataFrame; filters and projections reach the Parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import contract as K
from ..functions import exact_avg

# Averages published by the daily view: output name -> source column.
DAILY_AVERAGES = {
    "avg_confidence": "confidence_score_pct",
    "avg_moisture": "moisture_sensor",
    "avg_humidity": "humidity",
    "avg_temperature": "temperature",
    "avg_outside_temp": "outside_temperature",
    "avg_inside_temp": "inside_temperature",
}


def reading_date(df: DataFrame) -> F.Column:
    """The stored partition column when present (enables pruning), else derived."""
    return F.col(K.PARTITION_COL) if K.PARTITION_COL in df.columns else F.to_date("timestamp")


def latest_per_plant(fact: DataFrame, with_rank: bool = False) -> DataFrame:
    """Most recent reading of every plant.

    ``row_number() = 1`` is planned as WindowGroupLimit partial + final, so
    each map task forwards at most one row per plant to the shuffle.
    """
    w = Window.partitionBy("plant_name").orderBy(F.col("timestamp").desc())
    ranked = fact.withColumn("rn", F.row_number().over(w)).where("rn = 1")
    return ranked if with_rank else ranked.drop("rn")


def latest_per_plant_pruned(fact: DataFrame) -> DataFrame:
    """Latest reading per plant from a date-partitioned table, reading little.

    Phase 1 finds each plant's newest timestamp from two columns only
    (partial/final aggregate).  The distinct dates of those maxima (at most
    one value per day of data) select the partitions that phase 2 reads in
    full, and a semi-join keeps the matching rows.  Compared with the
    window over every column of every row, the full-width scan shrinks to
    the few most recent partitions.  Eager: the date list is computed when
    called, so build SQL views on the lazy ``latest_per_plant`` instead.
    """
    if K.PARTITION_COL not in fact.columns:
        return latest_per_plant(fact)
    maxes = fact.groupBy("plant_name").agg(F.max("timestamp").alias("timestamp"))
    days = [r.d for r in maxes.select(F.to_date("timestamp").alias("d")).distinct().collect()]
    recent = fact.where(F.col(K.PARTITION_COL).isin(days))
    return recent.join(maxes, ["plant_name", "timestamp"], "left_semi")


def daily_averages(fact: DataFrame) -> DataFrame:
    """Per (date, plant): reading count and six sensor averages."""
    return (fact.groupBy(reading_date(fact).alias("reading_date"), "plant_name")
            .agg(F.count(F.lit(1)).cast(T.LongType()).alias("reading_count"),
                 *[exact_avg(src).alias(out) for out, src in DAILY_AVERAGES.items()]))


def status_filter(fact: DataFrame, status: str = "Wilted") -> DataFrame:
    """Readings in one status, narrowed to the covering columns."""
    return (fact.where(F.col("status") == status)
            .select("timestamp", "plant_name", "status", "confidence_score_pct"))


def time_range_scan(fact: DataFrame, start: str, end: str) -> DataFrame:
    """Readings with start <= timestamp < end.

    The date bounds are stated next to the timestamp bounds so a
    date-partitioned table prunes whole partitions, and the timestamp
    predicates are pushed to the Parquet reader for row-group skipping.
    """
    lo = F.lit(start).cast(T.TimestampNTZType())
    hi = F.lit(end).cast(T.TimestampNTZType())
    cond = (F.col("timestamp") >= lo) & (F.col("timestamp") < hi)
    if K.PARTITION_COL in fact.columns:
        d = F.col(K.PARTITION_COL)
        cond = cond & (d >= F.to_date(lo)) & (d <= F.to_date(hi))
    return fact.where(cond)


def since(fact: DataFrame, watermark: str, overlap: str | None = None) -> DataFrame:
    """Readings newer than a high-water mark (incremental read of the table).

    The date bound is derived from the mark and stated beside the timestamp
    bound: partitions before the mark's date are pruned and the timestamp
    predicate is pushed to the Parquet reader.
    """
    wm = F.lit(watermark).cast(T.TimestampNTZType())
    if overlap:
        wm = wm - F.expr(f"INTERVAL {overlap}")
    cond = F.col("timestamp") > wm
    if K.PARTITION_COL in fact.columns:
        cond = cond & (F.col(K.PARTITION_COL) >= F.to_date(wm))
    return fact.where(cond)


def plant_history(fact: DataFrame, plant: str) -> DataFrame:
    """One plant's readings, newest first."""
    return fact.where(F.col("plant_name") == plant).orderBy(F.col("timestamp").desc())


def preview(fact: DataFrame, n: int = 3) -> DataFrame:
    """First n readings by key order (deterministic head)."""
    return fact.orderBy("timestamp", "plant_name").limit(n)
