"""Dashboard figures as plain aggregates over the fact table.

Every metric is a partial/final hash aggregate (map-side combine), so a
plant or status holding a large share of rows costs no more than any
other.  Averages use ``exact_avg`` (see ``functions.stats``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import exact_avg, ratio
from .views import reading_date

WILTED: Sequence[str] = ("Wilted",)
# Wilting-risk buckets: wilted share (%) below LOW -> 'low', below HIGH -> 'medium'.
RISK_LOW, RISK_HIGH = 10.0, 30.0


def _wilted(statuses: Sequence[str] = WILTED) -> Column:
    return F.col("status").isin(list(statuses))


def _count() -> Column:
    return F.count(F.lit(1)).cast(T.LongType())


def kpis(fact: DataFrame, wilted: Sequence[str] = WILTED) -> DataFrame:
    """One row: totals, averages, differences and wilted share."""
    n = F.count(F.lit(1))
    return fact.agg(
        _count().alias("total_readings"),
        exact_avg("moisture_sensor").alias("avg_moisture"),
        exact_avg("confidence_score_pct").alias("avg_confidence"),
        (exact_avg("inside_humidity") - exact_avg("outside_humidity")).alias("humidity_diff"),
        (exact_avg("inside_temperature") - exact_avg("outside_temperature"))
        .alias("temperature_diff"),
        ratio(F.count_if(_wilted(wilted)), n, 100.0).alias("wilted_pct"),
    )


def humidity_diff(fact: DataFrame) -> DataFrame:
    return fact.agg(exact_avg("inside_humidity").alias("avg_inside_humidity"),
                    exact_avg("outside_humidity").alias("avg_outside_humidity"),
                    (exact_avg("inside_humidity") - exact_avg("outside_humidity"))
                    .alias("humidity_diff"))


def temperature_diff(fact: DataFrame) -> DataFrame:
    return fact.agg(exact_avg("inside_temperature").alias("avg_inside_temperature"),
                    exact_avg("outside_temperature").alias("avg_outside_temperature"),
                    (exact_avg("inside_temperature") - exact_avg("outside_temperature"))
                    .alias("temperature_diff"))


def wilted_pct(fact: DataFrame, wilted: Sequence[str] = WILTED) -> DataFrame:
    return fact.agg(_count().alias("total_readings"),
                    F.count_if(_wilted(wilted)).cast(T.LongType()).alias("wilted_readings"),
                    ratio(F.count_if(_wilted(wilted)), F.count(F.lit(1)), 100.0)
                    .alias("wilted_pct"))


def confidence_trend(fact: DataFrame, by_plant: bool = False) -> DataFrame:
    keys = [reading_date(fact).alias("reading_date")] + (["plant_name"] if by_plant else [])
    return fact.groupBy(*keys).agg(_count().alias("reading_count"),
                                   exact_avg("confidence_score_pct").alias("avg_confidence"))


def health_distribution(fact: DataFrame) -> DataFrame:
    """Count and percentage share per status.

    The denominator is a scalar subquery over the per-status counts.  Spark
    reuses the per-status shuffle for it (ReusedExchange), so the readings
    are aggregated once, and the total is a two-phase global sum: no task
    ever holds more than one partial row per upstream task, however many
    distinct status texts the data carries.
    """
    per = fact.groupBy("status").agg(_count().alias("reading_count"))
    total = per.agg(F.sum("reading_count")).scalar()
    return per.withColumn("share_pct", ratio(F.col("reading_count"), total, 100.0))


def wilting_risk(fact: DataFrame, wilted: Sequence[str] = WILTED,
                 low: float = RISK_LOW, high: float = RISK_HIGH) -> DataFrame:
    """Wilted share per plant, bucketed low / medium / high."""
    per = fact.groupBy("plant_name").agg(
        _count().alias("reading_count"),
        F.count_if(_wilted(wilted)).cast(T.LongType()).alias("wilted_count"))
    pct = ratio(F.col("wilted_count"), F.col("reading_count"), 100.0)
    level = (F.when(F.col("wilted_pct") < low, "low")
             .when(F.col("wilted_pct") < high, "medium").otherwise("high"))
    return per.withColumn("wilted_pct", pct).withColumn("risk_level", level)


def environment_daily(fact: DataFrame) -> DataFrame:
    """Per day: inside vs outside temperature and humidity."""
    return fact.groupBy(reading_date(fact).alias("reading_date")).agg(
        exact_avg("inside_temperature").alias("avg_inside_temp"),
        exact_avg("outside_temperature").alias("avg_outside_temp"),
        exact_avg("inside_humidity").alias("avg_inside_humidity"),
        exact_avg("outside_humidity").alias("avg_outside_humidity"),
        (exact_avg("inside_temperature") - exact_avg("outside_temperature"))
        .alias("temperature_diff"),
        (exact_avg("inside_humidity") - exact_avg("outside_humidity")).alias("humidity_diff"),
    )
