"""Stored high-water mark (HWM) per pipeline.

The state table is an append-only Parquet log of (pipeline_name,
last_watermark, updated_at); the current mark is the newest row of a
pipeline.  Appending never rewrites a file that a concurrent reader may be
using, a failed append leaves the previous mark in force, and the history
of marks is kept for audit.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from .. import contract as K
from ..session import is_missing, path_exists


def state_log(spark: SparkSession, state_path: str) -> DataFrame:
    if path_exists(spark, state_path) is False:
        return spark.createDataFrame([], K.STATE_SCHEMA)
    try:
        return spark.read.schema(K.STATE_SCHEMA).parquet(state_path)
    except AnalysisException as e:
        if not is_missing(e):
            raise
        return spark.createDataFrame([], K.STATE_SCHEMA)


def current_state(spark: SparkSession, state_path: str) -> DataFrame:
    """One row per pipeline: its newest mark (the MERGE-by-name view)."""
    w = Window.partitionBy("pipeline_name").orderBy(
        F.col("updated_at").desc(), F.col("last_watermark").desc())
    return (state_log(spark, state_path).withColumn("_rn", F.row_number().over(w))
            .where("_rn = 1").drop("_rn"))


def latest(spark: SparkSession, state_path: str,
           pipeline: str = K.PIPELINE_NAME) -> DataFrame:
    """TOP 1 last_watermark for the pipeline, newest update first."""
    return (state_log(spark, state_path).where(F.col("pipeline_name") == pipeline)
            .orderBy(F.col("updated_at").desc(), F.col("last_watermark").desc())
            .limit(1).select("pipeline_name", "last_watermark"))


def read_hwm(spark: SparkSession, state_path: str,
             pipeline: str = K.PIPELINE_NAME) -> dt.datetime | None:
    """The pipeline's mark, or None on the first run."""
    row = latest(spark, state_path, pipeline).first()
    return row.last_watermark if row else None


def update_hwm(spark: SparkSession, state_path: str, watermark: dt.datetime,
               pipeline: str = K.PIPELINE_NAME,
               updated_at: dt.datetime | None = None) -> None:
    """Record a new mark (call only after the fact-table write committed)."""
    now = updated_at or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None, microsecond=0)
    row = spark.createDataFrame([(pipeline, watermark, now)], K.STATE_SCHEMA)
    row.coalesce(1).write.mode("append").parquet(state_path)


def since_filter(watermark: dt.datetime | str | None, overlap: str | None = None):
    """Predicate for rows newer than the mark (strictly greater).

    ``overlap`` (an interval such as ``'1 hour'``) re-reads a tail before the
    mark to pick up late rows; the keyed upsert makes that re-read harmless.
    Rows whose timestamp did not parse are kept so they reach the rejects.
    """
    if watermark is None:
        return None
    wm = F.lit(str(watermark)).cast(T.TimestampNTZType())
    if overlap:
        wm = wm - F.expr(f"INTERVAL {overlap}")
    # One reference to the timestamp: when Catalyst pushes this predicate
    # towards the scan it inlines the parse expression, so a second
    # reference (``ts IS NULL OR ts > wm``) would parse every cell twice.
    return F.coalesce(F.col("timestamp") > wm, F.lit(True))


# -- a mark per plant ------------------------------------------------------------

def marks_log(spark: SparkSession, marks_path: str) -> DataFrame:
    """Every mark of every plant that was ever recorded (append-only, as the single mark's log)."""
    none = spark.createDataFrame([], K.MARKS_SCHEMA)
    if path_exists(spark, marks_path) is False:
        return none
    try:
        return spark.read.schema(K.MARKS_SCHEMA).parquet(marks_path)
    except AnalysisException as e:
        if not is_missing(e):
            raise
        return none


def current_marks(spark: SparkSession, marks_path: str, pipeline: str = K.PIPELINE_NAME) -> DataFrame:
    """(plant_name, last_watermark): the vector of marks.  Marks never move back, so the
    greatest is the current one: a two-phase maximum, whatever the log's length."""
    return (marks_log(spark, marks_path).where(F.col("pipeline_name") == pipeline)
            .groupBy("plant_name").agg(F.max("last_watermark").alias("last_watermark")))


def newer_than_marks(t: DataFrame, marks: DataFrame, overlap: str | None = None) -> DataFrame:
    """Typed rows newer than their own plant's mark; rows of plants without one, and rows
    without a plant or a timestamp (they go to the rejects), are kept.

    The vector meets the batch in a join by plant: Spark broadcasts it while it is small
    and splits a hot plant's side where it is not."""
    mark = F.col("_mark") - F.expr(f"INTERVAL {overlap}") if overlap else F.col("_mark")
    joined = t.join(marks.select("plant_name", F.col("last_watermark").alias("_mark")), "plant_name", "left")
    return joined.where(F.coalesce(F.col("timestamp") > mark, F.lit(True))).select(*t.columns)


def update_marks(spark: SparkSession, marks_path: str, clean: DataFrame, pipeline: str = K.PIPELINE_NAME,
                 updated_at: dt.datetime | None = None) -> None:
    """Record the newest timestamp of each plant of a clean batch (after its rows are stored)."""
    now = updated_at or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None, microsecond=0)
    newest = clean.groupBy("plant_name").agg(F.max("timestamp").alias("last_watermark"))
    (newest.select(F.lit(pipeline).alias("pipeline_name"), "plant_name", "last_watermark",
                   F.lit(now).cast(T.TimestampNTZType()).alias("updated_at"))
     .write.mode("append").parquet(marks_path))
