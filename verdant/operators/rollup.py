"""Daily averages maintained from changes.

The rollup holds additive partials by (reading_date, plant): the count of readings, and
of each averaged column the sum of its unscaled values and how many are not NULL.
An upsert's effect on them is the partials of the rows it writes (*after* images)
less those of the rows it replaces (*before* images), so a value that changes, becomes
NULL or comes from NULL is taken back exactly, and only touched days are read
and written; no stored reading is aggregated again.

A change is computed from the table before its upsert and staged; each rollup row
keeps the id of the last change it took, so applying a change twice is harmless.  A
run is: ``stage_changes``, upsert, ``apply_changes``.  One writer at a time.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import contract as K
from ..plans.views import DAILY_AVERAGES
from ..session import drop_dir, fresh_dir, is_missing, path_exists
from .upsert import last_of_key, read_partitions, touched_dates

KEY = [K.PARTITION_COL, "plant_name"]
PARTS = ["readings", *[f"{c}_{p}" for c in DAILY_AVERAGES.values() for p in ("sum", "n")]]
SCHEMA = f"plant_name string, {', '.join(f'{p} long' for p in PARTS)}, change string, {K.PARTITION_COL} date"


def _parts(sign: Column) -> list[Column]:
    """Partials of rows that count ``sign`` (1 or -1) each."""
    out = [F.sum(sign).alias("readings")]
    for c in DAILY_AVERAGES.values():
        unscaled = (F.col(c) * 100).cast("long")
        out += [F.coalesce(F.sum(unscaled * sign), F.lit(0).cast("long")).alias(f"{c}_sum"),
                F.coalesce(F.sum(F.when(F.col(c).isNotNull(), sign)), F.lit(0).cast("long")).alias(f"{c}_n")]
    return out


def changes(source: DataFrame, before: DataFrame | None) -> DataFrame:
    """What an upsert of ``source`` into ``before`` (the stored rows of its days) does to the
    partials: one row per (date, plant), from one aggregate over both images."""
    cols = [K.PARTITION_COL, *K.KEY_COLS, *DAILY_AVERAGES.values()]
    after = last_of_key(source).select(*cols)
    images = after.withColumn("sign", F.lit(1).cast("long"))
    if before is not None:
        replaced = before.select(*cols).join(after.select(*K.KEY_COLS), K.KEY_COLS, "left_semi").select(*cols)
        images = images.unionByName(replaced.withColumn("sign", F.lit(-1).cast("long")))
    return images.groupBy(*KEY).agg(*_parts(F.col("sign")))


def stage_changes(spark: SparkSession, source: DataFrame, target_path: str,
                  dates: Sequence[dt.date] | None = None) -> str:
    """Compute and store the change that upserting ``source`` will make; returns its folder.
    Call it before the upsert."""
    dates = touched_dates(source) if dates is None else list(dates)
    path = fresh_dir(spark, "change")
    changes(source, read_partitions(spark, target_path, dates)).write.parquet(path)
    return path


def read_rollup(spark: SparkSession, path: str) -> DataFrame | None:
    if path_exists(spark, path) is False:
        return None
    try:
        return spark.read.schema(SCHEMA).parquet(path)
    except AnalysisException as e:
        if not is_missing(e):
            raise
        return None


def apply_changes(spark: SparkSession, change_path: str, rollup_path: str, keep: bool = False) -> None:
    """Add a staged change to the rollup; only the days it names are read and replaced.

    Days replace one after the other, so a crash may leave some done: applying the same
    change again skips those rows.  A plant without readings left on a day goes."""
    name = change_path.rstrip("/").rsplit("/", 1)[-1]
    change = spark.read.schema(", ".join(f"{p} long" for p in PARTS) + f", plant_name string, {K.PARTITION_COL} date"
                               ).parquet(change_path)
    dates = [r[0] for r in change.select(K.PARTITION_COL).distinct().collect()]  # one value a day
    stored = read_rollup(spark, rollup_path)
    if stored is None:
        merged = change.withColumn("change", F.lit(name))
    else:
        old = stored.where(F.col(K.PARTITION_COL).isin(dates)).select(
            *KEY, "change", F.struct(*PARTS).alias("o"))
        both = old.join(change.select(*KEY, F.struct(*PARTS).alias("c")), KEY, "full_outer")
        done = F.coalesce(F.col("change") == name, F.lit(False)) | F.col("c").isNull()
        zero = F.lit(0).cast("long")
        merged = both.select(*KEY, F.when(F.col("c").isNull(), F.col("change")).otherwise(F.lit(name)).alias("change"), *[
            (F.coalesce(F.col(f"o.{p}"), zero) + F.when(done, zero).otherwise(F.col(f"c.{p}"))).alias(p) for p in PARTS])
    # a row of no readings stays until the day is read (``daily_averages`` leaves it out):
    # its change id is what makes the repetition harmless
    copy = fresh_dir(spark, "rollup")
    try:
        merged.select(*PARTS, "plant_name", "change", K.PARTITION_COL).write.parquet(copy)
        (spark.read.schema(merged.select(*PARTS, "plant_name", "change", K.PARTITION_COL).schema).parquet(copy)
         .hint("rebalance", K.PARTITION_COL).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(K.PARTITION_COL).parquet(rollup_path))
    finally:
        drop_dir(spark, copy)
    if not keep:
        drop_dir(spark, change_path)


def daily_averages(rollup: DataFrame) -> DataFrame:
    """The daily view out of the partials: same columns and values as ``views.daily_averages``."""
    return rollup.where("readings > 0").select(
        K.PARTITION_COL, "plant_name", F.col("readings").alias("reading_count"),
        *[F.when(F.col(f"{c}_n") > 0, F.col(f"{c}_sum").cast("double") / (F.col(f"{c}_n") * 100).cast("double")).alias(out)
          for out, c in DAILY_AVERAGES.items()])
