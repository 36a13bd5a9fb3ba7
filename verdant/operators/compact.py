"""Compaction, on request: many small files become few, with the same rows.

Frequent runs append a file each to the mark's log, the plants' marks and the
run log, and a day of many micro-batches may hold many files.  Spark's rebalance
packs the rows to the advisory partition size, so a large log stays many tasks.

* Logs are append-only and read as "the newest row", so the packed rows are
  appended first and the files they came from deleted after.  A crash in between
  leaves rows twice: every reader gives the same, and the next compaction packs
  equal rows into one.  Runs may go on appending meanwhile.
* Days of the fact table go the upsert's way: a whole copy beside the table, then
  the days are replaced; the next upsert or compaction finishes what a crash left.
  One writer at a time.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import contract as K
from ..session import delete_files, path_exists
from . import upsert as U


def compact_log(spark: SparkSession, path: str, schema: T.StructType) -> int:
    """Pack an append-only log (state, marks, run log); how many files went.

    Nothing at the path, or a single file: nothing is done."""
    if path_exists(spark, path) is False:
        return 0
    small = spark.read.schema(schema).parquet(path)
    files = small.inputFiles()
    if len(files) < 2:
        return 0
    # the listing above is fixed: what is appended from now on is neither read nor deleted
    small.distinct().hint("rebalance").write.mode("append").parquet(path)
    delete_files(spark, files)
    return len(files)


def files_per_day(table: DataFrame) -> DataFrame:
    """(reading_date, files): from the files' names alone, no column is read."""
    return table.groupBy(K.PARTITION_COL).agg(F.count_distinct("_metadata.file_path").alias("files"))


def compact_days(spark: SparkSession, target_path: str, at_least: int = 4) -> list[dt.date]:
    """Rewrite the fact table's days of ``at_least`` files or more; the days done."""
    U.finish_pending(spark, target_path)
    table = U.read_table(spark, target_path)
    if table is None:
        return []
    rows = files_per_day(table).where(F.col("files") >= at_least).collect()   # a row per day at most
    days = sorted(r[K.PARTITION_COL] for r in rows if r[K.PARTITION_COL] is not None)
    if not days:
        return []
    U.rewrite_days(spark, U.read_partitions(spark, target_path, days, unmapped=True), target_path)
    return days
