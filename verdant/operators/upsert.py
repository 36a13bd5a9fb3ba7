"""Keyed upsert (MERGE) into a date-partitioned Parquet table.

Plain Parquet has no MERGE, so the merge is a partition-scoped rewrite:

1. the source is cut to the last row of each key (a partial group limit
   before the exchange: a hot key costs a row per map task);
2. the dates the source touches (a list bounded by days, not rows) select
   the target partitions to rewrite -- partition pruning reads nothing else;
3. one full outer join on the key puts source rows over target rows; both
   sides hold a key once, so no key is hot in it;
4. the rows are rebalanced by date (AQE splits a large date and packs small
   ones) and sorted by key within the task for the table's layout;
5. the merged days are written beside the table first and then replace
   exactly the touched partitions (dynamic overwrite).  A crash while they
   are replaced loses nothing: the next upsert finds the complete copy and
   finishes it.  An incomplete copy is dropped.

Into an empty table there is nothing to merge or to lose: the deduplicated
source is written straight away, with no copy and no list of dates.
Cells under headers without a column (``unmapped``) belong to their row: a source row
replaces them with its own, rows that only move to a new file keep theirs.
Re-running with the same source gives the same table (idempotent); untouched
partitions are never read or rewritten.  One writer at a time.
"""

from __future__ import annotations

import datetime as dt
import logging
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from .. import contract as K
from ..session import drop_dir, is_missing, list_dirs, path_exists
from .clean import holds_unmapped, to_target

log = logging.getLogger(__name__)

_ORD, _RN = "_ord", "_rn"
_KEYS = [K.PARTITION_COL, "plant_name", "timestamp"]


@dataclass
class UpsertResult:
    rows_loaded: int          # source rows processed (the load contract)
    rows_inserted: int        # keys new to the table
    rows_updated: int         # keys that replaced a stored row
    max_timestamp: dt.datetime | None
    touched_dates: list[dt.date]   # empty for a first load (all of them)


def read_table(spark: SparkSession, path: str, unmapped: bool = False) -> DataFrame | None:
    """The fact table at ``path``, or None when it does not exist yet; with ``unmapped``
    also the column of cells that the contract does not name (NULL where none were kept)."""
    if path_exists(spark, path) is False:
        return None
    try:
        return spark.read.schema(K.STORED_SCHEMA if unmapped else K.TABLE_SCHEMA).parquet(path)
    except AnalysisException as e:
        if not is_missing(e):
            raise
        return None


def read_partitions(spark: SparkSession, path: str,
                    dates: Sequence[dt.date], unmapped: bool = False) -> DataFrame | None:
    """Only the given date partitions of the table (None if none exists yet).

    A brace glob over the partition folders means only those folders are
    listed; reading the table root would list every file of every date
    before pruning, which dominates small merges into a large table.
    """
    if not dates:
        return None
    glob = f"{path.rstrip('/')}/{K.PARTITION_COL}={{{','.join(str(d) for d in dates)}}}"
    if path_exists(spark, glob) is False:
        return None
    try:
        return (spark.read.option("basePath", path)
                .schema(K.STORED_SCHEMA if unmapped else K.TABLE_SCHEMA).parquet(glob))
    except AnalysisException as e:
        if not is_missing(e):
            raise
        return None


def empty_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], K.TABLE_SCHEMA)


def touched_dates(source: DataFrame) -> list[dt.date]:
    """Distinct reading dates of a batch: partial/final aggregate, one row per day."""
    rows = (source.select(F.to_date("timestamp").alias("d")).where("d is not null")
            .distinct().collect())
    return sorted(r.d for r in rows)


def last_of_key(source: DataFrame) -> DataFrame:
    """Source rows in table shape, the latest of each key (highest ``_row_no``)."""
    has_ord = K.ROW_NO in source.columns
    kept = [K.UNMAPPED_COL] if holds_unmapped(source) else []
    cols = [f"`{c}`" for c in (*K.TARGET_COLUMNS, *kept)]
    order = f"`{K.ROW_NO}`" if has_ord else "CAST(NULL AS BIGINT)"
    src = to_target(source, keep_row_no=has_ord).selectExpr(
        *cols, f"{order} AS {_ORD}", f"to_date(timestamp) AS {K.PARTITION_COL}")
    spec = f"PARTITION BY {', '.join(_KEYS)} ORDER BY {_ORD} DESC NULLS LAST"
    return (src.selectExpr("*", f"row_number() OVER ({spec}) AS {_RN}").where(f"{_RN} = 1")
            .select(*K.TARGET_COLUMNS, *kept, K.PARTITION_COL))


def merge_plan(target: DataFrame | None, source: DataFrame, dates: Sequence[dt.date] = (),
               observation: Observation | None = None) -> DataFrame:
    """Lazy merged rows for the touched partitions (see module doc)."""
    src = last_of_key(source)
    kept = [K.UNMAPPED_COL] if any(holds_unmapped(d) for d in (src, target) if d is not None) else []
    rest = [*[c for c in K.TARGET_COLUMNS if c not in _KEYS], *kept]

    def payload(df: DataFrame) -> list:
        return [F.col(c) if c in df.columns else F.lit(None).cast(T.VariantType()).alias(c) for c in rest]

    if target is None:
        merged = src.withColumn("_new", F.lit(True)).withColumn("_src", F.lit(True))
    else:
        days = F.col(K.PARTITION_COL).isin(list(dates))
        s = src.select(*_KEYS, F.struct(*payload(src)).alias("_s"))
        t = target.where(days).select(*_KEYS, F.struct(*payload(target)).alias("_t"))
        merged = s.join(t, _KEYS, "full_outer")
        won = F.col("_s").isNotNull()
        merged = merged.select(*_KEYS, F.coalesce("_s", "_t").alias("_r"), won.alias("_src"),
                               F.col("_t").isNull().alias("_new"))
        merged = merged.select(*_KEYS, "_src", "_new", *[F.col(f"_r.{c}").alias(c) for c in rest])
    if observation is not None:
        merged = merged.observe(
            observation,
            F.count_if(F.col("_src") & F.col("_new")).alias("rows_inserted"),
            F.count_if(F.col("_src") & ~F.col("_new")).alias("rows_updated"),
            F.max(F.when(F.col("_src"), F.col("timestamp"))).alias("max_timestamp"))
    return merged.select(*K.TARGET_COLUMNS, *kept, K.PARTITION_COL)


def write_partitions(df: DataFrame, path: str, whole: bool = False) -> None:
    """Replace only the partitions present in ``df`` (or the ``whole`` table, which
    marks its end with _SUCCESS); files are sorted by key."""
    (df.hint("rebalance", K.PARTITION_COL).sortWithinPartitions(*_KEYS)
     .write.mode("overwrite").option("partitionOverwriteMode", "static" if whole else "dynamic")
     .partitionBy(K.PARTITION_COL).parquet(path))


def pending_root(target_path: str) -> str:
    """Where merged days wait until they are in the table (beside it, same store)."""
    return target_path.rstrip("/") + "__pending"


def finish_pending(spark: SparkSession, target_path: str) -> int:
    """Complete what a crashed upsert left: whole copies go into the table, others go."""
    done = 0
    for path in list_dirs(spark, pending_root(target_path)):
        if path_exists(spark, f"{path}/_SUCCESS"):
            _replace(spark.read.schema(K.STORED_SCHEMA).parquet(path), target_path)
            done += 1
        drop_dir(spark, path)
    return done


def _replace(days: DataFrame, target_path: str) -> None:
    (days.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(K.PARTITION_COL).parquet(target_path))


def rewrite_days(spark: SparkSession, rows: DataFrame, target_path: str) -> None:
    """Replace the days of ``rows``, which may read them: a whole copy first, so a crash loses none."""
    copy = f"{pending_root(target_path)}/{uuid.uuid4().hex}"
    write_partitions(rows, copy, whole=True)
    _replace(spark.read.schema(K.STORED_SCHEMA).parquet(copy), target_path)
    drop_dir(spark, copy)


def upsert(spark: SparkSession, source: DataFrame, target_path: str,
           dates: Sequence[dt.date] | None = None) -> UpsertResult:
    """MERGE ``source`` (fact-table columns, optional ``_row_no``) into the table.

    ``dates``, when given, must list every reading date present in ``source``;
    each listed partition is rewritten from its stored rows plus the source
    rows of that date.
    """
    finish_pending(spark, target_path)
    seen, out = Observation("source"), Observation("upsert")
    observed = source.observe(seen, F.count(F.lit(1)).alias("n"))
    if read_table(spark, target_path) is None:
        write_partitions(merge_plan(None, observed, (), out), target_path)
    else:
        dates = touched_dates(source) if dates is None else list(dates)
        if not dates:
            log.info("nothing to merge")
            return UpsertResult(0, 0, 0, None, [])
        rewrite_days(spark, merge_plan(read_partitions(spark, target_path, dates, unmapped=True),
                                        observed, dates, out), target_path)
    m = out.get
    res = UpsertResult(int(seen.get["n"] or 0), int(m["rows_inserted"] or 0),
                       int(m["rows_updated"] or 0), m["max_timestamp"], list(dates or []))
    log.info("merged %d source rows: %d keys added, %d replaced",
             res.rows_loaded, res.rows_inserted, res.rows_updated)
    return res


def matched(source: DataFrame, target: DataFrame) -> DataFrame:
    """Source rows whose key is already stored (MERGE ... WHEN MATCHED)."""
    return source.join(target.select(*K.KEY_COLS), K.KEY_COLS, "left_semi")


def not_matched(source: DataFrame, target: DataFrame) -> DataFrame:
    """Source rows with a new key (MERGE ... WHEN NOT MATCHED)."""
    return source.join(target.select(*K.KEY_COLS), K.KEY_COLS, "left_anti")
