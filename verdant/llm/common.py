"""Helpers shared by the operators of this package."""

from __future__ import annotations

import weakref

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from verdant.session import drop_dir, fresh_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# Arrow batches that go to Python hold at most so many rows and bytes, so a
# run of very long texts can't fill a worker's memory.
BATCH_ROWS = 8192
BATCH_BYTES = 4 << 20


def small_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches of the Python stages that follow."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_FOLDERS: weakref.WeakKeyDictionary = weakref.WeakKeyDictionary()


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: cuts lineage,
    and what lost executors had computed is still there.  The shuffle files of the
    write go with its end, not when the driver happens to collect its garbage."""
    spark = df.sparkSession
    path = fresh_dir(spark, name)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    _FOLDERS[out] = path
    return out


def forget(*frames: DataFrame) -> None:
    """Delete the folders of ``stored`` frames that nothing reads any more."""
    for df in frames:
        path = _FOLDERS.pop(df, None)
        if path:
            drop_dir(df.sparkSession, path)


def ascii_lower(c: Column) -> Column:
    """A-Z to lower case, every other character as it is (null: empty)."""
    c = F.coalesce(c, F.lit(""))
    return F.when(F.length(c) == F.octet_length(c), F.lower(c)).otherwise(
        F.translate(c, UPPER, UPPER.lower()))


def fold_bucket(doc_id: Column, mod: int) -> Column:
    """crc32 of the id's text, modulo ``mod`` (null id: bucket of the empty text)."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(mod))


def text_key(df: DataFrame, id_col: str, text_col: str) -> Column:
    """Identity of a document row: its id and its text's hash.  Rows that agree
    in both are one document to the operators."""
    return F.struct(df[id_col].alias("id"), F.xxhash64(df[text_col]).alias("h"))
