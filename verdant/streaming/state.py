"""Streaming state: a typed feed with a watermark, event-time daily averages, keep-last.

Three streams, each with its own checkpoint:

* ``start_feed``: grid files -> typed rows.  A batch's unusable rows go to the
  rejects.  So do rows whose day the watermark has closed (``late_event``): the
  watermark is the newest timestamp of all earlier batches less ``delay``, kept in
  a log beside the feed, so late rows are stored and counted, where a stateful
  operator would drop them unseen.  All outputs of a batch lie in folders of its
  number, so a repeated batch replaces what it wrote.
* ``start_daily_windows``: feed -> daily averages, in Spark's state store and append
  mode: keep-last by (day, plant, timestamp), then one-day windows over that.  A day
  is written once, when the watermark passes its end; its state then goes.
* ``start_keep_last``: feed -> fact table.  The state holds the last row of each key by
  the source's ordinal, also when rows arrive out of order; a batch upserts the
  keys it has touched.  Keys older than the watermark leave the state.

The feed's watermark is never ahead of the one Spark keeps over the feed's rows, so
the stateful streams lose no row of it.  ``trigger(availableNow=True)`` runs each
to completion; a restart goes on from the checkpoints with the state as it was.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from .. import contract as K
from ..operators import clean as CL
from ..operators.upsert import upsert
from ..plans import pipeline as P
from ..plans.views import DAILY_AVERAGES
from ..session import configure, drop_dir, fresh_dir, path_exists
from .ingest import batch_rows, file_stream

BATCH = "batch"
_DATA = [c for c in K.TARGET_COLUMNS if c not in (*K.KEY_COLS, K.AUDIT_COL)]


def marks_path(feed_path: str) -> str:
    return feed_path.rstrip("/") + "__marks"


def feed_schema(ordinal: T.DataType) -> T.StructType:
    """Columns of the feed: the ordinal, the typed cells, and the number of the batch."""
    return T.StructType([T.StructField(K.ROW_NO, ordinal), *[K.TARGET_SCHEMA[c] for c in (*K.KEY_COLS, *_DATA)],
                         T.StructField(BATCH, T.LongType())])


def read_feed(spark: SparkSession, feed_path: str) -> DataFrame:
    return spark.read.parquet(feed_path)


def _newest_before(spark: SparkSession, feed_path: str, epoch: int):
    """The newest timestamp of the batches before ``epoch``, None without any."""
    path = marks_path(feed_path)
    if path_exists(spark, path) is False:
        return None
    log = spark.read.schema(f"newest timestamp_ntz, {BATCH} long").parquet(path)
    return log.where(F.col(BATCH) < epoch).agg(F.max("newest")).first()[0]


def day_end(ts: str = "timestamp") -> Column:
    return F.date_trunc("day", F.col(ts)).cast(T.TimestampNTZType()) + F.expr("INTERVAL 1 DAY")


def feed_batch(feed_path: str, rejects_path: str, names: Sequence[str], delay: str, ordinal: str | None,
               formats: Sequence[str], max_future: str | None, run_ts: str | None):
    def fn(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        configure(spark)
        raw = batch_rows(batch, names)
        if ordinal:
            raw = raw.withColumn(K.ROW_NO, F.col(f"`{ordinal}`").cast("long"))
        stage = fresh_dir(spark, "typed")
        try:
            rows = P.stage_at(CL.typed(CL.with_cells(raw), formats), stage, partition=False)
            newest = _newest_before(spark, feed_path, epoch)
            late = F.lit(False) if newest is None else (
                day_end() <= F.lit(str(newest)).cast(T.TimestampNTZType()) - F.expr(f"INTERVAL {delay}"))
            reason = F.coalesce(CL.base_reject_reason(max_future, run_ts), F.when(late, F.lit(K.LATE_EVENT)))
            rows = rows.withColumn(K.REJECT_COL, reason)
            seen = Observation("feed")
            good = rows.where(F.col(K.REJECT_COL).isNull()).select(K.ROW_NO, *K.KEY_COLS, *_DATA)
            (good.observe(seen, F.max("timestamp").alias("newest"), F.count(F.lit(1)).alias("n"))
             .write.mode("overwrite").parquet(f"{feed_path}/{BATCH}={epoch}"))
            rows.where(F.col(K.REJECT_COL).isNotNull()).write.mode("overwrite").parquet(f"{rejects_path}/{BATCH}={epoch}")
            mark = spark.createDataFrame([(seen.get["newest"],)], "newest timestamp_ntz")
            mark.coalesce(1).write.mode("overwrite").parquet(f"{marks_path(feed_path)}/{BATCH}={epoch}")
        finally:
            drop_dir(spark, stage)
    return fn


def start_feed(spark: SparkSession, source_dir: str, feed_path: str, rejects_path: str, delay: str,
               names: Sequence[str] | None = None, ordinal: str | None = None,
               formats: Sequence[str] = K.TIMESTAMP_FORMATS, max_future: str | None = None,
               max_files_per_trigger: int | None = None, run_ts: str | None = None,
               available_now: bool = True, processing_time: str = "30 minutes") -> StreamingQuery:
    """Grid files -> typed feed and rejects.  ``delay``: how long a day stays open for late rows.
    ``ordinal`` names a grid column that orders the rows (default: their files and places)."""
    configure(spark)
    fn = feed_batch(feed_path, rejects_path, list(names or K.RAW_COLUMNS), delay, ordinal, formats, max_future, run_ts)
    return _go(file_stream(spark, source_dir, max_files_per_trigger).writeStream.foreachBatch(fn),
               feed_path.rstrip("/") + "__stream", available_now, processing_time)


def _go(writer, checkpoint: str, available_now: bool, processing_time: str) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time)).start()


def _events(spark: SparkSession, feed_path: str, delay: str) -> DataFrame:
    """The feed as a stream with Spark's watermark (on an instant: the session is in UTC)."""
    schema = spark.read.parquet(feed_path).schema
    rows = spark.readStream.schema(schema).parquet(feed_path)
    return rows.withColumn("event_time", F.col("timestamp").cast("timestamp")).withWatermark("event_time", delay)


def daily_windows(events: DataFrame) -> DataFrame:
    """Daily averages of the last row of each key: two stateful operators, one after the other."""
    data = F.struct(*_DATA)
    last = (events.groupBy(F.window("event_time", "1 day"), "plant_name", "timestamp")
            .agg(F.max_by(data, K.ROW_NO).alias("r")).select("window", "plant_name", "r.*")
            .where(~CL.all_numeric_null()))
    sums = [x for out, c in DAILY_AVERAGES.items() for x in (
        F.sum((F.col(c) * 100).cast("long")).alias(f"{out}_sum"), F.count(c).alias(f"{out}_n"))]
    per_day = (last.groupBy(F.window(F.window_time("window"), "1 day").alias("day"), "plant_name")
               .agg(F.count(F.lit(1)).alias("reading_count"), *sums))
    averages = [F.when(F.col(f"{o}_n") > 0, F.col(f"{o}_sum").cast("double") / (F.col(f"{o}_n") * 100).cast("double")).alias(o)
                for o in DAILY_AVERAGES]
    return per_day.select(F.to_date("day.start").alias("reading_date"), "plant_name", "reading_count", *averages)


def start_daily_windows(spark: SparkSession, feed_path: str, out_path: str, delay: str,
                        available_now: bool = True, processing_time: str = "30 minutes") -> StreamingQuery:
    """Feed -> one row per closed day and plant, appended to ``out_path`` exactly once.

    ``delay`` must be the feed's or longer."""
    configure(spark)
    w = daily_windows(_events(spark, feed_path, delay)).writeStream.outputMode("append").format("parquet")
    return _go(w.option("path", out_path), out_path.rstrip("/") + "__stream", available_now, processing_time)


def start_keep_last(spark: SparkSession, feed_path: str, target_path: str, delay: str, run_ts: str | None = None,
                    available_now: bool = True, processing_time: str = "30 minutes") -> StreamingQuery:
    """Feed -> fact table: the last row of each key by ordinal, the touched keys of each batch upserted."""
    configure(spark)
    last = (_events(spark, feed_path, delay).groupBy("event_time", "timestamp", "plant_name")
            .agg(F.max_by(F.struct(*_DATA), K.ROW_NO).alias("r")).select("timestamp", "plant_name", "r.*"))

    def store(batch: DataFrame, epoch: int) -> None:
        session = batch.sparkSession
        configure(session)
        path = fresh_dir(session, f"touched-{uuid.uuid4().hex[:6]}")
        try:
            staged, n, dates = P.stage_with_dates(CL.add_metadata(batch, run_ts), path)
            if n:
                upsert(session, staged, target_path, dates)
        finally:
            drop_dir(session, path)

    return _go(last.writeStream.outputMode("update").foreachBatch(store), target_path.rstrip("/") + "__stream",
               available_now, processing_time)


def finish(query: StreamingQuery) -> StreamingQuery:
    """Wait for a run to completion; raises what the stream raised."""
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return query
