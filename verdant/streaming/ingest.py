"""File-stream ingestion with Structured Streaming.

New grid files landing in a folder are picked up by the file source, which only
lists them; each micro-batch reads their rows once, mapped by the header of each
of its files, typed, split into
rejects and clean rows (keep-last inside the batch) and upserted into the
fact table inside ``foreachBatch``, as a batch run does, with the same rejects
and run log.  The upsert is keyed and replaces whole partitions, so replaying a
batch after a failure writes the same table (exactly-once results on an
at-least-once sink); rejects that a replayed batch has stored already are not
stored again.  A later batch overrides earlier rows of the same key.  The
stream's checkpoint (which files were consumed) lies beside the table unless
it is named, so the next start goes on where this one ended;
``trigger(availableNow=True)`` gives the scheduled micro-batch run: consume
everything new, then stop.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from .. import contract as K
from ..operators import clean as CL
from ..operators import hwm as H
from ..plans import pipeline as P
from ..session import configure, drop_dir, fresh_dir
from ..sources.grid import GridFile, empty_grid, read_files, with_headers


def file_stream(spark: SparkSession, source_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """The stream of new files (path, modificationTime, length); their content is not read here."""
    r = (spark.readStream.format("binaryFile").option("recursiveFileLookup", "true")
         .schema("path string, modificationTime timestamp, length long, content binary"))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(source_dir).select("path", "modificationTime", "length")


def batch_rows(batch: DataFrame, names: Sequence[str]) -> DataFrame:
    """The rows of a batch's files, each file read once, by its own header and with its width."""
    spark = batch.sparkSession
    found = batch.where("length > 0").select("path", "modificationTime").collect()  # the files of one micro-batch
    files = with_headers(spark, [GridFile(r.path, r.modificationTime) for r in found])
    return read_files(spark, files, names) if files else empty_grid(spark, names)


def process_batch(target_path: str, names: Sequence[str], run_ts: str | None = None,
                  max_future: str | None = None, formats: Sequence[str] = K.TIMESTAMP_FORMATS,
                  state_path: str | None = None, rejects_path: str | None = None,
                  run_log_path: str | None = None, pipeline: str = K.PIPELINE_NAME):
    def fn(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        configure(spark)
        started = P._ts(run_ts) or P._now()
        res = P.RunResult(pipeline, f"stream-{epoch_id}-{uuid.uuid4().hex[:8]}", started)
        if run_log_path:
            P.append_run_log(spark, run_log_path, res)
        stage = fresh_dir(spark, "typed")
        try:
            rows = CL.typed(batch_rows(batch, names), formats)
            rows = P.stage_at(rows, stage, partition=False)
            P.process(spark, rows, res, target_path, rejects_path, max_future)
            newest = res.new_watermark
            if state_path and newest is not None:
                # Keep the stored mark in step with the stream (never moving it back),
                # so batch runs on the same table start where the stream is.
                current = H.read_hwm(spark, state_path, pipeline)
                if current is None or newest > current:
                    H.update_hwm(spark, state_path, newest, pipeline)
            res.status = "SUCCESS"
        except Exception as exc:
            res.status, res.error_message = "FAILED", P.error_text(exc)
            raise
        finally:
            drop_dir(spark, stage)
            res.finished_at = P._ts(run_ts) or P._now()
            if run_log_path:
                P.append_run_log(spark, run_log_path, res)
    return fn


def start_ingest(spark: SparkSession, source_dir: str, target_path: str,
                 checkpoint: str | None = None, names: Sequence[str] | None = None,
                 max_files_per_trigger: int | None = None, run_ts: str | None = None,
                 max_future: str | None = None,
                 formats: Sequence[str] = K.TIMESTAMP_FORMATS,
                 available_now: bool = True,
                 processing_time: str | None = None,
                 state_path: str | None = None, rejects_path: str | None = None,
                 run_log_path: str | None = None) -> StreamingQuery:
    """Start the ingest stream; ``available_now`` runs to completion then stops.

    ``names``: the columns to read, each file maps to them by its own header."""
    configure(spark)
    names = list(names) if names else K.RAW_COLUMNS
    w = (file_stream(spark, source_dir, max_files_per_trigger).writeStream
         .foreachBatch(process_batch(target_path, names, run_ts, max_future, formats, state_path,
                                     rejects_path, run_log_path))
         .option("checkpointLocation", checkpoint or target_path.rstrip("/") + "__stream"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(
        processingTime=processing_time or "30 minutes")
    return w.start()


def ingest_available(spark: SparkSession, source_dir: str, target_path: str,
                     **kw) -> dt.timedelta:
    """Consume all new files now and wait for the stream to finish."""
    start = dt.datetime.now()
    q = start_ingest(spark, source_dir, target_path, available_now=True, **kw)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return dt.datetime.now() - start
