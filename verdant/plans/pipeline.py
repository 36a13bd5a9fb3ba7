"""One incremental run: HWM -> extract -> clean -> (stage) -> upsert -> HWM.

The batch is typed once and, when rejects are kept too, staged in the shared
scratch folder, so two outputs cost one parse.  A merge into a stored table
stages the clean batch as well: that cuts the lineage (a lost executor
re-reads files instead of re-parsing the source) and gives the touched dates
through ``Observation`` without a job of their own.  A first load writes its
rows once.  Staged folders go when the run ends, also when it fails.

What a run has done is kept in an order that a crash can't spoil: rejects,
then the fact table, then the mark.  A run that dies in between is repeated by
the next one: the keyed upsert gives the same table (and first finishes a
merge that was cut off, see ``operators.upsert``), and rejected rows that are
stored already are neither stored nor counted again.

The mark never moves back, except when a full run sets it anew.
"""

from __future__ import annotations

import datetime as dt
import logging
import traceback
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import contract as K
from ..operators import clean as CL
from ..operators import hwm as H
from ..functions.text import _ident
from ..operators.upsert import finish_pending, read_table, upsert
from ..session import configure, drop_dir, fresh_dir, is_missing, path_exists

log = logging.getLogger(__name__)


@dataclass
class RunResult:
    pipeline_name: str
    run_id: str
    started_at: dt.datetime
    finished_at: dt.datetime | None = None
    status: str = "RUNNING"
    watermark_before: dt.datetime | None = None
    new_watermark: dt.datetime | None = None
    rows_extracted: int = 0
    rows_rejected: int = 0
    rows_loaded: int = 0
    rows_inserted: int = 0
    rows_updated: int = 0
    touched_dates: list[dt.date] = field(default_factory=list)
    error_message: str | None = None


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None, microsecond=0)


def error_text(exc: Exception) -> str:
    return "".join(traceback.format_exception_only(type(exc), exc)).strip()


def _ts(v: str | dt.datetime | None) -> dt.datetime | None:
    if v is None or isinstance(v, dt.datetime):
        return v
    return dt.datetime.fromisoformat(v)


def extract(raw: DataFrame, watermark: dt.datetime | None, overlap: str | None = None,
            formats: Sequence[str] = K.TIMESTAMP_FORMATS) -> DataFrame:
    """Typed rows newer than the mark (all rows when there is none)."""
    return extract_typed(CL.typed(raw, formats), watermark, overlap)


def extract_typed(t: DataFrame, watermark: dt.datetime | None,
                  overlap: str | None = None) -> DataFrame:
    cond = H.since_filter(watermark, overlap)
    return t if cond is None else t.where(cond)


def stage_with_dates(clean: DataFrame, path: str | None = None):
    """Stage a clean batch; returns (staged frame, row count, touched dates).

    The touched dates ride along as a metric of the staging write (one
    value per day), so no extra job is needed to list them.
    """
    obs = Observation("staged")
    # Not partitioned by date: the merge reads all of it, and one file per
    # task (instead of one per task and date) keeps the staging write cheap.
    staged = stage_at(CL.with_partition(clean).observe(
        obs, F.count(F.lit(1)).alias("n"), F.collect_set(K.PARTITION_COL).alias("dates")),
        path or fresh_dir(clean.sparkSession, "stage"), partition=False)
    m = obs.get
    return staged, int(m.get("n") or 0), sorted(m.get("dates") or [])


def stage_and_upsert(spark: SparkSession, clean: DataFrame, target_path: str):
    """Upsert a clean batch; returns (rows in the batch, UpsertResult or None).

    A batch for a stored table is staged first; the staged copy is deleted
    when the upsert has ended, well or not.
    """
    finish_pending(spark, target_path)
    if read_table(spark, target_path) is None:
        res = upsert(spark, clean, target_path)
        return res.rows_loaded, res if res.rows_loaded else None
    path = fresh_dir(spark, "stage")
    try:
        staged, n, dates = stage_with_dates(clean, path)
        return n, upsert(spark, staged, target_path, dates) if n else None
    finally:
        drop_dir(spark, path)


def stage(df: DataFrame, partition: bool = True) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared scratch folder and read it back.

    Cuts the lineage: later jobs read the files instead of recomputing the
    plan, and a lost executor costs a re-read, not a re-parse.
    """
    return stage_at(df, fresh_dir(df.sparkSession, "stage"), partition)


def stage_at(df: DataFrame, path: str, partition: bool = True) -> DataFrame:
    spark = df.sparkSession
    w = df.write.partitionBy(K.PARTITION_COL) if partition else df.write
    w.parquet(path)
    return spark.read.schema(df.schema if not partition else _staged_schema(df)).parquet(path)


def _staged_schema(df: DataFrame) -> T.StructType:
    fields = [f for f in df.schema.fields if f.name != K.PARTITION_COL]
    return T.StructType(fields + [df.schema[K.PARTITION_COL]])


def append_run_log(spark: SparkSession, path: str, r: RunResult) -> None:
    row = (r.pipeline_name, r.run_id, r.started_at, r.finished_at, r.rows_extracted,
           r.rows_rejected, r.rows_loaded, r.status, r.error_message)
    spark.createDataFrame([row], K.RUN_LOG_SCHEMA).coalesce(1).write.mode("append").parquet(path)


def read_run_log(spark: SparkSession, path: str, history: bool = False) -> DataFrame:
    """Run log, one row per run (its latest status); ``history`` keeps every row.

    A run appends a RUNNING row when it starts and its final row when it ends.
    """
    log_rows = spark.read.schema(K.RUN_LOG_SCHEMA).parquet(path)
    if history:
        return log_rows
    w = Window.partitionBy("pipeline_name", "run_id").orderBy(
        (F.col("status") != "RUNNING").desc(), F.col("finished_at").desc_nulls_last())
    return log_rows.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def changed_since(spark: SparkSession, run_log_path: str, pipeline: str = K.PIPELINE_NAME,
                  overlap: str = "1 hour") -> dt.datetime | None:
    """From when on a file's change matters to the next run: the start of the last run that
    succeeded, less ``overlap`` (clocks of the writers, uploads that took long); None before one.

    ``read_grid(modified_after=...)`` then opens no other file.  A run's own rows are read
    again only within the overlap, where the keyed upsert and the mark absorb them."""
    if path_exists(spark, run_log_path) is False:
        return None
    done = read_run_log(spark, run_log_path).where((F.col("pipeline_name") == pipeline) & (F.col("status") == "SUCCESS"))
    return done.agg((F.max("started_at") - F.expr(f"INTERVAL {overlap}")).alias("t")).first()["t"]


def stored_rejects(spark: SparkSession, rejects_path: str) -> DataFrame | None:
    """The reject table, or None before the first reject."""
    if path_exists(spark, rejects_path) is False:
        return None
    try:
        return spark.read.parquet(rejects_path)
    except AnalysisException as e:
        if is_missing(e) or e.getCondition() == "UNABLE_TO_INFER_SCHEMA":
            return None
        raise


def without_known(rejects: DataFrame, known: DataFrame | None,
                  watermark: dt.datetime | None) -> DataFrame:
    """The rejected rows without those whose rejection is stored by an earlier run.

    Only rejected rows are compared: a valid row that is read again goes to the keyed
    upsert, whatever else of its file was refused.  A row of a frame is known by its
    ordinal, if it is not newer than the mark.  A row of a file has another position in
    each run (files are packed into tasks anew), so it is known by its file, the file's
    time of change, the reason and all that was read of it."""
    if known is None or K.ROW_NO not in known.columns:
        return rejects
    kind = rejects.schema[K.ROW_NO].dataType
    if known.schema[K.ROW_NO].dataType != kind:
        return rejects
    if isinstance(kind, T.StructType):
        types = {f.name: f.dataType for f in known.schema.fields}
        content = ", ".join(_ident(f.name) for f in rejects.schema.fields
                            if f.name not in (K.ROW_NO, K.CELLS_COL) and types.get(f.name) == f.dataType)
        row = f"struct({K.ROW_NO}.modified, {K.ROW_NO}.file, {content})"
        own = row
    else:
        old = "timestamp IS NULL" + (f" OR timestamp <= TIMESTAMP_NTZ '{watermark}'" if watermark else "")
        row, own = K.ROW_NO, f"CASE WHEN {old} THEN {K.ROW_NO} END"
    seen = known.selectExpr(f"{row} AS _seen").distinct()
    rows = rejects.selectExpr("*", f"{own} AS _from")
    return rows.join(seen, rows["_from"] == seen["_seen"], "left_anti").drop("_from")


def run(spark: SparkSession, raw: DataFrame, target_path: str, state_path: str,
        run_log_path: str | None = None, rejects_path: str | None = None,
        pipeline: str = K.PIPELINE_NAME, full: bool = False,
        run_ts: str | dt.datetime | None = None, overlap: str | None = None,
        max_future: str | None = None,
        formats: Sequence[str] = K.TIMESTAMP_FORMATS,
        run_id: str | None = None, parse_partitions: int | None = None,
        marks_path: str | None = None, keep_unmapped: bool = False) -> RunResult:
    """Run the pipeline once; returns the run's figures.

    With ``marks_path`` the new rows are those after their own plant's mark
    (``operators.hwm``), so a plant whose clock is ahead hides no other plant's rows;
    the single mark is still recorded.  ``keep_unmapped`` stores cells under headers that
    the contract does not name with their row (``read_table(..., unmapped=True)``)."""
    configure(spark)
    started = _ts(run_ts) or _now()
    res = RunResult(pipeline, run_id or uuid.uuid4().hex, started)
    typed_stage = None
    if run_log_path:
        append_run_log(spark, run_log_path, res)          # status RUNNING (the default)
    try:
        stored = H.read_hwm(spark, state_path, pipeline)
        res.watermark_before = None if full or marks_path else stored
        log.info("mark before the run: %s", res.watermark_before or "none, so all rows")
        raw = CL.with_cells(raw) if rejects_path else raw
        raw = CL.with_unmapped(raw) if keep_unmapped else raw
        batch = extract_typed(CL.typed(raw, formats, parse_partitions), res.watermark_before, overlap)
        if marks_path:
            batch = H.newer_than_marks(batch, H.current_marks(spark, marks_path, pipeline), overlap)
        if rejects_path or marks_path:
            typed_stage = fresh_dir(spark, "typed")
            batch = stage_at(batch, typed_stage, partition=False)
        process(spark, batch, res, target_path, rejects_path, max_future)
        if marks_path and res.rows_loaded:
            H.update_marks(spark, marks_path, CL.clean_typed(batch, started.isoformat(sep=" "), max_future), pipeline,
                           _ts(run_ts) or _now())
        newest = res.new_watermark
        if newest is not None and (full or stored is None or newest > stored):
            H.update_hwm(spark, state_path, newest, pipeline, updated_at=_ts(run_ts) or _now())
        res.status = "SUCCESS"
    except Exception as exc:
        res.status, res.error_message = "FAILED", error_text(exc)
        raise
    finally:
        if typed_stage:
            drop_dir(spark, typed_stage)
        res.finished_at = _ts(run_ts) or _now()
        if run_log_path:
            append_run_log(spark, run_log_path, res)
    return res


def process(spark: SparkSession, batch: DataFrame, res: RunResult, target_path: str,
            rejects_path: str | None = None, max_future: str | None = None) -> None:
    """Store a typed batch's rejects and upsert its clean rows; fills in ``res``.
    With ``rejects_path`` the batch is read more than once: stage it first."""
    ts_txt = res.started_at.isoformat(sep=" ")
    refused = Observation("refused")
    if rejects_path:
        # a refused row has these cells in its ``_cells`` already
        refusable = batch.drop(K.UNMAPPED_COL) if CL.holds_unmapped(batch) else batch
        fresh = without_known(CL.rejects_typed(refusable, max_future, ts_txt), stored_rejects(spark, rejects_path),
                              res.watermark_before)
        (fresh.withColumn("run_id", F.lit(res.run_id)).observe(refused, F.count(F.lit(1)).alias("n"))
         .write.mode("append").parquet(rejects_path))
    counted = Observation("extracted")
    observed = batch.observe(counted, F.count(F.lit(1)).alias("n"))
    n_clean, up = stage_and_upsert(spark, CL.clean_typed(observed, ts_txt, max_future), target_path)
    if rejects_path:  # rejects that an earlier run stored are not counted again
        res.rows_rejected = int(refused.get.get("n") or 0)
        res.rows_extracted = n_clean + res.rows_rejected
    else:
        res.rows_extracted = int(counted.get.get("n") or 0)
        res.rows_rejected = res.rows_extracted - n_clean
    if up is None:
        log.info("the batch holds no new readings")
        return
    res.rows_loaded, res.rows_inserted, res.rows_updated = up.rows_loaded, up.rows_inserted, up.rows_updated
    res.touched_dates, res.new_watermark = up.touched_dates, up.max_timestamp
