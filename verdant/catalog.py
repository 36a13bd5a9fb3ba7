"""Registered queries: name -> (spark callable, DuckDB oracle SQL or None).

Every query reads the driver tables under ``sf_dir`` (through the derived
``raw_readings`` grid) and runs over all of their rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import contract as K
from .functions import (format_timestamp, iso_timestamp, nan_to_null, parse_number,
                        parse_timestamp, round_to_second, to_decimal)
from .operators import access as AC
from .operators import clean as CL
from .operators import compact as CP
from .operators import hwm as H
from .operators import layouts as LY
from .operators import quality as DQ
from .operators import rollup as RU
from .operators import upsert as UP
from .oracles import NUM_SOURCE, ALL_NULL_SQL, NUM_RE, RUN_TS, all_null_sql, q, title_sql
from .plans import metrics as M
from .plans import pipeline as P
from .plans import replay as RP
from .plans import sql as SQ
from .plans import views as V
from .session import configure, fresh_dir
from .sources import grid as G
from .sources import json_records as J
from .sources import matrix as MX
from .sources.fixtures import COPY_MOD, raw_readings, read_table
from .streaming import ingest as S
from .streaming import state as ST

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[QueryFn, str | None]] = {}

HWM = "2024-01-15 00:00:00"          # high-water mark used by incremental queries
OVERLAP_HWM = "2024-01-14 23:00:00"  # HWM minus a one-hour overlap
PLANT = "Plant-A 7"
TASK_EVENTS = 250_000                # events that one task turns into readings


def register(name: str, oracle: str | None):
    def deco(fn: QueryFn) -> QueryFn:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return fn(spark, sf_dir)
        run.__name__ = fn.__name__
        REGISTRY[name] = (run, oracle)
        return run
    return deco


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_readings(spark, sf_dir)


def _cores(spark: SparkSession) -> int:
    """``parse_partitions`` of the registered queries: the raw grid is derived from one small
    file that Spark reads in one or two tasks, so its rows are dealt over all cores first."""
    return spark.sparkContext.defaultParallelism


def _sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw grid for queries that run the pipeline: dealt over all cores, and over more tasks
    where a task would get over ``TASK_EVENTS`` events (Parquet footers count them)."""
    events = read_table(spark, sf_dir, "events").count()
    return raw_readings(spark, sf_dir, max(_cores(spark), -(-events // TASK_EVENTS)))


def _until(cutoff: str | None):
    """Rows of the sheet up to ``cutoff``; those without a readable time are in every run's sheet.
    One reference to the timestamp, so that it is parsed once."""
    if cutoff is None:
        return F.lit(True)
    return F.coalesce(parse_timestamp("Timestamp") <= F.lit(cutoff).cast(T.TimestampNTZType()), F.lit(True))


def _typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return CL.typed(_raw(spark, sf_dir), parse_partitions=_cores(spark))


def _clean(spark: SparkSession, sf_dir: str, keep_row_no: bool = False) -> DataFrame:
    return CL.clean_typed(_typed(spark, sf_dir), run_ts=RUN_TS, keep_row_no=keep_row_no)


# -- sources / projections ------------------------------------------------------

@register("scan_raw", q("select * from R"))
def scan_raw(spark, sf_dir):
    return _raw(spark, sf_dir)


@register("rename_columns", q("select _row_no, " + ", ".join(
    f'"{k}" as {v}' for k, v in K.RENAME_MAP.items()) + " from R"))
def rename_columns(spark, sf_dir):
    return CL.rename_columns(_raw(spark, sf_dir))


# -- scalar functions -------------------------------------------------------------

@register("cast_timestamp", q(
    """select R._row_no, R."Timestamp" as raw_timestamp, T.timestamp from R join T on R._row_no = T._row_no"""))
def cast_timestamp(spark, sf_dir):
    return _raw(spark, sf_dir).select(
        K.ROW_NO, F.col("Timestamp").alias("raw_timestamp"), parse_timestamp("Timestamp").alias("timestamp"))


# Each event's time in one of eight layouts, by its id.
_LAYOUTS = ("yyyy-MM-dd", "yyyy-MM-dd HH:mm", "yyyy/MM/dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss'Z'",
            "yyyy-MM-dd'T'HH:mm:ss'+02:00'", "M/d/yyyy H:mm", "M/d/yyyy h:mm:ss a",
            "yyyy-MM-dd HH:mm:ss.SSSSSS'499'")


@register("cast_timestamp_formats", """
select event_id, case event_id % 8
    when 0 then date_trunc('day', ts)::timestamp
    when 1 then date_trunc('minute', ts)
    when 4 then date_trunc('second', ts) - interval 2 hour
    when 5 then date_trunc('minute', ts)
    when 7 then date_trunc('second', ts + interval 500 millisecond)
    else date_trunc('second', ts) end as timestamp
from events""")
def cast_timestamp_formats(spark, sf_dir):
    e = read_table(spark, sf_dir, "events").select("event_id", "ts")
    text = F.coalesce(*[F.when(F.col("event_id") % 8 == i, F.date_format("ts", f)) for i, f in enumerate(_LAYOUTS)])
    return e.select("event_id", text.alias("t")).select("event_id", parse_timestamp("t").alias("timestamp"))


@register("drop_bad_timestamps", q(
    "select _row_no, timestamp, plant_name from T where timestamp is not null"))
def drop_bad_timestamps(spark, sf_dir):
    return (_typed(spark, sf_dir).where(F.col("timestamp").isNotNull())
            .select(K.ROW_NO, "timestamp", "plant_name"))


@register("cast_numerics", q("select _row_no, " + ", ".join(K.NUMERIC_COLS) + " from T"))
def cast_numerics(spark, sf_dir):
    return _typed(spark, sf_dir).select(K.ROW_NO, *K.NUMERIC_COLS)


_NAN_TEXT_SQL = ("""case when _row_no % 13 = 0 then 'NaN' when _row_no % 17 = 0 then '-inf' """
                 """else "Moisture Sensor" end""")


@register("nan_to_null", q(f"""
select _row_no, raw_text,
       case when isnan(loose) or isinf(loose) then null else loose end as moisture
from (select _row_no, {_NAN_TEXT_SQL} as raw_text,
             try_cast({_NAN_TEXT_SQL} as double) as loose from R)"""))
def nan_to_null_q(spark, sf_dir):
    r = _raw(spark, sf_dir)
    rid = F.col(K.ROW_NO)
    txt = (F.when(rid % 13 == 0, F.lit("NaN")).when(rid % 17 == 0, F.lit("-inf"))
           .otherwise(F.col("Moisture Sensor")))
    loose = txt.try_cast(T.DoubleType())          # a lenient parser lets NaN/inf through
    return r.select(rid, txt.alias("raw_text"), nan_to_null(loose).alias("moisture"))


@register("decimal_narrowing", q(f"""
select _row_no, moisture_double,
       try_cast(moisture_double as decimal(4,2)) as moisture_dec,
       moisture_double is not null and try_cast(moisture_double as decimal(4,2)) is null as overflow
from (select _row_no, case when regexp_full_match(trim("Moisture Sensor"), '{NUM_RE}')
             then try_cast(trim("Moisture Sensor") as double) end as moisture_double from R)"""))
def decimal_narrowing(spark, sf_dir):
    r = _raw(spark, sf_dir).select(K.ROW_NO, parse_number("Moisture Sensor").alias("moisture_double"))
    dec = to_decimal(F.col("moisture_double"), 4)
    return r.select(K.ROW_NO, "moisture_double", dec.alias("moisture_dec"),
                    (F.col("moisture_double").isNotNull() & dec.isNull()).alias("overflow"))


@register("clean_strings", q(
    f"""select _row_no, {title_sql('"Plant Name"')} as plant_name, {title_sql('"Status"')} as status from R"""))
def clean_strings(spark, sf_dir):
    return _typed(spark, sf_dir).select(K.ROW_NO, "plant_name", "status")


@register("round_to_second", q(
    "select event_id, ts, date_trunc('second', ts + interval 500 millisecond) as ts_rounded from events"))
def round_to_second_q(spark, sf_dir):
    e = read_table(spark, sf_dir, "events").select("event_id", "ts")
    return e.select("event_id", "ts", round_to_second("ts").alias("ts_rounded"))


@register("format_timestamp", q("""
select event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') as ts_text,
       case when microsecond(ts) % 1000000 = 0 then strftime(ts, '%Y-%m-%dT%H:%M:%S')
            else strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') end as ts_iso
from events"""))
def format_timestamp_q(spark, sf_dir):
    e = read_table(spark, sf_dir, "events").select("event_id", "ts")
    return e.select("event_id", format_timestamp("ts").alias("ts_text"),
                    iso_timestamp("ts").alias("ts_iso"))


# -- row operators --------------------------------------------------------------

@register("dedup_keep_last", q("select _row_no, timestamp, plant_name, status from D"))
def dedup_keep_last(spark, sf_dir):
    t = _typed(spark, sf_dir).withColumn("_ok", CL.base_reject_reason().isNull())
    return (CL.dedup_keep_last(t).where("_ok")
            .select(K.ROW_NO, "timestamp", "plant_name", "status"))


@register("drop_empty_rows", q(
    f"select _row_no, moisture_sensor, inside_humidity from T where not ({ALL_NULL_SQL})"))
def drop_empty_rows(spark, sf_dir):
    return CL.drop_empty_rows(_typed(spark, sf_dir)).select(
        K.ROW_NO, "moisture_sensor", "inside_humidity")


@register("add_metadata", q(f"select _row_no, TIMESTAMP '{RUN_TS}' as etl_inserted_at from C"))
def add_metadata(spark, sf_dir):
    return _clean(spark, sf_dir, keep_row_no=True).select(K.ROW_NO, K.AUDIT_COL)


@register("clean_readings", q("select * exclude (_row_no) from C"))
def clean_readings(spark, sf_dir):
    return _clean(spark, sf_dir)


@register("rejects", q(f"""
select _row_no, reason as {K.REJECT_COL} from (
  select T._row_no,
         case when T.timestamp is null then '{K.BAD_TIMESTAMP}'
              when T.plant_name is null then '{K.NULL_PLANT}'
              when T.flaw is not null then T.flaw
              when D._row_no is null then '{K.DUPLICATE}'
              when {all_null_sql('T')} then '{K.ALL_NULL}'
         end as reason
  from T left join D using (_row_no)) where reason is not null"""))
def rejects(spark, sf_dir):
    return CL.rejects(_raw(spark, sf_dir), parse_partitions=_cores(spark)).select(K.ROW_NO, K.REJECT_COL)


@register("rejects_overflow", q(
    f"select _row_no, '{K.OVERFLOW}' as {K.REJECT_COL} from T "
    "where timestamp is not null and plant_name is not null and _row_no % 37 = 0"))
def rejects_overflow(spark, sf_dir):
    big = F.when(F.col(K.ROW_NO) % 37 == 0, F.lit("123456.78")).otherwise(F.col("Temperature"))
    r = CL.rejects(_raw(spark, sf_dir).withColumn("Temperature", big))
    return r.where(F.col(K.REJECT_COL) == K.OVERFLOW).select(K.ROW_NO, K.REJECT_COL)


@register("stage_counts", q(f"""
select (select count(*) from R) as rows_extracted,
       (select count(*) from T where timestamp is null) as rows_{K.BAD_TIMESTAMP},
       (select count(*) from T where timestamp is not null and plant_name is null) as rows_{K.NULL_PLANT},
       0::bigint as rows_{K.TOO_MANY_CELLS},
       (select count(*) from T where timestamp is not null and plant_name is not null and flaw is not null) as rows_{K.OVERFLOW},
       0::bigint as rows_{K.FUTURE_TIMESTAMP},
       (select count(*) from V) - (select count(*) from D) as rows_{K.DUPLICATE},
       (select count(*) from D where {ALL_NULL_SQL}) as rows_{K.ALL_NULL},
       (select count(*) from C) as rows_clean"""))
def stage_counts(spark, sf_dir):
    return CL.stage_counts(None, typed_rows=_typed(spark, sf_dir))


@register("null_profile", q(
    "select count(*) as rows, " + ", ".join(
        f"count(*) filter (where {c} is null) as {c}_nulls" for c in K.NUMERIC_COLS)
    + " from T where timestamp is not null"))
def null_profile(spark, sf_dir):
    return CL.null_profile(None, typed_rows=_typed(spark, sf_dir))


# -- views --------------------------------------------------------------------------

@register("latest_per_plant", q("""
select * exclude (rn, _row_no) from (
  select *, row_number() over (partition by plant_name order by timestamp desc) as rn from C)
where rn = 1"""))
def latest_per_plant(spark, sf_dir):
    return V.latest_per_plant(_clean(spark, sf_dir))


def _avg_sql(c: str) -> str:
    return (f"case when count({c}) > 0 then sum(cast({c} * 100 as bigint))::double "
            f"/ (count({c}) * 100)::double end")


@register("daily_averages", q(
    "select cast(timestamp as date) as reading_date, plant_name, count(*) as reading_count, "
    + ", ".join(f"{_avg_sql(src)} as {out}" for out, src in V.DAILY_AVERAGES.items())
    + " from C group by all"))
def daily_averages(spark, sf_dir):
    return V.daily_averages(_clean(spark, sf_dir))


# -- access patterns ---------------------------------------------------------------

RANGE = ("2024-01-10 06:00:00", "2024-01-12 18:00:00")
_TARGET_SQL = "select * exclude (_row_no) from C"


@register("status_filter", q(
    "select timestamp, plant_name, status, confidence_score_pct from C where status = 'Wilted'"))
def status_filter(spark, sf_dir):
    return V.status_filter(_clean(spark, sf_dir), "Wilted")


@register("time_range_scan", q(
    f"{_TARGET_SQL} where timestamp >= TIMESTAMP '{RANGE[0]}' and timestamp < TIMESTAMP '{RANGE[1]}'"))
def time_range_scan(spark, sf_dir):
    return V.time_range_scan(_clean(spark, sf_dir), *RANGE)


@register("plant_history", q(f"{_TARGET_SQL} where plant_name = '{PLANT}' order by timestamp desc"))
def plant_history(spark, sf_dir):
    return V.plant_history(_clean(spark, sf_dir), PLANT)


@register("preview_top3", q(f"{_TARGET_SQL} order by timestamp, plant_name limit 3"))
def preview_top3(spark, sf_dir):
    return V.preview(_clean(spark, sf_dir), 3)


# -- dashboard metrics ---------------------------------------------------------------

def _wilted_sql() -> str:
    return ("case when count(*) > 0 then (100 * count(*) filter (where status = 'Wilted'))::double"
            " / count(*)::double end")


@register("metric_kpis", q(f"""
select count(*) as total_readings, {_avg_sql('moisture_sensor')} as avg_moisture,
       {_avg_sql('confidence_score_pct')} as avg_confidence,
       {_avg_sql('inside_humidity')} - {_avg_sql('outside_humidity')} as humidity_diff,
       {_avg_sql('inside_temperature')} - {_avg_sql('outside_temperature')} as temperature_diff,
       {_wilted_sql()} as wilted_pct
from C"""))
def metric_kpis(spark, sf_dir):
    return M.kpis(_clean(spark, sf_dir))


@register("metric_humidity_diff", q(f"""
select {_avg_sql('inside_humidity')} as avg_inside_humidity,
       {_avg_sql('outside_humidity')} as avg_outside_humidity,
       {_avg_sql('inside_humidity')} - {_avg_sql('outside_humidity')} as humidity_diff from C"""))
def metric_humidity_diff(spark, sf_dir):
    return M.humidity_diff(_clean(spark, sf_dir))


@register("metric_temperature_diff", q(f"""
select {_avg_sql('inside_temperature')} as avg_inside_temperature,
       {_avg_sql('outside_temperature')} as avg_outside_temperature,
       {_avg_sql('inside_temperature')} - {_avg_sql('outside_temperature')} as temperature_diff
from C"""))
def metric_temperature_diff(spark, sf_dir):
    return M.temperature_diff(_clean(spark, sf_dir))


@register("metric_wilted_pct", q(f"""
select count(*) as total_readings, count(*) filter (where status = 'Wilted') as wilted_readings,
       {_wilted_sql()} as wilted_pct from C"""))
def metric_wilted_pct(spark, sf_dir):
    return M.wilted_pct(_clean(spark, sf_dir))


@register("confidence_trend", q(f"""
select cast(timestamp as date) as reading_date, count(*) as reading_count,
       {_avg_sql('confidence_score_pct')} as avg_confidence from C group by all"""))
def confidence_trend(spark, sf_dir):
    return M.confidence_trend(_clean(spark, sf_dir))


@register("health_distribution", q("""
select status, reading_count, (100 * reading_count)::double / (sum(reading_count) over ())::double as share_pct
from (select status, count(*) as reading_count from C group by status)"""))
def health_distribution(spark, sf_dir):
    return M.health_distribution(_clean(spark, sf_dir))


@register("wilting_risk", q(f"""
select plant_name, reading_count, wilted_count, wilted_pct,
       case when wilted_pct < {M.RISK_LOW} then 'low' when wilted_pct < {M.RISK_HIGH} then 'medium'
            else 'high' end as risk_level
from (select plant_name, count(*) as reading_count,
             count(*) filter (where status = 'Wilted') as wilted_count, {_wilted_sql()} as wilted_pct
      from C group by plant_name)"""))
def wilting_risk(spark, sf_dir):
    return M.wilting_risk(_clean(spark, sf_dir))


@register("environment_daily", q(f"""
select cast(timestamp as date) as reading_date,
       {_avg_sql('inside_temperature')} as avg_inside_temp,
       {_avg_sql('outside_temperature')} as avg_outside_temp,
       {_avg_sql('inside_humidity')} as avg_inside_humidity,
       {_avg_sql('outside_humidity')} as avg_outside_humidity,
       {_avg_sql('inside_temperature')} - {_avg_sql('outside_temperature')} as temperature_diff,
       {_avg_sql('inside_humidity')} - {_avg_sql('outside_humidity')} as humidity_diff
from C group by all"""))
def environment_daily(spark, sf_dir):
    return M.environment_daily(_clean(spark, sf_dir))


# -- incremental loads and the high-water mark ---------------------------------------

@register("incremental_filter", q(f"{_TARGET_SQL} where timestamp > TIMESTAMP '{HWM}'"))
def incremental_filter(spark, sf_dir):
    batch = P.extract_typed(_typed(spark, sf_dir), P._ts(HWM))
    return CL.clean_typed(batch, RUN_TS)


@register("incremental_overlap", q(f"{_TARGET_SQL} where timestamp > TIMESTAMP '{OVERLAP_HWM}'"))
def incremental_overlap(spark, sf_dir):
    batch = P.extract_typed(_typed(spark, sf_dir), P._ts(HWM), overlap="1 hour")
    return CL.clean_typed(batch, RUN_TS)


@register("late_rows", q(
    f"select _row_no, timestamp, plant_name from T where timestamp <= TIMESTAMP '{HWM}'"))
def late_rows(spark, sf_dir):
    t = _typed(spark, sf_dir)
    return t.where(F.col("timestamp") <= F.lit(HWM).cast(T.TimestampNTZType())).select(
        K.ROW_NO, "timestamp", "plant_name")


@register("hwm_candidate", q("""
select max(timestamp) as new_watermark,
       strftime(max(timestamp), '%Y-%m-%dT%H:%M:%S') as new_watermark_iso from C"""))
def hwm_candidate(spark, sf_dir):
    m = _clean(spark, sf_dir).agg(F.max("timestamp").alias("new_watermark"))
    return m.select("new_watermark", iso_timestamp("new_watermark").alias("new_watermark_iso"))


def _ts_col(v: str):
    return F.lit(v).cast(T.TimestampNTZType())


# Three scheduled runs over a sheet that grows: run k sees rows up to CUTOFFS[k].
CUTOFFS = ("2024-01-10 00:00:00", "2024-01-20 00:00:00", None)
RUN_TIMES = ("2025-05-01 10:00:00", "2025-05-01 10:30:00", "2025-05-01 11:00:00")


def _incremental_runs(spark, sf_dir):
    raw = _sheet(spark, sf_dir)
    target, state = fresh_dir(spark, "fact"), fresh_dir(spark, "hwm")
    for cutoff, run_ts in zip(CUTOFFS, RUN_TIMES):
        P.run(spark, raw.where(_until(cutoff)), target, state, run_ts=run_ts)
    return target, state


def _run_audit_sql() -> str:
    """Audit timestamp of the run that loaded each row (run k owns rows up to CUTOFFS[k])."""
    arms = " ".join(f"when timestamp <= TIMESTAMP '{c}' then TIMESTAMP '{r}'"
                    for c, r in zip(CUTOFFS[:-1], RUN_TIMES[:-1]))
    return f"case {arms} else TIMESTAMP '{RUN_TIMES[-1]}' end"


@register("incremental_runs", q(
    f"select * exclude (_row_no) replace ({_run_audit_sql()} as etl_inserted_at) from C"))
def incremental_runs(spark, sf_dir):
    target, _ = _incremental_runs(spark, sf_dir)
    return UP.read_table(spark, target).select(*K.TARGET_COLUMNS)


@register("hwm_update", q(" union all ".join(
    f"select '{K.PIPELINE_NAME}' as pipeline_name, max(timestamp) as last_watermark, "
    f"TIMESTAMP '{r}' as updated_at from C"
    + (f" where timestamp <= TIMESTAMP '{c}'" if c else "")
    for c, r in zip(CUTOFFS, RUN_TIMES))))
def hwm_update(spark, sf_dir):
    _, state = _incremental_runs(spark, sf_dir)
    return H.state_log(spark, state)


@register("hwm_read", q(
    f"select '{K.PIPELINE_NAME}' as pipeline_name, max(timestamp) as last_watermark from C"))
def hwm_read(spark, sf_dir):
    _, state = _incremental_runs(spark, sf_dir)
    return H.latest(spark, state)


@register("full_load", q(_TARGET_SQL))
def full_load(spark, sf_dir):
    target, state = fresh_dir(spark, "fact"), fresh_dir(spark, "hwm")
    P.run(spark, _raw(spark, sf_dir), target, state, full=True, run_ts=RUN_TS, parse_partitions=_cores(spark))
    return UP.read_table(spark, target).select(*K.TARGET_COLUMNS)


@register("run_log", q(f"""
select '{K.PIPELINE_NAME}' as pipeline_name, (select count(*) from R) as rows_extracted,
       (select count(*) from R) - (select count(*) from C) as rows_rejected,
       (select count(*) from C) as rows_loaded, 'SUCCESS' as status"""))
def run_log(spark, sf_dir):
    target, state, logp = (fresh_dir(spark, n) for n in ("fact", "hwm", "runlog"))
    P.run(spark, _sheet(spark, sf_dir), target, state, run_log_path=logp, run_ts=RUN_TS)
    return P.read_run_log(spark, logp).select(
        "pipeline_name", "rows_extracted", "rows_rejected", "rows_loaded", "status")


def _three_runs_with_rejects(spark, sf_dir):
    raw = _sheet(spark, sf_dir)
    target, state, rej, logp = (fresh_dir(spark, n) for n in ("fact", "hwm", "rejects", "runlog"))
    for cutoff, run_ts in zip(CUTOFFS, RUN_TIMES):
        P.run(spark, raw.where(_until(cutoff)), target, state, run_ts=run_ts, rejects_path=rej, run_log_path=logp)
    return rej, logp


@register("rejects_three_runs", REGISTRY["rejects"][1])
def rejects_three_runs(spark, sf_dir):
    """Rows refused over three runs of a growing sheet: each stored once."""
    rej, _ = _three_runs_with_rejects(spark, sf_dir)
    return spark.read.parquet(rej).select(K.ROW_NO, K.REJECT_COL)


@register("run_log_three_runs", q("""
select 3::bigint as runs, (select count(*) from R) as rows_extracted,
       (select count(*) from R) - (select count(*) from C) as rows_rejected,
       (select count(*) from C) as rows_loaded"""))
def run_log_three_runs(spark, sf_dir):
    _, logp = _three_runs_with_rejects(spark, sf_dir)
    return P.read_run_log(spark, logp).agg(
        F.count(F.lit(1)).alias("runs"), *[F.sum(c).alias(c) for c in ("rows_extracted", "rows_rejected", "rows_loaded")])


@register("hwm_monotonic_overlap", q(
    f"select '{K.PIPELINE_NAME}' as pipeline_name, max(timestamp) as last_watermark from C "
    f"where timestamp <= TIMESTAMP '{CUTOFFS[1]}'"))
def hwm_monotonic_overlap(spark, sf_dir):
    """A run of late rows alone, read through an overlap, leaves the mark where it is."""
    raw, ts = _sheet(spark, sf_dir), parse_timestamp(F.col("Timestamp"))
    target, state = fresh_dir(spark, "fact"), fresh_dir(spark, "hwm")
    P.run(spark, raw.where(ts <= _ts_col(CUTOFFS[1])), target, state, run_ts=RUN_TIMES[0])
    P.run(spark, raw.where(ts <= _ts_col(CUTOFFS[0])), target, state, run_ts=RUN_TIMES[1], overlap="30 days")
    return H.latest(spark, state)


# -- keyed upsert ----------------------------------------------------------------------

# Target holds readings before UPSERT_HI; the source re-sends readings from
# UPSERT_LO on with a revised status, so [LO, HI) are updates and >= HI inserts.
UPSERT_LO, UPSERT_HI = "2024-01-18 00:00:00", "2024-01-20 00:00:00"
RUN_TS2 = "2025-05-02 10:00:00"


def _upsert_source(spark, sf_dir):
    src = CL.clean_typed(_typed(spark, sf_dir), run_ts=RUN_TS2).where(
        F.col("timestamp") >= _ts_col(UPSERT_LO))
    return src.withColumn("status", F.lit("Revised"))


def _upsert_target(spark, sf_dir):
    return _clean(spark, sf_dir).where(F.col("timestamp") < _ts_col(UPSERT_HI))


def _upsert_scenario(spark, sf_dir, times: int = 1):
    path = fresh_dir(spark, "fact")
    UP.write_partitions(CL.with_partition(_upsert_target(spark, sf_dir)), path)
    source, _, dates = P.stage_with_dates(_upsert_source(spark, sf_dir))
    res = None
    for _ in range(times):
        res = UP.upsert(spark, source, path, dates)
    return path, res


_UPSERT_SQL = (f"select * exclude (_row_no) from C where timestamp < TIMESTAMP '{UPSERT_LO}' "
               f"union all select * exclude (_row_no) replace ('Revised' as status, "
               f"TIMESTAMP '{RUN_TS2}' as etl_inserted_at) from C where timestamp >= TIMESTAMP '{UPSERT_LO}'")


@register("upsert_merge", q(_UPSERT_SQL))
def upsert_merge(spark, sf_dir):
    path, _ = _upsert_scenario(spark, sf_dir, 1)
    return UP.read_table(spark, path).select(*K.TARGET_COLUMNS)


@register("upsert_idempotent", q(_UPSERT_SQL))
def upsert_idempotent(spark, sf_dir):
    path, _ = _upsert_scenario(spark, sf_dir, 2)
    return UP.read_table(spark, path).select(*K.TARGET_COLUMNS)


@register("load_rowcount", q(f"""
select count(*) filter (where timestamp >= TIMESTAMP '{UPSERT_LO}') as rows_loaded,
       count(*) filter (where timestamp >= TIMESTAMP '{UPSERT_HI}') as rows_inserted,
       count(*) filter (where timestamp >= TIMESTAMP '{UPSERT_LO}'
                          and timestamp < TIMESTAMP '{UPSERT_HI}') as rows_updated from C"""))
def load_rowcount(spark, sf_dir):
    path, res = _upsert_scenario(spark, sf_dir, 1)
    return spark.createDataFrame(
        [(res.rows_loaded, res.rows_inserted, res.rows_updated)],
        "rows_loaded bigint, rows_inserted bigint, rows_updated bigint")


@register("upsert_last_wins", q(
    "select " + ", ".join(c if c != K.AUDIT_COL else f"TIMESTAMP '{RUN_TS}' as {c}"
                          for c in K.TARGET_COLUMNS) + " from D"))
def upsert_last_wins(spark, sf_dir):
    t = CL.drop_bad_rows(_typed(spark, sf_dir))           # duplicates kept
    source = P.stage(CL.with_partition(CL.add_metadata(t, RUN_TS)), partition=True)
    path = fresh_dir(spark, "fact")
    UP.upsert(spark, source, path)
    return UP.read_table(spark, path).select(*K.TARGET_COLUMNS)


_SRC_SQL = f"(select * exclude (_row_no) from C where timestamp >= TIMESTAMP '{UPSERT_LO}')"
_TGT_SQL = f"(select timestamp, plant_name from C where timestamp < TIMESTAMP '{UPSERT_HI}')"


@register("merge_matched", q(
    f"select * from {_SRC_SQL} s where exists (select 1 from {_TGT_SQL} t "
    "where t.timestamp = s.timestamp and t.plant_name = s.plant_name)"))
def merge_matched(spark, sf_dir):
    src = _clean(spark, sf_dir).where(F.col("timestamp") >= _ts_col(UPSERT_LO))
    return UP.matched(src, _upsert_target(spark, sf_dir))


@register("merge_not_matched", q(
    f"select * from {_SRC_SQL} s where not exists (select 1 from {_TGT_SQL} t "
    "where t.timestamp = s.timestamp and t.plant_name = s.plant_name)"))
def merge_not_matched(spark, sf_dir):
    src = _clean(spark, sf_dir).where(F.col("timestamp") >= _ts_col(UPSERT_LO))
    return UP.not_matched(src, _upsert_target(spark, sf_dir))


# -- data quality ----------------------------------------------------------------------

@register("dq_unique_key", q(
    "select timestamp, plant_name, count(*) as dup_count from V group by all having count(*) > 1"))
def dq_unique_key(spark, sf_dir):
    return DQ.duplicate_keys(CL.drop_bad_rows(_typed(spark, sf_dir)))


@register("dq_not_null", q(
    "select _row_no, 'timestamp' as failed_column from T where timestamp is null union all "
    "select _row_no, 'plant_name' as failed_column from T where plant_name is null"))
def dq_not_null(spark, sf_dir):
    return DQ.not_null_violations(_typed(spark, sf_dir))


def _fit_sql() -> str:
    parts = []
    for c, p in K.NUMERIC_PRECISION.items():
        src = f'"{NUM_SOURCE[c]}"'
        d = (f"case when regexp_full_match(trim({src}), '{NUM_RE}') "
             f"then try_cast(trim({src}) as double) end")
        parts.append(f"count(*) filter (where {d} is not null and "
                     f"try_cast({d} as decimal({p},2)) is null) as {c}_overflow")
    for c, n in K.TEXT_LENGTH.items():
        v = '"Time"' if c == "reading_time" else title_sql(f'"{NUM_SOURCE[c]}"')
        parts.append(f"count(*) filter (where length({v}) > {n}) as {c}_too_long")
    return "select " + ", ".join(parts) + " from R"


@register("dq_type_fit", q(_fit_sql()))
def dq_type_fit(spark, sf_dir):
    return DQ.type_fit(_raw(spark, sf_dir))


# -- sources and sinks -----------------------------------------------------------------

@register("json_roundtrip", q(_TARGET_SQL))
def json_roundtrip(spark, sf_dir):
    path = fresh_dir(spark, "json")
    J.write_records(_clean(spark, sf_dir), path)
    return J.read_records(spark, path, K.TARGET_SCHEMA)


@register("json_props", q("select event_id, cast(props->>'k' as bigint) as k from events"))
def json_props(spark, sf_dir):
    e = read_table(spark, sf_dir, "events")
    return e.select("event_id", J.field("props", "k", T.LongType()).alias("k"))


SHORT_MOD = 7      # rows whose ordinal is a multiple of this lose their last two cells
GRID_CELLS = ["Row", *K.RAW_COLUMNS]


def _grid_frame(raw):
    return raw.withColumn("Row", F.col(K.ROW_NO).cast("string"))


@register("pad_short_rows", q("select _row_no, " + ", ".join(
    f'"{c}"' if c not in K.RAW_COLUMNS[-2:] else
    f"""case when _row_no % {SHORT_MOD} = 0 then '' else "{c}" end as "{c}\""""
    for c in K.RAW_COLUMNS) + " from R"))
def pad_short_rows(spark, sf_dir):
    path = fresh_dir(spark, "grid")
    G.write_grid(_grid_frame(_raw(spark, sf_dir)), path, GRID_CELLS,
                 short_when=(F.col(K.ROW_NO) % SHORT_MOD) == 0,
                 keep_when_short=len(GRID_CELLS) - 2)
    g = G.read_grid(spark, path)
    return g.select(F.col("Row").cast(T.LongType()).alias(K.ROW_NO), *K.RAW_COLUMNS)


STREAM_SPLITS = ("2024-01-10 00:00:00", "2024-01-20 00:00:00")


@register("stream_ingest", q(_TARGET_SQL))
def stream_ingest(spark, sf_dir):
    raw = _grid_frame(_raw(spark, sf_dir))
    ts = parse_timestamp(F.col("Timestamp"))
    lo, hi = (_ts_col(s) for s in STREAM_SPLITS)
    src = fresh_dir(spark, "landing")
    chunk = F.when(ts.isNull() | (ts < lo), 0).when(ts < hi, 1).otherwise(2)
    later = F.col(K.ROW_NO) % 2 == 1  # the copies land after the rows they revise
    for name, part in (("first", raw.where(~later)), ("second", raw.where(later))):
        G.write_grid(part.withColumn("chunk", chunk), f"{src}/{name}", GRID_CELLS, partition_by="chunk")
    target = fresh_dir(spark, "fact")
    S.ingest_available(spark, src, target, names=GRID_CELLS, max_files_per_trigger=16,
                       run_ts=RUN_TS)
    return UP.read_table(spark, target).select(*K.TARGET_COLUMNS)


def _streamed(spark, sf_dir):
    """One micro-batch over the whole grid, with rejects and a run log."""
    src, target, rej, logp = (fresh_dir(spark, n) for n in ("landing", "fact", "rejects", "runlog"))
    G.write_grid(_grid_frame(_raw(spark, sf_dir)), src, GRID_CELLS)
    S.ingest_available(spark, src, target, names=GRID_CELLS, run_ts=RUN_TS, rejects_path=rej, run_log_path=logp)
    return rej, logp


@register("stream_rejects", q(f"""
select timestamp, plant_name, reason as {K.REJECT_COL}, count(*) as n from (
  select T.timestamp, T.plant_name,
         case when T.timestamp is null then '{K.BAD_TIMESTAMP}'
              when T.plant_name is null then '{K.NULL_PLANT}'
              when T.flaw is not null then T.flaw
              when D._row_no is null then '{K.DUPLICATE}'
              when {all_null_sql('T')} then '{K.ALL_NULL}' end as reason
  from T left join D using (_row_no)) where reason is not null group by all"""))
def stream_rejects(spark, sf_dir):
    """By key and reason: which of two rows is later is the files' order here."""
    rej, _ = _streamed(spark, sf_dir)
    return (spark.read.parquet(rej).groupBy("timestamp", "plant_name", K.REJECT_COL)
            .agg(F.count(F.lit(1)).alias("n")))


@register("stream_run_log", REGISTRY["run_log"][1])
def stream_run_log(spark, sf_dir):
    _, logp = _streamed(spark, sf_dir)
    return P.read_run_log(spark, logp).select(
        "pipeline_name", "rows_extracted", "rows_rejected", "rows_loaded", "status")


# -- SQL surface ---------------------------------------------------------------------

@register("sql_daily_view", REGISTRY["daily_averages"][1])
def sql_daily_view(spark, sf_dir):
    SQ.register_views(_clean(spark, sf_dir))
    return spark.sql(f"SELECT * FROM {SQ.DAILY_VIEW}")


@register("sql_latest_view", REGISTRY["latest_per_plant"][1])
def sql_latest_view(spark, sf_dir):
    SQ.register_views(_clean(spark, sf_dir))
    return spark.sql(f"SELECT * FROM {SQ.LATEST_VIEW}")


@register("sql_fact_table", q(_TARGET_SQL))
def sql_fact_table(spark, sf_dir):
    """The table by its catalog name; creating it again changes nothing."""
    path = fresh_dir(spark, "fact")
    name = f"{SQ.FACT_TABLE}_{path.rsplit('-', 1)[-1]}"
    UP.upsert(spark, _clean(spark, sf_dir), path)
    for _ in range(2):
        spark.sql(SQ.ddl(name, K.TABLE_SCHEMA, path, K.PARTITION_COL))
    spark.catalog.recoverPartitions(name)
    return spark.table(name).select(*K.TARGET_COLUMNS)


# -- the stored table ----------------------------------------------------------------

def stored_table(spark, sf_dir):
    """The clean readings as the partitioned table that users read."""
    path = fresh_dir(spark, "fact")
    UP.write_partitions(CL.with_partition(_clean(spark, sf_dir)), path)
    return UP.read_table(spark, path)


@register("stored_time_range", REGISTRY["time_range_scan"][1])
def stored_time_range(spark, sf_dir):
    return V.time_range_scan(stored_table(spark, sf_dir), *RANGE).select(*K.TARGET_COLUMNS)


@register("stored_plant_history", REGISTRY["plant_history"][1])
def stored_plant_history(spark, sf_dir):
    return V.plant_history(stored_table(spark, sf_dir), PLANT).select(*K.TARGET_COLUMNS)


@register("stored_status_filter", REGISTRY["status_filter"][1])
def stored_status_filter(spark, sf_dir):
    return V.status_filter(stored_table(spark, sf_dir), "Wilted")


@register("stored_latest", REGISTRY["latest_per_plant"][1])
def stored_latest(spark, sf_dir):
    return V.latest_per_plant(stored_table(spark, sf_dir)).select(*K.TARGET_COLUMNS)


@register("stored_latest_pruned", REGISTRY["latest_per_plant"][1])
def stored_latest_pruned(spark, sf_dir):
    return V.latest_per_plant_pruned(stored_table(spark, sf_dir)).select(*K.TARGET_COLUMNS)


@register("stored_daily_averages", REGISTRY["daily_averages"][1])
def stored_daily_averages(spark, sf_dir):
    return V.daily_averages(stored_table(spark, sf_dir))


@register("stored_since", REGISTRY["incremental_filter"][1])
def stored_since(spark, sf_dir):
    return V.since(stored_table(spark, sf_dir), HWM).select(*K.TARGET_COLUMNS)


# -- grids of many files ----------------------------------------------------------------

@register("grid_mixed_headers", q("select _row_no, " + ", ".join(
    f"""case when _row_no % 3 = 2 then null else "{c}" end as "{c}\"""" if c == "Inside Humidity" else f'"{c}"'
    for c in K.RAW_COLUMNS) + " from R"))
def grid_mixed_headers(spark, sf_dir):
    """Three files' worth of rows: two column orders, and one column missing."""
    raw, path = _grid_frame(_raw(spark, sf_dir)), fresh_dir(spark, "grid")
    orders = (GRID_CELLS, GRID_CELLS[::-1], [c for c in GRID_CELLS if c != "Inside Humidity"])
    for i, cells in enumerate(orders):
        G.write_grid(raw.where(F.col(K.ROW_NO) % 3 == i), f"{path}/{i}", cells)
    return G.read_grid(spark, path).select(F.col("Row").cast("long").alias(K.ROW_NO), *K.RAW_COLUMNS)


@register("dedup_multi_file", q("""
select kind, timestamp, plant_name, max(case when status = 'Dead' then 1 else 0 end) = 1 as from_later_file
from V, (select unnest(['csv', 'json']) as kind) group by all"""))
def dedup_multi_file(spark, sf_dir):
    """Keep-last over two files: the copies (status dead) are in the one written later."""
    raw, later = _raw(spark, sf_dir), F.col("Status") == "dead"
    csv, js = fresh_dir(spark, "grid"), fresh_dir(spark, "json")
    for name, part in (("z-first", raw.where(~later)), ("a-second", raw.where(later))):
        G.write_grid(part, f"{csv}/{name}", K.RAW_COLUMNS)
        J.write_records(part.select(*K.RAW_COLUMNS), f"{js}/{name}")
    schema = T.StructType(K.RAW_SCHEMA.fields[1:])
    records = J.read_records(spark, f"{js}/*", schema, with_ordinal=True)
    out = None
    for kind, grid, path in (("csv", G.read_grid(spark, csv), csv), ("json", records, js)):
        last = CL.dedup_keep_last(CL.drop_bad_rows(CL.typed(grid)), partitions=G.tasks_for(spark, path)).select(
            F.lit(kind).alias("kind"), "timestamp", "plant_name", (F.col("status") == "Dead").alias("from_later_file"))
        out = last if out is None else out.unionByName(last)
    return out


@register("rejects_overlong", q(
    f"""select _row_no, '{K.TOO_MANY_CELLS}' as {K.REJECT_COL}, '["surplus","more"]' as {K.EXTRA_COL} from T """
    "where timestamp is not null and plant_name is not null and _row_no % 31 = 0"))
def rejects_overlong(spark, sf_dir):
    raw, path = _grid_frame(_raw(spark, sf_dir)), fresh_dir(spark, "grid")
    line = G.to_line(GRID_CELLS)
    line = F.when(F.col(K.ROW_NO) % 31 == 0, F.concat(line, F.lit(",surplus,more"))).otherwise(line)
    G.write_lines(raw, path, GRID_CELLS, line)
    r = CL.rejects(G.read_grid(spark, path)).where(F.col(K.REJECT_COL) == K.TOO_MANY_CELLS)
    return r.select(F.col("Row").cast("long").alias(K.ROW_NO), K.REJECT_COL, K.EXTRA_COL)


@register("grid_header_trim", q('select _row_no, "Plant Name", "Confidence Score (%)" from R'))
def grid_header_trim(spark, sf_dir):
    """Header names padded with blanks read as the names."""
    raw, path = _grid_frame(_raw(spark, sf_dir)), fresh_dir(spark, "grid")
    padded = [f"  {c} " for c in GRID_CELLS]
    G.write_grid(raw.select(*[F.col(f"`{c}`").alias(p) for c, p in zip(GRID_CELLS, padded)]), path, padded)
    return G.read_grid(spark, path).select(F.col("Row").cast("long").alias(K.ROW_NO), "Plant Name", "Confidence Score (%)")


@register("grid_empty_source", q(f"{_TARGET_SQL} where false"))
def grid_empty_source(spark, sf_dir):
    """A source without rows is an empty frame of the contract's shape."""
    path = fresh_dir(spark, "grid")
    G.write_grid(_raw(spark, sf_dir).where("Timestamp is null"), path, K.RAW_COLUMNS)
    return CL.clean(G.read_grid(spark, path), run_ts=RUN_TS)


# -- contract ---------------------------------------------------------------------------

@register("missing_columns", q(
    "select 'reading_time' as column_name, count(*) as rows_null from R union all "
    "select 'inside_humidity', count(*) from R"))
def missing_columns(spark, sf_dir):
    """Expected columns that the grid lacks, and the NULLs that stand for them."""
    raw = _raw(spark, sf_dir).drop("Time", "Inside Humidity")
    names = CL.missing_columns(raw)
    counts = CL.rename_columns(raw).agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in names])
    return counts.unpivot([], names, "column_name", "rows_null")


@register("mandatory_column", q("select true as refused, count(*) as rows_refused from R"))
def mandatory_column(spark, sf_dir):
    """A grid without the timestamp column is refused before any row is read."""
    raw, refused = _raw(spark, sf_dir).drop("Timestamp"), False
    try:
        CL.rename_columns(raw)
    except KeyError:
        refused = True
    return raw.agg(F.lit(refused).alias("refused"), F.count(F.lit(1)).alias("rows_refused"))


@register("column_defaults", q(
    "select timestamp, plant_name, null::varchar as status, true as audit_set from C"))
def column_defaults(spark, sf_dir):
    """The write projection fills what a batch lacks: NULL, and the run time for the audit column."""
    t = CL.to_target(_clean(spark, sf_dir).drop("status", K.AUDIT_COL))
    return t.select("timestamp", "plant_name", "status", F.col(K.AUDIT_COL).isNotNull().alias("audit_set"))


@register("null_name_stays_null", q(
    f"""select _row_no, case when _row_no % 5 = 0 then null else {title_sql('"Plant Name"')} end as plant_name from R"""))
def null_name_stays_null(spark, sf_dir):
    raw = _raw(spark, sf_dir)
    name = F.when(F.col(K.ROW_NO) % 5 != 0, F.col("Plant Name"))
    return CL.typed(raw.withColumn("Plant Name", name)).select(K.ROW_NO, "plant_name")


# -- quarantine and replay -----------------------------------------------------------------

DAY_FIRST = "d.M.yyyy H:mm:ss"
_DAY_FIRST_ROWS = f"_row_no % 10 = 0 and _row_no % {2 * COPY_MOD} <> 0"


def _replayed(spark, sf_dir):
    """A run that refuses a tenth of the rows (day-first timestamps), then a replay with that layout."""
    raw = _raw(spark, sf_dir)
    ts = F.try_to_timestamp("Timestamp", F.lit("yyyy-MM-dd HH:mm:ss"))
    day_first = F.expr(_DAY_FIRST_ROWS) & ts.isNotNull()
    raw = raw.withColumn("Timestamp", F.when(day_first, F.date_format(ts, DAY_FIRST)).otherwise(F.col("Timestamp")))
    target, state, rej = (fresh_dir(spark, n) for n in ("fact", "hwm", "rejects"))
    P.run(spark, raw, target, state, run_ts=RUN_TS, rejects_path=rej, parse_partitions=_cores(spark))
    RP.replay(spark, rej, target, [*K.TIMESTAMP_FORMATS, DAY_FIRST], run_ts=RUN_TS)
    return target, rej


@register("rejects_replay", REGISTRY["rejects"][1])
def rejects_replay(spark, sf_dir):
    """What stays refused once the missing layout is added."""
    _, rej = _replayed(spark, sf_dir)
    return P.stored_rejects(spark, rej).select(K.ROW_NO, K.REJECT_COL)


@register("rejects_replay_table", q(_TARGET_SQL))
def rejects_replay_table(spark, sf_dir):
    """The fact table after the replay: as if the layout had been known from the start."""
    target, _ = _replayed(spark, sf_dir)
    return UP.read_table(spark, target).select(*K.TARGET_COLUMNS)


@register("rejects_cells", q(f"""
select _row_no, "Timestamp" as timestamp_text, "Plant Name" as plant_text from R
where _row_no in (select _row_no from T where timestamp is null)"""))
def rejects_cells(spark, sf_dir):
    """The cells that refused rows were read with, out of the stored rejects."""
    target, state, rej = (fresh_dir(spark, n) for n in ("fact", "hwm", "rejects"))
    P.run(spark, _raw(spark, sf_dir), target, state, run_ts=RUN_TS, rejects_path=rej, parse_partitions=_cores(spark))
    bad = P.stored_rejects(spark, rej).where(F.col(K.REJECT_COL) == K.BAD_TIMESTAMP)
    return bad.select(K.ROW_NO, J.field(K.CELLS_COL, "Timestamp", T.StringType()).alias("timestamp_text"),
                      J.field(K.CELLS_COL, "Plant Name", T.StringType()).alias("plant_text"))


# -- a mark per plant ------------------------------------------------------------------------

@register("hwm_per_plant", q(
    f"select * exclude (_row_no) replace (case when plant_name = '{PLANT}' or timestamp <= TIMESTAMP '{CUTOFFS[0]}' "
    f"then TIMESTAMP '{RUN_TIMES[0]}' else TIMESTAMP '{RUN_TIMES[1]}' end as etl_inserted_at) from C"))
def hwm_per_plant(spark, sf_dir):
    """One plant runs ahead of the others in the first run and hides none of their rows in the second."""
    raw = _sheet(spark, sf_dir)
    ahead = F.trim(F.lower("Plant Name")) == PLANT.lower()
    first = raw.where(ahead | (parse_timestamp(F.col("Timestamp")) <= _ts_col(CUTOFFS[0])))
    target, state, marks = (fresh_dir(spark, n) for n in ("fact", "hwm", "marks"))
    for sheet, run_ts in ((first, RUN_TIMES[0]), (raw, RUN_TIMES[1])):
        P.run(spark, sheet, target, state, run_ts=run_ts, marks_path=marks, parse_partitions=_cores(spark))
    return UP.read_table(spark, target).select(*K.TARGET_COLUMNS)


# -- daily averages from changes ----------------------------------------------------------------

# The second batch revises stored readings: a value goes, one comes, one changes.
_REVISED = {
    "moisture_sensor": "case when minute(timestamp) % 3 = 0 then null else moisture_sensor end",
    "confidence_score_pct": "coalesce(confidence_score_pct, 50)",
    "temperature": "temperature + 1",
}


def _revised_sql() -> str:
    cols = ", ".join(f"case when timestamp >= TIMESTAMP '{UPSERT_LO}' then {e} else {c} end as {c}" for c, e in _REVISED.items())
    return f"(select * replace ({cols}) from C)"


@register("daily_averages_incremental", REGISTRY["daily_averages"][1].replace(" from C group by all", f" from {_revised_sql()} group by all"))
def daily_averages_incremental(spark, sf_dir):
    """The daily view kept by changes: two upserts, the second one replacing stored readings."""
    clean = _clean(spark, sf_dir)
    first = clean.where(F.col("timestamp") < _ts_col(UPSERT_HI))
    second = clean.where(F.col("timestamp") >= _ts_col(UPSERT_LO)).withColumns({c: F.expr(e) for c, e in _REVISED.items()})
    target, sums = fresh_dir(spark, "fact"), fresh_dir(spark, "rollup")
    for batch in (first, second):
        source, _, dates = P.stage_with_dates(CL.to_target(batch))
        change = RU.stage_changes(spark, source, target, dates)
        UP.upsert(spark, source, target, dates)
        RU.apply_changes(spark, change, sums)
    return RU.daily_averages(RU.read_rollup(spark, sums))


# -- JSON matrices ---------------------------------------------------------------------------------

DOC_ROWS, LONG_MOD, EMPTY_MOD = 4000, 31, 97


@register("grid_values_matrix", q("select " + ", ".join([
    f"case when _row_no % {EMPTY_MOD} <> 0 then _row_no end as _row_no",
    *[f"""case when _row_no % {EMPTY_MOD} = 0{f' or _row_no % {SHORT_MOD} = 0' if c in K.RAW_COLUMNS[-2:] else ''}
      then '' else "{c}" end as "{c}\"""" for c in K.RAW_COLUMNS],
    f"""case when _row_no % {LONG_MOD} = 0 and _row_no % {SHORT_MOD} <> 0 and _row_no % {EMPTY_MOD} <> 0
      then '["more"]' end as {K.EXTRA_COL}"""]) + " from R"))
def grid_values_matrix(spark, sf_dir):
    """Documents of ragged rows: full, short, long and empty ones, the header in the data."""
    raw, path = _grid_frame(_raw(spark, sf_dir)), fresh_dir(spark, "matrix")
    full = F.array(*[F.col(f"`{c}`") for c in GRID_CELLS])
    rid = F.col(K.ROW_NO)
    row = (F.when(rid % EMPTY_MOD == 0, F.array().cast("array<string>"))
           .when(rid % SHORT_MOD == 0, F.slice(full, 1, len(GRID_CELLS) - 2))
           .when(rid % LONG_MOD == 0, F.concat(full, F.array(F.lit(""), F.lit("more")))).otherwise(full))
    MX.write_matrix(raw, path, GRID_CELLS, F.floor(rid / DOC_ROWS), rid, row)
    g = MX.read_matrix(spark, path, GRID_CELLS)
    return g.select(F.col("Row").try_cast("long").alias(K.ROW_NO), *K.RAW_COLUMNS, K.EXTRA_COL)


# -- streaming state -----------------------------------------------------------------------------------

DELAY = "1 day"
# Three deliveries: two spans of time, then the rest with all copies, most of them late.
_STEP_SQL = (f"case when _row_no % 2 = 1 then 3 when timestamp < TIMESTAMP '{STREAM_SPLITS[0]}' then 1 "
             f"when timestamp < TIMESTAMP '{STREAM_SPLITS[1]}' then 2 else 3 end")
_STREAM_SQL = f""",
P as (select *, {_STEP_SQL} as step, date_trunc('day', timestamp) + interval 1 day as day_end from V),
W as (select max(timestamp) filter (where step < 3) - interval {DELAY} as closed from P),
L as (select P.* from P, W where not (step = 3 and day_end <= closed)),
E as (select max(timestamp) - interval {DELAY} as closed from L)
"""


def _stream_q(body: str) -> str:
    return q("").rstrip() + _STREAM_SQL + body


def _deliveries(spark, sf_dir, order=(1, 2, 3)):
    raw = _grid_frame(_raw(spark, sf_dir))
    ts = parse_timestamp(F.col("Timestamp"))
    lo, hi = (_ts_col(s) for s in STREAM_SPLITS)
    step = F.when(F.col(K.ROW_NO) % 2 == 1, 3).when(ts < lo, 1).when(ts < hi, 2).otherwise(3)
    return [raw.where(step == k) for k in order]


def _fed(spark, sf_dir, delay, after, order=(1, 2, 3)):
    """Deliver, feed, and run ``after(feed path)``, three times: each is a restart of all streams."""
    src, feed, rej = (fresh_dir(spark, n) for n in ("landing", "feed", "rejects"))
    for k, part in enumerate(_deliveries(spark, sf_dir, order)):
        G.write_grid(part, f"{src}/{k}", GRID_CELLS)
        ST.finish(ST.start_feed(spark, src, feed, rej, delay, names=GRID_CELLS, ordinal="Row", run_ts=RUN_TS))
        if after:
            ST.finish(after(feed))
    return feed, rej


@register("stream_daily_window", _stream_q(
    "select reading_date, plant_name, count(*) as reading_count, "
    + ", ".join(f"{_avg_sql(src)} as {out}" for out, src in V.DAILY_AVERAGES.items())
    + f""" from (select *, cast(timestamp as date) as reading_date from (
        select *, row_number() over (partition by timestamp, plant_name order by _row_no desc) as rn from L)
      where rn = 1 and not ({ALL_NULL_SQL})), E where day_end <= closed group by all"""))
def stream_daily_window(spark, sf_dir):
    """Daily averages of the days that the watermark has closed, from the state store."""
    out = fresh_dir(spark, "daily")
    _fed(spark, sf_dir, DELAY, lambda feed: ST.start_daily_windows(spark, feed, out, DELAY))
    return spark.read.parquet(out)


@register("stream_late_events", _stream_q(
    f"select _row_no, '{K.LATE_EVENT}' as {K.REJECT_COL} from P, W where step = 3 and day_end <= closed"))
def stream_late_events(spark, sf_dir):
    """Rows whose day was closed when they came."""
    _, rej = _fed(spark, sf_dir, DELAY, None)
    late = spark.read.parquet(rej).where(F.col(K.REJECT_COL) == K.LATE_EVENT)
    return late.select(K.ROW_NO, K.REJECT_COL)


@register("stream_keep_last", REGISTRY["upsert_last_wins"][1])
def stream_keep_last(spark, sf_dir):
    """Keep-last in streaming state: the later rows are delivered first."""
    target = fresh_dir(spark, "fact")
    _fed(spark, sf_dir, "3650 days", lambda feed: ST.start_keep_last(spark, feed, target, "3650 days", RUN_TS), order=(3, 1, 2))
    return UP.read_table(spark, target).select(*K.TARGET_COLUMNS)


# -- maintenance, layouts by vote, defaults -----------------------------------------------

@register("compact_state_log", q(
    f"""select '{K.PIPELINE_NAME}' as pipeline_name, max(timestamp) as last_watermark,
      TIMESTAMP '{RUN_TS}' as updated_at, true as packed from C group by cast(timestamp as date)"""))
def compact_state_log(spark, sf_dir):
    """A log of a mark for each day, a file each, packed: the same rows in fewer files."""
    path = fresh_dir(spark, "hwm")
    marks = (_clean(spark, sf_dir).groupBy(F.to_date("timestamp").alias("d")).agg(F.max("timestamp").alias("last_watermark")))
    rows = marks.select("d", F.lit(K.PIPELINE_NAME).alias("pipeline_name"), "last_watermark",
                        F.lit(RUN_TS).cast(T.TimestampNTZType()).alias("updated_at"))
    rows.repartition(64, "d").drop("d").write.mode("append").parquet(path)
    before = CP.compact_log(spark, path, K.STATE_SCHEMA)
    log = H.state_log(spark, path)
    return log.withColumn("packed", F.lit(len(log.inputFiles()) < before))


@register("compact_days", q(
    """select *, 1::bigint as files from (select * exclude (_row_no) from C)"""))
def compact_days(spark, sf_dir):
    """Days of many files, each rewritten as one."""
    path = fresh_dir(spark, "fact")
    rows = CL.with_partition(_clean(spark, sf_dir))
    (rows.repartition(5, "plant_name").write.partitionBy(K.PARTITION_COL).parquet(path))
    CP.compact_days(spark, path, at_least=2)
    table = UP.read_table(spark, path)
    return table.join(CP.files_per_day(table), K.PARTITION_COL).select(*K.TARGET_COLUMNS, "files")


# Three sheets out of the events: day-first, month-first, and month-first with no day after
# the 12th, of which no vote can tell the order.
_SHEETS_SQL = """with e as (select event_id, date_trunc('second', ts) as t,
    case when event_id % 3 = 0 then 'day-first' when event_id % 3 = 1 or day(ts) > 12 then 'month-first'
         else 'unclear' end as sheet from events)"""


def _sheets(spark, sf_dir):
    e = read_table(spark, sf_dir, "events").select("event_id", F.date_trunc("second", "ts").alias("t"))
    rest = (F.col("event_id") % 3 == 1) | (F.dayofmonth("t") > 12)
    sheet = F.when(F.col("event_id") % 3 == 0, "day-first").when(rest, "month-first").otherwise("unclear")
    cell = F.when(F.col("event_id") % 3 == 0, F.date_format("t", "dd/MM/yyyy HH:mm:ss")).otherwise(
        F.date_format("t", "M/d/yyyy H:mm:ss"))
    return e.select("event_id", sheet.alias("sheet"), F.when(F.col("event_id") % 101 == 0, "NOT A DATE").otherwise(cell)
                    .alias("Timestamp"))


@register("layout_votes", _SHEETS_SQL + """
select sheet as source, count(*) as n_cells, count(*) filter (event_id % 101 <> 0) as n_votes,
  case sheet when 'day-first' then 'd/M/yyyy H:mm:ss' when 'month-first' then 'M/d/yyyy H:mm:ss'
    else 'd/M/yyyy H:mm:ss|M/d/yyyy H:mm:ss' end as layouts
from e group by sheet""")
def layout_votes(spark, sf_dir):
    found = LY.votes(_sheets(spark, sf_dir), F.col("Timestamp"), F.col("sheet"))
    return found.withColumn("layouts", F.array_join("layouts", "|"))


@register("cast_timestamp_voted", _SHEETS_SQL + """
select event_id, case when event_id % 101 <> 0 and (sheet <> 'unclear' or day(t) = month(t)) then t end as timestamp
from e""")
def cast_timestamp_voted(spark, sf_dir):
    settled = LY.settle(_sheets(spark, sf_dir), F.col("sheet"))
    return settled.select("event_id", parse_timestamp("Timestamp", [K.ISO]).alias("timestamp"))


@register("sql_column_defaults", q(
    "select timestamp, plant_name, status, true as filled, true as empty from C"))
def sql_column_defaults(spark, sf_dir):
    """INSERT INTO without the audit column: the table's default fills it, other columns stay empty."""
    path = fresh_dir(spark, "fact")
    name = f"{SQ.FACT_TABLE}_{path.rsplit('-', 1)[-1]}"
    spark.sql(SQ.ddl(name, K.TABLE_SCHEMA, path, K.PARTITION_COL))
    _clean(spark, sf_dir).createOrReplaceTempView(f"{name}_in")
    spark.sql(f"INSERT INTO {name} (timestamp, plant_name, status, {K.PARTITION_COL}) "
              f"SELECT timestamp, plant_name, status, to_date(timestamp) FROM {name}_in")
    spark.catalog.dropTempView(f"{name}_in")
    return spark.table(name).select("timestamp", "plant_name", "status", F.col(K.AUDIT_COL).isNotNull().alias("filled"),
                                    F.col("humidity").isNull().alias("empty"))


# -- cells without a column, layouts for other access paths -------------------------------

_NOTE_SQL = """case when _row_no % 3 = 0 then 'note ' || _row_no end"""
_SERIAL_SQL = """case when _row_no % 5 <> 0 then 'SN-' || (_row_no % 1000) end"""


def _with_other_headers(raw):
    """The grid with two columns of which the contract knows nothing."""
    rid = F.col(K.ROW_NO)
    return raw.withColumns({
        " Note ": F.when(rid % 3 == 0, F.concat(F.lit("note "), rid.cast("string"))).otherwise(""),
        "Sensor Serial": F.when(rid % 5 != 0, F.concat(F.lit("SN-"), (rid % 1000).cast("string")))})


@register("stored_unmapped", q(f"""
select timestamp, plant_name, case when timestamp >= TIMESTAMP '{UPSERT_LO}' then 'Revised' else status end as status,
  {_NOTE_SQL} as note,
  case when timestamp >= TIMESTAMP '{UPSERT_LO}' then 'new' else {_SERIAL_SQL} end as serial from C"""))
def stored_unmapped(spark, sf_dir):
    """Cells under unknown headers, read from the stored table after an upsert has replaced some rows."""
    raw, path = _with_other_headers(_raw(spark, sf_dir)), fresh_dir(spark, "fact")
    revised = raw.withColumns({"Sensor Serial": F.lit("new"), "Status": F.lit("revised")})
    at = F.col("timestamp")
    for grid, part in ((raw, at < _ts_col(UPSERT_HI)), (revised, at >= _ts_col(UPSERT_LO))):
        rows = CL.typed(CL.with_unmapped(grid), parse_partitions=_cores(spark))
        P.stage_and_upsert(spark, CL.clean_typed(rows, RUN_TS).where(part), path)
    stored = UP.read_table(spark, path, unmapped=True)
    return stored.select("timestamp", "plant_name", "status",
                         F.try_variant_get(K.UNMAPPED_COL, "$.Note", "string").alias("note"),
                         F.try_variant_get(K.UNMAPPED_COL, "$['Sensor Serial']", "string").alias("serial"))


def _refreshed(spark, sf_dir, layout):
    """A layout written from the stored table, then brought in step with an upsert."""
    table, copy = fresh_dir(spark, "fact"), fresh_dir(spark, "layout")
    UP.write_partitions(CL.with_partition(_upsert_target(spark, sf_dir)), table)
    AC.refresh(spark, table, copy, layout)
    source, _, dates = P.stage_with_dates(_upsert_source(spark, sf_dir))
    UP.upsert(spark, source, table, dates)
    AC.refresh(spark, table, copy, layout, dates)
    return AC.read_layout(spark, copy, layout)


@register("layout_plant_history", q(f"select * from ({_UPSERT_SQL}) where plant_name = '{PLANT}'"))
def layout_plant_history(spark, sf_dir):
    return AC.of_plant(_refreshed(spark, sf_dir, AC.BY_PLANT), PLANT).select(*K.TARGET_COLUMNS)


@register("layout_status", q(
    f"select timestamp, plant_name, status, confidence_score_pct from ({_UPSERT_SQL}) where status = 'Wilted'"))
def layout_status(spark, sf_dir):
    return V.status_filter(_refreshed(spark, sf_dir, AC.BY_STATUS), "Wilted")
