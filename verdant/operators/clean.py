"""Raw grid -> typed, cleaned readings.

Order is semantic and follows the source pipeline: rename -> timestamp
parse (bad rows out) -> numeric parse -> string cleaning -> keep-last
dedup on (timestamp, plant_name) -> drop rows whose sensors are all empty
-> audit column.  Dedup runs after name cleaning (so ``plant 1 `` and
``Plant 1`` collide) and before the empty-row drop (so an all-empty last
duplicate removes the key).  A row with more cells than its header, or with
a number that its column can't hold, goes to the rejects before the dedup.

Three plans share the same expressions:

* ``clean`` keeps only surviving rows.  Its dedup is a ``row_number() = 1``
  window, which Catalyst plans as WindowGroupLimit *partial* (before the
  shuffle) + *final*: a hot key is cut to one row per map task before it
  is shuffled.
* ``rejects`` names why a row was dropped.  Only keys with two rows or more
  are joined back, each to ``SALTS`` parts of its rows, so a hot key is
  spread over as many tasks; all other rows pass no join.
* ``stage_counts`` needs no join: one row per key from a two-phase
  aggregate, then a global one.
"""

from __future__ import annotations

import logging
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import contract as K
from ..functions import clean_text, parse_number, parse_timestamp, to_decimal
from ..functions.text import _ident
from ..session import fresh_dir

log = logging.getLogger(__name__)

SALTS = 16      # parts that the rows of a repeated key are dealt over in a join


# -- projections -------------------------------------------------------------

def strip_headers(df: DataFrame) -> DataFrame:
    """Header names trimmed of surrounding whitespace."""
    return df.toDF(*[c.strip() for c in df.columns])


def _renamed(columns: Sequence[str]) -> dict[str, str]:
    """Source column -> output name: headers trimmed, then mapped."""
    return {c: K.RENAME_MAP.get(c.strip(), c.strip()) for c in columns}


def missing_columns(df: DataFrame) -> list[str]:
    names = set(_renamed(df.columns).values())
    return [c for c in K.RENAME_MAP.values() if c not in names]


def rename_columns(df: DataFrame) -> DataFrame:
    """Sheet headers -> column names; unmapped columns are kept.

    Expected columns that are absent are reported and added as NULL text,
    so later steps and the fixed write projection never break.  A missing
    ``timestamp`` fails before any job starts.  One projection.
    """
    mapping = _renamed(df.columns)
    missing = [c for c in K.RENAME_MAP.values() if c not in set(mapping.values())]
    if "timestamp" in missing:
        raise KeyError("no header maps to 'timestamp', the column that every reading needs")
    if missing:
        log.warning("columns absent from the grid, read as NULL: %s", ", ".join(missing))
    return df.selectExpr(*[f"{_ident(src)} AS {_ident(dst)}" for src, dst in mapping.items()],
                         *[f"CAST(NULL AS STRING) AS {_ident(c)}" for c in missing])


def with_row_no(df: DataFrame) -> DataFrame:
    """The frame as it is; raises without an input ordinal (higher = later).

    Spark rows have no order of their own, so "the later row wins" needs one
    from the source: the file readers add it, other frames bring it along."""
    if K.ROW_NO not in df.columns:
        raise ValueError(f"the grid has no {K.ROW_NO} column, so 'later' is not defined")
    return df


def with_cells(raw: DataFrame) -> DataFrame:
    """Add ``_cells``: the row's text cells by header, as JSON (nothing that was read gets lost)."""
    return raw.withColumn(K.CELLS_COL, F.to_json(F.struct(*[
        F.col(_ident(c)) for c in raw.columns if c not in (K.ROW_NO, K.CELLS_COL)])))


def with_unmapped(raw: DataFrame) -> DataFrame:
    """Add ``unmapped``: the cells under headers that the contract does not name, as a
    VARIANT object by trimmed header, so that they reach the fact table.

    Cells stay the text that was read; empty ones are left out, and a row without any has
    NULL.  Of headers that trim to one name the first filled cell counts.  A sheet's own
    column called ``unmapped`` goes into the object as any other."""
    by_name: dict[str, list[str]] = {}
    for c, name in _renamed(raw.columns).items():
        if name not in K.RENAME_MAP.values() and c not in (K.ROW_NO, K.CELLS_COL, K.EXTRA_COL):
            by_name.setdefault(name, []).append(f"nullif({_ident(c)}, '')")
    if not by_name:
        return raw.withColumn(K.UNMAPPED_COL, F.lit(None).cast(T.VariantType()))
    cells = [(name, f"coalesce({', '.join(found)})") for name, found in by_name.items()]
    packed = F.parse_json(F.to_json(F.struct(*[F.expr(e).alias(name) for name, e in cells])))
    return raw.withColumn(K.UNMAPPED_COL, F.when(F.coalesce(*[F.expr(e) for _, e in cells]).isNotNull(), packed))


def holds_unmapped(df: DataFrame) -> bool:
    """Whether ``unmapped`` is there as the VARIANT object (a sheet may have a column of that name)."""
    return K.UNMAPPED_COL in df.columns and isinstance(df.schema[K.UNMAPPED_COL].dataType, T.VariantType)


def pinned(df: DataFrame) -> DataFrame:
    """The frame as it is, with filters above it left there.

    Catalyst moves a filter below a shuffle, and with it the parse that the filter compares:
    it would then run in the few tasks that read the source.  It moves none past a metric."""
    return df.observe(f"pinned-{uuid.uuid4().hex}", F.count(F.lit(1)).alias("rows"))


def typed(raw: DataFrame, formats: Sequence[str] = K.TIMESTAMP_FORMATS,
          parse_partitions: int | None = None) -> DataFrame:
    """Rename and parse every contract column.

    Two stacked projections (strip/parse -> narrow): each input cell is read
    by several expressions (format tries, regex guard, cast), and a separate
    projection makes Catalyst compute the parsed value once instead of once
    per reference.  Timestamps are rounded to the second before any key
    comparison; numbers are coerced (junk -> NULL) and narrowed to
    DECIMAL(p, 2).  ``_flaw`` says what makes a row unfit as a whole: more
    cells than the header, or a number that its column can't hold.

    ``parse_partitions`` deals the rows over so many tasks first (a shuffle):
    for a source of few unsplittable files, where parsing is the bottleneck.
    """
    df = with_row_no(rename_columns(raw))
    if parse_partitions:
        df = pinned(df.repartition(parse_partitions, K.ROW_NO))
    over = f"{_ident(K.EXTRA_COL)} IS NOT NULL" if K.EXTRA_COL in df.columns else "false"
    extra = [c for c in df.columns if c not in K.RENAME_MAP.values()
             and c not in (K.ROW_NO, K.FLAW_COL)]
    df = df.select(
        K.ROW_NO,
        parse_timestamp("timestamp", formats).alias("timestamp"),
        clean_text("plant_name").alias("plant_name"),
        clean_text("status").alias("status"),
        F.col("reading_time").cast(T.StringType()).alias("reading_time"),
        *[parse_number(c).alias(c) for c in K.NUMERIC_COLS], *extra)
    return df.select(
        K.ROW_NO, "timestamp", "plant_name", "status", "reading_time",
        *[to_decimal(c, K.NUMERIC_PRECISION[c]).alias(c) for c in K.NUMERIC_COLS],
        F.expr(f"CASE WHEN {over} THEN '{K.TOO_MANY_CELLS}' "
               f"WHEN {' OR '.join(map(_overflows, K.NUMERIC_COLS))} THEN '{K.OVERFLOW}' END")
        .alias(K.FLAW_COL), *extra)


def _overflows(c: str) -> str:
    """SQL: a parsed number that its DECIMAL can't hold (the cast is the output's, computed once)."""
    x = _ident(c)
    return f"({x} IS NOT NULL AND try_cast({x} AS DECIMAL({K.NUMERIC_PRECISION[c]},{K.NUMERIC_SCALE})) IS NULL)"


def base_reject_reason(max_future: str | None = None,
                       run_ts: str | None = None) -> Column:
    """Row-local reasons, first match wins; NULL = row is usable."""
    reason = (F.when(F.col("timestamp").isNull(), F.lit(K.BAD_TIMESTAMP))
              .when(F.col("plant_name").isNull(), F.lit(K.NULL_PLANT))
              .when(F.col(K.FLAW_COL).isNotNull(), F.col(K.FLAW_COL)))
    if max_future:
        now = _run_ts_col(run_ts)
        limit = now + F.expr(f"INTERVAL {max_future}")
        reason = reason.when(F.col("timestamp") > limit, F.lit(K.FUTURE_TIMESTAMP))
    return reason


def all_numeric_null() -> Column:
    return F.coalesce(*[F.col(c) for c in K.NUMERIC_COLS]).isNull()


def _run_ts_col(run_ts: str | None) -> Column:
    if run_ts is None:
        return F.current_timestamp().cast(T.TimestampNTZType())
    return F.lit(run_ts).cast(T.TimestampNTZType())


# -- row filters ---------------------------------------------------------------

def drop_bad_rows(df: DataFrame, max_future: str | None = None,
                  run_ts: str | None = None) -> DataFrame:
    return df.where(base_reject_reason(max_future, run_ts).isNull())


def dedup_keep_last(df: DataFrame, keys: Sequence[str] = K.KEY_COLS,
                    order_col: str = K.ROW_NO, partitions: int | None = None) -> DataFrame:
    """One row per key: the one with the highest ``order_col``.

    ``partitions`` deals the keys over so many tasks, for rows that shrink much when they are
    shuffled (all have the path of their file): AQE packs partitions by their shuffled bytes, and
    a task would sort many times as much.  Each key is first cut to one row per task of the
    source, which splits a hot key."""
    if partitions:
        df = df.withColumn("_task", F.spark_partition_id())
        df = _last(df.repartition(partitions, *keys, "_task"), [*keys, "_task"], order_col).drop("_task")
        df = df.repartition(partitions, *keys)
    return _last(df, keys, order_col)


def _last(df: DataFrame, keys: Sequence[str], order_col: str) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(F.col(order_col).desc())
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def drop_empty_rows(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    present = [c for c in (cols or K.NUMERIC_COLS) if c in df.columns]
    return df.dropna(how="all", subset=present) if present else df


def audit_ts(run_ts: str | None = None) -> Column:
    """Audit value: one timestamp per run (UTC, whole seconds)."""
    return F.date_trunc("second", _run_ts_col(run_ts)).cast(T.TimestampNTZType())


def add_metadata(df: DataFrame, run_ts: str | None = None) -> DataFrame:
    return df.withColumn(K.AUDIT_COL, audit_ts(run_ts))


def with_partition(df: DataFrame) -> DataFrame:
    return df.withColumn(K.PARTITION_COL, F.to_date("timestamp"))


def to_target(df: DataFrame, keep_row_no: bool = False,
              audit: Column | None = None) -> DataFrame:
    """Fixed write projection (16 columns in order, contract types; ``unmapped`` where it was kept).

    Column defaults: a missing or NULL audit timestamp becomes the current
    UTC time (whole seconds); any other missing column becomes NULL.
    """
    present = set(df.columns)
    exprs = [f"CAST({_ident(f.name) if f.name in present else 'NULL'} AS "
             f"{f.dataType.simpleString()}) AS {_ident(f.name)}"
             for f in K.TARGET_SCHEMA.fields if f.name != K.AUDIT_COL]
    if keep_row_no:
        exprs.append(_ident(K.ROW_NO))
    if audit is None:
        current = F.col(K.AUDIT_COL) if K.AUDIT_COL in present else F.lit(None)
        audit = F.coalesce(current.cast(T.TimestampNTZType()), audit_ts())
    kept = [K.UNMAPPED_COL] if holds_unmapped(df) else []
    out = df.select(*[F.expr(e) for e in exprs], audit.alias(K.AUDIT_COL), *kept)
    order = [*K.TARGET_COLUMNS, *kept, *([K.ROW_NO] if keep_row_no else [])]
    return out.select(*order)


# -- whole chains ------------------------------------------------------------

def clean_typed(t: DataFrame, run_ts: str | None = None,
                max_future: str | None = None, keep_row_no: bool = False) -> DataFrame:
    """Typed rows -> clean readings in the fact-table shape.

    Whether the key is valid is the same for every row of a key, and flawed
    rows are a window group of their own, so dropping invalid rows after the
    dedup equals dropping them before.  The flag ``_ok`` is not a window key,
    so Catalyst keeps that filter above the window instead of pushing a copy
    of the whole parse expression into the scan.  The keep-last window,
    the validity flag and the empty-row test share one filter.
    """
    ok = f"timestamp IS NOT NULL AND plant_name IS NOT NULL AND {K.FLAW_COL} IS NULL"
    if max_future:
        now = ("CAST(current_timestamp() AS TIMESTAMP_NTZ)" if run_ts is None
               else f"CAST('{run_ts}' AS TIMESTAMP_NTZ)")
        ok += f" AND timestamp <= {now} + INTERVAL {max_future}"
    t = t.selectExpr("*", f"({ok}) AS _ok",
                     f"row_number() OVER (PARTITION BY timestamp, plant_name, {K.FLAW_COL} IS NULL "
                     f"ORDER BY {_ident(K.ROW_NO)} DESC) AS _rn")
    nums = ", ".join(K.NUMERIC_COLS)
    t = t.where(f"_rn = 1 AND _ok AND coalesce({nums}) IS NOT NULL")
    return to_target(t, keep_row_no=keep_row_no, audit=audit_ts(run_ts))


def clean(raw: DataFrame, run_ts: str | None = None,
          formats: Sequence[str] = K.TIMESTAMP_FORMATS,
          max_future: str | None = None, keep_row_no: bool = False) -> DataFrame:
    """Raw grid -> clean readings in the fact-table shape."""
    return clean_typed(typed(raw, formats), run_ts, max_future, keep_row_no)


def rejects_typed(t: DataFrame, max_future: str | None = None,
                  run_ts: str | None = None) -> DataFrame:
    """Typed rows that do not reach the fact table, with ``reject_reason``.

    Rows with a reason of their own go straight out.  Of the rest only keys
    with two rows or more are looked up: their last row comes from a two-phase
    aggregate, and each key meets its rows in ``SALTS`` parts.  The rows are
    read once for each of the three outputs, so callers stage a costly source.
    """
    t = t.withColumn(K.REJECT_COL, base_reject_reason(max_future, run_ts))
    bad = t.where(F.col(K.REJECT_COL).isNotNull())
    good = t.where(F.col(K.REJECT_COL).isNull())
    part = F.pmod(F.xxhash64(K.ROW_NO), F.lit(SALTS))
    last = (good.groupBy(*K.KEY_COLS).agg(F.count(F.lit(1)).alias("_n"), F.max(K.ROW_NO).alias("_last"))
            .where("_n > 1").withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
            .select(*K.KEY_COLS, "_part", "_last"))
    on = [*K.KEY_COLS, "_part"]
    salted = good.withColumn("_part", part)
    older = (salted.join(last, on).where(F.col(K.ROW_NO) < F.col("_last"))
             .withColumn(K.REJECT_COL, F.lit(K.DUPLICATE)))
    empty = (salted.where(all_numeric_null()).join(last, on, "left")
             .where(F.col("_last").isNull() | (F.col(K.ROW_NO) == F.col("_last")))
             .withColumn(K.REJECT_COL, F.lit(K.ALL_NULL)))
    return bad.unionByName(older.select(bad.columns)).unionByName(empty.select(bad.columns))


def rejects(raw: DataFrame, formats: Sequence[str] = K.TIMESTAMP_FORMATS,
            max_future: str | None = None, run_ts: str | None = None,
            parse_partitions: int | None = None) -> DataFrame:
    """Rows that do not reach the fact table, with the reason.

    The typed rows are staged in the shared scratch folder: the outputs below
    then share one parse."""
    t = typed(raw, formats, parse_partitions)
    path = fresh_dir(t.sparkSession, "typed")
    t.write.parquet(path)
    return rejects_typed(t.sparkSession.read.schema(t.schema).parquet(path), max_future, run_ts)


def stage_counts(raw: DataFrame | None, typed_rows: DataFrame | None = None,
                 formats: Sequence[str] = K.TIMESTAMP_FORMATS,
                 max_future: str | None = None, run_ts: str | None = None) -> DataFrame:
    """One row of per-stage counts; ``rows_extracted`` is the sum of all others.

    One row per key (its rows, whether the last one is empty), one per reason
    for rows without a valid key, then one global aggregate.  No join.
    """
    t = typed(raw, formats) if typed_rows is None else typed_rows
    t = t.withColumn("_base", base_reject_reason(max_future, run_ts)).withColumn("_empty", all_numeric_null())
    keys = [F.when(F.col("_base").isNull(), F.col(c)).alias(c) for c in K.KEY_COLS]
    per_key = t.groupBy("_base", *keys).agg(
        F.count(F.lit(1)).alias("n"), F.max_by("_empty", K.ROW_NO).alias("empty"))
    base, zero = F.col("_base"), F.lit(0)

    def total(value: Column, name: str) -> Column:
        return F.coalesce(F.sum(value), zero).cast(T.LongType()).alias(name)

    def because(reason: str) -> Column:
        return total(F.when(base == reason, F.col("n")), f"rows_{reason}")

    kept = base.isNull()
    return per_key.agg(
        total(F.col("n"), "rows_extracted"),
        because(K.BAD_TIMESTAMP), because(K.NULL_PLANT), because(K.TOO_MANY_CELLS), because(K.OVERFLOW),
        because(K.FUTURE_TIMESTAMP),
        total(F.when(kept, F.col("n") - 1), f"rows_{K.DUPLICATE}"),
        total(F.when(kept & F.col("empty"), 1), f"rows_{K.ALL_NULL}"),
        total(F.when(kept & ~F.col("empty"), 1), "rows_clean"))


def null_profile(raw: DataFrame | None, formats: Sequence[str] = K.TIMESTAMP_FORMATS,
                 typed_rows: DataFrame | None = None) -> DataFrame:
    """NULL count per numeric column after parsing (rows with a valid timestamp)."""
    t = (typed(raw, formats) if typed_rows is None else typed_rows)
    t = t.where(F.col("timestamp").isNotNull())
    return t.agg(F.count(F.lit(1)).cast(T.LongType()).alias("rows"),
                 *[F.count_if(F.col(c).isNull()).cast(T.LongType()).alias(f"{c}_nulls")
                   for c in K.NUMERIC_COLS])
