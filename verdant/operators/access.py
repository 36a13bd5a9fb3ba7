"""Layouts for more than one access path: copies of the readings ordered for their readers.

The fact table is kept by day, which serves the upsert and time ranges.  One plant's
history or all readings in one status meet every day of it.  A layout is a copy by month
(``reading_month``), with the columns its readers need, in an order that keeps what they
ask for together:

* ``BY_PLANT`` holds all columns in Z-order of (plant, time): a plant's bucket and the
  part of the month, bits interleaved.  Reading one plant meets a row of squares, reading
  a span of time a column of them, instead of everything.  Equal hashes are no range, so
  the row groups of a plant are found by Parquet's dictionaries, or by its bloom filter
  where a column has too many values for a dictionary.
* ``BY_STATUS`` holds the four columns of the status report, in order of status and time.

Rows are dealt by ranges of that order, time included, so a plant or status with a third
of all rows is spread over many tasks and files.  A layout holds nothing of its own:
``refresh`` rewrites the months of the given dates from the fact table, and one that was
cut off is simply run again.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import contract as K
from ..session import path_exists
from .upsert import read_table

MONTH_COL = "reading_month"
Z_BITS = 8          # a month is cut into at most 256 spans of time and 256 buckets of plants


@dataclass(frozen=True)
class Layout:
    columns: tuple[str, ...]            # what the copy holds
    order: tuple[str, ...]              # SQL; time last, so equal values can be split
    blooms: tuple[str, ...] = ()        # columns looked up by single values
    distinct: int = 100_000             # expected values of such a column in a row group


def z_value(a: str, b: str, bits: int = Z_BITS) -> str:
    """SQL: the bits of two numbers below 2**bits, interleaved (Z-order)."""
    return " | ".join(f"shiftleft(shiftright({x}, {i}) & 1, {2 * i + at})" for i in range(bits) for at, x in ((1, a), (0, b)))


_PLANT_BUCKET = f"cast(pmod(xxhash64(plant_name), {1 << Z_BITS}) as int)"
_MONTH_SPAN = "((dayofmonth(timestamp) - 1) * 8 + cast(hour(timestamp) div 3 as int))"    # 3 hours, 248 at most

BY_PLANT = Layout(tuple(K.TARGET_COLUMNS), (z_value(_PLANT_BUCKET, _MONTH_SPAN), "timestamp"), blooms=("plant_name",))
BY_STATUS = Layout(("timestamp", "plant_name", "status", "confidence_score_pct"), ("status", "timestamp"))


def _month(day: str = "timestamp") -> Column:
    return F.date_format(day, "yyyy-MM")


def _schema(layout: Layout) -> T.StructType:
    return T.StructType([K.TARGET_SCHEMA[c] for c in layout.columns] + [T.StructField(MONTH_COL, T.StringType(), True)])


def write_layout(readings: DataFrame, path: str, layout: Layout, whole: bool = True, **parquet: str) -> None:
    """Write the readings in the layout's order; without ``whole`` only their months are replaced.

    ``parquet``: further writer options, such as the size of a row group."""
    order = [F.col(MONTH_COL), *[F.col(f"_o{i}") for i in range(len(layout.order))]]
    rows = readings.select(*layout.columns, _month().alias(MONTH_COL),
                           *[F.expr(e).alias(f"_o{i}") for i, e in enumerate(layout.order)])
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).select(*layout.columns, MONTH_COL)
    options = dict(parquet)
    for c in layout.blooms:
        options |= {f"parquet.bloom.filter.enabled#{c}": "true",
                    f"parquet.bloom.filter.expected.ndv#{c}": str(layout.distinct)}
    (rows.write.mode("overwrite").option("partitionOverwriteMode", "static" if whole else "dynamic")
     .options(**options).partitionBy(MONTH_COL).parquet(path))


def refresh(spark: SparkSession, table_path: str, path: str, layout: Layout,
            dates: Sequence[dt.date] | None = None, **parquet: str) -> list[str]:
    """Bring a layout in step with the fact table; the months rewritten.

    ``dates`` are the days that an upsert has touched: their months are read from the
    table (other days are pruned) and replaced.  Without dates, or where there is no
    layout yet, all of it is written.  No table: nothing is done."""
    table = read_table(spark, table_path)
    if table is None:
        return []
    if dates is None or path_exists(spark, f"{path}/_SUCCESS") is False:
        write_layout(table, path, layout, **parquet)
        return sorted(r[0] for r in read_layout(spark, path, layout).select(MONTH_COL).distinct().collect())
    months = sorted({d.strftime("%Y-%m") for d in dates})
    if months:
        day = F.col(K.PARTITION_COL)
        spans = [(dt.date(int(m[:4]), int(m[5:]), 1), m) for m in months]
        mine = None
        for first, _ in spans:      # bounds of dates, so the table's days are pruned
            span = (day >= F.lit(first)) & (day < F.add_months(F.lit(first), 1))
            mine = span if mine is None else mine | span
        write_layout(table.where(mine), path, layout, whole=False, **parquet)
    return months


def read_layout(spark: SparkSession, path: str, layout: Layout) -> DataFrame:
    return spark.read.schema(_schema(layout)).parquet(path)


def of_plant(copy: DataFrame, plant: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """One plant's readings, start <= timestamp < end where given; whole months are pruned."""
    rows = copy.where(F.col("plant_name") == plant)
    if start is not None:
        at = F.lit(start).cast(T.TimestampNTZType())
        rows = rows.where((F.col("timestamp") >= at) & (F.col(MONTH_COL) >= F.date_format(at, "yyyy-MM")))
    if end is not None:
        at = F.lit(end).cast(T.TimestampNTZType())
        rows = rows.where((F.col("timestamp") < at) & (F.col(MONTH_COL) <= F.date_format(at, "yyyy-MM")))
    return rows
