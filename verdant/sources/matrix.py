"""Grids as a spreadsheet service sends them: JSON documents that hold an array of
ragged rows, the first of which is the header.

A document is ``{"values": [[...], ...]}`` (with any other fields) or the array
alone.  Conventions as for CSV grids: header names are trimmed, every cell is text
(numbers and booleans by their JSON text), short rows are padded with empty text,
surplus cells are kept in ``_extra``, a document without rows gives none, and each
document is mapped by its own header.  Each row gets the ordinal of the CSV reader:
(time of change, file, block, position).  Spark parses the documents; no Python
runs in tasks.  A document is one row of one task: the service sends a
sheet at a time.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import contract as K

_ROWS = "array<array<string>>"


def _matrix(text: Column) -> Column:
    inside = F.from_json(text, f"values {_ROWS}")["values"]
    return F.when(F.ltrim(text).startswith("["), F.from_json(text, _ROWS)).otherwise(inside)


def read_documents(spark: SparkSession, path: str, modified_after: dt.datetime | None = None) -> DataFrame:
    """(header, place, cells) of every data row under ``path``."""
    docs = spark.read.option("wholetext", "true").option("recursiveFileLookup", "true").text(path)
    docs = docs.select("value", F.col("_metadata.file_modification_time").alias("modified"),
                       F.col("_metadata.file_path").alias("file"))
    if modified_after is not None:
        docs = docs.where(F.col("modified") > F.lit(f"{modified_after}+00:00").cast("timestamp"))
    docs = docs.select("modified", "file", _matrix(F.col("value")).alias("m")).where(F.size("m") > 1)
    names = F.transform(F.get("m", F.lit(0)), lambda c: F.trim(F.coalesce(c, F.lit(""))))
    # the body is a column of its own, so that the rows made of it do not carry the document
    docs = docs.select("modified", "file", names.alias("header"), F.slice("m", F.lit(2), F.size("m")).alias("body"))
    rows = docs.select("modified", "file", "header", F.posexplode("body").alias("at", "cells"))
    place = F.struct("modified", "file", F.lit(0).cast("long").alias("block"), F.col("at").cast("long").alias("row"))
    return rows.select("header", place.alias(K.ROW_NO), F.coalesce("cells", F.array().cast("array<string>")).alias("cells"))


def read_matrix(spark: SparkSession, path: str, names: Sequence[str] | None = None,
                modified_after: dt.datetime | None = None) -> DataFrame:
    """JSON matrices -> text columns + ``_extra`` + ``_row_no``, as ``grid.read_grid``.

    ``names`` fixes the columns (default: the contract's); one that a document's header
    lacks is NULL there.  Of equal names in a header the first counts."""
    rows = read_documents(spark, path, modified_after)
    width = F.size("header")

    def cell(name: str) -> Column:
        at = F.array_position("header", name).cast("int")
        return F.when(at > 0, F.coalesce(F.get("cells", at - 1), F.lit(""))).alias(name)

    past = F.filter(F.slice("cells", width + 1, F.size("cells")), lambda c: c.isNotNull() & (c != ""))
    extra = F.when((F.size("cells") > width) & (F.size(past) > 0), F.to_json(past))
    return rows.select(K.ROW_NO, *[cell(n) for n in names or K.RAW_COLUMNS], extra.alias(K.EXTRA_COL))


def write_matrix(df: DataFrame, path: str, cells: Sequence[str], document: Column, order: Column,
                 row: Column | None = None) -> None:
    """Write rows as JSON matrices, one per value of ``document``; rows stand by ``order``.
    ``row`` may give a row's cells (default: all ``cells``).  A document's rows meet in a task."""
    full = F.array(*[F.col(f"`{c}`") for c in cells])
    each = df.select(document.alias("d"), F.struct(order.alias("o"), (full if row is None else row).alias("c")).alias("r"))
    rows = F.transform(F.array_sort(F.collect_list("r")), lambda r: r["c"])
    head = F.array(F.array(*[F.lit(c) for c in cells]))
    doc = F.to_json(F.struct(F.lit("Sheet1").alias("range"), F.concat(head, rows).alias("values")))
    (each.groupBy("d").agg(doc.alias("value")).repartition("d").write.mode("overwrite").partitionBy("d").text(path))
