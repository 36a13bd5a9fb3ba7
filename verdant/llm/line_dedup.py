"""Line deduplication by overlapping three-line windows.

Windows run over a document's non-blank lines; a document of one or two such
lines is one window.  A window's key is the MD5 of its lines.  Of equal windows
anywhere, the first in the order of (doc id, position) stays, and every later
occurrence marks the lines it covers; marks of overlapping windows merge and
the marked lines go.

Counting is a two-phase aggregate and the join back splits hot keys (AQE), so a
window that a third of all documents share needs no single task.

Work grows with the lines of a text, not with their square.

Defined results: a null text stays null with no lines; blank lines are neither
compared nor removed; null ids come first in the order; rows that agree in id
and text are one document and come back once each, unchanged towards each other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 3


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def _windows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc, h, at: lines covered, key)"""
    lines = F.transform(_lines(F.col(text_col)), lambda s, i: F.struct(i.alias("i"), s.alias("s")))
    full = F.filter(lines, lambda x: F.trim(x["s"]) != "")
    base = docs.select(F.col(id_col).alias("doc"), F.xxhash64(F.col(text_col)).alias("h"), full.alias("ls"))
    base = base.filter(F.size("ls") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("ls") - WINDOW + 1, F.lit(1)))

    def window(k: Column) -> Column:
        run = F.slice(F.col("ls"), k, F.lit(WINDOW))
        return F.struct(F.transform(run, lambda x: x["i"]).alias("at"),
                        F.unhex(F.md5(F.array_join(F.transform(run, lambda x: x["s"]), "\n"))).alias("key"))

    wins = base.select("doc", "h", F.explode(F.transform(starts, window)).alias("w"))
    return wins.select("doc", "h", F.col("w.at").alias("at"), F.col("w.key").alias("key"))


def covered_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, h, gone): the line positions, from 0, that later occurrences cover."""
    wins = _windows(docs, id_col, text_col)
    place = F.struct("doc", "h", F.col("at")[0].alias("i"))
    first = (wins.groupBy("key").agg(F.count("*").alias("n"), F.min(place).alias("first"))
             .filter("n > 1").select("key", "first"))
    later = wins.join(first, "key").filter(~place.eqNullSafe(F.col("first")))
    return later.groupBy("doc", "h").agg(F.array_distinct(F.flatten(F.collect_set("at"))).alias("gone"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row of ``docs``: __text (what is left), __n_lines, __n_removed beside its own
    columns (and in place of any of those names)."""
    gone = covered_lines(docs, id_col, text_col).select(
        F.col("doc").alias("__doc"), F.col("h").alias("__h"), F.col("gone").alias("__gone"))
    same = docs[id_col].eqNullSafe(gone["__doc"]) & (F.xxhash64(docs[text_col]) == gone["__h"])
    lines = _lines(docs[text_col])
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone["__gone"])
    # the lines are split once; each kept place then takes its line
    left = F.transform(F.array(lines), lambda ls: F.array_join(F.transform(kept, lambda i: F.get(ls, i)), "\n"))[0]
    out = {"__text": F.when(gone["__gone"].isNull(), docs[text_col]).otherwise(left),
           "__n_lines": F.when(docs[text_col].isNull(), 0).otherwise(F.size(lines)).cast("long"),
           "__n_removed": F.coalesce(F.size(gone["__gone"]), F.lit(0)).cast("long")}
    return docs.join(gone, same, "left").select(
        *[docs[c] for c in docs.columns if c not in out], *[v.alias(k) for k, v in out.items()])


def strip_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the repeated lines gone; a document that loses all its
    non-blank lines goes.  Columns as they were (``n_chars``, if any, follows the text)."""
    out = dedup_lines(docs, id_col, text_col)
    emptied = (F.col("__n_removed") > 0) & (F.trim(F.replace(F.col("__text"), F.lit("\n"), F.lit(""))) == "")
    out = out.filter(~F.coalesce(emptied, F.lit(False))).withColumn(text_col, F.col("__text"))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("__n_removed") > 0, F.length(text_col)).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)
