"""Timestamp layouts settled by a vote of each source's own values.

``03/04/2025`` is day-first in one sheet and month-first in another, and no
cell says which.  All cells of a source together often do: one aggregate counts,
for each candidate layout, how many of the source's values it fits.  A layout
that fits every value that any candidate fits is in the running.  Where several
are, a value counts only if all of them read it alike; the others stay as text
and go to the rejects with it, so a tie is reported and never guessed.

Year-first values are the same in every layout's eyes: they have no vote and are
left alone, as are blank, null and junk cells.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import contract as K
from ..functions import parse_timestamp, strip
from ..functions.parse import ISO_RE
from ..functions.text import _ident

CANDIDATES = ("d/M/yyyy H:mm:ss", "M/d/yyyy H:mm:ss", "d/M/yyyy H:mm", "M/d/yyyy H:mm", "d/M/yyyy", "M/d/yyyy")
_SOURCE, _FITS = "__source", "__fits"


def _readings(text: Column, layouts: Sequence[str]) -> list[Column]:
    """The text read by each layout (NULL where it doesn't fit, or is year-first)."""
    cell = strip(text)
    return [F.when(~cell.rlike(ISO_RE), parse_timestamp(cell, [f], stripped=True)) for f in layouts]


def votes(cells: DataFrame, text: Column, source: Column, layouts: Sequence[str] = CANDIDATES) -> DataFrame:
    """(source, n_cells, n_votes, layouts): what each source's values agree on.

    ``n_votes`` counts the cells that some candidate fits; ``layouts`` are those
    that fit all of them, in the candidates' order (none: a source of mixed orders,
    or without votes).  Two phases, so a source that holds most rows costs a row a task."""
    read = cells.select(source.alias("source"), *[r.alias(f"_{i}") for i, r in enumerate(_readings(text, layouts))])
    names = [f"_{i}" for i in range(len(layouts))]
    counted = read.groupBy("source").agg(
        F.count("*").alias("n_cells"), F.count_if(F.coalesce(*names).isNotNull()).alias("n_votes"),
        *[F.count(n).alias(n) for n in names])
    fits = F.array_compact(F.array(*[F.when((F.col(n) == F.col("n_votes")) & (F.col("n_votes") > 0), F.lit(f))
                                     for n, f in zip(names, layouts)]))
    return counted.select("source", "n_cells", "n_votes", fits.alias("layouts"))


def settle(raw: DataFrame, source: Column, column: str = "Timestamp",
           layouts: Sequence[str] = CANDIDATES) -> DataFrame:
    """The grid with the cells of ``column`` that the vote settles as year-first text.

    All other cells stay as they are; parse the result with ``formats=[contract.ISO]``.
    The votes meet the rows in a join by source (null sources are one source): Spark
    broadcasts them while they are few, else AQE splits a hot source."""
    cell = F.col(_ident(column))
    found = votes(raw, cell, source, layouts).select(F.col("source").alias(_SOURCE), F.col("layouts").alias(_FITS))
    joined = raw.join(found, source.eqNullSafe(F.col(_SOURCE)), "left")
    read = [F.when(F.array_contains(_FITS, f), r) for f, r in zip(layouts, _readings(cell, layouts))]
    low, high = (F.least(*read), F.greatest(*read)) if len(read) > 1 else (read[0], read[0])
    iso = F.when(low == high, F.date_format(low, "yyyy-MM-dd HH:mm:ss"))
    return joined.select(*[F.coalesce(iso, cell).alias(c) if c == column else F.col(_ident(c)) for c in raw.columns])


def file_of(raw: DataFrame) -> Column:
    """The source of a grid's rows: the file in the readers' ordinal, or one source for all."""
    kind = raw.schema[K.ROW_NO].dataType
    return F.col(f"{K.ROW_NO}.file") if "file" in getattr(kind, "names", []) else F.lit("grid")
