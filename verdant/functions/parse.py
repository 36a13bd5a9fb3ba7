"""Coercing parsers and time helpers, all built-in expressions.

Every parser is total: bad input becomes NULL, never an error, so a
single dirty cell cannot fail a job (ANSI mode is on by default).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..contract import ISO, NUMERIC_SCALE, TIMESTAMP_FORMATS
from .text import WHITESPACE, _ident, _sql_str, strip

# Plain decimal or scientific number; rejects 'nan', 'inf', '1d', '1,000', '5%'.
NUMBER_RE = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


# Year first, '-' or '/' between the date parts; time only behind a full date.
ISO_RE = r"^[0-9]{4}([-/])[0-9]{1,2}\1[0-9]{1,2}([ T].+)?$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _layout_sql(txt: str, layout: str) -> str:
    """SQL of one layout: TIMESTAMP (UTC session), NULL if the text doesn't fit."""
    if layout == ISO:
        return (f"CASE WHEN {txt} RLIKE {_sql_str(ISO_RE)} "
                f"THEN try_cast(replace({txt}, '/', '-') AS TIMESTAMP) END")
    return f"try_to_timestamp({txt}, {_sql_str(layout)})"


def _layout(txt: Column, layout: str) -> Column:
    if layout == ISO:
        return F.when(txt.rlike(ISO_RE), F.replace(txt, F.lit("/"), F.lit("-")).try_cast(T.TimestampType()))
    return F.try_to_timestamp(txt, F.lit(layout))


def round_to_second(ts: Column | str) -> Column:
    """Round a TIMESTAMP_NTZ half-up to the whole second (DATETIME2(0))."""
    ts = _col(ts)
    shifted = ts + F.expr("INTERVAL '0.5' SECOND")
    # date_trunc yields TIMESTAMP; with a UTC session the NTZ cast is exact.
    return F.date_trunc("second", shifted).cast(T.TimestampNTZType())


def parse_timestamp(c: Column | str, formats: Sequence[str] = TIMESTAMP_FORMATS,
                    round_seconds: bool = True, stripped: bool = False) -> Column:
    """Text -> TIMESTAMP_NTZ using an ordered list of layouts; NULL if none fit.

    ``stripped=True`` skips the whitespace strip when the caller already
    projected stripped text (each layout re-reads the input).
    """
    if isinstance(c, str):
        # Same expression as SQL text: one JVM call instead of one per node.
        txt = _ident(c) if stripped else f"btrim({_ident(c)}, {_sql_str(WHITESPACE)})"
        tries = ", ".join(_layout_sql(txt, f) for f in formats)
        ts = f"cast(coalesce({tries}) as timestamp_ntz)"
        if round_seconds:
            ts = f"cast(date_trunc('second', {ts} + INTERVAL '0.5' SECOND) as timestamp_ntz)"
        return F.expr(ts)
    txt = _col(c) if stripped else strip(_col(c))
    tries = [_layout(txt, f) for f in formats]
    ts = (F.coalesce(*tries) if len(tries) > 1 else tries[0]).cast(T.TimestampNTZType())
    return round_to_second(ts) if round_seconds else ts


def parse_number(c: Column | str, stripped: bool = False) -> Column:
    """Text -> DOUBLE; anything that is not a plain finite number is NULL.

    Cells that already are a bare number take the short path (one regex
    test, one cast); only the others pay for the Unicode strip.
    """
    if isinstance(c, str):
        # Same expression as SQL text: one JVM call instead of one per node.
        x, pat = _ident(c), _sql_str(NUMBER_RE)
        sql = f"CASE WHEN {x} RLIKE {pat} THEN try_cast({x} AS DOUBLE)"
        if not stripped:
            t = f"btrim({x}, {_sql_str(WHITESPACE)})"
            sql += f" WHEN {t} RLIKE {pat} THEN try_cast({t} AS DOUBLE)"
        return F.expr(sql + " END")
    raw = _col(c)
    bare = F.when(raw.rlike(NUMBER_RE), raw.try_cast(T.DoubleType()))
    if stripped:
        return bare
    txt = strip(raw)
    return F.when(raw.rlike(NUMBER_RE), raw.try_cast(T.DoubleType())).when(
        txt.rlike(NUMBER_RE), txt.try_cast(T.DoubleType()))


def nan_to_null(c: Column | str) -> Column:
    """NaN and +/-Infinity -> NULL (a DECIMAL column can hold neither)."""
    c = _col(c)
    return F.when(~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))), c)


def to_decimal(c: Column | str, precision: int, scale: int = NUMERIC_SCALE) -> Column:
    """DOUBLE -> DECIMAL(p, s), rounding half-up; overflow, NaN and Inf become NULL."""
    if isinstance(c, str):
        return F.expr(f"try_cast({_ident(c)} AS DECIMAL({precision},{scale}))")
    return c.try_cast(T.DecimalType(precision, scale))


def format_timestamp(ts: Column | str, pattern: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    return F.date_format(_col(ts), pattern)


def iso_timestamp(ts: Column | str) -> Column:
    """ISO-8601 text; fraction printed only when non-zero (as ``isoformat``)."""
    ts = _col(ts)
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    frac = F.date_format(ts, ".SSSSSS")
    return F.when(ts.isNull(), None).when(frac == ".000000", whole).otherwise(
        F.concat(whole, frac))
