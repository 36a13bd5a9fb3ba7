"""String cleaning expressions (JVM-side, codegen-friendly).

``strip`` removes Unicode whitespace at both ends (Spark's ``trim`` only
removes U+0020).  ``title_case`` upper-cases the first letter of every run
of cased letters and lower-cases the rest, so ``plant-1a`` becomes
``Plant-1A`` and ``o'neil`` becomes ``O'Neil`` (``initcap`` splits on
spaces only and would give ``Plant-1a``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's ``str.strip()`` removes, i.e. every
# code point whose ``isspace()`` is true (Unicode White_Space plus the
# separators U+001C..U+001F).  tests/test_functions.py re-derives the set.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# A word is a run of cased letters (upper, lower or title case).
_UNCASED = r"([^\p{Lu}\p{Ll}\p{Lt}])"
# U+FFFF is a Unicode noncharacter: never valid in interchanged text, so it
# can mark the spaces this module inserts.
_MARK = "\uffff "


def _sql_str(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _ident(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def strip_sql(x: str) -> str:
    """SQL text of ``strip`` over the SQL expression ``x``."""
    return f"btrim({x}, {_sql_str(WHITESPACE)})"


def title_sql(x: str) -> str:
    """SQL text of ``title_case`` over the SQL expression ``x``."""
    spaced = f"regexp_replace({x}, {_sql_str(_UNCASED)}, {_sql_str('$1' + _MARK)})"
    return f"replace(initcap({spaced}), {_sql_str(_MARK)}, '')"


def strip(c: Column | str) -> Column:
    if isinstance(c, str):                       # one JVM call for a column name
        return F.expr(strip_sql(_ident(c)))
    # btrim with a character set: a per-character test, no regex engine.
    return F.btrim(c, F.lit(WHITESPACE))


def title_case(c: Column | str) -> Column:
    """Python ``str.title`` semantics with codegen-only built-ins.

    ``initcap`` capitalises the letter after a space; putting a marked
    space after every uncased character makes every cased run start a
    word, and the marks are removed afterwards.
    """
    if isinstance(c, str):
        return F.expr(title_sql(_ident(c)))
    spaced = F.regexp_replace(c, _UNCASED, "$1" + _MARK)
    return F.replace(F.initcap(spaced), F.lit(_MARK), F.lit(""))


def clean_text(c: Column | str) -> Column:
    """strip then title-case; NULL stays NULL."""
    if isinstance(c, str):
        return F.expr(title_sql(strip_sql(_ident(c))))
    return title_case(strip(c))
