"""Quality rules: a threshold table compiled into one Spark projection.

``RULES`` lists, for each rule, a ratio of two whole-text counts and the least
and the most of it (in thousandths) that a good document has.  ``measured``
counts what the rules need and ``failed_rules`` turns the table into one
expression, so a document is read once and no user function runs.  Ratios are
compared as integer products: no rounding, and SQL gives the same verdicts.

Words are runs of anything but blank, tab, LF, VT, FF and CR; lines are parted
by LF.  A word belongs to a repeated passage if a three-word window over it is
found twice or more in the text; such words are counted by sorting the
windows, in n log n steps for any length of text.

Defined results: null and empty texts and texts without words have zero counts
and fail the base rules; a ratio with nothing below the line passes its rule;
repeated rows and null ids are judged each; other columns stay as they are
(in place of any column that has a result's name).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PARTS_WORDS = r"[\x20\x09-\x0D]+"
SYMBOL = r"[#*$%&|<>]"
MARK = r"[\x21-\x40\x5B-\x60\x7B-\x7E]"   # ASCII that is neither letter nor blank
CAPITAL = "[A-Z]"
REPEAT = 3          # words of a window
MIN_WORDS = 50
MAX_REPEATED = 50   # per cent of the words

# Frequent function words of four languages (fixed list); a word counts in lower case and capitalised.
STOP_WORDS = """
    a an and are as at be by for from has have he in is it not of on or that the this to was were which with you
    au aux ce dans de des du elle en est et il la le les ne par pas pour que qui se sur un une
    als auch auf aus das dem den der des die ein eine er es im ist mit nicht sich sie und von zu
    al como con del el ella es esta la las lo los no o para pero por que se su un una y
""".split()


@dataclass(frozen=True)
class Rule:
    """``least`` <= 1000 * part / whole <= ``most`` (None: no bound)."""

    name: str
    part: str
    whole: str
    least: int | None = None
    most: int | None = None


RULES = (
    Rule("word_length", "word_chars", "n_words", least=2_000, most=15_000),
    Rule("symbols_per_word", "n_symbols", "n_words", most=100),
    Rule("marks", "n_marks", "word_chars", most=250),
    Rule("stop_words", "n_stop_words", "n_words", least=20),
    Rule("capitals", "n_capitals", "word_chars", most=300),
    Rule("repeated_lines", "n_dup_lines", "n_lines", most=300),
    Rule("bullet_lines", "n_bullets", "n_lines", most=900),
    Rule("cut_off_lines", "n_ellipses", "n_lines", most=300),
)

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_marks", "n_capitals",
          "n_stop_words", "n_lines", "n_bullets", "n_ellipses")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, PARTS_WORDS), "")


def repeated_words(ws: Column, size: int = REPEAT) -> Column:
    """How many words lie in a window of ``size`` words that occurs twice or more in ``ws``
    (an array that is at hand, such as a lambda's variable)."""
    last = F.size(ws) - size
    at = F.sequence(F.lit(0), F.greatest(last, F.lit(0)))

    def window(i: Column) -> Column:
        return F.concat_ws(" ", *[F.get(ws, i + k) for k in range(size)])

    def twice(ordered: Column) -> Column:
        def same(x: Column, j: Column) -> Column:
            before, after = F.get(ordered, j - 1)["w"], F.get(ordered, j + 1)["w"]
            return F.coalesce(before == x["w"], F.lit(False)) | F.coalesce(after == x["w"], F.lit(False))

        return F.array_sort(F.transform(F.filter(ordered, same), lambda x: x["i"]))

    def covered(places: Column) -> Column:
        steps = F.transform(places, lambda p, j: F.least(F.coalesce(F.get(places, j + 1) - p, F.lit(size)), F.lit(size)))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda s, x: s + x)

    def counted(wins: Column) -> Column:
        placed = F.transform(wins, lambda w, i: F.struct(w.alias("w"), i.alias("i")))
        return F.when(F.size(F.array_distinct(wins)) == F.size(wins), F.lit(0).cast("long")).otherwise(
            let(F.sort_array(placed), lambda ordered: let(twice(ordered), covered)))

    return F.when(last >= 0, let(F.transform(at, window), counted)).otherwise(F.lit(0).cast("long"))


def _counts(text: Column) -> Column:
    """Struct of ``COUNTS`` (all long) of a text that is not null."""
    def lined(ls: Column) -> dict[str, Column]:
        return {
            "n_lines": F.size(ls), "n_dup_lines": F.size(ls) - F.size(F.array_distinct(ls)),
            "n_bullets": F.size(F.filter(ls, lambda s: s.rlike(r"^[\x20\t]*[-*•‣·][\x20\t]"))),
            "n_ellipses": F.size(F.filter(ls, lambda s: s.rlike(r"(\.\.\.|…)[\x20\x09-\x0D]*\z"))),
        }

    def worded(ws: Column) -> dict[str, Column]:
        return {
            "n_words": F.size(ws), "word_chars": F.length(F.array_join(ws, "")), "n_repeat_words": repeated_words(ws),
            "n_stop_words": F.size(F.filter(ws, lambda w: w.isin(*STOP_WORDS, *map(str.capitalize, STOP_WORDS)))),
        }

    whole = {"n_symbols": F.regexp_count(text, F.lit(SYMBOL)), "n_marks": F.regexp_count(text, F.lit(MARK)),
             "n_capitals": F.regexp_count(text, F.lit(CAPITAL))}
    lines = F.filter(F.split(text, "\n"), lambda s: s.rlike(r"[^\x20\x09-\x0D]"))

    def both(ws: Column) -> Column:
        def all_of(ls: Column) -> Column:
            got = {**whole, **worded(ws), **lined(ls)}
            return F.struct(*[got[c].cast("long").alias(c) for c in COUNTS])

        return let(lines, all_of)

    return let(words(text), both)


def base_failed(m: Column) -> Column:
    return (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > MAX_REPEATED * m["n_words"])


def failed_rules(m: Column, rules: Sequence[Rule] = RULES) -> Column:
    """Names of the rules that a struct of counts breaks, in the table's order."""
    found = []
    for r in rules:
        part, whole = m[r.part] * 1000, m[r.whole]
        broken = F.lit(False)
        if r.least is not None:
            broken = broken | (part < whole * r.least)
        if r.most is not None:
            broken = broken | (part > whole * r.most)
        found.append(F.when(broken & (whole > 0), F.lit(r.name)))
    return F.filter(F.array(*found), lambda x: x.isNotNull()) if found else F.array().cast("array<string>")


def judged(docs: DataFrame, text_col: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """Every row of ``docs`` with ``COUNTS``, base_failed, failed (names of broken rules) and kept."""
    def verdict(m: Column) -> Column:
        def last(failed: Column) -> Column:
            return F.struct(*[m[c].alias(c) for c in COUNTS], base_failed(m).alias("base_failed"), failed.alias("failed"),
                            (~base_failed(m) & (F.size(failed) == 0)).alias("kept"))

        return let(failed_rules(m, rules), last)

    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    made = {*COUNTS, "base_failed", "failed", "kept"}
    own = [c for c in docs.columns if c not in made]
    out = docs.select(*[docs[c] for c in own], let(_counts(text), verdict).alias("__judged"))
    return out.select(*own, "__judged.*")
