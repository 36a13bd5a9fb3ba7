"""Chat formatting: heterogeneous records to one marked-up text per conversation.

A record is a VARIANT (from JSON text or from any struct).  Which of the known
nested field paths it holds is hashed into its *schema fingerprint*; the
fingerprint selects a declarative ``Layout`` that says where the turns are.
Only DataFrame functions run here.

Defined results: a record whose fingerprint no layout has gives ``layout``
null and no turns (formatted text empty), its fingerprint is reported; null
texts and roles are empty; an empty list of turns is a conversation without
turns; unknown roles pass through; a null record counts as one without fields.
Very long texts and conversations of very many turns take time close to their length.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass, field
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

END = "</turn>\n"
OPEN, AFTER_ROLE = "### ", ": "

# Names that datasets give to the three roles (fixed values).
ROLE_ALIASES = {
    "human": "user", "prompter": "user", "customer": "user",
    "gpt": "assistant", "bot": "assistant", "model": "assistant", "chatbot": "assistant",
}

TURNS = "array<struct<role:string,text:string>>"


@dataclass(frozen=True)
class Layout:
    """Where a record's turns are.

    A *list* layout names the list, and the role and text field of its items.
    A *field* layout lists (role, fields): the texts of one turn's non-empty
    fields are joined by a blank line; optional fields may be absent.
    """

    name: str
    items: str = ""
    role: str = ""
    text: str = ""
    fields: tuple[tuple[str, tuple[str, ...]], ...] = ()
    optional: tuple[str, ...] = field(default=())

    def paths(self) -> tuple[str, ...]:
        if self.items:
            return (f"{self.items}[].{self.role}", f"{self.items}[].{self.text}")
        return tuple(f for _, fs in self.fields for f in fs)

    def fingerprints(self) -> list[str]:
        must = [p for p in self.paths() if p not in self.optional]
        return [fingerprint_of([*must, *some]) for k in range(len(self.optional) + 1)
                for some in combinations(self.optional, k)]


LAYOUTS = (
    Layout("messages", items="messages", role="role", text="content"),
    Layout("nested_messages", items="chat.messages", role="role", text="content"),
    Layout("share", items="conversations", role="from", text="value"),
    Layout("turns", items="turns", role="role", text="text"),
    Layout("dialog", items="dialog", role="speaker", text="utterance"),
    Layout("instruction", fields=(("system", ("system",)), ("user", ("instruction", "input")),
                                  ("assistant", ("output",))), optional=("system", "input")),
    Layout("prompt_completion", fields=(("user", ("prompt",)), ("assistant", ("completion",)))),
    Layout("prompt_response", fields=(("system", ("system_prompt",)), ("user", ("prompt",)),
                                      ("assistant", ("response",))), optional=("system_prompt",)),
    Layout("question_answer", fields=(("user", ("context", "question")), ("assistant", ("answer",))),
           optional=("context",)),
)


def fingerprint_of(paths: list[str]) -> str:
    return hashlib.sha256("|".join(sorted(set(paths))).encode()).hexdigest()


def _probe(path: str) -> str:
    return "$." + path.replace("[]", "[0]")


def fingerprint(record: Column, layouts: tuple[Layout, ...] = LAYOUTS) -> Column:
    """SHA-256 of the known nested field paths that the record holds, sorted."""
    known = sorted({p for layout in layouts for p in layout.paths()})
    held = [F.when(F.try_variant_get(record, _probe(p), "variant").isNotNull(), F.lit(p)) for p in known]
    return F.sha2(F.concat_ws("|", *held), 256)


def _canonical_role(role: Column) -> Column:
    r = F.coalesce(role, F.lit(""))
    out = r
    for alias, name in ROLE_ALIASES.items():
        out = F.when(F.lower(r) == alias, F.lit(name)).otherwise(out)
    return out


def _turns_of(layout: Layout, record: Column) -> Column:
    if layout.items:
        kind = f"array<struct<`{layout.role}`:string,`{layout.text}`:string>>"
        got = F.try_variant_get(record, "$." + layout.items, kind)
        return F.transform(got, lambda t: F.struct(
            _canonical_role(t[layout.role]).alias("role"),
            F.coalesce(t[layout.text], F.lit("")).alias("text")))
    turns = []
    for role, names in layout.fields:
        got = {n: F.try_variant_get(record, "$." + n, "string") for n in names}
        # an empty optional field adds nothing; joined fields are apart by a blank line
        parts = [F.when(got[n] != "", got[n]) for n in names]
        turn = F.struct(F.lit(role).alias("role"), F.concat_ws("\n\n", *parts).alias("text"))
        if all(n in layout.optional for n in names):
            turn = F.when(F.coalesce(*parts).isNotNull(), turn)
        turns.append(turn)
    return F.filter(F.array(*turns), lambda t: t.isNotNull())


def with_turns(df: DataFrame, record: str, layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """Add ``fingerprint``, ``layout`` and ``turns`` (canonical roles and texts)."""
    df = df.withColumn("fingerprint", fingerprint(F.col(record), layouts))
    fp, name, turns = F.col("fingerprint"), F.lit(None).cast("string"), F.lit(None).cast(TURNS)
    for layout in layouts:
        hit = fp.isin(layout.fingerprints())
        name = F.when(hit, F.lit(layout.name)).otherwise(name)
        turns = F.when(hit, _turns_of(layout, F.col(record)).cast(TURNS)).otherwise(turns)
    return df.withColumn("layout", name).withColumn("turns", F.coalesce(turns, F.array().cast(TURNS)))


def escape(c: Column) -> Column:
    """No ``#`` or ``<`` stays in a text, so no control string can: each is a
    backslash and a letter, and the backslash itself is one as well."""
    for raw, code in (("\\", "\\b"), ("#", "\\h"), ("<", "\\l")):
        c = F.replace(c, F.lit(raw), F.lit(code))
    return c


def unescape(c: Column) -> Column:
    for raw, code in (("#", "\\h"), ("<", "\\l"), ("\\", "\\b")):
        c = F.replace(c, F.lit(code), F.lit(raw))
    return c


def _escape_role(c: Column) -> Column:
    return F.replace(escape(c), F.lit(":"), F.lit("\\c"))


def _unescape_role(c: Column) -> Column:
    return unescape(F.replace(c, F.lit("\\c"), F.lit(":")))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, also where lambdas in the body use it."""
    return F.transform(F.array(value), body)[0]


def starts_of(sizes: Column) -> Column:
    """For each of an array's sizes the sum (long) of those before it.

    Summed in about sqrt(n) blocks of sqrt(n), then over the blocks: an array that
    ``aggregate`` grows is copied at each step, so no long one is grown."""
    longs = "array<long>"

    def before(xs: Column) -> Column:
        start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(longs).alias("out"))
        return F.aggregate(xs, start, lambda acc, x: F.struct(
            (acc["at"] + x).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")),
            lambda acc: acc["out"])

    def total(xs: Column) -> Column:
        return F.aggregate(xs, F.lit(0).cast("long"), lambda acc, x: acc + x)

    def blocks(xs: Column) -> Column:
        width = F.greatest(F.lit(1), F.ceil(F.sqrt(F.size(xs))).cast("int"))
        return F.when(F.size(xs) > 0, F.transform(
            F.sequence(F.lit(0), F.floor((F.size(xs) - 1) / width).cast("int")),
            lambda i: F.slice(xs, i * width + 1, width))).otherwise(F.array().cast(f"array<{longs}>"))

    def joined(parts: Column) -> Column:
        return F.flatten(F.zip_with(parts, before(F.transform(parts, total)), lambda part, base: F.transform(
            before(part), lambda x: x + base)))

    return _let(_let(sizes.cast(longs), blocks), joined)


def format_turns(df: DataFrame, turns: str = "turns", trained: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """Add ``formatted`` and ``loss_spans`` (start from 0 and length, in code
    points of the formatted text): the texts of the ``trained`` roles."""
    parts = F.transform(F.col(turns), lambda t: F.struct(
        F.concat(F.lit(OPEN), _escape_role(t["role"]), F.lit(AFTER_ROLE)).alias("head"),
        escape(t["text"]).alias("body"), t["role"].isin(list(trained)).alias("train")))
    df = df.withColumn("__parts", parts)
    sizes = F.transform(F.col("__parts"), lambda p: F.length(p["head"]) + F.length(p["body"]) + len(END))
    spans = F.filter(F.zip_with(F.col("__parts"), starts_of(sizes), lambda p, at: F.struct(
        (at + F.length(p["head"])).alias("start"), F.length(p["body"]).cast("long").alias("len"),
        p["train"].alias("train"))), lambda s: s["train"])
    spans = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["len"].alias("len")))
    text = F.array_join(F.transform(F.col("__parts"), lambda p: F.concat(p["head"], p["body"], F.lit(END))), "")
    return (df.withColumn("formatted", text)
            .withColumn("loss_spans", spans)
            .drop("__parts"))


def _pieces(formatted: Column) -> Column:
    pieces = F.split(formatted, END)
    return F.slice(pieces, F.lit(1), F.size(pieces) - 1)


def parse_formatted(formatted: Column) -> Column:
    """The turns that a formatted text holds (the way back from ``format_turns``)."""
    def turn(p: Column) -> Column:
        head = F.substring_index(p, AFTER_ROLE, 1)
        at = F.length(head)
        return F.struct(_unescape_role(F.substr(head, F.lit(len(OPEN) + 1))).alias("role"),
                        unescape(F.substr(p, at + len(AFTER_ROLE) + 1)).alias("text"))

    return F.transform(_pieces(formatted), turn)


def masked_text(formatted: Column, spans: Column) -> Column:
    """The unescaped text under the loss mask, in text order (no two spans start alike).

    The text is cut by turn once and a span that starts with a turn's body is read
    from that turn, so no span counts code points from the text's start; any other
    span is cut from the whole text."""
    def body(p: Column) -> Column:
        return F.length(F.substring_index(p, AFTER_ROLE, 1)) + len(AFTER_ROLE)

    def cut(pieces: Column) -> Column:
        at = starts_of(F.transform(pieces, lambda p: F.length(p) + len(END)))
        bodies = F.map_from_arrays(F.zip_with(pieces, at, lambda p, a: a + body(p)),
                                   F.transform(pieces, lambda p: F.substr(p, body(p) + 1)))
        asked = F.map_from_arrays(spans["start"], spans["len"])
        return F.map_zip_with(bodies, asked, lambda start, text, size: F.when(
            size.isNotNull() & (size <= F.length(text)), F.substr(text, F.lit(1), size.cast("int"))).when(
            size.isNotNull(), F.substr(formatted, (start + 1).cast("int"), size.cast("int"))))

    found = F.array_sort(F.filter(F.map_entries(_let(_pieces(formatted), cut)), lambda e: e["value"].isNotNull()))
    return F.array_join(F.transform(found, lambda e: unescape(e["value"])), "")


def records_from_rows(df: DataFrame, conv: str = "conv_id", turn: str = "turn",
                      role: str = "role", text: str = "text") -> DataFrame:
    """One ``record`` VARIANT per conversation out of rows by turn.  Rows of
    equal turn go by role, then text; a repeated row is a turn of its own."""
    rows = df.select(F.col(conv).alias("conv_id"), F.struct(
        F.col(turn).alias("turn"), F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("content")).alias("t"))
    grouped = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("ts"))
    msgs = F.transform(F.col("ts"), lambda t: F.struct(t["role"].alias("role"), t["content"].alias("content")))
    return grouped.select("conv_id", F.to_variant_object(F.struct(msgs.alias("messages"))).alias("record"))
