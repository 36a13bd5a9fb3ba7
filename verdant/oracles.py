"""DuckDB SQL text for the correctness gate.

Each query in ``__spark_entry__.queries()`` has an independent SQL
statement here, written against the raw driver tables (``events``) and
never sharing code with the Spark side beyond these fixed strings.  The
common prefix defines R (raw grid), T (typed rows), D (deduplicated) and
C (clean readings).
"""

from __future__ import annotations

from . import contract as K
from .sources.fixtures import RAW_READINGS_SQL

RUN_TS = "2025-05-01 10:00:00"

NUM_RE = r"[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?"
CASED = r"\p{Lu}\p{Ll}\p{Lt}"


def title_sql(x: str) -> str:
    runs = f"regexp_extract_all(lower(trim({x})), '[{CASED}]+|[^{CASED}]+')"
    return f"array_to_string(list_transform({runs}, lambda w: upper(w[1])||w[2:]), '')"


def num_sql(x: str, precision: int) -> str:
    return (f"try_cast(case when regexp_full_match(trim({x}), '{NUM_RE}') "
            f"then try_cast(trim({x}) as double) end as decimal({precision},2))")


NUM_SOURCE = {v: k for k, v in K.RENAME_MAP.items()}

TYPED_COLS = ",\n  ".join(
    ["_row_no",
     """try_strptime(trim("Timestamp"), '%Y-%m-%d %H:%M:%S') as timestamp""",
     f"""{title_sql('"Plant Name"')} as plant_name""",
     f"""{title_sql('"Status"')} as status""",
     '"Time" as reading_time']
    + [f"""{num_sql(f'"{NUM_SOURCE[c]}"', p)} as {c}""" for c, p in K.NUMERIC_PRECISION.items()]
)

FLAW_SQL = " or ".join(
    f"""(regexp_full_match(trim("{NUM_SOURCE[c]}"), '{NUM_RE}') and try_cast(try_cast(trim("{NUM_SOURCE[c]}") as double) """
    f"as decimal({p},2)) is null)" for c, p in K.NUMERIC_PRECISION.items())
TYPED_COLS += f",\n  case when {FLAW_SQL} then '{K.OVERFLOW}' end as flaw"


def all_null_sql(alias: str = "") -> str:
    pre = f"{alias}." if alias else ""
    return "coalesce(" + ", ".join(pre + c for c in K.NUMERIC_COLS) + ") is null"


ALL_NULL_SQL = all_null_sql()

TARGET_SELECT = ", ".join(
    c if c != K.AUDIT_COL else f"TIMESTAMP '{RUN_TS}' as {K.AUDIT_COL}"
    for c in K.TARGET_COLUMNS)

PREFIX = f"""
with R as ({RAW_READINGS_SQL}),
T as (select
  {TYPED_COLS}
  from R),
V as (select * from T where timestamp is not null and plant_name is not null and flaw is null),
D as (select * exclude (rn) from (
        select *, row_number() over (partition by timestamp, plant_name order by _row_no desc) as rn
        from V) where rn = 1),
C as (select {TARGET_SELECT}, _row_no from D where not ({ALL_NULL_SQL}))
"""


def q(body: str) -> str:
    """Full statement: the common prefix plus one query body."""
    return PREFIX + body
