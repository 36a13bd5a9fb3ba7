"""Data-quality checks for the constraints Parquet does not enforce.

Each check is one aggregate or filter pass: partial/final hash aggregation
for key uniqueness, row filters for NOT NULL, one global aggregate for
type fit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import contract as K
from ..functions import parse_number, strip, title_case, to_decimal
from .clean import rename_columns

NOT_NULL_COLS = ("timestamp", "plant_name")


def duplicate_keys(df: DataFrame, keys=K.KEY_COLS) -> DataFrame:
    """Keys stored more than once (UNIQUE violation), with their counts."""
    valid = df.dropna(how="any", subset=list(keys))
    return (valid.groupBy(*keys).agg(F.count(F.lit(1)).cast(T.LongType()).alias("dup_count"))
            .where("dup_count > 1"))


def not_null_violations(df: DataFrame, cols=NOT_NULL_COLS) -> DataFrame:
    """One row per (row, column) that breaks NOT NULL."""
    checks = F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in cols])
    return (df.select(K.ROW_NO, F.explode(F.array_compact(checks)).alias("failed_column")))


def type_fit(raw: DataFrame) -> DataFrame:
    """Counts of values that do not fit their warehouse type.

    ``<col>_overflow``: a number that does not fit DECIMAL(p, 2);
    ``<col>_too_long``: text longer than NVARCHAR(n).
    """
    r = rename_columns(raw)
    aggs = []
    for c in K.NUMERIC_COLS:
        d = parse_number(c)
        aggs.append(F.count_if(d.isNotNull() & to_decimal(d, K.NUMERIC_PRECISION[c]).isNull())
                    .cast(T.LongType()).alias(f"{c}_overflow"))
    for c, n in K.TEXT_LENGTH.items():
        v = F.col(c) if c == "reading_time" else title_case(strip(c))
        aggs.append(F.count_if(F.length(v) > n).cast(T.LongType()).alias(f"{c}_too_long"))
    return r.agg(*aggs)
