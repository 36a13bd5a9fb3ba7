"""JSON records (one object per line) with an explicit schema.

Writing uses ISO-8601 timestamps; reading never infers types, so text that
looks like a date or a number stays text (``"02:28"`` stays ``"02:28"``,
plant ``"01"`` stays ``"01"``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..contract import ROW_NO
from .grid import ordinal

ISO_NTZ = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"
_OPTS = {"timestampNTZFormat": ISO_NTZ, "dateFormat": "yyyy-MM-dd"}


def write_records(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(**_OPTS).json(path)


def read_records(spark: SparkSession, path: str, schema: T.StructType,
                 with_ordinal: bool = False) -> DataFrame:
    """Records under ``path``; ``with_ordinal`` adds ``_row_no`` (later change,
    file, split, row), which keep-last needs when there are several files."""
    df = spark.read.options(**_OPTS).schema(schema).json(path)
    return df.select(ordinal().alias(ROW_NO), *schema.names) if with_ordinal else df


def to_records(df: DataFrame) -> DataFrame:
    """Each row as one JSON text (for message sinks)."""
    return df.select(F.to_json(F.struct(*df.columns), _OPTS).alias("value"))


def field(json_text: Column | str, name: str, dtype: T.DataType) -> Column:
    """One typed field of a JSON object column."""
    c = F.col(json_text) if isinstance(json_text, str) else json_text
    return F.from_json(c, T.StructType([T.StructField(name, dtype, True)]))[name]
