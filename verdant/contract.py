"""Column contract for plant sensor readings.

One place for every name, type and fixed value the pipeline depends on:
the raw grid header, the rename map, the typed fact-table schema, the
numeric columns and their decimal shapes, and the state/run-log schemas.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the source system's contract; natural order).
# Sheet header -> column name.
# ---------------------------------------------------------------------------
RENAME_MAP: dict[str, str] = {
    "Timestamp": "timestamp",
    "Plant Name": "plant_name",
    "Status": "status",
    "Confidence Score (%)": "confidence_score_pct",
    "Moisture Sensor": "moisture_sensor",
    "Humidity": "humidity",
    "Nitrogen": "nitrogen",
    "Phosphorus": "phosphorus",
    "Potassium": "potassium",
    "Temperature": "temperature",
    "Time": "reading_time",
    "Outside Temperature": "outside_temperature",
    "Outside Humidity": "outside_humidity",
    "Inside Temperature": "inside_temperature",
    "Inside Humidity": "inside_humidity",
}

# Numeric sensor columns and their warehouse DECIMAL(precision, 2) shapes.
NUMERIC_PRECISION: dict[str, int] = {
    "confidence_score_pct": 6,
    "moisture_sensor": 8,
    "humidity": 8,
    "nitrogen": 8,
    "phosphorus": 8,
    "potassium": 8,
    "temperature": 6,
    "outside_temperature": 6,
    "outside_humidity": 6,
    "inside_temperature": 6,
    "inside_humidity": 6,
}
NUMERIC_SCALE = 2
NUMERIC_COLS: list[str] = list(NUMERIC_PRECISION)

# Text columns and their NVARCHAR(n) lengths.
TEXT_LENGTH: dict[str, int] = {"plant_name": 100, "status": 50, "reading_time": 20}

# Natural key of the fact table; state-table key.
KEY_COLS: list[str] = ["timestamp", "plant_name"]
PIPELINE_NAME = "plant_monitoring"

# Accepted timestamp layouts, tried in order (first match wins).  ISO is the
# year-first family: date alone or with hour and minute, seconds and up to 9
# fraction digits; '-' or '/' in the date; 'T' or a blank; 'Z' or an offset
# (the instant, in UTC).
ISO = "ISO"
TIMESTAMP_FORMATS: list[str] = [
    ISO,
    "M/d/yyyy H:mm:ss",
    "M/d/yyyy H:mm",
    "M/d/yyyy h:mm:ss a",
    "M/d/yyyy h:mm a",
    "M/d/yyyy",
]

# Fact table columns in write order (the 16 loaded columns).
TARGET_COLUMNS: list[str] = [
    "timestamp",
    "plant_name",
    "status",
    "confidence_score_pct",
    "moisture_sensor",
    "humidity",
    "nitrogen",
    "phosphorus",
    "potassium",
    "temperature",
    "reading_time",
    "outside_temperature",
    "outside_humidity",
    "inside_temperature",
    "inside_humidity",
    "etl_inserted_at",
]

# Catalog names of the tables and views.
FACT_TABLE, STATE_TABLE, RUN_LOG_TABLE = "plant_readings", "etl_watermark", "etl_run_log"
LATEST_VIEW, DAILY_VIEW = "vw_latest_plant_readings", "vw_daily_plant_averages"
# ---------------------------------------------------------------------------

RAW_COLUMNS: list[str] = list(RENAME_MAP)
ROW_NO = "_row_no"          # input ordinal: higher = later in the source
PARTITION_COL = "reading_date"
AUDIT_COL = "etl_inserted_at"
REJECT_COL = "reject_reason"
EXTRA_COL = "_extra"        # surplus cells of an over-long row (JSON text), else NULL
CELLS_COL = "_cells"        # the row's cells as they were read (JSON by header), for the rejects
UNMAPPED_COL = "unmapped"   # cells under headers that the contract does not name (VARIANT object)
FLAW_COL = "_flaw"          # row-local reason found while parsing cells, else NULL

# Reject reasons, in the order they are tested.
BAD_TIMESTAMP = "bad_timestamp"
NULL_PLANT = "null_plant_name"
TOO_MANY_CELLS = "too_many_cells"
OVERFLOW = "number_overflow"
FUTURE_TIMESTAMP = "future_timestamp"
LATE_EVENT = "late_event"   # its day was closed by the stream's watermark
DUPLICATE = "duplicate_superseded"
ALL_NULL = "all_numeric_null"


def decimal_type(col: str) -> T.DecimalType:
    return T.DecimalType(NUMERIC_PRECISION[col], NUMERIC_SCALE)


RAW_SCHEMA = T.StructType(
    [T.StructField(ROW_NO, T.LongType(), True)]
    + [T.StructField(c, T.StringType(), True) for c in RAW_COLUMNS]
)


def _target_field(name: str) -> T.StructField:
    if name in NUMERIC_PRECISION:
        return T.StructField(name, decimal_type(name), True)
    if name in ("timestamp", AUDIT_COL):
        return T.StructField(name, T.TimestampNTZType(), name != "timestamp")
    return T.StructField(name, T.StringType(), name != "plant_name")


TARGET_SCHEMA = T.StructType([_target_field(c) for c in TARGET_COLUMNS])
# On disk the table is partitioned by the reading date.
TABLE_SCHEMA = T.StructType(
    TARGET_SCHEMA.fields + [T.StructField(PARTITION_COL, T.DateType(), True)]
)

# Every file may hold the unmapped cells too; those without them read NULL.
STORED_SCHEMA = T.StructType(
    TARGET_SCHEMA.fields + [T.StructField(UNMAPPED_COL, T.VariantType(), True),
                            T.StructField(PARTITION_COL, T.DateType(), True)]
)

STATE_SCHEMA = T.StructType([
    T.StructField("pipeline_name", T.StringType(), False),
    T.StructField("last_watermark", T.TimestampNTZType(), True),
    T.StructField("updated_at", T.TimestampNTZType(), False),
])

# One row per plant and run that stored readings of it.
MARKS_SCHEMA = T.StructType([
    T.StructField("pipeline_name", T.StringType(), False),
    T.StructField("plant_name", T.StringType(), True),
    T.StructField("last_watermark", T.TimestampNTZType(), True),
    T.StructField("updated_at", T.TimestampNTZType(), False),
])

RUN_LOG_SCHEMA = T.StructType([
    T.StructField("pipeline_name", T.StringType(), False),
    T.StructField("run_id", T.StringType(), True),
    T.StructField("started_at", T.TimestampNTZType(), False),
    T.StructField("finished_at", T.TimestampNTZType(), True),
    T.StructField("rows_extracted", T.LongType(), True),
    T.StructField("rows_rejected", T.LongType(), True),
    T.StructField("rows_loaded", T.LongType(), True),
    T.StructField("status", T.StringType(), False),
    T.StructField("error_message", T.StringType(), True),
])
