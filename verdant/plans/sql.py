"""SQL surface: catalog tables from the column contract and the named views.

``create_tables`` issues ``CREATE TABLE IF NOT EXISTS ... USING parquet``
(partitioned fact table) at the given locations, so BI and SQL users can
query ``plant_readings`` directly; ``refresh`` makes partitions written by a
load visible to the catalog.  The columns' defaults are part of the tables, so an
``INSERT INTO`` that leaves the audit column out fills it.  ``register_views`` publishes the two analytic
views over any fact frame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .. import contract as K
from . import views as V

FACT_TABLE, STATE_TABLE, RUN_LOG_TABLE = K.FACT_TABLE, K.STATE_TABLE, K.RUN_LOG_TABLE
LATEST_VIEW, DAILY_VIEW = K.LATEST_VIEW, K.DAILY_VIEW


# A writer that leaves these columns out gets the time of the write (UTC, whole seconds).
NOW = "CAST(date_trunc('SECOND', current_timestamp()) AS TIMESTAMP_NTZ)"
DEFAULTS = {c: NOW for c in (K.AUDIT_COL, "updated_at", "started_at")}


def _columns(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}"
                     + (f" DEFAULT {DEFAULTS[f.name]}" if f.name in DEFAULTS else "") for f in schema.fields)


def ddl(name: str, schema: T.StructType, location: str,
        partition: str | None = None) -> str:
    part = f" PARTITIONED BY (`{partition}`)" if partition else ""
    return (f"CREATE TABLE IF NOT EXISTS {name} ({_columns(schema)}) USING parquet"
            f"{part} LOCATION '{location}'")


def create_tables(spark: SparkSession, fact_path: str, state_path: str,
                  run_log_path: str | None = None) -> None:
    spark.sql(ddl(FACT_TABLE, K.TABLE_SCHEMA, fact_path, K.PARTITION_COL))
    spark.sql(ddl(STATE_TABLE, K.STATE_SCHEMA, state_path))
    if run_log_path:
        spark.sql(ddl(RUN_LOG_TABLE, K.RUN_LOG_SCHEMA, run_log_path))


def refresh(spark: SparkSession) -> None:
    """Pick up partitions and files written since the tables were created."""
    spark.catalog.recoverPartitions(FACT_TABLE)
    for t in (FACT_TABLE, STATE_TABLE, RUN_LOG_TABLE):
        if spark.catalog.tableExists(t):
            spark.catalog.refreshTable(t)


def register_views(fact: DataFrame) -> None:
    """Temp views: latest reading per plant, daily averages per plant."""
    V.latest_per_plant(fact).createOrReplaceTempView(LATEST_VIEW)
    V.daily_averages(fact).createOrReplaceTempView(DAILY_VIEW)
