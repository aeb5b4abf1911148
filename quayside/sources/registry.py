"""Schema registry kept as a small dimension table.

A lookup is an equality filter plus ``max_by(version)``: one row reaches the driver
(the schema text), never the data. Registering on a miss is off: an unknown
schema is an error, as with an encoder configured without auto-registration.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.functions.avro import schema_fingerprint
from quayside.functions.schemas import (
    REGISTRY_SCHEMA,
    SALES_EVENT_GROUP,
    SALES_EVENT_NAMESPACE,
    SALES_EVENT_RECORD_NAME,
    SALES_EVENT_SCHEMA,
    sales_event_avro,
)

SALES_EVENT_FULL_NAME = f"{SALES_EVENT_NAMESPACE}.{SALES_EVENT_RECORD_NAME}"
# Version 1 of the producer did not send these fields yet.
V1_MISSING_FIELDS = ("cs_ext_tax", "session_id")


class SchemaNotFound(LookupError):
    pass


def sales_event_versions() -> list[tuple[int, str]]:
    """(version, Avro text) of the sales-event record, oldest first."""
    v1 = sales_event_avro(tuple(f.name for f in SALES_EVENT_SCHEMA.fields if f.name not in V1_MISSING_FIELDS))
    return [(1, v1), (2, sales_event_avro())]


def registry_table(spark: SparkSession) -> DataFrame:
    """The registry with every version of the sales-event schema."""
    rows = [
        (schema_fingerprint(text), SALES_EVENT_GROUP, SALES_EVENT_FULL_NAME, "avro", version, text)
        for version, text in sales_event_versions()
    ]
    return spark.createDataFrame(rows, REGISTRY_SCHEMA)


def resolve_schema(registry: DataFrame, group_name: str, name: str, fmt: str = "avro",
                   version: int | None = None) -> tuple[str, str]:
    """(schema_id, definition) of a registered schema; the latest version unless one is given."""
    hits = registry.where(
        (F.col("group_name") == group_name) & (F.col("name") == name) & (F.lower("format") == fmt.lower())
    )
    if version is not None:
        hits = hits.where(F.col("version") == version)
    row = hits.agg(
        F.max_by("schema_id", "version").alias("schema_id"), F.max_by("definition", "version").alias("definition")
    ).first()
    if row is None or row["schema_id"] is None:
        raise SchemaNotFound(f"no {fmt} schema {name!r} in group {group_name!r}")
    return row["schema_id"], row["definition"]


def writer_schemas(registry: DataFrame, group_name: str, name: str) -> dict[str, str]:
    """schema_id -> definition for every version of one record (bounded by the version count)."""
    rows = registry.where((F.col("group_name") == group_name) & (F.col("name") == name)) \
        .select("schema_id", "definition").limit(10_000).collect()
    if len(rows) >= 10_000:
        raise ValueError("too many schema versions to ship to executors")
    return {r["schema_id"]: r["definition"] for r in rows}
