"""Schemas: one Avro record definition is the single source of truth for the event table.

``avro_to_struct`` derives the Spark ``StructType`` from Avro text, so the decoder
schema and the table schema cannot drift apart.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# The sales-event record. Field names, order and types must equal
# the event producer's, otherwise decoded tables do not line up.
# 19 nullable ints, 15 nullable doubles, one nullable string, and one nullable
# long with logical type timestamp-seconds (epoch seconds).
# ---------------------------------------------------------------------------
SALES_EVENT_INT_FIELDS = (
    "cs_sold_date_sk",
    "cs_sold_time_sk",
    "cs_ship_date_sk",
    "cs_bill_customer_sk",
    "cs_bill_cdemo_sk",
    "cs_bill_hdemo_sk",
    "cs_bill_addr_sk",
    "cs_ship_customer_sk",
    "cs_ship_cdemo_sk",
    "cs_ship_hdemo_sk",
    "cs_ship_addr_sk",
    "cs_call_center_sk",
    "cs_catalog_page_sk",
    "cs_ship_mode_sk",
    "cs_warehouse_sk",
    "cs_item_sk",
    "cs_promo_sk",
    "cs_order_number",
    "cs_quantity",
)
SALES_EVENT_DOUBLE_FIELDS = (
    "cs_wholesale_cost",
    "cs_list_price",
    "cs_sales_price",
    "cs_ext_discount_amt",
    "cs_ext_sales_price",
    "cs_ext_wholesale_cost",
    "cs_ext_list_price",
    "cs_ext_tax",
    "cs_coupon_amt",
    "cs_ext_ship_cost",
    "cs_net_paid",
    "cs_net_paid_inc_tax",
    "cs_net_paid_inc_ship",
    "cs_net_paid_inc_ship_tax",
    "cs_net_profit",
)
SALES_EVENT_STRING_FIELDS = ("session_id",)
SALES_EVENT_TIME_FIELD = "CreatedTime"
SALES_EVENT_RECORD_NAME = "DataEvent"
SALES_EVENT_NAMESPACE = "quayside.events"
SALES_EVENT_GROUP = "sales_avro"


def _nullable(avro_type) -> dict:
    return ["null", avro_type]


def sales_event_avro(fields: tuple[str, ...] | None = None) -> str:
    """Avro record text for the sales event (optionally only some fields, for older versions)."""
    spec: list[dict] = []
    for name in SALES_EVENT_INT_FIELDS:
        spec.append({"name": name, "type": _nullable("int"), "default": None})
    for name in SALES_EVENT_DOUBLE_FIELDS:
        spec.append({"name": name, "type": _nullable("double"), "default": None})
    for name in SALES_EVENT_STRING_FIELDS:
        spec.append({"name": name, "type": _nullable("string"), "default": None})
    spec.append(
        {
            "name": SALES_EVENT_TIME_FIELD,
            "type": _nullable({"type": "long", "logicalType": "timestamp-seconds"}),
            "default": None,
        }
    )
    if fields is not None:
        keep = set(fields)
        spec = [f for f in spec if f["name"] in keep]
    record = {
        "namespace": SALES_EVENT_NAMESPACE,
        "type": "record",
        "name": SALES_EVENT_RECORD_NAME,
        "fields": spec,
    }
    return json.dumps(record, indent=2)


# ---------------------------------------------------------------------------
# Avro -> Spark
# ---------------------------------------------------------------------------
_PRIMITIVES = {
    "boolean": T.BooleanType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "bytes": T.BinaryType(),
}
_LOGICAL = {
    ("long", "timestamp-seconds"): T.TimestampType(),
    ("long", "timestamp-millis"): T.TimestampType(),
    ("long", "timestamp-micros"): T.TimestampType(),
    ("int", "date"): T.DateType(),
}


@dataclass(frozen=True)
class AvroField:
    """One field of a flat Avro record: ``kind`` is the physical type, ``branches`` the union order."""

    name: str
    kind: str  # boolean|int|long|float|double|string|bytes
    logical: str | None
    branches: tuple[str, ...]  # e.g. ("null", "int"); a non-union field has one branch
    spark_type: T.DataType

    @property
    def null_branch(self) -> int:
        return self.branches.index("null") if "null" in self.branches else -1

    @property
    def value_branch(self) -> int:
        return next(i for i, b in enumerate(self.branches) if b != "null")


def _physical(avro_type) -> tuple[str, str | None]:
    if isinstance(avro_type, str):
        if avro_type not in _PRIMITIVES:
            raise NotImplementedError(f"unsupported Avro type {avro_type!r}")
        return avro_type, None
    if isinstance(avro_type, dict):
        kind = avro_type.get("type")
        if kind not in _PRIMITIVES:
            raise NotImplementedError(f"unsupported Avro type {avro_type!r}")
        return kind, avro_type.get("logicalType")
    raise NotImplementedError(f"unsupported Avro type {avro_type!r}")


def parse_avro_record(avro_text: str | dict) -> tuple[AvroField, ...]:
    """Fields of a flat record whose fields are primitives or ``[null, primitive]`` unions."""
    record = json.loads(avro_text) if isinstance(avro_text, str) else avro_text
    if record.get("type") != "record":
        raise NotImplementedError("only record schemas are supported")
    out = []
    for f in record["fields"]:
        ftype = f["type"]
        if isinstance(ftype, list):
            non_null = [t for t in ftype if t != "null"]
            if len(non_null) != 1 or len(ftype) > 2:
                raise NotImplementedError(f"union {ftype!r} of field {f['name']!r}")
            kind, logical = _physical(non_null[0])
            branches = tuple("null" if t == "null" else kind for t in ftype)
        else:
            kind, logical = _physical(ftype)
            branches = (kind,)
        spark_type = _LOGICAL.get((kind, logical), _PRIMITIVES[kind])
        out.append(AvroField(f["name"], kind, logical, branches, spark_type))
    return tuple(out)


def avro_to_struct(avro_text: str | dict) -> T.StructType:
    """Spark schema of an Avro record; every field nullable, as in the event table."""
    return T.StructType([T.StructField(f.name, f.spark_type, True) for f in parse_avro_record(avro_text)])


SALES_EVENT_SCHEMA = avro_to_struct(sales_event_avro())

# Event envelope: all strings, ``data`` holds JSON text.
ENVELOPE_SCHEMA = T.StructType(
    [
        T.StructField("eventId", T.StringType(), True),
        T.StructField("timestamp", T.StringType(), True),
        T.StructField("data", T.StringType(), True),
    ]
)

# Event message as it arrives from the broker (file replay in tests).
MESSAGE_SCHEMA = T.StructType(
    [
        T.StructField("body", T.BinaryType(), True),
        T.StructField("offset", T.LongType(), True),
        T.StructField("enqueued_time", T.TimestampType(), True),
        T.StructField("schema_id", T.StringType(), True),
    ]
)

# Document ingestion.
DOCUMENT_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType(), True),
        T.StructField("fileName", T.StringType(), True),
        T.StructField("text", T.StringType(), True),
    ]
)
CHECKPOINT_SCHEMA = T.StructType([T.StructField("id", T.StringType(), True)])
FAILURE_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType(), True),
        T.StructField("fileName", T.StringType(), True),
        T.StructField("text", T.StringType(), True),
        T.StructField("error", T.StringType(), True),
    ]
)
OUTCOME_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType(), True),
        T.StructField("fileName", T.StringType(), True),
        T.StructField("text", T.StringType(), True),
        T.StructField("batch_id", T.LongType(), True),
        T.StructField("status", T.StringType(), False),
        T.StructField("error", T.StringType(), True),
        T.StructField("vector", T.ArrayType(T.FloatType(), False), True),
    ]
)
INDEX_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType(), False),
        T.StructField("content", T.StringType(), True),
        T.StructField("fileName", T.StringType(), True),
        T.StructField("contentVector", T.ArrayType(T.FloatType(), False), True),
    ]
)
REGISTRY_SCHEMA = T.StructType(
    [
        T.StructField("schema_id", T.StringType(), False),
        T.StructField("group_name", T.StringType(), False),
        T.StructField("name", T.StringType(), False),
        T.StructField("format", T.StringType(), False),
        T.StructField("version", T.IntegerType(), False),
        T.StructField("definition", T.StringType(), False),
    ]
)
