"""Event messages derived from the input tables.

Sales events are projected from ``lineitem`` (other fields stay null); each event
becomes a broker-style message ``(body, offset, enqueued_time, schema_id)``.
Everything here is column expressions, so building messages is a narrow,
codegen'd projection over the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.functions.schemas import (
    MESSAGE_SCHEMA,
    SALES_EVENT_SCHEMA,
    SALES_EVENT_TIME_FIELD,
)

def _lineitem_map() -> dict[str, Column]:
    """lineitem column -> sales event column (everything else is null)."""
    return {
        "cs_order_number": F.col("l_orderkey").cast("int"),
        "cs_item_sk": F.col("l_partkey").cast("int"),
        "cs_quantity": F.col("l_quantity").cast("int"),
        "cs_ext_sales_price": F.col("l_extendedprice"),
        "cs_ext_discount_amt": F.col("l_extendedprice") * F.col("l_discount"),
        "cs_ext_tax": F.col("l_extendedprice") * F.col("l_tax"),
        "session_id": F.concat(F.lit("s"), F.col("l_suppkey").cast("string")),
        SALES_EVENT_TIME_FIELD: F.col("l_shipdate"),
    }


def _event_columns() -> list[Column]:
    cols = []
    mapping = _lineitem_map()
    for field in SALES_EVENT_SCHEMA.fields:
        expr = mapping.get(field.name)
        expr = F.lit(None).cast(field.dataType) if expr is None else expr.cast(field.dataType)
        cols.append(expr.alias(field.name))
    return cols


def sales_events_from_lineitem(lineitem: DataFrame, with_position: bool = False,
                               carry: tuple[str, ...] = ()) -> DataFrame:
    """Typed sales events (36 columns, the event-table schema), one per lineitem row.

    ``with_position`` adds the broker ``offset`` and ``enqueued_time`` of the event;
    ``carry`` keeps lineitem columns alongside.
    """
    extra = [message_offset().alias("offset"), F.col("l_shipdate").alias("enqueued_time")] if with_position else []
    return lineitem.select(*_event_columns(), *extra, *carry)


def message_offset() -> Column:
    """Broker offset of a lineitem event: unique, and increasing with arrival (ship date).

    Events of later days always get larger offsets, as on a broker partition.
    """
    within_day = F.col("l_orderkey") * F.lit(8) + F.col("l_linenumber").cast("long")
    return F.unix_seconds(F.col("l_shipdate").cast("timestamp")) * F.lit(100_000_000) + within_day


def partitioned_schema() -> T.StructType:
    """Messages with the name of the broker partition that they came from."""
    return T.StructType([*MESSAGE_SCHEMA.fields, T.StructField("partition", T.StringType())])


def in_partitions(messages: DataFrame, partition: Column) -> DataFrame:
    """Messages of the broker partition ``partition`` (0, 1, ...), each of which counts its
    offsets alone: those of partition p are divided by 1000 to the power p, rounded down."""
    places = F.pow(F.lit(1000), partition).cast("long")
    return messages.select("body", F.floor(F.col("offset") / places).cast("long").alias("offset"), "enqueued_time",
                           "schema_id", partition.cast("string").alias("partition"))


def wire_record(events: DataFrame) -> Column:
    """The record as it goes on the wire: timestamp-seconds as an epoch-seconds long."""
    fields = []
    for field in SALES_EVENT_SCHEMA.fields:
        if field.name == SALES_EVENT_TIME_FIELD:
            fields.append(F.unix_seconds(F.col(field.name)).alias(field.name))
        else:
            fields.append(F.col(field.name))
    return F.struct(*fields)


def json_body(record: Column) -> Column:
    """JSON text as UTF-8 bytes; nulls are kept, as a record serializer writes them."""
    return F.encode(F.to_json(record, {"ignoreNullFields": "false"}), "UTF-8")


def json_messages(lineitem: DataFrame, schema_id: str | None = None) -> DataFrame:
    """Broker messages with JSON bodies built from lineitem."""
    events = sales_events_from_lineitem(lineitem, with_position=True)
    return events.select(
        json_body(wire_record(events)).alias("body"),
        F.col("offset"),
        F.col("enqueued_time"),
        F.lit(schema_id).cast("string").alias("schema_id"),
    )


def avro_messages(lineitem: DataFrame, avro_text: str, schema_id: str | None = None,
                  carry: tuple[str, ...] = ()) -> DataFrame:
    """Broker messages with schemaless Avro bodies (encoded by an Arrow UDF, which is given only the
    fields that lineitem fills: the others are written as null without a trip to Python)."""
    from quayside.functions.avro import encode_avro
    from quayside.functions.schemas import parse_avro_record

    filled = _lineitem_map()
    names = [f.name for f in parse_avro_record(avro_text) if f.name in filled]
    events = sales_events_from_lineitem(lineitem, with_position=True, carry=carry)
    return events.select(
        encode_avro(F.struct(*names), avro_text).alias("body"),
        F.col("offset"),
        F.col("enqueued_time"),
        F.lit(schema_id).cast("string").alias("schema_id"),
        *carry,
    )
