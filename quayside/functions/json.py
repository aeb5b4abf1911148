"""JSON, envelope and base64 column functions.

All of these are built-in Catalyst expressions, so they stay inside whole-stage
codegen and Catalyst prunes ``from_json`` to the fields a query actually uses.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.functions.schemas import ENVELOPE_SCHEMA, SALES_EVENT_SCHEMA

CORRUPT_COLUMN = "_decode_error"


def body_text(body: Column | str = "body") -> Column:
    """``CAST(body AS STRING)``: UTF-8 bytes to text (text bodies pass through)."""
    col = F.col(body) if isinstance(body, str) else body
    return col.cast("string")


def parse_json(text: Column, schema: T.StructType = SALES_EVENT_SCHEMA, keep_errors: bool = False) -> Column:
    """``from_json`` in PERMISSIVE mode.

    A malformed record yields a struct of nulls, a bad field yields that field null;
    nothing is dropped. With ``keep_errors`` the raw text of a malformed record is
    kept in ``_decode_error`` (the plain form loses it).
    """
    if not keep_errors:
        return F.from_json(text, schema)
    with_err = T.StructType(list(schema.fields) + [T.StructField(CORRUPT_COLUMN, T.StringType(), True)])
    return F.from_json(text, with_err, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COLUMN})


def decode_json_messages(
    messages: DataFrame,
    schema: T.StructType = SALES_EVENT_SCHEMA,
    body: str = "body",
    keep: tuple[str, ...] = (),
    keep_errors: bool = False,
) -> DataFrame:
    """Broker messages with JSON bodies -> typed event rows (``parsed_data.*``).

    ``keep`` carries message columns (e.g. ``offset``) next to the event fields.
    """
    parsed = messages.select(
        *[F.col(k) for k in keep],
        parse_json(body_text(body), schema, keep_errors).alias("parsed_data"),
    )
    return parsed.select(*keep, "parsed_data.*")


def record_to_json(record: Column) -> Column:
    """Record -> JSON text keeping null fields (a plain ``to_json`` drops them)."""
    return F.to_json(record, {"ignoreNullFields": "false"})


def to_base64(text: Column) -> Column:
    """Base64 of the UTF-8 bytes, on one line (Spark's ``base64`` wraps every 76 chars)."""
    return F.regexp_replace(F.base64(F.encode(text, "UTF-8")), r"[\r\n]", "")


def from_base64(b64: Column) -> Column:
    """Base64 text -> UTF-8 text."""
    return F.decode(F.unbase64(b64), "UTF-8")


def payload_to_base64(record: Column) -> Column:
    """A payload struct -> base64 of its JSON text."""
    return to_base64(record_to_json(record))


def payload_from_base64(b64: Column, schema: T.StructType) -> Column:
    """Base64 of JSON text -> typed struct."""
    return F.from_json(from_base64(b64), schema)


def envelope(event_id: Column, timestamp: Column, data_json: Column) -> Column:
    """An event envelope as JSON text: ``{eventId, timestamp, data}`` with ``data`` a JSON string."""
    return F.to_json(
        F.struct(
            event_id.cast("string").alias("eventId"),
            timestamp.cast("string").alias("timestamp"),
            data_json.cast("string").alias("data"),
        ),
        {"ignoreNullFields": "false"},
    )


def decode_envelopes(messages: DataFrame, data_schema: T.StructType, body: str = "body") -> DataFrame:
    """Envelope messages -> ``eventId, timestamp`` plus the fields of the inner ``data`` JSON."""
    outer = messages.select(F.from_json(body_text(body), ENVELOPE_SCHEMA).alias("env"))
    return outer.select(
        F.col("env.eventId").alias("eventId"),
        F.col("env.timestamp").alias("timestamp"),
        F.from_json(F.col("env.data"), data_schema).alias("data"),
    ).select("eventId", "timestamp", "data.*")


def json_field(text: Column, path: str) -> Column:
    """A JSONPath pick (``$.value[0].sessionId``) as text."""
    return F.get_json_object(text, path)
