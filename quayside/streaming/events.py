"""Structured Streaming: broker messages -> decoded events -> append-only table.

The broker is a parameter: any streaming source giving ``body`` (and for starting
positions ``offset`` / ``enqueued_time``) works. Tests and queries replay
messages from parquet files (``spark.readStream.format("parquet")``), which keeps
every run offline and repeatable. The stream is stateless (decode + flatten), so
there is no state store and no watermark; late events are simply appended.
Exactly-once output comes from the checkpoint plus the file sink's commit log.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quayside.functions import avro as qavro
from quayside.functions import json as qjson
from quayside.functions.schemas import MESSAGE_SCHEMA, SALES_EVENT_SCHEMA


# Largest micro-batch of a file source, in files. A backlog is then worked through in
# bounded, checkpointed steps (``availableNow`` honours the limit) instead of one
# batch holding everything, which a lost executor would force to redo whole.
MAX_FILES_PER_TRIGGER = 1000
_FILE_FORMATS = {"parquet", "json", "csv", "orc", "text", "avro"}


def read_messages(spark: SparkSession, path: str | None = None, fmt: str = "parquet", options: dict | None = None,
                  schema=None, max_files_per_trigger: int | None = MAX_FILES_PER_TRIGGER) -> DataFrame:
    """A streaming DataFrame of broker messages (``body`` plus position columns).

    File sources are read by ``path`` with ``schema`` (messages by default) and get
    ``maxFilesPerTrigger`` unless ``options`` set it. Any other source (a broker) is
    opened by its options, takes its own rate limit from them and brings its own schema
    and, mostly, no path; :func:`as_messages` gives its rows the message columns.
    """
    reader, opts = spark.readStream.format(fmt), dict(options or {})
    if fmt in _FILE_FORMATS:
        schema = MESSAGE_SCHEMA if schema is None else schema
        if max_files_per_trigger and "maxFilesPerTrigger" not in opts:
            opts["maxFilesPerTrigger"] = str(max_files_per_trigger)
    if schema is not None:
        reader = reader.schema(schema)
    reader = reader.options(**opts)
    return reader.load(path) if path else reader.load()


def as_messages(source: DataFrame, body: str = "value", offset: str = "offset", enqueued_time: str = "timestamp",
                partition: str | None = "partition", schema_id: str | None = None) -> DataFrame:
    """Message columns from a source's own ones: body (as bytes), offset, enqueued_time,
    schema_id and, where the source has it, partition (as text)."""
    kept = [F.col(partition).cast("string").alias("partition")] if partition else []
    as_bytes = F.col(body) if source.schema[body].dataType.typeName() == "binary" else F.encode(F.col(body).cast("string"), "UTF-8")
    return source.select(
        as_bytes.alias("body"), F.col(offset).cast("long").alias("offset"),
        F.col(enqueued_time).cast("timestamp").alias("enqueued_time"),
        (F.col(schema_id) if schema_id else F.lit(None)).cast("string").alias("schema_id"), *kept)


#: What a row decoded with ``keep_message`` carries: the message as it came.
MESSAGE_COLUMN = "_message"


def decode_stream(messages: DataFrame, codec: str = "avro", avro_text: str | None = None,
                  schema=SALES_EVENT_SCHEMA, with_errors: bool = False, keep_message: bool = False) -> DataFrame:
    """Decode message bodies into typed event columns (Avro: Arrow UDF; JSON: from_json).

    An undecodable body becomes an all-null row (nothing is dropped). With
    ``with_errors`` a ``_decode_error`` column says why (null for a good row), so
    :func:`split_decode_errors` can route bad bodies to a quarantine sink; with
    ``keep_message`` the struct ``_message`` holds body, offset and all other columns of
    the message, so that a quarantined one can be repaired and replayed.
    """
    if keep_message:
        messages = messages.withColumn(MESSAGE_COLUMN, F.struct(*messages.columns))
    kept = (MESSAGE_COLUMN,) if keep_message else ()
    if codec == "avro":
        if avro_text is None:
            raise ValueError("avro_text is required for codec='avro'")
        decoded = qavro.decode_avro(F.col("body"), avro_text, with_error=with_errors)
        return messages.select(decoded.alias("decoded"), *kept).select("decoded.*", *kept)
    if codec == "json":
        if not with_errors:
            return qjson.decode_json_messages(messages, schema, keep=kept)
        out = qjson.decode_json_messages(messages, schema, keep=("body", *kept), keep_errors=True)
        # null or empty text gives a null record, whose error field is null too
        missing = F.when(F.col("body").isNull(), F.lit("null body")).when(F.length("body") == 0, F.lit("empty body"))
        err = qjson.CORRUPT_COLUMN
        return out.withColumn(err, F.coalesce(F.col(err), missing)).drop("body")
    raise ValueError(f"unknown codec {codec!r}")


def split_decode_errors(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(good, bad)`` of rows decoded ``with_errors``: good rows without the error
    column and the message, bad rows with both (the reason, and what it is about)."""
    err = F.col(qjson.CORRUPT_COLUMN)
    return decoded.where(err.isNull()).drop(qjson.CORRUPT_COLUMN, MESSAGE_COLUMN), decoded.where(err.isNotNull())


def append_with_quarantine(decoded: DataFrame, table_path: str, quarantine_path: str, checkpoint: str,
                           trigger: str | dict = "availableNow") -> StreamingQuery:
    """One streaming query, two sinks: good events to ``table_path``, bad bodies to
    ``quarantine_path``.

    Each micro-batch is decoded once (cached for its two writes) and lands in a
    ``batch_id=<n>`` folder of each sink, written with overwrite: a batch replayed
    after a failure rewrites the same folders, so each event lands exactly once.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        write_split_batch(batch, batch_id, table_path, quarantine_path)

    writer = decoded.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return _trigger(writer, trigger).start()


def write_split_batch(batch: DataFrame, batch_id: int, table_path: str, quarantine_path: str) -> None:
    """Write one decoded micro-batch to both sinks; idempotent for a given ``batch_id``."""
    batch.persist()
    try:
        good, bad = split_decode_errors(batch)
        good.write.mode("overwrite").parquet(f"{table_path}/batch_id={batch_id}")
        bad.write.mode("overwrite").parquet(f"{quarantine_path}/batch_id={batch_id}")
    finally:
        batch.unpersist()


def _trigger(writer, trigger: str | dict):
    if trigger == "availableNow":
        return writer.trigger(availableNow=True)
    if trigger == "once":
        return writer.trigger(once=True)
    if isinstance(trigger, dict):
        return writer.trigger(**trigger)
    if trigger in (None, "default"):
        return writer
    return writer.trigger(processingTime=trigger)


def append_stream(events: DataFrame, path: str, checkpoint: str, fmt: str = "parquet",
                  trigger: str | dict = "availableNow", query_name: str | None = None) -> StreamingQuery:
    """Start an append-mode stream into ``path`` (``delta`` where its jar is present)."""
    writer = events.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
    if query_name:
        writer = writer.queryName(query_name)
    return _trigger(writer, trigger).start(path)


def table_stream(events: DataFrame, table: str, path: str, checkpoint: str, fmt: str = "parquet",
                 trigger: str | dict = "availableNow") -> StreamingQuery:
    """Append a stream into a catalog table stored at ``path``; query it with ``spark.sql``.

    Stands in for the in-memory debug sink: the rows stay on the cluster's storage
    instead of accumulating on the driver.
    """
    writer = (
        events.writeStream.format(fmt)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .option("path", path)
    )
    return _trigger(writer, trigger).toTable(table)


def memory_stream(events: DataFrame, name: str) -> StreamingQuery:
    """Debug only: the memory sink keeps every row on the driver; use on small samples."""
    return events.writeStream.format("memory").queryName(name).outputMode("append").start()


def run_to_end(query: StreamingQuery, timeout_s: float | None = None) -> None:
    """Wait for an availableNow/once query to finish and surface its failure, if any."""
    query.awaitTermination(timeout_s)
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))


# ---------------------------------------------------------------------------
# Starting position
# ---------------------------------------------------------------------------
@dataclass(frozen=True)
class StartingPosition:
    """Where a new stream starts: ``offset`` is "@earliest", "@latest" or a number.

    ``enqueued_time`` (ISO text) starts at that arrival time instead. ``partitions``
    gives broker partitions (by name) a position of their own. The position applies to
    the first start only; afterwards the query checkpoint decides.
    """

    offset: str | int = "@latest"
    inclusive: bool = True
    enqueued_time: str | None = None
    partitions: dict[str, StartingPosition] | None = None


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jpath


def _read_text(spark: SparkSession, path: str) -> str | None:
    fs, jpath = _fs(spark, path)
    if not fs.exists(jpath):
        return None
    stream = fs.open(jpath)
    try:
        reader = spark.sparkContext._jvm.java.io.BufferedReader(
            spark.sparkContext._jvm.java.io.InputStreamReader(stream, "UTF-8"))
        return reader.readLine()
    finally:
        stream.close()


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, jpath = _fs(spark, path)
    out = fs.create(jpath, False)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def resolve_start(spark: SparkSession, source_path: str, checkpoint: str, position: StartingPosition,
                  fmt: str = "parquet", partition: str | None = None, schema=None) -> dict:
    """The start filter, fixed at the first start and kept next to the query checkpoint.

    "@latest" resolves to the highest offset present at first start (one aggregate over
    the backlog), so the backlog is skipped once and never again. Offsets count within a
    broker partition: with ``partition`` (the column's name) there is one position per
    partition, and a partition that has no messages yet is read from its beginning.
    """
    marker = f"{checkpoint.rstrip('/')}.start.json"
    saved = _read_text(spark, marker)
    if saved:
        return json.loads(saved)
    positions = [position, *(position.partitions or {}).values()]
    latest: dict[str | None, int | None] = {}
    if any(p.offset == "@latest" and p.enqueued_time is None for p in positions):
        schema = MESSAGE_SCHEMA if schema is None else schema
        backlog = spark.read.format(fmt).schema(schema).load(source_path)
        if partition:
            name = F.col(partition).cast("string").alias("name")
            latest = {r["name"]: r["last"] for r in backlog.groupBy(name).agg(F.max("offset").alias("last")).collect()}
        else:
            latest = {None: backlog.agg(F.max("offset")).first()[0]}

    def one(p: StartingPosition, name: str | None) -> dict:
        if p.enqueued_time is not None:
            return {"column": "enqueued_time", "value": p.enqueued_time, "inclusive": p.inclusive}
        if p.offset == "@latest":
            last = latest.get(name)
            return {"column": None} if last is None else {"column": "offset", "value": last, "inclusive": False}
        if p.offset == "@earliest":
            return {"column": None}
        return {"column": "offset", "value": int(p.offset), "inclusive": p.inclusive}

    if partition:
        own = position.partitions or {}
        names = sorted({n for n in latest if n is not None} | set(own))
        spec = {"partition": partition, "starts": {n: one(own.get(n, position), n) for n in names}}
        # "@latest" of a partition that appears later is its beginning; other positions hold there too
        spec["others"] = one(position, "") if position.offset != "@latest" or position.enqueued_time else {"column": None}
    else:
        spec = one(position, None)
    _write_text(spark, marker, json.dumps(spec))
    return spec


def apply_start(messages: DataFrame, spec: dict) -> DataFrame:
    """Filter a message stream to the resolved starting position (pushed to the file scan)."""

    def from_here(start: dict):
        if start.get("column") is None:
            return F.lit(True)
        value, col = F.lit(start["value"]), F.col(start["column"])
        if start["column"] == "enqueued_time":
            value = value.cast("timestamp")
        # a message without a position cannot be before the start
        return col.isNull() | (col >= value if start["inclusive"] else col > value)

    if "starts" not in spec:
        return messages if spec.get("column") is None else messages.where(from_here(spec))
    name = F.col(spec["partition"]).cast("string")
    keep = (name.isNull() | ~name.isin(list(spec["starts"]))) & from_here(spec["others"])
    for n, start in spec["starts"].items():
        keep = keep | ((name == n) & from_here(start))
    return messages.where(keep)
