"""Registered queries: one per operator of the inventory, each reading the input tables.

Every entry is ``(spark, sf_dir) -> DataFrame``; ``ORACLE`` holds the DuckDB SQL twin
where SQL can express the result.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.functions import avro as qavro
from quayside.functions import json as qjson
from quayside.functions import text as qtext
from quayside.operators import batching, embedding, nearest, pending, search, upsert
from quayside.functions.schemas import SALES_EVENT_GROUP, sales_event_avro
from quayside.plans import ingest, oracle
from quayside.session import prepare, work_dir
from quayside.sources import documents as docs
from quayside.sources import events as ev
from quayside.sources import registry as reg
from quayside.sources import store
from quayside.sources import tables
from quayside.sources.tables import read_table
from quayside.streaming import events as stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def wrap(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return fn(spark, sf_dir)

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return run

    return wrap


# ---------------------------------------------------------------------------
# Event decoding
# ---------------------------------------------------------------------------
@register("json_decode", oracle.sales_events_sql())
def json_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON event bodies -> CAST AS STRING -> from_json -> parsed_data.* (flagship)."""
    messages = ev.json_messages(read_table(spark, sf_dir, "lineitem"))
    return qjson.decode_json_messages(messages)


@register("json_roundtrip", oracle.sales_events_sql())
def json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed record -> JSON text keeping nulls (ISO timestamps) -> from_json -> same record."""
    events = ev.sales_events_from_lineitem(read_table(spark, sf_dir, "lineitem"))
    text = events.select(qjson.record_to_json(F.struct(*events.columns)).alias("json_data"))
    return text.select(qjson.parse_json(F.col("json_data")).alias("parsed_data")).select("parsed_data.*")


@register(
    "envelope_decode",
    """SELECT CAST(event_id AS VARCHAR) AS eventId,
       strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS "timestamp",
       ts AS event_time,
       CAST(json_extract(props, '$.k') AS INTEGER) AS k
FROM events""",
)
def envelope_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Envelope ``{eventId, timestamp, data}`` whose ``data`` is JSON text: two from_json steps."""
    events = read_table(spark, sf_dir, "events")
    messages = events.select(
        F.encode(
            qjson.envelope(
                F.col("event_id"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.col("props")
            ),
            "UTF-8",
        ).alias("body")
    )
    decoded = qjson.decode_envelopes(messages, T.StructType([T.StructField("k", T.IntegerType())]))
    return decoded.select(
        "eventId", "timestamp", F.to_timestamp("timestamp").alias("event_time"), "k"
    )


@register("json_path", "SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
def json_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSONPath field pick from JSON text (``get_json_object``)."""
    events = read_table(spark, sf_dir, "events")
    return events.select("event_id", qjson.json_field(F.col("props"), "$.k").alias("k"))


@register(
    "payload_base64",
    "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders",
)
def payload_base64(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row -> JSON payload -> one-line base64 -> decoded JSON -> same row."""
    orders = read_table(spark, sf_dir, "orders")
    b64 = orders.select(qjson.payload_to_base64(F.struct(*orders.columns)).alias("payload"))
    return b64.select(qjson.payload_from_base64(F.col("payload"), orders.schema).alias("p")).select("p.*")


# ---------------------------------------------------------------------------
# Documents: scan, clean, checkpoint, pending
# ---------------------------------------------------------------------------
@register("doc_scan", oracle.DOCS_SQL)
def doc_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document table in the ingestion shape ``(id, fileName, text)``."""
    return docs.documents_from_table(read_table(spark, sf_dir, "documents"))


@register("doc_source", f"SELECT * FROM ({oracle.DOCS_SQL} WHERE lang = 'en')")
def doc_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of one language from a document store, by format and options; the language
    filter is pushed to the source."""
    found = store.read_documents(spark, options={"endpoint": sf_dir, "container": "documents"})
    return found.where(F.col("lang") == "en").select("id", "fileName", "text")


@register("doc_source_catalog", f"SELECT id FROM ({oracle.DOCS_SQL}) WHERE coalesce(text, '') <> ''")
def doc_source_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A container under a catalog name, read by SQL and ingested: ids of the index (texts that
    are empty fail alone)."""
    run = uuid.uuid4().hex[:12]
    store.register_catalog(spark, f"store_{run}", sf_dir)
    store.create_container_view(spark, f"documents_{run}", f"store_{run}.documents")
    documents = spark.sql(f"SELECT CAST(doc_id AS STRING) AS id, source AS fileName, text FROM documents_{run}")
    paths = ingest.IngestPaths.fresh(spark)
    ingest.ingest(spark, documents, paths, embedding.HashingEmbedder(), batch_size=1)
    return ingest.read_index(spark, paths).select("id")


@register(
    "clean_text",
    f"SELECT CAST(doc_id AS VARCHAR) AS id, {oracle.clean_text_sql('text')} AS content FROM documents",
)
def clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Index content: controls dropped, ':' -> ' -', Unicode-stripped (whole texts)."""
    d = docs.documents_from_table(read_table(spark, sf_dir, "documents"))
    return d.select("id", qtext.clean_text(F.col("text")).alias("content"))


@register(
    "clean_text_pages",
    f"SELECT page_id, {oracle.clean_text_sql('url')} AS url_content, "
    f"{oracle.clean_text_sql('html')} AS html_content FROM pages",
)
def clean_text_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """clean_text over raw web pages, where ':' and controls do occur."""
    pages = read_table(spark, sf_dir, "pages")
    return pages.select(
        "page_id",
        qtext.clean_text(F.col("url")).alias("url_content"),
        qtext.clean_text(F.col("html")).alias("html_content"),
    )


@register("completed_ids", f"SELECT DISTINCT id FROM ({oracle.CHECKPOINT_SQL})")
def completed_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct ids of the progress checkpoint."""
    return pending.completed_ids(docs.checkpoint_from_labels(read_table(spark, sf_dir, "labels")))


@register(
    "pending_documents",
    f"SELECT d.* FROM ({oracle.DOCS_SQL}) d WHERE NOT EXISTS "
    f"(SELECT 1 FROM ({oracle.CHECKPOINT_SQL}) c WHERE c.id = d.id)",
)
def pending_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents not yet in the checkpoint (left anti join)."""
    d = docs.documents_from_table(read_table(spark, sf_dir, "documents"))
    c = docs.checkpoint_from_labels(read_table(spark, sf_dir, "labels"))
    return pending.pending_documents(d, c)


@register("pending_documents_bloom", ORACLE["pending_documents"])
def pending_documents_bloom(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by way of a Bloom filter of finished ids, as for a checkpoint too large to send:
    only documents that may be done are shuffled."""
    d = docs.documents_from_table(read_table(spark, sf_dir, "documents"))
    c = docs.checkpoint_from_labels(read_table(spark, sf_dir, "labels"))
    return pending.pending_documents(d, c, bloom=True)


@register(
    "pending_notin",
    f"SELECT d.* FROM ({oracle.DOCS_SQL}) d WHERE d.id NOT IN (SELECT id FROM ({oracle.CHECKPOINT_SQL}))",
)
def pending_notin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose id is NOT IN the checkpoint (SQL null semantics)."""
    d = docs.documents_from_table(read_table(spark, sf_dir, "documents"))
    c = docs.checkpoint_from_labels(read_table(spark, sf_dir, "labels"))
    return pending.pending_not_in(d, c)


@register(
    "facet_sort",
    f"SELECT fileName, count(*) AS doc_count, min(id) AS first_id, max(id) AS last_id "
    f"FROM ({oracle.DOCS_SQL}) GROUP BY fileName",
)
def facet_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facet counts on ``fileName`` with the first/last ``id`` (sortable, filterable key)."""
    d = docs.documents_from_table(read_table(spark, sf_dir, "documents"))
    return search.facets(d, "fileName", "id")


#: Documents per page, and the id behind which the registered page query starts.
PAGE_SIZE, PAGE_AFTER = 100, "5"


@register(
    "index_page",
    f"SELECT id, fileName, text FROM ({oracle.DOCS_SQL}) WHERE id > '{PAGE_AFTER}' ORDER BY id LIMIT {PAGE_SIZE}",
)
def index_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page of documents in order of their (text) id, from an index stored in ranges of it."""
    path = f"{work_dir(spark, 'sorted')}/index"
    search.write_sorted(docs.documents_from_table(read_table(spark, sf_dir, "documents")), path)
    return search.page(spark.read.parquet(path), PAGE_SIZE, PAGE_AFTER)


# ---------------------------------------------------------------------------
# Avro events and the schema registry
# ---------------------------------------------------------------------------
# Events shipped before this day were written with schema version 1 / form the backlog
# of the restart and starting-position runs. It lies inside the data (ship dates run
# 1995-01-02 .. 2001-11-04; about 44% of rows fall before it), so both sides are exercised.
V1_CUTOVER = "1998-01-01"


@register("avro_decode", oracle.sales_events_sql())
def avro_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Schemaless Avro bodies -> decoded struct (Arrow UDF) -> decoded.*"""
    avro_text = sales_event_avro()
    messages = ev.avro_messages(read_table(spark, sf_dir, "lineitem"), avro_text)
    return messages.select(qavro.decode_avro(F.col("body"), avro_text).alias("decoded")).select("decoded.*")


@register("schema_resolve", oracle.sales_events_sql())
def schema_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Resolve the writer schema from the registry by group/name/format, then decode with it."""
    registry = reg.registry_table(spark)
    schema_id, definition = reg.resolve_schema(registry, SALES_EVENT_GROUP, reg.SALES_EVENT_FULL_NAME, "avro")
    messages = ev.avro_messages(read_table(spark, sf_dir, "lineitem"), definition, schema_id)
    return messages.select(qavro.decode_avro(F.col("body"), definition).alias("decoded")).select("decoded.*")


@register(
    "avro_decode_by_id",
    oracle.sales_events_sql(where=f"l_shipdate >= TIMESTAMP '{V1_CUTOVER}' OR l_shipdate IS NULL")
    + "\nUNION ALL\n"
    + oracle.sales_events_sql(where=f"l_shipdate < TIMESTAMP '{V1_CUTOVER}'", absent=reg.V1_MISSING_FIELDS),
)
def avro_decode_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages carry the id of their writer schema; older events were written with version 1.

    Each message is decoded with its own writer schema and read as the latest
    version (fields the writer lacked are null).
    """
    registry = reg.registry_table(spark)
    writers = reg.writer_schemas(registry, SALES_EVENT_GROUP, reg.SALES_EVENT_FULL_NAME)
    (v1_id, v1), (v2_id, v2) = [
        reg.resolve_schema(registry, SALES_EVENT_GROUP, reg.SALES_EVENT_FULL_NAME, "avro", version=v)
        for v in (1, 2)
    ]
    lineitem = read_table(spark, sf_dir, "lineitem")
    late = (F.col("l_shipdate") >= F.lit(V1_CUTOVER).cast("timestamp")) | F.col("l_shipdate").isNull()
    old, new = lineitem.where(~late), lineitem.where(late)
    messages = ev.avro_messages(old, v1, v1_id).unionByName(ev.avro_messages(new, v2, v2_id))
    decoder = qavro.avro_decoder_by_id(writers, v2)
    return messages.select(decoder(F.col("schema_id"), F.col("body")).alias("decoded")).select("decoded.*")


@register(
    "avro_decode_by_id_errors",
    f"""SELECT {oracle.sales_event_columns(null_when="l_returnflag IN ('R', 'A')")},
  CASE l_returnflag WHEN 'R' THEN 'unknown schema id retired' WHEN 'A' THEN 'no schema id' END AS _decode_error
FROM lineitem""",
)
def avro_decode_by_id_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages whose schema id is unknown or missing become all-null rows with the reason; the others decode."""
    registry = reg.registry_table(spark)
    writers = reg.writer_schemas(registry, SALES_EVENT_GROUP, reg.SALES_EVENT_FULL_NAME)
    v2_id, v2 = reg.resolve_schema(registry, SALES_EVENT_GROUP, reg.SALES_EVENT_FULL_NAME, "avro", version=2)
    messages = ev.avro_messages(read_table(spark, sf_dir, "lineitem"), v2, v2_id, carry=("l_returnflag",))
    flag = F.col("l_returnflag")
    schema_id = F.when(flag == "R", "retired").when(flag == "A", F.lit(None)).otherwise(F.col("schema_id"))
    decoder = qavro.avro_decoder_by_id(writers, v2, with_error=True)
    return messages.select(decoder(schema_id, F.col("body")).alias("decoded")).select("decoded.*")


# Returned-item events arrive cut short by one byte: all-null rows with the reason.
_TRUNCATED_RETURNS_SQL = f"""SELECT
  {oracle.sales_event_columns(null_when="l_returnflag = 'R'")},
  CASE WHEN l_returnflag = 'R' THEN 'truncated record at field CreatedTime' END AS _decode_error
FROM lineitem"""


def _truncated_return_messages(spark: SparkSession, sf_dir: str, avro_text: str) -> DataFrame:
    """Broker messages from lineitem whose returned-item bodies lost their last byte."""
    raw = ev.avro_messages(read_table(spark, sf_dir, "lineitem"), avro_text, carry=("l_returnflag",))
    cut = F.when(F.col("l_returnflag") == "R", F.expr("substring(body, 1, length(body) - 1)")).otherwise(F.col("body"))
    return raw.select(cut.alias("body"), "offset", "enqueued_time", "schema_id")


@register("avro_decode_errors", _TRUNCATED_RETURNS_SQL)
def avro_decode_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Returned-item events arrive cut short by one byte: each becomes an all-null row
    whose ``_decode_error`` says why; no row is dropped."""
    avro_text = sales_event_avro()
    bodies = _truncated_return_messages(spark, sf_dir, avro_text)
    decoded = bodies.select(qavro.decode_avro(F.col("body"), avro_text, with_error=True).alias("decoded"))
    return decoded.select("decoded.*")


# ---------------------------------------------------------------------------
# Document ingestion
# ---------------------------------------------------------------------------
def _docs_and_checkpoint(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    d = docs.documents_from_table(read_table(spark, sf_dir, "documents"))
    c = docs.checkpoint_from_labels(read_table(spark, sf_dir, "labels"))
    return d, c


def _seeded_paths(spark: SparkSession, sf_dir: str) -> ingest.IngestPaths:
    """A fresh ingestion folder whose checkpoint already lists the labelled documents."""
    paths = ingest.IngestPaths.fresh(spark)
    docs.checkpoint_from_labels(read_table(spark, sf_dir, "labels")).write.json(paths.checkpoint)
    return paths


@register("batch_assign", f"SELECT id, rn AS rank, batch_id, batch_pos FROM ({oracle.batches_sql()})")
def batch_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pending documents numbered in id order and cut into batches of 16 (no single-partition window)."""
    d, c = _docs_and_checkpoint(spark, sf_dir)
    batched = batching.assign_batches(pending.pending_documents(d, c), "id", size=ingest.BATCH_SIZE)
    return batched.public().select("id", "rank", "batch_id", "batch_pos")


#: Documents with mail addresses are not sent to the embedder; the oracle has the same string.
REJECTED = "@mail"

_OUTCOME_COLS = ("id", "fileName", "batch_id", "status", "error")


@register("outcome_split", f"SELECT {', '.join(_OUTCOME_COLS)} FROM ({oracle.outcome_sql()})")
def outcome_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-document outcome of embedding pending batches: a rejected text fails its whole batch."""
    d, c = _docs_and_checkpoint(spark, sf_dir)
    return ingest.plan_outcome(d, c, embedding.HashingEmbedder(reject=REJECTED)).select(*_OUTCOME_COLS)


@register("outcome_retry", f"SELECT {', '.join(_OUTCOME_COLS)} FROM ({oracle.outcome_sql()})")
def outcome_retry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A throttling service (two rate-limit errors per batch) is retried at a constant interval."""
    d, c = _docs_and_checkpoint(spark, sf_dir)
    flaky = embedding.FlakyEmbedder(embedding.HashingEmbedder(reject=REJECTED), failures=2)
    return ingest.plan_outcome(d, c, flaky, retry_interval=0.0, max_tries=5).select(*_OUTCOME_COLS)


@register("index_documents")
def index_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One full ingestion run; the index read back: id, content (cleaned), fileName, contentVector."""
    paths = _seeded_paths(spark, sf_dir)
    d = docs.documents_from_table(read_table(spark, sf_dir, "documents"))
    ingest.ingest(spark, d, paths, embedding.HashingEmbedder(reject=REJECTED))
    return ingest.read_index(spark, paths)


@register("index_vectors", oracle.index_vectors_sql(dim=64))
def index_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every element of every vector of the index after one run, beside content and fileName."""
    index = index_documents(spark, sf_dir)
    return index.select("id", "content", "fileName", F.posexplode("contentVector").alias("place", "value")).select(
        "id", "content", "fileName", "place", F.round(F.col("value").cast("double"), 6).alias("value"))


@register(
    "failure_log",
    f"SELECT id, fileName, text, error FROM ({oracle.outcome_sql()}) WHERE status = 'failed'",
)
def failure_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The failure log after one run: every row of a failed batch with raw text and the error."""
    paths = _seeded_paths(spark, sf_dir)
    d = docs.documents_from_table(read_table(spark, sf_dir, "documents"))
    ingest.ingest(spark, d, paths, embedding.HashingEmbedder(reject=REJECTED))
    return docs.read_failures(spark, paths.failures)


@register(
    "checkpoint_resume",
    f"SELECT id FROM ({oracle.CHECKPOINT_SQL}) UNION ALL "
    f"SELECT id FROM ({oracle.outcome_sql()}) WHERE status = 'success'",
)
def checkpoint_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs, the first cut off after the index write: the checkpoint ends holding each id once."""
    paths = _seeded_paths(spark, sf_dir)
    d = docs.documents_from_table(read_table(spark, sf_dir, "documents"))
    ingest.ingest(spark, d, paths, embedding.HashingEmbedder(reject=REJECTED), run=1, crash_after="index")
    ingest.ingest(spark, d, paths, embedding.HashingEmbedder(reject=REJECTED), run=2)
    return docs.read_checkpoint(spark, paths.checkpoint)


@register(
    "upsert_documents",
    "SELECT conv_id, turn, role, text FROM (SELECT *, row_number() OVER "
    "(PARTITION BY conv_id ORDER BY turn DESC NULLS LAST) AS rn FROM conversations WHERE conv_id IS NOT NULL) WHERE rn = 1",
)
def upsert_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns upserted by ``conv_id`` in two writes; the newest turn wins, and
    the second write rewrites only the buckets that its conversations fall into."""
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    table = upsert.BucketedTable(spark, work_dir(spark, "upsert"), key="conv_id", version="turn")
    first = F.col("turn").eqNullSafe(F.lit(0))
    for part in (turns.where(first), turns.where(~first)):
        table.upsert(part.where(F.col("conv_id").isNotNull()))
    return table.read()


# ---------------------------------------------------------------------------
# Search over the index
# ---------------------------------------------------------------------------
@register("vector_topk", oracle.vector_topk_sql())
def vector_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact cosine top-10 of every label's mean vector among all embeddings."""
    corpus = read_table(spark, sf_dir, "embeddings")
    return search.vector_topk(corpus, search.label_centroids(corpus), k=10)


@register("vector_topk_lsh")
def vector_topk_lsh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Approximate top-10 (random-projection LSH candidates, exact re-rank); rows-only check."""
    corpus = read_table(spark, sf_dir, "embeddings")
    return search.vector_topk_lsh(corpus, search.label_centroids(corpus), k=10)


@register("vector_topk_ivf")
def vector_topk_ivf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Approximate top-10 through an inverted file over all embeddings, built and read back;
    recall against the exact search is tested."""
    corpus = read_table(spark, sf_dir, "embeddings")
    index = nearest.InvertedFile(spark, work_dir(spark, "ivf")).build(corpus)
    return search.vector_topk_ivf(index, search.label_centroids(corpus), k=10)


@register("keyword_search", oracle.bm25_sql())
def keyword_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """BM25 top-10 documents (content and fileName) for every benchmark passage as a query."""
    index = docs.documents_from_table(read_table(spark, sf_dir, "documents")).select(
        "id", qtext.clean_text(F.col("text")).alias("content"), "fileName"
    )
    queries = read_table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("qid"),
                                                            F.col("text").alias("query"))
    return search.bm25(index, queries, k=10)


# ---------------------------------------------------------------------------
# Streaming ingestion of events
# ---------------------------------------------------------------------------
def _write_messages(messages: DataFrame, path: str, files: int | None = None) -> None:
    """Land broker messages as parquet files (a replayable stand-in for the broker).

    One file per broker partition; by default as many partitions as task slots,
    as a topic is sized for its consumers, so the stream decodes in every slot.
    """
    n = files or messages.sparkSession.sparkContext.defaultParallelism
    if messages.rdd.getNumPartitions() != n:
        messages = messages.repartition(n)
    messages.write.mode("append").parquet(path)


@register("stream_append", oracle.sales_events_sql())
def stream_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Avro messages -> readStream -> decode -> append to a parquet table (availableNow); table read back."""
    root = work_dir(spark, "stream_append")
    avro_text = sales_event_avro()
    _write_messages(ev.avro_messages(read_table(spark, sf_dir, "lineitem"), avro_text), f"{root}/source")
    events = stream.decode_stream(stream.read_messages(spark, f"{root}/source"), "avro", avro_text)
    stream.run_to_end(stream.append_stream(events, f"{root}/table", f"{root}/checkpoint"))
    return spark.read.parquet(f"{root}/table")


@register("stream_restart", oracle.sales_events_sql())
def stream_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs on one checkpoint: backlog, new files, nothing new. Every event lands exactly once."""
    root = work_dir(spark, "stream_restart")
    avro_text = sales_event_avro()
    lineitem = read_table(spark, sf_dir, "lineitem")
    cut = F.lit(V1_CUTOVER).cast("timestamp")
    late = (F.col("l_shipdate") >= cut) | F.col("l_shipdate").isNull()  # events without a date come with the later ones
    batches = [lineitem.where(~late), lineitem.where(late), None]
    for batch in batches:
        if batch is not None:
            _write_messages(ev.avro_messages(batch, avro_text), f"{root}/source")
        events = stream.decode_stream(stream.read_messages(spark, f"{root}/source"), "avro", avro_text)
        stream.run_to_end(stream.append_stream(events, f"{root}/table", f"{root}/checkpoint"))
    return spark.read.parquet(f"{root}/table")


@register("stream_memory_sql", oracle.sales_events_sql())
def stream_memory_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON messages -> CAST(body AS STRING) -> from_json -> a catalog table -> SQL. The table has
    a name of its own, so nothing of the caller's catalog is touched."""
    root = work_dir(spark, "stream_sql")
    _write_messages(ev.json_messages(read_table(spark, sf_dir, "lineitem")), f"{root}/source")
    events = stream.decode_stream(stream.read_messages(spark, f"{root}/source"), "json")
    table = f"structured_data_{uuid.uuid4().hex[:12]}"
    stream.run_to_end(stream.table_stream(events, table, f"{root}/table", f"{root}/checkpoint"))
    return spark.sql(f"SELECT * FROM {table}")


@register("start_position", oracle.sales_events_sql(where=f"l_shipdate >= TIMESTAMP '{V1_CUTOVER}' OR l_shipdate IS NULL"))
def start_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Start at "@latest": the backlog present at first start is skipped; later events all arrive."""
    root = work_dir(spark, "start_position")
    avro_text = sales_event_avro()
    lineitem = read_table(spark, sf_dir, "lineitem")
    cut = F.lit(V1_CUTOVER).cast("timestamp")
    position = stream.StartingPosition("@latest", inclusive=True)
    late = (F.col("l_shipdate") >= cut) | F.col("l_shipdate").isNull()
    for batch in (lineitem.where(~late), lineitem.where(late)):
        _write_messages(ev.avro_messages(batch, avro_text), f"{root}/source")
        spec = stream.resolve_start(spark, f"{root}/source", f"{root}/checkpoint", position)
        messages = stream.apply_start(stream.read_messages(spark, f"{root}/source"), spec)
        events = stream.decode_stream(messages, "avro", avro_text)
        stream.run_to_end(stream.append_stream(events, f"{root}/table", f"{root}/checkpoint"))
    return spark.read.parquet(f"{root}/table")


@register("start_position_partitions", oracle.sales_events_sql(where=f"l_shipdate >= TIMESTAMP '{V1_CUTOVER}' OR l_shipdate IS NULL"))
def start_position_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Start at "@latest" of every broker partition. Offsets of one partition are far behind
    the other's, so one position for both would drop its later events."""
    root = work_dir(spark, "start_partitions")
    avro_text = sales_event_avro()
    schema = ev.partitioned_schema()
    lineitem = read_table(spark, sf_dir, "lineitem")
    late = (F.col("l_shipdate") >= F.lit(V1_CUTOVER).cast("timestamp")) | F.col("l_shipdate").isNull()
    for batch in (lineitem.where(~late), lineitem.where(late)):
        messages = ev.avro_messages(batch, avro_text, carry=("l_linenumber",))
        _write_messages(ev.in_partitions(messages, F.col("l_linenumber") % 2), f"{root}/source")
        spec = stream.resolve_start(spark, f"{root}/source", f"{root}/checkpoint", stream.StartingPosition("@latest"),
                                    partition="partition", schema=schema)
        source = stream.apply_start(stream.read_messages(spark, f"{root}/source", schema=schema), spec)
        events = stream.decode_stream(source, "avro", avro_text)
        stream.run_to_end(stream.append_stream(events, f"{root}/table", f"{root}/checkpoint"))
    return spark.read.parquet(f"{root}/table")


@register("stream_quarantine", _TRUNCATED_RETURNS_SQL)
def stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream with truncated returned-item bodies: one query decodes each micro-batch
    once and writes good events to the table and bad bodies (with the reason) to a
    quarantine table. Both read back together: nothing is lost, nothing lands twice."""
    root = work_dir(spark, "stream_quarantine")
    avro_text = sales_event_avro()
    _write_messages(_truncated_return_messages(spark, sf_dir, avro_text), f"{root}/source")
    decoded = stream.decode_stream(stream.read_messages(spark, f"{root}/source"), "avro", avro_text, with_errors=True,
                                   keep_message=True)
    stream.run_to_end(stream.append_with_quarantine(decoded, f"{root}/table", f"{root}/quarantine",
                                                    f"{root}/checkpoint"))
    table = spark.read.parquet(f"{root}/table").withColumn(qjson.CORRUPT_COLUMN, F.lit(None).cast("string"))
    return table.unionByName(spark.read.parquet(f"{root}/quarantine").drop(stream.MESSAGE_COLUMN)).drop("batch_id")


# ---------------------------------------------------------------------------
# Tables and files
# ---------------------------------------------------------------------------
@register("table_ddl", oracle.sales_events_sql())
def table_ddl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CREATE DATABASE/TABLE IF NOT EXISTS (bucketed by session_id), INSERT decoded events, SELECT."""
    root = work_dir(spark, "table_ddl")
    # names of this run's own: nothing of the caller's catalog is dropped or inserted into
    run = uuid.uuid4().hex[:12]
    events_table, index_table = f"sales_events_{run}", f"search_index_{run}"
    tables.create_event_table(spark, "quayside_db", events_table, f"{root}/sales_events")
    tables.create_index_table(spark, "quayside_db", index_table, f"{root}/search_index", dim=64)
    tables.create_index_table(spark, "quayside_db", index_table, f"{root}/search_index", dim=64)  # no-op
    events = qjson.decode_json_messages(ev.json_messages(read_table(spark, sf_dir, "lineitem")))
    tables.insert_events(events, f"quayside_db.{events_table}")
    return spark.sql(f"SELECT * FROM quayside_db.{events_table}")


@register(
    "csv_multiline",
    """SELECT 'part_' || CAST(p_partkey AS VARCHAR) AS title, p_name AS name, p_brand AS brand, p_type AS type,
       p_size AS size, p_retailprice AS retail_price,
       'http://parts.example.com/img?id=' || CAST(p_partkey AS VARCHAR) || '&zoom=1' AS thumbnail
FROM part""",
)
def csv_multiline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records with a multi-line quoted ``Key: value`` field, written as one CSV file, re-read by
    splits whose borders may lie inside quotes, then parsed."""
    root = work_dir(spark, "csv")
    part = read_table(spark, sf_dir, "part")
    text = F.concat_ws(
        "\n",
        F.concat(F.lit("Name: "), "p_name"),
        F.concat(F.lit("Brand: "), "p_brand"),
        F.concat(F.lit("Type: "), "p_type"),
        F.concat(F.lit("Size: "), F.col("p_size").cast("string")),
        F.concat(F.lit("Retail Price: "), F.col("p_retailprice").cast("string")),
        F.concat(F.lit("Thumbnail: http://parts.example.com/img?id="), F.col("p_partkey").cast("string"),
                 F.lit("&zoom=1")),
    )
    records = part.select(F.concat(F.lit("part_"), F.col("p_partkey").cast("string")).alias("title"),
                          F.concat(text, F.lit("\n")).alias("text"))
    docs.write_csv(records.coalesce(1), f"{root}/books")
    back = docs.read_split_csv(spark, f"{root}/books", "title STRING, text STRING")
    kv = back.select("title", qtext.key_value_pairs(F.col("text")).alias("kv"))
    return kv.select(
        "title",
        qtext.key_value(F.col("kv"), "Name").alias("name"),
        qtext.key_value(F.col("kv"), "Brand").alias("brand"),
        qtext.key_value(F.col("kv"), "Type").alias("type"),
        qtext.key_value(F.col("kv"), "Size").cast("int").alias("size"),
        qtext.key_value(F.col("kv"), "Retail Price").cast("double").alias("retail_price"),
        qtext.key_value(F.col("kv"), "Thumbnail").alias("thumbnail"),
    )
