"""Incremental document ingestion: skip finished ids, embed in batches, record progress.

Order of effects, so that a crash at any point can only cause work to be redone:

1. pending = documents minus checkpoint ids (anti-join);
2. outcome of embedding every batch is written once to the run folder (the
   expensive calls are never repeated for the three sinks below);
3. successful rows are upserted into the index by ``id`` (only the hash buckets that
   they fall into are rewritten);
4. failed rows are appended to the failure log (raw text and error message);
5. successful ids are appended to the checkpoint, last.

Failures are not checkpointed, so the next run retries them. A document without an
id cannot be indexed or recorded as done: it fails with that reason, apart from the
batches, so it never costs another document. Nothing is collected on the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.functions.text import clean_text
from quayside.operators.batching import assign_batches
from quayside.operators.embedding import FAILED, SUCCESS, embed_batches
from quayside.operators.pending import pending_documents
from quayside.operators.upsert import BucketedTable
from quayside.session import work_dir
from quayside.sources.documents import folder_names, read_checkpoint, write_complete
from quayside.sources.tables import create_index_table

BATCH_SIZE = 16
NO_ID = "document without an id"


@dataclass
class IngestPaths:
    root: str

    @property
    def checkpoint(self) -> str:
        return f"{self.root}/completed_ids.json"

    @property
    def failures(self) -> str:
        return f"{self.root}/failures"

    @property
    def index(self) -> str:
        return f"{self.root}/index"

    def run(self, n: int) -> str:
        return f"{self.root}/runs/{n}"

    def done(self, n: int) -> str:
        return f"{self.root}/finished/{n}"

    @classmethod
    def fresh(cls, spark: SparkSession, name: str = "ingest") -> IngestPaths:
        return cls(work_dir(spark, name))


def last_run(spark: SparkSession, paths: IngestPaths) -> int:
    """The highest run that was begun; 0 if none."""
    return max((int(n) for n in folder_names(spark, f"{paths.root}/runs") if n.isdigit()), default=0)


def index_rows(outcome: DataFrame) -> DataFrame:
    """Index documents from successful outcomes: the vector saw raw text, content is cleaned."""
    return outcome.where(F.col("status") == SUCCESS).select(
        F.col("id"),
        clean_text(F.col("text")).alias("content"),
        F.col("fileName"),
        F.col("vector").alias("contentVector"),
    )


def failure_rows(outcome: DataFrame) -> DataFrame:
    return outcome.where(F.col("status") == FAILED).select("id", "fileName", "text", "error")


def plan_outcome(documents: DataFrame, checkpoint: DataFrame, embedder=None, batch_size: int = BATCH_SIZE,
                 retry_interval: float = 60.0, max_tries: int | None = None, concurrency: int = 1) -> DataFrame:
    """The outcome DataFrame (lazy except for the batch-numbering checkpoint)."""
    has_id = F.col("id").isNotNull()
    pending = pending_documents(documents.where(has_id), checkpoint)
    batched = assign_batches(pending, "id", size=batch_size)
    outcome = embed_batches(batched, embedder, retry_interval=retry_interval, max_tries=max_tries,
                            concurrency=concurrency)
    values = {"status": F.lit(FAILED), "error": F.lit(NO_ID)}
    without = documents.where(~has_id).select(*[
        (F.col(f.name) if f.name in ("id", "fileName", "text") else values.get(f.name, F.lit(None)))
        .cast(f.dataType).alias(f.name) for f in outcome.schema.fields])
    return outcome.unionByName(without)


def ingest(
    spark: SparkSession,
    documents: DataFrame,
    paths: IngestPaths,
    embedder=None,
    batch_size: int = BATCH_SIZE,
    retry_interval: float = 60.0,
    max_tries: int | None = None,
    run: int | None = None,
    crash_after: str | None = None,
    concurrency: int = 1,
    table: str | None = None,
) -> DataFrame:
    """One ingestion run; returns the persisted outcome of this run.

    Without ``run``, a run that a crash left unfinished is completed first; if there is
    none, a new run takes the documents that no run before it has done.

    Running the same ``run`` again (after a crash at any point) completes it: a
    committed outcome is reused, the index upsert is keyed, the checkpoint is a set.

    ``crash_after`` ("index" or "failures") stops the run after that write, to test
    that a crashed run is completed by the next one. ``concurrency`` batch calls
    are kept in flight per task (for a remote embedding service). ``table`` is the
    catalog name of the index (``database.name``), created when absent and refreshed.
    """
    if run is None:
        last = last_run(spark, paths)
        finished = last == 0 or write_complete(spark, paths.done(last))
        run = last + 1 if finished else last
    run_path = paths.run(run)
    if not write_complete(spark, run_path):
        # a folder left by a crashed write holds no committed outcome: replace it
        checkpoint = read_checkpoint(spark, paths.checkpoint)
        outcome = plan_outcome(documents, checkpoint, embedder, batch_size, retry_interval, max_tries,
                               concurrency)
        outcome.write.mode("overwrite").parquet(run_path)
    # re-running a run whose outcome was committed reuses it: the embedder is not
    # called again, only the idempotent steps below are redone
    outcome = spark.read.parquet(run_path)

    if not outcome.where(F.col("status") == SUCCESS).isEmpty():
        index_table(spark, paths).upsert(index_rows(outcome).withColumn("_run", F.lit(run)))
    if table is not None:
        register_index(spark, paths, table)
    if crash_after == "index":
        return outcome
    failures = failure_rows(outcome)
    if not failures.isEmpty():
        failures.write.mode("overwrite").json(f"{paths.failures}/run={run}")
    if crash_after == "failures":
        return outcome
    done = outcome.where(F.col("status") == SUCCESS).select("id")
    if not done.isEmpty():
        done.write.mode("overwrite").json(f"{paths.checkpoint}/run={run}")
    # an empty write whose marker tells that the run is finished
    done.limit(0).write.mode("overwrite").json(paths.done(run))
    return outcome


def index_table(spark: SparkSession, paths: IngestPaths) -> BucketedTable:
    return BucketedTable(spark, paths.index, key="id", version="_run")


def register_index(spark: SparkSession, paths: IngestPaths, table: str) -> None:
    """The index under a catalog name: the table is created when absent (before the first
    document if need be) and told of buckets that are new."""
    database, _, name = table.rpartition(".")
    index = index_table(spark, paths)
    create_index_table(spark, database or spark.catalog.currentDatabase(), name, index.rows, bucket=index.BUCKET, version="_run")
    if index.buckets() is not None:
        spark.sql(f"MSCK REPAIR TABLE {table} SYNC PARTITIONS")
    spark.catalog.refreshTable(table)


def read_index(spark: SparkSession, paths: IngestPaths) -> DataFrame | None:
    current = index_table(spark, paths).read()
    return None if current is None else current.drop("_run")
