"""Reading the input tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A parquet table; column pruning and filters reach the scan through Catalyst."""
    return spread_narrow_scan(spark.read.parquet(table_path(sf_dir, name)))


def spread_narrow_scan(df: DataFrame) -> DataFrame:
    """Round-robin a scan that yields fewer splits than the cluster has task slots.

    A parquet file written as one row group is one split, so every per-row step
    after the scan (JSON/Avro coding, text cleaning, tokenising) would run in a
    single task. Large inputs scan into thousands of splits and pass through
    untouched, so this costs a shuffle only where the input is small.
    Projections and filters still go below the exchange to the scan.
    """
    slots = df.sparkSession.sparkContext.defaultParallelism
    try:
        splits = df.rdd.getNumPartitions()
    except Exception:  # no RDD view (e.g. a remote session): leave the plan as it is
        return df
    return df.repartition(slots) if splits < slots else df


def _ddl_columns(schema) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString().upper()}" for f in schema.fields)


# Buckets of the event table: the store's partition key is a hash distribution of
# rows by ``session_id``, which is what Spark bucketing is. A cluster sizes this to
# the data (about one bucket per 1 GB written per load); tests keep it small.
EVENT_BUCKETS = 16


def create_event_table(spark: SparkSession, database: str, table: str, location: str,
                       key: str = "session_id", buckets: int = EVENT_BUCKETS) -> None:
    """``CREATE DATABASE/TABLE IF NOT EXISTS`` for the event table, hash-distributed by ``key``.

    ``CLUSTERED BY`` rather than ``PARTITIONED BY``: a session key has as many
    values as there are sessions, and a folder per value would not survive the
    key's cardinality at scale. Buckets keep the file count bounded, and an
    equality filter on the key still reads one bucket (bucket pruning).
    """
    from quayside.functions.schemas import SALES_EVENT_SCHEMA

    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {database}.{table} ({_ddl_columns(SALES_EVENT_SCHEMA)}) "
        f"USING parquet CLUSTERED BY ({key}) INTO {buckets} BUCKETS LOCATION '{location}'"
    )


def create_index_table(spark: SparkSession, database: str, table: str, location: str, dim: int | None = None,
                       bucket: str | None = None, version: str | None = None) -> None:
    """The search index table, created only when absent (a second call is a no-op).

    ``bucket`` and ``version`` name the columns that an upserted index has besides: the
    hash bucket of the id, which is its partition column, and the run that wrote a row.
    """
    extra = (f", {version} INT" if version else "") + (f", {bucket} INT" if bucket else "")
    partitioned = f" PARTITIONED BY ({bucket})" if bucket else ""
    dimensions = f"'quayside.vector.dimensions'='{dim}', " if dim else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {database}.{table} "
        f"(id STRING NOT NULL, content STRING, fileName STRING, contentVector ARRAY<FLOAT>{extra}) "
        f"USING parquet{partitioned} LOCATION '{location}' "
        f"TBLPROPERTIES ('quayside.key'='id', {dimensions}'quayside.vector.metric'='cosine')"
    )


def _bucket_spec(spark: SparkSession, table: str) -> tuple[list[str], int] | None:
    meta = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()
    info = {r["col_name"]: r["data_type"] for r in meta}
    if "Num Buckets" not in info:
        return None
    cols = [c.strip(" `") for c in info["Bucket Columns"].strip("[]").split(",")]
    return cols, int(info["Num Buckets"])


def insert_events(events: DataFrame, table: str) -> None:
    """Append into the event table.

    For a bucketed table the rows are rebalanced on the bucket key into as many
    shuffle partitions as buckets (the same hash, so a task holds whole buckets
    and writes one file per bucket). ``REBALANCE`` rather than ``repartition``
    lets adaptive execution split an oversized bucket over several writer tasks,
    so one session holding a third of all events does not land on one task.
    """
    spark = events.sparkSession
    target = spark.table(table)
    rows = events.select(*target.columns)
    spec = _bucket_spec(spark, table)
    if spec is not None:
        cols, buckets = spec
        rows = rows.hint("rebalance", buckets, *cols)
    rows.write.insertInto(table)
