"""What the operators of this package share: reading tables, word splitting, batch bounds, shared folders."""

from __future__ import annotations

import re
import uuid
from functools import wraps

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are separated by these characters only (a contract of the registered queries).
WORD_SEPARATORS = " \t\n\u000b\f\r"
_SEPARATOR_CLASS = "[\\x20\\x09-\\x0D]+"
WORD = re.compile("[^\x20\x09-\x0d]+")

#: Documents whose crc32 leaves this remainder are held out of every fit.
FOLDS, HELD_OUT_FOLD = 3, 1

#: Rows and bytes of text that a Python worker holds at once.
ARROW_ROWS, ARROW_BYTES = 2000, 16 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def words(text: Column) -> Column:
    """The words of a text in order; an empty array for null or blank text."""
    trimmed = F.btrim(text, F.lit(WORD_SEPARATORS))
    return (F.when(text.isNull() | (trimmed == ""), F.array().cast("array<string>"))
            .otherwise(F.split(trimmed, _SEPARATOR_CLASS)))


def held_out(key: Column) -> Column:
    """Whether a key belongs to the fold that no fit may see; false for a null key."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % FOLDS == HELD_OUT_FOLD, F.lit(False))


def bounded_batches(spark: SparkSession) -> None:
    """Keep the Arrow batches given to Python workers small, so that long texts do not add up in one worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)


def handing_back(run):
    """``run`` (batches to batches) of a Python worker, after which Arrow's memory pool returns what it no longer uses:
    Spark keeps the worker for later tasks, and the pool would keep the most that any of them needed."""
    @wraps(run)
    def with_release(batches):
        yield from run(batches)
        pa.default_memory_pool().release_unused()

    return with_release


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder under ``spark.checkpoint.dir``, which the driver and all executors share."""
    from quayside.session import work_dir

    return work_dir(spark, name)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back, so that what follows does not compute it again
    and survives lost executors."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")  # the shuffles that led to the written table aren't needed any more
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before) if before is not None else spark.conf.unset(SHUFFLE_CLEANUP)
    return spark.read.schema(df.schema).parquet(path)


def unique_suffix() -> str:
    return uuid.uuid4().hex[:8]
