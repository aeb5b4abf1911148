"""Which documents still need work: anti-join against the progress checkpoint."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.session import conf_bytes, estimated_bytes


def completed_ids(checkpoint: DataFrame, key: str = "id") -> DataFrame:
    """Distinct finished ids.

    ``distinct`` aggregates partially on the map side, so a key repeated by many
    runs collapses before the shuffle, and its hash exchange is the one the
    following join needs, so no second shuffle of the checkpoint.
    """
    return checkpoint.select(key).distinct()


def pending_documents(documents: DataFrame, checkpoint: DataFrame, key: str = "id", bloom: bool | None = None) -> DataFrame:
    """Documents whose id is not in the checkpoint (``LEFT ANTI JOIN``).

    Keeps rows with a null id (they never match, so they are redone every run) and
    keeps duplicate document rows. A checkpoint within Spark's broadcast threshold is
    joined as it is: AQE sends it to the documents, which stay in place. Beyond that a
    join would shuffle every document's text, so a Bloom filter of the finished ids goes
    first (:func:`may_be_done`): surely pending documents stay in place, and only the
    others are joined. ``bloom`` decides this by hand.
    """
    if bloom is None:
        spark = documents.sparkSession
        limit = spark.conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold", None) or spark.conf.get(
            "spark.sql.autoBroadcastJoinThreshold", "10m")
        size = estimated_bytes(checkpoint.select(key))
        bloom = size is not None and size > (0 if limit.startswith("-") else conf_bytes(limit))
    done = completed_ids(checkpoint, key)
    if not bloom:
        return documents.join(done, on=key, how="left_anti")
    marked = may_be_done(documents, done, key)
    sure = marked.where(~F.col(MAYBE)).drop(MAYBE)
    return sure.unionByName(marked.where(MAYBE).drop(MAYBE).join(done, on=key, how="left_anti"))


#: Bits of one block of the filter (those of Spark's bitmap functions), bits set per id, bits per id,
#: and the largest number of blocks: the filter that is sent to the tasks has 64 MB at most.
BLOCK_BITS, BITS_SET, BITS_PER_ID, MAX_BLOCKS = 32_768, 4, 10, 16_384
MAYBE = "_maybe"


def _positions(key: str) -> list:
    return [F.pmod(F.xxhash64(F.col(key), F.lit(i)), F.lit(BLOCK_BITS)) for i in range(1, BITS_SET + 1)]


def finished_filter(done: DataFrame, key: str = "id") -> tuple[DataFrame, int]:
    """``(_block, _bits)``: a Bloom filter of the distinct ids ``done``, and its number of blocks.

    An id sets ``BITS_SET`` bits of the one block that its hash names. Blocks are built by
    Spark's bitmap aggregate, partially before the shuffle. With more ids than
    ``MAX_BLOCKS`` was made for, more documents count as possibly done; none is missed.
    """
    n = done.count()
    blocks = int(min(MAX_BLOCKS, max(1, -(-n * BITS_PER_ID // BLOCK_BITS))))
    rows = done.where(F.col(key).isNotNull()).select(
        F.pmod(F.xxhash64(F.col(key), F.lit(0)), F.lit(blocks)).alias("_block"), F.explode(F.array(*_positions(key))).alias("_at"))
    return rows.groupBy("_block").agg(F.bitmap_construct_agg("_at").alias("_bits")), blocks


def may_be_done(documents: DataFrame, done: DataFrame, key: str = "id") -> DataFrame:
    """``documents`` with a boolean ``_maybe``: false where the id is surely not among ``done``."""
    bits, blocks = finished_filter(done, key)
    rows = documents.withColumn("_block", F.pmod(F.xxhash64(F.col(key), F.lit(0)), F.lit(blocks)))
    rows = rows.join(F.broadcast(bits), "_block", "left")

    def is_set(at):
        byte = F.conv(F.hex(F.substring(F.col("_bits"), F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        return F.pmod(F.floor(byte / F.pow(F.lit(2), at % 8)), F.lit(2)) == 1

    hit = F.col("_bits").isNotNull() & F.col(key).isNotNull()
    for at in _positions(key):
        hit = hit & is_set(at)
    return rows.withColumn(MAYBE, F.coalesce(hit, F.lit(False))).drop("_block", "_bits")


def pending_not_in(documents: DataFrame, checkpoint: DataFrame, key: str = "id") -> DataFrame:
    """``id NOT IN (checkpoint ids)`` with SQL semantics, without a broadcast.

    Differs from :func:`pending_documents` on nulls: a null document id is dropped,
    and a null id in a non-empty checkpoint makes every comparison unknown, so no
    row is kept. Both subquery tests are scalar ``EXISTS`` (one boolean each), and
    the exclusion itself is a shuffle anti-join, not a list on the driver.
    """
    ids = checkpoint.select(key)
    checkpoint_empty = ~ids.exists()
    checkpoint_has_null = ids.where(F.col(key).isNull()).exists()
    keep = checkpoint_empty | (F.col(key).isNotNull() & ~checkpoint_has_null)
    return documents.where(keep).join(completed_ids(checkpoint, key), on=key, how="left_anti")
