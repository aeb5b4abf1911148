"""Deterministic fixed-size batches over a distributed DataFrame.

Batch ``b`` holds the rows ranked ``16*b .. 16*b+15`` in key order, whatever the
partitioning. The global rank is computed without a single-partition window:

1. range-partition on (key, tie-break) and sort inside partitions: every
   partition holds a contiguous, balanced key range (the range partitioner
   samples keys, so a key range holding a third of all rows is still split
   by the tie-break);
2. number rows inside each partition (``monotonically_increasing_id`` =
   partition id << 33 | local index) and checkpoint to the shared folder, so
   partition ids and positions are fixed facts, identical for every reader and
   under executor loss;
3. per-partition counts (one row per partition, a bounded table) give each
   partition's start offset through a running sum; it is broadcast back.

A batch can straddle two partitions; :func:`split_whole_batches` separates the
few straddling rows (at most ``2*(size-1)`` per partition boundary) so they can
be regrouped by a tiny shuffle while everything else is processed in place.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quayside.session import MAX_PARTITIONS, partitions_for

_LOCAL_BITS = 33
# Largest offsets table broadcast (one row of four longs per partition, about 40 MB at
# the cap). ``partitions_for`` never asks for more partitions than this, so the
# bound holds by construction; only an explicit larger ``partitions`` is refused.
# (A shuffle join would not do instead: it would reorder rows inside partitions.)
_MAX_PARTITION_ROWS_FOR_BROADCAST = MAX_PARTITIONS


@dataclass
class Batched:
    """Rows with ``rank``, ``batch_id``, ``batch_pos`` plus partition bookkeeping."""

    rows: DataFrame  # original columns + rank, batch_id, batch_pos, _pid, _start, _end, _total
    size: int

    def whole(self) -> DataFrame:
        """Rows whose batch lies entirely inside their partition (processed in place, in order)."""
        return self.rows.where(_whole(self.size))

    def straddling(self) -> DataFrame:
        """Rows of batches cut by a partition boundary (bounded: < 2*size per boundary)."""
        return self.rows.where(~_whole(self.size))

    def public(self) -> DataFrame:
        return self.rows.drop("_pid", "_start", "_end", "_total")


def _whole(size: int):
    first = F.col("batch_id") * F.lit(size)
    last_excl = F.least((F.col("batch_id") + 1) * F.lit(size), F.col("_total"))
    return (first >= F.col("_start")) & (last_excl <= F.col("_end"))




def assign_batches(
    df: DataFrame,
    order_by: list[str] | str,
    size: int = 16,
    tiebreak: str | None = None,
    partitions: int | None = None,
) -> Batched:
    """Global rank in ``order_by`` order (ties broken by ``tiebreak`` or a row hash), then batches.

    ``tiebreak`` should be unique per row (e.g. a position taken at the scan); by
    default a 64-bit hash of the whole row is used, which separates rows that
    share a key but differ in content.
    """
    order = [order_by] if isinstance(order_by, str) else list(order_by)
    n = partitions or partitions_for(df)  # grows with the input's estimated size
    tb = F.col(tiebreak) if tiebreak else F.xxhash64(*[F.col(c) for c in df.columns])
    keyed = df.withColumn("_tb", tb)
    sort_cols = [F.col(c).asc_nulls_first() for c in order] + [F.col("_tb")]
    ranged = (
        keyed.repartitionByRange(n, *sort_cols)
        .sortWithinPartitions(*sort_cols)
        .withColumn("_mid", F.monotonically_increasing_id())
    )
    # Fix partition ids and positions in the shared checkpoint folder.
    ranged = ranged.checkpoint(eager=True)
    ranged = ranged.withColumn("_pid", F.shiftright("_mid", _LOCAL_BITS)).withColumn(
        "_local", F.col("_mid").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))
    )
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    everything = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "_pid",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"),
        (F.coalesce(F.sum("_n").over(before), F.lit(0)) + F.col("_n")).alias("_end"),
        F.sum("_n").over(everything).alias("_total"),
    )
    # one row per partition: the size bound of this broadcast is the partition count
    if n > _MAX_PARTITION_ROWS_FOR_BROADCAST:
        raise ValueError("too many partitions for the offsets broadcast")
    rows = ranged.join(F.broadcast(offsets), "_pid")
    rank = F.col("_start") + F.col("_local")
    rows = (
        rows.withColumn("rank", rank)
        .withColumn("batch_id", F.floor(rank / F.lit(size)).cast("long"))
        .withColumn("batch_pos", (rank % F.lit(size)).cast("int"))
        .drop("_mid", "_local", "_tb")
    )
    return Batched(rows, size)
