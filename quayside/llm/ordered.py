"""Ordered work on groups of any size: running totals and digests whose groups are dealt out by ranges of their order,
so that a group with a third of all rows is spread over many tasks.

Rows are dealt by ranges of (group, order), which gives every partition whole groups and at most two broken ones. The
layout is cut off with a checkpoint, as later steps rely on which partition a row is in.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import BinaryType, IntegerType, LongType, StringType, StructField, StructType

from quayside.llm import common

PART = "_part"
#: Bytes of a broken group's text that go into one row.
CHUNK = 1 << 20


def laid_out(df: DataFrame, keys: list[str]) -> DataFrame:
    """``df`` in the order of ``keys`` (nulls first) over partitions, with the partition's number."""
    order = [F.col(k).asc_nulls_first() for k in keys]
    return df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(PART, F.spark_partition_id()).checkpoint()


def running(df: DataFrame, group: str, order: list[str], totals: dict[str, Column], merge: dict[str, Column]) -> DataFrame:
    """``df`` with a running total per group (not null) for each entry of ``totals``, an aggregate of rows up to and with
    this one; ``merge`` has the aggregate over the column of that name that puts totals of parts together."""
    laid = laid_out(df, [group, *order])
    parts = laid.groupBy(PART, group).agg(*(e.alias(n) for n, e in totals.items()))
    earlier = Window.partitionBy(group).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    before = parts.select(PART, group, *(merge[n].over(earlier).alias(f"_before_{n}") for n in totals))
    here = Window.partitionBy(PART, group).orderBy(*(F.col(k).asc_nulls_first() for k in order)).rowsBetween(
        Window.unboundedPreceding, 0)
    both = laid.join(before, [PART, group])
    for n, e in totals.items():
        both = both.withColumn(n, e.over(here))
    return both.drop(PART)


def _rows(batches, columns: list[str]) -> Iterator[tuple]:
    for b in batches:
        yield from zip(*(b.column(c).to_pylist() for c in columns))


def sha256_by_group(df: DataFrame, group: str, order: list[str], piece: str, separator: str) -> DataFrame:
    """group, sha256: the hex SHA-256 of each group's pieces in order, with ``separator`` between them.

    A group that lies in one partition is hashed there. Of groups that cross a border, and of those over ``CHUNK`` bytes,
    joined pieces are passed on in rows of about ``CHUNK`` bytes: a digest reads its input in order, so such a group's
    bytes pass through one task, row by row, and none of them holds the group.
    """
    laid = laid_out(df.select(group, *order, F.col(piece).cast("string").alias("_piece")), [group, *order])
    field = laid.schema[group]
    schema = StructType([field, StructField(PART, IntegerType()), StructField("_seq", LongType()),
                         StructField("_chunk", BinaryType()), StructField("sha256", StringType())])
    last = StructType([field, StructField("sha256", StringType())])
    glue = separator.encode()

    def local(batches):
        return _batches(_digested(_rows(batches, [group, PART, "_piece"]), glue), schema)

    def chained(batches):
        for key, rows in groupby(_rows(batches, [group, "_chunk"]), key=itemgetter(0)):
            digest = hashlib.sha256(next(rows)[1])
            for _, data in rows:
                digest.update(glue + data)
            yield from _batches([(key, digest.hexdigest())], last)

    found = common.stored(laid.mapInArrow(local, schema), "digests")
    broken = found.where("sha256 IS NULL").repartition(F.col(group))
    broken = broken.sortWithinPartitions(F.col(group).asc_nulls_first(), PART, "_seq")
    return found.where("sha256 IS NOT NULL").select(group, "sha256").unionByName(broken.mapInArrow(chained, last))


def _rows(batches, columns: list[str]) -> Iterator[tuple]:
    for b in batches:
        yield from zip(*(b.column(c).to_pylist() for c in columns))


def _batches(rows: Iterable[tuple], schema: StructType) -> Iterator[pa.RecordBatch]:
    """Arrow batches of up to 1000 rows or a few chunks."""
    arrow, waiting, size = to_arrow_schema(schema), [], 0
    for row in rows:
        waiting.append(row)
        size += sum(len(x) for x in row if isinstance(x, bytes))
        if len(waiting) >= 1000 or size >= 4 * CHUNK:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*waiting), arrow)], arrow.names)
            waiting, size = [], 0
    if waiting:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*waiting), arrow)], arrow.names)


def _digested(rows: Iterator[tuple], glue: bytes) -> Iterator[tuple]:
    """Per group of a partition's (group, part, piece): its digest, or its chunks if it may go on in another partition."""
    whole = None  # a group that is complete unless it is the last one
    for i, (key, members) in enumerate(groupby(rows, key=itemgetter(0))):
        if whole:
            yield (*whole[:2], 0, None, hashlib.sha256(whole[2]).hexdigest())
            whole = None
        pieces, size, seq, part = [], 0, 0, None
        for _, part, text in members:
            pieces.append((text or "").encode())
            size += len(pieces[-1]) + 1
            if size >= CHUNK:
                yield key, part, seq, glue.join(pieces), None
                pieces, size, seq = [], 0, seq + 1
        if i and not seq:
            whole = key, part, glue.join(pieces)
        elif pieces:
            yield key, part, seq, glue.join(pieces), None
    if whole:
        yield (*whole[:2], 0, whole[2], None)
