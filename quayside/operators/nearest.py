"""Nearest vectors by blocks: the kernel of exact search, and an inverted file for approximate search.

Vectors of corpus and queries are packed into blocks, each one row of a DataFrame: a
list of keys and a matrix of unit vectors. A join brings query blocks to corpus blocks,
and a task multiplies each pair of blocks and keeps the best ``k`` per query so far. So
no (query, vector) pair is ever a row, no query passes through the driver, and a task
holds the best of a few query blocks, however many blocks there are.

The inverted file (IVF) stores every vector under its nearest centroid, as a partition
column. A query reads the lists of its nearest ``probes`` centroids only. Centroids are
fitted on a bounded sample; every vector is indexed.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# Scores are ordered at this many decimals, then by key, so that float noise in the
# order of summation never decides a rank.
RANK_DECIMALS = 9
# Bytes of a corpus block and of a query block, and scores computed at a time.
CORPUS_BYTES, QUERY_BYTES, SCORES_AT_ONCE = 4 << 20, 1 << 20, 1 << 20
# Query blocks whose best rows a task holds at a time.
HELD_BLOCKS = 8


def _unit_rows(vectors: pa.Array) -> np.ndarray:
    """Unit vectors of an Arrow list column without nulls; a zero vector stays zero."""
    lengths = pc.list_value_length(vectors).to_numpy(zero_copy_only=False)
    if len(set(lengths.tolist())) > 1:
        raise ValueError(f"vectors of unlike lengths: {sorted(set(lengths.tolist()))}")
    m = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    m = m.reshape(len(vectors), int(lengths[0]) if len(lengths) else 0)
    norms = np.linalg.norm(m, axis=1, keepdims=True)
    return np.divide(m, norms, out=np.zeros_like(m), where=norms > 0)


def packed(df: DataFrame, group: str, key: str, vector: str, size: int, prefix: str) -> DataFrame:
    """``df`` as blocks ``(group, <prefix>keys, <prefix>block)`` of up to ``size`` bytes: rows that
    follow each other in one group. Rows without a vector are left out."""
    kind = df.schema[key].dataType
    schema = T.StructType([T.StructField(group, df.schema[group].dataType), T.StructField(f"{prefix}keys", T.ArrayType(kind)),
                           T.StructField(f"{prefix}block", T.BinaryType())])
    arrow = to_arrow_schema(schema)

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            groups, keys = b.column(group), b.column(key)
            units = _unit_rows(b.column(vector))
            rows = max(1, size // max(1, units.shape[1] * 8))
            codes = groups.dictionary_encode().indices.to_numpy(zero_copy_only=False)
            borders = np.r_[0, np.flatnonzero(np.diff(codes)) + 1, len(codes)]
            for start, stop in zip(borders, borders[1:]):
                for i in range(start, stop, rows):
                    n = min(rows, stop - i)
                    yield pa.RecordBatch.from_arrays(
                        [groups.slice(i, 1), pa.ListArray.from_arrays([0, n], keys.slice(i, n)).cast(arrow.field(1).type),
                         pa.array([units[i:i + n].tobytes()], pa.binary())], schema=arrow)

    return df.select(group, key, vector).where(F.col(vector).isNotNull()).mapInArrow(run, schema)


def _best(q: np.ndarray, scores: np.ndarray, keys: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """The best ``k`` per query of candidates, ordered by query, score (descending) and key."""
    table = pa.table({"q": q, "s": scores, "k": keys})
    order = pc.sort_indices(table, sort_keys=[("q", "ascending"), ("s", "descending"), ("k", "ascending")])
    sorted_q = q[order.to_numpy()]
    first = np.searchsorted(sorted_q, sorted_q)
    keep = order.take(pa.array(np.flatnonzero(np.arange(len(q)) - first < k)))
    at = keep.to_numpy()
    return q[at], scores[at], keys.take(keep)


class RunningBest:
    """The best ``k`` rows so far for each of ``n`` queries; scores under ``floor`` don't count."""

    def __init__(self, n: int, k: int, floor: float = -np.inf):
        self.k = k
        self.least = np.full(n, floor)  # a score below this is not among the best
        self.found: tuple | None = None

    def offer(self, keys: pa.Array, scores: np.ndarray) -> None:
        """Rows ``keys`` with their ``scores`` (row, query)."""
        scores = np.round(scores, RANK_DECIMALS)
        least = self.least
        if len(keys) > self.k:
            least = np.maximum(least, np.partition(scores, len(keys) - self.k, axis=0)[len(keys) - self.k])
        rows, q = np.nonzero(scores >= least)
        if not len(rows):
            return
        found = q, scores[rows, q], keys.take(pa.array(rows))
        if self.found is not None:
            both = [np.concatenate(x) for x in zip(self.found[:2], found[:2])]
            found = *both, pa.concat_arrays([self.found[2], found[2]])
        self.found = _best(*found, self.k)
        counts = np.bincount(self.found[0], minlength=len(self.least))
        last = np.cumsum(counts) - 1
        full = counts >= self.k
        self.least[full] = self.found[1][last[full]]

    def rows(self, qids: pa.Array, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        if self.found is not None:
            q, scores, keys = self.found
            yield pa.RecordBatch.from_arrays([qids.take(pa.array(q)), keys, pa.array(scores)], schema=schema)


class _Running:
    """The best rows so far for the queries of one block."""

    def __init__(self, qids: pa.Array, queries: np.ndarray, k: int):
        self.qids, self.queries, self.best = qids, queries, RunningBest(len(queries), k)

    def add(self, keys: pa.Array, vectors: np.ndarray) -> None:
        if vectors.shape[1] != self.queries.shape[1]:
            raise ValueError(f"vectors of length {vectors.shape[1]}, queries of length {self.queries.shape[1]}")
        step = max(1, SCORES_AT_ONCE // len(self.queries))
        for i in range(0, len(keys), step):
            self.best.offer(keys.slice(i, step), vectors[i:i + step] @ self.queries.T)


def best_of_blocks(pairs: DataFrame, k: int, qid: T.DataType, key: str, key_type: T.DataType) -> DataFrame:
    """``(qid, key, score)``: per task and query block of ``pairs`` the best ``k`` rows per query."""
    schema = T.StructType([T.StructField("qid", qid), T.StructField(key, key_type), T.StructField("score", T.DoubleType())])
    arrow = to_arrow_schema(schema)
    held_blocks = HELD_BLOCKS

    def run(batches) -> Iterator[pa.RecordBatch]:
        held: OrderedDict[tuple, _Running] = OrderedDict()
        for b in batches:
            for i in range(b.num_rows):
                name = b.column("_qpart")[i].as_py(), b.column("_qblock_no")[i].as_py()
                qids, keys = b.column("_qkeys")[i].values, b.column("_ckeys")[i].values
                if name not in held:
                    q = np.frombuffer(b.column("_qblock")[i].as_py(), dtype=np.float64).reshape(len(qids), -1)
                    held[name] = _Running(qids, q, k)
                    if len(held) > held_blocks:
                        done = held.popitem(last=False)[1]
                        yield from done.best.rows(done.qids, arrow)
                held.move_to_end(name)
                c = np.frombuffer(b.column("_cblock")[i].as_py(), dtype=np.float64).reshape(len(keys), -1)
                held[name].add(keys, c)
        for running in held.values():
            yield from running.best.rows(running.qids, arrow)

    # a pair takes a few MB; ``session.prepare`` bounds the bytes of an Arrow batch
    small = pairs.select("_qpart", "_qblock_no", "_qkeys", "_qblock", "_ckeys", "_cblock")
    return small.mapInArrow(run, schema)


def _numbered(blocks: DataFrame) -> DataFrame:
    return blocks.withColumn("_qpart", F.spark_partition_id()).withColumn("_qblock_no", F.monotonically_increasing_id())


def exact_candidates(corpus: DataFrame, queries: DataFrame, k: int, key: str, vector: str) -> DataFrame:
    """Candidates of every query's exact best ``k``: every corpus block meets every query block once.

    Corpus blocks stay as they were read, dealt into ``sides`` by their partition; each query
    block is repeated once per side, so the join has a key, and Spark may send the query
    blocks to the tasks (when they are measured small) or shuffle both.
    """
    spark = corpus.sparkSession
    sides = max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))
    c = packed(corpus.withColumn("_side", F.spark_partition_id() % F.lit(sides)), "_side", key, vector, CORPUS_BYTES, "_c")
    q = _numbered(packed(queries.withColumn("_all", F.lit(0)), "_all", "qid", "vector", QUERY_BYTES, "_q")).drop("_all")
    q = q.withColumn("_side", F.explode(F.sequence(F.lit(0), F.lit(sides - 1))))
    return best_of_blocks(q.join(c, "_side"), k, queries.schema["qid"].dataType, key, corpus.schema[key].dataType)


# ---------------------------------------------------------------------------
# Inverted file
# ---------------------------------------------------------------------------
LIST = "list"
#: Rows that centroids are fitted on (those with the smallest key hashes), and most lists.
SAMPLE_ROWS, MAX_LISTS = 20_000, 4096


def fit_centroids(corpus: DataFrame, lists: int, key: str, vector: str, sample_rows: int = SAMPLE_ROWS,
                  seed: int = 7) -> np.ndarray:
    """Unit centroids by k-means on the ``sample_rows`` rows with the smallest key hashes."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    from quayside.functions.vectors import normalize

    rows = corpus.where(F.col(vector).isNotNull()).orderBy(F.xxhash64(F.col(key), F.lit(seed))).limit(sample_rows)
    sample = rows.select(array_to_vector(normalize(F.col(vector))).alias("features"))
    if sample.isEmpty():
        return np.zeros((0, 0))
    model = KMeans(k=max(2, lists), seed=seed, maxIter=10).fit(sample)
    centres = np.array([np.asarray(c) for c in model.clusterCenters()])
    norms = np.linalg.norm(centres, axis=1, keepdims=True)
    return np.divide(centres, norms, out=np.zeros_like(centres), where=norms > 0)


def _nearest_lists(df: DataFrame, key: str, vector: str, centroids: np.ndarray, n: int) -> DataFrame:
    """``(list, key, vector)``: each row under its ``n`` nearest centroids. The centroids are
    sent to the tasks: at most ``MAX_LISTS`` of them."""
    schema = T.StructType([T.StructField(LIST, T.IntegerType()), df.schema[key], df.schema[vector]])
    arrow = to_arrow_schema(schema)

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            scores = _unit_rows(b.column(vector)) @ centroids.T
            m = min(n, scores.shape[1])
            near = np.argsort(-scores, axis=1, kind="stable")[:, :m]
            rows = pa.array(np.repeat(np.arange(b.num_rows), m))
            yield pa.RecordBatch.from_arrays(
                [pa.array(near.reshape(-1), pa.int32()), b.column(key).take(rows), b.column(vector).take(rows)], schema=arrow)

    return df.select(key, vector).where(F.col(vector).isNotNull()).mapInArrow(run, schema)


class InvertedFile:
    """Vectors stored under their nearest centroid: ``<path>/lists/list=<n>/``,
    beside ``<path>/centroids`` and an empty table ``<path>/schema``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def build(self, corpus: DataFrame, lists: int | None = None, key: str = "vec_id", vector: str = "embedding",
              sample_rows: int = SAMPLE_ROWS, seed: int = 7) -> InvertedFile:
        """Fit centroids and store every row that has a vector. ``lists`` defaults to the
        square root of the number of rows, at most ``MAX_LISTS``."""
        if lists is None:
            lists = min(MAX_LISTS, max(2, int(corpus.count() ** 0.5)))
        centroids = fit_centroids(corpus, lists, key, vector, sample_rows, seed)
        rows = [(i, c.tolist()) for i, c in enumerate(centroids)]
        self.spark.createDataFrame(rows, f"{LIST} int, centroid array<double>").coalesce(1).write.parquet(f"{self.path}/centroids")
        dealt = _nearest_lists(corpus, key, vector, centroids, 1) if len(rows) else corpus.limit(0).select(
            F.lit(0).alias(LIST), key, vector)
        dealt.limit(0).coalesce(1).write.parquet(f"{self.path}/schema")
        # a list with very many rows is split over several tasks and files
        dealt.hint("rebalance", LIST).write.partitionBy(LIST).parquet(f"{self.path}/lists")
        return self

    def centroids(self) -> np.ndarray:
        rows = self.spark.read.parquet(f"{self.path}/centroids").orderBy(LIST).collect()  # at most MAX_LISTS
        return np.array([r["centroid"] for r in rows])

    def rows(self) -> DataFrame:
        schema = self.spark.read.parquet(f"{self.path}/schema").schema
        return self.spark.read.schema(schema).parquet(f"{self.path}/lists")

    def probed(self, queries: DataFrame, probes: int) -> DataFrame:
        """``(list, qid, vector)``: the lists that each query reads."""
        return _nearest_lists(queries, "qid", "vector", self.centroids(), probes)

    def candidates(self, queries: DataFrame, k: int, probes: int, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
        """Candidates of every query's best ``k`` in the lists of its nearest ``probes`` centroids."""
        probed = self.probed(queries, probes)
        wanted = [r[0] for r in probed.select(LIST).distinct().collect()]  # at most MAX_LISTS
        rows = self.rows().where(F.col(LIST).isin(wanted))  # prunes the other lists' folders
        c = packed(rows, LIST, key, vector, CORPUS_BYTES, "_c")
        ordered = probed.repartition(LIST).sortWithinPartitions(LIST)
        q = _numbered(packed(ordered, LIST, "qid", "vector", QUERY_BYTES, "_q"))
        return best_of_blocks(q.join(c, LIST), k, queries.schema["qid"].dataType, key, rows.schema[key].dataType)
