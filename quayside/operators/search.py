"""Index queries: facets, exact and approximate vector top-k, BM25 keyword search."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from quayside.functions.text import tokenize
from quayside.functions.vectors import normalize
from quayside.operators import nearest
from quayside.operators.nearest import RANK_DECIMALS
from quayside.session import work_dir


def facets(index: DataFrame, facet: str, key: str = "id") -> DataFrame:
    """Count per facet value with the first and last key; partial aggregation absorbs hot values."""
    return (
        index.groupBy(facet)
        .agg(F.count(F.lit(1)).alias("doc_count"), F.min(key).alias("first_id"), F.max(key).alias("last_id"))
        .orderBy(F.desc("doc_count"), F.asc(facet))
    )


def write_sorted(index: DataFrame, path: str, key: str = "id") -> None:
    """The index in ranges of its key: every file holds one range in order, so that a filter on
    the key reads only the row groups of that range (their statistics tell)."""
    by_key = F.col(key).asc_nulls_first()
    index.repartitionByRange(by_key).sortWithinPartitions(by_key).write.mode("errorifexists").parquet(path)


def page(index: DataFrame, size: int, after: str | None = None, key: str = "id", upto: str | None = None) -> DataFrame:
    """The next ``size`` rows in order of ``key`` behind the one of the page before (keyset
    paging: no row that a page skips is sorted or counted), within ``key <= upto``."""
    rows = index.where(F.col(key).isNotNull())
    if after is not None:
        rows = rows.where(F.col(key) > F.lit(after))
    if upto is not None:
        rows = rows.where(F.col(key) <= F.lit(upto))
    return rows.orderBy(key).limit(size)


def top_k(scored: DataFrame, group: str, key: str, score: str, k: int) -> DataFrame:
    """Best ``k`` rows per ``group`` by ``score`` (ties by ``key``), with ``rank`` 1..k.

    ``row_number() <= k`` lets Spark insert a partial window-group limit before the
    shuffle, so each task ships at most ``k`` rows per group whatever the group size.
    """
    w = Window.partitionBy(group).orderBy(F.desc(F.round(score, RANK_DECIMALS)), F.asc(key))
    return scored.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def label_centroids(corpus: DataFrame, label: str = "label", vector: str = "embedding") -> DataFrame:
    """Unit-length mean vector per label: ``(qid, vector)``.

    ``Summarizer.mean`` is a vector aggregate with a partial (map-side) buffer per
    label, so each task ships one mean per label it saw, however many rows a label
    holds, and the vectors are never exploded into one row per element.
    """
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    means = corpus.where(F.col(vector).isNotNull()).groupBy(F.col(label).alias("qid")).agg(
        Summarizer.mean(array_to_vector(F.col(vector))).alias("m"))
    return means.select("qid", normalize(vector_to_array(F.col("m"))).alias("vector"))


def vector_topk(corpus: DataFrame, queries: DataFrame, k: int = 10, key: str = "vec_id",
                vector: str = "embedding") -> DataFrame:
    """Exact cosine top-k of every query among ``corpus`` rows: ``(qid, key, rank, score)``.

    Corpus and queries meet as blocks (:mod:`quayside.operators.nearest`): every task
    keeps the best ``k`` per query of the block pairs that it multiplies, and the global
    :func:`top_k` merges these. Any number of queries is a part of the plan like the
    corpus. Rows and queries without a vector have no neighbours; queries that share a
    qid compete for its ``k`` places.
    """
    best = top_k(nearest.exact_candidates(corpus, queries, k, key, vector), "qid", key, "score", k)
    return best.select("qid", key, "rank", F.round("score", 4).alias("score"))


def vector_topk_ivf(index: nearest.InvertedFile, queries: DataFrame, k: int = 10, probes: int = 8,
                    key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Approximate cosine top-k through an inverted file: the exact top-k among the rows
    stored under each query's nearest ``probes`` centroids, ``(qid, key, rank, score)``."""
    best = top_k(index.candidates(queries, k, probes, key, vector), "qid", key, "score", k)
    return best.select("qid", key, "rank", F.round("score", 4).alias("score"))


def vector_topk_lsh(corpus: DataFrame, queries: DataFrame, k: int = 10, key: str = "vec_id",
                    vector: str = "embedding", bucket_length: float = 1.0, tables: int = 8,
                    max_distance: float = 1.5, seed: int = 7) -> DataFrame:
    """Approximate cosine top-k: random-projection LSH candidates, then exact re-rank.

    On unit vectors Euclidean order equals cosine order, so ``BucketedRandomProjectionLSH``
    buckets unit vectors and ``approxSimilarityJoin`` returns the pairs sharing a
    bucket within ``max_distance``; those candidates are scored exactly.
    Approximate by design (like a graph index): a true neighbour that never shares
    a bucket with the query is missed.
    """
    from pyspark.ml.feature import BucketedRandomProjectionLSH
    from pyspark.ml.functions import array_to_vector

    c = corpus.select(F.col(key), array_to_vector(normalize(F.col(vector))).alias("features"))
    q = queries.select(F.col("qid"), array_to_vector(normalize(F.col("vector"))).alias("features"))
    model = BucketedRandomProjectionLSH(inputCol="features", outputCol="hashes", bucketLength=bucket_length,
                                       numHashTables=tables, seed=seed).fit(c)
    pairs = model.approxSimilarityJoin(c, q, max_distance, distCol="dist")
    scored = pairs.select(
        F.col("datasetB.qid").alias("qid"),
        F.col(f"datasetA.{key}").alias(key),
        (F.lit(1.0) - F.col("dist") * F.col("dist") / 2).alias("score"),
    )
    best = top_k(scored, "qid", key, "score", k)
    return best.select("qid", key, "rank", F.round("score", 4).alias("score"))


# (query, term) pairs of a query block, which is sent to every task, and queries scored at a time.
BLOCK_TERMS, QUERIES_AT_ONCE, DOCS_AT_ONCE = 20_000, 256, 256


def _query_blocks(queries: DataFrame) -> list[DataFrame]:
    """The queries as ``(qid, terms)`` in blocks of about ``BLOCK_TERMS`` terms each, by hash
    of the qid; every block is measured, and they are dealt anew until none is over twice that."""
    terms = F.flatten(F.collect_list(tokenize(F.col("query"))))
    rows = queries.groupBy("qid").agg(F.array_sort(F.array_distinct(terms)).alias("terms"))
    total = rows.agg(F.sum(F.size("terms"))).first()[0] or 0
    n = -(-total // BLOCK_TERMS)
    while n > 1:
        block = F.pmod(F.xxhash64("qid", F.lit(n)), F.lit(n))
        sizes = rows.groupBy(block.alias("b")).agg(F.sum(F.size("terms")).alias("s"), F.count(F.lit(1)).alias("n"))
        if sizes.where((F.col("s") > 2 * BLOCK_TERMS) & (F.col("n") > 1)).isEmpty():
            return [rows.where(block == i) for i in range(n)]
        n *= 2
    return [rows] if total else []


def _term_vectors(tokens: DataFrame, key: str, vocabulary: list[str]) -> DataFrame:
    """``(key, dl, codes, tfs)``: per document its length and how often it holds the terms of
    ``vocabulary``, by their places in it. Counted inside the row: no (document, term) rows."""
    kind = tokens.schema[key].dataType
    schema = T.StructType([T.StructField(key, kind), T.StructField("dl", T.IntegerType()),
                           T.StructField("codes", T.ArrayType(T.IntegerType())), T.StructField("tfs", T.ArrayType(T.IntegerType()))])
    arrow = to_arrow_schema(schema)
    terms = pa.array(vocabulary, pa.string())

    def run(batches):
        for b in batches:
            lists = b.column("toks")
            dl = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
            found = pc.index_in(lists.flatten(), value_set=terms)
            doc = np.repeat(np.arange(len(dl)), dl)[found.is_valid().to_numpy(zero_copy_only=False)]
            pairs, tf = np.unique(doc * len(terms) + found.drop_null().to_numpy(), return_counts=True)
            offsets = pa.array(np.searchsorted(pairs, np.arange(len(dl) + 1) * len(terms)), pa.int32())
            codes = pa.ListArray.from_arrays(offsets, pa.array(pairs % len(terms), pa.int32()))
            tfs = pa.ListArray.from_arrays(offsets, pa.array(tf, pa.int32()))
            columns = [b.column(key), pa.array(dl, pa.int32()), codes, tfs]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow)], schema=arrow)

    return tokens.mapInArrow(run, schema)


def _bm25_candidates(vectors: DataFrame, key: str, qids: list, terms: list[list[int]], idf: np.ndarray, avgdl: float,
                     k: int, k1: float, b: float, qid_type) -> DataFrame:
    """``(qid, key, score)``: the best ``k`` documents per query of every task.

    Documents are weighted against the terms of up to ``QUERIES_AT_ONCE`` queries by one
    matrix product. The sum of a document's weights bounds its score for any of them, and
    one that cannot reach the least of their ``k``-th best scores is not scored.
    """
    schema = T.StructType([T.StructField("qid", qid_type), vectors.schema[key], T.StructField("score", T.DoubleType())])
    arrow = to_arrow_schema(schema)
    groups = []
    for i in range(0, len(qids), QUERIES_AT_ONCE):
        some = terms[i:i + QUERIES_AT_ONCE]
        columns = np.unique(np.concatenate([np.array(t, dtype=np.int64) for t in some]))
        groups.append((pa.array(qids[i:i + QUERIES_AT_ONCE], arrow.field(0).type), columns, some))

    def run(batches):
        held = []
        for names, columns, some in groups:
            holds = np.zeros((len(columns), len(some)))
            for j, t in enumerate(some):
                holds[np.searchsorted(columns, t), j] = 1
            held.append((names, columns, holds, nearest.RunningBest(len(some), k, floor=np.nextafter(0, 1))))
        for batch in batches:
            for i in range(0, batch.num_rows, DOCS_AT_ONCE):
                docs = batch.slice(i, DOCS_AT_ONCE)
                keys, dl = docs.column(key), docs.column("dl").to_numpy().astype(np.float64)
                size = pc.list_value_length(docs.column("codes")).to_numpy()
                doc, code = np.repeat(np.arange(len(dl)), size), docs.column("codes").flatten().to_numpy()
                tf = docs.column("tfs").flatten().to_numpy().astype(np.float64)
                norm = k1 * (1.0 - b + b * dl / avgdl)
                weights = np.zeros((len(dl), len(idf)))
                weights[doc, code] = idf[code] * tf * (k1 + 1.0) / (tf + norm[doc])
                for _, columns, holds, best in held:
                    part = weights[:, columns]
                    may = np.flatnonzero(part.sum(1) + 1e-6 >= best.least.min())
                    if len(may):
                        best.offer(keys.take(pa.array(may)), part[may] @ holds)
        for names, _, _, best in held:
            yield from best.rows(names, arrow)

    return vectors.mapInArrow(run, schema)


def bm25(
    index: DataFrame,
    queries: DataFrame,
    k: int = 10,
    key: str = "id",
    fields: tuple[str, ...] = ("content", "fileName"),
    k1: float = 1.2,
    b: float = 0.75,
) -> DataFrame:
    """BM25 keyword search of ``queries(qid, query)`` over the tokens of ``fields``: ``(qid, id, rank, score)``.

    Queries are taken in blocks of bounded size. For each block the documents are
    tokenised once into term vectors, which are written to the shared folder. Document
    frequencies are counted from these (one small row per term leaves a task), and the
    weighted query block goes back to the tasks, each of which keeps the best ``k``
    documents per query. So only term counts and candidates are shuffled: never a row per
    (document, term) or per (document, query), however common a word is.

    Null fields are empty; a document without a term of a query is no result for it;
    documents that share a key are scored one by one; equal scores are ordered by key.
    """
    spark = index.sparkSession
    kind, qid_type = index.schema[key], queries.schema["qid"].dataType
    tokens = index.select(F.col(key), F.concat(*[tokenize(F.col(f)) for f in fields]).alias("toks"))
    found = None
    for rows in _query_blocks(queries):
        block = [r for r in rows.collect() if r["terms"]]  # within the block's bound
        if not block:
            continue
        vocabulary = sorted({t for r in block for t in r["terms"]})
        path = work_dir(spark, "bm25")
        _term_vectors(tokens, key, vocabulary).write.parquet(path)
        vectors = spark.read.parquet(path)
        n_docs, avgdl = vectors.agg(F.count(F.lit(1)), F.avg("dl")).first()
        counts = vectors.select(F.explode("codes").alias("code")).groupBy("code").count().collect()  # one per term
        df = np.zeros(len(vocabulary))
        for code, count in counts:
            df[code] = count
        places = {t: i for i, t in enumerate(vocabulary)}
        part = _bm25_candidates(vectors, key, [r["qid"] for r in block], [[places[t] for t in r["terms"]] for r in block],
                                np.log(1.0 + (n_docs - df + 0.5) / (df + 0.5)), avgdl or 1.0, k, k1, b, qid_type)
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = spark.createDataFrame([], T.StructType([T.StructField("qid", qid_type), kind, T.StructField("score", T.DoubleType())]))
    best = top_k(found, "qid", key, "score", k)
    return best.select("qid", key, "rank", F.round("score", 4).alias("score"))
