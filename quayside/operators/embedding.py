"""Embedding documents in fixed-size batches, with retry and batch-atomic failure capture.

The embedder is any object with ``embed(texts: list[str]) -> list[list[float]]``
(one vector per text, in input order). A remote service is called the same way;
the offline default, :class:`HashingEmbedder`, hashes word tokens into a fixed
number of signed buckets and L2-normalises them.

Every batch is one call. If the call fails (after retries of rate-limit errors),
every row of the batch is marked ``failed`` with the same message and keeps its
raw text; nothing is dropped. Batches never pass through the driver.
"""

from __future__ import annotations

import re
import time
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema

from quayside.functions.schemas import OUTCOME_SCHEMA
from quayside.operators.batching import Batched

SUCCESS = "success"
FAILED = "failed"
_WORD = re.compile(r"\w+")


class RateLimitError(RuntimeError):
    """The service asks us to slow down; the call is retried."""


class EmbeddingInputError(ValueError):
    """The service rejects the input; the batch fails."""


class HashingEmbedder:
    """Offline embedder: signed feature hashing of lower-cased word tokens, L2-normalised.

    Like a hosted model it rejects empty input, failing the whole request; texts of any
    length are embedded. ``reject`` names a string that the caller does not let through.
    """

    def __init__(self, dim: int = 64, reject: str | None = None):
        self.dim = dim
        self.reject = reject

    def check(self, texts: list) -> None:
        for t in texts:
            if t is None or t == "":
                raise EmbeddingInputError("empty input")
            if self.reject and self.reject in t:
                raise EmbeddingInputError("input is rejected")

    def embed(self, texts: list) -> list[np.ndarray]:
        self.check(texts)
        out = []
        for t in texts:
            tokens = _WORD.findall(t.lower())
            vec = np.zeros(self.dim, np.float64)
            if tokens:
                uniq, counts = np.unique(np.asarray(tokens, dtype=object), return_counts=True)
                h = np.fromiter((zlib.crc32(u.encode("utf-8")) for u in uniq), np.uint64, len(uniq))
                sign = np.where((h >> np.uint64(31)) & np.uint64(1), -1.0, 1.0)
                np.add.at(vec, (h % np.uint64(self.dim)).astype(np.int64), sign * counts)
            norm = np.linalg.norm(vec)
            out.append((vec / norm if norm > 0 else vec).astype(np.float32))
        return out


class FlakyEmbedder:
    """Wraps an embedder; the first ``failures`` calls for each batch raise RateLimitError.

    Stands in for a throttling service in tests of the retry path.
    """

    def __init__(self, inner, failures: int = 1):
        self.inner = inner
        self.failures = failures
        self._calls: dict[int, int] = {}

    def embed(self, texts: list) -> list:
        key = hash(tuple(texts))
        seen = self._calls.get(key, 0)
        self._calls[key] = seen + 1
        if seen < self.failures:
            raise RateLimitError("rate limit reached, retry later")
        return self.inner.embed(texts)


def call_with_retry(
    fn: Callable[[], object],
    retry_on: tuple[type[BaseException], ...] = (RateLimitError,),
    interval: float = 60.0,
    max_tries: int | None = None,
    sleep: Callable[[float], None] = time.sleep,
):
    """Call ``fn``; on ``retry_on`` wait a constant ``interval`` (no jitter) and try again.

    ``max_tries=None`` retries without limit; other errors propagate at once.
    """
    tries = 0
    while True:
        tries += 1
        try:
            return fn()
        except retry_on:
            if max_tries is not None and tries >= max_tries:
                raise
            sleep(interval)


def _call(texts: list, embedder, retry: dict) -> tuple[list, str | None]:
    """One call for the texts of a batch: their vectors, or none and why."""
    try:
        vectors = call_with_retry(lambda: embedder.embed(texts), **retry)
        if len(vectors) != len(texts):
            raise RuntimeError(f"embedder returned {len(vectors)} vectors for {len(texts)} texts")
        return [np.asarray(v, dtype=np.float32) for v in vectors], None
    except Exception as e:  # noqa: BLE001 - any failure fails the whole batch
        return [None] * len(texts), str(e)


#: Rows of an Arrow batch that are turned into Python texts and vectors at a time.
CHUNK_ROWS = 256


def _process_sorted(rows: pa.Table, embedder, retry: dict, pool=None) -> pa.Table:
    """Every batch of rows in batch order, one call each; with a thread pool the calls overlap
    (for a remote service the wait is network time), results keep their order."""
    schema = to_arrow_schema(OUTCOME_SCHEMA)
    texts = rows.column("text").to_pylist()
    cuts = [0, *_borders(rows), len(texts)]
    groups = [texts[a:b] for a, b in zip(cuts, cuts[1:])]
    calls = (pool.map if pool is not None and len(groups) > 1 else map)(lambda g: _call(g, embedder, retry), groups)
    vectors, errors = [], []
    for found, error in calls:
        vectors.extend(found)
        errors.extend([error] * len(found))
    made = {"status": [SUCCESS if e is None else FAILED for e in errors], "error": errors, "vector": vectors}
    return pa.Table.from_arrays(
        [pa.chunked_array([pa.array(made[f.name], f.type)]) if f.name in made else rows.column(f.name).cast(f.type)
         for f in schema], schema=schema)


def _borders(rows: pa.Table) -> list[int]:
    """Where rows in batch order go on to the next batch."""
    return (np.flatnonzero(np.diff(rows.column("batch_id").to_numpy())) + 1).tolist()


def embed_batches(batched: Batched, embedder=None, retry_interval: float = 60.0,
                  max_tries: int | None = None, concurrency: int = 1) -> DataFrame:
    """Outcome of embedding every batch: ``id, fileName, text, batch_id, status, error, vector``.

    Whole batches are embedded in place (``mapInArrow`` over the range-ordered
    partitions, ``CHUNK_ROWS`` rows at a time, carrying a batch cut by a chunk border
    into the next chunk, so a worker holds one Arrow batch and one chunk however large
    the partition is); the few batches cut by a partition border are regrouped by a
    shuffle of at most ``2*(size-1)`` rows per border (``applyInArrow``, groups
    of at most ``size`` rows).

    ``concurrency`` > 1 keeps that many batch calls in flight per task (a thread
    pool inside the task, for an embedder that waits on a remote service); the
    embedder must then be safe to call from several threads. Parallelism across
    tasks comes from the partitions.
    """
    embedder = embedder or HashingEmbedder()
    retry = {"interval": retry_interval, "max_tries": max_tries}
    cols = ["id", "fileName", "text", "batch_id", "rank"]

    def whole(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from concurrent.futures import ThreadPoolExecutor

        pool = ThreadPoolExecutor(concurrency) if concurrency > 1 else None
        try:
            carry: list[pa.Table] = []  # rows of the batch that the last chunk ended in
            for batch in it:
                for at in range(0, batch.num_rows, CHUNK_ROWS):
                    rows = pa.Table.from_batches([batch.slice(at, CHUNK_ROWS)])
                    if carry and carry[-1].column("batch_id")[-1] != rows.column("batch_id")[0]:
                        yield from _process_sorted(pa.concat_tables(carry), embedder, retry, pool).to_batches()
                        carry = []
                    if borders := _borders(rows):
                        full = pa.concat_tables([*carry, rows.slice(0, borders[-1])])
                        yield from _process_sorted(full, embedder, retry, pool).to_batches()
                        carry, rows = [], rows.slice(borders[-1])
                    # a copy, which does not hold the whole Arrow batch
                    carry.append(rows.take(pa.array(range(rows.num_rows), pa.int64())))
            if carry:
                yield from _process_sorted(pa.concat_tables(carry), embedder, retry, pool).to_batches()
        finally:
            if pool is not None:
                pool.shutdown()

    def regroup(rows: pa.Table) -> pa.Table:
        return _process_sorted(rows.sort_by("rank"), embedder, retry)

    in_place = batched.whole().select(*cols).mapInArrow(whole, OUTCOME_SCHEMA)
    cut = batched.straddling().select(*cols).groupBy("batch_id").applyInArrow(regroup, OUTCOME_SCHEMA)
    return in_place.unionByName(cut)
