"""Language-model scores by stupid backoff over bigrams, computed relationally.

A text is its lower-cased words between a begin and an end mark. Counts are over all documents but the one that is
scored (leave one out, so that copies of its own words don't vouch for a text):

    S(b | a) = c(a b) / c(a)                    where other documents have the pair,
    S(b | a) = 0.4 * max(c(b), FLOOR) / N       otherwise.

Steps: (1) word counts, a table partitioned by hash; (2) the exploded pairs of every document meet the pair counts,
partitioned by the hash of the first word, and are scored where seen or where the second word is frequent; (3) the rest
meets the word counts, partitioned by the hash of the second word; (4) partial sums are added up by document. Words are
64-bit hashes. Rows travel in blocks of columns, one for each batch of texts and hash bucket; a document has at most one
partial sum for each bucket and for each of its pairs.

Words with at least ``1 / FREQUENT_SHARE`` of all tokens, so at most ``FREQUENT_SHARE`` words, are broadcast with
their counts and stand as small numbers instead of hashes; their pairs are dealt out by the hash of the whole pair, so
that no bucket gathers a frequent word. What is shuffled grows with the input; nothing else reaches the driver.

Defined results: null, empty and blank texts have no words and only the pair of both marks; rows that share a key are scored
one by one and summed, null keys are left out; repeated texts under other keys do vouch for each other; a single document backs
off everywhere. An empty table gives an empty result. Only key and text are read.
"""

from __future__ import annotations

import struct
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm import common

BACKOFF = 0.4
FLOOR = 0.5
FREQUENT_SHARE = 5000
BEGIN, END = np.uint64(1), np.uint64(2)
#: The number of the first frequent word, and the least hash of a word; numbers stay below it.
FIRST, LEAST_HASH = 3, 1 << 32
CACHE_WORDS = 150_000
#: Characters of text whose pairs a worker holds at once.
SLICE_CHARS = 1 << 22
#: Rows of the word table that are dealt out at once.
WORDS_AT_ONCE = 1 << 20
#: Bytes of a pair in memory, and of the pairs that a bucket should hold; the count of words is measured first.
PAIR_BYTES, BUCKET_BYTES = 36, 24 << 20

#: Buckets of pairs for each bucket of documents, in which partial sums are added up as they come.
BUCKETS_PER_SUM = 8

_BLOCK = "bucket int, kind int, block binary"
#: Kinds of block and their columns.
PAIR, REST, WORD, PART = range(4)
_LAYOUT = {
    PAIR: (("key", "<i8"), ("a", "<u8"), ("b", "<u8"), ("n", "<i4"), ("na", "<i4"), ("nb", "<i4")),
    REST: (("key", "<i8"), ("b", "<u8"), ("n", "<i4"), ("nb", "<i4")),
    WORD: (("h", "<u8"), ("c", "<i8")),
    PART: (("key", "<i8"), ("score", "<i8"), ("seen", "<i8")),
}
ZSTD_LEVEL = 5
#: Partial sums of scores are whole numbers of 1 / SCORE_UNITS, so that their sum does not depend on the order.
SCORE_UNITS = 1 << 30


class Hasher:
    """Texts to the hashes of their words; words in ``numbers`` get these instead."""

    def __init__(self, numbers: dict[int, int] | None = None):
        self.known: dict[str, int] = {}
        self.numbers = numbers or {}

    def __call__(self, text: str | None) -> np.ndarray:
        if len(self.known) > CACHE_WORDS:
            self.known = {}
        out, known = [], self.known
        for w in common.WORD.findall(text.lower()) if text else []:
            h = known.get(w)
            if h is None:
                h = max(xxhash.xxh3_64_intdigest(w), LEAST_HASH)
                h = known[w] = self.numbers.get(h, h)
            out.append(h)
        return np.array(out, dtype=np.uint64)


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (a ^ (b * np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xBF58476D1CE4E5B9)
        return x ^ (x >> np.uint64(31))


def _pack(kind: int, columns: dict[str, np.ndarray]) -> bytes:
    """The columns with the first bytes of all values first, then the second bytes and so on, which compresses better."""
    parts = []
    for name, dtype in _LAYOUT[kind]:
        values = np.ascontiguousarray(columns[name], dtype=dtype)
        parts.append(np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T).tobytes())
    return struct.pack("<I", len(values)) + pa.Codec("zstd", ZSTD_LEVEL).compress(b"".join(parts), asbytes=True)


def _unpack(kind: int, blocks: list[bytes]) -> dict[str, np.ndarray]:
    found = {name: [np.zeros(0, dtype)] for name, dtype in _LAYOUT[kind]}
    for block in blocks:
        rows, at = struct.unpack_from("<I", block)[0], 0
        raw = pa.Codec("zstd").decompress(memoryview(block)[4:], rows * sum(np.dtype(d).itemsize for _, d in _LAYOUT[kind]))
        for name, dtype in _LAYOUT[kind]:
            size = np.dtype(dtype).itemsize
            raw_column = np.frombuffer(raw, np.uint8, rows * size, at).reshape(size, rows)
            found[name].append(np.ascontiguousarray(raw_column.T).view(dtype).reshape(rows))
            at += rows * size
    return {name: np.concatenate(v) for name, v in found.items()}


def _dealt(bucket: np.ndarray, buckets: int, kind: int, columns: dict[str, np.ndarray]):
    """Blocks of the rows of each bucket."""
    order = np.argsort(bucket, kind="stable")
    ends = np.searchsorted(bucket[order], np.arange(buckets), side="right")
    for i, (start, end) in enumerate(zip([0, *ends[:-1].tolist()], ends.tolist())):
        if end > start:
            at = order[start:end]
            yield i, kind, _pack(kind, {n: c[at] for n, c in columns.items()})


def _rows(found):
    found = list(found)
    return pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.int32()), pa.array([f[1] for f in found], pa.int32()),
                                       pa.array([f[2] for f in found], pa.binary())], ["bucket", "kind", "block"])


def word_counts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(h, c): occurrences of every word, and of the begin and end marks, over all documents."""
    common.bounded_batches(docs.sparkSession)

    def run(batches):
        hasher = Hasher()
        for b in batches:
            marks = np.array([BEGIN, END], dtype=np.uint64).repeat(b.num_rows)
            h, c = np.unique(np.concatenate([marks, *[hasher(t) for t in b.column(0).to_pylist()]]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(c)], ["h", "c"])

    rows = _documents(docs, key, text).select("text")
    return rows.mapInArrow(run, "h bigint, c bigint").groupBy("h").agg(F.sum("c").alias("c"))


def _documents(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text")).where("key is not null")


def _pairs(texts: list[str | None], keys: np.ndarray, hasher: Hasher) -> dict[str, np.ndarray]:
    """Distinct pairs (a, b) of each document with their count and the counts of a and b in the document."""
    out = {n: [] for n in ("key", "a", "b", "n", "na", "nb")}
    for key, text in zip(keys, texts):
        words = np.concatenate([[BEGIN], hasher(text), [END]]).astype(np.uint64)
        single, counts = np.unique(words, return_counts=True)
        ids = np.searchsorted(single, words)
        pair, n = np.unique(ids[:-1] * len(single) + ids[1:], return_counts=True)
        a, b = pair // len(single), pair % len(single)
        for name, values in (("a", single[a]), ("b", single[b]), ("n", n.astype(np.int32)), ("na", counts[a].astype(np.int32)),
                             ("nb", counts[b].astype(np.int32)), ("key", np.full(len(n), key, dtype=np.int64))):
            out[name].append(values)
    return {n: np.concatenate(v) if v else np.zeros(0, np.int64) for n, v in out.items()}


def _slices(batches):
    """Keys and texts of bounded size: documents up to ``SLICE_CHARS`` characters, one at least."""
    for b in batches:
        keys, texts, start, size = b.column(0).to_numpy(), b.column(1).to_pylist(), 0, 0
        for i, t in enumerate(texts):
            size += len(t or "")
            if size >= SLICE_CHARS or i + 1 == len(texts):
                yield keys[start:i + 1], texts[start:i + 1]
                start, size = i + 1, 0


def _lookup(h: np.ndarray, table: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Counts by sorted hash; 0 where there is none."""
    if not len(table):
        return np.zeros(len(h), dtype=np.int64)
    i = np.minimum(np.searchsorted(table, h), len(table) - 1)
    return np.where(table[i] == h, counts[i], 0)


def _grouped(columns: list[np.ndarray], n: np.ndarray) -> np.ndarray:
    """For each row, the sum of n over the rows that agree with it in ``columns``."""
    order = np.lexsort(columns[::-1])
    new = np.zeros(len(order), dtype=bool)
    for c in columns:
        s = c[order]
        new[1:] |= s[1:] != s[:-1]
    group = np.cumsum(new)
    total = np.bincount(group, weights=n[order]).astype(np.int64)
    out = np.empty(len(order), dtype=np.int64)
    out[order] = total[group]
    return out


def _summed(key: np.ndarray, score: np.ndarray, seen: np.ndarray) -> dict[str, np.ndarray]:
    """Sums of whole numbers by key."""
    order = np.argsort(key, kind="stable")
    docs, starts = np.unique(key[order], return_index=True)
    if not len(docs):
        return {"key": docs, "score": score, "seen": seen}
    return {"key": docs, "score": np.add.reduceat(score[order], starts), "seen": np.add.reduceat(seen[order], starts)}


def scores(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_words, n_seen, score, mean_score): pairs that other documents have, the sum of log scores, and its mean
    over the pairs of the text."""
    spark = docs.sparkSession
    common.bounded_batches(spark)
    rows = _documents(docs, key, text)
    words = common.stored(word_counts(docs, key, text), "lm-words")
    n = words.where("h <> 1").agg(F.sum("c")).first()[0] or 0
    buckets = int(max(spark.sparkContext.defaultParallelism, n * PAIR_BYTES // BUCKET_BYTES + 1))
    often = words.where(F.col("c") * FREQUENT_SHARE >= n).collect()  # 2 x FREQUENT_SHARE rows at most
    often = {np.int64(r["h"]).view(np.uint64).item(): r["c"] for r in sorted(often, key=lambda r: (-r["c"], r["h"]))}
    numbers = {h: i for i, h in enumerate((h for h in often if h >= LEAST_HASH), FIRST)}
    frequent = np.zeros(FIRST + len(numbers), dtype=np.int64)  # counts by number; 0: not frequent
    for h, c in often.items():
        frequent[numbers.get(h, h)] = c
    shared, sums = spark.sparkContext.broadcast((numbers, frequent)), max(1, buckets // BUCKETS_PER_SUM)

    def known(h):
        """Counts of frequent words; 0 for others."""
        counts = shared.value[1]
        return np.where(h < np.uint64(len(counts)), counts[np.minimum(h, np.uint64(len(counts) - 1)).astype(np.int64)], 0)

    def parts(key, score, seen):
        units = np.rint(score * SCORE_UNITS).astype(np.int64)
        summed = _summed(key, units, seen.astype(np.int64))
        to = _mix(summed["key"].view(np.uint64), np.zeros(1, np.uint64)) % np.uint64(sums)
        return _dealt(to.astype(np.int32), sums, PART, summed)

    def pairs(batches):
        hasher = Hasher(shared.value[0])
        for keys, texts in _slices(batches):
            p = _pairs(texts, keys, hasher)
            order = np.lexsort((p["b"], p["a"]))
            p = {k: v[order] for k, v in p.items()}
            bucket = np.where(known(p["a"]) > 0, _mix(p["a"], p["b"]), p["a"]) % np.uint64(buckets)
            yield _rows(_dealt(bucket.astype(np.int32), buckets, PAIR, p))

    def score_pairs(batches):
        blocks = [x for b in batches for x in b.column(2).to_pylist()]
        if not blocks:
            return
        p = _unpack(PAIR, blocks)
        del blocks
        total = _grouped([p["a"], p["b"]], p["n"])
        context, count = known(p["a"]), known(p["b"])
        mine = context == 0
        if mine.any():
            context[mine] = _grouped([p["a"][mine]], p["n"][mine])
        others, around = total - p["n"], context - p["na"]
        seen = others > 0
        now = seen | (count > 0)
        value = np.where(seen, np.log(np.maximum(others, 1)) - np.log(np.maximum(around, np.maximum(others, 1))),
                         np.log(BACKOFF) + np.log(np.maximum(count - p["nb"], FLOOR)) - np.log(max(n, 1)))
        yield _rows(parts(p["key"][now], (p["n"] * value)[now], np.where(seen, p["n"], 0)[now]))
        rest = {k: p[k][~now] for k in ("key", "b", "n", "nb")}
        yield _rows(_dealt((rest["b"] % np.uint64(buckets)).astype(np.int32), buckets, REST, rest))

    often_hashes = np.array(list(often), dtype=np.uint64)

    def word_blocks(batches):
        held, size = [], 0
        for b in chain(batches, [None]):
            if b is not None:
                held.append((b.column(0).to_numpy().view(np.uint64), b.column(1).to_numpy()))
                size += b.num_rows
            if held and (b is None or size >= WORDS_AT_ONCE):
                h, c = (np.concatenate(x) for x in zip(*held))
                rare = ~np.isin(h, often_hashes)  # frequent words are known to all
                yield _rows(_dealt((h[rare] % np.uint64(buckets)).astype(np.int32), buckets, WORD, {"h": h[rare], "c": c[rare]}))
                held, size = [], 0

    def score_rest(batches):
        blocks: dict[int, list[bytes]] = {REST: [], WORD: []}
        for b in batches:
            for kind, block in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                blocks[kind].append(block)
        if not blocks[REST]:
            return
        w, p = _unpack(WORD, blocks[WORD]), _unpack(REST, blocks[REST])
        del blocks
        order = np.argsort(w["h"])
        count = _lookup(p["b"], w["h"][order], w["c"][order]) - p["nb"]
        value = p["n"] * (np.log(BACKOFF) + np.log(np.maximum(count, FLOOR)) - np.log(max(n, 1)))
        yield _rows(parts(p["key"], value, np.zeros(len(value), dtype=np.int64)))

    def add_up(batches):
        so_far = _unpack(PART, [])
        for b in batches:
            more = _unpack(PART, b.column(2).to_pylist())
            so_far = _summed(*(np.concatenate([so_far[c], more[c]]) for c in ("key", "score", "seen")))
        yield pa.RecordBatch.from_arrays([pa.array(so_far[c]) for c in ("key", "score", "seen")], ["key", "score", "n_seen"])

    scored = rows.mapInArrow(pairs, _BLOCK).repartition(buckets, "bucket").mapInArrow(score_pairs, _BLOCK)
    scored = common.stored(scored, "lm-pairs")
    rest = scored.where(F.col("kind") == REST).union(words.mapInArrow(word_blocks, _BLOCK)).repartition(buckets, "bucket")
    summed = scored.where(F.col("kind") == PART).union(rest.mapInArrow(score_rest, _BLOCK)).repartition(sums, "bucket")
    total = summed.mapInArrow(add_up, "key bigint, score bigint, n_seen bigint")
    sizes = rows.select("key", F.size(common.words(F.col("text"))).cast("long").alias("n_words")).groupBy("key").agg(
        F.sum("n_words").alias("n_words"), F.count("*").alias("texts"))
    done, score = total.join(sizes, "key"), F.col("score") / SCORE_UNITS
    return done.select(F.col("key").alias(key), "n_words", "n_seen", F.round(score, 6).alias("score"),
                       F.round(score / (F.col("n_words") + F.col("texts")), 6).alias("mean_score"))
