"""N-gram Jaccard join: a blocked sparse product of the document by n-gram incidence matrix.

A document's set holds its distinct n-word shingles, as 64-bit hashes. Two documents link when the intersection has
at least ``percent`` of the union. Documents with equal sets form a class of which only the representative (smallest
key) takes part. Columns of the matrix are n-grams; a row keeps the cells that a pair above the threshold must share:
with all n-grams in one global order, two linked sets of n1 and n2 members share at least overlap(min(n1, n2)) of the
first n - ceil(percent * n) + overlap(n) of each. Frequent n-grams stand last in that order, so columns that much text shares
are hardly ever kept. Overlaps are counted by pair over the kept cells; pairs below the bounds are discarded, also those
whose cells stand so late in either set that what follows can't make up the rest; the sets of the others are
intersected exactly.

A group of thousands of near copies would make a pair of any two in a column. So the product is taken in two rounds.
The first has only pairs of neighbours in a column, ordered by size, and of each member with the one that holds the
n-gram at the smallest position, for each member the closest few of these; their links give components. The second has the pairs of a column whose documents are
still in different components, so no link between two components is lost. Documents without any link are paired one by
one. A component is first met by its hub, the smallest key: Jaccard distance is a metric, so with the exact distances of
hubs to each other and to their members, only documents can link with a member of a component that are not farther from its
hub than the limit and that component's radius. Such a document that doesn't link with the hub itself links with a member only
if both have enough of the same n-grams that the hub lacks, or lack enough of the same ones that it has; so these few are
joined, and not every such document with every member. A document that shares a passage with thousands of near copies is
thus held against their hub, not against each of them.

The global order only matters for speed: it puts the n-grams last that are frequent within Arrow batches, at most
``MAX_FREQUENT`` of them. Nothing depends on it for results.

Defined results: null and empty texts, and texts without words, have an empty set, link with nothing and are
components of their own; fewer words than n make one shingle of the whole sequence; rows that repeat a key come back
once, with the first set by digest; every row with a null key comes back, in the component of an equal set if any. An empty table gives an empty result. Only key and
text are read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm import common

#: Cells that linked sets of n members must share: this percentage of n, and as many as the least (or as all that the
#: threshold asks for, if these are fewer).
OVERLAP_PERCENT, LEAST_OVERLAP = 3, 4
MAX_FREQUENT = 200_000
#: Neighbours of each document that the first round holds against it.
NEIGHBOURS = 4
#: An n-gram that so many sets of one Arrow batch hold is a candidate for the end of the order.
FREQUENT_IN_BATCH = 6
CACHE_WORDS = 100_000
SKETCH = 128

class WordHashes(dict):
    """The hash of every word (its bytes) that was looked up."""

    def __missing__(self, word: bytes) -> int:
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


class Shingler:
    """Texts to sorted arrays of distinct shingle hashes."""

    def __init__(self, n: int):
        self.n, self.hashes = n, WordHashes()

    def words(self, text: str) -> np.ndarray:
        if len(self.hashes) > CACHE_WORDS:
            self.hashes.clear()
        found = text.encode().lower().split()  # of bytes: only A-Z change, and only ASCII white space separates
        return np.fromiter(map(self.hashes.__getitem__, found), np.uint64, len(found))

    def __call__(self, text: str | None) -> np.ndarray:
        words = self.words(text or "")
        if not len(words):
            return words
        size = min(self.n, len(words))
        mixed = np.full(len(words) - size + 1, size, dtype=np.uint64)
        with np.errstate(over="ignore"):
            for j in range(size):  # the words in order, each mixed into what came before
                mixed = (mixed ^ words[j:len(words) - size + 1 + j]) * np.uint64(0x9E3779B97F4A7C15)
                mixed ^= mixed >> np.uint64(29)
                mixed *= np.uint64(0xBF58476D1CE4E5B9)
                mixed ^= mixed >> np.uint64(32)
        return np.unique(mixed)


def minimum(n: int, percent: int) -> int:
    """Members that a set of n must share with any set it links with."""
    return -(-n * percent // 100)


def overlap(n: int, percent: int) -> int:
    return min(minimum(n, percent), max(LEAST_OVERLAP, -(-n * OVERLAP_PERCENT // 100)))


def _overlap(n: F.Column, percent: int) -> F.Column:
    return F.least(F.ceil(n * percent / 100), F.greatest(F.lit(LEAST_OVERLAP), F.ceil(n * OVERLAP_PERCENT / 100)))


def ordered(members: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """A sorted set in the global order: the frequent n-grams last."""
    if not len(frequent):
        return members
    late = frequent[np.minimum(np.searchsorted(frequent, members), len(frequent) - 1)] == members
    return np.concatenate([members[~late], members[late]])


def sketch(members: np.ndarray) -> bytes:
    """Members by residue class, capped: the sum of differences is at most the size of the symmetric difference."""
    return np.minimum(np.bincount((members % np.uint64(SKETCH)).astype(np.int64), minlength=SKETCH), 65535).astype("<u2").tobytes()


def _digest(members: np.ndarray) -> bytes:
    return hashlib.blake2b(members.tobytes(), digest_size=16).digest()


def _signed(a: np.ndarray) -> np.ndarray:
    return a.view(np.int64)


def sets(docs: DataFrame, n: int, key: str, text: str) -> DataFrame:
    """Rows of two kinds: (key, n, digest) of every document, and (h, c) of n-grams that are frequent in a batch."""
    common.bounded_batches(docs.sparkSession)

    @common.handing_back
    def run(batches):
        shingler = Shingler(n)
        for pdf in batches:
            found = [shingler(t) for t in pdf["text"]]
            digests = list(map(_digest, found))
            yield pd.DataFrame({"key": pdf["key"], "n": [len(m) for m in found], "digest": digests, "h": 0, "c": 0})
            distinct = {d: m for d, m in zip(digests, found)}
            if distinct:
                h, c = np.unique(np.concatenate(list(distinct.values())), return_counts=True)
                often = c >= FREQUENT_IN_BATCH
                if often.any():
                    yield pd.DataFrame({"key": pd.array([None] * int(often.sum()), dtype=object), "n": -1, "digest": b"",
                                        "h": _signed(h[often]), "c": c[often]})

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return rows.mapInPandas(run, f"key {kind}, n int, digest binary, h bigint, c bigint")


def _prefixes(docs: DataFrame, n: int, percent: int, frequent: np.ndarray, key: str, text: str) -> DataFrame:
    """(key, n, digest, first): the cells that a document keeps, in the global order."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent)
    least = minimum_size(percent)

    @common.handing_back
    def run(batches):
        shingler, late = Shingler(n), shared.value
        for b in batches:
            keys, sizes, digests, firsts = [], [], [], []
            for k, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                members = shingler(t)
                if len(members) >= least:
                    keys.append(k)
                    sizes.append(len(members))
                    digests.append(_digest(members))
                    firsts.append(_signed(ordered(members, late)[:len(members) - minimum(len(members), percent) + overlap(len(members), percent)]))
            yield pa.RecordBatch.from_arrays([pa.array(keys, b.column(0).type), pa.array(sizes, pa.int32()), pa.array(digests, pa.binary()),
                                              pa.array(firsts, pa.list_(pa.int64()))], ["key", "n", "digest", "first"])

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).where("key is not null")
    return rows.mapInArrow(run, f"key {kind}, n int, digest binary, first array<bigint>")


def minimum_size(percent: int) -> int:
    """The smallest set that can link with one that differs from it."""
    return max(1, -(-percent // (100 - percent))) if percent < 100 else 2**31 - 1


def _packed(docs: DataFrame, n: int, key: str, text: str) -> DataFrame:
    @common.handing_back
    def run(batches):
        shingler = Shingler(n)
        for b in batches:
            found = [shingler(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([_digest(m) for m in found], pa.binary()), pa.array([m.tobytes() for m in found], pa.binary()),
                 pa.array([sketch(m) for m in found], pa.binary())], ["key", "digest", "members", "sketch"])

    return docs.mapInArrow(run, f"key {docs.schema[key].dataType.simpleString()}, digest binary, members binary, sketch binary")


def _bounds(percent: int):
    """Whether two sizes allow a link."""
    return F.least("n1", "n2") * 100 >= F.greatest("n1", "n2") * percent


def _reaches(cells: F.Column, percent: int) -> F.Column:
    """Whether an intersection can be large enough: ``cells`` up to the cell at positions p1 and p2, and all that follow."""
    most = cells + F.least(F.col("n1") - F.col("p1"), F.col("n2") - F.col("p2")) - 1
    return most * (100 + percent) >= (F.col("n1") + F.col("n2")) * percent


def _cell_reaches(percent: int) -> F.Column:
    """The same for one cell, before which the sets share at most as many as stand before it in either."""
    return _reaches(F.least("p1", "p2") + 1, percent)


#: Added to a distance, so that rounding never excludes a pair.
SLACK = 1e-9


def _measured(pairs: DataFrame, packed: DataFrame) -> DataFrame:
    """``pairs`` (a, b, limit) whose Jaccard distance is at most the limit, with that ``distance``: sketches tell most of
    the others, then the sets are intersected."""
    near = pairs.select("a", "b", "limit")
    for side in ("a", "b"):
        near = near.join(packed.select(F.col("key").alias(side), F.col("sketch").alias(f"s{side}")), side)

    @common.handing_back
    def plausible(batches):
        for b in batches:
            if not b.num_rows:
                continue
            x, y = (np.frombuffer(b"".join(b.column(i).to_pylist()), "<u2").reshape(-1, SKETCH).astype(np.int64) for i in (3, 4))
            apart, size = np.abs(x - y).sum(1), x.sum(1) + y.sum(1)
            # apart is at most the symmetric difference, which is size - 2 i for an intersection i
            ok = 2 * apart <= (b.column(2).to_numpy() + SLACK) * (size + apart)
            yield pa.RecordBatch.from_arrays([b.column(i) for i in range(3)], ["a", "b", "limit"]).filter(pa.array(ok))

    kind = pairs.schema["a"].dataType.simpleString()
    near = near.select("a", "b", "limit", "sa", "sb").mapInArrow(plausible, f"a {kind}, b {kind}, limit double")
    for side in ("a", "b"):
        near = near.join(packed.select(F.col("key").alias(side), F.col("members").alias(f"m{side}")), side)

    @common.handing_back
    def measured(batches):
        for b in batches:
            apart = []
            for x, y in zip(b.column(3).to_pylist(), b.column(4).to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                apart.append(1 - both / (len(x) + len(y) - both))
            ok = np.array(apart) <= b.column(2).to_numpy() + SLACK
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(apart, pa.float64())],
                                             ["a", "b", "distance"]).filter(pa.array(ok, pa.bool_()))

    return near.select("a", "b", "limit", "ma", "mb").mapInArrow(measured, f"a {kind}, b {kind}, distance double")


def _limit(percent: int) -> float:
    """The distance of documents that just link."""
    return 1 - percent / 100


def _verified(pairs: DataFrame, packed: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that link."""
    return _measured(pairs.withColumn("limit", F.lit(_limit(percent))), packed).select("a", "b")


def _apart(pairs: DataFrame, packed: DataFrame) -> DataFrame:
    """``pairs`` (component, key) with the ``size`` of the hub's set, what the document's set lacks (``removed``) and has
    beside it (``added``), the Jaccard ``distance``, and these n-grams (``apart``)."""
    near = pairs.select("component", "key")
    for side in ("component", "key"):
        near = near.join(packed.select(F.col("key").alias(side), F.col("members").alias(f"m{side}")), side)

    @common.handing_back
    def run(batches):
        for b in batches:
            size, removed, added, apart = [], [], [], []
            for hub, own in zip(b.column(2).to_pylist(), b.column(3).to_pylist()):
                hub, own = np.frombuffer(hub, np.uint64), np.frombuffer(own, np.uint64)
                less, more = np.setdiff1d(hub, own, assume_unique=True), np.setdiff1d(own, hub, assume_unique=True)
                size.append(len(hub))
                removed.append(len(less))
                added.append(len(more))
                apart.append(_signed(np.concatenate([less, more])))
            far = (np.array(removed) + np.array(added)) / (np.array(size) + np.array(added))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), *(pa.array(x, pa.int64()) for x in (size, removed, added)), pa.array(far, pa.float64()),
                 pa.array(apart, pa.list_(pa.int64()))], ["component", "key", "size", "removed", "added", "distance", "apart"])

    kind = pairs.schema["key"].dataType.simpleString()
    return near.select("component", "key", "mcomponent", "mkey").mapInArrow(
        run, f"component {kind}, key {kind}, size bigint, removed bigint, added bigint, distance double, apart array<bigint>")


def _across(left: DataFrame, known: DataFrame, packed: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of documents in different components that may link, at least one of them in a component of ``known``
    (key, component); ``left`` has the cells (h, key, component) of columns with several components. Of the links of a
    document with a component, those with others than the hub may be left out if it links with the hub."""
    spokes = common.stored(_apart(known.where("key <> component"), packed), "ngram-spokes")
    radius = spokes.groupBy("component").agg(F.max("distance").alias("radius"), F.count("*").alias("members"))
    units = left.select("h", "component").distinct().join(radius, "component", "left")
    grouped = units.where("radius is not null").select("h", F.col("component").alias("a"), F.col("radius").alias("r1"), F.col("members").alias("m1"))
    others = units.select("h", F.col("component").alias("b"), F.col("radius").alias("r2"), F.col("members").alias("m2"))
    met = grouped.join(others, "h").where("a <> b and (r2 is null or a < b)")
    ends = met.groupBy("a", "b").agg(*[F.max(c).alias(c) for c in ("r1", "r2", "m1", "m2")])
    limit = F.lit(_limit(percent))
    # the smaller component's documents are held against the larger one's hub
    turned = F.coalesce(F.col("m2") > F.col("m1"), F.lit(False))
    ends = ends.select(F.when(turned, F.col("b")).otherwise(F.col("a")).alias("a"), F.when(turned, F.col("a")).otherwise(F.col("b")).alias("b"),
                       F.when(turned, F.col("r2")).otherwise(F.col("r1")).alias("radius"),
                       (limit + F.col("r1") + F.coalesce("r2", F.lit(0.0))).alias("limit"))
    ends = common.stored(ends, "ngram-ends")
    hubs = common.stored(_measured(ends, packed).join(ends.select("a", "b", "radius"), ["a", "b"]), "ngram-hubs")
    # a document that not even the farthest member of the larger component can reach goes at once
    reach = F.lit(_limit(percent) + SLACK) + F.col("radius")
    alone = hubs.where(F.col("distance") <= reach).select(F.col("a").alias("component"), F.col("b").alias("key"))
    inside = spokes.select(F.col("component").alias("b"), "key", F.col("distance").alias("d"))
    guests = alone.union(hubs.join(inside, "b").where(F.col("distance") <= reach + F.col("d")).select(F.col("a").alias("component"), "key"))
    guests = common.stored(_apart(guests, packed), "ngram-guests")

    # With w = 100 removed + percent added, members x and y link if and only if they share, of what sets them apart from a
    # hub of n n-grams, s with s (100 + percent) >= w(x) + w(y) - (100 - percent) n. Without the w of the other (that of the
    # hub itself is 0) this tells whether y links with the hub; if not, y and a member that it links with share some.
    weight = 100 * F.col("removed") + percent * F.col("added")
    beyond = weight - (100 - percent) * F.col("size")
    linked = guests.where(beyond <= 0).select(F.col("component").alias("x"), F.col("key").alias("y"))
    x = spokes.select("component", "key", weight.alias("w"), "apart", F.lit(False).alias("guest"))
    y = guests.where(beyond > 0).select("component", "key", beyond.alias("w"), "apart", F.lit(True).alias("guest"))
    least = lambda rows: rows.groupBy("component").agg(F.min("w").alias("least"))
    need = lambda w: F.ceil(w / (100 + percent) - SLACK)
    rows = x.join(least(y), "component").union(y.join(least(x), "component").select(*x.columns, "least"))
    rows = rows.withColumn("need", need(F.col("w") + F.col("least"))).where(F.size("apart") >= F.col("need"))
    cells = rows.select("component", "key", "guest", "w", "need", F.explode("apart").alias("h"))
    both = cells.groupBy("component", "h").agg(F.count("*").alias("often"), F.min("guest").alias("low"), F.max("guest").alias("high")).where("low <> high")
    # as in the first round: the rare ones stand first, and of these a document keeps so many that pairs meet in one
    own = Window.partitionBy("component", "key")
    cells = cells.join(both.select("component", "h", "often"), ["component", "h"]).withColumn(
        "pos", F.row_number().over(own.orderBy("often", "h"))).withColumn("n", F.count("*").over(own)).where(
        F.col("pos") <= F.col("n") - F.col("need") + 1)
    cells = common.stored(cells.select("component", "h", "key", "guest", "w", "pos", "n"), "ngram-apart")
    one = cells.where("not guest").select("component", "h", F.col("key").alias("x"), F.col("w").alias("w1"), F.col("pos").alias("p1"), F.col("n").alias("n1"))
    two = cells.where("guest").select("component", "h", F.col("key").alias("y"), F.col("w").alias("w2"), F.col("pos").alias("p2"), F.col("n").alias("n2"))
    most = F.least("p1", "p2") + F.least(F.col("n1") - F.col("p1"), F.col("n2") - F.col("p2"))
    met = one.join(two, ["component", "h"]).where(most >= need(F.col("w1") + F.col("w2"))).select("x", "y").union(linked)
    return met.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def connected(edges: DataFrame, name: str) -> DataFrame:
    """(key, component) for every end of ``edges`` (a, b): the smallest key of its component.

    Alternating large-star and small-star rounds, each written to the shared folder, until the edges stay the same.
    A node's neighbours are never collected: rounds are minimums and joins.
    """
    def star(e: DataFrame, large: bool) -> DataFrame:
        both = e.union(e.select("b", "a")) if large else e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        low = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        met = both.join(low, "a")
        if large:
            new = met.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        else:
            new = met.select(F.col("b").alias("a"), F.col("m").alias("b")).union(low.select("a", F.col("m").alias("b")))
        return new.where("a <> b").select("a", "b").distinct()

    def mark(e: DataFrame):
        return e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    current, seen = common.stored(edges.where("a <> b").select("a", "b").distinct(), name), None
    while (now := mark(current)) != seen:
        seen = now
        current = common.stored(star(star(current, True), False), name)
    return current.groupBy(F.col("a").alias("key")).agg(F.min("b").alias("component")).union(
        current.select(F.col("b").alias("key"), F.col("b").alias("component")).distinct())


def links(docs: DataFrame, n: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text"):
    """(documents, components): (key, n, representative) of every document, and (key, component) of the
    representatives that link with another. ``components`` finds a document's component from both."""
    found = common.stored(sets(docs, n, key, text), "ngram-sets")
    frequent = found.where("n < 0").groupBy("h").agg(F.sum("c").alias("c")).orderBy(F.desc("c"), "h").limit(MAX_FREQUENT)
    late = np.sort(np.array([r["h"] for r in frequent.select("h").collect()], dtype=np.int64).view(np.uint64))
    rows = found.where("n >= 0").select("key", "n", "digest")
    # of rows that repeat a key the one with the smallest digest counts, here and in every later step
    one = rows.where("key is not null").groupBy("key").agg(F.min(F.struct("digest", "n")).alias("r"))
    all_docs = one.select("key", "r.n", "r.digest").union(rows.where("key is null"))
    all_docs = common.stored(all_docs, "ngram-documents")
    classes = all_docs.where("n > 0 and key is not null").groupBy("n", "digest").agg(F.min("key").alias("representative"))
    reps = classes.where(F.col("n") >= minimum_size(percent)).select(F.col("representative").alias("key"), "digest")

    cells = _prefixes(docs, n, percent, late, key, text).join(reps, ["key", "digest"], "left_semi").dropDuplicates(["key"])
    cells = cells.select("key", "n", F.posexplode("first").alias("pos", "h"))
    by_size = Window.partitionBy("h").orderBy("n", "key")
    # columns with one document go at once; the others are kept in the shared folder
    cells = common.stored(cells.withColumn("before", F.lag(F.struct("key", "n", "pos")).over(by_size)).withColumn(
        "lead", F.min(F.struct("pos", "n", "key")).over(by_size)).withColumn("after", F.lead("key").over(by_size)).where(
        F.col("before").isNotNull() | F.col("after").isNotNull()), "ngram-cells")
    # a document needs as many cells that others have as it must share with its smallest partner
    involved = cells.groupBy("key").agg(F.count("*").alias("cells"), F.max("n").alias("n")).where(
        F.col("cells") >= _overlap(F.ceil(F.col("n") * percent / 100), percent)).select("key")
    involved = common.stored(involved, "ngram-involved")
    first = F.explode(F.array_distinct(F.array("before", F.struct(F.col("lead.key"), F.col("lead.n"), F.col("lead.pos")))))
    pair = cells.where("before is not null").select(
        F.col("key").alias("k"), F.col("n").alias("n1"), F.col("pos").alias("p1"), first.alias("o")).where("k <> o.key").select(
        "k", F.least("k", "o.key").alias("a"), F.greatest("k", "o.key").alias("b"), "n1", "p1", F.col("o.n").alias("n2"), F.col("o.pos").alias("p2"))
    near = pair.where(_bounds(percent) & _cell_reaches(percent)).groupBy("k", "a", "b").agg(F.count("*").alias("cells")).where("cells >= 2")
    # of a document's neighbours those that share most cells are enough to find its component; the second round finds the rest
    closest = Window.partitionBy("k").orderBy(F.desc("cells"), "a", "b")
    near = near.withColumn("place", F.row_number().over(closest)).where(F.col("place") <= NEIGHBOURS).select("a", "b").distinct()
    near = near.join(involved.select(F.col("key").alias("a")), "a", "left_semi").join(
        involved.select(F.col("key").alias("b")), "b", "left_semi")
    texts = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).join(involved, "key", "left_semi")
    packed = _packed(texts, n, "key", "text").join(reps, ["key", "digest"], "left_semi").dropDuplicates(["key"])
    packed = common.stored(packed.drop("digest"), "ngram-members")
    edges = common.stored(_verified(near, packed, percent), "ngram-edges")
    known = connected(edges, "ngram-components")

    # the rest: pairs of a column whose components differ
    placed = cells.join(involved, "key", "left_semi").join(known, "key", "left").select("h", "key", "n", "pos", F.coalesce("component", "key").alias("component"))
    span = placed.groupBy("h").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high")
    left = common.stored(placed.join(span.select("h"), "h", "left_semi"), "ngram-left")
    alone = left.join(known.select("key"), "key", "left_anti")
    one = alone.select("h", F.col("key").alias("a"), F.col("n").alias("n1"), F.col("pos").alias("p1"))
    two = alone.select("h", F.col("key").alias("b"), F.col("n").alias("n2"), F.col("pos").alias("p2"))
    rest = one.join(two, "h").where("n1 < n2 or n1 = n2 and a < b").where(_bounds(percent) & _cell_reaches(percent))
    rest = rest.groupBy("a", "b").agg(F.count("*").alias("cells"), *[F.max(c).alias(c) for c in ("n1", "n2", "p1", "p2")]).where(
        (F.col("cells") >= _overlap(F.col("n1"), percent)) & _reaches(F.col("cells"), percent)).select("a", "b")
    rest = rest.union(_across(left, known, packed, percent))
    more = common.stored(_verified(rest, packed, percent), "ngram-edges")
    final = connected(edges.union(more), "ngram-components") if not more.isEmpty() else known
    return all_docs.join(classes, ["n", "digest"], "left"), final


def components(docs: DataFrame, n: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_shingles, component_id) for every document."""
    members, known = links(docs, n, percent, key, text)
    placed = members.join(known.withColumnRenamed("key", "representative"), "representative", "left")
    return placed.select(F.col("key").alias(key), F.col("n").cast("long").alias("n_shingles"),
                         F.coalesce("component", "representative", "key").alias("component_id"))
