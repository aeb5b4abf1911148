"""Toxicity by maximum-scoring segments.

Tokens score by their log-odds between toxic and clean training texts under an informative Dirichlet prior; a word
never seen falls back to its longest known beginning. A linear scan (Ruzzo and Tompa's all maximal scoring
subsequences) finds every passage whose score no extension or cut improves; every occurrence of a token scores, though
in learning a text counts once for it. Karlin-Altschul statistics turn a passage's score S in a text of n words into the
extreme-value variate lambda * S - ln(K * n), with lambda and K from the tokens and passages of clean training texts: that
of the best passage, together with the sum over all significant ones, is calibrated to a probability. For that, every
training text is scored by token scores that were learned from the other folds.

Labels come from a bounded sample: for each class the ``docs_per_class`` labelled documents with the smallest hash of
their key. Every document is scored from its whole text.

Defined results: null and empty texts score like a text without any toxic passage; a key with several labels counts as toxic if any
says so, null labels are left out; without labels of both classes every score is 0; ties and repeated rows get equal scores; an
empty table gives an empty result. Only key, text and label columns are read.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm import common

DOCS_PER_CLASS = 10_000
MAX_FEATURES = 200_000
MIN_TEXTS = 3
THRESHOLD = 0.7
PREFIXES = (6, 5, 4)
PRIOR_STRENGTH = 100.0
#: How many standard errors of the log-odds are taken off before a token counts for or against.
CAUTION = 2.0
#: What a token adds that says nothing, so that passages end where nothing toxic follows.
DRIFT = -0.5
FLOOR, CEILING = -3.0, 8.0
#: A passage is significant where chance gives less than one as good in such a text.
SIGNIFICANT = 1.0
#: Chance of a token that only toxic texts have, over all tokens, under which it counts.
ONE_SIDED = 0.05
#: Share of the passages of clean texts under the score at which K is read off.
TAIL = 0.9
#: The variate of a text without any passage.
LOWEST = -12.0
#: Words that a worker remembers with their score, and with one for each fold.
CACHE_WORDS, CACHE_FOLDED = 100_000, 80_000
#: Counts that a worker holds before it hands them on; the sums are Spark's.
MAX_COUNTED = 50_000
CALIBRATION_FOLDS = 5

LETTERS = re.compile(r"[^\W\d_]+")


def features(word: str) -> list[str]:
    """A word and its beginnings, longest first; beginnings are marked by a star."""
    return [word] + [word[:n] + "*" for n in PREFIXES if len(word) > n]


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score), in order of start.

    Runs of tokens of equal sign are taken together first; the list of open segments is then kept as in Ruzzo and
    Tompa: a segment absorbs those before it back to the last one that began at a lower running sum.
    """
    at = np.flatnonzero(scores > 0)
    if not len(at):
        return []
    sums = np.concatenate([[0.0], np.cumsum(scores)])
    breaks = np.flatnonzero(np.diff(at) > 1)
    starts, ends = at[np.concatenate([[0], breaks + 1])], at[np.concatenate([breaks, [len(at) - 1]])] + 1
    open_: list[list] = []  # [start, end, sum before, sum after, index of the last one with a lower sum before]
    for start, end in zip(starts.tolist(), ends.tolist()):
        new = [start, end, sums[start], sums[end], -1]
        while True:
            j = len(open_) - 1
            while j >= 0 and open_[j][2] >= new[2]:
                j = open_[j][4]
            new[4] = j
            if j < 0 or open_[j][3] >= new[3]:
                open_.append(new)
                break
            new = [open_[j][0], new[1], open_[j][2], new[3], -1]
            del open_[j:]
    return [(s, e, after - before) for s, e, before, after, _ in open_]


@dataclass
class Model:
    scores: dict[str, float] = field(default_factory=dict)
    rate: float = 1.0  # Karlin-Altschul lambda
    size: float = 1.0  # Karlin-Altschul K
    weights: tuple[float, float, float] = (0.0, 0.0, -50.0)  # of the best variate, of the sum, and the constant

    def token(self, word: str) -> float:
        for f in features(word):
            if (s := self.scores.get(f)) is not None:
                return s + DRIFT
        return DRIFT

    def scorer(self):
        model = self

        class Tokens(dict):
            def __missing__(self, word):
                self[word] = s = model.token(word)
                return s

        cache = Tokens()

        def score(text: str | None) -> np.ndarray:
            nonlocal cache
            words = LETTERS.findall(text.lower()) if text else []
            if len(cache) > CACHE_WORDS:
                cache = Tokens()
            return np.fromiter(map(cache.__getitem__, words), dtype=np.float64, count=len(words))

        return score

    def variates(self, scores: np.ndarray) -> tuple[float, float, list[tuple[int, int, float]]]:
        """The best passage's extreme-value variate, the sum of significant ones', and the significant passages."""
        segments = maximal_segments(scores)
        n = max(len(scores), 1)
        base = np.log(self.size * n)
        worth = [(s, e, self.rate * x - base) for s, e, x in segments]
        # E = K n exp(-lambda S): a passage is significant where so few are expected by chance
        found = [w for w in worth if np.exp(-w[2]) <= SIGNIFICANT]
        best = max((w[2] for w in worth), default=LOWEST)
        return float(np.clip(best, LOWEST, 25)), float(np.clip(sum(w[2] for w in found), 0, 100)), found

    def probability(self, best: float, total: float) -> float:
        z = self.weights[0] * best + self.weights[1] * np.log1p(total) + self.weights[2]
        return float(1 / (1 + np.exp(-np.clip(z, -500, 500))))


def log_odds(counts: pd.DataFrame) -> dict[str, float]:
    """Token scores from (feature, toxic, clean) counts of texts: the log-odds ratio with an informative Dirichlet prior,
    drawn towards 0 by ``CAUTION`` standard errors; words and beginnings of each length are counted apart."""
    out: dict[str, float] = {}
    kind = counts["feature"].map(lambda f: len(f) if f.endswith("*") else 0)
    for _, part in counts.groupby(kind):
        y1, y0 = part["toxic"].to_numpy(float), part["clean"].to_numpy(float)
        n1, n0 = y1.sum(), y0.sum()
        prior = PRIOR_STRENGTH * (y1 + y0) / max(n1 + n0, 1)
        odds = lambda y, n: np.log((y + prior) / np.maximum(n + PRIOR_STRENGTH - y - prior, 1e-9))
        delta = odds(y1, n1) - odds(y0, n0)
        error = np.sqrt(1 / (y1 + prior) + 1 / (y0 + prior))
        cautious = np.sign(delta) * np.maximum(np.abs(delta) - CAUTION * np.minimum(error, np.abs(delta)), 0)
        # an unseen count leaves an error without meaning: a token of toxic texts only counts if so many of them by
        # chance are unlikely, given how many tokens there are
        enough = np.log(max(len(part), 1) / ONE_SIDED) / -np.log(min(max(n1 / max(n1 + n0, 1), 1e-6), 0.9))
        one_sided = (y0 == 0) & (y1 >= enough)
        cautious = np.where(one_sided, np.log(np.maximum(y1, 1)), np.where(y0 == 0, np.minimum(cautious, 0), cautious))
        out |= {f: float(s) for f, s in zip(part["feature"], np.clip(cautious, FLOOR, CEILING)) if abs(s) > 1e-3}
    return out


def karlin_rate(scores: np.ndarray, counts: np.ndarray) -> float:
    """lambda > 0 with sum p(s) exp(lambda s) = 1 for the token scores of clean texts; 1 if none has it."""
    p = counts / max(counts.sum(), 1)
    if not len(scores) or (scores > 0).sum() == 0 or float((p * scores).sum()) >= 0:
        return 1.0
    low, high = 1e-3, 1.0
    value = lambda x: float((p * np.exp(x * scores)).sum())
    while value(high) < 1 and high < 64:
        high *= 2
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if value(mid) < 1 else (low, mid)
    return min(high, 4.0)


def karlin_size(scores: np.ndarray, counts: np.ndarray, tokens: int, rate: float) -> float:
    """K from the passages of clean texts: as many as K * tokens * exp(-lambda * S) score S or more; 1 without any."""
    if not len(scores) or not tokens:
        return 1.0
    order = np.argsort(scores)
    scores, counts = scores[order], counts[order]
    at = int(np.searchsorted(np.cumsum(counts), TAIL * counts.sum()))
    at = min(at, len(scores) - 1)
    return float(np.clip(counts[at:].sum() / (tokens * np.exp(-rate * scores[at])), 1e-3, 1e3))


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 0.05) -> np.ndarray:
    """Weights of a logistic regression (last: constant) by Newton steps."""
    a = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(a.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a.T * (weight * p * (1 - p) + 1e-9)) @ a + ridge * np.eye(len(w)),
                               a.T @ (weight * (y - p)) - ridge * w)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return w


@common.handing_back
def _count(batches):
    counts: dict[tuple[int, int], Counter] = {}  # of (toxic, fold)

    def taken() -> pd.DataFrame:
        found = pd.concat([pd.DataFrame({"feature": list(c), "fold": fold, "toxic": np.fromiter(c.values(), np.int64, len(c)) * bool(t),
                                         "clean": np.fromiter(c.values(), np.int64, len(c)) * (not t)}) for (t, fold), c in counts.items()],
                          ignore_index=True)
        counts.clear()
        return found

    for pdf in batches:
        for text, toxic, fold in zip(pdf["text"], pdf["toxic"], pdf["fold"]):
            # a text counts once for a token, however often it repeats it
            counts.setdefault((toxic, fold), Counter()).update({f for word in set(LETTERS.findall(text.lower())) for f in features(word)})
            if sum(map(len, counts.values())) >= MAX_COUNTED:
                yield taken()
    if counts:
        yield taken()


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
        docs_per_class: int = DOCS_PER_CLASS) -> Model:
    """Learn from documents with a label in ``labels`` (key, label: 1 toxic, 0 clean)."""
    spark = docs.sparkSession
    common.bounded_batches(spark)
    known = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull()).groupBy(F.col(key).alias("key")).agg(
        F.max(F.col(label).cast("int")).alias("toxic"))
    ids = docs.select(F.col(key).alias("key")).join(known, "key").withColumn("h", F.xxhash64("key"))
    first = Window.partitionBy("toxic").orderBy("h", "key")
    chosen = ids.distinct().withColumn("r", F.row_number().over(first)).where(F.col("r") <= docs_per_class)
    chosen = F.broadcast(chosen.select("key", "toxic", F.pmod("h", F.lit(CALIBRATION_FOLDS)).cast("int").alias("fold")))
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text")).join(chosen, "key")
    rows = common.stored(rows.select("text", "toxic", "fold"), "toxicity-sample")  # 2 x docs_per_class texts at most
    if {r["toxic"] for r in rows.select("toxic").distinct().collect()} != {0, 1}:
        return Model()
    counts = rows.mapInPandas(_count, "feature string, fold int, toxic bigint, clean bigint")
    by_fold = [F.sum(F.when(F.col("fold") == f, F.col(c)).otherwise(0)).alias(f"{c}{f}")
               for f in range(CALIBRATION_FOLDS) for c in ("toxic", "clean")]
    counts = counts.groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"), *by_fold)
    counts = common.stored(counts.where((F.col("toxic") + F.col("clean")) >= MIN_TEXTS), "toxicity-counts")
    n = counts.agg(F.coalesce(F.sum("toxic"), F.lit(0)), F.coalesce(F.sum("clean"), F.lit(0))).first()
    skew = F.abs(F.log((F.col("toxic") + 0.5) / (n[0] + 1)) - F.log((F.col("clean") + 0.5) / (n[1] + 1)))
    strong = counts.orderBy(F.desc(skew * F.sqrt(F.col("toxic") + F.col("clean"))), "feature").limit(MAX_FEATURES)
    table = strong.toPandas().sort_values("feature", ignore_index=True)
    model = Model(scores=log_odds(table))

    shared = spark.sparkContext.broadcast(model)

    @common.handing_back
    def score_counts(batches):
        score = shared.value.scorer()
        for pdf in batches:
            for text, toxic in zip(pdf["text"], pdf["toxic"]):
                if not toxic:
                    tokens = score(text)
                    passages = np.array([s for _, _, s in maximal_segments(tokens)])
                    for kind, found in (("token", np.round(tokens, 1)), ("passage", np.round(passages, 2))):
                        v, c = np.unique(found, return_counts=True)
                        yield pd.DataFrame({"kind": kind, "s": v, "n": c})

    spread = rows.mapInPandas(score_counts, "kind string, s double, n bigint").groupBy("kind", "s").agg(F.sum("n").alias("n")).toPandas()
    of = {k: (g["s"].to_numpy(float), g["n"].to_numpy(float)) for k, g in spread.groupby("kind")}
    tokens, passages = (of.get(k, (np.zeros(0), np.zeros(0))) for k in ("token", "passage"))
    model.rate = karlin_rate(*tokens)
    model.size = karlin_size(*passages, int(tokens[1].sum()), model.rate)
    calibrate(rows, model, table)
    return model


def calibrate(rows: DataFrame, model: Model, table: pd.DataFrame) -> None:
    """Set the weights from rows (text, toxic, fold): logistic regression on the extreme-value variates that token
    scores learned from the other folds give; ``table`` has each token's counts by fold."""
    place = {f: i for i, f in enumerate(table["feature"])}
    scores = np.zeros((len(table), CALIBRATION_FOLDS), dtype=np.float32)
    for fold in range(CALIBRATION_FOLDS):
        rest = pd.DataFrame({"feature": table["feature"], **{c: table[c] - table[f"{c}{fold}"] for c in ("toxic", "clean")}})
        for f, s in log_odds(rest[rest["toxic"] + rest["clean"] >= MIN_TEXTS]).items():
            scores[place[f], fold] = s
    shared = rows.sparkSession.sparkContext.broadcast((model, place, scores))

    @common.handing_back
    def run(batches):
        own, place, scores = shared.value
        known: dict[str, np.ndarray] = {}

        def word_scores(word: str) -> np.ndarray:
            """A word's score in every fold: that of the longest beginning that has one."""
            if (out := known.get(word)) is None:
                out = np.zeros(CALIBRATION_FOLDS)
                for f in features(word):
                    if (i := place.get(f)) is not None:
                        out = np.where(out == 0, scores[i], out)
                if len(known) > CACHE_FOLDED:
                    known.clear()
                known[word] = out
            return out

        for pdf in batches:
            found = []
            for text, fold in zip(pdf["text"], pdf["fold"]):
                words = LETTERS.findall(text.lower())
                found.append(own.variates(np.array([word_scores(w)[fold] for w in words], dtype=float) + DRIFT)[:2])
            yield pd.DataFrame({"best": [f[0] for f in found], "total": [f[1] for f in found], "toxic": pdf["toxic"]})

    got = rows.mapInPandas(run, "best double, total double, toxic int").toPandas()  # 2 x docs_per_class rows at most
    got = got.sort_values(["best", "total", "toxic"])
    y = got["toxic"].to_numpy(float)
    x = np.column_stack([got["best"], np.log1p(got["total"])])
    # both classes weigh the same, so that the probability doesn't depend on how many of each were labelled
    weight = np.where(y == 1, 0.5 / max(y.mean(), 1e-9), 0.5 / max(1 - y.mean(), 1e-9))
    w = logistic(x, y, weight)
    model.weights = (max(w[0], 0.0), max(w[1], 0.0), float(w[2]))


SCORED = "score double, predicted int, passages array<struct<start:int,end:int,significance:double>>"


def score(docs: DataFrame, model: Model, text: str = "text", prefix: str = "") -> DataFrame:
    """``docs`` with score, predicted and passages (first word, word after the last, variate), each named with
    ``prefix``; columns of other names pass through Arrow unchanged."""
    import pyarrow as pa
    from pyspark.sql.types import StructType, _parse_datatype_string

    spark = docs.sparkSession
    common.bounded_batches(spark)
    shared = spark.sparkContext.broadcast(model)
    new = _parse_datatype_string(SCORED)
    names = [prefix + f.name for f in new.fields]
    kept = [i for i, f in enumerate(docs.schema.fields) if f.name not in names]
    schema = StructType([docs.schema.fields[i] for i in kept] + [f.__class__(n, f.dataType) for n, f in zip(names, new.fields)])
    at = docs.columns.index(text)
    struct = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("significance", pa.float64())])

    @common.handing_back
    def run(batches):
        own = shared.value
        tokens = own.scorer()
        for b in batches:
            p, passages = [], []
            for t in b.column(at).to_pylist():
                best, total, found = own.variates(tokens(t))
                p.append(own.probability(best, total))
                passages.append([{"start": s, "end": e, "significance": w} for s, e, w in found])
            yield pa.RecordBatch.from_arrays(
                [*(b.column(i) for i in kept), pa.array(p, pa.float64()), pa.array([int(x >= THRESHOLD) for x in p], pa.int32()),
                 pa.array(passages, pa.list_(struct))], [f.name for f in schema.fields])

    return docs.mapInArrow(run, schema)
