"""Language identification by word-first backoff.

A known word adds its log frequency in each language; an unseen word is scored by its character n-grams, the longest
order of which any is known, down to single characters. The language with the highest sum wins, and the score is its
posterior under equal priors.

The model learns from (text, language) rows. It is fitted on a bounded sample: for each language the
``docs_per_language`` documents with the smallest hash of their key, whatever the size of the table; all documents
are predicted from their whole text. The model has at most ``MODEL_ENTRIES`` words and n-grams, shared evenly among
the languages, so what is broadcast is bounded too.

Defined results: null text, and text without a letter, is ``und`` with score 0; rows without a language or text are
not learned from; with nothing learned every text is ``und``; ties between languages go to the first in alphabetical
order; repeated rows get one result each; an empty table gives an empty result. Only key, text and language are read.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm import common

DOCS_PER_LANGUAGE = 2000
MODEL_ENTRIES = 600_000
MAX_ORDER = 5
SMOOTHING = 0.5
UNKNOWN = "und"
#: Words scored so far that a worker remembers; beyond it the memory starts anew.
CACHE_WORDS = 400_000

LETTERS = re.compile(r"[^\W\d_]+")


def letter_words(text: str) -> list[str]:
    """Runs of letters (Unicode category L); numerals such as a half or a Roman eight stand between them."""
    found = LETTERS.findall(text)
    if not found or "".join(found).isalpha():
        return found
    return [part for w in found for part in "".join(c if c.isalpha() else " " for c in w).split()]


def grams(word: str, order: int) -> list[str]:
    """Character n-grams of a word; from two characters on, with its ends marked."""
    marked = word if order == 1 else f"^{word}$"
    return [marked[i:i + order] for i in range(len(marked) - order + 1)]


def _sample(docs: DataFrame, key: str, text: str, lang: str, per_language: int) -> DataFrame:
    usable = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    first = Window.partitionBy("lang").orderBy("h", "key")
    ids = usable.select(F.col(key).alias("key"), F.col(lang).alias("lang"), F.xxhash64(F.col(key)).alias("h"))
    chosen = ids.withColumn("r", F.row_number().over(first)).where(F.col("r") <= per_language).select("key").distinct()
    # bounded by languages x per_language keys
    rows = usable.select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    return rows.join(F.broadcast(chosen), rows["key"].eqNullSafe(chosen["key"]), "left_semi")


def _count(batches):
    for pdf in batches:
        counts: Counter = Counter()
        for text, lang in zip(pdf["text"], pdf["lang"]):
            for word, n in Counter(letter_words(text.lower())).items():
                counts[lang, 0, word] += n
                for order in range(1, MAX_ORDER + 1):
                    for g in grams(word, order):
                        counts[lang, order, g] += n
        if counts:
            out = pd.DataFrame([(*k, n) for k, n in counts.items()], columns=["lang", "ord", "gram", "n"])
            yield out


class Model:
    """Log frequencies by language; picklable, scored without Spark."""

    def __init__(self, rows: list[tuple[str, int, str, int]]):
        self.langs = sorted({r[0] for r in rows})
        at = {lang: i for i, lang in enumerate(self.langs)}
        index: dict[tuple[int, str], int] = {}
        for _, order, gram, _n in rows:
            index.setdefault((order, gram), len(index))
        n = np.zeros((len(index), len(at)))
        for lang, order, gram, count in rows:
            n[index[order, gram], at[lang]] += count
        kinds = np.array([order for order, _ in index], dtype=int)
        table = np.zeros_like(n)
        for order in range(MAX_ORDER + 1):
            of = kinds == order
            if of.any():
                table[of] = np.log((n[of] + SMOOTHING) / (n[of].sum(0) + SMOOTHING * (of.sum() + 1)))
        # each entry against the mean over the languages, so that an entry equally likely in all adds nothing
        self.table = (table - table.mean(1, keepdims=True)).astype(np.float32) if len(index) else table
        self.index = index

    def word(self, word: str) -> np.ndarray:
        row = self.index.get((0, word))
        if row is not None:
            return self.table[row]
        for order in range(MAX_ORDER, 0, -1):
            rows = [r for g in grams(word, order) if (r := self.index.get((order, g))) is not None]
            if rows:
                return self.table[rows].mean(0)
        return np.zeros(len(self.langs), dtype=np.float32)

    def predictor(self):
        """A function text -> (language, score) that remembers the words it has scored."""
        model, size = self, len(self.langs)

        class Rows(dict):
            def __init__(self):
                super().__init__()
                self.scores = np.zeros((1024, size), dtype=np.float32)

            def __missing__(self, word):
                i = len(self)
                if i == len(self.scores):
                    self.scores = np.concatenate([self.scores, np.zeros_like(self.scores)])
                self.scores[i] = model.word(word)
                self[word] = i
                return i

        rows = Rows()

        def predict(text: str | None) -> tuple[str, float]:
            nonlocal rows
            words = letter_words(text.lower()) if text else []
            if not words or not size:
                return UNKNOWN, 0.0
            if len(rows) > CACHE_WORDS:
                rows = Rows()
            at = np.fromiter(map(rows.__getitem__, words), dtype=np.int64, count=len(words))
            total = rows.scores[at].sum(0, dtype=np.float64)
            best = int(total.argmax())
            return model.langs[best], float(1 / np.exp(total - total[best]).sum())

        return predict


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
        docs_per_language: int = DOCS_PER_LANGUAGE, entries: int = MODEL_ENTRIES) -> Model:
    """Learn from the rows of ``docs`` that have text and language."""
    common.bounded_batches(docs.sparkSession)
    sample = _sample(docs, key, text, lang, docs_per_language).select("text", "lang")
    counts = sample.mapInPandas(_count, "lang string, ord int, gram string, n bigint")
    counts = counts.groupBy("lang", "ord", "gram").agg(F.sum("n").alias("n"))
    each = max(1, entries // (MAX_ORDER + 1) // max(1, sample.select("lang").distinct().count()))
    frequent = Window.partitionBy("lang", "ord").orderBy(F.desc("n"), "gram")
    kept = counts.withColumn("r", F.row_number().over(frequent)).where(F.col("r") <= each).drop("r")
    return Model(sorted(tuple(r) for r in kept.collect()))  # entries rows at most


def predict(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, lang_pred, score) for every row of ``docs``."""
    spark = docs.sparkSession
    common.bounded_batches(spark)
    shared = spark.sparkContext.broadcast(model)

    def run(batches):
        one = shared.value.predictor()
        for pdf in batches:
            found = [one(t) for t in pdf["text"]]
            yield pd.DataFrame({key: pdf["key"], "lang_pred": [f[0] for f in found], "score": [f[1] for f in found]})

    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = docs.schema[key].dataType.simpleString()
    return rows.mapInPandas(run, f"`{key}` {kind}, lang_pred string, score double")
