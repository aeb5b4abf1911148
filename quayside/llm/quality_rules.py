"""Quality rules: a threshold table compiled into one Spark projection, without user functions.

``signals`` derives counts and ratios from every whole text with array and string functions of Spark;
``compile_rules`` turns a table of (name, signal, low, high) into one projection of boolean verdicts.

Defined results: null text has no words, so every count is 0 and the base rule fails; empty and blank texts
behave alike; repeated rows and ties get one result each; an empty table gives an empty result with the same
columns. Only the key and the results leave the operator, so extra columns of the input cannot clash. Work and
memory are linear in a text's length but for the sort of its word windows (n log n, only where one repeats).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm import common

SYMBOLS = "#*$%&|<>"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20

#: Frequent function words by which running text is told from lists and junk.
STOP_WORDS = (
    "the of and to in is that for it on with as was at by an be this are from or "
    "le la les de des et est une un que qui dans pour sur pas avec en au ce du "
    "der die das und ist ein eine nicht zu den mit von im auf für dem sich des "
    "el los las y es una por con para se no del al lo como más su"
).split()


@dataclass(frozen=True)
class Rule:
    """A text passes when ``low <= signal <= high``; None leaves that side open."""

    name: str
    signal: str
    low: float | None = None
    high: float | None = None

    def passed(self) -> Column:
        value, both = F.col(self.signal), F.lit(True)
        if self.low is not None:
            both = both & (value >= self.low)
        if self.high is not None:
            both = both & (value <= self.high)
        return F.coalesce(both, F.lit(False))


#: The threshold table. Ratios are per word, but for the line ratio, which is per line with a word.
RULES = (
    Rule("length", "n_words", low=MIN_WORDS),
    Rule("word_length", "mean_word_chars", low=2, high=15),
    Rule("symbols", "symbol_ratio", high=0.1),
    Rule("stop_words", "stop_word_ratio", low=0.02),
    Rule("duplicate_lines", "dup_line_ratio", high=0.3),
    Rule("shouting", "upper_ratio", high=0.5),
)


def _stop_hashes() -> list[Column]:
    """Hashes of the stop words as written in running text: lower case and with a capital first letter."""
    forms = sorted({f for w in STOP_WORDS for f in (w, w[0].upper() + w[1:])})
    return [F.xxhash64(F.lit(f)) for f in forms]


def signals(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``key`` and the signals that rules refer to.

    n_words, word_chars, n_symbols, n_lines (lines with a word), n_dup_lines, n_repeat_words, n_stop_words,
    n_upper, and the ratios mean_word_chars, symbol_ratio, stop_word_ratio, dup_line_ratio, upper_ratio.
    """
    at = lambda name, i: F.get(F.col(name), i)
    body = F.coalesce(F.col(text), F.lit(""))
    base = docs.select(F.col(key).alias("key"), body.alias("body"))
    counted = base.select(
        "key",
        F.transform(common.words(F.col("body")), lambda w: F.xxhash64(w)).alias("hashes"),
        F.length(F.translate("body", common.WORD_SEPARATORS, "")).alias("word_chars"),
        (F.length("body") - F.length(F.translate("body", SYMBOLS, ""))).alias("n_symbols"),
        F.length(F.regexp_replace("body", r"[^\p{Lu}]+", "")).alias("n_upper"),
        F.filter(F.split("body", "\n"), lambda x: F.btrim(x, F.lit(common.WORD_SEPARATORS)) != "").alias("lines"),
    )
    # Every array that a lambda looks into is a column of the step before, so it is computed once per text.
    windows = counted.select(
        "key", "word_chars", "n_symbols", "n_upper",
        F.size("hashes").alias("n_words"),
        F.size("lines").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        F.size(F.filter("hashes", lambda h: h.isin(_stop_hashes()))).alias("n_stop_words"),
        F.when(F.size("hashes") >= WINDOW, F.transform(
            F.sequence(F.lit(0), F.size("hashes") - WINDOW),
            lambda i: F.xxhash64(*[at("hashes", i + j) for j in range(WINDOW)])))
        .otherwise(F.array().cast("array<bigint>")).alias("windows"),
    )
    ordered = windows.withColumn("ordered", F.when(
        F.size(F.array_distinct("windows")) < F.size("windows"),
        F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))).drop("windows")
    again = lambda i: (at("ordered", i)["h"] == at("ordered", i - 1)["h"]) | (
        at("ordered", i)["h"] == at("ordered", i + 1)["h"])
    # Windows that occur twice or more, by position; each adds the words that the one before doesn't cover.
    starts = F.sort_array(F.array_compact(F.transform(
        F.sequence(F.lit(0), F.size("ordered") - 1),
        lambda i: F.when(F.coalesce(again(i), F.lit(False)), at("ordered", i)["i"]))))
    covered = F.aggregate(
        starts, F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last")),
        lambda acc, p: F.struct((acc["n"] + F.least(F.lit(WINDOW), p - acc["last"])).alias("n"), p.alias("last")),
        lambda acc: acc["n"])
    found = ordered.withColumn("n_repeat_words", F.when(F.col("ordered").isNull(), 0).otherwise(covered)).drop("ordered")
    per = lambda n, d: F.when(F.col(d) > 0, F.col(n) / F.col(d)).otherwise(0.0)
    whole = [F.col(c).cast("long").alias(c) for c in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_stop_words", "n_upper")]
    return found.select(
        F.col("key").alias(key), *whole,
        per("word_chars", "n_words").alias("mean_word_chars"), per("n_symbols", "n_words").alias("symbol_ratio"),
        per("n_stop_words", "n_words").alias("stop_word_ratio"), per("n_dup_lines", "n_lines").alias("dup_line_ratio"),
        per("n_upper", "word_chars").alias("upper_ratio"))


def compile_rules(rules: Sequence[Rule]) -> list[Column]:
    """The table as columns: ``passed_<name>`` for each rule, and ``failed_rules`` with the names not passed."""
    names = F.array_compact(F.array(*[F.when(~r.passed(), F.lit(r.name)) for r in rules]))
    return [r.passed().alias(f"passed_{r.name}") for r in rules] + [names.alias("failed_rules")]


def apply_rules(docs: DataFrame, rules: Sequence[Rule] = RULES, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``signals`` with ``base_failed``, the compiled verdicts and ``kept`` (every rule and the base passed)."""
    base_failed = (F.col("n_words") < MIN_WORDS) | (
        F.lit(100) * F.col("n_repeat_words") > F.lit(MAX_REPEAT_PERCENT) * F.col("n_words"))
    judged = signals(docs, key, text).select("*", base_failed.alias("base_failed"), *compile_rules(rules))
    return judged.withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))
