"""A corpus pipeline of five operators: toxic documents go, one of each group of near copies stays, documents with
benchmark passages go, personal data is replaced, and what is left is encoded.

Each stage takes (spark, docs, sf_dir), works on all rows of ``docs`` and returns the columns of documents; the last
adds ids and n_tokens. ``run`` writes each stage's rows as Parquet to the shared folder and reads them again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm import common, decontamination, ngram_join, pii, sentencepiece_codec, toxicity
from quayside.session import prepare

#: SQL expresses none of the learned stages; tests/llm/test_pipeline.py compares run() with a brute-force version.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Toxicity, learned from the labelled documents outside the held-out fold: predicted documents go."""
    prepare(spark)
    learn = ~common.held_out(F.col("doc_id"))
    model = toxicity.fit(docs.where(learn), common.table(spark, sf_dir, "labels").where(learn))
    scored = toxicity.score(docs, model, prefix="_toxicity_")
    return scored.where("_toxicity_predicted = 0").select(docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join of five-word shingles at 0.8: of each group the document with the smallest id stays."""
    prepare(spark)
    placed = ngram_join.components(docs, n=5, percent=80)
    gone = placed.where("doc_id <> component_id").select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti").select(docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: documents with passages or variants of benchmark items go."""
    prepare(spark)
    return decontamination.filter_clean(docs, common.table(spark, sf_dir, "benchmark")).select(docs.columns)


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """PII: every span found in the text is replaced by its kind."""
    prepare(spark)
    return pii.redact(docs, pii.fit(docs))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SentencePiece: ids and their number for every text."""
    prepare(spark)
    return sentencepiece_codec.encode(docs).withColumn(
        "n_tokens", F.when(F.col("ids").isNotNull(), F.size("ids").cast("long")))


STAGES = [("toxicity", drop_toxic), ("ngram_join", drop_near_copies), ("decontamination", drop_contaminated),
          ("pii", redact_pii), ("sentencepiece", encode)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = common.table(prepare(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
