"""Anti-join and NOT IN semantics, checkpoint states."""

import os

import pytest
from pyspark.sql import functions as F

from quayside.functions.schemas import CHECKPOINT_SCHEMA, DOCUMENT_SCHEMA
from quayside.operators import pending
from quayside.sources import documents as docs

DOCS = [("1", "f", "a"), ("2", "f", "b"), (None, "f", "c"), ("2", "f", "b2"), ("3", "g", "d")]


def _ids(df):
    return sorted((r["id"] or "<null>") for r in df.collect())


def test_anti_join_keeps_null_and_duplicate_rows(spark):
    d = spark.createDataFrame(DOCS, DOCUMENT_SCHEMA)
    c = spark.createDataFrame([("1",), ("1",)], CHECKPOINT_SCHEMA)
    assert _ids(pending.pending_documents(d, c)) == ["2", "2", "3", "<null>"]
    assert pending.pending_documents(d, c).columns[0] == "id"


def test_not_in_drops_null_ids_and_empties_on_null_checkpoint(spark):
    d = spark.createDataFrame(DOCS, DOCUMENT_SCHEMA)
    c = spark.createDataFrame([("1",)], CHECKPOINT_SCHEMA)
    assert _ids(pending.pending_not_in(d, c)) == ["2", "2", "3"]
    with_null = spark.createDataFrame([("1",), (None,)], CHECKPOINT_SCHEMA)
    assert _ids(pending.pending_not_in(d, with_null)) == []
    empty = spark.createDataFrame([], CHECKPOINT_SCHEMA)
    assert _ids(pending.pending_not_in(d, empty)) == ["1", "2", "2", "3", "<null>"]


def test_hot_checkpoint_key_is_preaggregated(spark):
    c = spark.range(5000).select(F.lit("hot").alias("id"))
    plan = pending.completed_ids(c)._jdf.queryExecution().executedPlan().toString()
    # partial aggregate before the exchange, final after: copies collapse map-side
    assert plan.count("HashAggregate") >= 2 and "Exchange" in plan
    assert pending.completed_ids(c).count() == 1


def test_checkpoint_missing_empty_corrupt_and_parts(spark, scratch):
    missing = f"{scratch}/missing"
    assert docs.read_checkpoint(spark, missing).count() == 0
    empty = f"{scratch}/empty"
    os.makedirs(empty.replace("file:", ""), exist_ok=True)
    assert docs.read_checkpoint(spark, empty).count() == 0
    parts = f"{scratch}/parts"
    spark.createDataFrame([("1",), ("2",)], CHECKPOINT_SCHEMA).write.json(parts)
    spark.createDataFrame([("3",)], CHECKPOINT_SCHEMA).write.mode("append").json(parts)
    assert sorted(r["id"] for r in docs.read_checkpoint(spark, parts).collect()) == ["1", "2", "3"]
    corrupt = f"{scratch}/corrupt"
    os.makedirs(corrupt.replace("file:", ""), exist_ok=True)
    with open(os.path.join(corrupt.replace("file:", ""), "part-0.json"), "w") as fh:
        fh.write('{"id": "1"}\n{broken\n')
    with pytest.raises(Exception):
        docs.read_checkpoint(spark, corrupt).collect()


def test_bloom_filter_keeps_sure_misses_in_place_and_is_exact(spark, monkeypatch):
    monkeypatch.setattr(pending, "BITS_PER_ID", 1)  # small, so that there are false positives
    docs = spark.range(6000).selectExpr("cast(id AS string) AS id", "'f' AS fileName", "repeat('x', 50) AS text")
    docs = docs.union(spark.createDataFrame([(None, "f", "no id"), ("7", "f", "twice")], "id string, fileName string, text string"))
    done = spark.range(0, 9000, 3).selectExpr("cast(id AS string) AS id").union(spark.createDataFrame([(None,)], "id string"))
    want = sorted(map(str, docs.join(done.distinct(), "id", "left_anti").collect()))
    assert sorted(map(str, pending.pending_documents(docs, done, bloom=True).collect())) == want
    marked = pending.may_be_done(docs, done.distinct())
    hits = {r.id for r in marked.where("_maybe").collect()}
    assert hits >= {str(i) for i in range(0, 6000, 3)}  # nothing that is done is missed
    false = len(hits) - 2000
    assert 0 < false < 2500 and None not in hits
    monkeypatch.setattr(pending, "BITS_PER_ID", 10)
    assert len({r.id for r in pending.may_be_done(docs, done.distinct()).where("_maybe").collect()}) < 2150
    nothing = pending.pending_documents(docs, done.limit(0), bloom=True)
    assert nothing.count() == 6002


def test_large_checkpoints_take_the_filter(spark, scratch):
    docs = spark.range(200).selectExpr("cast(id AS string) AS id", "'f' AS fileName", "'t' AS text")
    spark.range(0, 200, 2).selectExpr("cast(id AS string) AS id").write.parquet(f"{scratch}/done")
    done = spark.read.parquet(f"{scratch}/done")
    small = pending.pending_documents(docs, done)
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "16b")
    try:
        large = pending.pending_documents(docs, done)
        assert "_bits" in large._jdf.queryExecution().analyzed().toString()
        assert sorted(map(tuple, large.collect())) == sorted(map(tuple, small.collect()))
    finally:
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    assert "_bits" not in small._jdf.queryExecution().analyzed().toString()
