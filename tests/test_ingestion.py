"""Batch numbering, batch embedding outcomes, retries, resume, crash recovery, upsert."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from quayside.functions.schemas import DOCUMENT_SCHEMA
from quayside.operators import batching, embedding, upsert
from quayside.plans import ingest


def _docs(spark, n, text=lambda i: f"text {i}", parts=3):
    rows = [(f"{i:05d}", f"src{i % 3}", text(i)) for i in range(n)]
    return spark.createDataFrame(rows, DOCUMENT_SCHEMA).repartition(parts)


@pytest.mark.parametrize("n,parts", [(15, 1), (16, 2), (17, 3), (200, 7), (0, 2)])
def test_ranks_equal_row_number(spark, n, parts):
    df = _docs(spark, n)
    b = batching.assign_batches(df, "id", size=16, partitions=parts)
    got = sorted((r["id"], r["rank"], r["batch_id"], r["batch_pos"]) for r in b.public().collect())
    want = [(f"{i:05d}", i, i // 16, i % 16) for i in range(n)]
    assert got == want
    whole = b.whole().count()
    straddling = b.straddling().count()
    assert whole + straddling == n
    assert straddling <= 2 * 15 * max(parts - 1, 0)


def test_hot_duplicate_key_is_split_across_partitions(spark):
    hot = spark.range(3000).select(F.lit("same").alias("id"), F.lit("f").alias("fileName"),
                                   F.col("id").cast("string").alias("text"))
    cold = _docs(spark, 6000)
    b = batching.assign_batches(hot.unionByName(cold), "id", size=16, partitions=8)
    per_part = b.rows.groupBy("_pid").count().collect()
    assert max(r["count"] for r in per_part) < 3000  # the hot id does not land whole in one task
    ranks = sorted(r["rank"] for r in b.public().select("rank").collect())
    assert ranks == list(range(9000))


def test_failed_text_fails_its_whole_batch_only(spark):
    long_text = "x" * 20_000
    df = _docs(spark, 40, text=lambda i: long_text if i == 20 else f"text {i}")
    b = batching.assign_batches(df, "id", size=16, partitions=3)
    out = embedding.embed_batches(b, embedding.HashingEmbedder(dim=8, reject="xxxx")).collect()
    assert len(out) == 40
    failed = sorted(r["id"] for r in out if r["status"] == embedding.FAILED)
    assert failed == [f"{i:05d}" for i in range(16, 32)]
    assert {r["error"] for r in out if r["status"] == embedding.FAILED} == {"input is rejected"}
    assert all(r["text"] == long_text for r in out if r["id"] == "00020")  # raw text kept
    ok = [r for r in out if r["status"] == embedding.SUCCESS]
    norms = [np.linalg.norm(r["vector"]) for r in ok]
    assert all(abs(n - 1) < 1e-5 or n == 0 for n in norms)  # signed buckets may cancel to zero


def test_embedder_matches_driver_side_call(spark):
    df = _docs(spark, 20)
    emb = embedding.HashingEmbedder(dim=16)
    out = embedding.embed_batches(batching.assign_batches(df, "id", partitions=2), emb).collect()
    by_id = {r["id"]: r for r in out}
    texts = [f"text {i}" for i in range(20)]
    expected = emb.embed(texts)
    for i, vec in enumerate(expected):
        assert np.allclose(by_id[f"{i:05d}"]["vector"], vec)


def test_retry_recovers_and_exhausted_retry_fails(spark):
    df = _docs(spark, 33)
    b = batching.assign_batches(df, "id", partitions=2)
    flaky = embedding.FlakyEmbedder(embedding.HashingEmbedder(dim=8), failures=2)
    ok = embedding.embed_batches(b, flaky, retry_interval=0, max_tries=3).collect()
    assert {r["status"] for r in ok} == {embedding.SUCCESS}
    flaky = embedding.FlakyEmbedder(embedding.HashingEmbedder(dim=8), failures=2)
    bad = embedding.embed_batches(b, flaky, retry_interval=0, max_tries=2).collect()
    assert {r["status"] for r in bad} == {embedding.FAILED}
    assert {r["error"] for r in bad} == {"rate limit reached, retry later"}


def test_call_with_retry_is_constant_interval():
    waits = []
    calls = {"n": 0}

    def fn():
        calls["n"] += 1
        if calls["n"] < 4:
            raise embedding.RateLimitError("slow down")
        return "done"

    assert embedding.call_with_retry(fn, interval=60, sleep=waits.append) == "done"
    assert waits == [60, 60, 60]
    with pytest.raises(ValueError):
        embedding.call_with_retry(lambda: (_ for _ in ()).throw(ValueError("x")), sleep=waits.append)


def test_runs_resume_and_crash_only_redoes_work(spark, scratch):
    long_text = "y" * 20_000
    df = _docs(spark, 50, text=lambda i: long_text if i == 3 else f"text {i}")
    paths = ingest.IngestPaths(scratch)
    emb = embedding.HashingEmbedder(dim=8, reject="yyyy")
    # run 1 crashes after the index write: nothing checkpointed yet
    ingest.ingest(spark, df, paths, emb, run=1, crash_after="index")
    from quayside.sources.documents import read_checkpoint

    assert read_checkpoint(spark, paths.checkpoint).count() == 0
    # run 2 redoes everything and completes
    ingest.ingest(spark, df, paths, emb, run=2)
    done = {r["id"] for r in read_checkpoint(spark, paths.checkpoint).collect()}
    assert done == {f"{i:05d}" for i in range(16, 50)}
    # run 3: only the failed batch is pending; it fails again, failure log grows
    out3 = ingest.ingest(spark, df, paths, emb, run=3)
    assert out3.count() == 16 and {r["status"] for r in out3.collect()} == {embedding.FAILED}
    failures = spark.read.json(paths.failures)
    assert failures.count() == 32 and failures.select("id").distinct().count() == 16
    index = ingest.read_index(spark, paths)
    assert index.count() == 34 and index.select("id").distinct().count() == 34
    assert set(index.columns) == {"id", "content", "fileName", "contentVector"}


def test_latest_per_key_with_hot_key(spark):
    rows = spark.range(20000).select(
        F.when(F.col("id") < 7000, F.lit(0)).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("v"), (F.col("id") * 2).alias("payload"))
    out = upsert.latest_per_key(rows, "k", "v")
    assert out.count() == 20000 - 7000 + 1
    assert out.where("k = 0").first()["v"] == 6999
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" in plan or "ObjectHashAggregate" in plan or "HashAggregate" in plan


def test_versioned_table_upsert(spark, scratch):
    t = upsert.VersionedTable(spark, f"{scratch}/idx")
    assert t.read() is None
    t.upsert(spark.createDataFrame([(1, 0, "a"), (2, 0, "b")], "k INT, ver INT, x STRING"), "k", "ver")
    t.upsert(spark.createDataFrame([(1, 1, "a2"), (3, 1, "c")], "k INT, ver INT, x STRING"), "k", "ver")
    assert t.versions() == [1, 2]
    assert sorted(tuple(r) for r in t.read().collect()) == [(1, 1, "a2"), (2, 0, "b"), (3, 1, "c")]


def test_versioned_table_skips_and_survives_an_interrupted_write(spark, scratch):
    t = upsert.VersionedTable(spark, f"{scratch}/idx2")
    t.upsert(spark.createDataFrame([(1, 0, "a")], "k INT, ver INT, x STRING"), "k", "ver")
    # a write cut off before its commit: files but no _SUCCESS marker
    spark.createDataFrame([(9, 9, "partial")], "k INT, ver INT, x STRING").write.option(
        "mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{scratch}/idx2/v=2")
    assert t.versions() == [1] and t.versions(complete=False) == [1, 2]
    assert [tuple(r) for r in t.read().collect()] == [(1, 0, "a")]  # readers never see it
    t.upsert(spark.createDataFrame([(2, 1, "b")], "k INT, ver INT, x STRING"), "k", "ver")  # the retry
    assert t.versions() == [1, 3]
    assert sorted(tuple(r) for r in t.read().collect()) == [(1, 0, "a"), (2, 1, "b")]


def test_rerunning_a_crashed_run_completes_it_without_new_embedding(spark, scratch):
    df = _docs(spark, 40, text=lambda i: f"text {i}")
    paths = ingest.IngestPaths(scratch)
    ingest.ingest(spark, df, paths, embedding.HashingEmbedder(dim=8), run=1, crash_after="index")
    from quayside.sources.documents import read_checkpoint

    assert read_checkpoint(spark, paths.checkpoint).count() == 0

    class Refuses:
        def embed(self, texts):
            raise AssertionError("the committed outcome must be reused")

    out = ingest.ingest(spark, df, paths, Refuses(), run=1)  # same run again: completes it
    assert {r["status"] for r in out.collect()} == {embedding.SUCCESS}
    assert read_checkpoint(spark, paths.checkpoint).count() == 40
    assert ingest.read_index(spark, paths).count() == 40


def test_concurrent_batch_calls_give_the_same_outcome_sooner(spark):
    import time

    class SlowEmbedder:  # defined here so the workers receive it by value
        """Waits like a remote service, then embeds."""

        def __init__(self, wait: float):
            self.wait = wait
            self.inner = embedding.HashingEmbedder(dim=8, reject="xxxx")

        def embed(self, texts):
            import time

            time.sleep(self.wait)
            return self.inner.embed(texts)

    long_text = "x" * 20_000
    df = _docs(spark, 208, text=lambda i: long_text if i == 40 else f"text {i}", parts=1)
    b = batching.assign_batches(df, "id", size=16, partitions=1)
    cols = ["id", "status", "error", "batch_id"]
    runs = {}
    for conc in (1, 8):
        t0 = time.perf_counter()
        rows = embedding.embed_batches(b, SlowEmbedder(0.3), concurrency=conc).select(*cols).collect()
        runs[conc] = (time.perf_counter() - t0, sorted(map(tuple, rows)))
    assert runs[1][1] == runs[8][1]
    assert {r[0] for r in runs[8][1] if r[1] == embedding.FAILED} == {f"{i:05d}" for i in range(32, 48)}
    assert runs[8][0] < runs[1][0] - 1.5  # 13 calls of 0.3 s overlap instead of queueing


def test_second_call_ingests_new_documents_and_a_replay_adds_none(spark, scratch):
    paths = ingest.IngestPaths(scratch)
    texts = [(str(i), f"f{i}", "word " * (8000 if i == 3 else 5)) for i in range(60)]
    frame = spark.createDataFrame(texts, "id string, fileName string, text string")
    emb = embedding.HashingEmbedder(dim=8)
    from quayside.sources.documents import read_checkpoint

    for upto in (40, 60, 60):
        ingest.ingest(spark, frame.where(F.col("id").cast("int") < upto), paths, emb)
        assert ingest.read_index(spark, paths).count() == upto
        assert read_checkpoint(spark, paths.checkpoint).count() == upto
    ingest.ingest(spark, frame, paths, emb, run=2)
    assert read_checkpoint(spark, paths.checkpoint).count() == 60


def _bucket_files(table):
    import glob
    import os

    return {p: os.stat(p).st_mtime_ns for p in glob.glob(f"{table.rows}/_bucket=*/*.parquet")}


def _table(spark, path, rows=200, **kw):
    table = upsert.BucketedTable(spark, path, key="k", version="ver", **kw)
    table.upsert(spark.range(rows).selectExpr("id AS k", "0 AS ver", "'a' || id AS x"))
    return table


def test_bucketed_upsert_rewrites_only_the_buckets_it_touches(spark, scratch):
    table = _table(spark, f"{scratch}/t")
    before = _bucket_files(table)
    updates = spark.createDataFrame([(3, 1, "new"), (3, 0, "older"), (7, 0, "same version"), (900, 5, "added"), (8, -1, "late")],
                                    "k BIGINT, ver INT, x STRING")
    table.upsert(updates)
    got = {r.k: r.x for r in table.read().collect()}
    want = {i: f"a{i}" for i in range(200)} | {3: "new", 7: "same version", 900: "added"}
    assert got == want and table.read().columns == ["k", "ver", "x"]
    touched = {r.b for r in updates.select(table._bucket(table.buckets()).alias("b")).collect()}
    after = _bucket_files(table)
    untouched = {p: t for p, t in before.items() if int(p.split("_bucket=")[1].split("/")[0]) not in touched}
    assert untouched and all(after[p] == t for p, t in untouched.items())
    assert len(touched) < table.buckets() and not (before.keys() - untouched.keys()) & after.keys()
    table.upsert(updates)  # again: nothing changes
    assert {r.k: r.x for r in table.read().collect()} == want
    table.upsert(updates.limit(0))
    assert {r.k: r.x for r in table.read().collect()} == want


def test_bucketed_upsert_survives_a_cut_at_every_step(spark, scratch):
    table = _table(spark, f"{scratch}/cut")
    more = spark.createDataFrame([(3, 1, "new"), (900, 1, "added")], "k BIGINT, ver INT, x STRING")
    want = {i: f"a{i}" for i in range(200)} | {3: "new", 900: "added"}
    n, buckets = table.merge(more)  # cut off after the merge, before anything is overwritten
    assert {r.k: r.x for r in table.read().collect()} == want
    import shutil

    for b in table._touched(table._step("merges", n, buckets)):  # cut off while buckets are replaced: one is gone
        shutil.rmtree(f"{table.rows}/_bucket={b}", ignore_errors=True)
        break
    assert {r.k: r.x for r in table.read().collect()} == want
    table.recover()
    assert {r.k: r.x for r in table.read().collect()} == want and not table._steps("merges")
    # a merge without its marker changed nothing and is not read
    more.withColumn("_bucket", F.lit(0)).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(
        table._step("merges", n + 1, buckets))
    table.upsert(more.withColumn("x", F.lit("last")))
    assert {r.k: r.x for r in table.read().collect()} == want | {3: "last", 900: "last"}


def test_bucketed_table_grows_with_its_rows_and_refuses_null_keys(spark, scratch):
    table = _table(spark, f"{scratch}/grow", rows=3000, bucket_bytes=200)
    first = table.buckets()
    table.upsert(spark.createDataFrame([(5, 1, "new")], "k BIGINT, ver INT, x STRING"))
    assert table.buckets() > first
    got = {r.k: r.x for r in table.read().collect()}
    assert len(got) == 3000 and got[5] == "new" and got[6] == "a6"
    with pytest.raises(Exception, match="upsert of a row whose k is null"):
        table.upsert(spark.createDataFrame([(None, 1, "x")], "k BIGINT, ver INT, x STRING"))
    assert table.read().count() == 3000
    empty = upsert.BucketedTable(spark, f"{scratch}/none", key="k", version="ver")
    empty.upsert(spark.createDataFrame([], "k BIGINT, ver INT, x STRING"))
    assert empty.read() is None


def test_documents_without_an_id_fail_with_a_reason(spark, scratch):
    paths = ingest.IngestPaths(scratch)
    frame = spark.range(60).selectExpr("if(id % 10 = 9, NULL, cast(id AS string)) AS id", "'f' AS fileName", "'text ' || id AS text",
                                       "id AS n")
    from quayside.sources.documents import read_checkpoint, read_failures

    for upto, done in ((40, 36), (60, 54)):
        ingest.ingest(spark, frame.where(F.col("n") < upto).drop("n"), paths, embedding.HashingEmbedder(dim=8))
        index = ingest.read_index(spark, paths)
        assert index.count() == done and index.where("id IS NULL").count() == 0
        assert {r.id for r in read_checkpoint(spark, paths.checkpoint).collect()} == {r.id for r in index.collect()}
    failed = read_failures(spark, paths.failures).collect()
    assert len(failed) == 4 + 6 and {(r.id, r.error) for r in failed} == {(None, ingest.NO_ID)}


def test_the_index_has_a_catalog_name(spark, scratch):
    import uuid

    name = f"default.idx_{uuid.uuid4().hex[:8]}"
    paths = ingest.IngestPaths(scratch)
    frame = spark.range(60).selectExpr("cast(id AS string) AS id", "'f' AS fileName", "'text ' || id AS text")
    try:
        ingest.ingest(spark, frame.limit(0), paths, embedding.HashingEmbedder(dim=8), table=name)
        assert spark.sql(f"SELECT * FROM {name}").count() == 0  # there before the first document
        for upto in (20, 60):
            ingest.ingest(spark, frame.where(F.col("id").cast("int") < upto), paths, embedding.HashingEmbedder(dim=8), table=name)
            assert spark.sql(f"SELECT count(DISTINCT id) AS n FROM {name} WHERE size(contentVector) = 8").first().n == upto
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


@pytest.mark.parametrize("size", [7, 600])
def test_a_worker_holds_a_chunk_of_a_partition_not_all_of_it(spark, size):
    class BlocksEmbedder:
        """Vectors that tell how many small Python objects live in the worker at the call."""

        def embed(self, texts):
            import sys

            return [[float(sys.getallocatedblocks()), float(len(texts))] for _ in texts]

    n = 9100
    batched = batching.assign_batches(_docs(spark, n), "id", size=size, partitions=1)
    rows = embedding.embed_batches(batched, BlocksEmbedder()).collect()
    assert len({r["id"] for r in rows}) == len(rows) == n
    # one call per batch, whatever chunks it lies in
    assert all(r["vector"][1] == min(size, n - r["batch_id"] * size) for r in rows)
    blocks = [r["vector"][0] for r in rows]
    assert max(blocks) - min(blocks) < 8000  # the outcomes of 9,100 rows do not pile up
