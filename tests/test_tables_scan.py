"""Scan spreading and the bucketed event table."""

from pyspark.sql import functions as F

from quayside.functions import json as qjson
from quayside.sources import events as ev
from quayside.sources import tables


def test_single_split_scan_is_spread_and_wide_scan_is_untouched(spark, scratch):
    slots = spark.sparkContext.defaultParallelism
    spark.range(1000).coalesce(1).write.parquet(f"{scratch}/one")
    spark.range(1000).repartition(slots * 2).write.parquet(f"{scratch}/many")
    one = tables.spread_narrow_scan(spark.read.parquet(f"{scratch}/one"))
    many = spark.read.parquet(f"{scratch}/many")
    assert one.rdd.getNumPartitions() == slots
    assert tables.spread_narrow_scan(many) is many
    # filters and projections still reach the scan below the exchange
    plan = one.where("id > 500").select("id")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(id), GreaterThan(id,500)]" in plan
    assert one.where("id > 500").count() == 499


def test_event_table_is_bucketed_and_insert_keeps_every_row(spark, sf_dir, scratch):
    tables.create_event_table(spark, "quayside_t", "events_b", f"{scratch}/events_b", buckets=4)
    tables.create_event_table(spark, "quayside_t", "events_b", f"{scratch}/events_b", buckets=4)  # no-op
    info = {r["col_name"]: r["data_type"] for r in spark.sql("DESCRIBE TABLE EXTENDED quayside_t.events_b").collect()}
    assert info["Num Buckets"] == "4" and "session_id" in info["Bucket Columns"]
    lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    events = qjson.decode_json_messages(ev.json_messages(lineitem))
    tables.insert_events(events, "quayside_t.events_b")
    back = spark.table("quayside_t.events_b")
    assert back.count() == lineitem.count()
    assert back.select(F.sum("cs_order_number")).first()[0] == lineitem.select(F.sum("l_orderkey")).first()[0]
    # one session: an equality filter reads one bucket
    assert back.where(F.col("session_id") == "s1").count() == lineitem.where("l_suppkey = 1").count()
    spark.sql("DROP TABLE quayside_t.events_b")


def test_table_ddl_query_gives_the_same_rows_when_run_again(spark, sf_dir):
    from quayside.plans.registered import QUERIES

    first = QUERIES["table_ddl"](spark, sf_dir).count()
    assert QUERIES["table_ddl"](spark, sf_dir).count() == first == spark.read.parquet(
        f"{sf_dir}/lineitem.parquet").count()


def test_explicit_partition_count_grows_with_estimated_input(spark, sf_dir):
    from quayside.session import conf_bytes, partitions_for

    assert conf_bytes("67108864b") == conf_bytes("64m") == 64 << 20
    assert conf_bytes("9223372036854775807b") == 2**63 - 1  # exact: it marks "no estimate"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    configured = min(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    assert partitions_for(docs) == configured  # small input: one per task slot
    size = int(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.advisoryPartitionSizeInBytes",
                                         "spark.sql.files.maxPartitionBytes")}
    try:
        for k in old:
            spark.conf.set(k, "4k")
        assert partitions_for(docs) == max(configured, -(-size // 4096)) > configured
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_hot_session_bucket_is_written_by_several_tasks(spark, sf_dir, scratch):
    import glob

    # several map tasks (the spread scan): AQE splits an oversized partition along map outputs
    lineitem = tables.read_table(spark, sf_dir, "lineitem")
    events = qjson.decode_json_messages(ev.json_messages(lineitem))
    # a third of all events belong to one session
    hot = events.withColumn("session_id", F.when(F.col("cs_quantity") <= 16, F.lit("s_hot"))
                            .otherwise(F.col("session_id")))
    n_hot = hot.where("session_id = 's_hot'").count()
    assert n_hot > lineitem.count() / 4
    tables.create_event_table(spark, "quayside_t", "events_hot", f"{scratch}/events_hot", buckets=4)
    # test-sized thresholds: a partition over 16 KB counts as oversized, and coalescing
    # may not merge pieces past 1 KB (its 1 MB default exceeds this whole table)
    sizes = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
             "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k"}
    old = {k: spark.conf.get(k) for k in sizes}
    try:
        for k, v in sizes.items():
            spark.conf.set(k, v)
        tables.insert_events(hot, "quayside_t.events_hot")
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    back = spark.table("quayside_t.events_hot")
    assert back.count() == lineitem.count() and back.where("session_id = 's_hot'").count() == n_hot
    hot_bucket = back.where("session_id = 's_hot'").select(F.input_file_name().alias("f")).distinct().count()
    assert hot_bucket > 1  # the oversized bucket was split over several writer tasks
    assert len(glob.glob(f"{scratch}/events_hot/*.parquet")) <= 4 * 16  # still bounded
    spark.sql("DROP TABLE quayside_t.events_hot")


def test_one_multiline_csv_file_is_read_by_many_tasks(spark, scratch):
    import random

    from quayside.sources import documents as docs

    rng = random.Random(2)
    texts = [None, "plain", 'say "hi"', "a,b", "line one\nline two\n", '"\n"\n\n,"', "x" * 700 + "\n" + "y" * 700, "é\n日本"]
    rows = [(f"t{i}", rng.choice(texts), i) for i in range(300)]
    df = spark.createDataFrame(rows, "title STRING, text STRING, n INT")
    docs.write_csv(df.coalesce(1), f"{scratch}/one")
    docs.write_csv(df.limit(0).coalesce(1), f"{scratch}/none")
    schema = "title STRING, text STRING, n INT"
    want = sorted(map(str, docs.read_multiline_csv(spark, f"{scratch}/one", schema).collect()))
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")
    before = [spark.conf.get(n, None) for n in names]
    try:
        for size in ("197b", "1000b", "64k"):
            spark.conf.set(names[0], size)
            spark.conf.set(names[1], "0")
            spark.conf.set(names[2], "1")
            read = docs.read_split_csv(spark, f"{scratch}/one", schema)
            assert sorted(map(str, read.collect())) == want, size
            if size == "1000b":
                assert spark.read.text(f"{scratch}/one").rdd.getNumPartitions() > 20
        assert docs.read_split_csv(spark, f"{scratch}/none", schema).count() == 0
    finally:
        for n, v in zip(names, before):
            spark.conf.unset(n) if v is None else spark.conf.set(n, v)
