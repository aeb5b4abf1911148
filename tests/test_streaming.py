"""Structured Streaming: append, restart, bad bodies, SQL over the sink, starting positions."""

from pyspark.sql import functions as F

from quayside.functions.schemas import sales_event_avro
from quayside.sources import events as ev
from quayside.sources.tables import read_table
from quayside.streaming import events as stream


def _land(messages, path):
    messages.repartition(2).write.mode("append").parquet(path)


def test_restart_appends_only_new_files_and_bad_bodies_are_kept(spark, sf_dir, scratch):
    avro_text = sales_event_avro()
    lineitem = read_table(spark, sf_dir, "lineitem")
    first = ev.avro_messages(lineitem.where("l_linenumber = 1"), avro_text)
    _land(first, f"{scratch}/src")

    def run():
        events = stream.decode_stream(stream.read_messages(spark, f"{scratch}/src"), "avro", avro_text)
        stream.run_to_end(stream.append_stream(events, f"{scratch}/out", f"{scratch}/ck"))
        return spark.read.parquet(f"{scratch}/out").count()

    n1 = run()
    assert n1 == first.count()
    assert run() == n1  # no new data: nothing appended
    bad = first.limit(3).select(F.lit(b"\x07garbage").alias("body"), "offset", "enqueued_time", "schema_id")
    _land(bad, f"{scratch}/src")
    assert run() == n1 + 3
    out = spark.read.parquet(f"{scratch}/out")
    assert out.where(F.col("cs_order_number").isNull()).count() == 3  # all-null rows, not dropped


def test_sql_over_table_sink_and_memory_sink(spark, sf_dir, scratch):
    lineitem = read_table(spark, sf_dir, "lineitem").limit(50)
    _land(ev.json_messages(lineitem), f"{scratch}/src")
    events = stream.decode_stream(stream.read_messages(spark, f"{scratch}/src"), "json")
    spark.sql("DROP TABLE IF EXISTS t_events")
    stream.run_to_end(stream.table_stream(events, "t_events", f"{scratch}/tbl", f"{scratch}/ck"))
    assert spark.sql("SELECT count(*) AS n FROM t_events").first()["n"] == 50
    q = stream.memory_stream(events, "structured_data_test")
    q.processAllAvailable()
    q.stop()
    assert spark.sql("SELECT CreatedTime FROM structured_data_test").count() == 50


def test_starting_positions(spark, sf_dir, scratch):
    avro_text = sales_event_avro()
    msgs = ev.avro_messages(read_table(spark, sf_dir, "lineitem"), avro_text)
    _land(msgs, f"{scratch}/src")
    offsets = sorted(r["offset"] for r in msgs.select("offset").collect())
    mid = offsets[len(offsets) // 2]

    def count(position, name):
        spec = stream.resolve_start(spark, f"{scratch}/src", f"{scratch}/{name}", position)
        again = stream.resolve_start(spark, f"{scratch}/src", f"{scratch}/{name}", position)
        assert spec == again  # fixed at first start
        return stream.apply_start(spark.read.schema(msgs.schema).parquet(f"{scratch}/src"), spec).count()

    assert count(stream.StartingPosition("@earliest"), "e") == len(offsets)
    assert count(stream.StartingPosition("@latest"), "l") == 0
    assert count(stream.StartingPosition(mid, inclusive=True), "i") == sum(o >= mid for o in offsets)
    assert count(stream.StartingPosition(mid, inclusive=False), "x") == sum(o > mid for o in offsets)


def test_running_stream_picks_up_files_as_they_land_and_restarts_cleanly(spark, sf_dir, scratch):
    avro_text = sales_event_avro()
    lineitem = read_table(spark, sf_dir, "lineitem")
    parts = [ev.avro_messages(lineitem.where(f"l_linenumber = {n}"), avro_text) for n in (1, 2)]
    _land(parts[0], f"{scratch}/src")
    events = stream.decode_stream(stream.read_messages(spark, f"{scratch}/src"), "avro", avro_text)
    query = stream.append_stream(events, f"{scratch}/out", f"{scratch}/ck", trigger="200 milliseconds")
    try:
        query.processAllAvailable()
        assert spark.read.parquet(f"{scratch}/out").count() == parts[0].count()
        _land(parts[1], f"{scratch}/src")  # arrives while the query runs
        query.processAllAvailable()
    finally:
        query.stop()
    total = parts[0].count() + parts[1].count()
    assert spark.read.parquet(f"{scratch}/out").count() == total
    # a later run on the same checkpoint finds nothing new
    again = stream.decode_stream(stream.read_messages(spark, f"{scratch}/src"), "avro", avro_text)
    stream.run_to_end(stream.append_stream(again, f"{scratch}/out", f"{scratch}/ck"))
    assert spark.read.parquet(f"{scratch}/out").count() == total


def test_bad_bodies_are_routed_to_a_quarantine_sink(spark, sf_dir, scratch):
    avro_text = sales_event_avro()
    lineitem = read_table(spark, sf_dir, "lineitem").where("l_linenumber = 1")
    for codec, messages in (("avro", ev.avro_messages(lineitem, avro_text)), ("json", ev.json_messages(lineitem))):
        src = f"{scratch}/{codec}/src"
        _land(messages, src)
        bad = messages.limit(4).select(
            F.when(F.col("offset") % 2 == 0, F.lit(b"\x07garbage")).otherwise(F.lit(None).cast("binary")).alias("body"),
            "offset", "enqueued_time", "schema_id")
        _land(bad, src)
        for _ in range(2):  # the second run on the same checkpoint finds nothing new
            decoded = stream.decode_stream(stream.read_messages(spark, src), codec, avro_text, with_errors=True)
            stream.run_to_end(stream.append_with_quarantine(
                decoded, f"{scratch}/{codec}/table", f"{scratch}/{codec}/quarantine", f"{scratch}/{codec}/ck"))
        table = spark.read.parquet(f"{scratch}/{codec}/table")
        q = spark.read.parquet(f"{scratch}/{codec}/quarantine")
        assert table.count() == messages.count() and "_decode_error" not in table.columns
        assert table.where(F.col("cs_order_number").isNull()).count() == 0
        assert q.count() == 4 and q.where(F.col("_decode_error").isNull()).count() == 0
        # split_decode_errors on a batch DataFrame gives the same partition of rows
        good, bad = stream.split_decode_errors(
            stream.decode_stream(spark.read.parquet(src), codec, avro_text, with_errors=True))
        assert (good.count(), bad.count()) == (messages.count(), 4)


def test_backlog_is_worked_through_in_bounded_batches(spark, sf_dir, scratch):
    avro_text = sales_event_avro()
    messages = ev.avro_messages(read_table(spark, sf_dir, "lineitem"), avro_text)
    messages.repartition(5).write.parquet(f"{scratch}/src")  # a backlog of 5 files
    events = stream.decode_stream(stream.read_messages(spark, f"{scratch}/src", max_files_per_trigger=2),
                                  "avro", avro_text)
    query = stream.append_stream(events, f"{scratch}/out", f"{scratch}/ck")
    stream.run_to_end(query)
    batches = [p for p in query.recentProgress if p["numInputRows"] > 0]
    assert len(batches) == 3  # 2 + 2 + 1 files
    assert spark.read.parquet(f"{scratch}/out").count() == messages.count()


def test_a_replayed_quarantine_batch_overwrites_instead_of_duplicating(spark, sf_dir, scratch):
    avro_text = sales_event_avro()
    msgs = ev.avro_messages(read_table(spark, sf_dir, "lineitem").where("l_linenumber = 1"), avro_text)
    bad = msgs.limit(2).select(F.lit(b"\x07").alias("body"), "offset", "enqueued_time", "schema_id")
    batch = stream.decode_stream(msgs.unionByName(bad), "avro", avro_text, with_errors=True)
    for _ in range(2):  # the same micro-batch delivered twice (replay after a failure)
        stream.write_split_batch(batch, 7, f"{scratch}/table", f"{scratch}/quarantine")
    assert spark.read.parquet(f"{scratch}/table").count() == msgs.count()
    assert spark.read.parquet(f"{scratch}/quarantine").count() == 2


def test_each_broker_partition_starts_at_its_own_position(spark, scratch):
    schema = ev.partitioned_schema()

    def land(rows):
        frame = spark.createDataFrame([(f'{{"n": {o}}}'.encode(), o, None, None, p) for p, o in rows], schema)
        frame.coalesce(1).write.mode("append").parquet(f"{scratch}/src")

    def seen(name, position):
        spec = stream.resolve_start(spark, f"{scratch}/src", f"{scratch}/{name}", position, partition="partition", schema=schema)
        assert spec == stream.resolve_start(spark, f"{scratch}/src", f"{scratch}/{name}", position, partition="partition", schema=schema)
        source = stream.apply_start(stream.read_messages(spark, f"{scratch}/src", schema=schema), spec)
        query = stream.append_stream(source.select("partition", "offset"), f"{scratch}/{name}-out", f"{scratch}/{name}")
        stream.run_to_end(query)
        return sorted(map(tuple, spark.read.parquet(f"{scratch}/{name}-out").collect()), key=lambda r: (r[0] or "", r[1]))

    start = stream.StartingPosition
    mixed = start("@latest", partitions={"b": start(11, inclusive=True), "c": start(5, inclusive=False)})
    land([("a", 1000), ("a", 1001), ("b", 10), ("b", 11), (None, 3)])
    assert seen("latest", start("@latest")) == [(None, 3)]  # no partition: read from the beginning
    assert seen("mixed", mixed)[-1] == ("b", 11)
    # later events: the slower partition's offsets are still below the other's, and a new partition appears
    land([("a", 1002), ("b", 12), ("c", 5), ("c", 6), ("d", 0)])
    late = [("a", 1002), ("b", 12), ("c", 5), ("c", 6), ("d", 0)]
    assert [r for r in seen("latest", start("@latest")) if r[0]] == late
    assert [r for r in seen("mixed", mixed) if r[0]] == [("a", 1002), ("b", 11), ("b", 12), ("c", 6), ("d", 0)]
    assert len(seen("all", start("@earliest"))) == 10
    assert [r for r in seen("number", start(12)) if r[0]] == [("a", 1000), ("a", 1001), ("a", 1002), ("b", 12)]


def test_a_source_with_its_own_schema_opens_without_path(spark, scratch):
    source = stream.read_messages(spark, fmt="rate", options={"rowsPerSecond": "200"})
    assert source.columns == ["timestamp", "value"]
    messages = stream.as_messages(source, body="value", offset="value", partition=None)
    assert messages.columns == ["body", "offset", "enqueued_time", "schema_id"]
    query = stream.append_stream(messages, f"{scratch}/out", f"{scratch}/ck", trigger="200 milliseconds")
    try:
        for _ in range(100):
            query.processAllAvailable()
            if query.lastProgress and sum(p["numInputRows"] for p in query.recentProgress):
                break
    finally:
        query.stop()
    rows = spark.read.parquet(f"{scratch}/out").collect()
    assert rows and all(bytes(r.body).decode() == str(r.offset) for r in rows)


def test_quarantine_keeps_the_message(spark, scratch):
    rows = [(b"\x07garbage", 7, None, "s1"), (None, 8, None, "s2")]
    from quayside.functions.schemas import MESSAGE_SCHEMA

    messages = spark.createDataFrame(rows, MESSAGE_SCHEMA)
    for codec, avro_text in (("avro", sales_event_avro()), ("json", None)):
        decoded = stream.decode_stream(messages, codec, avro_text, with_errors=True, keep_message=True)
        stream.write_split_batch(decoded, 1, f"{scratch}/{codec}/t", f"{scratch}/{codec}/q")
        bad = spark.read.parquet(f"{scratch}/{codec}/q").select("_message.*", "_decode_error").collect()
        found = {r.offset: (None if r.body is None else bytes(r.body), r.schema_id) for r in bad if r._decode_error}
        assert found == {7: (b"\x07garbage", "s1"), 8: (None, "s2")}
        assert "_message" not in spark.read.parquet(f"{scratch}/{codec}/t").columns
