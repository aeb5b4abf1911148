"""The document store source: options, partitions, pushed filters, catalog names, ingestion from it."""

import re
import uuid

import pytest
from pyspark.sql import functions as F

from quayside.operators import embedding
from quayside.plans import ingest
from quayside.sources import store


def _container(spark, scratch, n=400):
    rows = spark.range(n).selectExpr("id AS doc_id", "if(id % 50 = 7, NULL, 'text ' || id) AS text",
                                     "if(id % 3 = 0, 'en', if(id % 3 = 1, 'de', NULL)) AS lang", "'s' || (id % 5) AS source",
                                     "if(id % 10 = 0, double('NaN'), id / 2) AS x")
    rows.repartitionByRange(4, "doc_id").write.option("parquet.block.size", 1024).parquet(f"{scratch}/db/docs")
    return rows, {"endpoint": scratch, "database": "db", "container": "docs"}


def _formatted(spark, df):
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


FILTERS = [("doc_id = 17", True), ("doc_id >= 390 AND lang = 'en'", True), ("lang IS NULL", True), ("lang IS NOT NULL", True),
           ("doc_id IN (3, 5, 1000)", True), ("NOT (lang = 'en')", True), ("lang <=> 'de'", True), ("source LIKE 's1%'", True),
           ("text LIKE '%9'", True), ("text LIKE '%t 3%'", True), ("x > 150", False), ("x = double('NaN')", False),
           ("doc_id = 1 OR lang = 'en'", False), ("NOT (lang <=> 'de')", False), ("length(text) > 7", False)]


def test_filters_are_pushed_and_give_the_same_rows(spark, scratch):
    rows, options = _container(spark, scratch)
    store.register_store(spark)
    source = spark.read.format("document_store").options(**options).load()
    assert source.columns == rows.columns and source.rdd.getNumPartitions() >= 4
    assert sorted(map(str, source.collect())) == sorted(map(str, rows.collect()))
    for condition, pushed in FILTERS:
        found = source.where(condition)
        assert sorted(map(str, found.collect())) == sorted(map(str, rows.where(condition).collect())), condition
        listed = "".join(x for x in _formatted(spark, found).splitlines() if "PushedFilters" in x)
        assert (re.sub(r"IsNotNull\(\w+\)", "", listed).strip("PushedFilters: [],") != "" or condition == "lang IS NOT NULL") == pushed, listed
    one = source.where("doc_id = 17")
    assert "EqualTo(doc_id,17)" in _formatted(spark, one)
    assert one.rdd.getNumPartitions() < source.rdd.getNumPartitions()  # row groups are dropped by their statistics
    assert source.where("doc_id = 10000").count() == 0
    narrow = spark.read.format("document_store").schema("doc_id BIGINT").options(**options).load()
    assert narrow.columns == ["doc_id"] and narrow.agg(F.sum("doc_id")).first()[0] == 400 * 399 // 2


def test_missing_options_and_containers_are_errors(spark, scratch):
    store.register_store(spark)
    for options, match in (({"container": "docs"}, "needs the option endpoint"),
                           ({"endpoint": scratch, "container": "nothing"}, "no container 'nothing'")):
        with pytest.raises(Exception, match=match):
            spark.read.format("document_store").options(**options).load()


def test_a_named_store_feeds_ingestion(spark, scratch):
    rows, options = _container(spark, scratch, n=60)
    name = f"store_{uuid.uuid4().hex[:8]}"
    with pytest.raises(ValueError, match="no store is registered"):
        store.container(spark, f"{name}.docs")
    store.register_catalog(spark, name, options["endpoint"], options["database"], batchRows="7")
    documents = store.as_documents(store.container(spark, f"{name}.docs")).where("lang = 'en'").select("id", "fileName", "text")
    paths = ingest.IngestPaths(f"{scratch}/ingest")
    ingest.ingest(spark, documents, paths, embedding.HashingEmbedder(dim=8), batch_size=1)
    want = {str(r.doc_id) for r in rows.where("lang = 'en' AND text IS NOT NULL").collect()}
    assert {r.id for r in ingest.read_index(spark, paths).collect()} == want
    store.create_container_view(spark, "docs_view", f"{name}.docs")
    one = spark.sql("SELECT * FROM docs_view WHERE doc_id = 3")
    assert "EqualTo(doc_id,3)" in _formatted(spark, one) and one.count() == 1
    spark.catalog.dropTempView("docs_view")


def test_any_format_by_options(spark, scratch):
    spark.range(3).selectExpr("id AS k", "'f' AS name", "'t' || id AS body", "id * 2 AS id").write.json(f"{scratch}/j")
    docs = store.read_documents(spark, "json", {"mode": "FAILFAST"}, f"{scratch}/j", key="k", file_name="name", text="body")
    assert docs.columns == ["id", "fileName", "text"]
    assert sorted(map(tuple, docs.collect())) == [(str(i), "f", f"t{i}") for i in range(3)]


def test_a_source_without_a_size_is_not_dealt_by_its_default(spark, scratch):
    from quayside.session import estimated_bytes, partitions_for

    _, options = _container(spark, scratch, n=60)
    # the projection scales the default estimate, which is no size of the container
    found = store.read_documents(spark, options=options).where("id IS NOT NULL").select("id", "fileName", "text")
    assert estimated_bytes(found) is None
    assert partitions_for(found) == int(spark.conf.get("spark.sql.shuffle.partitions"))
