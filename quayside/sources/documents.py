"""Document table, progress checkpoint and multi-line CSV sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quayside.functions.schemas import CHECKPOINT_SCHEMA


def documents_from_table(documents: DataFrame) -> DataFrame:
    """``documents`` -> the ingestion shape ``(id, fileName, text)``."""
    return documents.select(
        F.col("doc_id").cast("string").alias("id"),
        F.col("source").alias("fileName"),
        F.col("text"),
    )


def checkpoint_from_labels(labels: DataFrame) -> DataFrame:
    """A progress checkpoint seeded from ``labels``: ids already done."""
    return labels.select(F.col("doc_id").cast("string").alias("id"))


def _hadoop_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, jpath


def path_has_data(spark: SparkSession, path: str) -> bool:
    """True when ``path`` exists and holds at least one non-hidden file (any Hadoop file system)."""
    fs, jpath = _hadoop_path(spark, path)
    if not fs.exists(jpath):
        return False
    if fs.isFile(jpath):
        return True
    it = fs.listFiles(jpath, True)
    while it.hasNext():
        name = it.next().getPath().getName()
        if not name.startswith(("_", ".")):
            return True
    return False


def write_complete(spark: SparkSession, path: str) -> bool:
    """True when a DataFrame write to ``path`` committed (its ``_SUCCESS`` marker exists)."""
    fs, jpath = _hadoop_path(spark, path)
    return fs.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(jpath, "_SUCCESS"))


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder of any Hadoop file system; none if it is missing."""
    fs, jpath = _hadoop_path(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(jpath)] if fs.exists(jpath) else []


def read_checkpoint(spark: SparkSession, path: str) -> DataFrame:
    """Ids already processed.

    A missing path or an empty folder means nothing is done yet. A corrupt file is
    an error (FAILFAST): silently treating it as empty would redo everything.
    """
    if not path_has_data(spark, path):
        return spark.createDataFrame([], CHECKPOINT_SCHEMA)
    return spark.read.schema(CHECKPOINT_SCHEMA).option("mode", "FAILFAST").option("recursiveFileLookup", "true").json(path)


def read_multiline_csv(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """CSV with a header row and quoted fields that span lines, one task per file.

    Spark does not split multiLine files; :func:`read_split_csv` reads a large one by many tasks.
    """
    reader = spark.read.option("header", "true").option("multiLine", "true").option("escape", '"')
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


def read_split_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV with a header row and quoted fields that span lines, by many tasks per file.

    Whether a line break ends a record depends on the quotes before it in the file. Two
    passes over the splits of Spark's text source settle that: the first counts each
    split's quotes, whose running sum (one row per split) tells whether a split begins
    inside a quoted field; the second joins lines to records. A record that crosses
    borders leaves a piece in each of its splits, and these few pieces are put together
    by a small shuffle. Records are parsed by Spark's ``from_csv``.

    ``schema`` names the columns (the header is skipped). Empty lines outside quotes are no
    records; a carriage return at the end of a record is dropped.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("value"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    quotes = F.length("value") - F.length(F.replace(F.col("value"), F.lit('"'), F.lit("")))
    splits = lines.groupBy("file", "start").agg((F.sum(quotes) % 2).alias("odd"))
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.select("file", "start", (F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2 == 1).alias("inside"))
    # one small row per split; a broadcast keeps the lines in their order
    marked = lines.join(F.broadcast(splits), ["file", "start"]).select("value", "file", "start", "inside")
    found = marked.mapInArrow(_records, "file string, start bigint, seq bigint, opens boolean, closes boolean, text string")
    found = found.where(~((F.col("start") == 0) & (F.col("seq") == 0) & F.col("opens") & F.col("closes")))  # the header
    whole = found.where("opens AND closes").select("text")
    # pieces of broken records, two per split at most: a record begins at each one that opens
    so_far = Window.partitionBy("file").orderBy("start", "seq").rowsBetween(Window.unboundedPreceding, 0)
    broken = found.where("NOT (opens AND closes)").withColumn("record", F.sum(F.col("opens").cast("long")).over(so_far))
    pieces = F.sort_array(F.collect_list(F.struct("start", "seq", "text")))
    joined = broken.groupBy("file", "record").agg(pieces.alias("pieces"), F.min(F.struct("start", "seq")).alias("at"))
    joined = joined.where("NOT (at.start = 0 AND at.seq = 0)").select(  # a header that spans lines and splits
        F.array_join(F.transform("pieces", lambda p: p["text"]), "\n").alias("text"))
    text = F.regexp_replace("text", "\r\\z", "")
    options = {"escape": '"', "multiLine": "true", "mode": "PERMISSIVE"}
    return whole.unionByName(joined).where(text != "").select(F.from_csv(text, schema, options).alias("r")).select("r.*")


def _records(batches):
    """Records of the splits that a task reads: ``opens`` and ``closes`` tell whether a text begins
    and ends a record, ``seq`` counts a split's texts."""
    import pyarrow as pa

    split, inside, opens, seq, waiting = None, False, True, 0, []
    names = ["file", "start", "seq", "opens", "closes", "text"]
    types = [pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.string()]
    for b in batches:
        out = []
        for value, file, start, begins_inside in zip(*(b.column(i).to_pylist() for i in range(4))):
            if (file, start) != split:
                if waiting:
                    out.append((*split, seq, opens, False, "\n".join(waiting)))
                split, inside, opens, seq, waiting = (file, start), begins_inside, not begins_inside, 0, []
            waiting.append(value)
            inside ^= value.count('"') % 2 == 1
            if not inside:
                out.append((*split, seq, opens, True, "\n".join(waiting)))
                opens, seq, waiting = True, seq + 1, []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)
    if waiting:
        row = (*split, seq, opens, False, "\n".join(waiting))
        yield pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(row, types)], names)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with header; fields holding quotes, commas or newlines get quoted."""
    df.write.mode("errorifexists").option("header", "true").option("escape", '"').csv(path)


def read_failures(spark: SparkSession, path: str) -> DataFrame:
    """The failure log; a run without failures leaves no log, which reads as empty."""
    from quayside.functions.schemas import FAILURE_SCHEMA

    if not path_has_data(spark, path):
        return spark.createDataFrame([], FAILURE_SCHEMA)
    return spark.read.schema(FAILURE_SCHEMA).option("mode", "FAILFAST").option("recursiveFileLookup", "true").json(path)
