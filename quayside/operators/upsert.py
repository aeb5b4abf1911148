"""Upsert by key into a file-backed table, idempotent under re-runs.

:class:`BucketedTable` deals rows into hash buckets of the key, one folder each, and
an upsert rewrites only the buckets that its rows fall into: the cost follows the
update, not the table. :class:`VersionedTable` writes a whole new version folder
``v=<n>`` per upsert instead, which suits a small table whose readers need
snapshots. Where Delta Lake is available either step is one ``MERGE INTO``.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.session import partitions_for
from quayside.sources.documents import folder_names, write_complete


def latest_per_key(df: DataFrame, key: str, version: str, preferred: str | None = None) -> DataFrame:
    """One row per ``key``: the row with the highest ``version`` (ties: rows marked by the
    boolean column ``preferred``, which is not returned, then the highest row hash).

    ``max_by`` aggregates partially before the shuffle, so a key holding a third
    of all rows is reduced to one row per map task instead of landing whole in
    one reducer (a ``row_number`` window would sort the whole group in one task).
    """
    columns = [c for c in df.columns if c != preferred]
    others = [c for c in columns if c != key]
    first = [F.col(preferred)] if preferred else []
    ordering = F.struct(F.col(version), *first, F.xxhash64(*[F.col(c) for c in columns]))
    picked = df.groupBy(key).agg(F.max_by(F.struct(*others), ordering).alias("_row"))
    return picked.select(key, *[F.col(f"_row.{c}").alias(c) for c in others]).select(*columns)


def upsert(existing: DataFrame | None, updates: DataFrame, key: str, version: str) -> DataFrame:
    """Rows of ``existing`` replaced/added by ``updates``: the newest ``version`` wins per
    key, and of equal versions the update. A row without a key is an error."""
    missing = F.raise_error(F.lit(f"upsert of a row whose {key} is null")).cast(updates.schema[key].dataType)
    combined = updates.withColumn(key, F.coalesce(F.col(key), missing)).withColumn("_new", F.lit(True))
    if existing is not None:
        combined = existing.withColumn("_new", F.lit(False)).unionByName(combined)
    return latest_per_key(combined, key, version, "_new")


class VersionedTable:
    """A table stored as ``<path>/v=<n>`` folders; the newest complete one is current."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def _fs(self):
        jvm = self.spark.sparkContext._jvm
        jpath = jvm.org.apache.hadoop.fs.Path(self.path)
        return jpath.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), jpath

    def versions(self, complete: bool = True) -> list[int]:
        """Version numbers present; only those whose write finished unless ``complete=False``."""
        fs, root = self._fs()
        if not fs.exists(root):
            return []
        out = []
        for st in fs.listStatus(root):
            name = st.getPath().getName()
            if st.isDirectory() and name.startswith("v="):
                marker = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")
                if not complete or fs.exists(marker):
                    out.append(int(name[2:]))
        return sorted(out)

    def current(self) -> int | None:
        v = self.versions()
        return v[-1] if v else None

    def read(self) -> DataFrame | None:
        v = self.current()
        return None if v is None else self.spark.read.parquet(f"{self.path}/v={v}")

    def write_version(self, df: DataFrame) -> int:
        # number past every folder, finished or not: a write cut off by a crash leaves
        # an incomplete folder that readers skip and the next attempt must not reuse
        v = max(self.versions(complete=False), default=0) + 1
        df.write.mode("errorifexists").parquet(f"{self.path}/v={v}")
        return v

    def upsert(self, updates: DataFrame, key: str, version: str) -> int:
        return self.write_version(upsert(self.read(), updates, key, version))


class BucketedTable:
    """A table in hash buckets of its key: ``<path>/rows/_bucket=<b>/``.

    An upsert merges its rows with the buckets they fall into (the others are not
    read), writes the result to ``<path>/merges`` and then overwrites these partitions
    of ``rows`` (dynamic partition overwrite). The merge folder is a redo log: an upsert
    cut off before its merge is complete changed nothing; one cut off later is finished
    by the next, and readers take the buckets of an unfinished overwrite from the merge.
    Finished merges are removed. There is one writer at a time, and a reader that is
    overtaken by an upsert has to read again.

    The number of buckets follows the size of the first rows; when buckets have grown to
    four times ``bucket_bytes`` on average, an upsert deals all rows into twice as many
    (or more), so a table never ends up with a few giant buckets.
    """

    BUCKET = "_bucket"
    #: One folder each; also bounds the list of touched buckets that the driver holds.
    MAX_BUCKETS = 1 << 16
    _STEP = re.compile(r"n=(\d+),buckets=(\d+)")

    def __init__(self, spark: SparkSession, path: str, key: str, version: str, bucket_bytes: int = 128 << 20):
        self.spark, self.path, self.key, self.version = spark, path.rstrip("/"), key, version
        self.bucket_bytes = bucket_bytes
        self.rows = f"{self.path}/rows"

    def _steps(self, folder: str) -> dict[int, int]:
        """Complete steps of ``merges`` or ``applied``: number -> buckets."""
        found = filter(None, map(self._STEP.fullmatch, folder_names(self.spark, f"{self.path}/{folder}")))
        return {int(m[1]): int(m[2]) for m in found if write_complete(self.spark, f"{self.path}/{folder}/{m[0]}")}

    def _step(self, folder: str, n: int, buckets: int) -> str:
        return f"{self.path}/{folder}/n={n},buckets={buckets}"

    def _open_merge(self) -> tuple[int, int] | None:
        """The merge that is complete but not known to be applied."""
        merges, applied = self._steps("merges"), self._steps("applied")
        last = max(merges, default=0)
        return (last, merges[last]) if last > max(applied, default=0) else None

    def buckets(self) -> int | None:
        """Number of buckets of ``rows``; None before the first upsert."""
        applied = self._steps("applied")
        return applied[max(applied)] if applied else None

    def _bucket(self, buckets: int):
        return F.pmod(F.xxhash64(F.col(self.key)), F.lit(buckets)).cast("int")

    def _read(self, path: str) -> DataFrame:
        return self.spark.read.parquet(path)

    def _touched(self, merge: str) -> list[int]:
        names = folder_names(self.spark, merge)
        return sorted(int(n.partition("=")[2]) for n in names if n.startswith(f"{self.BUCKET}="))

    def read(self) -> DataFrame | None:
        """The current rows; None before the first upsert."""
        merge = self._open_merge()
        if merge is None:
            return self._read(self.rows).drop(self.BUCKET) if self.buckets() else None
        path = self._step("merges", *merge)
        merged = self._read(path)
        if merge[1] == self.buckets():
            rest = self._read(self.rows).where(~F.col(self.BUCKET).isin(self._touched(path)))
            merged = rest.unionByName(merged)
        return merged.drop(self.BUCKET)

    def _apply(self, n: int, buckets: int) -> None:
        path = self._step("merges", n, buckets)
        same = buckets == self.buckets()
        writer = self._read(path).write.mode("overwrite").partitionBy(self.BUCKET)
        # other bucket numbers than before: all rows are in the merge, so nothing old stays
        writer.option("partitionOverwriteMode", "dynamic" if same else "static").parquet(self.rows)
        self.spark.range(0).write.mode("overwrite").parquet(self._step("applied", n, buckets))
        self._remove(path)

    def _remove(self, path: str) -> None:
        jpath = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        jpath.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(jpath, True)

    def _size(self) -> int:
        jpath = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.rows)
        fs = jpath.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        return int(fs.getContentSummary(jpath).getLength()) if fs.exists(jpath) else 0

    def recover(self) -> None:
        """Finish an upsert that was cut off while it overwrote its buckets."""
        if merge := self._open_merge():
            self._apply(*merge)

    def merge(self, updates: DataFrame) -> tuple[int, int] | None:
        """The first half of an upsert: its buckets as they will be. ``updates`` is read
        twice (which buckets it touches, then its rows), so it should be a stored table."""
        self.recover()
        now = self.buckets()
        if updates.isEmpty():
            return None
        if now is None:
            existing, buckets = None, min(partitions_for(updates), self.MAX_BUCKETS)
        else:
            buckets, size = now, self._size()
            while buckets < self.MAX_BUCKETS and size > 4 * buckets * self.bucket_bytes:
                buckets *= 2
            touched = [r[0] for r in updates.select(self._bucket(now).alias("b")).distinct().collect()]
            existing = self._read(self.rows)
            if buckets == now:
                existing = existing.where(F.col(self.BUCKET).isin(touched))
            existing = existing.drop(self.BUCKET)
        n = max([*self._steps("merges"), *self._steps("applied")], default=0) + 1
        merged = upsert(existing, updates, self.key, self.version).withColumn(self.BUCKET, self._bucket(buckets))
        # one task per bucket, an oversized one split over several
        merged.hint("rebalance", self.BUCKET).write.mode("overwrite").partitionBy(self.BUCKET).parquet(
            self._step("merges", n, buckets))
        return n, buckets

    def upsert(self, updates: DataFrame) -> None:
        """Add or replace rows by key; the newest version wins, of equal ones the update."""
        if step := self.merge(updates):
            self._apply(*step)
