"""A document store as a Spark data source: ``spark.read.format("document_store").options(...)``.

The store is addressed like a document database: an ``endpoint``, a ``database`` and a
``container`` in it. Here a container is a folder of Parquet files (or one file) on any
file system that pyarrow opens by its address; a client of a hosted database would take
the place of :class:`_Reader`. Row groups are the partitions. Filters on whole numbers,
text, booleans and bytes are pushed down: they drop row groups by their statistics and
rows before these reach Spark. A user schema names the columns to read.

Options: ``endpoint`` (folder or address), ``database`` (optional), ``container``,
``batchRows`` (rows per Arrow batch, 2000).
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualNullSafe,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    IsNull,
    LessThan,
    LessThanOrEqual,
    Not,
    StringContains,
    StringEndsWith,
    StringStartsWith,
)
from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_schema
from pyspark.sql.types import StructType

FORMAT = "document_store"
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"


class ContainerNotFound(ValueError):
    """The endpoint has no such container."""


def _dataset(options):
    """The container as a pyarrow dataset."""
    import pyarrow.dataset as ds
    from pyarrow import fs

    missing = [o for o in ("endpoint", "container") if not options.get(o)]
    if missing:
        raise ValueError(f"{FORMAT} needs the option {missing[0]}")
    endpoint = options["endpoint"].rstrip("/")
    files, root = fs.FileSystem.from_uri(endpoint) if "://" in endpoint else (fs.LocalFileSystem(), endpoint)
    base = "/".join(p for p in (root, options.get("database"), options["container"]) if p)
    for path in (base, f"{base}.parquet"):
        if files.get_file_info(path).type != fs.FileType.NotFound:
            return ds.dataset(path, format="parquet", filesystem=files)
    raise ContainerNotFound(f"no container {options['container']!r} at {endpoint}")


def _comparable(value) -> bool:
    # floats are left to Spark (NaN is equal to itself there), and so are dates, whose zones differ
    return isinstance(value, (bool, int, str, bytes))


def _expression(f: Filter, names: set[str]):
    """A pushed filter as a pyarrow expression; None if Spark has to evaluate it."""
    import pyarrow.compute as pc

    if isinstance(f, Not):
        inner = None if isinstance(f.child, (EqualNullSafe, IsNull, IsNotNull)) else _expression(f.child, names)
        return None if inner is None else ~inner
    if len(f.attribute) != 1 or f.attribute[0] not in names:
        return None
    column = pc.field(f.attribute[0])
    if isinstance(f, IsNull):
        return column.is_null()
    if isinstance(f, IsNotNull):
        return column.is_valid()
    values = list(f.value) if isinstance(f, In) else [f.value]
    if not all(map(_comparable, values)):
        return None
    if isinstance(f, In):
        return column.isin(values)
    value = values[0]
    made = {
        EqualTo: lambda: column == value, EqualNullSafe: lambda: column == value,
        GreaterThan: lambda: column > value, GreaterThanOrEqual: lambda: column >= value,
        LessThan: lambda: column < value, LessThanOrEqual: lambda: column <= value,
        StringStartsWith: lambda: pc.starts_with(column, pattern=value),
        StringEndsWith: lambda: pc.ends_with(column, pattern=value),
        StringContains: lambda: pc.match_substring(column, pattern=value),
    }.get(type(f))
    return made() if made else None


class _Reader(DataSourceReader):
    def __init__(self, options: dict, schema: StructType):
        self.options, self.names = options, schema.names
        self.arrow = to_arrow_schema(schema)
        self.filters: list[Filter] = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            if _expression(f, set(self.names)) is None:
                yield f
            else:
                self.filters.append(f)

    def _condition(self):
        made = [_expression(f, set(self.names)) for f in self.filters]
        return reduce(lambda a, b: a & b, made) if made else None

    def partitions(self) -> list[InputPartition]:
        parts = [(piece.path, [g.id for g in piece.row_groups])
                 for fragment in _dataset(self.options).get_fragments(filter=self._condition())
                 for piece in fragment.split_by_row_group(filter=self._condition())]
        return [InputPartition(p) for p in parts] or [InputPartition(None)]

    def read(self, partition: InputPartition) -> Iterator:
        if partition.value is None:
            return
        path, groups = partition.value
        data = _dataset(self.options)
        fragment = data.format.make_fragment(path, filesystem=data.filesystem, row_groups=groups)
        rows = int(self.options.get("batchRows", 2000))
        for batch in fragment.to_batches(schema=data.schema, columns=self.names, filter=self._condition(), batch_size=rows):
            if batch.num_rows:
                yield batch.cast(self.arrow)


class DocumentStore(DataSource):
    """See the module's text."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> StructType:
        return from_arrow_schema(_dataset(self.options).schema)

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(dict(self.options), schema)


def register_store(spark: SparkSession) -> None:
    """Make the format known to the session, with filters pushed to it."""
    spark.dataSource.register(DocumentStore)
    spark.conf.set(PUSHDOWN, "true")


#: Settings of a named store: ``<prefix><name>.<option>``.
CATALOG = "spark.quayside.catalog."


def register_catalog(spark: SparkSession, name: str, endpoint: str, database: str | None = None, **options: str) -> None:
    """Give a store's address (and any other options of the source) a name in this session."""
    register_store(spark)
    for option, value in {"endpoint": endpoint, "database": database or "", **options}.items():
        spark.conf.set(f"{CATALOG}{name}.{option}", value)


def container_options(spark: SparkSession, table: str, options: tuple[str, ...] = ("endpoint", "database", "batchRows")) -> dict[str, str]:
    """The options of ``<catalog>.<container>``; an error if there is no such catalog."""
    name, _, container = table.partition(".")
    found = {o: spark.conf.get(f"{CATALOG}{name}.{o}", "") for o in options}
    if not found["endpoint"]:
        raise ValueError(f"no store is registered as {name!r}")
    return {o: v for o, v in found.items() if v} | {"container": container}


def container(spark: SparkSession, table: str) -> DataFrame:
    """The rows of ``<catalog>.<container>``."""
    return spark.read.format(FORMAT).options(**container_options(spark, table)).load()


def create_container_view(spark: SparkSession, view: str, table: str) -> None:
    """A name for plain SQL that lasts as long as the session. (A lasting ``CREATE TABLE ...
    USING`` is of no use: Spark doesn't hand its options to a Python source.)"""
    quoted = {k: v.replace("\\", "\\\\").replace("'", "\\'") for k, v in container_options(spark, table).items()}
    listed = ", ".join(f"{k} '{v}'" for k, v in quoted.items())
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {view} USING {FORMAT} OPTIONS ({listed})")


def read_documents(spark: SparkSession, fmt: str = FORMAT, options: dict | None = None, path: str | None = None,
                   key: str = "doc_id", file_name: str = "source", text: str = "text") -> DataFrame:
    """Documents ``(id, fileName, text)`` and the source's other columns from any format by its options."""
    if fmt == FORMAT:
        register_store(spark)
    reader = spark.read.format(fmt).options(**(options or {}))
    return as_documents(reader.load(path) if path else reader.load(), key, file_name, text)


def as_documents(rows: DataFrame, key: str = "doc_id", file_name: str = "source", text: str = "text") -> DataFrame:
    """``rows`` in the ingestion shape ``(id, fileName, text)``, other columns behind."""
    shape = [F.col(key).cast("string").alias("id"), F.col(file_name).alias("fileName"), F.col(text).alias("text")]
    taken = {key, file_name, text, "id", "fileName", "text"}
    return rows.select(*shape, *[c for c in rows.columns if c not in taken])
