"""Session helpers: a local session for tests/bench, and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

SESSION_TIME_ZONE = "UTC"


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "quayside") -> SparkSession:
    """A session for tests and the bench. Cluster jobs get theirs from spark-submit."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", SESSION_TIME_ZONE)
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("QUAYSIDE_DRIVER_MEMORY", "16g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    prepare(spark)
    return spark


#: Bytes of the Arrow batches given to Python workers, where the session sets no smaller bound.
ARROW_BYTES = 64 << 20
_ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def prepare(spark: SparkSession) -> SparkSession:
    """Settings every job relies on: UTC session time, Arrow batches of bounded bytes and a
    shared checkpoint folder."""
    spark.conf.set("spark.sql.session.timeZone", SESSION_TIME_ZONE)
    if conf_bytes(spark.conf.get(_ARROW_BYTES)) > ARROW_BYTES:
        spark.conf.set(_ARROW_BYTES, ARROW_BYTES)
    checkpoint_root(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the operator and must be a shared file system;
    without it a cluster job stops with an error. Only a local-mode session
    (tests) gets a folder of its own when it is unset.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        sc_dir = spark.sparkContext.getCheckpointDir()
        if sc_dir:
            # getCheckpointDir() returns a per-application sub folder; use its parent
            root = sc_dir.rsplit("/", 1)[0]
    if not root:
        master = spark.sparkContext.master or ""
        if not master.startswith("local"):
            # a machine-local folder is invisible to the other executors of a cluster
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach "
                               "(HDFS, an object store); it holds checkpoints and work tables")
        root = tempfile.mkdtemp(prefix="quayside-ckpt-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint root (never reused)."""
    return f"{checkpoint_root(spark)}/quayside/{name}-{uuid.uuid4().hex[:12]}"


_UNITS = {"b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20, "g": 1 << 30, "gb": 1 << 30,
          "t": 1 << 40, "tb": 1 << 40}


def conf_bytes(value: str) -> int:
    """A Spark size setting (``67108864b``, ``64m``, ``128MB``, ``1024``) in bytes."""
    text = str(value).strip().lower()
    digits = text.rstrip("abcdefghijklmnopqrstuvwxyz")
    unit = _UNITS.get(text[len(digits):].strip(), 1)
    # integers stay exact (a float would round Long.MaxValue, Spark's "no estimate" size)
    return int(digits) * unit if digits.isdigit() else int(float(digits) * unit)


MAX_PARTITIONS = 1 << 20  # upper bound of partitions_for


def partitions_for(df) -> int:
    """Partitions for an explicit repartition of ``df``.

    Enough that no partition is larger than a task's usual input (the larger of
    ``spark.sql.adaptive.advisoryPartitionSizeInBytes`` and
    ``spark.sql.files.maxPartitionBytes``) by the optimizer's size estimate, and at
    least one per task slot (capped by ``spark.sql.shuffle.partitions``) so a small
    input still uses every core. An explicit count is neither split nor coalesced
    by AQE, so it has to follow the data. An input of unknown size gets
    ``spark.sql.shuffle.partitions``.
    """
    spark = df.sparkSession
    shuffled = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    configured = min(shuffled, spark.sparkContext.defaultParallelism)
    target = max(conf_bytes(spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64m")),
                 conf_bytes(spark.conf.get("spark.sql.files.maxPartitionBytes", "128m")))
    size = estimated_bytes(df)
    return shuffled if size is None else int(min(max(configured, -(-size // max(1, target))), MAX_PARTITIONS))


#: A larger estimate is no estimate: it comes from the default of a source that knows no size (such
#: as one in Python), which projections and joins above it scale.
MAX_ESTIMATE = 1 << 50


def estimated_bytes(df) -> int | None:
    """The optimizer's estimate of a DataFrame's size; None where it has none."""
    spark = df.sparkSession
    try:
        size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    except Exception:  # no JVM view of the plan (e.g. a remote session)
        return None
    # no estimate (e.g. local rows): Spark reports its default
    default = conf_bytes(spark.conf.get("spark.sql.defaultSizeInBytes", str(2**63 - 1)))
    return size if size < min(default, MAX_ESTIMATE) else None
