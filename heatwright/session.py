"""Session helpers: a builder for local runs, runtime settings, and the shared scratch folder."""

from __future__ import annotations

import functools
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Runtime settings every plan here benefits from, on any cluster.
RUNTIME_SETTINGS = {
    # Split a hot join key even where that costs one more exchange further up.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # HotSpot never compiles a method above 8000 bytes of bytecode. Fused stages of a plan this wide
    # exceed that and would be interpreted; unfused, their projections are split into small methods.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Cut each key to its first n rows before the shuffle for large n as well.
    "spark.sql.optimizer.windowGroupLimitThreshold": "1000000",
}


def local_session(cpus: int | str = "*", app: str = "heatwright", **settings: str) -> SparkSession:
    """Single-JVM session for tests and benchmarks."""
    partitions = "8" if cpus == "*" else str(cpus)
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        # One wide report has more generated classes than the default cache of 100 holds.
        .config("spark.sql.codegen.cache.maxEntries", "2000")
        # No call site per column expression: building a wide plan takes thousands of them.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for name, value in settings.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else built."""
    for name, value in RUNTIME_SETTINGS.items():
        spark.conf.set(name, value)
    return spark


# Whether the files that a query shuffled are removed when it ends, not when its plan is collected as garbage.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def dropped_shuffles(spark: SparkSession) -> Iterator[None]:
    """The queries run within leave no shuffle files. For writes, whose plans run once."""
    before = spark.conf.get(DROP_SHUFFLES, "false")
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(DROP_SHUFFLES, before)


@functools.cache
def _local_base() -> str:
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A new folder name under the shared folder the session names in ``spark.checkpoint.dir``.

    Only a local session, where driver and executors are one process, may fall back to /tmp.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = _local_base()
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
