"""Session helpers: building a local session and finding the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
#: Spark removes the shuffle files of a write when it ends, not when the driver happens to collect its garbage.
CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Folders written by ``durable`` in the scopes that are open, innermost last.
_scopes: list[list[str]] = []


def local_session(app: str = "stratum", cores: str = "*", **conf: str) -> SparkSession:
    """A session for tests and benches; clusters bring their own."""
    settings = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
        "spark.sql.files.maxPartitionBytes": "8m",
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A machine-local folder is only ever used by a ``local`` master, where every task sees it.
    """
    root = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getConf().get(CHECKPOINT_CONF)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder that every executor can reach")
    root = tempfile.mkdtemp(prefix="stratum-")
    spark.conf.set(CHECKPOINT_CONF, root)
    return root


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that nothing has written yet."""
    return f"{work_root(spark)}/{name}-{uuid.uuid4().hex}"


def step_path(spark: SparkSession, name: str) -> str:
    """A fresh path that the innermost open scope (``released``) will delete."""
    path = fresh_path(spark, name)
    if _scopes:
        _scopes[-1].append(path)
    return path


def durable(df: DataFrame, name: str = "cut") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Needed where later steps must see one fixed evaluation (partition ids, file listings) even if
    executors are lost and tasks run again. Reading Parquet back also keeps column pruning.
    """
    return durable_at(df, step_path(df.sparkSession, name))


def durable_at(df: DataFrame, path: str) -> DataFrame:
    """``durable`` at a path that the caller may ``delete`` once nothing reads it any more."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def kept(df: DataFrame, name: str) -> DataFrame:
    """Like ``durable``, but no scope deletes it: for the result that leaves a ``released`` block."""
    return durable_at(df, fresh_path(df.sparkSession, name))


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder of the shared storage."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


@contextmanager
def released(spark: SparkSession) -> Iterator[None]:
    """Written steps of the block are deleted at its end.

    For blocks that end with a published result: frames built inside must not be read after it.
    """
    steps: list[str] = []
    _scopes.append(steps)
    try:
        yield
    finally:
        _scopes.remove(steps)
        for path in steps:
            delete(spark, path)


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a step written in the block go as soon as the step is written, so disk holds those of one step."""
    before = spark.conf.get(CLEANUP_CONF, None)
    spark.conf.set(CLEANUP_CONF, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP_CONF)
        else:
            spark.conf.set(CLEANUP_CONF, before)
