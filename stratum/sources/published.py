"""Published tables: whole snapshots, and hash-bucketed tables that are merged by copy on write.

A table is a root folder with one folder per batch and a small log. A whole snapshot is one log row. A bucketed table
keeps its rows in hash buckets of the key, ``batch=<id>/__bucket=<n>``; a merge joins and rewrites the buckets that its
rows fall into and logs one row for each of them, and the current table is the newest folder of every bucket. So the
work of a merge follows the increment, and files of untouched buckets stay as they are.

Readers see a batch when its log rows are there, which one task writes in one commit; a run that dies before leaves a
folder that nobody reads and that the repeated batch overwrites. What the driver holds is bounded by the number of
buckets, a property of the table.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.scd2 import CURRENT, scd2_apply, scd2_init, version_changes
from ..operators.upsert import STATE, require_unique, upsert_placed
from ..session import delete, durable, step_path

LOG_SCHEMA = (
    "batch_id string, path string, published timestamp, bucket int, buckets int, table_rows bigint, table_schema string"
)
BUCKET = "__bucket"
#: Buckets of a new table. Choose it so that a bucket of the full table is a few hundred megabytes.
BUCKETS = 16


def exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.parquet(path).schema
        return True
    except AnalysisException:
        return False


def read_log(spark: SparkSession, root: str) -> DataFrame | None:
    log = f"{root}/_log"
    return spark.read.schema(LOG_SCHEMA).parquet(log) if exists(spark, log) else None


def is_published(spark: SparkSession, root: str, batch_id: str) -> bool:
    log = read_log(spark, root)
    return log is not None and bool(log.filter(F.col("batch_id") == batch_id).take(1))


def current_path(spark: SparkSession, root: str) -> str | None:
    """The folder of the batch published last."""
    log = read_log(spark, root)
    return None if log is None else log.agg(F.max_by("path", F.struct("published", "batch_id"))).first()[0]


@dataclass(frozen=True)
class State:
    """What the log says: the newest batch, the folder of each bucket (none: one whole snapshot at ``path``)."""

    path: str
    schema: StructType | None
    rows: int | None
    buckets: int | None
    folders: Mapping[int, str]


def current_state(spark: SparkSession, root: str) -> State | None:
    log = read_log(spark, root)
    if log is None:
        return None
    order = F.struct("published", "batch_id")
    last = log.agg(F.max_by(F.struct("path", "table_schema", "table_rows", "buckets"), order), F.max(F.when(F.col("bucket").isNull(), F.col("published")))).first()
    newest, whole_at = last
    since = log.filter(F.col("bucket") >= 0) if whole_at is None else log.filter((F.col("bucket") >= 0) & (F.col("published") > F.lit(whole_at)))
    found = since.groupBy("bucket").agg(F.max_by("path", order).alias("path")).collect() if newest["buckets"] else []
    folders = {r["bucket"]: f"{r['path']}/{BUCKET}={r['bucket']}" for r in found}
    schema = StructType.fromJson(json.loads(newest["table_schema"])) if newest["table_schema"] else None
    return State(newest["path"], schema, newest["table_rows"], newest["buckets"], folders)


def read_state(spark: SparkSession, state: State, buckets: Sequence[int] | None = None, placed: bool = False) -> DataFrame:
    """The table, or the given buckets of it; ``placed`` adds the bucket of each row, as its folder names it.

    Files older than a column read as null there.
    """
    if not state.buckets:
        return spark.read.parquet(state.path)
    chosen = set(state.folders if buckets is None else buckets)
    paths = [p for b, p in state.folders.items() if b in chosen]
    df = spark.read.schema(state.schema).parquet(*paths) if paths else spark.createDataFrame([], state.schema)
    if not placed:
        return df
    bucket = F.regexp_extract("_metadata.file_path", f"{BUCKET}=(\\d+)/", 1) if paths else F.lit(None)
    return df.select("*", bucket.cast("int").alias(BUCKET))


def current_snapshot(spark: SparkSession, root: str) -> DataFrame | None:
    state = current_state(spark, root)
    return None if state is None else read_state(spark, state)


def _log_rows(spark: SparkSession, root: str, batch_id: str, path: str, buckets: Sequence[int | None], facts: tuple) -> None:
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    rows = [(batch_id, path, now, b, *facts) for b in buckets]
    spark.createDataFrame(rows, LOG_SCHEMA).coalesce(1).write.mode("append").parquet(f"{root}/_log")


def _refuse_twice(spark: SparkSession, root: str, batch_id: str) -> None:
    if is_published(spark, root, batch_id):
        raise ValueError(f"batch {batch_id} is already published")


def publish(df: DataFrame, root: str, batch_id: str) -> str:
    """Write a whole snapshot and make it current; a batch id is published once."""
    spark, path = df.sparkSession, f"{root}/batch={batch_id}"
    _refuse_twice(spark, root, batch_id)
    df.write.mode("overwrite").parquet(path)
    _log_rows(spark, root, batch_id, path, [None], (None, None, None))
    return path


def bucket_of(keys: Sequence[str], columns: Sequence[str], buckets: int) -> Column:
    """Hash bucket of a row; rows with a null in the key match nothing and are spread by all their columns."""
    missing = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    spread = F.xxhash64(*[F.col(f"`{c}`") for c in columns])
    return F.pmod(F.when(missing, spread).otherwise(F.xxhash64(*[F.col(k) for k in keys])), F.lit(buckets)).cast("int")


def write_counted(
    df: DataFrame, path: str, metrics: Mapping[str, Column], drop: Sequence[str] = (), by: str | None = None, dealt: bool = False
) -> dict[str, int]:
    """Write ``df`` and return counts taken by the write itself, without another pass.

    Rows are dealt out ``by`` a column for the write, unless they are ``dealt`` already.

    The rows are observed after the last shuffle, in the tasks whose results are committed: a task that is repeated
    counts once. ``rows`` is always among the counts.
    """
    seen = Observation()
    laid = df.hint("rebalance", by) if by and not dealt else df
    watched = laid.observe(seen, F.count(F.lit(1)).alias("rows"), *[m.cast("bigint").alias(n) for n, m in metrics.items()])
    writer = watched.drop(*drop).write.mode("overwrite")
    (writer.partitionBy(by) if by else writer).parquet(path)
    return {k: v or 0 for k, v in seen.get.items()}


def counted(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """``df`` written to the shared folder and read back, and its number of rows, counted by that write."""
    spark, path = df.sparkSession, step_path(df.sparkSession, name)
    rows = write_counted(df, path, {})["rows"]
    return spark.read.schema(df.schema).parquet(path), rows


def distinct_buckets(df: DataFrame) -> list[int]:
    return sorted(r[0] for r in df.select(BUCKET).distinct().collect())


def merged_schema(old: StructType | None, new: StructType) -> StructType:
    """Columns of the table so far, then new ones; a column never changes its type."""
    if old is None:
        return new
    known = {f.name: f for f in old.fields}
    for f in new.fields:
        if f.name in known and known[f.name].dataType != f.dataType:
            raise ValueError(f"column {f.name} is {known[f.name].dataType.simpleString()} in the table, {f.dataType.simpleString()} in the batch")
    return StructType([*old.fields, *[f for f in new.fields if f.name not in known]])


def _keyed(df: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    return df.withColumn(BUCKET, bucket_of(keys, df.columns, buckets))


def _rewrite(
    spark: SparkSession, root: str, batch_id: str, state: State | None, touched: list[int], placed: DataFrame, buckets: int,
    metrics: Mapping[str, Column], growth: Callable[[Mapping[str, int]], int] = lambda counts: counts["rows"], dealt: bool = False,
) -> dict[str, int]:
    """Publish ``placed`` (rows with their bucket) as the new content of the ``touched`` buckets.

    ``growth`` tells from the counts by how much the table grew.
    """
    path = f"{root}/batch={batch_id}"
    schema = StructType([f for f in placed.schema.fields if f.name not in (BUCKET, STATE)])
    counts = {"rows": 0, **dict.fromkeys(metrics, 0)}
    if touched:
        counts = write_counted(placed, path, metrics, [STATE], by=BUCKET, dealt=dealt)
    rows = (state.rows or 0 if state else 0) + growth(counts)
    # without a touched bucket the batch is on record all the same
    _log_rows(spark, root, batch_id, path, touched or [-1], (buckets, rows, merged_schema(state.schema if state else None, schema).json()))
    return counts


def _bucketed(spark: SparkSession, root: str, keys: Sequence[str], buckets: int) -> State | None:
    """The state of a bucketed table; a whole snapshot is laid out in buckets first, as a batch of its own."""
    state = current_state(spark, root)
    if state is None or state.buckets:
        return state
    rows = read_state(spark, state)
    batch_id = f"{state.path.rsplit('batch=', 1)[-1]}-buckets"
    rows = _keyed(rows, keys, buckets)
    _rewrite(spark, root, batch_id, None, distinct_buckets(rows), rows, buckets, {})
    return current_state(spark, root)


def _first_load(source: DataFrame, root: str, keys: Sequence[str], batch_id: str, buckets: int) -> int:
    """Write ``source`` as the new table, check its keys on what is written and publish it; returns its rows."""
    spark, path = source.sparkSession, f"{root}/batch={batch_id}"
    placed = _keyed(source, keys, buckets)
    rows = write_counted(placed, path, {}, by=BUCKET)["rows"]
    placed = spark.read.schema(placed.schema).parquet(path)
    found = []
    if rows:
        try:
            require_unique(placed, keys)
        except ValueError:
            delete(spark, path)
            raise
        found = distinct_buckets(placed)
    _log_rows(spark, root, batch_id, path, found or [-1], (buckets, rows, placed.drop(BUCKET).schema.json()))
    return rows


def merge_table(
    source: DataFrame,
    root: str,
    keys: Sequence[str],
    batch_id: str,
    preserve: Sequence[str] = (),
    touch: Mapping[str, Column] | None = None,
    buckets: int = BUCKETS,
    written: bool = False,
) -> dict[str, int]:
    """Upsert into the bucketed table (first run: create it); returns true insert, update and untouched counts.

    Source keys must be unique. ``buckets`` counts when the table is new. Rows of a null key are spread by their columns,
    so a batch may touch more buckets than it has keys. ``written`` tells that the source is read from written files: it is
    not written once more.
    """
    spark = source.sparkSession
    _refuse_twice(spark, root, batch_id)
    state = _bucketed(spark, root, keys, buckets)
    if state is None:
        return {"inserted": _first_load(source, root, keys, batch_id, buckets), "updated": 0, "untouched": 0}
    source = source if written else durable(source, "merge-source")
    require_unique(source, keys)
    merged_schema(state.schema, source.schema)
    n = state.buckets
    source = _keyed(source, keys, n)
    touched = distinct_buckets(source)
    merged = upsert_placed(read_state(spark, state, touched, placed=True), source, keys, BUCKET, preserve, touch, state=STATE)
    metrics = {kind: F.count_if(F.col(STATE) == kind) for kind in ("inserted", "updated")}
    counts = _rewrite(spark, root, batch_id, state, touched, merged, n, metrics, lambda c: c["inserted"], dealt=True)
    return {"inserted": counts["inserted"], "updated": counts["updated"], "untouched": (state.rows or 0) - counts["updated"]}


def merge_history(
    incoming: DataFrame, root: str, key: str, tracked: Sequence[str], from_col: str, as_of: dt.date | str, batch_id: str,
    key_name: str = "dim_key", buckets: int = BUCKETS, written: bool = False,
) -> dict[str, int]:
    """Apply one snapshot to a bucketed type-2 history; buckets without a change are neither read whole nor written.

    The changes are found on the key and the tracked columns of the open versions alone. Rows with a null key open a version
    each time they come, like anywhere else. Returns ``inserted`` and ``expired`` versions. ``written``: see :func:`merge_table`.
    """
    spark = incoming.sparkSession
    _refuse_twice(spark, root, batch_id)
    incoming = incoming if written else durable(incoming, "history-source")
    require_unique(incoming, [key])
    state = _bucketed(spark, root, [key], buckets)
    n = state.buckets if state else buckets
    bucket = F.pmod(F.xxhash64(key), F.lit(n)).cast("int").alias(BUCKET)
    closed = {"closed": F.count_if(~F.col(CURRENT))}
    if state is None:
        rows = scd2_init(incoming, key, from_col, key_name).select("*", bucket)
        counts = _rewrite(spark, root, batch_id, None, distinct_buckets(rows), rows, n, closed)
        return {"inserted": counts["rows"], "expired": counts["closed"]}
    touched = distinct_buckets(version_changes(read_state(spark, state), incoming, key, tracked).select(bucket))
    before = read_state(spark, state, touched)
    old = before.agg(F.count(F.lit(1)), F.count_if(~F.col(CURRENT))).first()
    after = scd2_apply(before, incoming.filter(bucket.isin(touched)), key, tracked, as_of, key_name).select("*", bucket)
    counts = _rewrite(spark, root, batch_id, state, touched, after, n, closed, lambda c: c["rows"] - old[0])
    return {"inserted": max(counts["rows"] - old[0], 0), "expired": max(counts["closed"] - old[1], 0)} if touched else {"inserted": 0, "expired": 0}


def vacuum(spark: SparkSession, root: str, keep_batches: Sequence[str] = ()) -> list[str]:
    """Delete bucket and batch folders that the current table does not read; returns them.

    For times without readers of older batches; folders of ``keep_batches`` stay.
    """
    state = current_state(spark, root)
    if state is None:
        return []
    used = set(state.folders.values()) if state.buckets else {state.path}
    kept = {f"{root}/batch={b}" for b in keep_batches}
    log = read_log(spark, root).select("path", "bucket").distinct().collect()  # one row per batch and touched bucket
    gone = []
    for path, bucket in log:
        folder = path if bucket is None else f"{path}/{BUCKET}={bucket}"
        if folder not in used and path not in kept and bucket != -1:
            hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
            if hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True):
                gone.append(folder)
    return sorted(gone)
