"""A persisted, versioned schema for streams whose files drift.

The log is a small Parquet table of versions. A micro-batch that brings new columns adds a version before it writes, so a
batch that is repeated after a failure finds its own version and adds none. Whether new columns are added (``evolve``) or
kept in the rescue column (``rescue``) is the caller's choice per run; the columns that the log knows keep their types for good,
and values that do not fit a type are rescued in either mode.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructField, StructType

from ..session import released
from ..sources.files import with_bronze_meta
from ..sources.reconciled import read_reconciled
from ..sources.tables import exists
from .ingest import RESCUED, conform, open_stream

LOG_SCHEMA = "version int, fields string, added string, origin string, logged timestamp"
MODES = ("evolve", "rescue")
#: Files of a micro-batch, unless the options say otherwise: what a batch names one by one stays bounded.
FILES_PER_BATCH = 1000


def versions(spark: SparkSession, log: str) -> DataFrame:
    """All versions: number, fields as JSON, names added by it, and the stream batch that brought it."""
    return spark.read.schema(LOG_SCHEMA).parquet(log) if exists(spark, log) else spark.createDataFrame([], LOG_SCHEMA)


def current_schema(spark: SparkSession, log: str) -> tuple[int, StructType] | None:
    """The newest version (one row reaches the driver)."""
    row = versions(spark, log).agg(F.max_by(F.struct("version", "fields"), "version")).first()[0]
    return None if row is None else (row["version"], StructType.fromJson(json.loads(row["fields"])))


def log_schema(spark: SparkSession, log: str, version: int, schema: StructType, added: list[str], origin: str) -> None:
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    row = [(version, schema.json(), json.dumps(added), origin, now)]
    spark.createDataFrame(row, LOG_SCHEMA).coalesce(1).write.mode("append").parquet(log)


def evolved(schema: StructType, found: StructType, ignore: tuple[str, ...] = ("_source_file",)) -> tuple[StructType, list[str]]:
    """``schema`` with the fields of ``found`` that it lacks (letter case does not tell names apart), all nullable."""
    known = {f.name.lower() for f in schema.fields} | {c.lower() for c in ignore}
    new = [StructField(f.name, f.dataType, True) for f in found.fields if f.name.lower() not in known]
    return StructType([*schema.fields, *new]), [f.name for f in new]


def spelt_like(rows: DataFrame, schema: StructType) -> DataFrame:
    """``rows`` with the log's spelling of the names it knows."""
    known = {f.name.lower(): f.name for f in schema.fields}
    return rows.withColumnsRenamed({c: known[c.lower()] for c in rows.columns if known.get(c.lower(), c) != c})


def schema_of_batch(spark: SparkSession, log: str, found: StructType, start: StructType, mode: str, origin: str) -> StructType:
    """The schema a batch is written with; in ``evolve`` mode new columns become a new version first."""
    if current_schema(spark, log) is None:
        log_schema(spark, log, 1, start, [f.name for f in start.fields], "start")
    version, schema = current_schema(spark, log)
    if mode == "rescue":
        return schema
    wider, added = evolved(schema, found)
    if added:
        log_schema(spark, log, version + 1, wider, added, origin)
    return wider


def ingest_evolving(
    spark: SparkSession, src: str, dst: str, checkpoint: str, log: str, batch_id: str, schema: str, mode: str = "evolve",
    options: Mapping[str, object] | None = None,
) -> StreamingQuery:
    """Ingest Parquet files that have arrived since the last run, by the schema of the log at ``log``.

    ``schema`` is the first version; later runs take the log's. Each micro-batch is a folder of ``dst``, replaced when the batch
    is repeated. A column of the log whose files bring another type keeps its type (see ``conform``); a new column that the
    files of one batch bring in several types is added as text. A file that cannot be read fails the batch.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    start = StructType.fromDDL(schema)
    stream = hashlib.sha256(checkpoint.encode()).hexdigest()[:12]

    def write(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        with released(session):
            rows, _, skipped = read_reconciled(session, batch.select("path"))
            broken = skipped.take(5)
            if broken:
                raise ValueError(f"not readable as Parquet: {[tuple(r) for r in broken]}")
            wanted = schema_of_batch(session, log, rows.schema, start, mode, f"{stream}-{number}")
            full = with_bronze_meta(conform(spelt_like(rows, wanted), wanted), batch_id, path=F.col("_source_file"))
            full.write.partitionBy("year", "month").mode("overwrite").parquet(f"{dst}/stream_batch={stream}-{number}")

    wanted_options = {"pathGlobFilter": "*.parquet", "maxFilesPerTrigger": FILES_PER_BATCH, **(options or {})}
    found = open_stream(spark, "binaryFile", src, options=wanted_options)
    return found.writeStream.foreachBatch(write).trigger(availableNow=True).option("checkpointLocation", checkpoint).start()


def read_evolved(spark: SparkSession, dst: str, log: str) -> DataFrame:
    """The ingested table by the newest version: files written before a column came read as null there."""
    _, schema = current_schema(spark, log)
    meta = [
        StructField(RESCUED, StructType.fromDDL("x string")["x"].dataType), *StructType.fromDDL(
            "_source_file string, _ingest_timestamp timestamp, _batch_id string, _commit_sha string, stream_batch string, year string, month string"
        ).fields,
    ]
    return spark.read.schema(StructType([*schema.fields, *meta])).parquet(dst)
