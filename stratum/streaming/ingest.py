"""File-arrival streams: append only, exactly once per checkpoint, run to completion and stop."""

from __future__ import annotations

import hashlib
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructType

from ..sources.files import CORRUPT, MANIFEST_SCHEMA, file_name, with_bronze_meta
from ..sources.reconciled import read_reconciled

#: Fields of the files that the schema does not hold, as JSON; null when there are none.
RESCUED = "_rescued_data"
_FORMATS = ("parquet", "json", "csv", "binaryFile")


def open_stream(
    spark: SparkSession, fmt: str, src: str, schema: str | None = None, options: Mapping[str, object] | None = None
) -> DataFrame:
    """A file stream with an explicit schema; JSON keeps unparsable lines, documents only their manifest."""
    if fmt not in _FORMATS:
        raise ValueError(f"format must be one of {_FORMATS}")
    reader = spark.readStream.format(fmt).option("recursiveFileLookup", True)
    if fmt == "json":
        schema = schema if CORRUPT in schema else f"{schema}, {CORRUPT} string"
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    elif fmt == "csv":
        reader = reader.option("header", True).option("mode", "PERMISSIVE")
    elif fmt == "binaryFile":
        schema = MANIFEST_SCHEMA
    for key, value in (options or {}).items():
        reader = reader.option(key, value)
    stream = reader.schema(schema).load(src)
    if fmt == "binaryFile":
        return stream.select("path", "length", "modificationTime", file_name("path").alias("file_name"))
    return stream


def ingest_stream(
    spark: SparkSession,
    fmt: str,
    src: str,
    dst: str,
    checkpoint: str,
    batch_id: str,
    schema: str | None = None,
    options: Mapping[str, object] | None = None,
    partition: bool = True,
) -> StreamingQuery:
    """Ingest what has arrived since the last run into Parquet partitioned by path period.

    A restart on the same checkpoint adds nothing that is already there. ``maxFilesPerTrigger`` in
    ``options`` bounds a micro-batch.
    """
    stream = open_stream(spark, fmt, src, schema, options)
    path = F.col("path") if fmt == "binaryFile" else None
    rows = with_bronze_meta(stream, batch_id, path=path)
    writer = rows.writeStream.format("parquet").outputMode("append").trigger(availableNow=True)
    if partition:
        writer = writer.partitionBy("year", "month")
    return writer.option("checkpointLocation", checkpoint).start(dst)


def conform(rows: DataFrame, schema: StructType) -> DataFrame:
    """``rows`` with the columns of ``schema`` and ``RESCUED``; nothing is lost.

    A column of another type is cast. A value that the type does not hold (the cast fails or changes it) is null and kept
    in ``RESCUED``, like every field that the schema does not have.
    """
    out, rescued = {}, []
    have = {f.name: f.dataType for f in rows.schema}
    for field in schema:
        name, kind = field.name, field.dataType
        source = F.col(f"`{name}`")
        if name not in have:
            out[name] = F.lit(None).cast(kind)
        elif have[name] == kind:
            out[name] = source
        else:
            value = source.try_cast(kind)
            fits = value.isNotNull()
            if not isinstance(kind, StringType) and not isinstance(have[name], StringType):
                fits = fits & value.try_cast(have[name]).eqNullSafe(source)
            try:
                rows.select(fits)
            except AnalysisException:  # no cast between the two types
                value, fits = F.lit(None).cast(kind), F.lit(False)
            out[name] = F.when(fits, value)
            rescued.append(F.when(~fits, source).alias(name))
    rescued += [F.col(f"`{name}`") for name in have if name not in out and name != "_source_file"]
    kept = F.nullif(F.to_json(F.struct(*rescued)), F.lit("{}")) if rescued else F.lit(None).cast("string")
    return rows.select(*[c.alias(n) for n, c in out.items()], kept.alias(RESCUED), "_source_file")


def ingest_rescued(
    spark: SparkSession, src: str, dst: str, checkpoint: str, batch_id: str, schema: str, options: Mapping[str, object] | None = None,
) -> StreamingQuery:
    """Ingest Parquet files whose columns drift: the files that have arrived are read by their own schemas and brought to
    ``schema`` by ``conform``.

    Each micro-batch is a folder ``stream_batch=..`` of ``dst``; one that is repeated after a failure replaces its own
    folder. A file that cannot be read fails the batch, so that it is read once it is whole.
    """
    wanted = StructType.fromDDL(schema)
    stream = hashlib.sha256(checkpoint.encode()).hexdigest()[:12]

    def write(batch: DataFrame, number: int) -> None:
        rows, _, skipped = read_reconciled(batch.sparkSession, batch.select("path"))
        broken = skipped.take(5)
        if broken:
            raise ValueError(f"not readable as Parquet: {[tuple(r) for r in broken]}")
        full = with_bronze_meta(conform(rows, wanted), batch_id, path=F.col("_source_file"))
        full.write.partitionBy("year", "month").mode("overwrite").parquet(f"{dst}/stream_batch={stream}-{number}")

    found = open_stream(spark, "binaryFile", src, options={"pathGlobFilter": "*.parquet", **(options or {})})
    return found.writeStream.foreachBatch(write).trigger(availableNow=True).option("checkpointLocation", checkpoint).start()
