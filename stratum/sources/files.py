"""Landing-tree readers: listings, JSON lines, CSV, control JSON and path-derived columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from fnmatch import fnmatchcase
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import durable

# fixed values: where year and month stand in a landing path, and how a monthly file (or folder of parts) is named
YEAR_IN_PATH = r"/(\d{4})/"
MONTH_IN_PATH = r"/\d{4}/(\d{2})/"
ENTITY_FILE = r"/([^/]+?)_\d{4}_\d{2}\.parquet(?:/[^/]*)?$"

CORRUPT = "_corrupt_record"
MANIFEST_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def file_name(path: Column | str) -> Column:
    p = F.col(path) if isinstance(path, str) else path
    return F.element_at(F.split(p, "/"), -1)


def period(path: Column | str) -> dict[str, Column]:
    """``year`` and ``month`` strings of a landing path; empty when the path has none."""
    p = F.col(path) if isinstance(path, str) else path
    return {"year": F.regexp_extract(p, YEAR_IN_PATH, 1), "month": F.regexp_extract(p, MONTH_IN_PATH, 1)}


def with_bronze_meta(
    df: DataFrame, batch_id: str, commit_sha: str | None = None, path: Column | None = None
) -> DataFrame:
    """Add source file, ingest time, batch, commit and path period; source columns stay as they are."""
    where = F.col("_metadata.file_path") if path is None else path
    return df.withColumns({
        "_source_file": where,
        "_ingest_timestamp": F.current_timestamp(),
        "_batch_id": F.lit(batch_id),
        "_commit_sha": F.lit(commit_sha).cast("string"),
        **period(where),
    })


def arrow_uri(path: str) -> str:
    """Spark's spelling of a location in Arrow's: plain paths, ``file:/x`` and the Hadoop names of object stores."""
    if path.startswith("/"):
        return "file://" + path
    if path.startswith("file:/") and not path.startswith("file://"):
        return "file://" + path[len("file:"):]
    scheme, _, rest = path.partition("://")
    return f"s3://{rest}" if scheme in ("s3a", "s3n") else path


def _walk(pattern: str, most: int):
    """List folders inside a task. After ``most`` entries the folders that are left are handed back."""

    def run(batches):
        import pyarrow as pa
        from pyarrow import fs as pafs

        for batch in batches:
            for root in batch.column(0).to_pylist():
                system, top = pafs.FileSystem.from_uri(arrow_uri(root))
                scheme = "file:" if isinstance(system, pafs.LocalFileSystem) else root.split("://")[0] + "://"
                waiting, rows, seen = [top], [], 0
                while waiting:
                    if seen >= most:
                        rows += [(scheme + f, None, None, True) for f in waiting]
                        break
                    folder = waiting.pop()
                    info = system.get_file_info(folder)
                    if info.type == pafs.FileType.NotFound:
                        raise FileNotFoundError(scheme + folder)
                    entries = [info] if info.type == pafs.FileType.File else system.get_file_info(pafs.FileSelector(folder))
                    seen += len(entries)
                    for e in entries:
                        if e.type == pafs.FileType.Directory:
                            waiting.append(e.path)
                        elif fnmatchcase(e.base_name, pattern) and e.base_name != "_SUCCESS" and not e.base_name.endswith(".crc"):
                            rows.append((scheme + e.path, e.size, (e.mtime_ns or 0) // 1_000_000, False))
                for k in range(0, len(rows), 10_000):
                    part = rows[k:k + 10_000]
                    kinds = [pa.string(), pa.int64(), pa.int64(), pa.bool_()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*part), kinds)], ["path", "length", "millis", "open"])

    return run


def list_files(spark: SparkSession, root: str | Sequence[str], pattern: str = "*", entries_per_task: int = 10_000) -> DataFrame:
    """path, length and modification time of every file below ``root`` whose name fits ``pattern``.

    Folders are listed inside tasks, round by round: a task walks down until it has seen ``entries_per_task`` entries and
    hands the folders that are left to the next round, where they are dealt out. The driver sees no file; each round is
    written, so that all readers of the listing see the same one. Files of zero bytes and names that start with ``_`` or
    ``.`` are there too (checksum side files and the markers of a finished write are not data and stay out). No file is opened.
    """
    roots = [root] if isinstance(root, str) else list(root)
    folders = spark.createDataFrame([(r,) for r in roots], "folder string")
    walk, rounds = _walk(pattern, entries_per_task), []
    while True:
        level = folders.repartition("folder").mapInArrow(walk, "path string, length bigint, millis bigint, open boolean")
        rounds.append(durable(level, "listing"))
        folders = rounds[-1].filter("open").select(F.col("path").alias("folder"))
        if folders.isEmpty():
            break
    found = reduce(DataFrame.unionByName, rounds).filter("NOT open")
    return found.select("path", "length", F.timestamp_millis("millis").alias("modificationTime"))


def discover_entities(files: DataFrame) -> DataFrame:
    """(entity, files) for monthly Parquet files named ``<entity>_<yyyy>_<mm>.parquet``."""
    entity = F.regexp_extract("path", ENTITY_FILE, 1)
    return files.filter(entity != "").groupBy(entity.alias("entity")).agg(F.count(F.lit(1)).alias("files"))


def discover_groups(files: DataFrame, pattern: str = r"\.csv$") -> DataFrame:
    """(subfolder, file stem, table name, files): one table per CSV kind."""
    parts = F.split("path", "/")
    stem = F.regexp_replace(file_name("path"), pattern, "")
    return (
        files.filter(file_name("path").rlike(pattern))
        .groupBy(F.element_at(parts, -2).alias("subfolder"), stem.alias("stem"))
        .agg(F.count(F.lit(1)).alias("files"))
        .withColumn("table_name", F.concat_ws("_", "subfolder", "stem"))
    )


def build_manifest(spark: SparkSession, root: str | Sequence[str], pattern: str, kind: str, batch_id: str) -> DataFrame:
    """Manifest rows of binary documents; the bytes stay on disk."""
    files = list_files(spark, root, pattern)
    return with_bronze_meta(files, batch_id, path=F.col("path")).withColumns(
        {"file_name": file_name("path"), "file_type": F.lit(kind)}
    )


def changed_files(current: DataFrame, last: DataFrame, deletions: bool = False) -> DataFrame:
    """Files that are new or differ in size or time from the last manifest; empty means nothing to do.

    With ``deletions`` every row has a ``change``: ``added``, ``modified``, or ``deleted`` for a file of the last manifest that
    is gone (its row is the last manifest's).
    """
    keys = ["path", "length", "modificationTime"]
    if not deletions:
        return current.join(last.select(*keys), keys, "left_anti")
    known = last.select(F.col("path").alias("__path"), F.col("length").alias("__length"), F.col("modificationTime").alias("__time"))
    same = (F.col("length").eqNullSafe(F.col("__length"))) & F.col("modificationTime").eqNullSafe(F.col("__time"))
    met = current.join(known, F.col("path") == F.col("__path"), "left").filter(F.col("__path").isNull() | ~same)
    there = met.withColumn("change", F.when(F.col("__path").isNull(), "added").otherwise("modified")).select(*current.columns, "change")
    gone = last.join(current.select("path"), "path", "left_anti").withColumn("change", F.lit("deleted"))
    return there.unionByName(gone, allowMissingColumns=True)


def read_jsonl(spark: SparkSession, paths: str | Sequence[str], schema: str | None = None) -> DataFrame:
    """JSON lines; a line that is no JSON keeps its text in ``_corrupt_record``."""
    reader = spark.read.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    reader = reader.option("recursiveFileLookup", True)
    if schema:
        extra = "" if CORRUPT in schema else f", {CORRUPT} string"
        reader = reader.schema(schema + extra)
    return reader.json(paths)


def read_csv(spark: SparkSession, paths: str | Sequence[str], schema: str | None = None) -> DataFrame:
    """CSV with a header. Without ``schema`` types are inferred, which reads the files twice."""
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE").option("recursiveFileLookup", True)
    reader = reader.schema(schema) if schema else reader.option("inferSchema", True)
    return reader.csv(paths)


def read_control_json(spark: SparkSession, path: str) -> DataFrame:
    """A single pretty-printed JSON document."""
    return spark.read.option("multiLine", True).json(path)


def read_flat_jsonl(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: str,
    columns: Mapping[str, str],
    constants: Mapping[str, object],
) -> DataFrame:
    """JSON lines projected to ``{output: dotted source}`` plus constant marker columns and the source file."""
    reader = spark.read.schema(schema).option("mode", "PERMISSIVE").option("recursiveFileLookup", True)
    return reader.json(paths).select(
        *[F.col(src).alias(out) for out, src in columns.items()],
        *[F.lit(v).alias(n) for n, v in constants.items()],
        F.col("_metadata.file_path").alias("_source_file"),
    )
