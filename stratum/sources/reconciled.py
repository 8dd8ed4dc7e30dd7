"""Parquet reading that survives schema drift, empty shells and broken files."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import durable
from .files import ENTITY_FILE, arrow_uri, file_name, period

# fixed values: first bytes of a Parquet file and of a pointer file left by an unfinished download
PARQUET_MAGIC = b"PAR1"
POINTER_PREFIX = b"version "

FOOTER_SCHEMA = "path string, length bigint, magic string, columns int, rows bigint, schema_text string, verdict string"


def _footers(batches):
    """Read one footer per path inside the task: magic bytes, column names and types, row count."""
    import pyarrow as pa
    import pyarrow.fs as pafs
    import pyarrow.parquet as pq

    for batch in batches:
        out = []
        for path in batch["path"]:
            row = {"path": path, "length": None, "magic": None, "columns": None, "rows": None, "schema_text": None}
            # a file system that cannot be opened fails the task: that is no property of the file
            fs, inner = pafs.FileSystem.from_uri(arrow_uri(path))
            try:
                row["length"] = fs.get_file_info(inner).size
                with fs.open_input_file(inner) as f:
                    head = f.read(8)
                row["magic"] = head[:4].decode("latin-1")
                if not head:
                    row["verdict"] = "zero_bytes"
                elif head.startswith(POINTER_PREFIX):
                    row["verdict"] = "pointer"
                elif head[:4] != PARQUET_MAGIC:
                    row["verdict"] = "not_parquet"
                else:
                    with fs.open_input_file(inner) as f:
                        meta = pq.ParquetFile(f)
                        row["rows"] = meta.metadata.num_rows
                        fields = meta.schema_arrow
                    row["columns"] = len(fields)
                    row["schema_text"] = "\n".join(f"{x.name}: {x.type}" for x in fields)
                    row["verdict"] = "ok" if len(fields) else "empty_shell"
            except (pa.ArrowInvalid, pa.ArrowNotImplementedError, EOFError) as error:
                # broken bytes are a finding; a missing right or a network fault fails the task
                row["verdict"] = f"unreadable: {type(error).__name__}"
            except OSError as error:
                if error.errno is not None:
                    raise
                row["verdict"] = f"unreadable: {type(error).__name__}"  # Arrow's word for bytes that end too early
            out.append(row)
        yield pd.DataFrame(out, columns=[c.split()[0] for c in FOOTER_SCHEMA.split(", ")])


def probe_files(paths: DataFrame) -> DataFrame:
    """Footer facts and a verdict per file of a listing: ok, zero_bytes, empty_shell, pointer, not_parquet,
    unreadable."""
    dealt = paths.select("path").repartition("path")
    return dealt.mapInPandas(_footers, FOOTER_SCHEMA)


def schema_groups(probed: DataFrame, folders: bool = True) -> DataFrame:
    """``schema_digest, place`` to read: whole folders whose files all have one schema, single files of the other folders
    (of all, without ``folders``).

    So the plan's path lists grow with the folders, not with the files, as long as a folder holds one kind of file.
    """
    folder = F.regexp_replace("path", "/[^/]*$", "")
    digest = F.when(F.col("verdict") == "ok", F.sha2("schema_text", 256))
    files = probed.select("path", folder.alias("folder"), digest.alias("schema_digest"), file_name("path").rlike("^[_.]").alias("hidden"))
    whole = files.groupBy("folder").agg(
        (F.bool_and(F.col("schema_digest").isNotNull() & ~F.col("hidden")) & (F.min("schema_digest") == F.max("schema_digest"))).alias("alike"),
    )
    if not folders:
        return files.filter("schema_digest IS NOT NULL").select("schema_digest", F.col("path").alias("place"))
    placed = files.filter("schema_digest IS NOT NULL").join(whole.withColumnRenamed("folder", "of_folder"), F.col("folder") == F.col("of_folder"))
    return placed.select("schema_digest", F.when(F.col("alike"), F.col("folder")).otherwise(F.col("path")).alias("place")).distinct()


def read_reconciled(spark: SparkSession, paths: DataFrame, pattern: str | None = None) -> tuple[DataFrame, list[str], DataFrame]:
    """Read the Parquet files of a listing as one table: (rows, conflicting columns, skipped files with their verdicts).

    Files are grouped by schema, so the plan has one scan per distinct schema. A column whose type differs between schemas
    becomes string; a missing column is null. A ``pattern`` promises that the listing holds every file below its folders
    whose name fits: then a folder of one schema is read as a folder. Without it (a listing that holds a part, like the
    files of a micro-batch) the files are named one by one. What the driver sees: a sample file per schema, and the places
    of ``schema_groups``.
    """
    probed = durable(probe_files(paths), "probes")
    skipped = probed.filter("verdict <> 'ok'").select("path", "verdict")
    samples = probed.filter("verdict = 'ok'").groupBy(F.sha2("schema_text", 256).alias("schema_digest")).agg(F.min("path").alias("path")).collect()
    if not samples:
        raise ValueError("no readable Parquet file among the given paths")
    places: dict[str, list[str]] = {}
    for row in schema_groups(probed, pattern is not None).toLocalIterator():
        places.setdefault(row["schema_digest"], []).append(row["place"])

    frames = []
    for digest, sample in sorted(samples):
        schema = spark.read.parquet(sample).schema
        # a folder is listed by Spark, in tasks if there are many; names given one by one are read as they are
        frame = spark.read.schema(schema).option("pathGlobFilter", pattern or "*").parquet(*places[digest])
        frames.append(frame.select("*", F.col("_metadata.file_path").alias("_source_file")))
    kinds: dict[str, set[str]] = {}
    for frame in frames:
        for field in frame.schema:
            kinds.setdefault(field.name, set()).add(field.dataType.simpleString())
    conflicts = sorted(c for c, types in kinds.items() if len(types) > 1)
    alike = [
        f.withColumns({c: F.col(c).cast("string") for c in conflicts if c in f.columns}) if conflicts else f
        for f in frames
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), alike), conflicts, skipped


def expected_grid(spark: SparkSession, entities: Sequence[str], first_month: str, last_month: str) -> DataFrame:
    """Every (entity, year, month) that should have a file; grows with the calendar only."""
    months = F.sequence(F.lit(first_month).cast("date"), F.lit(last_month).cast("date"), F.expr("interval 1 month"))
    return (
        spark.range(1).select(F.explode(F.array(*[F.lit(e) for e in entities])).alias("entity"), F.lit(1).alias("one"))
        .select("entity", F.explode(months).alias("day"))
        .select(
            "entity", F.date_format("day", "yyyy").alias("year"), F.date_format("day", "MM").alias("month"),
            F.concat_ws("_", "entity", F.date_format("day", "yyyy"), F.date_format("day", "MM")).alias("stem"),
        )
        .withColumn("file_name", F.concat("stem", F.lit(".parquet"))).drop("stem")
    )


def gap_manifest(grid: DataFrame, probes: DataFrame) -> DataFrame:
    """The expected grid with what was found: size, finding, type of gap and what to do about it.

    A file belongs to the entity, year and month that its path tells, whatever folder it lies in; of several for one
    month the best counts, sizes and rows add up. ``finding_id`` names the grid cell.
    """
    where = period("path")
    entity = F.regexp_extract("path", ENTITY_FILE, 1)
    of_month = probes.filter(entity != "").groupBy(entity.alias("__e"), where["year"].alias("__y"), where["month"].alias("__m"))
    seen = of_month.agg(
        F.sum("length").alias("length"), F.sum("rows").alias("rows"),
        F.when(F.max(F.col("verdict") == "ok"), "ok").otherwise(F.min("verdict")).alias("verdict"),
    )
    finding = (
        F.when(F.col("verdict").isNull(), "missing")
        .when(F.col("verdict") != "ok", F.col("verdict"))
        .when(F.col("rows") == 0, "no_rows").otherwise("present")
    )
    resolution = (
        F.when(F.col("finding") == "present", "none")
        .when(F.col("finding").isin("missing", "zero_bytes", "empty_shell", "no_rows"), "request_from_source")
        .otherwise("fetch_again")
    )
    gap_type = (
        F.when(F.col("finding") == "present", "none").when(F.col("finding") == "missing", "absent_file")
        .when(F.col("finding").isin("zero_bytes", "empty_shell", "no_rows"), "empty_file").otherwise("broken_file")
    )
    return (
        grid.join(seen, (F.col("entity") == F.col("__e")) & (F.col("year") == F.col("__y")) & (F.col("month") == F.col("__m")), "left")
        .withColumn("on_disk", F.col("verdict").isNotNull())
        .withColumn("finding", finding)
        .withColumn("resolution", resolution)
        .withColumn("gap_type", gap_type)
        .withColumn("finding_id", F.concat_ws("-", "entity", "year", "month", "finding"))
        .select("finding_id", "year", "month", "entity", "file_name", "on_disk", F.col("length").alias("size"), "finding", "gap_type", "resolution")
    )


def with_period(df: DataFrame, path: str = "_source_file") -> DataFrame:
    return df.withColumns(period(path))
