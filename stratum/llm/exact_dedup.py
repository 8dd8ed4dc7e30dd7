"""Exact dedup against a persistent digest index.

The index is a Parquet table bucketed and sorted by digest. A batch is reduced to one row per digest, joined
to the index by a sort-merge anti-join (the index side is not shuffled: its buckets are the partitioning),
and the digests that are new are appended. Documents never travel: only (doc_id, digest) rows are shuffled.

Defined results: a null text counts as empty; a null ``doc_id`` never wins over a real one, and among rows of
one text and one id each is marked alike (``kept`` compares ids), while ``keep_largest`` returns one of them; an empty
table gives no rows.
"""

from __future__ import annotations

import hashlib
import uuid
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import delete, durable_at, fresh_path, released, work_root
from .common import map_batches, same_key, settled, unused

#: Buckets of a new index. A cluster-sized index takes thousands; the number is a property of the table.
BUCKETS = 16


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, digest``: SHA-256 (lowercase hex) of the text with A-Z lower-cased, in UTF-8."""

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        raw = batch.column(1).cast(pa.binary())
        out = [hashlib.sha256((x.as_py() or b"").lower()).hexdigest() for x in raw]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], ["doc_id", "digest"])

    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return map_batches(narrow, step, "doc_id long, digest string")


class DigestIndex:
    """Digests seen so far, with the id that stays and how many rows carried the digest when it came."""

    def __init__(self, spark: SparkSession, name: str | None = None, path: str | None = None, buckets: int = BUCKETS):
        """``name``/``path`` reopen an index; without them a fresh one is made in the shared folder."""
        self.spark = spark
        self.name = name or f"digest_index_{uuid.uuid4().hex}"
        self.path = path or f"{work_root(spark)}/{self.name}"
        self.buckets = buckets
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} (digest STRING, keep_id BIGINT, group_size BIGINT) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{self.path}'"
        )

    def table(self) -> DataFrame:
        return self.spark.table(self.name)

    def unseen(self, rows: DataFrame) -> DataFrame:
        """Rows whose ``digest`` the index does not hold."""
        return rows.join(self.table().hint("merge"), "digest", "left_anti")

    def drop(self) -> None:
        """Remove the index, its files and its entry in the catalog."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        delete(self.spark, self.path)

    def ingest(self, hashed: DataFrame) -> DataFrame:
        """Add a batch of ``doc_id, digest`` rows; returns the batch's new groups ``digest, keep_id, group_size``.

        Groups are combined map-side before the shuffle, so a text that is a third of the batch costs one row
        per task.
        """
        groups = hashed.groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        fresh = settled(self.unseen(groups), "digests")
        (
            fresh.repartition(self.buckets, "digest").write.format("parquet").mode("append")
            .bucketBy(self.buckets, "digest").sortBy("digest").saveAsTable(self.name, path=self.path)
        )
        return fresh


def batches_by_id(hashed: DataFrame, batches: int) -> list[DataFrame]:
    """The rows cut by id, larger ids first, null ids last."""
    cuts = hashed.agg(F.percentile_approx("doc_id", [k / batches for k in range(1, batches)], 10_000)).first()[0] if batches > 1 else []
    cuts = sorted(set(cuts or []), reverse=True)
    doc, out = F.col("doc_id"), []
    for upper, lower in zip([None, *cuts], [*cuts, None]):
        inside = F.lit(True) if upper is None else F.coalesce(doc <= upper, F.lit(True))
        out.append(hashed.filter(inside & (F.lit(True) if lower is None else F.coalesce(doc > lower, F.lit(False)))))
    return out


def exact_dedup(docs: DataFrame, index: DigestIndex | None = None, batches: int = 1) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``.

    The row with the largest id stays in each group of equal texts. With an ``index`` from earlier batches a
    known text is dropped in favour of the row that stayed then. ``batches`` cuts the documents by id and adds the largest
    ids first, so that each later batch meets the index of those before it and the result is that of one batch. The
    label join is one that AQE can split, so the copies of a very common text are labelled by several tasks. An index made
    here is dropped again.
    """
    passing = index is None
    index = index or DigestIndex(docs.sparkSession)
    hashed = settled(digests(docs), "hashed")
    earlier = index.table().count() > 0
    before = settled(index.table(), "known") if earlier else None
    fresh = [index.ingest(part) for part in batches_by_id(hashed, batches)]
    groups = fresh[0]
    if len(fresh) > 1:
        sizes = hashed.groupBy(F.col("digest").alias("counted")).agg(F.count(F.lit(1)).alias("group_size"))
        groups = reduce(DataFrame.unionByName, fresh).drop("group_size")
        groups = settled(groups.join(sizes, F.col("digest") == F.col("counted")).drop("counted"), "groups")
    if passing:
        index.drop()
    if before is not None:
        groups = groups.unionByName(before)
    found = groups.withColumnRenamed("digest", "known_digest")
    labelled = hashed.join(found, same_key("digest", "known_digest", "exact"), "left")
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    if before is not None:
        old = before.select(F.col("digest").alias("old_digest"))
        labelled = labelled.join(old, same_key("digest", "old_digest", "old"), "left")
        kept = kept & F.col("old_digest").isNull()
    return labelled.select("doc_id", "keep_id", "group_size", kept.alias("kept"), F.col("digest").alias("text_sha256"))


def keep_largest(docs: DataFrame) -> DataFrame:
    """The documents that stay, with all their columns: exactly one row of each group of equal texts.

    A row is told by its id where the id occurs once. Rows of repeated and null ids are told by id and digest, and of rows
    equal in both one stays; only these few are shuffled with their texts.
    """
    with released(docs.sparkSession):
        marked = durable_at(exact_dedup(docs).select("doc_id", "text_sha256", "kept"), fresh_path(docs.sparkSession, "llm-marked"))
    name, digest = unused(docs, "keep_doc"), unused(docs, "keep_digest")
    counts = marked.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.count_if("kept").alias("stay"))
    doc = F.col("doc_id").cast("long")
    plain = counts.filter("n = 1 AND stay = 1 AND doc_id IS NOT NULL").select(F.col("doc_id").alias(name))
    alone = docs.join(plain, doc == F.col(name), "left_semi")
    several = counts.filter("(n > 1 OR doc_id IS NULL) AND stay > 0").select(F.col("doc_id").alias(name))
    if several.isEmpty():
        return alone
    rows = docs.join(several, doc.eqNullSafe(F.col(name)), "left_semi")
    columns = rows.columns

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        raw = batch.column(columns.index("text")).cast(pa.binary())
        found = [hashlib.sha256((x.as_py() or b"").lower()).hexdigest() for x in raw]
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.string())], [*columns, digest])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    rows = map_batches(rows, step, f"{schema}, `{digest}` string")
    won = marked.filter("kept").select(F.col("doc_id").alias(name), F.col("text_sha256").alias("won_digest")).distinct()
    won = rows.join(won, doc.eqNullSafe(F.col(name)) & (F.col(digest) == F.col("won_digest")), "left_semi")
    return alone.unionByName(won.dropDuplicates(["doc_id", digest]).drop(digest))
