"""Document fingerprints: a homomorphic hash of the multiset of paragraphs.

Every paragraph is hashed to a wide vector and a document's fingerprint is the sum of its paragraphs' vectors modulo
powers of two. So the order of paragraphs does not matter, equal texts have equal fingerprints, and a paragraph is
inserted or removed by adding or subtracting its vector. The vector has two parts:

* 8 lanes modulo 2**64, the 512 bits of the paragraph's BLAKE2b digest: equality of multisets;
* ``LANES`` lanes modulo 2**32: each run of three words of the paragraph adds or subtracts 1 in one lane, which no text
  can wrap around. Sums stay linear, and the cosine of two such parts estimates how much of the words two documents share.

Defined results: a null text counts as empty; the empty document has the zero vector; likeness of two empty ones is 1,
of an empty and another one 0. "Next" is the next row by falling id (nulls last, ties by a hash of the text), after the
last the first; a single row is its own next one.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import settled
from .words import U, cut_words, mix, text_steps

EXACT, LANES = 8, 256
BYTES = EXACT * 8 + LANES * 4
#: Buckets of consecutive ids per shuffle partition.
BUCKETS = 3


def step_vectors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(documents x 8 of uint64, documents x LANES of uint32)``."""
    docs = len(offsets) - 1
    exact, loose = np.zeros((docs, EXACT), np.uint64), np.zeros((docs, LANES), np.uint32)
    if not len(data):
        return exact, loose
    # paragraphs: runs between line feeds
    line = data == 10
    start = np.zeros(len(data) + 1, bool)
    start[offsets] = True
    start = start[:-1]
    start |= line
    start[1:] |= line[:-1]
    starts = np.flatnonzero(start)
    ends = np.append(starts[1:], len(data))
    real = ~line[starts]
    starts, ends = starts[real], ends[real]
    doc = np.searchsorted(offsets, starts, side="right") - 1
    if len(starts):
        raw = data.tobytes()
        digests = b"".join([hashlib.blake2b(raw[a:b]).digest() for a, b in zip(starts.tolist(), ends.tolist())])
        begins = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
        exact[doc[begins]] = np.add.reduceat(np.frombuffer(digests, "<u8").reshape(-1, EXACT), begins, axis=0)
    # runs of three words inside a paragraph (all words, when it has fewer)
    words, _, first, _ = cut_words(data, offsets)
    if len(words):
        own = np.searchsorted(starts, first, side="right") - 1
        size = np.bincount(own, minlength=len(starts))[own]
        head = np.concatenate([[True], own[1:] != own[:-1]])
        place = np.arange(len(own)) - np.maximum.accumulate(np.where(head, np.arange(len(own)), 0))
        use = (place + 3 <= size) | ((size < 3) & (place == 0))
        padded = np.concatenate([words, np.zeros(2, np.uint64)])
        second = np.where(size - place > 1, padded[1:-1], U(1))
        third = np.where(size - place > 2, padded[2:], U(2))
        runs = mix(words * U(0x9FB21C651E98DF25) + second * U(0xD6E8FEB86659FD93) + third * U(0xA0761D6478BD642F))[use]
        lane = (runs >> U(40)).astype(np.int64) % LANES
        sign = np.where(runs & U(1), 1.0, -1.0)
        at = doc[own[use]] * LANES + lane
        loose += np.bincount(at, sign, docs * LANES).astype(np.int64).reshape(docs, LANES).astype(np.uint32)
    return exact, loose


def vectors(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    parts = [step_vectors(data, offsets) for _, _, data, offsets in text_steps(texts)]
    if not parts:
        return np.zeros((0, EXACT), np.uint64), np.zeros((0, LANES), np.uint32)
    return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])


def packed(exact: np.ndarray, loose: np.ndarray) -> list[str]:
    raw = np.concatenate([exact.astype("<u8").view(np.uint8).reshape(len(exact), -1), loose.astype("<u4").view(np.uint8).reshape(len(loose), -1)], axis=1)
    return [base64.b64encode(row.tobytes()).decode() for row in raw]


def unpacked(fingerprint: str) -> tuple[np.ndarray, np.ndarray]:
    raw = base64.b64decode(fingerprint)
    return np.frombuffer(raw[:EXACT * 8], "<u8"), np.frombuffer(raw[EXACT * 8:], "<u4")


def fingerprint(text: str | None) -> str:
    return packed(*vectors(pa.array([text], pa.string())))[0]


def changed(before: str, inserted: str = "", removed: str = "") -> str:
    """The fingerprint after whole paragraphs were inserted and removed, without the rest of the text."""
    (e, w), (ei, wi), (er, wr) = unpacked(before), unpacked(fingerprint(inserted)), unpacked(fingerprint(removed))
    return packed((e + ei - er)[None, :], (w + wi - wr)[None, :])[0]


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of the signed lanes, row by row, from 0 to 1."""
    a, b = a.astype(np.int32).astype(float), b.astype(np.int32).astype(float)
    na, nb = np.sqrt((a * a).sum(1)), np.sqrt((b * b).sum(1))
    cosine = (a * b).sum(1) / np.maximum(na * nb, 1e-9)
    return np.where((na == 0) & (nb == 0), 1.0, np.clip(cosine, 0.0, 1.0))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fingerprint`` of every document; nothing is shuffled."""

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed(*vectors(batch.column(1))), pa.string())], ["doc_id", "fingerprint"])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(run, "doc_id long, fingerprint string")


def bucket_of(ids: np.ndarray, missing: np.ndarray, hashes: np.ndarray, cuts: np.ndarray, null_parts: int) -> np.ndarray:
    """Bucket 0 holds the largest ids; null ids follow, cut by text hash."""
    known = len(cuts) - np.searchsorted(cuts, ids, side="right")
    part = ((hashes.astype(float) + 2.0 ** 63) * (null_parts / 2.0 ** 64)).astype(np.int64)
    return np.where(missing, len(cuts) + 1 + np.clip(part, 0, max(null_parts - 1, 0)), known)


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Documents in buckets of consecutive ids, sorted by falling id, each bucket followed by the row after it.

    Columns ``bucket, extra, doc_id, text``; a bucket lies whole and in order in one partition, and each text is shuffled
    once. The driver sees the bucket borders only: a few numbers per shuffle partition, which tasks search in a sorted
    array. Null ids come last and are spread over buckets by the hash of their text.
    """
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    count = partitions * BUCKETS
    asked = F.percentile_approx("doc_id", [i / count for i in range(1, count)], 100 * count) if count > 1 else F.lit(None)
    known, everything, found = rows.agg(F.count("doc_id"), F.count(F.lit(1)), asked).first()
    cuts = np.array(sorted(set(found or [])), np.int64)
    null_parts = -(-(everything - known) * count // max(everything, 1))
    nothing = F.lit(0).cast("long")
    rows = rows.withColumn("tie", F.when(F.col("doc_id").isNull(), F.xxhash64("text")).otherwise(nothing) if null_parts else nothing)

    def place(ids: pd.Series, ties: pd.Series) -> pd.Series:
        missing = ids.isna().to_numpy()
        return pd.Series(bucket_of(ids.fillna(0).to_numpy().astype(np.int64), missing, ties.to_numpy(), cuts, null_parts))

    # the first row of each bucket, one (id, tie) per bucket, is what the bucket before it needs
    placed = F.pandas_udf(place, "long")("doc_id", "tie").alias("bucket")
    first = rows.select("doc_id", "tie", placed).groupBy("bucket").agg(F.max("doc_id"), F.min("tie")).orderBy("bucket").collect()
    heads = {(r[1], r[2]): p["bucket"] for p, r in zip(first[-1:] + first[:-1], first)}

    def buckets(ids: pd.Series, ties: pd.Series) -> pd.Series:
        """Buckets of a row, as a list: its own and, for a head, the one before."""
        own = place(ids, ties).tolist()
        keys = zip([None if i is None or i != i else int(i) for i in ids.tolist()], ties.tolist())
        return pd.Series([[b, before] if (before := heads.get(key)) is not None else [b] for b, key in zip(own, keys)])

    both = rows.withColumn("buckets", F.pandas_udf(buckets, "array<long>")("doc_id", "tie"))
    both = both.select(F.posexplode("buckets").alias("extra", "bucket"), "doc_id", "text")
    return both.select("bucket", "extra", "doc_id", "text").repartition(partitions, "bucket").sortWithinPartitions(
        "bucket", "extra", F.col("doc_id").desc_nulls_last(), F.xxhash64("text"),
    )


def edited_text(text: str, following: str) -> str:
    """The last half of ``text`` (rounded down) replaced by as much of the beginning of ``following``."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def compare_with_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness; see the module text for "next"."""
    schema = (
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double"
    )
    names = [part.split()[0] for part in schema.split(", ")]

    def block(rows: list[tuple[int | None, str, str]]) -> pa.RecordBatch:
        """Rows of (id, text, next text); a text that is the next row's is hashed once."""
        edited = [edited_text(text, following) for _, text, following in rows]
        texts = [r[1] for r in rows]
        exact, loose = vectors(pa.array(texts + edited, pa.string()))
        n = len(rows)
        # the next row of a row is usually the one below it; only the last of a block or bucket needs its own pass
        away = [k for k in range(n) if k + 1 == n or rows[k][2] is not rows[k + 1][1]]
        _, other = vectors(pa.array([rows[k][2] for k in away], pa.string()))
        following = np.concatenate([loose[1:n], np.zeros((1, LANES), np.uint32)]) if n else loose[:0]
        following[away] = other
        shown, changed_shown = packed(exact[:n], loose[:n]), packed(exact[n:], loose[n:])
        arrays = [
            pa.array([r[0] for r in rows], pa.int64()), pa.array([len(t) for t in texts], pa.int64()),
            pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited], pa.string()),
            pa.array(shown, pa.string()), pa.array(changed_shown, pa.string()),
            pa.array(likeness(loose[:n], loose[n:])), pa.array(likeness(loose[:n], following)),
        ]
        return pa.RecordBatch.from_arrays(arrays, names)

    def run(batches):
        waiting = None  # the last row of a bucket so far: (bucket, id, text)
        done, size = [], 0
        for batch in batches:
            # row by row: a batch is never turned into Python objects as a whole
            for bucket, extra, doc_id, text in zip(*(batch.column(i) for i in range(4))):
                bucket, extra, text = bucket.as_py(), extra.as_py(), text.as_py()
                if waiting is not None and waiting[0] == bucket:
                    done.append((waiting[1], waiting[2], text))
                    size += len(waiting[2])
                waiting = None if extra else (bucket, doc_id.as_py(), text)
                if size > 1 << 20:
                    yield block(done)
                    done, size = [], 0
        if done:
            yield block(done)

    return with_next(docs, id_col, text_col).mapInArrow(run, schema)
