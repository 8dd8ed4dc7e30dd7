"""Near-dedup by min-max hashing.

Each permutation of the shingles gives two signature values, its minimum and its maximum, so half as many hash
evaluations are needed as with minima alone; both agree between two sets with probability equal to their Jaccard
similarity. Bands of the signature are bucketed, and links are confirmed on the full sets.

No bucket is expanded into pairs:

1. Rows with equal sets are one node (its smallest id).
2. In each bucket every node is compared with the bucket's smallest id and with the id whose turn it is by a hash (two
   stars). Confirmed links give components.
3. A bucket whose nodes are then all in one component is done. In a mixed bucket the nodes outside its largest component
   are compared with all nodes of the bucket, block against block, through an inverted index inside a task; of the links
   found only one per node and component leaves the task.

So the components are those of all confirmed links between nodes that share a bucket. With the production bands two
sets of similarity 0.8 miss each other with probability (1 - 0.8**5)**40 < 2e-7.

Defined results: a null or blank text has the empty set, which is linked with nothing; rows of one id are one node; a row
with a null id is never linked (component null) and kept.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..session import kept, released
from .common import map_batches, same_key, settled, unused
from .components import components
from .words import U, cut_words, mix, text_steps

BANDS, ROWS = 40, 5
#: Shingles of all nodes in one block of a mixed bucket: what a task holds at a time.
BLOCK = 1 << 20
NO_WORD = U(0x2545F4914F6CDD1D)


def shingle_sets(texts: pa.Array, words: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every text: ``words`` words each; fewer words are one shingle."""
    out = []
    for _, _, data, offsets in text_steps(texts):
        hashes, counts, _, _ = cut_words(data, offsets)
        ends = np.cumsum(counts)
        for end, n in zip(ends.tolist(), counts.tolist()):
            own = hashes[end - n:end]
            k = min(words, n)
            if not k:
                out.append(own)
                continue
            total = np.full(n - k + 1, U(k), np.uint64)
            for j in range(k):
                total = total * U(0x9FB21C651E98DF25) + own[j:n - k + 1 + j]
                total = total ^ (total >> U(29))
            out.append(np.unique(mix(total)))
    return out


class MinMax:
    """``bands`` band keys from ``bands * rows`` signature values, half of them minima, half maxima."""

    def __init__(self, bands: int = BANDS, rows: int = ROWS, seed: int = 11):
        if bands * rows % 2:
            raise ValueError("an even number of signature values is needed")
        rng = np.random.default_rng(seed)
        self.bands, self.rows = bands, rows
        self.factors = rng.integers(1, 1 << 63, bands * rows // 2, dtype=np.uint64) * U(2) + U(1)
        self.tags = mix(np.arange(1, bands + 1, dtype=np.uint64))

    def signature(self, shingles: np.ndarray) -> np.ndarray:
        low = np.full(len(self.factors), np.iinfo(np.uint64).max, np.uint64)
        high = np.zeros(len(self.factors), np.uint64)
        for at in range(0, len(shingles), 2048):
            turned = self.factors[:, None] * shingles[None, at:at + 2048]
            low, high = np.minimum(low, turned.min(1)), np.maximum(high, turned.max(1))
        return np.concatenate([low, high])

    def keys(self, shingles: np.ndarray) -> np.ndarray:
        key = self.tags.copy()
        for value in self.signature(shingles).reshape(self.bands, self.rows).T:
            key = mix(key ^ value)
        return key.view(np.int64)


def signed_sets(docs: DataFrame, words: int, hasher: MinMax) -> DataFrame:
    """``doc_id, n_shingles, set_a, set_b, bands``: set size, a 128-bit digest of the set, and its band keys."""

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = shingle_sets(batch.column(1), words)
        size = np.fromiter(map(len, sets), np.int64, len(sets))
        first = [int(s.sum(dtype=np.uint64).view(np.int64)) if len(s) else 0 for s in sets]
        second = [int(mix(s ^ NO_WORD).sum(dtype=np.uint64).view(np.int64)) if len(s) else 0 for s in sets]
        bands = [hasher.keys(s) if len(s) else np.zeros(0, np.int64) for s in sets]
        arrays = [batch.column(0), pa.array(size), pa.array(first, pa.int64()), pa.array(second, pa.int64()), pa.array(bands, pa.list_(pa.int64()))]
        return pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_shingles", "set_a", "set_b", "bands"])

    return map_batches(docs, step, "doc_id long, n_shingles long, set_a long, set_b long, bands array<long>")


def sets_of(docs: DataFrame, ids: DataFrame, words: int) -> DataFrame:
    """``node, shingles`` (sorted) of the documents in ``ids`` (column ``node``)."""

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = [s.view(np.int64) for s in shingle_sets(batch.column(1), words)]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.list_(pa.int64()))], ["node", "shingles"])

    chosen = docs.join(ids, F.col("doc_id") == F.col("node"), "left_semi").select("doc_id", "text")
    return map_batches(chosen, step, "node long, shingles array<long>")


def similar(a: int, b: int, both: int, percent: int) -> bool:
    return 100 * both >= percent * (a + b - both)


def confirmed_pairs(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The ``a, b`` of ``pairs`` whose sets are similar enough. Every ``a`` brings its set once per partner, the
    partners' sets are joined on the other side, where AQE may split one with very many rows."""
    left = sets.select(F.col("node").alias("x"), F.col("shingles").alias("sx"))
    right = sets.select(F.col("node").alias("y"), F.col("shingles").alias("sy"))
    joined = pairs.join(left, same_key("a", "x", "left")).join(right, same_key("b", "y", "right"))
    small, large = F.least(F.size("sx"), F.size("sy")), F.greatest(F.size("sx"), F.size("sy"))
    joined = joined.filter(small * 100 >= large * percent)

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        keep = []
        for sx, sy in zip(batch.column(2), batch.column(3)):
            x, y = sx.values.to_numpy(), sy.values.to_numpy()
            both = len(np.intersect1d(x, y, assume_unique=True))
            keep.append(similar(len(x), len(y), both, percent))
        return batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return map_batches(joined.select("a", "b", "sx", "sy"), step, "a long, b long")


def mixed_links(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between components inside mixed buckets.

    ``members``: ``bucket, node, component, outer`` (outside the bucket's largest component), ``blocks``. Outer nodes meet
    all nodes of their bucket in tasks of one block against one block.
    """
    placed = members.withColumn("block", F.pmod(F.xxhash64("node", F.lit("block")), F.col("blocks")).cast("int"))
    others = F.sequence(F.lit(0), F.col("blocks") - 1)
    left = placed.filter("outer").select("bucket", "node", "component", F.lit(True).alias("outer"), F.col("block").alias("mine"), F.explode(others).alias("theirs"))
    right = placed.select("bucket", "node", "component", F.lit(False).alias("outer"), F.col("block").alias("theirs"), F.explode(others).alias("mine"))
    rows = left.unionByName(right)
    keyed = sets.select(F.col("node").alias("x"), "shingles")
    rows = rows.join(keyed, same_key("node", "x", "mixed")).select(
        F.xxhash64("bucket", "mine", "theirs").alias("cell"), "outer", "node", "component", "shingles",
    )
    schema = "a long, b long"

    def links(cell: list) -> list[tuple[int, int]]:
        """One link per outer node and component of the other side."""
        inner = [r for r in cell if not r[0]]
        outer = [r for r in cell if r[0]]
        if not outer or not inner:
            return []
        tokens = np.concatenate([r[3] for r in inner])
        owner = np.repeat(np.arange(len(inner)), [len(r[3]) for r in inner])
        order = np.argsort(tokens, kind="stable")
        tokens, owner = tokens[order], owner[order]
        size = np.array([len(r[3]) for r in inner])
        comp = np.array([r[2] for r in inner])
        out = []
        for _, node, component, shingles in outer:
            a, b = np.searchsorted(tokens, shingles, "left"), np.searchsorted(tokens, shingles, "right")
            hit = b > a
            jump = np.repeat(a[hit] - np.concatenate([[0], np.cumsum(b[hit] - a[hit])[:-1]]), (b - a)[hit]) if hit.any() else np.zeros(0, np.int64)
            both = np.bincount(owner[np.arange(len(jump)) + jump], minlength=len(inner))
            good = (100 * both >= percent * (size + len(shingles) - both)) & (comp != component)
            found = np.flatnonzero(good)
            for k in found[np.unique(comp[found], return_index=True)[1]]:
                out.append((node, inner[k][1]))
        return out

    def run(batches):
        cell, now, out = None, [], []
        for batch in batches:
            for key, outer, node, component, shingles in zip(*batch.columns):
                key = key.as_py()
                if key != cell:
                    out += links(now)
                    cell, now = key, []
                # a copy: a view would hold its whole batch for as long as the cell lasts
                now.append((outer.as_py(), node.as_py(), component.as_py(), shingles.values.to_numpy().copy()))
            if len(out) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.int64()) for i in (0, 1)], ["a", "b"])
                out = []
        out += links(now)
        yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.int64()) for i in (0, 1)], ["a", "b"])

    return rows.repartition("cell").sortWithinPartitions("cell").mapInArrow(run, schema)


def near_duplicates(
    docs: DataFrame, words: int = 2, percent: int = 80, bands: int = BANDS, rows: int = ROWS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row; links need ``100 * both >= percent * either``.

    The result is written; all steps before it are deleted.
    """
    with released(docs.sparkSession):
        return kept(marked_components(docs, words, percent, bands, rows, id_col, text_col), "llm-components")


def marked_components(docs: DataFrame, words: int, percent: int, bands: int, rows: int, id_col: str, text_col: str) -> DataFrame:
    hasher = MinMax(bands, rows)
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    signed = settled(signed_sets(narrow, words, hasher), "signed")
    usable = signed.filter("doc_id IS NOT NULL AND n_shingles > 0")
    nodes = usable.groupBy("set_a", "set_b", "n_shingles").agg(F.min("doc_id").alias("node"), F.count(F.lit(1)).alias("copies"))
    nodes = settled(nodes, "nodes")
    # rows of equal sets are linked to their node; the join is one that AQE can split
    same = F.xxhash64("set_a", "set_b", "n_shingles")
    equal = usable.withColumn("__s", same).join(
        nodes.filter("copies > 1").select(same.alias("__t"), "node"), same_key("__s", "__t", "equal")
    ).select(F.col("doc_id").alias("a"), F.col("node").alias("b"))
    heads = usable.join(nodes.select("node"), same_key("doc_id", "node", "heads"))
    spread = heads.select(F.col("doc_id").alias("node"), "n_shingles", F.explode("bands").alias("bucket")).distinct()
    # a bucket holds at most one row per node, a small part of all (node, band) rows
    bucket = Window.partitionBy("bucket")
    turn = F.struct(F.xxhash64("node").alias("h"), F.col("node").alias("n"))
    members = spread.withColumns({"low": F.min("node").over(bucket), "turn": F.min(turn).over(bucket), "size": F.count(F.lit(1)).over(bucket)})
    members = settled(members.filter("size > 1").select("bucket", "node", "n_shingles", "low", F.col("turn.n").alias("turn")), "members")
    stars = members.select(F.col("node").alias("a"), F.explode(F.array("low", "turn")).alias("b")).filter("a <> b").distinct()
    sets = settled(sets_of(narrow, members.select("node").distinct(), words), "sets")
    links = settled(confirmed_pairs(stars, sets, percent), "confirmed")
    first = components(links)
    # mixed buckets: several components are left in them
    known = first.withColumnRenamed("node", "known")
    labelled = settled(members.join(known, same_key("node", "known", "labels"), "left").select(
        "bucket", "node", "n_shingles", F.coalesce("root", "node").alias("component"),
    ), "labelled")
    counts = labelled.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("weight"))
    per = Window.partitionBy("bucket")
    counts = counts.withColumns({"kinds": F.count(F.lit(1)).over(per), "all": F.sum("weight").over(per), "top": F.max(F.struct("n", "component")).over(per)})
    mixed = counts.filter("kinds > 1").select("bucket", F.col("top.component").alias("main"), F.ceil(F.col("all") / BLOCK).cast("int").alias("blocks")).distinct()
    mixed = settled(mixed.select(F.col("bucket").alias("mixed"), "main", "blocks"), "mixed")
    inside = labelled.join(mixed, same_key("bucket", "mixed", "mixed")).select(
        "bucket", "node", "component", (F.col("component") != F.col("main")).alias("outer"), "blocks",
    )
    more = settled(mixed_links(inside, sets, percent), "more")
    every = links.unionByName(more).unionByName(equal)
    final = components(every)
    rooted = signed.join(final.select("node", "root"), same_key("doc_id", "node", "final"), "left")
    component = F.coalesce("root", "doc_id")
    return rooted.select("doc_id", "n_shingles", component.alias("component_id"), (F.col("doc_id").isNull() | (F.col("doc_id") == component)).alias("kept"))


def keep_one(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """One document of each near-duplicate group, with all columns (every row of the kept id)."""
    name = unused(docs, "keep_doc")
    stay = near_duplicates(docs, words, percent).filter("kept").select(F.col("doc_id").alias(name)).distinct()
    return docs.join(stay, F.col("doc_id").eqNullSafe(F.col(name)), "left_semi")
