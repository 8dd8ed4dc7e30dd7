"""Merkle manifest of a dataset by slot pivot.

Every row is a leaf; a tree per group (language) joins runs of ``FANOUT`` consecutive nodes, and the groups' subroots are
the leaves of one more tree. A level is one aggregate: conditional aggregates spread the children of a parent into
``FANOUT`` columns. All columns in a row hash to the parent, all but a child's own column are the siblings of its proof.

Upwards each level is an eighth of the one below. Downwards each parent hands its own path to its children, so a leaf
ends with all siblings up to the root, and a leaf is checked without any other row.

Defined results: null columns count as ``-`` in a leaf; null is a language of its own, the first; a null ``doc_id`` sorts
first and is never among the tampered ones; rows of one id follow in the order of their leaves, equal rows in any order;
an empty table has no rows and no root.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import settled
from .lines import in_line

FANOUT = 8
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def field(value: Column) -> Column:
    """Self-delimiting form of one value: ``-`` for null, else its UTF-8 byte count, a colon and itself."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*values: Column) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def slots(name: str, fanout: int) -> list[Column]:
    return [F.col(f"{name}_{k}") for k in range(fanout)]


def spread(nodes: DataFrame, carry: list[str], fanout: int) -> DataFrame:
    """One row per parent: ``tree, parent, members`` and a column per slot for ``node`` and each carried column."""
    slot = F.pmod("place", F.lit(fanout))
    columns = [F.max(F.when(slot == k, F.col(c))).alias(f"{c}_{k}") for c in ["node", *carry] for k in range(fanout)]
    return nodes.groupBy("tree", F.expr(f"place div {fanout}").alias("parent")).agg(F.max("members").alias("members"), *columns)


def climb(nodes: DataFrame, carry: list[str], name: str, fanout: int = FANOUT) -> tuple[list[DataFrame], DataFrame]:
    """All levels from the leaves up, as written pivots, and ``tree, node`` of the tops.

    ``nodes`` has ``tree, place, members, node``. A tree of one node is its own top; in trees that are lower than the
    highest one the top is passed on unchanged.
    """
    most = nodes.agg(F.max("members")).first()[0] or 0
    levels = []
    while True:
        level = settled(spread(nodes, carry, fanout), f"{name}-level")
        levels.append(level)
        joined = F.when(F.col("members") == 1, F.col("node_0")).otherwise(F.sha2(F.concat_ws("", *slots("node", fanout)), 256))
        nodes = level.select(
            "tree", F.col("parent").alias("place"), F.expr(f"(members + {fanout - 1}) div {fanout}").alias("members"), joined.alias("node"),
        )
        carry = []
        most = -(-most // fanout)
        if most <= 1:
            return levels, nodes.select("tree", "node")


def descend(levels: list[DataFrame], tops: DataFrame, carry: list[str], handed: list[str], fanout: int = FANOUT) -> DataFrame:
    """``tree, place, node, path`` and the carried columns of every leaf; ``tops`` has ``tree, path`` and what is handed down.

    ``path`` lists the siblings left and right of the leaf, then of its parent, and so on to the end of the top's path.
    """
    above = tops.select(F.col("tree").alias("of_tree"), F.lit(0).cast("long").alias("of_place"), "path", *handed)
    for depth, level in enumerate(reversed(levels)):
        kept = carry if depth + 1 == len(levels) else []
        node = slots("node", fanout)
        children = F.array(*[
            F.struct(
                F.lit(k).alias("slot"), node[k].alias("node"),
                F.concat_ws("", *node[:k]).alias("left"), F.concat_ws("", *node[k + 1:]).alias("right"),
                *[F.col(f"{c}_{k}").alias(c) for c in kept],
            )
            for k in range(fanout)
        ])
        met = level.join(above, F.col("tree").eqNullSafe(F.col("of_tree")) & (F.col("parent") == F.col("of_place")))
        child = met.select("tree", "parent", "members", "path", *handed, F.explode(children).alias("child")).filter("child.node IS NOT NULL")
        own = F.array(F.struct(F.col("child.left").alias("left"), F.col("child.right").alias("right")))
        leaves = child.select(
            "tree", (F.col("parent") * fanout + F.col("child.slot")).alias("place"), F.col("child.node").alias("node"),
            F.when(F.col("members") == 1, F.col("path")).otherwise(F.concat(own, F.col("path"))).alias("path"),
            *handed, *[F.col(f"child.{c}").alias(c) for c in kept],
        )
        above = leaves.select(F.col("tree").alias("of_tree"), F.col("place").alias("of_place"), "path", *handed)
    return leaves


def fold(leaf: Column, path: Column) -> Column:
    """The root that ``leaf`` and its siblings give."""
    return F.aggregate(path, leaf, lambda node, step: F.sha2(F.concat(step["left"], node, step["right"]), 256))


def path_digest(path: Column) -> Column:
    """One hash of all siblings of a path, level by level, left to right."""
    return F.sha2(F.concat_ws("", F.transform(path, lambda step: F.concat(step["left"], step["right"]))), 256)


def merkle_proofs(leaves: DataFrame, carry: list[str], fanout: int = FANOUT) -> DataFrame:
    """``tree, place, leaf, subroot, root, path`` and the carried columns for rows ``tree, rank, leaf`` (and those).

    Leaves of a tree ascend by ``rank``, then by ``leaf``; trees ascend by name, null first.
    """
    leaves = settled(leaves.withColumn("row", F.monotonically_increasing_id()), "merkle-leaves")
    placed = in_line(leaves, ["tree"], ["rank", "leaf", "row"], "merkle-line").withColumnRenamed("leaf", "node")
    levels, tops = climb(placed, carry, "merkle", fanout)
    tops = settled(tops.withColumnRenamed("tree", "name"), "merkle-tops")
    upper = in_line(tops.withColumn("tree", F.lit("")), [], ["name"], "merkle-trees")
    high, top = climb(upper, ["name"], "merkle-top", fanout)
    root = top.first()  # one digest
    start = top.select("tree", F.array().cast("array<struct<left:string,right:string>>").alias("path"))
    roots = descend(high, start, ["name"], [], fanout).select(F.col("name").alias("tree"), F.col("node").alias("subroot"), "path")
    return descend(levels, roots, carry, ["subroot"], fanout).select(
        "tree", "place", F.col("node").alias("leaf"), "subroot", F.lit(root["node"] if root else None).cast("string").alias("root"),
        "path", *carry,
    )


def dataset_manifest(docs: DataFrame) -> DataFrame:
    """A leaf, subroot, root and proof per document, and what a tampered text (A-Z lower-cased) makes of the root.

    Every third document (by CRC of its id) is tampered with; the others check their original leaf.
    """
    doc_id, source, lang, n_chars, text = (F.col(c) for c in LEAF_COLUMNS)
    touched = F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3)) == 0
    leaves = docs.select(
        doc_id.cast("long").alias("rank"), lang.cast("string").alias("tree"),
        leaf_digest(doc_id, source, lang, n_chars, text).alias("leaf"),
        F.when(touched, leaf_digest(doc_id, source, lang, n_chars, F.translate(text, UPPER, LOWER))).alias("changed"),
    )
    proofs = merkle_proofs(leaves, ["rank", "changed"])
    folded = fold(F.coalesce("changed", "leaf"), F.col("path"))
    out = proofs.select(
        F.col("rank").alias("doc_id"), "leaf", "subroot", "root", path_digest(F.col("path")).alias("proof_sha256"), folded.alias("folded_root"),
    )
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
