"""Latest-per-key selection and exact-duplicate removal.

``row_number() == 1`` is planned with a group limit on both sides of the shuffle, so each map task sends at
most one row per key: a key that holds a third of the table reaches its reducer as one row per task.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def row_tiebreak(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """A hash of the row (or of some columns); makes any order total up to rows that are identical in them."""
    return F.xxhash64(*[F.col(f"`{c}`") for c in (df.columns if columns is None else columns)])


def latest_by(df: DataFrame, keys: Sequence[str], order: Iterable[Column | str], tie: Sequence[str] | None = None) -> DataFrame:
    """One row per key, the first under ``order`` (null keys form a group of their own).

    Ties go to the smallest hash of the row, for which every column is read. ``tie`` names the columns to hash instead;
    with an empty ``tie`` the order is taken as total and nothing else is read.
    """
    order = [F.col(c).desc_nulls_last() if isinstance(c, str) else c for c in order]
    if tie is None or tie:
        # taken before the shuffle: columns that only the hash reads are not shuffled and sorted
        df, order = df.withColumn("__tie", row_tiebreak(df, tie)), [*order, F.col("__tie")]
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rank", F.row_number().over(window)).filter("__rank = 1").drop("__rank", "__tie")


def drop_copies(
    df: DataFrame, subset: Sequence[str], order: Iterable[Column | str] = (), digest: bool = False
) -> DataFrame:
    """Remove rows equal on ``subset``; the survivor is the first under ``order``, not an arbitrary one.

    ``digest`` compares SHA-256 digests: sort and shuffle then move 64 characters instead of long texts as keys.
    """
    if not digest:
        return latest_by(df, subset, order)
    keyed = df.withColumn("__digest", F.sha2(F.to_json(F.struct(*subset)), 256))
    return latest_by(keyed, ["__digest"], order).drop("__digest")
