"""Shared pieces: Arrow batches in tasks, narrow joins that survive hot keys, one-row scalars."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import durable

#: Bytes of text that one vectorised step looks at; a longer document is a step of its own.
STEP_BYTES = 2 << 20


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def lower_ascii(text: str) -> str:
    """Lower-case A-Z only; other letters keep their case."""
    return text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def map_batches(df: DataFrame, step: Callable[[pa.RecordBatch], pa.RecordBatch | Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``step`` on every Arrow batch of ``df``; one task, one pass, no state beyond the closure."""

    def run(batches):
        for batch in batches:
            out = step(batch)
            if isinstance(out, pa.RecordBatch):
                yield out
            else:
                yield from out

    return df.mapInArrow(run, schema)


def byte_steps(sizes: Sequence[int], limit: int = STEP_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges of about ``limit`` bytes; every row is in exactly one."""
    ends = np.cumsum(np.asarray(sizes, dtype=np.int64))
    start, done = 0, 0
    while start < len(ends):
        stop = max(start + 1, int(np.searchsorted(ends, done + limit, side="right")))
        yield start, stop
        start, done = stop, int(ends[stop - 1])


def same_key(left: str, right: str, tag: str) -> Column:
    """Equality in the form that lets AQE split a hot key: the join asks for a shuffle of its own on both sides.

    The second, always true condition keeps the join from reusing the partitioning that an aggregate or window
    below left behind; ``tag`` keeps two joins on one key apart.
    """
    anchor = [F.pmod(F.xxhash64(F.col(c), F.lit(tag)), F.lit(1)) for c in (left, right)]
    return (F.col(left) == F.col(right)) & (anchor[0] == anchor[1])


def unused(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def settled(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: a lineage cut that outlives lost executors."""
    return durable(df, f"llm-{name}")
