"""Positions, neighbours and global ranks that never pull a whole group into one task.

Two tools share one idea: cut the ordered rows into chunks, number the rows inside each chunk, and carry
only one summary row per chunk across chunk borders.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, MapType, NumericType, TimestampNTZType, TimestampType

from ..session import durable


CHUNK_UNITS = ("day", "week", "month", "quarter", "year")


#: Ids per chunk among rows of one key whose leading order column is null.
NULL_SPAN = 10_000


def chunk_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], chunk: Column) -> Column:
    """Key and chunk of a row. Where ``chunk`` is null the order columns after the first decide: their values up to the first
    number (a span of it) or time (its day).

    Like ``chunk`` itself this never decreases along the order, so a key whose dates are all missing spreads as well.
    """
    tail = []
    for name in order[1:]:
        kind, value = df.schema[name].dataType, F.col(name)
        if isinstance(kind, NumericType):
            tail.append(F.floor(value / NULL_SPAN))
            break
        if isinstance(kind, (TimestampType, TimestampNTZType, DateType)):
            tail.append(F.to_date(value))
            break
        tail.append(value)
    rest = F.when(chunk.isNull(), F.struct(*[c.alias(f"t{i}") for i, c in enumerate(tail)])) if tail else F.lit(None).cast("int")
    return F.struct(*keys, chunk.alias("__chunk"), rest.alias("__tail"))


def with_neighbours(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    chunk: Column,
    position: str | None = None,
    lags: Mapping[str, str] | None = None,
    leads: Mapping[str, str] | None = None,
) -> DataFrame:
    """Row number, previous and next values per key under the ascending, total ``order``.

    ``chunk`` must never decrease along ``order`` (the day of an event time, say); choose it fine enough for
    the rows of one key in one chunk to fit a task. The result equals ``row_number``/``lag``/``lead`` over the
    whole key. The input is read and shuffled once, by key and chunk, and written with what its chunk alone tells; then
    the first and last row of every chunk meet those of the chunks before and after, like the carry of a prefix scan.
    """
    lags, leads = dict(lags or {}), dict(leads or {})
    wanted = list(dict.fromkeys([*lags.values(), *leads.values()]))
    rows = Window.partitionBy("__g").orderBy(*order)
    # a struct tells "no neighbour in this chunk" (null) from "neighbour with a null value"
    detail = {
        "__pos": F.row_number().over(rows),
        "__n": F.count(F.lit(1)).over(Window.partitionBy("__g")),
        **{f"__lag_{out}": F.lag(F.struct(F.col(src).alias("v"))).over(rows) for out, src in lags.items()},
        **{f"__lead_{out}": F.lead(F.struct(F.col(src).alias("v"))).over(rows) for out, src in leads.items()},
    }
    local = durable(df.withColumn("__g", chunk_key(df, keys, order, chunk)).withColumns(detail), "chunks")

    first = F.col("__pos") == 1
    borders = local.filter(first | (F.col("__pos") == F.col("__n"))).select(
        "__g", "__pos", "__n", F.struct(*[F.col(c) for c in wanted], F.lit(1).alias("__there")).alias("__v"),
    )
    along = Window.partitionBy(*[f"__g.{k}" for k in keys]).orderBy("__g.__chunk", "__g.__tail", "__pos")
    size = F.sum(F.when(first, F.col("__n"))).over(along.rowsBetween(Window.unboundedPreceding, -1))
    after = F.when(F.col("__n") == 1, F.lead("__v", 1).over(along)).otherwise(F.lead("__v", 2).over(along))
    heads = borders.select(
        F.col("__g").alias("__h"), "__pos", F.coalesce(size, F.lit(0)).alias("__before"),
        F.lag("__v").over(along).alias("__prev"), after.alias("__next"),
    ).filter(first).drop("__pos")
    joined = local.join(heads, F.col("__g") == F.col("__h"), "left")
    out = {}
    if position:
        out[position] = (F.col("__before") + F.col("__pos")).cast("int")
    for name, src in lags.items():
        own = F.col(f"__lag_{name}")
        out[name] = F.when(own.isNotNull(), own["v"]).otherwise(F.col("__prev")[src])
    for name, src in leads.items():
        own = F.col(f"__lead_{name}")
        out[name] = F.when(own.isNotNull(), own["v"]).otherwise(F.col("__next")[src])
    return joined.withColumns(out).select(*df.columns, *out)


def asof_join(
    left: DataFrame,
    right: DataFrame,
    on: str,
    left_at: str,
    right_at: str,
    columns: Sequence[str],
    unit: str = "month",
) -> DataFrame:
    """Attach ``columns`` of the last ``right`` row of the key whose date is not after the left row's date.

    Both sides become one ordered stream and values are carried forward, inside calendar chunks and then from
    chunk to chunk; no pairs are formed, so a key that is hot on both sides costs its rows, not their product.
    ``right`` holds one row per key and date. The left row count is preserved. ``unit`` is the length of a chunk. Rows
    without key or date match nothing: on the right they are left out, on the left a row hash spreads them.
    """
    if unit not in CHUNK_UNITS:
        raise ValueError(f"unit must be one of {', '.join(CHUNK_UNITS)}")
    values = right.select(
        F.col(on).alias("__k"), F.col(right_at).cast("date").alias("__at"), F.lit(0).alias("__side"),
        F.struct(*columns).alias("__val"),
    ).filter("__k IS NOT NULL AND __at IS NOT NULL")
    known = F.col("__k").isNotNull() & F.col("__at").isNotNull()
    spread = F.xxhash64(*[F.col(f"`{c}`") for c in left.columns if not isinstance(left.schema[c].dataType, MapType)])
    rows = left.select(
        F.col(on).alias("__k"), F.col(left_at).cast("date").alias("__at"), F.lit(1).alias("__side"),
        F.struct(*left.columns).alias("__row"), spread.alias("__spread"),
    )
    both = values.unionByName(rows, allowMissingColumns=True)
    day = F.col("__at") if unit == "day" else F.trunc("__at", unit)
    both = both.withColumn("__g", F.struct("__k", day.alias("__chunk"), F.when(~known, F.col("__spread")).alias("__spread"))).drop("__spread")
    inside = Window.partitionBy("__g").orderBy("__at", "__side")
    local = both.withColumns({
        "__here": F.last("__val", ignorenulls=True).over(inside.rowsBetween(Window.unboundedPreceding, 0)),
        "__end": F.lead(F.lit(1)).over(inside).isNull(),
    })
    local = durable(local.select("__g", "__side", "__row", "__here", "__end"), "chunks")
    # the last row of a chunk holds the newest value that the chunk has
    earlier = Window.partitionBy("__g.__k").orderBy("__g.__chunk").rowsBetween(Window.unboundedPreceding, -1)
    ends = local.filter(F.col("__end") & F.col("__g.__k").isNotNull() & F.col("__g.__chunk").isNotNull())
    carry = ends.select(F.col("__g").alias("__h"), F.last("__here", ignorenulls=True).over(earlier).alias("__carry"))
    found = F.coalesce("__here", "__carry").alias("__found")
    return local.filter("__side = 1").join(carry, F.col("__g") == F.col("__h"), "left").select("__row", found).select(
        "__row.*", *[F.col(f"__found.{c}").alias(c) for c in columns]
    )


def pick_ranks(
    df: DataFrame,
    group: str,
    order: Sequence[str],
    ranks: Callable[[Column], Column],
    weight: str | None = None,
) -> DataFrame:
    """The rows at given ranks of each group: (group, ``wanted_rank``, order columns).

    ``ranks(n)`` maps a group's size to an array of 1-based ranks. ``order`` must be unique within a group;
    ``weight`` says how many equal rows a row stands for. Rows are range partitioned by (group, order), so a
    hot group spreads over many tasks; the partition id is stored before it is used. Only the chunks that
    hold a wanted rank are sorted again.
    """
    narrow = df.select(group, *order, (F.col(weight) if weight else F.lit(1)).cast("bigint").alias("__w"))
    ranged = durable(
        narrow.repartitionByRange(group, *order).withColumn("__chunk", F.spark_partition_id()), "ranks"
    )
    per_chunk = ranged.groupBy(group, "__chunk").agg(F.sum("__w").alias("__n"))
    by_group = Window.partitionBy(group)  # one row per chunk: bounded by the number of partitions
    earlier = by_group.orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    spans = per_chunk.select(
        F.col(group).alias("__grp"), F.col("__chunk").alias("__c"), "__n",
        F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"),
        F.sum("__n").over(by_group).alias("__total"),
    )
    inside = F.filter(
        F.array_distinct(ranks(F.col("__total"))),
        lambda r: (r > F.col("__before")) & (r <= F.col("__before") + F.col("__n")),
    )
    hits = spans.withColumn("__want", inside).filter(F.size("__want") > 0)
    touched = ranged.join(
        hits, F.col(group).eqNullSafe(F.col("__grp")) & (F.col("__chunk") == F.col("__c")), "inner"
    )
    upto = Window.partitionBy(group, "__chunk").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    placed = touched.withColumn("__to", F.col("__before") + F.sum("__w").over(upto))
    mine = F.filter("__want", lambda r: (r > F.col("__to") - F.col("__w")) & (r <= F.col("__to")))
    return placed.select(group, F.explode(mine).alias("wanted_rank"), *order)


def _tile_ends(tiles: int) -> Callable[[Column], Column]:
    """Last rank of every tile but the last; the first ``n % tiles`` tiles get one row more."""

    def ends(n: Column) -> Column:
        size, extra = F.floor(n / tiles), n % tiles
        return F.array(*[
            (size * t + F.least(F.lit(t), extra)).cast("bigint") for t in range(1, tiles)
        ])

    return ends


def with_tiles(df: DataFrame, metrics: Mapping[str, str], tie: str, tiles: int = 4) -> DataFrame:
    """Exact ``ntile(tiles)`` over the whole table for several metrics (output name -> metric column).

    Ascending, nulls first, ties by the unique column ``tie``. All metrics go through one narrow range
    partitioning; only ``tiles - 1`` border rows per metric come back to the driver, and tagging the wide rows
    is then a plain comparison without a shuffle.
    """
    outs = list(metrics)
    long = df.select(
        F.inline(F.array(*[
            F.struct(F.lit(i).alias("metric"), F.col(metrics[o]).cast("double").alias("value"), F.col(tie).alias("tie"))
            for i, o in enumerate(outs)
        ]))
    )
    sizes = _tile_ends(tiles)
    borders: dict[int, list] = {i: [] for i in range(len(outs))}
    for row in pick_ranks(long, "metric", ["value", "tie"], sizes).collect():  # at most (tiles - 1) rows per metric
        borders[row["metric"]].append(row)
    tagged = {}
    for i, out in enumerate(outs):
        here = F.struct(F.col(metrics[out]).cast("double").alias("value"), F.col(tie).alias("tie"))
        edges = [
            F.struct(F.lit(r["value"]).cast("double").alias("value"), F.lit(r["tie"]).cast(df.schema[tie].dataType).alias("tie"))
            for r in sorted(borders[i], key=lambda r: r["wanted_rank"])
        ]
        total = F.lit(1)
        for edge in edges:
            total = total + (here > edge).cast("int")
        tagged[out] = total
    return df.withColumns(tagged)


def exact_quantiles(df: DataFrame, group: str, value: str, probabilities: Sequence[float]) -> DataFrame:
    """Interpolated quantiles per group: columns ``group``, ``probability``, ``quantile``.

    Exact at any size and skew; use ``percentile_approx`` where an estimate will do.
    """
    # equal values collapse first, so a hot value is one row
    data = (
        df.filter(F.col(value).isNotNull())
        .groupBy(F.col(group), (F.col(value).cast("double") + 0.0).alias("__v"))
        .agg(F.count(F.lit(1)).alias("__copies"))
    )

    def ranks(n: Column) -> Column:
        places = [(n - 1) * p for p in probabilities]
        return F.array(*[(f(x) + 1).cast("bigint") for x in places for f in (F.floor, F.ceil)])

    picked = pick_ranks(data, group, ["__v"], ranks, weight="__copies")
    found = picked.groupBy(group).agg(F.map_from_entries(F.collect_set(F.struct("wanted_rank", "__v"))).alias("__at"))
    sizes = data.groupBy(F.col(group).alias("__grp")).agg(F.sum("__copies").alias("__n"))
    both = found.join(sizes, F.col(group).eqNullSafe(F.col("__grp")))
    parts = []
    for p in probabilities:
        place = (F.col("__n") - 1) * F.lit(float(p))
        low = F.element_at("__at", (F.floor(place) + 1).cast("bigint"))
        high = F.element_at("__at", (F.ceil(place) + 1).cast("bigint"))
        parts.append(F.struct(
            F.lit(float(p)).alias("probability"), (low + (high - low) * (place - F.floor(place))).alias("quantile")
        ))
    return both.select(group, F.inline(F.array(*parts)))
