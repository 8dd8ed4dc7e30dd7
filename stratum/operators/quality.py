"""Data-quality checks, each one pass over the table.

Checks return small result frames; only :func:`require` raises.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.casting import long_counts
from ..functions.text import PII_PATTERNS

# fixed values: share of null foreign keys (percent) that is still fine / still acceptable
FK_WARN_PCT, FK_FAIL_PCT = 1.0, 5.0


@dataclass(frozen=True)
class Rule:
    """``failing`` is true on a bad row; ``where`` limits the rows the rule speaks about."""

    name: str
    failing: Column
    severity: str = "warn"
    where: Column | None = None


def required(columns: Iterable[str], severity: str = "fail", where: Column | None = None) -> list[Rule]:
    """Null rules for columns that must be filled (for the rows in ``where``)."""
    return [Rule(f"{c}_null", F.col(c).isNull(), severity, where) for c in columns]


def run_rules(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(rule, severity, checked, failed, pct) for all rules in a single aggregate."""
    counters = []
    for i, rule in enumerate(rules):
        scope = F.lit(True) if rule.where is None else F.coalesce(rule.where, F.lit(False))
        counters += [
            F.count_if(scope).alias(f"c{i}"),
            F.count_if(scope & F.coalesce(rule.failing, F.lit(False))).alias(f"f{i}"),
        ]
    lines = F.array(*[
        F.struct(
            F.lit(rule.name).alias("rule"), F.lit(rule.severity).alias("severity"),
            F.col(f"c{i}").alias("checked"), F.col(f"f{i}").alias("failed"),
            F.when(F.col(f"c{i}") > 0, F.col(f"f{i}") * 100.0 / F.col(f"c{i}")).otherwise(0.0).alias("pct"),
        )
        for i, rule in enumerate(rules)
    ])
    return df.agg(*counters).select(F.inline(lines))


def require(results: DataFrame, severity: str = "fail") -> None:
    """Raise when a rule of the given severity failed (the result has one row per rule)."""
    bad = [r["rule"] for r in results.filter((F.col("severity") == severity) & (F.col("failed") > 0)).collect()]
    if bad:
        raise ValueError(f"failed checks: {', '.join(sorted(bad))}")


def fk_coverage(df: DataFrame, keys: Sequence[str], warn: float = FK_WARN_PCT, fail: float = FK_FAIL_PCT) -> DataFrame:
    """Null share per foreign key with a verdict: ok, warn or fail."""
    out = run_rules(df, [Rule(k, F.col(k).isNull()) for k in keys])
    verdict = F.when(F.col("pct") < warn, "ok").when(F.col("pct") < fail, "warn").otherwise("fail")
    return out.select(F.col("rule").alias("foreign_key"), "checked", F.col("failed").alias("nulls"), "pct", verdict.alias("verdict"))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: how many key values repeat, and how many rows they hold."""
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return groups.agg(F.count(F.lit(1)).alias("repeated_keys"), F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"))


def outside_domain(df: DataFrame, column: str, allowed: Sequence[str]) -> DataFrame:
    """Values outside a fixed domain, with their counts."""
    return (
        df.filter(F.col(column).isNotNull() & ~F.col(column).isin(list(allowed)))
        .groupBy(column).agg(F.count(F.lit(1)).alias("row_count"))
    )


def bridge_checks(bridge: DataFrame, group: str, member: str, is_primary: Column) -> DataFrame:
    """Null keys, groups without and with several primary members, in one result row."""
    per_group = bridge.groupBy(group).agg(
        F.count_if(F.coalesce(is_primary, F.lit(False))).alias("primaries"),
        F.count_if(F.col(member).isNull()).alias("null_members"), F.count(F.lit(1)).alias("members"),
    )
    return per_group.agg(
        F.coalesce(F.sum("null_members"), F.lit(0)).alias("null_members"),
        F.coalesce(F.sum(F.when(F.col(group).isNull(), F.col("members"))), F.lit(0)).alias("null_groups"),
        F.count_if(F.col("primaries") == 0).alias("no_primary"),
        F.count_if(F.col("primaries") > 1).alias("several_primaries"),
    )


def date_sanity(df: DataFrame, columns: Sequence[str], today: Column) -> DataFrame:
    """Earliest, latest and future-dated values per date column."""
    aggs = [
        a for i, c in enumerate(columns)
        for a in (
            F.min(F.col(c).cast("date")).alias(f"lo{i}"), F.max(F.col(c).cast("date")).alias(f"hi{i}"),
            F.count_if(F.col(c).cast("date") > today).alias(f"fu{i}"),
        )
    ]
    lines = F.array(*[
        F.struct(
            F.lit(c).alias("column_name"), F.col(f"lo{i}").alias("earliest"), F.col(f"hi{i}").alias("latest"),
            F.col(f"fu{i}").alias("future_dated"),
        )
        for i, c in enumerate(columns)
    ])
    return df.agg(*aggs).select(F.inline(lines))


def date_profile(df: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    """Rows per year and month of every date column (null dates included), one pass for all columns."""
    days = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("date").alias("day")) for c in columns])
    return (
        df.select(F.inline(days))
        .groupBy("column_name", F.year("day").alias("year"), F.month("day").alias("month"))
        .agg(F.count(F.lit(1)).alias("row_count"))
        .withColumn("table_name", F.lit(name))
    )


def text_lengths(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Null count and shortest, longest and mean length per text column."""
    aggs = [
        a for i, c in enumerate(columns)
        for a in (
            F.count_if(F.col(c).isNull()).alias(f"n{i}"), F.min(F.length(c)).alias(f"lo{i}"),
            F.max(F.length(c)).alias(f"hi{i}"), F.avg(F.length(c)).alias(f"av{i}"),
        )
    ]
    lines = F.array(*[
        F.struct(
            F.lit(c).alias("column_name"), F.col(f"n{i}").alias("nulls"), F.col(f"lo{i}").alias("min_length"),
            F.col(f"hi{i}").alias("max_length"), F.col(f"av{i}").alias("avg_length"),
        )
        for i, c in enumerate(columns)
    ])
    return df.agg(*aggs).select(F.inline(lines))


def pii_flags(column: str) -> dict[str, Column]:
    """One boolean per kind of personal data found in a free text column."""
    return {f"has_{name}": F.col(column).rlike(pattern) for name, pattern in PII_PATTERNS.items()}


def pii_rows(df: DataFrame, column: str, keep: Sequence[str]) -> DataFrame:
    """The rows whose text leaks personal data, with the kinds found."""
    flags = pii_flags(column)
    flagged = df.select(*keep, *[f.alias(n) for n, f in flags.items()])
    return flagged.filter(F.greatest(*[F.col(n) for n in flags]))


def ratios(df: DataFrame, conditions: Mapping[str, Column]) -> DataFrame:
    """Share of rows (0..1) on which each condition holds, in one row."""
    total = F.count(F.lit(1))
    return df.agg(*[
        F.try_divide(F.count_if(F.coalesce(c, F.lit(False))), total).alias(n) for n, c in conditions.items()
    ])


def lineage(df: DataFrame) -> DataFrame:
    """Distinct batches and commits, first and last ingest time of a bronze table."""
    return df.agg(
        F.count_distinct("_batch_id").alias("batches"), F.count_distinct("_commit_sha").alias("commits"),
        F.min("_ingest_timestamp").alias("first_ingest"), F.max("_ingest_timestamp").alias("last_ingest"),
    )


def run_summary(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows in, rows out and rows removed by a step."""
    both = before.select(F.lit(1).alias("i"), F.lit(0).alias("o")).unionByName(
        after.select(F.lit(0).alias("i"), F.lit(1).alias("o"))
    )
    return both.agg(
        F.coalesce(F.sum("i"), F.lit(0)).alias("rows_in"), F.coalesce(F.sum("o"), F.lit(0)).alias("rows_out")
    ).withColumn("rows_removed", F.col("rows_in") - F.col("rows_out"))


def calendar_checks(dates: DataFrame) -> DataFrame:
    """Weekend share, quarter and month-end counts of a date dimension."""
    return dates.agg(
        F.count(F.lit(1)).alias("days"), F.count_if("is_weekend").alias("weekend_days"),
        (F.count_if("is_weekend") * 100.0 / F.count(F.lit(1))).alias("weekend_pct"),
        F.count_if("is_month_end").alias("month_ends"), F.count_if("is_quarter_end").alias("quarter_ends"),
    )


def failed_counts(df: DataFrame, conditions: Mapping[str, Column]) -> DataFrame:
    """(check, failed) rows for named violation predicates."""
    one = df.agg(*[F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in conditions.items()])
    return long_counts(one, conditions, "check_name", "failed")
