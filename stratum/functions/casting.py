"""ANSI-safe typed columns.

Every cast is a ``try_`` cast: a value that does not parse becomes null instead of failing the job.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_CASE = {"lower": F.lower, "upper": F.upper, "trim": F.trim}
_WHOLE = {"int": "int", "integer": "int", "long": "bigint", "bigint": "bigint"}


def typed(column: Column | str, kind: str) -> Column:
    """One typed column from a short spec: ``"double"``, ``"string trim lower"``, ``"date"``."""
    c = F.col(column) if isinstance(column, str) else column
    kind, *steps = kind.split()
    if kind == "string":
        c = c.cast("string")
        for step in steps:
            c = _CASE[step](c)
        return c
    if kind in _WHOLE:
        # "12.0" is a whole number to a permissive reader; go through double when the direct cast fails
        target = _WHOLE[kind]
        return F.coalesce(c.try_cast(target), c.try_cast("double").try_cast(target))
    return c.try_cast(kind)


def project(df: DataFrame, spec: Mapping[str, str], keep: Iterable[str] = (), missing: str = "null") -> DataFrame:
    """Project onto ``spec`` (name -> kind) in one select, then the ``keep`` columns unchanged.

    ``missing="null"`` pads absent columns with typed nulls, ``"skip"`` leaves them out.
    """
    have = set(df.columns)
    out = []
    for name, kind in spec.items():
        if name in have:
            out.append(typed(name, kind).alias(name))
        elif missing == "null":
            out.append(F.lit(None).cast(kind.split()[0]).alias(name))
        elif missing != "skip":
            raise ValueError(f"column {name} is missing")
    return df.select(*out, *[c for c in keep if c in have and c not in spec])


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Project onto a declared schema: same names and types, unparsable values null, absent columns null."""
    return project(df, {f.name: f.dataType.simpleString() for f in schema})


def cast_failures(df: DataFrame, spec: Mapping[str, str]) -> DataFrame:
    """Per column, how many non-null inputs have no value of the wanted type (one pass)."""
    names = [c for c in spec if c in df.columns and not spec[c].startswith("string")]
    counts = df.agg(*[F.count_if(F.col(c).isNotNull() & typed(c, spec[c]).isNull()).alias(c) for c in names])
    return long_counts(counts, names, "column_name", "failed")


def long_counts(one_row: DataFrame, names: Iterable[str], key: str, value: str) -> DataFrame:
    """Turn a one-row frame of counters into (name, value) rows."""
    pairs = F.array(*[F.struct(F.lit(n).alias(key), F.col(f"`{n}`").cast("bigint").alias(value)) for n in names])
    return one_row.select(F.inline(pairs))


def parse_timestamp(column: Column | str, formats: Iterable[str]) -> Column:
    """First format that parses wins; no match is null."""
    c = F.col(column) if isinstance(column, str) else column
    return F.coalesce(*[F.try_to_timestamp(c, F.lit(f)) for f in formats])


def parse_date(column: Column | str, formats: Iterable[str]) -> Column:
    return F.to_date(parse_timestamp(column, formats))


def normalise_names(df: DataFrame) -> DataFrame:
    """Lower-case, trimmed column names."""
    return df.toDF(*[c.strip().lower() for c in df.columns])


def keep_existing(df: DataFrame, wanted: Iterable[str]) -> DataFrame:
    """Final column order, leaving out names the frame does not have."""
    return df.select(*[c for c in wanted if c in df.columns])


def flatten(df: DataFrame, parts: Mapping[str, Mapping[str, str]], redundant: Iterable[str] = ()) -> DataFrame:
    """Replace struct columns by flat ones.

    ``parts`` maps struct column -> {field: output name}. ``redundant`` flat copies go first, so an
    extracted field may reuse one of their names. A struct or field that is absent gives nulls.
    """
    slim = df.drop(*redundant)
    out = {}
    for struct, fields in parts.items():
        known = set()
        if struct in slim.columns and hasattr(slim.schema[struct].dataType, "names"):
            known = set(slim.schema[struct].dataType.names)
        for name, alias in fields.items():
            out[alias] = F.col(f"{struct}.{name}") if name in known else F.lit(None).cast("string")
    return slim.withColumns(out).drop(*parts)
