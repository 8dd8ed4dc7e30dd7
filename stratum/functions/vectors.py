"""Dense vectors held as ``array<float>`` or ``array<double>``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def dot(a: Column | str, b: Column | str) -> Column:
    products = F.zip_with(_c(a), _c(b), lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def norm(a: Column | str) -> Column:
    return F.sqrt(dot(a, a))


def unit(a: Column | str, eps: float = 1e-9) -> Column:
    """L2-normalised copy; ``eps`` keeps a zero vector finite."""
    size = norm(a) + eps
    return F.transform(_c(a), lambda x: x.cast("double") / size)
