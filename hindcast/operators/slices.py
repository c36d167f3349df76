"""Time slices of keys with very many rows, so that no key's history is one task.

A key with more than `hot` rows is cut at quantiles of its first order column, from a mergeable
sketch; rows of one instant stay together.  Work is then done per key and slice, and what
a slice needs of those before it (a total, a last row) is carried over from one summary row a
slice.  Keys with fewer rows are one slice, and their work is what it was.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows from which a key is cut, and pieces it is cut into.
HOT, PIECES = 1_000_000, 64
SLICE = "__slice"


def _same(keys: Sequence[str], prefix: str) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"{prefix}{k}")) for k in keys])


def cuts(rows: DataFrame, by: Sequence[str], at: str, hot: int = HOT, pieces: int = PIECES) -> DataFrame:
    """(__by..., __cuts) of keys with more than hot rows: where their slices begin."""
    shares = [k / pieces for k in range(1, pieces)]
    found = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("__rows"), F.percentile_approx(at, shares, 100 * pieces).alias("__cuts"))
    # No more rows than all rows divided by hot.
    return found.where(F.col("__rows") > hot).select(*[F.col(k).alias(f"__{k}") for k in by], F.array_distinct("__cuts").alias("__cuts"))


def sliced(rows: DataFrame, by: Sequence[str], at: str, found: DataFrame) -> DataFrame:
    """rows with the number of their slice; a row without a place in time is in the first."""
    number = F.size(F.filter("__cuts", lambda c: c <= F.col(at)))
    out = rows.join(found, _same(by, "__"), "left").withColumn(SLICE, F.when(F.col("__cuts").isNull(), 0).otherwise(number))
    return out.drop("__cuts", *[f"__{k}" for k in by])


def carried(summary: DataFrame, by: Sequence[str], cols: dict[str, Column]) -> DataFrame:
    """summary (by, slice, ...), a row per slice, as (__by, __slice of by, cols): each col over all earlier slices of the key."""
    before = Window.partitionBy(*by).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    return summary.select(*[F.col(k).alias(f"__{k}") for k in by], F.col(SLICE).alias("__at"), *[c.over(before).alias(n) for n, c in cols.items()])


def with_carried(rows: DataFrame, carry: DataFrame, by: Sequence[str]) -> DataFrame:
    """rows with what is carried into their slice; first slices, most rows of most keys, need nothing and meet nothing."""
    return rows.join(carry.where("__at > 0"), _same(by, "__") & (F.col(SLICE) == F.col("__at")), "left").drop("__at", *[f"__{k}" for k in by])
