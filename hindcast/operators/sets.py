"""Set operations on tables of one shape."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_captures(dfs: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def target_minus_captured(targets: DataFrame, captured: DataFrame) -> DataFrame:
    return targets.subtract(captured)


def common_keys(dfs: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.intersect, dfs)


def split_overlap(a: DataFrame, b: DataFrame, key: str = "game_id") -> DataFrame:
    return a.select(key).intersect(b.select(key))


def rows_changed(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows only in a ('removed') or only in b ('added'), as often as they differ in number."""
    return a.exceptAll(b).withColumn("change", F.lit("removed")).unionByName(b.exceptAll(a).withColumn("change", F.lit("added")))
