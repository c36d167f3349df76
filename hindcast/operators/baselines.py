"""Frequency baselines by prediction problem: thin compositions of the training-row aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hindcast.functions.sizes import few
from hindcast.operators.aggregates import base_rate, conditional_rate


def base_rate_forecast(train: DataFrame, targets: DataFrame, key: Sequence[str], y: str) -> DataFrame:
    """Every target with every class and its training frequency: (key..., cls, p)."""
    rates = base_rate(train, y).select(F.col(y).alias("cls"), "p")
    return targets.select(*key).crossJoin(few(rates))  # a row per class


def conditional_forecast(train: DataFrame, targets: DataFrame, key: Sequence[str], y: str, levels: Sequence[Sequence[str]], min_n: int, alpha: float) -> DataFrame:
    """Targets with the class frequencies of their condition; conditions that training lacks take the base rate."""
    rates = conditional_rate(train, y, levels, min_n, alpha).select(*levels[0], F.col(y).alias("cls"), "p")
    base = base_rate(train, y).select(F.col(y).alias("cls"), F.col("p").alias("base"))
    rows = targets.select(*key, *[c for c in levels[0] if c not in key]).crossJoin(few(base))  # a row per class
    return rows.join(rates, [*levels[0], "cls"], "left").select(*key, "cls", F.coalesce("p", "base").alias("p"))
