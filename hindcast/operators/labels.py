"""Labels and their states."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hindcast.functions.scalars import horizon_end
from hindcast.operators.aggregates import collapse_pa
from hindcast.operators.gates import finals_only, map_outcome, valid_location


def label_game(games: DataFrame) -> DataFrame:
    """Official results only: 'H', 'D' or 'A' beside the runs."""
    d = F.col("home_runs") - F.col("away_runs")
    return finals_only(games).withColumn("cls", F.when(d > 0, "H").when(d == 0, "D").otherwise("A"))


def label_pa(pitches: DataFrame, mapping: DataFrame, keys: Sequence[str], order: Column) -> DataFrame:
    """The class of each plate appearance's settled result; mapping has (result, cls)."""
    return map_outcome(collapse_pa(pitches, keys, order, [], "result"), mapping, "result")


def label_pitch(pitches: DataFrame, keys: Sequence[str], kind: str, result: str, x: str, z: str) -> DataFrame:
    return valid_location(pitches, x, z).select(*keys, kind, result, x, z, "valid")


def label_state(panel: DataFrame, sums: DataFrame, complete: DataFrame, key: Sequence[str], value: str, as_of: Column, season_end: Column, days: int) -> DataFrame:
    """Adds state and value to (key..., anchor) rows; complete has (anchor, is_complete).

    In this order: out of scope (the season was over at the anchor), undetermined
    (the horizon isn't over), unobserved (over but not complete), confirmed zero
    (complete without a row, or a sum of zero), confirmed.  The value is null
    unless it is confirmed.
    """
    rows = panel.join(sums.select(*key, F.col(value).alias("__sum")), list(key), "left").join(complete, "anchor", "left")
    state = (F.when(F.col("anchor") >= season_end, "out of scope")
             .when(horizon_end(F.col("anchor"), days) > as_of, "undetermined")
             .when(~F.coalesce("is_complete", F.lit(False)), "unobserved")
             .when(F.coalesce("__sum", F.lit(0)) == 0, "confirmed zero").otherwise("confirmed"))
    rows = rows.withColumn("state", state)
    return rows.withColumn(value, F.when(F.col("state").startswith("confirmed"), F.coalesce("__sum", F.lit(0)).cast("long"))).drop("__sum", "is_complete")


def horizon_complete(manifest: DataFrame, days: int, date: str, ok: str) -> DataFrame:
    """(anchor, expected, is_complete): whether all targets of [anchor, anchor + days) are captured and corrected."""
    from hindcast.operators.joins import horizon_rows

    return horizon_rows(manifest, date, days).groupBy("anchor").agg(F.count(F.lit(1)).alias("expected"), F.bool_and(ok).alias("is_complete"))


def train_eligible(labels: DataFrame, as_of: Column, label_end: str = "label_end", available: str = "available_at") -> DataFrame:
    """Labels that had ended and were available at the logical training time; unknown availability is no."""
    return labels.where((F.col(label_end) <= as_of) & F.col(available).isNotNull() & (F.col(available) <= as_of))


def partial_mask(labels: DataFrame, key: Sequence[str], output: str, values: Sequence[str], mode: str) -> DataFrame:
    """Long labels (key, output, y) to a row per key: 'mask' keeps nulls, 'complete' keeps full rows only."""
    wide = labels.groupBy(*key).pivot(output, list(values)).agg(F.max("y"))
    return wide if mode == "mask" else wide.dropna(subset=list(values))


def overlap_report(labels: DataFrame, key: Sequence[str], days: int) -> DataFrame:
    """Per key how many pairs of its anchors have horizons that overlap: each pairs with the Mondays less than days before."""
    a = labels.select(*key, "anchor").distinct()
    near = a.select(*key, F.explode(F.array(*[F.date_add("anchor", 7 * k) for k in range(1, -(-days // 7))])).alias("anchor")) if days > 7 else a.where("false")
    pairs = near.join(a, [*key, "anchor"]).groupBy(*key).agg(F.count(F.lit(1)).alias("pairs"))
    return a.groupBy(*key).agg(F.count(F.lit(1)).alias("anchors")).join(pairs, list(key), "left").withColumn("pairs", F.coalesce("pairs", F.lit(0)))
