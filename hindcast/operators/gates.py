"""Input gates, filters and projections."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def gate_event_time(df: DataFrame, event_ts: str, ref_ts: Column) -> DataFrame:
    """Events strictly before the reference time."""
    return df.where(F.col(event_ts) < ref_ts)


def gate_available(df: DataFrame, avail_ts: str, ref_ts: Column) -> DataFrame:
    """Rows proven to be available by the reference time; missing evidence is no proof."""
    return df.where(F.col(avail_ts).isNotNull() & (F.col(avail_ts) <= ref_ts))


def gate_sequence(df: DataFrame, order_cols: Sequence[str], boundary: Sequence[Column]) -> DataFrame:
    """Rows whose order is strictly before the boundary; at one instant the sequence decides."""
    ours = F.struct(*[F.col(c).alias(f"c{k}") for k, c in enumerate(order_cols)])
    return df.where(ours < F.struct(*[b.alias(f"c{k}") for k, b in enumerate(boundary)]))


def gate_provenance(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows that name their source version."""
    for c in cols:
        df = df.where(F.col(c).isNotNull())
    return df


def gate_stacked(preds: DataFrame, ref_ts: Column, train_end: str = "train_end", generated_at: str = "generated_at") -> DataFrame:
    """Another predictor's outputs, if it was trained and had spoken before the cutoff."""
    return preds.where((F.col(train_end) < ref_ts) & (F.col(generated_at) < ref_ts))


def with_reason(df: DataFrame, rules: Sequence[tuple[str, Column]]) -> DataFrame:
    """Adds the first reason whose rule doesn't hold; a rule that is null doesn't hold."""
    reason = F.lit(None).cast("string")
    for name, ok in reversed(rules):
        reason = F.when(~F.coalesce(ok, F.lit(False)), name).otherwise(reason)
    return df.withColumn("reason", reason)


def split_reasons(df: DataFrame, rules: Sequence[tuple[str, Column]]) -> tuple[DataFrame, DataFrame]:
    """(admitted, rejected with its first failing reason)."""
    judged = with_reason(df, rules)
    return judged.where("reason is null").drop("reason"), judged.where("reason is not null")


def strip_current_event(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.drop(*cols)


def stage_filter(df: DataFrame, stage: str, column: str = "stage") -> DataFrame:
    return df.where(F.col(column) == stage)


def finals_only(games: DataFrame) -> DataFrame:
    return games.where("status = 'F'")


def actual_pitch_filter(df: DataFrame, is_pitch: Column) -> DataFrame:
    return df.withColumn("is_pitch", is_pitch).where("is_pitch")


def valid_location(df: DataFrame, x: str, z: str) -> DataFrame:
    """Adds a mask and the reason of what is missing; nothing is filled in."""
    reason = F.when(F.col(x).isNull() & F.col(z).isNull(), "no location").when(F.col(x).isNull(), f"no {x}").when(F.col(z).isNull(), f"no {z}")
    return df.withColumn("valid", reason.isNull()).withColumn("why_invalid", reason)


def map_outcome(df: DataFrame, mapping: DataFrame, code: str, cls: str = "cls") -> DataFrame:
    """Source codes to classes; the closed mapping is a small table, and what it lacks is 'unmapped'."""
    return df.join(mapping, code, "left").withColumn(cls, F.coalesce(F.col(cls), F.lit("unmapped")))


def team_perspective(games: DataFrame) -> DataFrame:
    """Each game as two team rows that keep the game's id."""

    def side(name: str, other: str) -> Column:
        return F.struct(F.lit(name).alias("side"), F.col(f"{name}_team").alias("team"), F.col(f"{other}_team").alias("opponent"),
                        F.col(f"{name}_runs").alias("runs"), F.col(f"{other}_runs").alias("allowed"))

    keep = [c for c in games.columns if not c.startswith(("home_", "away_"))]
    return games.select(*keep, F.explode(F.array(side("home", "away"), side("away", "home"))).alias("t")).select(*keep, "t.*")
