"""Splits by time, what is fitted on training rows, and audits of leaks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hindcast.functions.sizes import few


def time_split(games: DataFrame, date: str, cuts: tuple[Column, Column]) -> DataFrame:
    """train before the first cut, validation before the second, test after; the dates are the caller's."""
    return games.withColumn("split", F.when(F.col(date) < cuts[0], "train").when(F.col(date) < cuts[1], "validation").otherwise("test"))


def propagate_split(events: DataFrame, split: DataFrame, key: str = "game_id") -> DataFrame:
    """Every event with its game's split; null where the game has none, so that a gap shows instead of shrinking the table."""
    return events.join(split.select(key, "split"), key, "left")


def purge_overlap(labels: DataFrame, cut: Column, label_end: str = "label_end") -> DataFrame:
    """Training rows whose label interval ends by the cut."""
    return labels.where((F.col("split") != "train") | (F.col(label_end) <= cut))


def rolling_origin(df: DataFrame, origins: DataFrame, date: str, eval_days: int, train_days: int | None = None) -> DataFrame:
    """(origin, role, rows...): before an origin train (all, or the last train_days), from it on eval for eval_days.

    origins is a small table of dates, so each row meets every origin once and
    keeps those that give it a role.
    """
    both = df.join(few(origins), F.col(date) < F.date_add("origin", eval_days))  # a few dates
    role = F.when(F.col(date) >= F.col("origin"), "eval").when(F.lit(train_days is None) | (F.col(date) >= F.date_sub("origin", train_days or 0)), "train")
    return both.withColumn("role", role).where("role is not null")


def fit_impute(train: DataFrame, cols: Sequence[str]) -> DataFrame:
    return train.agg(*[F.avg(c).alias(c) for c in cols])


def apply_impute(df: DataFrame, fitted: DataFrame) -> DataFrame:
    """Fills features by the training means and says where; labels and locations are not for this."""
    cols = fitted.columns
    df = df.crossJoin(F.broadcast(fitted.select(*[F.col(c).alias(f"__{c}") for c in cols])))  # one row
    return df.select(*[c for c in df.columns if c not in cols and not c.startswith("__")], *[F.coalesce(c, f"__{c}").alias(c) for c in cols], *[F.col(c).isNull().alias(f"{c}_was_missing") for c in cols])


def fit_scale(train: DataFrame, cols: Sequence[str]) -> DataFrame:
    return train.agg(*[F.avg(c).alias(f"{c}_mean") for c in cols], *[F.stddev_samp(c).alias(f"{c}_dev") for c in cols])


def apply_scale(df: DataFrame, fitted: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(x - mean) / deviation; a zero deviation gives null."""
    df = df.crossJoin(F.broadcast(fitted))  # one row
    return df.withColumns({c: F.try_divide(F.col(c) - F.col(f"{c}_mean"), F.col(f"{c}_dev")) for c in cols}).drop(*fitted.columns)


def fit_encode(train: DataFrame, col: str) -> DataFrame:
    """(col, code): numbers of the training categories, from 0 by name; codes are few, as categories are."""
    return train.where(F.col(col).isNotNull()).select(col).distinct().withColumn("code", F.row_number().over(Window.orderBy(col)) - 1)


def apply_encode(df: DataFrame, fitted: DataFrame, col: str) -> DataFrame:
    """Adds code; categories that training hasn't seen get -1, nulls stay null."""
    return df.join(fitted, col, "left").withColumn("code", F.when(F.col(col).isNull(), F.lit(None)).otherwise(F.coalesce("code", F.lit(-1))))


def screen_features(train: DataFrame, cols: Sequence[str], y: str) -> DataFrame:
    """(feature, r): correlation with the target on the training slice."""
    return train.agg(*[F.corr(F.col(c).cast("double"), F.col(y).cast("double")).alias(c) for c in cols]).unpivot([], list(cols), "feature", "r")


def calibrate_bins(calib: DataFrame, preds: DataFrame, p: str, y: str, n: int) -> DataFrame:
    """Replaces forecasts by the observed rate of their bin in an earlier slice; empty bins keep the forecast."""
    b = F.least(F.floor(F.col(p) * n), F.lit(n - 1)).cast("long")
    rates = calib.groupBy(b.alias("bin")).agg(F.avg(F.col(y).cast("double")).alias("rate"))
    return preds.withColumn("bin", b).join(rates, "bin", "left").withColumn("calibrated", F.coalesce("rate", p)).drop("rate")  # n rows


def test_lock_audit(run_ledger: DataFrame, test_ids: DataFrame, key: str) -> DataFrame:
    """Selection runs that touched locked test samples, and how many."""
    touched = run_ledger.where("purpose = 'selection'").join(test_ids.select(key).distinct(), key, "left_semi")
    return touched.groupBy("run_id").agg(F.count_distinct(key).alias("touched"))


def leak_report(inputs: DataFrame, samples: DataFrame, key: str, event_ts: str, avail_ts: str) -> DataFrame:
    """(cause, n_rows, n_samples) of input rows later than their sample's cutoff, or not known to be earlier; samples has (key, cutoff).

    A row without evidence of its event time or availability, of a sample that isn't listed, or of one without a cutoff counts with that cause.
    """
    listed = samples.select(key, "cutoff", F.lit(True).alias("__listed"))
    cause = (F.when(F.col("__listed").isNull(), "unknown sample").when(F.col("cutoff").isNull(), "no cutoff").when(F.col(event_ts).isNull(), "no event time")
             .when(F.col(event_ts) >= F.col("cutoff"), "event").when(F.col(avail_ts).isNull(), "no evidence").when(F.col(avail_ts) > F.col("cutoff"), "availability"))
    bad = inputs.join(listed, key, "left").withColumn("cause", cause).where("cause is not null")
    return bad.groupBy("cause").agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct(F.struct(key)).alias("n_samples"))
