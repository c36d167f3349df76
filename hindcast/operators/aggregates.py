"""Aggregations: counts, totals, ratios as sums over sums, and baselines from training rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hindcast.functions.scalars import ratio_of
from hindcast.functions.sizes import few
from hindcast.operators.joins import horizon_rows
from hindcast.operators.windows import rolling_days


def n_rows(name: str = "n") -> Column:
    return F.count(F.lit(1)).alias(name)


def collapse_pa(pitches: DataFrame, keys: Sequence[str], order: Column, state: Sequence[str], result: str) -> DataFrame:
    """Pitches to one row per plate appearance: first state, last result."""
    return pitches.groupBy(*keys).agg(*[F.min_by(c, order).alias(f"start_{c}") for c in state], F.max_by(result, order).alias("result"), n_rows("pitches"))


def horizon_counts(logs: DataFrame, ts: str, days: int, by: Sequence[str], counts: Sequence[str]) -> DataFrame:
    """Sums of count and exposure columns per key and Monday anchor over [anchor, anchor + days)."""
    return horizon_rows(logs, ts, days).groupBy(*by, "anchor").agg(*[F.sum(c).cast("long").alias(c) for c in counts])


def season_to_date(logs: DataFrame, ts: str, cut: Column, by: Sequence[str], counts: Sequence[str]) -> DataFrame:
    return logs.where(F.col(ts) < cut).groupBy(*by).agg(*[F.sum(c).cast("long").alias(c) for c in counts])


def ratio(df: DataFrame, by: Sequence[str], num: str, den: str) -> DataFrame:
    """Sum over sum per group; a zero denominator gives null and a reason."""
    sums = df.groupBy(*by).agg(F.sum(num).alias("num"), F.sum(den).alias("den"))
    return sums.withColumn("r", ratio_of(F.col("num"), F.col("den"))).select(*by, "r.*")


def outs_to_innings(df: DataFrame, by: Sequence[str], outs: str = "outs") -> DataFrame:
    sums = df.groupBy(*by).agg(F.sum(outs).cast("long").alias("outs"))
    return sums.select(*by, "outs", F.expr("outs div 3").alias("innings"), (F.col("outs") % 3).alias("thirds"))


def season_projection(actual: DataFrame, remaining: DataFrame, key: str, num: str, den: str) -> DataFrame:
    """Actual counts plus expected remaining ones, then the ratio of the sums."""
    both = actual.select(key, F.col(num).alias("an"), F.col(den).alias("ad")).join(remaining.select(key, F.col(num).alias("rn"), F.col(den).alias("rd")), key, "full")
    total = [(F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0))).cast("double") for a, b in (("an", "rn"), ("ad", "rd"))]
    return both.select(key, total[0].alias(num), total[1].alias(den)).withColumn("value", F.try_divide(num, den))


def base_rate(train: DataFrame, y: str) -> DataFrame:
    counts = train.groupBy(y).agg(n_rows())
    return counts.crossJoin(counts.agg(F.sum("n").alias("total"))).withColumn("p", F.col("n") / F.col("total"))  # one row per class


def _join_with_nulls(left: DataFrame, right: DataFrame, on: Sequence[str], how: str) -> DataFrame:
    """Equality join in which null equals null; the columns of on come from the left."""
    named = right.withColumnsRenamed({c: f"__{c}" for c in on})
    return left.join(named, reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in on]), how).drop(*[f"__{c}" for c in on])


def conditional_rate(train: DataFrame, y: str, levels: Sequence[Sequence[str]], min_n: int, alpha: float) -> DataFrame:
    """Class frequencies for each finest condition, with additive smoothing.

    levels goes from finest to coarsest; a cell with fewer than min_n rows backs
    off to the next coarser one, at last to all rows.  One fine aggregate is
    made; the coarser levels are sums of it.  A null condition or class is a
    value of its own.
    """
    fine = train.groupBy(*levels[0], y).agg(n_rows())
    classes = fine.select(y).distinct()
    k = classes.agg(F.count(F.lit(1)).alias("k"))
    grid = fine.select(*levels[0]).distinct().crossJoin(few(classes)).crossJoin(k)  # classes are few
    p, level = None, None
    for i, cols in enumerate([*levels, []]):
        cell = fine.groupBy(*cols, y).agg(F.sum("n").alias(f"n{i}"))
        size = fine.groupBy(*cols).agg(F.sum("n").alias(f"t{i}"))
        grid = _join_with_nulls(grid, cell, [*cols, y], "left")
        grid = _join_with_nulls(grid, size, cols, "inner") if cols else grid.crossJoin(size)  # one row
        value = (F.coalesce(f"n{i}", F.lit(0)) + alpha) / (F.col(f"t{i}") + alpha * F.col("k"))
        enough = F.col(f"t{i}") >= min_n if cols else F.lit(True)
        p = F.when(enough, value) if p is None else p.when(enough, value)
        level = F.when(enough, i) if level is None else level.when(enough, i)
    return grid.select(*levels[0], y, p.alias("p"), level.alias("level"))


def joint_rate(train: DataFrame, a: str, b: str) -> DataFrame:
    """Joint, both marginals and the total in one pass: grouping is 0 for joint, 1 and 2 for marginals, 3 for all."""
    return train.groupingSets([[a, b], [a], [b], []], a, b).agg(n_rows(), F.grouping_id().cast("long").alias("grouping"))


def mean_with_back_off(train: DataFrame, state: Sequence[str], y: str, min_n: int, coarser: Sequence[Sequence[str]], name: str) -> DataFrame:
    """Mean of y per state; one with fewer than min_n rows takes the mean of the first coarser level that has them, at last of all rows.

    coarser goes from finer to coarser subsets of the state's columns.  One fine
    aggregate is made; the levels are sums of it.  A null is a value of its own.
    """
    fine = train.groupBy(*state).agg(n_rows(), F.sum(y).alias("sum"), F.count(y).alias("known"))
    out, value = fine, F.when(F.col("n") >= min_n, F.col("sum") / F.nullif("known", F.lit(0)))
    for i, cols in enumerate(coarser):
        level = fine.groupBy(*cols).agg(F.sum("n").alias(f"n{i}"), (F.sum("sum") / F.nullif(F.sum("known"), F.lit(0))).alias(f"m{i}"))
        out = _join_with_nulls(out, level, cols, "inner")
        value = value.when(F.col(f"n{i}") >= min_n, F.col(f"m{i}"))
    overall = fine.agg((F.sum("sum") / F.nullif(F.sum("known"), F.lit(0))).alias("overall"))  # one row
    return out.crossJoin(overall).select(*state, "n", value.otherwise(F.col("overall")).alias(name))


def run_expectancy(train: DataFrame, state: Sequence[str], rem: str, min_n: int, coarser: Sequence[Sequence[str]] = ()) -> DataFrame:
    """Mean runs to come per state; states with fewer than min_n rows back off."""
    return mean_with_back_off(train, state, rem, min_n, coarser, "expected")


def point_baseline(train: DataFrame, y: str, by: Sequence[str] = (), accuracy: int | None = None) -> DataFrame:
    """Mean and median of the training rows.

    The exact median holds a group's values in one task.  With `accuracy` it comes from a mergeable quantile sketch:
    partial sketches are merged, none larger than about `accuracy` entries, and its rank is off by 1 in `accuracy` at most.
    """
    middle = F.median(y) if accuracy is None else F.percentile_approx(y, 0.5, accuracy)
    return train.groupBy(*by).agg(F.avg(y).alias("mean"), middle.cast("double").alias("median"))


def rate_per_exposure(hist: DataFrame, expo: DataFrame, key: str, count: str, exposure: str) -> DataFrame:
    """Count per unit of past exposure times the expected exposure, for every key with an expected exposure.

    reason says why there is none: no history, or no exposure in it.
    """
    past = hist.groupBy(key).agg(F.sum(count).alias("c"), F.sum(exposure).alias("e"), F.lit(True).alias("known"))
    rate = F.try_divide(F.col("c").cast("double"), F.col("e").cast("double"))
    reason = F.when(F.col("known").isNull(), "no history").when(rate.isNull(), "no exposure")
    return expo.join(past, key, "left").select(key, (rate * F.col("expected_exposure")).alias("expected"), reason.alias("reason"))


def empirical_pmf(train: DataFrame, y: str, kmax: int) -> DataFrame:
    """(k, n, p, cdf, is_tail) for every k from 0 to kmax, those without a training row too; kmax gathers what is above it and is marked as the tail."""
    counts = train.where(F.col(y).isNotNull()).groupBy(F.least(F.col(y), F.lit(kmax)).cast("long").alias("k")).agg(n_rows())
    every = train.sparkSession.range(kmax + 1).select(F.col("id").alias("k"))
    # kmax + 1 rows from here on; a constant key keeps them in one window.
    rows = every.join(counts, "k", "left").select("k", F.coalesce("n", F.lit(0)).cast("long").alias("n")).withColumn("total", F.sum("n").over(Window.partitionBy(F.lit(1))))
    rows = rows.withColumn("p", F.try_divide(F.col("n"), F.col("total")))
    return rows.withColumn("cdf", F.sum("p").over(Window.partitionBy("total").orderBy("k"))).select("k", "n", "p", "cdf", (F.col("k") == kmax).alias("is_tail"))


def independent_seasons(evals: DataFrame, by: Sequence[str], season: str = "season") -> DataFrame:
    return evals.groupBy(*by).agg(F.count_distinct(season).alias("seasons"), n_rows("forecasts"))


def bullpen_usage(logs: DataFrame, part: Sequence[str], ts: str, load: str, days: int, *, by_day: bool = False) -> DataFrame:
    """Load of the last days before each appearance, the day itself left out; by_day as in rolling_days, for keys with very many rows."""
    rows = rolling_days(logs, part, ts, days, [load], by_day=by_day)
    return rows.withColumn("recent_load", F.coalesce(f"{load}_{days}d", F.lit(0)).cast("long")).drop(f"{load}_{days}d")


def team_strength(team_games: DataFrame, cut: Column, date: str = "game_date") -> DataFrame:
    """Games, win share (a draw counts half) and mean run difference before the cutoff."""
    won = F.when(F.col("runs") > F.col("allowed"), 1.0).when(F.col("runs") == F.col("allowed"), 0.5).otherwise(0.0)
    return team_games.where(F.col(date) < cut).groupBy("team").agg(n_rows("games"), F.avg(won).alias("win_share"), F.avg(F.col("runs") - F.col("allowed")).alias("run_diff"))


def schedule_difficulty(schedule: DataFrame, strength: DataFrame) -> DataFrame:
    """Mean strength of the opponents still to come; schedule has (team, opponent).

    rated is how many of the games have an opponent whose strength is known; the mean is over these.
    """
    both = schedule.join(strength.select(F.col("team").alias("opponent"), "win_share"), "opponent", "left")
    return both.groupBy("team").agg(n_rows("games"), F.count("win_share").alias("rated"), F.avg("win_share").alias("difficulty"))


def matchup_split(pa: DataFrame, by: Sequence[str], hit: str, exposure: str) -> DataFrame:
    return ratio(pa, by, hit, exposure)


def usage_frequency(rows: DataFrame, keys: Sequence[str], what: str) -> DataFrame:
    """How often each key used each option, and its share of the key's uses."""
    counts = rows.groupBy(*keys, what).agg(n_rows())
    return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(*keys)))


def distinct_predictors(registry: DataFrame, predictor: str = "predictor", limit: int = 7) -> DataFrame:
    counts = registry.agg(F.count_distinct(predictor).alias("predictors"))
    return counts.withColumn("within_limit", F.col("predictors") <= limit)
