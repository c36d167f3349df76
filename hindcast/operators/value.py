"""Game value: score distributions, win values and run values."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hindcast.operators.aggregates import mean_with_back_off
from hindcast.operators.joins import join_boundary_pair


def joint_score(home: DataFrame, away: DataFrame) -> DataFrame:
    """(game_id, h, a, p, assumption) from two pmfs (game_id, k, p): independence is an assumption and says so."""
    return home.select("game_id", F.col("k").alias("h"), F.col("p").alias("__h")).join(away.select("game_id", F.col("k").alias("a"), F.col("p").alias("__a")), "game_id").select(
        "game_id", "h", "a", (F.col("__h") * F.col("__a")).alias("p"), F.lit("independent").alias("assumption"))


def wdl_from_scores(joint: DataFrame) -> DataFrame:
    def part(when):
        return F.sum(F.when(when, F.col("p")).otherwise(0.0))

    h, a = F.col("h"), F.col("a")
    return joint.groupBy("game_id").agg(part(h > a).alias("p_home"), part(h == a).alias("p_draw"), part(h < a).alias("p_away"))


def expected_score(pmf: DataFrame, key: Sequence[str]) -> DataFrame:
    """Expected runs and the rounded summary with its rule."""
    mean = F.sum(F.col("k") * F.col("p"))
    return pmf.groupBy(*key).agg(mean.alias("expected")).select(*key, "expected", F.floor(F.col("expected") + 0.5).cast("long").alias("score"), F.lit("mean_rounded").alias("rule"))


def state_win_rate(train: DataFrame, state: Sequence[str], y: str, min_n: int, coarser: Sequence[Sequence[str]] = ()) -> DataFrame:
    """Mean win share per state; states with fewer than min_n rows back off."""
    return mean_with_back_off(train, state, y, min_n, coarser, "win_share")


def _pairs(states: DataFrame, game: str, order: Sequence[str], state: Sequence[str], extra: Sequence[str]) -> DataFrame:
    """Each state and the next one; __ends where there is none: only that ends a part, an unknown state does not."""
    pairs = join_boundary_pair(states, game, order, state)
    return pairs.select(game, *order, *extra, F.col("post").isNull().alias("__ends"), *[F.col(f"pre.{c}").alias(f"pre_{c}") for c in state], *[F.col(f"post.{c}").alias(f"post_{c}") for c in state])


def _valued(pairs: DataFrame, table: DataFrame, state: Sequence[str], value: str) -> DataFrame:
    """Values of both states, from a table with a row per state; null columns of a state are a value of their own."""
    for side in ("pre", "post"):
        keys = [F.col(c).alias(f"__{c}") for c in state]
        same = reduce(lambda a, b: a & b, [F.col(f"{side}_{c}").eqNullSafe(F.col(f"__{c}")) for c in state])
        pairs = pairs.join(table.select(*keys, F.col(value).alias(f"{side}_value")), same, "left").drop(*[f"__{c}" for c in state])
    return pairs.withColumn("post_value", F.when(~F.col("__ends"), F.col("post_value")))


def wpa(states: DataFrame, wp: DataFrame, game: str, order: Sequence[str], state: Sequence[str]) -> DataFrame:
    """Win value after minus before, for one fixed team; the last state of a game has no after and gives null, as does a state without a value."""
    out = _valued(_pairs(states, game, order, state, []), wp, state, "win_share")
    return out.select(game, *order, (F.col("post_value") - F.col("pre_value")).alias("wpa"))


def run_value(states: DataFrame, re: DataFrame, part: str, order: Sequence[str], state: Sequence[str], runs: str) -> DataFrame:
    """Change of run expectancy, plain and with the runs scored; after the end of a half inning the value is 0.

    The end is where no state follows.  A state that follows but is unknown has the value of such states in re, and
    none if re has none: then the change is null, not that of an ended half inning.
    """
    out = _valued(_pairs(states, part, order, state, [runs]), re, state, "expected")
    change = F.when(F.col("__ends"), 0.0).otherwise(F.col("post_value")) - F.col("pre_value")
    return out.select(part, *order, change.alias("plain"), (change + F.col(runs)).alias("with_runs"))


def leverage(trans: DataFrame, wp: DataFrame, state: str = "state") -> DataFrame:
    """Expected absolute change of win value over a state's outcomes (state, next, p), relative to the mean of all states.

    covered is the share of the state's outcomes whose change has a value; only if all have one there is a swing, and only such states make the mean.
    """
    rows = trans.where("p > 0").join(wp.select(state, F.col("win_share").alias("now")), state, "left").join(wp.select(F.col(state).alias("next"), F.col("win_share").alias("then")), "next", "left")
    change = F.abs(F.col("then") - F.col("now"))
    sums = rows.groupBy(state).agg(F.sum(F.col("p") * change).alias("swing"), F.count_if(change.isNull()).alias("__open"), F.coalesce(F.sum(F.when(change.isNotNull(), F.col("p"))), F.lit(0.0)).alias("covered"), F.sum("p").alias("__p"))
    swing = sums.select(state, F.when(F.col("__open") == 0, F.col("swing")).alias("swing"), (F.col("covered") / F.col("__p")).alias("covered"))
    return swing.crossJoin(swing.agg(F.avg("swing").alias("mean"))).select(state, "swing", F.try_divide("swing", "mean").alias("leverage"), "covered")  # one row
