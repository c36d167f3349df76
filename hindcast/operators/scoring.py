"""Scores of forecasts: probabilities, counts, distributions, locations, lineups."""

from __future__ import annotations

import itertools
import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hindcast.functions.scalars import euclid, neg_log, one_hot_sq


def n_rows(name: str = "n") -> Column:
    return F.count(F.lit(1)).alias(name)


def log_loss(preds: DataFrame, truth: DataFrame, key: Sequence[str], by: Sequence[str] = (), eps: float = 1e-12) -> DataFrame:
    """Mean minus-log of the true class's probability; preds (key, cls, p), truth (key, by, truth)."""
    hit = truth.join(preds.withColumnRenamed("cls", "truth"), [*key, "truth"], "left")
    return hit.groupBy(*by).agg(n_rows(), F.avg(neg_log(F.coalesce("p", F.lit(0.0)), eps)).alias("log_loss"))


def brier_multi(preds: DataFrame, truth: DataFrame, key: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Squared error summed over classes, then the mean over samples.

    Every sample of truth counts, as for log_loss: a class without a forecast has probability 0.
    """
    both = truth.select(*key, *by, "truth").join(preds.select(*key, "cls", "p"), list(key), "left")
    missed = F.when(F.coalesce(F.bool_or(F.col("cls") == F.col("truth")), F.lit(False)), 0.0).otherwise(1.0)
    per = both.groupBy(*key, *by).agg((F.coalesce(F.sum(one_hot_sq(F.col("p"), F.col("cls"), F.col("truth"))), F.lit(0.0)) + missed).alias("s"))
    return per.groupBy(*by).agg(n_rows(), F.avg("s").alias("brier"))


def joint_and_marginal_loss(joint: DataFrame, truth: DataFrame, key: Sequence[str], a: str, b: str, eps: float = 1e-12) -> DataFrame:
    """Joint loss and each marginal's, apart: joint (key, a, b, p), truth (key, a, b).

    One pass: cells meet the sample's truth as they come, and a sample keeps three sums, so no task holds the cells of its samples.
    """
    samples = truth.groupBy(*key, a, b).agg(F.count(F.lit(1)).alias("__n"))
    cells = joint.select(*key, F.col(a).alias("__a"), F.col(b).alias("__b"), "p")
    hit_a, hit_b = F.col(a) == F.col("__a"), F.col(b) == F.col("__b")
    hits = {"joint": hit_a & hit_b, a: hit_a, b: hit_b}
    per = samples.join(cells, list(key), "left").groupBy(*key, a, b, "__n").agg(*[F.sum(F.when(hit, F.col("p"))).alias(f"__p{k}") for k, hit in enumerate(hits.values())])
    losses = [F.sum(F.col("__n") * neg_log(F.coalesce(f"__p{k}", F.lit(0.0)), eps)) / F.sum("__n") for k in range(len(hits))]
    row = per.agg(F.coalesce(F.sum("__n"), F.lit(0)).alias("n"), F.array(*[F.struct(F.lit(name).alias("part"), loss.alias("log_loss")) for name, loss in zip(hits, losses)]).alias("parts"))
    return row.select("n", F.explode("parts").alias("x")).select("x.part", "n", "x.log_loss")


def confusion(preds: DataFrame, truth: DataFrame, key: Sequence[str]) -> DataFrame:
    """Counts of true by likeliest class; of equally likely classes the first by name.

    Every observed sample counts: without a forecast, or with none that has a probability, its predicted class is null.
    Samples without a true class are not observed and count nowhere.
    """
    best = preds.where("p is not null").groupBy(*key).agg(F.min_by("cls", F.struct(-F.col("p"), "cls")).alias("predicted"))
    return truth.select(*key, "truth").where("truth is not null").join(best, list(key), "left").groupBy("truth", "predicted").agg(n_rows())


def class_report(conf: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support of each true or predicted class; a sample without a predicted class is in its true class's support only."""
    rows = conf.select(F.explode(F.array(F.struct(F.col("truth").alias("cls"), F.lit(True).alias("t")), F.struct(F.col("predicted").alias("cls"), F.lit(False).alias("t")))).alias("c"), "truth", "predicted", "n")
    sums = rows.where("c.cls is not null").groupBy("c.cls").agg(
        F.sum(F.when(F.col("c.t") & (F.col("truth") == F.col("predicted")), F.col("n")).otherwise(0)).alias("tp"),
        F.sum(F.when(F.col("c.t"), F.col("n")).otherwise(0)).alias("support"), F.sum(F.when(~F.col("c.t"), F.col("n")).otherwise(0)).alias("predicted_n"))
    precision, recall = F.try_divide(F.col("tp"), F.col("predicted_n")), F.try_divide(F.col("tp"), F.col("support"))
    f1 = F.try_divide(2.0 * F.col("tp"), F.col("support") + F.col("predicted_n"))
    return sums.select("cls", precision.alias("precision"), recall.alias("recall"), f1.alias("f1"), "support")


def macro_f1(report: DataFrame) -> DataFrame:
    return report.agg(F.avg(F.coalesce("f1", F.lit(0.0))).alias("macro_f1"), n_rows("classes"))


def accuracy(conf: DataFrame) -> DataFrame:
    """Share of all observed samples whose predicted class is the true one; no forecast is no hit."""
    return conf.agg((F.coalesce(F.sum(F.when(F.col("truth") == F.col("predicted"), F.col("n"))), F.lit(0)) / F.sum("n")).alias("accuracy"), F.sum("n").alias("n"))


def _scored(truth: DataFrame, preds: DataFrame, key: Sequence[str], observed: Column, forecast: Column) -> DataFrame:
    """Every sample of truth, with its forecast if it has one, and __state: scored, unforecast or unobserved."""
    state = F.when(~observed, "unobserved").when(forecast, "scored").otherwise("unforecast")
    return truth.join(preds, list(key), "left").withColumn("__state", state)


def _states() -> list[Column]:
    """n of the scored, and how many samples have no forecast, or no observation."""
    state = F.col("__state")
    return [F.count_if(state == "scored").alias("n"), F.count_if(state == "unforecast").alias("unforecast"), F.count_if(state == "unobserved").alias("unobserved")]


def _where_scored(value: Column) -> Column:
    return F.when(F.col("__state") == "scored", value)


def mae_rmse(preds: DataFrame, truth: DataFrame, key: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Absolute and squared error of y_hat against y where both are known, beside the samples without a forecast or an observation."""
    rows = _scored(truth, preds, key, F.col("y").isNotNull(), F.col("y_hat").isNotNull())
    e = _where_scored(F.col("y_hat") - F.col("y"))
    return rows.groupBy(*by).agg(*_states(), F.avg(F.abs(e)).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse"))


def ratio_mae(preds: DataFrame, truth: DataFrame, key: Sequence[str]) -> DataFrame:
    """MAE of a ratio where its denominator isn't zero, with these denominators' sum and the share of all samples that could be scored.

    A ratio whose denominator is zero, or that is not known, is not observed.
    """
    value = F.try_divide(F.col("num").cast("double"), F.col("den").cast("double"))
    rows = _scored(truth, preds, key, value.isNotNull(), F.col("y_hat").isNotNull())
    return rows.agg(*_states(), F.avg(_where_scored(F.abs(F.col("y_hat") - value))).alias("mae"), F.sum(_where_scored(F.col("den"))).alias("den"),
                    F.avg((F.col("__state") == "scored").cast("double")).alias("coverage"))


def log_score_dist(pmf: DataFrame, truth: DataFrame, key: str, eps: float = 1e-12) -> DataFrame:
    return truth.join(pmf.withColumnRenamed("k", "y"), [key, "y"], "left").agg(n_rows(), F.avg(neg_log(F.coalesce("p", F.lit(0.0)), eps)).alias("log_score"))


def crps_discrete(pmf: DataFrame, truth: DataFrame, key: str) -> DataFrame:
    """Mean of the integral over x of (F(x) - 1[y <= x])^2, for pmfs (key, k, p) with any support.

    F is a step function, so between two neighbours of the support the integral is the gap's length on each side
    of y times a squared step: gaps in k cost no rows.  Below the support F is 0, above it 1: the tail rule, fixed
    beforehand, is that mass which a pmf doesn't list stands at its greatest k (`unlisted` is its mean), and rows
    with null k or p are not listed.  Samples without a pmf, or with unknown y, are counted, not scored.
    """
    steps = Window.partitionBy(key).orderBy("k")
    k, nxt = F.col("k").cast("double"), F.col("__next").cast("double")
    seen = (pmf.where("k is not null and p is not null").groupBy(key, "k").agg(F.sum("p").alias("p"))
            .withColumn("cdf", F.sum("p").over(steps)).withColumn("__next", F.lead("k").over(steps)).withColumn("__first", F.row_number().over(steps) == 1))
    rows = _scored(truth.select(key, F.col("y").cast("double").alias("y")), seen, [key], F.col("y").isNotNull(), F.col("k").isNotNull())
    y = F.col("y")
    before = F.greatest(F.lit(0.0), F.least(nxt, y) - k)  # of the gap [k, next), what lies below y
    inside = before * F.pow("cdf", F.lit(2)) + (nxt - k - before) * F.pow(1 - F.col("cdf"), F.lit(2))
    below = F.when(F.col("__first"), F.greatest(F.lit(0.0), k - y)).otherwise(0.0)
    each = rows.groupBy(key, "y", "__state").agg(F.sum(below + F.when(nxt.isNull(), F.greatest(F.lit(0.0), y - k)).otherwise(inside)).alias("crps"), (1 - F.max("cdf")).alias("unlisted"))
    return each.agg(*_states(), F.avg(_where_scored(F.col("crps"))).alias("crps"), F.avg(_where_scored(F.col("unlisted"))).alias("unlisted"))


def interval_score(preds: DataFrame, truth: DataFrame, key: Sequence[str]) -> DataFrame:
    """Coverage and width of the intervals (lo, hi) that are given, beside the samples without one; an interval without both ends is none."""
    y, lo, hi = (F.col(c) for c in ("y", "lo", "hi"))
    rows = _scored(truth, preds, key, y.isNotNull(), lo.isNotNull() & hi.isNotNull())
    return rows.agg(*_states(), F.avg(_where_scored(y.between(lo, hi).cast("double"))).alias("coverage"), F.avg(_where_scored(hi - lo)).alias("width"))


def location_error(preds: DataFrame, truth: DataFrame, key: Sequence[str], accuracy: int | None = None) -> DataFrame:
    """Per-axis MAE, mean and median distance where the truth is valid, the valid share, and how many are left out or have no forecast.

    The median is exact and holds all distances in one task; with `accuracy` it is a mergeable sketch's, whose rank is off by 1 in `accuracy` at most.
    """
    rows = _scored(truth, preds, key, F.col("x").isNotNull() & F.col("z").isNotNull(), F.col("x_hat").isNotNull() & F.col("z_hat").isNotNull())
    dx, dz = _where_scored(F.col("x_hat") - F.col("x")), _where_scored(F.col("z_hat") - F.col("z"))
    d = euclid(dx, dz)
    middle = F.median(d) if accuracy is None else F.percentile_approx(d, 0.5, accuracy)
    return rows.agg(F.avg(F.abs(dx)).alias("mae_x"), F.avg(F.abs(dz)).alias("mae_z"), F.avg(d).alias("mean_distance"), middle.alias("median_distance"),
                    F.avg((F.col("__state") != "unobserved").cast("double")).alias("valid_share"), F.count_if(F.col("__state") == "unobserved").alias("excluded"), F.count_if(F.col("__state") == "unforecast").alias("unforecast"))


def lineup_hits(pred: DataFrame, actual: DataFrame, game: str, player: str, slot: str, position: str, starter: str) -> DataFrame:
    """Per game of the actual lineups: players, those forecast, in the right slot, at the right position, and whether the starter is right.

    The starter is who stands at the position named so.  Games without any hit,
    or without a forecast, count with zeros; games without a lineup don't.
    """
    guess = pred.select(game, player, F.col(slot).alias("__slot"), F.col(position).alias("__position"))
    both = actual.select(game, player, slot, position).join(guess, [game, player], "left")
    same, at = F.col(slot) == F.col("__slot"), F.col(position) == F.col("__position")
    return both.groupBy(game).agg(
        n_rows("players"), F.count_if(F.col("__slot").isNotNull() | F.col("__position").isNotNull()).alias("roster_hits"), F.count_if(same).alias("slot_hits"),
        F.count_if(at).alias("position_hits"), F.coalesce(F.max((at & (F.col(position) == starter)).cast("int")), F.lit(0)).cast("long").alias("starter_hit"))


def candidate_hit_at_k(ranked: DataFrame, actual: DataFrame, key: Sequence[str], what: str, k: int) -> DataFrame:
    """Share of actual picks among the first k; picks without candidates miss."""
    hit = actual.join(ranked.select(*key, what, "rank"), [*key, what], "left")
    return hit.agg(n_rows(), F.avg(F.coalesce((F.col("rank") <= k).cast("double"), F.lit(0.0))).alias("hit_rate"))


def compare_candidates(preds: Mapping[str, DataFrame], truth: DataFrame, key: Sequence[str], eps: float = 1e-12) -> DataFrame:
    """Log loss of each candidate on the samples all of them cover, beside the share each covers by itself."""
    common = truth.select(*key)
    for p in preds.values():
        common = common.join(p, list(key), "left_semi")
    shared, out = truth.join(common, list(key), "left_semi"), None
    total = truth.agg(n_rows("total"))
    for name, p in preds.items():
        own = truth.join(p, list(key), "left_semi").agg(n_rows("covered"))
        row = log_loss(p, shared, key, eps=eps).crossJoin(own).crossJoin(total)  # one row each
        row = row.select(F.lit(name).alias("candidate"), "n", "log_loss", (F.col("covered") / F.col("total")).alias("coverage"))
        out = row if out is None else out.unionByName(row)
    return out


def poisson_weight(replicate: Column, cluster: Column, seed: int) -> Column:
    """How often a replicate draws a cluster: Poisson(1) at a uniform number that a hash of both and the seed gives.

    So a weight needs no shuffle and no state, and is the same wherever it is computed.
    """
    digits = F.substring(F.md5(F.concat_ws("/", F.lit(str(seed)), replicate.cast("string"), cluster.cast("string")).cast("binary")), 1, 7)
    u = F.conv(digits, 16, 10).cast("long") / float(16**7)
    steps = itertools.accumulate(math.exp(-1) / math.factorial(k) for k in range(10))
    return reduce(lambda a, b: a + b, [F.when(u >= c, 1).otherwise(0) for c in steps])


def bootstrap_compare(preds: Mapping[str, DataFrame], truth: DataFrame, key: Sequence[str], cluster: str, reference: str, *, replicates: int = 200, level: float = 0.95, seed: int = 1, eps: float = 1e-12) -> DataFrame:
    """compare_candidates with the difference from a reference and its bootstrap interval over whole clusters, such as seasons.

    Samples are summed once by candidate and cluster; replicates reweight these sums, so the samples are read
    once and never repeated.  A replicate weighs a cluster alike for all candidates, so their differences are paired.
    truth has (key, cluster, truth); samples without a cluster are one.
    """
    common = truth.select(*key)
    for p in preds.values():
        common = common.join(p, list(key), "left_semi")
    shared = truth.select(*key, F.col(cluster).alias("__cluster"), "truth").join(common, list(key), "left_semi")
    each = []
    for name, p in preds.items():
        hit = shared.join(p.withColumnRenamed("cls", "truth"), [*key, "truth"], "left")
        each.append(hit.groupBy("__cluster").agg(n_rows(), F.sum(neg_log(F.coalesce("p", F.lit(0.0)), eps)).alias("loss")).withColumn("candidate", F.lit(name)))
    sums = reduce(DataFrame.unionByName, each)
    number = F.coalesce(F.col("__cluster").cast("string"), F.lit(""))
    drawn = sums.withColumn("b", F.explode(F.sequence(F.lit(1), F.lit(replicates)))).withColumn("w", poisson_weight(F.col("b"), number, seed))
    per = drawn.groupBy("candidate", "b").agg(F.try_divide(F.sum(F.col("w") * F.col("loss")), F.sum(F.col("w") * F.col("n"))).alias("loss"))
    other = per.where(F.col("candidate") == reference).select("b", F.col("loss").alias("__loss"))
    tails = [(1 - level) / 2, (1 + level) / 2]
    # A row per replicate and candidate.
    spread = per.join(other, "b").groupBy("candidate").agg(F.percentile(F.col("loss") - F.col("__loss"), F.array(*map(F.lit, tails))).alias("q"))
    whole = sums.groupBy("candidate").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("clusters"), (F.sum("loss") / F.sum("n")).alias("log_loss"))
    base = whole.where(F.col("candidate") == reference).select(F.col("log_loss").alias("__base"))
    out = whole.join(spread, "candidate", "left").crossJoin(F.broadcast(base))  # one row
    return out.select("candidate", "n", "clusters", "log_loss", (F.col("log_loss") - F.col("__base")).alias("difference"), F.col("q")[0].alias("lo"), F.col("q")[1].alias("hi"))


def select_setting(scores: DataFrame, metric: str, lower_is_better: bool = True) -> DataFrame:
    """The setting with the best declared metric on validation rows; other rows are never looked at."""
    order = F.col(metric) if lower_is_better else -F.col(metric)
    return scores.where("split = 'validation'").agg(F.min_by(F.struct("setting", metric), F.struct(order, "setting")).alias("b")).select("b.*")


def strata_report(scored: DataFrame, dims: Sequence[str], metric: str) -> DataFrame:
    """Mean metric for every combination of dims, each also left out (null)."""
    return scored.cube(*dims).agg(n_rows(), F.avg(metric).alias(metric), F.grouping_id().cast("long").alias("grouping"))


def worst_cases(scored: DataFrame, by: Sequence[str], error: str, order: Sequence[str], k: int) -> DataFrame:
    w = Window.partitionBy(*by).orderBy(F.desc(error), *order)
    return scored.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def eval_record(metrics: DataFrame, ctx: Mapping[str, str]) -> DataFrame:
    from hindcast.sources.lineage import with_context

    return with_context(metrics, **ctx)


def season_scores(outlook: DataFrame, actual: DataFrame, eps: float = 1e-12) -> DataFrame:
    """Completed seasons only: MAE of wins and rank, Brier and log loss of entry.

    Teams without an outlook are counted and count as log_loss and brier_multi count a sample without a forecast: what
    happened had no probability.  They have no error of wins or rank.
    """
    both = actual.where("completed").join(outlook, ["season", "team"], "left")
    y, p = F.col("entered").cast("double"), F.coalesce("p_entry", 1 - F.col("entered").cast("double"))
    return both.agg(n_rows(), F.count_if(F.col("p_entry").isNull()).alias("unforecast"), F.avg(F.abs(F.col("wins_hat") - F.col("wins"))).alias("wins_mae"), F.avg(F.abs(F.col("rank_hat") - F.col("rank"))).alias("rank_mae"),
                    F.avg(F.pow(p - y, F.lit(2))).alias("brier"), F.avg(F.when(F.col("entered"), neg_log(p, eps)).otherwise(neg_log(1 - p, eps))).alias("log_loss"))
