"""Queries of scores, game value, season tables and estimators."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from hindcast.operators import aggregates, baselines, estimators, ranking, scoring, season, splits, value
from hindcast.plans.registry import query


def cut():
    return F.lit("1998-01-01").cast("date")

KEY = ["game_id"]
_JOINT = "(SELECT x.game_id, x.k AS h, y.k AS a, x.p * y.p AS p FROM {pmf} x JOIN {pmf2} y USING (game_id))"
_CONF = "(SELECT f.truth, b.cls AS predicted, count(*) AS n FROM (SELECT * FROM {preds} QUALIFY row_number() OVER (PARTITION BY game_id ORDER BY p DESC, cls) = 1) b JOIN {final} f USING (game_id) GROUP BY 1, 2)"


def _truth(t, *extra):
    return t.final.select("game_id", "truth", *extra)


def _runs(t):
    return t.final.select("game_id", F.col("home_runs").alias("y"))


def _joint(t):
    return value.joint_score(t.pmf, t.pmf2)


def _conf(t):
    return scoring.confusion(t.preds, _truth(t), KEY)


@query("base_rate_forecast", """WITH b AS (SELECT truth AS cls, count(*) / (SELECT count(*) FROM {final} WHERE game_date < DATE '1998-01-01') AS p FROM {final} WHERE game_date < DATE '1998-01-01' GROUP BY 1),
 t AS (SELECT * FROM {final} WHERE game_date >= DATE '1998-01-01'), x AS (SELECT t.game_id, t.season, -ln(max(b.p) FILTER (b.cls = t.truth)) AS ll, sum(power(b.p - CASE WHEN b.cls = t.truth THEN 1 ELSE 0 END, 2)) AS br FROM t CROSS JOIN b GROUP BY 1, 2)
 SELECT season::BIGINT AS season, count(*) AS n, round(avg(ll), 6) AS log_loss, round(avg(br), 6) AS brier FROM x GROUP BY 1""")
def base_rate_slice(t):
    """How good is the base-rate game forecast, by season?"""
    from hindcast.operators.labels import label_game

    games = splits.time_split(label_game(t.game).withColumnRenamed("cls", "truth"), "game_date", (cut(), cut()))
    test = games.where("split = 'test'")
    preds = baselines.base_rate_forecast(games.where("split = 'train'"), test, KEY, "truth")
    truth = test.select("game_id", "truth", "season")
    return scoring.log_loss(preds, truth, KEY, ["season"]).join(scoring.brier_multi(preds, truth, KEY, ["season"]).drop("n"), "season")


@query("log_loss", "SELECT season::BIGINT AS season, count(*) AS n, round(avg(-ln(p)), 6) AS log_loss FROM {preds} p JOIN {final} f ON p.game_id = f.game_id AND p.cls = f.truth GROUP BY 1")
def _(t):
    return scoring.log_loss(t.preds, _truth(t, "season"), KEY, ["season"])


@query("brier_multi", "SELECT season::BIGINT AS season, count(*) AS n, round(avg(s), 6) AS brier FROM (SELECT game_id, season, sum(power(p - CASE WHEN cls = truth THEN 1 ELSE 0 END, 2)) AS s FROM {preds} JOIN {final} USING (game_id) GROUP BY 1, 2) GROUP BY 1")
def _(t):
    return scoring.brier_multi(t.preds, _truth(t, "season"), KEY, ["season"])


@query("brier_multi_missing", """WITH p AS (SELECT * FROM {preds} WHERE game_id % 6 <> 0 AND NOT (game_id % 5 = 0 AND cls = 'D')), x AS (SELECT f.game_id, f.season, f.truth, sum(power(p - CASE WHEN cls = truth THEN 1 ELSE 0 END, 2)) AS s, count(*) FILTER (cls = truth) AS hit
 FROM {final} f LEFT JOIN p ON p.game_id = f.game_id GROUP BY 1, 2, 3) SELECT season::BIGINT AS season, count(*) AS n, round(avg(coalesce(s, 0) + CASE WHEN hit > 0 THEN 0 ELSE 1 END), 6) AS brier FROM x GROUP BY 1""")
def _(t):
    """Games without a forecast, or without one of the true class, count as log_loss counts them."""
    preds = t.preds.where("game_id % 6 <> 0 and not (game_id % 5 = 0 and cls = 'D')")
    return scoring.brier_multi(preds, _truth(t, "season"), KEY, ["season"])


@query("joint_and_marginal_loss", f"SELECT 'joint' AS part, count(*) AS n, round(avg(-ln(p)), 6) AS log_loss FROM {_JOINT} j JOIN {{final}} f ON j.game_id = f.game_id AND j.h = f.home_runs AND j.a = f.away_runs UNION ALL SELECT 'h', count(*), round(avg(-ln(p)), 6) FROM {{pmf}} j JOIN {{final}} f ON j.game_id = f.game_id AND j.k = f.home_runs UNION ALL SELECT 'a', count(*), round(avg(-ln(p)), 6) FROM {{pmf2}} j JOIN {{final}} f ON j.game_id = f.game_id AND j.k = f.away_runs")
def _(t):
    return scoring.joint_and_marginal_loss(_joint(t), t.final.select("game_id", F.col("home_runs").alias("h"), F.col("away_runs").alias("a")), KEY, "h", "a")


@query("confusion", f"SELECT * FROM {_CONF}")
def _(t):
    return _conf(t)


_REPORT = f"(WITH c AS {_CONF}, k AS (SELECT truth AS cls FROM c UNION SELECT predicted FROM c), s AS (SELECT cls, coalesce(sum(n) FILTER (truth = cls AND predicted = cls), 0) AS tp, coalesce(sum(n) FILTER (truth = cls), 0) AS su, coalesce(sum(n) FILTER (predicted = cls), 0) AS pr FROM k CROSS JOIN c GROUP BY 1) SELECT cls, tp / nullif(pr, 0) AS precision, tp / nullif(su, 0) AS recall, 2 * tp / nullif(su + pr, 0) AS f1, su::BIGINT AS support FROM s)"


@query("class_report", f"SELECT cls, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM {_REPORT}")
def _(t):
    return scoring.class_report(_conf(t))


@query("macro_f1", f"SELECT round(avg(coalesce(f1, 0)), 6) AS macro_f1, count(*) AS classes FROM {_REPORT}")
def _(t):
    return scoring.macro_f1(scoring.class_report(_conf(t)))


@query("accuracy", f"SELECT round(sum(n) FILTER (truth = predicted) / sum(n), 6) AS accuracy, sum(n)::BIGINT AS n FROM {_CONF}")
def _(t):
    return scoring.accuracy(_conf(t))


# Games without a forecast, written from the games' side: each counts, and none is right.
_SOME = "(SELECT * FROM {preds} WHERE game_id % 6 <> 0)"
_BEST = f"(SELECT f.game_id, f.truth, (SELECT p.cls FROM {_SOME} p WHERE p.game_id = f.game_id ORDER BY p.p DESC, p.cls LIMIT 1) AS predicted FROM {{final}} f)"


def _conf_of_some(t):
    return scoring.confusion(t.preds.where("game_id % 6 <> 0"), _truth(t), KEY)


@query("confusion_missing", f"SELECT truth, predicted, count(*) AS n FROM {_BEST} GROUP BY 1, 2")
def _(t):
    return _conf_of_some(t)


@query("class_report_missing", f"""WITH b AS {_BEST} SELECT c.cls, round((SELECT count(*) FROM b WHERE truth = c.cls AND predicted = c.cls) / nullif((SELECT count(*) FROM b WHERE predicted = c.cls), 0), 6) AS precision,
 round((SELECT count(*) FROM b WHERE truth = c.cls AND predicted = c.cls) / (SELECT count(*) FROM b WHERE truth = c.cls), 6) AS recall,
 round(2 * (SELECT count(*) FROM b WHERE truth = c.cls AND predicted = c.cls) / ((SELECT count(*) FROM b WHERE truth = c.cls) + (SELECT count(*) FROM b WHERE predicted = c.cls)), 6) AS f1,
 (SELECT count(*) FROM b WHERE truth = c.cls) AS support FROM (SELECT DISTINCT truth AS cls FROM b) c""")
def _(t):
    return scoring.class_report(_conf_of_some(t))


@query("accuracy_missing", f"SELECT round(avg(CASE WHEN predicted = truth THEN 1.0 ELSE 0.0 END), 6) AS accuracy, count(*) AS n FROM {_BEST}")
def _(t):
    return scoring.accuracy(_conf_of_some(t))


_WEEKS = "(SELECT player_id, CAST(date_trunc('week', day) AS DATE) AS anchor, sum(hits)::BIGINT AS hits, sum(outs)::BIGINT AS outs, sum(exposure)::BIGINT AS exposure FROM {log} GROUP BY 1, 2)"


def _weeks(t):
    return aggregates.horizon_counts(t.log, "ts", 7, ["player_id"], ["hits", "outs", "exposure"])


@query("mae_rmse", f"""WITH x AS (SELECT anchor, CASE WHEN player_id % 7 <> 3 THEN hits END AS y, CASE WHEN player_id % 5 <> 1 THEN player_id % 3 + 0.5 END AS f FROM {_WEEKS})
 SELECT anchor, count(y + f) AS n, count(y) - count(y + f) AS unforecast, count(*) - count(y) AS unobserved, round(avg(abs(f - y)), 6) AS mae, round(sqrt(avg(power(f - y, 2))), 6) AS rmse FROM x GROUP BY 1""")
def _(t):
    """Some players have no forecast, and some no observed count."""
    w = _weeks(t)
    truth = w.select("player_id", "anchor", F.when(F.col("player_id") % 7 != 3, F.col("hits")).alias("y"))
    return scoring.mae_rmse(w.where("player_id % 5 <> 1").select("player_id", "anchor", (F.col("player_id") % 3 + 0.5).alias("y_hat")), truth, ["player_id", "anchor"], ["anchor"])


@query("ratio_mae", f"""WITH x AS (SELECT *, outs <> 0 AS good, player_id % 4 <> 2 AS has FROM {_WEEKS})
 SELECT count(*) FILTER (good AND has) AS n, count(*) FILTER (good AND NOT has) AS unforecast, count(*) FILTER (NOT good) AS unobserved, round(avg(abs(0.9 - hits / outs)) FILTER (good AND has), 6) AS mae,
 (sum(outs) FILTER (good AND has))::BIGINT AS den, round(count(*) FILTER (good AND has) / count(*), 6) AS coverage FROM x""")
def _(t):
    w = _weeks(t)
    return scoring.ratio_mae(w.where("player_id % 4 <> 2").select("player_id", "anchor", F.lit(0.9).alias("y_hat")), w.select("player_id", "anchor", F.col("hits").alias("num"), F.col("outs").alias("den")), ["player_id", "anchor"])


@query("log_score_dist", "SELECT count(*) AS n, round(avg(-ln(p)), 6) AS log_score FROM {pmf} j JOIN {final} f ON j.game_id = f.game_id AND j.k = f.home_runs")
def _(t):
    return scoring.log_score_dist(t.pmf, _runs(t), "game_id")


@query("crps_discrete", "SELECT count(*) AS n, 0 AS unforecast, 0 AS unobserved, round(avg(s), 6) AS crps, 0.0::DOUBLE AS unlisted FROM (SELECT game_id, sum(power(c - CASE WHEN home_runs <= k THEN 1 ELSE 0 END, 2)) AS s FROM (SELECT game_id, k, sum(p) OVER (PARTITION BY game_id ORDER BY k) AS c FROM {pmf}) JOIN {final} USING (game_id) GROUP BY 1)")
def _(t):
    return scoring.crps_discrete(t.pmf, _runs(t), "game_id")


@query("crps_discrete_gaps", """WITH s AS (SELECT game_id, k, w / CAST(16 + game_id % 3 AS DOUBLE) AS p FROM {final}, (VALUES (1, 4), (4, 6), (9, 6)) AS v(k, w) WHERE game_id % 9 <> 0),
 y AS (SELECT game_id, CASE WHEN game_id % 8 <> 5 THEN home_runs + CASE WHEN game_id % 11 = 0 THEN 7 ELSE 0 END END AS y FROM {final}),
 grid AS (SELECT y.game_id, y, g.x, CASE WHEN g.x >= 9 THEN 1.0 ELSE coalesce((SELECT sum(p) FROM s WHERE s.game_id = y.game_id AND s.k <= g.x), 0) END AS cdf FROM y, range(0, 20) g(x) WHERE y.game_id IN (SELECT game_id FROM s) AND y IS NOT NULL),
 each AS (SELECT game_id, sum(power(cdf - CASE WHEN y <= x THEN 1 ELSE 0 END, 2)) AS crps FROM grid GROUP BY 1)
 SELECT (SELECT count(*) FROM each) AS n, (SELECT count(*) FROM y WHERE y IS NOT NULL AND game_id % 9 = 0) AS unforecast, (SELECT count(*) FROM y WHERE y IS NULL) AS unobserved,
 (SELECT round(avg(crps), 6) FROM each) AS crps, (SELECT round(avg(1 - 16 / CAST(16 + game_id % 3 AS DOUBLE)), 6) FROM each) AS unlisted""")
def _(t):
    """Gaps in k, outcomes above the support, mass that isn't listed, games without a pmf or an outcome: equal to the sum over a dense grid."""
    some = t.final.where("game_id % 9 <> 0").select("game_id", F.explode(F.expr("array(struct(1 AS k, 4 AS w), struct(4 AS k, 6 AS w), struct(9 AS k, 6 AS w))")).alias("v"))
    pmf = some.select("game_id", "v.k", (F.col("v.w") / (16 + F.col("game_id") % 3)).alias("p"))
    y = F.when(F.col("game_id") % 8 != 5, F.col("home_runs") + F.when(F.col("game_id") % 11 == 0, 7).otherwise(0))
    return scoring.crps_discrete(pmf, t.final.select("game_id", y.alias("y")), "game_id")


@query("interval_score", """WITH x AS (SELECT CASE WHEN game_id % 7 <> 0 THEN home_runs END AS y, game_id % 3 AS lo, game_id % 3 + 3 AS hi, game_id % 4 <> 1 AS has FROM {final})
 SELECT count(y) FILTER (has) AS n, count(y) FILTER (NOT has) AS unforecast, count(*) - count(y) AS unobserved, round(avg(CASE WHEN y BETWEEN lo AND hi THEN 1.0 ELSE 0.0 END) FILTER (has AND y IS NOT NULL), 6) AS coverage, 3.0::DOUBLE AS width FROM x""")
def _(t):
    preds = t.final.where("game_id % 4 <> 1").select("game_id", (F.col("game_id") % 3).alias("lo"), (F.col("game_id") % 3 + 3).alias("hi"))
    return scoring.interval_score(preds, t.final.select("game_id", F.when(F.col("game_id") % 7 != 0, F.col("home_runs")).alias("y")), KEY)


_LOCATION = """WITH x AS (SELECT *, plate_x IS NOT NULL AND plate_z IS NOT NULL AS v, event_id % 8 <> 3 AS has, sqrt(power(50 - plate_x, 2) + power(25 - plate_z, 2)) AS d FROM {{pitch}})
 SELECT round(avg(abs(50 - plate_x)) FILTER (v AND has), 6) AS mae_x, round(avg(abs(25 - plate_z)) FILTER (v AND has), 6) AS mae_z, round(avg(d) FILTER (has), 6) AS mean_distance, {middle} AS median_distance,
 round(avg(CASE WHEN v THEN 1.0 ELSE 0.0 END), 6) AS valid_share, count(*) FILTER (NOT v) AS excluded, count(*) FILTER (v AND NOT has) AS unforecast FROM x"""


def _location(t, accuracy=None):
    truth = t.pitch.select("event_id", F.col("plate_x").alias("x"), F.col("plate_z").alias("z"))
    return scoring.location_error(t.pitch.where("event_id % 8 <> 3").select("event_id", F.lit(50.0).alias("x_hat"), F.lit(25.0).alias("z_hat")), truth, ["event_id"], accuracy)


@query("location_error", _LOCATION.format(middle="round(median(d) FILTER (has), 6)"))
def _(t):
    return _location(t)


# A sketch's median is one of the distances, whose rank is off by 1 in 10,000 at most: the query and the SQL say whether it is.
_RANK = """WITH x AS (SELECT sqrt(power(50 - plate_x, 2) + power(25 - plate_z, 2)) AS d FROM {pitch} WHERE event_id % 8 <> 3 AND plate_x IS NOT NULL AND plate_z IS NOT NULL)
 SELECT count(*) AS n, true AS below, true AS above FROM x"""


@query("location_error_sketch", _RANK)
def _(t):
    """The median of a sketch against the exact ranks: no more than half and a ten-thousandth of the distances lie on either side."""
    sketch = _location(t, 10_000).select("median_distance")
    d = F.sqrt(F.pow(50 - F.col("plate_x"), F.lit(2)) + F.pow(25 - F.col("plate_z"), F.lit(2)))
    rows = t.pitch.where("event_id % 8 <> 3 and plate_x is not null and plate_z is not null").select(d.alias("d")).crossJoin(F.broadcast(sketch))  # one row
    side = lambda c: F.count_if(c) <= F.count(F.lit(1)) * 0.5001 + 1
    return rows.agg(F.count(F.lit(1)).alias("n"), side(F.col("d") < F.col("median_distance")).alias("below"), side(F.col("d") > F.col("median_distance")).alias("above"))


_LINEUP = "(SELECT l_orderkey AS game, l_partkey AS player, min(l_linenumber) AS slot, min(CASE WHEN l_linenumber = 1 THEN 'P' WHEN l_suppkey % 2 = 0 THEN 'IF' ELSE 'OF' END) AS pos FROM {lineitem} GROUP BY 1, 2)"


@query("lineup_hits", f"WITH a AS {_LINEUP}, p AS (SELECT game, player, CASE WHEN player % 3 = 0 THEN slot ELSE slot % 4 + 1 END AS s, CASE WHEN player % 4 = 0 THEN 'IF' ELSE pos END AS q FROM a WHERE player % 5 > 1) SELECT a.game, count(*) AS players, count(p.player) AS roster_hits, count(*) FILTER (s = slot) AS slot_hits, count(*) FILTER (q = pos) AS position_hits, coalesce(max(CASE WHEN q = pos AND pos = 'P' THEN 1 END), 0)::BIGINT AS starter_hit FROM a LEFT JOIN p ON p.game = a.game AND p.player = a.player GROUP BY 1")
def _(t):
    position = F.when(F.col("l_linenumber") == 1, "P").when(F.col("l_suppkey") % 2 == 0, "IF").otherwise("OF")
    actual = t.lineitem.groupBy(F.col("l_orderkey").alias("game"), F.col("l_partkey").alias("player")).agg(F.min("l_linenumber").alias("slot"), F.min(position).alias("pos"))
    pred = actual.where("player % 5 > 1").withColumn("slot", F.when(F.col("player") % 3 == 0, F.col("slot")).otherwise(F.col("slot") % 4 + 1))
    pred = pred.withColumn("pos", F.when(F.col("player") % 4 == 0, "IF").otherwise(F.col("pos")))
    return scoring.lineup_hits(pred, actual, "game", "player", "slot", "pos", "P")


@query("candidate_hit_at_k", "WITH r AS (SELECT game_id, batter, row_number() OVER (PARTITION BY game_id ORDER BY count(*) DESC, batter) AS rank FROM {pitch} WHERE half_id < DATE '2024-01-15' GROUP BY 1, 2), a AS (SELECT DISTINCT game_id, batter FROM {pitch} WHERE half_id = DATE '2024-01-15') SELECT count(*) AS n, round(avg(CASE WHEN rank <= 2 THEN 1.0 ELSE 0.0 END), 6) AS hit_rate FROM a LEFT JOIN r USING (game_id, batter)")
def _(t):
    freq = aggregates.usage_frequency(t.pitch.where("half_id < '2024-01-15'"), ["game_id"], "batter")
    ranked = ranking.top_candidates(freq, ["game_id"], 4, [F.desc("n"), F.col("batter")])
    return scoring.candidate_hit_at_k(ranked, t.pitch.where("half_id = '2024-01-15'").select("game_id", "batter").distinct(), KEY, "batter", 2)


@query("compare_candidates", """WITH u AS (SELECT game_id FROM {final} WHERE game_id % 3 <> 0), f AS (SELECT * FROM {final} WHERE game_id IN (SELECT game_id FROM u))
 SELECT 'model' AS candidate, count(*) AS n, round(avg(-ln(p)), 6) AS log_loss, 1.0::DOUBLE AS coverage FROM {preds} p JOIN f ON p.game_id = f.game_id AND p.cls = f.truth
 UNION ALL SELECT 'uniform', count(*), round(-ln(1.0 / 3), 6), round(count(*) / (SELECT count(*) FROM {final}), 6) FROM f""")
def _(t):
    uniform = t.preds.where("game_id % 3 <> 0").withColumn("p", F.lit(1.0) / 3)
    return scoring.compare_candidates({"model": t.preds, "uniform": uniform}, _truth(t), KEY)


#: Weights of the bootstrap: thresholds of Poisson(1), as the rule gives them.
_CDF = [sum(math.exp(-1) / math.factorial(k) for k in range(n + 1)) for n in range(10)]
_U = "(('0x' || substr(md5({seed} || '/' || b || '/' || {cluster}), 1, 7))::BIGINT / 268435456.0)"


def _weight(cluster, seed="'1'"):
    u = _U.format(seed=seed, cluster=cluster)
    return "(" + " + ".join(f"CASE WHEN {u} >= {c!r} THEN 1 ELSE 0 END" for c in _CDF) + ")"


@query("bootstrap_compare", f"""WITH f AS (SELECT * FROM {{final}} WHERE game_id % 3 <> 0), s AS (SELECT 'model' AS candidate, f.season AS c, count(*) AS n, sum(-ln(p)) AS loss FROM {{preds}} p JOIN f ON p.game_id = f.game_id AND p.cls = f.truth GROUP BY 2
   UNION ALL SELECT 'uniform', season, count(*), count(*) * -ln(1.0 / 3) FROM f GROUP BY 2),
 d AS (SELECT candidate, b, sum(w * loss) / nullif(sum(w * n), 0) AS loss FROM (SELECT *, {_weight('c')} AS w FROM s, range(1, 201) r(b)) GROUP BY 1, 2),
 q AS (SELECT x.candidate, quantile_cont(x.loss - y.loss, 0.025) AS lo, quantile_cont(x.loss - y.loss, 0.975) AS hi FROM d x JOIN d y ON y.b = x.b AND y.candidate = 'uniform' GROUP BY 1),
 t AS (SELECT candidate, sum(n)::BIGINT AS n, count(*) AS clusters, sum(loss) / sum(n) AS l FROM s GROUP BY 1)
 SELECT candidate, n, clusters, round(l, 6) AS log_loss, round(l - (SELECT l FROM t WHERE candidate = 'uniform'), 6) AS difference, round(lo, 6) AS lo, round(hi, 6) AS hi FROM t JOIN q USING (candidate)""")
def _(t):
    """Is the model better than guessing, given that seasons differ?"""
    uniform = t.preds.where("game_id % 3 <> 0").withColumn("p", F.lit(1.0) / 3)
    return scoring.bootstrap_compare({"model": t.preds, "uniform": uniform}, _truth(t, "season"), KEY, "season", "uniform")


@query("select_setting", "SELECT setting, round(m, 6) AS score FROM (SELECT home_team::BIGINT AS setting, avg(away_runs) AS m FROM {final} WHERE season = 1999 GROUP BY 1) QUALIFY row_number() OVER (ORDER BY m, setting) = 1")
def _(t):
    scores = t.final.where("season >= 1999").groupBy(F.col("home_team").alias("setting"), F.when(F.col("season") == 1999, "validation").otherwise("test").alias("split")).agg(F.avg("away_runs").alias("score"))
    return scoring.select_setting(scores, "score")


@query("strata_report", "SELECT season::BIGINT AS season, stage, count(*) AS n, round(avg(ll), 6) AS ll, (2 * grouping(season) + grouping(stage))::BIGINT AS grouping FROM (SELECT f.*, -ln(p.p) AS ll FROM {preds} p JOIN {final} f ON p.game_id = f.game_id AND p.cls = f.truth) GROUP BY CUBE (season, stage)")
def _(t):
    scored = t.preds.join(t.final, "game_id").where("cls = truth").withColumn("ll", -F.log("p"))
    return scoring.strata_report(scored, ["season", "stage"], "ll")


@query("worst_cases", "SELECT season::BIGINT AS season, game_id, round(p, 6) AS p, row_number() OVER (PARTITION BY season ORDER BY p, game_id) AS rank FROM {preds} JOIN {final} USING (game_id) WHERE cls = truth QUALIFY rank <= 5")
def _(t):
    scored = t.preds.join(t.final, "game_id").where("cls = truth").withColumn("error", -F.col("p"))
    return scoring.worst_cases(scored, ["season"], "error", ["game_id"], 5).select("season", "game_id", "p", "rank")


@query("eval_record", "SELECT 'game' AS problem, 'log_loss' AS metric, 'v1' AS version, count(*) AS n, round(avg(-ln(p)), 6) AS log_loss FROM {preds} p JOIN {final} f ON p.game_id = f.game_id AND p.cls = f.truth")
def _(t):
    return scoring.eval_record(scoring.log_loss(t.preds, _truth(t), KEY), {"problem": "game", "metric": "log_loss", "version": "v1"}).select("context.*", "n", "log_loss")


@query("season_scores", """WITH x AS (SELECT *, rank <= 4 AS entered, (team + season) % 5 <> 2 AS has, CASE WHEN team % 3 = 0 THEN 0.7 ELSE 0.3 END AS p FROM {ranked} WHERE season < 2001)
 SELECT count(*) AS n, count(*) FILTER (NOT has) AS unforecast, round(avg(abs(wins + team % 4 - wins)) FILTER (has), 6) AS wins_mae, round(avg(abs(team + 1 - rank)) FILTER (has), 6) AS rank_mae,
 round(avg(CASE WHEN has THEN power(p - CASE WHEN entered THEN 1 ELSE 0 END, 2) ELSE 1 END), 6) AS brier, round(avg(CASE WHEN NOT has THEN -ln(1e-12) WHEN entered THEN -ln(p) ELSE -ln(1 - p) END), 6) AS log_loss FROM x""")
def _(t):
    """Some teams have no outlook: what happened to them had probability 0."""
    outlook = t.ranked.where("(team + season) % 5 <> 2").select("season", "team", (F.col("wins") + F.col("team") % 4).alias("wins_hat"), (F.col("team") + 1).alias("rank_hat"), F.when(F.col("team") % 3 == 0, 0.7).otherwise(0.3).alias("p_entry"))
    actual = t.ranked.select("season", "team", "wins", "rank", (F.col("rank") <= 4).alias("entered"), (F.col("season") < 2001).alias("completed"))
    return scoring.season_scores(outlook, actual)


# Value -----------------------------------------------------------------------------------------------------------


@query("joint_score", f"SELECT game_id, h::BIGINT AS h, a::BIGINT AS a, round(p, 6) AS p, 'independent' AS assumption FROM {_JOINT}")
def _(t):
    return _joint(t)


@query("wdl_from_scores", f"SELECT game_id, round(sum(CASE WHEN h > a THEN p ELSE 0 END), 6) AS p_home, round(sum(CASE WHEN h = a THEN p ELSE 0 END), 6) AS p_draw, round(sum(CASE WHEN h < a THEN p ELSE 0 END), 6) AS p_away FROM {_JOINT} GROUP BY 1")
def _(t):
    return value.wdl_from_scores(_joint(t))


@query("expected_score", "SELECT game_id, round(sum(k * p), 6) AS expected, floor(round(sum(k * p), 9) + 0.5)::BIGINT AS score, 'mean_rounded' AS rule FROM {pmf} GROUP BY 1")
def _(t):
    return value.expected_score(t.pmf, KEY)


_WP = "(SELECT state, runner, count(*) AS n, CASE WHEN count(*) >= 1100 THEN avg(y) ELSE (SELECT avg(CASE WHEN game_id % 2 = 0 THEN 1.0 ELSE 0.0 END) FROM {state}) END AS w FROM (SELECT *, CASE WHEN game_id % 2 = 0 THEN 1.0 ELSE 0.0 END AS y FROM {state}) GROUP BY 1, 2)"


def _wp(t):
    return value.state_win_rate(t.state.withColumn("y", F.when(F.col("game_id") % 2 == 0, 1.0).otherwise(0.0)), ["state", "runner"], "y", 1100)


@query("state_win_rate", f"SELECT state::BIGINT AS state, runner::BIGINT AS runner, n, round(w, 6) AS win_share FROM {_WP}")
def _(t):
    return _wp(t)


@query("wpa", f"WITH w AS {_WP}, s AS (SELECT game_id, ts, state, runner, lead(state) OVER o AS s2, lead(runner) OVER o AS r2 FROM {{state}} WINDOW o AS (PARTITION BY game_id ORDER BY ts)) SELECT game_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS at, round(b.w - a.w, 6) AS wpa FROM s LEFT JOIN w a ON a.state = s.state AND a.runner = s.runner LEFT JOIN w b ON b.state = s.s2 AND b.runner = s.r2")
def _(t):
    return value.wpa(t.state, _wp(t), "game_id", ["ts"], ["state", "runner"]).select("game_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("at"), "wpa")


@query("run_value", "WITH e AS (SELECT state, avg(rem) AS x FROM {state} GROUP BY 1), s AS (SELECT game_id, half_id, ts, runs, state, lead(state) OVER (PARTITION BY game_id, half_id ORDER BY ts) AS s2 FROM {state}) SELECT half, strftime(ts, '%Y-%m-%d %H:%M:%S') AS at, round(v - e1, 6) AS plain, round(v - e1 + runs, 6) AS with_runs FROM (SELECT s.game_id || '/' || s.half_id AS half, s.ts, s.runs, a.x AS e1, CASE WHEN s2 IS NULL THEN 0 ELSE b.x END AS v FROM s JOIN e a ON a.state = s.state LEFT JOIN e b ON b.state = s.s2)")
def _(t):
    states = t.state.withColumn("half", F.concat_ws("/", F.col("game_id").cast("string"), F.col("half_id").cast("string")))
    re = aggregates.run_expectancy(t.state, ["state"], "rem", 1)
    return value.run_value(states, re, "half", ["ts"], ["state"], "runs").select("half", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("at"), "plain", "with_runs")


# Every sixth state is unknown: that a state is unknown is told from that none follows.
_UNKNOWN = "(SELECT game_id, half_id, ts, runs, rem, CASE WHEN event_id % 6 <> 2 THEN state END AS state FROM {state})"


@query("run_value_unknown", f"""WITH u AS {_UNKNOWN}, e AS (SELECT state, avg(rem) AS x FROM u WHERE state IS NOT NULL GROUP BY 1), n AS (SELECT *, row_number() OVER (PARTITION BY game_id, half_id ORDER BY ts) AS i FROM u)
 SELECT a.game_id || '/' || a.half_id AS half, strftime(a.ts, '%Y-%m-%d %H:%M:%S') AS at, round(v - x, 6) AS plain, round(v - x + runs, 6) AS with_runs FROM (
   SELECT a.*, CASE WHEN b.i IS NULL THEN 0 ELSE (SELECT x FROM e WHERE e.state = b.state) END AS v FROM n a LEFT JOIN n b ON b.game_id = a.game_id AND b.half_id = a.half_id AND b.i = a.i + 1) a LEFT JOIN e ON e.state = a.state""")
def _(t):
    """Unknown states have no run expectancy, so changes from and to them are null; an ended half inning is worth 0."""
    states = t.state.withColumns({"half": F.concat_ws("/", F.col("game_id").cast("string"), F.col("half_id").cast("string")), "state": F.when(F.col("event_id") % 6 != 2, F.col("state"))})
    re = aggregates.run_expectancy(states.where("state is not null"), ["state"], "rem", 1)
    return value.run_value(states, re, "half", ["ts"], ["state"], "runs").select("half", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("at"), "plain", "with_runs")


@query("leverage", """WITH w AS (SELECT state, avg(CASE WHEN game_id % 2 = 0 THEN 1.0 ELSE 0.0 END) AS w FROM {state} GROUP BY 1), s AS (SELECT state, lead(state) OVER (PARTITION BY game_id ORDER BY ts) AS nx FROM {state}),
 t AS (SELECT state, nx, count(*) / sum(count(*)) OVER (PARTITION BY state) AS p FROM s WHERE nx IS NOT NULL GROUP BY 1, 2), g AS (SELECT t.state, sum(p * abs(b.w - a.w)) AS swing FROM t JOIN w a ON a.state = t.state JOIN w b ON b.state = t.nx GROUP BY 1)
 SELECT state::BIGINT AS state, round(swing, 6) AS swing, round(swing / avg(swing) OVER (), 6) AS leverage, 1.0::DOUBLE AS covered FROM g""")
def _(t):
    from hindcast.operators.joins import join_boundary_pair

    moves = join_boundary_pair(t.state, "game_id", ["ts"], ["state"]).where("post is not null").select("pre.state", F.col("post.state").alias("next"))
    trans = aggregates.usage_frequency(moves, ["state"], "next").withColumnRenamed("share", "p")
    wp = t.state.groupBy("state").agg(F.avg(F.when(F.col("game_id") % 2 == 0, 1.0).otherwise(0.0)).alias("win_share"))
    return value.leverage(trans, wp)


@query("leverage_unvalued", """WITH p AS (SELECT state, nx, count(*) AS c FROM (SELECT pitch_type * 10 + batter AS state, lead(pitch_type * 10 + batter) OVER (PARTITION BY game_id ORDER BY ts) AS nx FROM {pitch}) WHERE nx IS NOT NULL AND state % 10 <> nx % 10 GROUP BY 1, 2),
 w AS (SELECT state, CASE WHEN state <> 12 THEN state / 100.0 END AS v FROM p GROUP BY 1), x AS (SELECT p.state, c, abs(b.v - a.v) AS d FROM p JOIN w a ON a.state = p.state LEFT JOIN w b ON b.state = p.nx),
 g AS (SELECT state, CASE WHEN count(d) = count(*) THEN sum(c * d) / sum(c) END AS swing, coalesce(sum(c) FILTER (d IS NOT NULL), 0) / sum(c) AS covered FROM x GROUP BY 1)
 SELECT state::BIGINT AS state, round(swing, 6) AS swing, round(swing / (SELECT avg(swing) FROM g), 6) AS leverage, round(covered, 6)::DOUBLE AS covered FROM g""")
def _(t):
    """One state has no win value: states that lead to it have no swing, and say how much of theirs is covered."""
    from hindcast.operators.joins import join_boundary_pair

    states = t.pitch.select("game_id", "ts", (F.col("pitch_type") * 10 + F.col("batter")).alias("state"))
    moves = join_boundary_pair(states, "game_id", ["ts"], ["state"]).where("post is not null and pre.state % 10 <> post.state % 10").select("pre.state", F.col("post.state").alias("next"))
    trans = aggregates.usage_frequency(moves, ["state"], "next").withColumnRenamed("share", "p")
    return value.leverage(trans, moves.where("state <> 12").select("state").distinct().withColumn("win_share", F.col("state") / 100.0))


# Season ----------------------------------------------------------------------------------------------------------


@query("regular_title", "SELECT season::BIGINT AS season, team::BIGINT AS team, wins FROM {ranked} WHERE rank = 1")
def _(t):
    return season.regular_title(t.ranked).select("season", "team", "wins")


@query("postseason_entry", "SELECT season::BIGINT AS season, team::BIGINT AS team, rank::BIGINT AS rank FROM {ranked} WHERE rank <= CASE WHEN season < 1998 THEN 4 ELSE 5 END")
def _(t):
    rules = t.spark.sql("SELECT CAST(id AS INT) AS season, IF(id < 1998, 4, 5) AS slots FROM range(1990, 2010)")
    return season.postseason_entry(t.ranked, rules).select("season", "team", "rank")


_SERIES = "(SELECT series, stage, team, count(*) FILTER (won) AS wins FROM (SELECT season * 100 + least(home_team, away_team) * 10 + greatest(home_team, away_team) AS series, CASE WHEN (home_team + away_team) % 2 = 0 THEN 'final' ELSE 'first' END AS stage, unnest([home_team, away_team]) AS team, unnest([home_runs > away_runs, away_runs > home_runs]) AS won FROM {final}) GROUP BY 1, 2, 3)"


def _series(t):
    games = t.final.select((F.col("season") * 100 + F.least("home_team", "away_team") * 10 + F.greatest("home_team", "away_team")).alias("series"),
                           F.when((F.col("home_team") + F.col("away_team")) % 2 == 0, "final").otherwise("first").alias("stage"),
                           F.explode(F.array(F.struct(F.col("home_team").alias("team"), (F.col("home_runs") > F.col("away_runs")).alias("won")), F.struct(F.col("away_team").alias("team"), (F.col("away_runs") > F.col("home_runs")).alias("won")))).alias("x")).select("series", "stage", "x.*")
    rules = t.spark.sql("SELECT * FROM VALUES ('final', 12), ('first', 9) AS r(stage, target)")
    return season.series_result(games, rules)


@query("series_result", f"SELECT series::BIGINT AS series, stage, team::BIGINT AS team, wins, (CASE stage WHEN 'final' THEN 12 ELSE 9 END)::BIGINT AS target, wins >= CASE stage WHEN 'final' THEN 12 ELSE 9 END AS is_winner FROM {_SERIES}")
def _(t):
    return _series(t)


@query("final_champion", f"SELECT series::BIGINT AS series, team::BIGINT AS team FROM {_SERIES} WHERE stage = 'final' AND wins >= 12")
def _(t):
    return season.final_champion(_series(t), "final").select("series", "team")


@query("expected_wins", "WITH a AS (SELECT team, sum(wins)::BIGINT AS wins FROM {table} GROUP BY 1), r AS (SELECT team, sum(0.4 + (game_id % 3) * 0.1) AS rest FROM {team_game} WHERE status = 'O' GROUP BY 1) SELECT team::BIGINT AS team, wins, round(wins + rest, 6)::DOUBLE AS expected_wins FROM a JOIN r USING (team)")
def _(t):
    actual = t.table.groupBy("team").agg(F.sum("wins").alias("wins"))
    return season.expected_wins(actual, t.team_game.where("status = 'O'").select("team", (0.4 + (F.col("game_id") % 3) * 0.1).alias("p")))


# Written by Hall's condition over sets of teams, as bit masks: a set must have room for the games inside it. 4 slots.
_LOCK = """WITH t AS (SELECT season, team, wins FROM {{ranked}}), g AS (SELECT season, least(home_team, away_team) AS a, greatest(home_team, away_team) AS b, count(*) AS n FROM {{game}} WHERE {which} GROUP BY 1, 2, 3),
 x AS (SELECT t.season, t.team AS x, t.wins AS xw, o.team, o.wins, coalesce((SELECT sum(n) FROM g WHERE g.season = t.season AND t.team IN (a, b) AND o.team IN (a, b)), 0) AS own,
   coalesce((SELECT sum(n) FROM g WHERE g.season = t.season AND o.team IN (a, b) AND t.team NOT IN (a, b)), 0) AS rest, coalesce((SELECT sum(n) FROM g WHERE g.season = t.season AND t.team IN (a, b)), 0) AS xleft
   FROM t JOIN t o ON o.season = t.season AND o.team <> t.team),
 room AS (SELECT season, x, team, rest - greatest(0, xw - wins - own) AS up, xw + xleft - wins AS down FROM x),
 u AS (SELECT m FROM range(1, 1024) r(m)),
 inside AS (SELECT s.season, m, coalesce((SELECT sum(n) FROM g WHERE g.season = s.season AND (m >> a) & 1 = 1 AND (m >> b) & 1 = 1), 0) AS games FROM (SELECT DISTINCT season FROM t) s CROSS JOIN u),
 sets AS (SELECT r.season, r.x, u.m, sum(up) FILTER ((u.m >> team) & 1 = 1) AS up, sum(down) FILTER ((u.m >> team) & 1 = 1) AS down FROM room r CROSS JOIN u WHERE (u.m >> r.x) & 1 = 0 GROUP BY 1, 2, 3),
 bad AS (SELECT season, x, m, games > up AS no_up, games > down AS no_down FROM sets JOIN inside USING (season, m) WHERE games > up OR games > down),
 chosen AS (SELECT season, x, c.m, bit_count(c.m) AS size FROM (SELECT DISTINCT season, x FROM room) CROSS JOIN u c WHERE (c.m >> x) & 1 = 0 AND bit_count(c.m) IN (4, 6)),
 good AS (SELECT c.season, c.x, bool_or(size = 4 AND NOT no_up) AS up, bool_or(size = 6 AND NOT no_down) AS down FROM (
   SELECT c.season, c.x, c.m, size, coalesce(bool_or(no_up), false) AS no_up, coalesce(bool_or(no_down), false) AS no_down FROM chosen c LEFT JOIN bad b ON b.season = c.season AND b.x = c.x AND b.m & c.m = b.m GROUP BY 1, 2, 3, 4) c GROUP BY 1, 2),
 bounds AS (SELECT season, x, count(*) FILTER (wins + own + rest >= xw) AS can_reach, count(*) FILTER (wins > xw + xleft) AS beyond FROM x GROUP BY 1, 2)
 SELECT season::BIGINT AS season, x::BIGINT AS team, can_reach, beyond, CASE WHEN NOT up THEN 'clinched' WHEN NOT down THEN 'eliminated' ELSE 'open' END AS status FROM bounds JOIN good USING (season, x)"""


def _lock(t, which):
    return season.lock_status(t.ranked.select("season", "team", "wins"), t.game.where(which).select("season", F.col("home_team").alias("home"), F.col("away_team").alias("away")), 4)


@query("lock_status", _LOCK.format(which="status = 'P'"))
def _(t):
    return _lock(t, "status = 'P'")


_FEW = "status = 'O' AND game_id % 64 = 1"


@query("lock_status_late", _LOCK.format(which=_FEW))
def _(t):
    """Seasons with other games to come."""
    return _lock(t, _FEW)


_PAIRS = "(SELECT team, opponent, count(*) AS n, avg(CASE WHEN runs > allowed THEN 1.0 ELSE 0.0 END) AS w FROM {team_game} WHERE status = 'F' GROUP BY 1, 2)"


@query("advance_probability", f"SELECT team::BIGINT AS team, round(sum(n / t * w), 6) AS p_advance, 1.0::DOUBLE AS covered FROM (SELECT *, sum(n) OVER (PARTITION BY team) AS t FROM {_PAIRS}) GROUP BY 1")
def _(t):
    games = t.team_game.where("status = 'F'")
    meet = aggregates.usage_frequency(games, ["team"], "opponent").withColumnRenamed("share", "p_meet")
    cond = games.groupBy("team", "opponent").agg(F.avg(F.when(F.col("runs") > F.col("allowed"), 1.0).otherwise(0.0)).alias("p_win"))
    return season.advance_probability(meet, cond)


@query("advance_probability_open", f"SELECT team::BIGINT AS team, CASE WHEN count(*) FILTER (opponent = 7) = 0 THEN round(sum(n / t * w), 6) END AS p_advance, round(coalesce(sum(n) FILTER (opponent <> 7), 0) / sum(n), 6)::DOUBLE AS covered FROM (SELECT *, sum(n) OVER (PARTITION BY team) AS t FROM {_PAIRS}) GROUP BY 1")
def _(t):
    """No chances against one opponent are known: who may meet it has no probability to advance."""
    games = t.team_game.where("status = 'F'")
    meet = aggregates.usage_frequency(games, ["team"], "opponent").withColumnRenamed("share", "p_meet")
    cond = games.where("opponent <> 7").groupBy("team", "opponent").agg(F.avg(F.when(F.col("runs") > F.col("allowed"), 1.0).otherwise(0.0)).alias("p_win"))
    return season.advance_probability(meet, cond)


_RANKED_DRAWS_BY_REPEAT = "(SELECT *, rank() OVER (PARTITION BY repeat, draw_id ORDER BY wins DESC, team) AS r FROM {draws})"
_RANKED_DRAWS = "(SELECT *, rank() OVER (PARTITION BY draw_id ORDER BY wins DESC, team) AS r FROM {draws})"


@query("outlook_from_draws", f"SELECT team::BIGINT AS team, count(*) AS draws, round(avg(wins), 6) AS wins, round(avg(r), 6) AS mean_rank, round(avg(CASE WHEN r <= 4 THEN 1.0 ELSE 0.0 END), 6) AS p_entry, round(avg(CASE WHEN r = 1 THEN 1.0 ELSE 0.0 END), 6) AS p_title FROM {_RANKED_DRAWS} GROUP BY 1")
def _(t):
    return season.outlook_from_draws(t.draws, 4, [F.desc("wins"), F.col("team")])


@query("draw_stability", f"SELECT team::BIGINT AS team, count(*) AS repeats, round(avg(p), 6) AS mean, round(stddev_samp(p), 6) AS spread FROM (SELECT repeat, team, avg(CASE WHEN r = 1 THEN 1.0 ELSE 0.0 END) AS p FROM {_RANKED_DRAWS} GROUP BY 1, 2) GROUP BY 1")
def _(t):
    return season.draw_stability(t.draws, [F.desc("wins"), F.col("team")])


@query("draw_intervals", f"""WITH p AS (SELECT team, repeat, count(*) AS n, count(*) FILTER (r = 1) AS titles FROM {_RANKED_DRAWS_BY_REPEAT} GROUP BY 1, 2),
 d AS (SELECT team, b, sum(w * titles) / nullif(sum(w * n), 0) AS p FROM (SELECT *, {_weight('repeat', "'7'")} AS w FROM p, range(1, 101) r(b)) GROUP BY 1, 2),
 q AS (SELECT team, quantile_cont(p, 0.05) AS lo, quantile_cont(p, 0.95) AS hi FROM d GROUP BY 1), t AS (SELECT team, count(*) AS repeats, sum(titles) / sum(n) AS p FROM p GROUP BY 1)
 SELECT team::BIGINT AS team, repeats, round(p, 6) AS p_title, round(lo, 6) AS lo, round(hi, 6) AS hi FROM t JOIN q USING (team)""")
def _(t):
    return season.draw_intervals(t.draws, [F.desc("wins"), F.col("team")], replicates=100, level=0.9, seed=7)


@query("replay_fixed", "SELECT d.draw_id::BIGINT AS draw_id, g.game_id, coalesce(f.truth, d.cls) AS cls, f.truth IS NOT NULL AS is_fixed FROM {game} g CROSS JOIN (SELECT 1 AS draw_id, 'H' AS cls UNION ALL SELECT 2, 'A') d LEFT JOIN {final} f ON f.game_id = g.game_id")
def _(t):
    drawn = t.game.select("game_id", F.explode(F.expr("array(named_struct('draw_id', 1L, 'cls', 'H'), named_struct('draw_id', 2L, 'cls', 'A'))")).alias("d")).select("game_id", "d.*")
    return season.replay_fixed(drawn, t.final.select("game_id", F.col("truth").alias("cls")))


# Estimators: no SQL equal ----------------------------------------------------------------------------------------


def _team_rows(t):
    return t.team_game.where("status = 'F'").select("game_id", "game_date", "side", "team", F.col("runs").cast("double"), (F.col("side") == "home").cast("double").alias("is_home"), (F.col("team") % 5).cast("double").alias("f1"), (F.col("opponent") % 4).cast("double").alias("f2"), (F.col("runs") > F.col("allowed")).cast("double").alias("won"))


def _pitch_rows(t):
    return t.pitch.select("event_id", "half_id", F.col("pitch_result").alias("cls"), F.concat_ws("/", F.col("pitch_type").cast("string"), "pitch_result").alias("joint"), F.col("batter").cast("double").alias("f1"), F.col("runner").cast("double").alias("f2"), "plate_x", "plate_z")


@query("fit_runs")
def _(t):
    rows = _team_rows(t)
    model = estimators.fit_runs(rows.where(F.col("game_date") < cut()), ["is_home", "f1", "f2"])
    return model.transform(rows.where(F.col("game_date") >= cut())).select("game_id", "side", "prediction")


@query("fit_pa")
def _(t):
    rows = _pitch_rows(t)
    return estimators.class_probabilities(estimators.fit_pa(rows.where("half_id < '2024-01-15'"), ["f1", "f2"]), rows.where("half_id >= '2024-01-15'"), ["event_id"])


def _player_rows(t):
    w = _weeks(t).unpivot(["player_id", "anchor"], ["hits", "outs", "exposure"], "stat", "y")
    return w.select("player_id", "anchor", F.when(F.col("player_id") % 2 == 0, "batter").otherwise("pitcher").alias("role"), "stat", F.col("y").cast("double"), (F.col("stat") == "hits").cast("double").alias("is_hits"), (F.col("stat") == "outs").cast("double").alias("is_outs"), (F.col("player_id") % 5).cast("double").alias("f1"))


@query("fit_player")
def _(t):
    rows = _player_rows(t)
    model = estimators.fit_player(rows.where("anchor < '2024-01-22'"), "batter", ["is_hits", "is_outs", "f1"])
    return model.transform(rows.where("anchor >= '2024-01-22' and role = 'batter'")).select("player_id", "anchor", "stat", "prediction")


@query("fit_win")
def _(t):
    from pyspark.ml.functions import vector_to_array

    rows = _team_rows(t)
    model = estimators.fit_win(rows.where(F.col("game_date") < cut()), ["is_home", "f1", "f2"])
    return model.transform(rows.where(F.col("game_date") >= cut())).select("game_id", "side", vector_to_array("probability")[1].alias("p"))


@query("fit_pitch")
def _(t):
    rows = _pitch_rows(t)
    joint, _ = estimators.fit_pitch(rows.where("half_id < '2024-01-15'"), ["f1", "f2"])
    return estimators.class_probabilities(joint, rows.where("half_id >= '2024-01-15'"), ["event_id"])


_ISO = "SELECT game_id, p, season, CASE WHEN truth = 'H' THEN 1.0 ELSE 0.0 END AS y FROM {preds} JOIN {final} USING (game_id) WHERE cls = 'H'"


@query("calibrate_isotonic", f"""WITH r AS ({_ISO}), tr AS (SELECT p, count(*) AS w, sum(y) AS s FROM r WHERE season < 1998 GROUP BY p),
 seg AS (SELECT a.p AS lo, b.p AS hi, (SELECT sum(s) / sum(w) FROM tr c WHERE c.p BETWEEN a.p AND b.p) AS m FROM tr a JOIN tr b ON a.p <= b.p),
 least AS (SELECT tr.p, lo, min(m) AS m FROM tr JOIN seg ON lo <= tr.p AND hi >= tr.p GROUP BY 1, 2), iso AS (SELECT p, max(m) AS calibrated FROM least GROUP BY 1)
 SELECT game_id, round(p, 6) AS p, round(calibrated, 6) AS calibrated FROM r JOIN iso USING (p) WHERE season >= 1998""")
def _(t):
    rows = t.preds.where("cls = 'H'").join(t.final, "game_id").select("game_id", "p", "season", (F.col("truth") == "H").alias("y"))
    return estimators.calibrate_isotonic(rows.where("season < 1998"), rows.where("season >= 1998")).select("game_id", "p", "calibrated")


@query("linear_contributions")
def _(t):
    rows = _team_rows(t)
    train = rows.where(F.col("game_date") < cut())
    names = ["is_home", "f1", "f2"]
    coefficients = estimators.fit_runs(train, names).stages[-1].coefficients.toArray().tolist()
    return estimators.linear_contributions(rows, coefficients, train.agg(*[F.avg(c).alias(c) for c in names]), names, ["game_id", "side"])


_SIDES = "(SELECT *, CASE WHEN side = 'home' THEN 1.0 ELSE 0.0 END AS is_home, CAST(team % 5 AS DOUBLE) AS f1, CAST(opponent % 4 AS DOUBLE) AS f2 FROM {team_game} WHERE status = 'F')"
_SLOPES = " UNION ALL ".join(f"SELECT game_id, side, '{c}' AS feature, (SELECT regr_slope(runs, {c}) FROM tr) * ({c} - (SELECT avg({c}) FROM tr)) AS contribution FROM r" for c in ("is_home", "f1", "f2"))


def _slope_contributions(t):
    rows, names = _team_rows(t), ["is_home", "f1", "f2"]
    train = rows.where(F.col("game_date") < cut())
    slopes = list(train.agg(*[F.regr_slope("runs", c) for c in names]).first())
    return estimators.linear_contributions(rows, slopes, train.agg(*[F.avg(c).alias(c) for c in names]), names, ["game_id", "side"])


@query("linear_contributions_slopes", f"WITH r AS {_SIDES}, tr AS (SELECT * FROM r WHERE game_date < DATE '1998-01-01'), c AS ({_SLOPES}) SELECT game_id, side, feature, round(contribution, 6) AS contribution FROM c")
def _(t):
    """Contributions under one-feature slopes, which SQL knows too."""
    return _slope_contributions(t)


@query("mean_contributions", f"WITH r AS {_SIDES}, tr AS (SELECT * FROM r WHERE game_date < DATE '1998-01-01'), c AS ({_SLOPES}) SELECT feature, round(avg(abs(contribution)), 6) AS mean_abs FROM c GROUP BY 1")
def _(t):
    return estimators.mean_contributions(_slope_contributions(t))


@query("fit_runs_by_side", f"WITH r AS {_SIDES} SELECT game_id, side, round((SELECT avg(runs) FROM r x WHERE x.side = r.side AND x.game_date < DATE '1998-01-01'), 3) AS prediction FROM r WHERE game_date >= DATE '1998-01-01'")
def _(t):
    """With the side alone, a Poisson model gives each side's mean."""
    rows = _team_rows(t)
    model = estimators.fit_runs(rows.where(F.col("game_date") < cut()), ["is_home"])
    return model.transform(rows.where(F.col("game_date") >= cut())).select("game_id", "side", F.round("prediction", 3).alias("prediction"))


# Score equations of each fit: totals of the outcome by feature, which SQL knows, are those of the fitted values ------


def _totals(source, outcomes, features, where):
    """SQL of score_balance: n and the observed totals; the fit has to balance them."""
    return f"WITH r AS {source}, tr AS (SELECT * FROM r WHERE {where}) " + " UNION ALL ".join(
        f"SELECT '{name}' AS outcome, '{c}' AS feature, count({y}) AS n, round(sum({y} * {c or '1.0'}), 6)::DOUBLE AS observed, true AS balanced FROM tr" for name, y in outcomes.items() for c in ("", *features))


_RUNS_BEFORE = "game_date < DATE '1998-01-01'"
_THREE = ["is_home", "f1", "f2"]


@query("fit_runs_balance", _totals(_SIDES, {"runs": "runs"}, _THREE, _RUNS_BEFORE))
def _(t):
    train = _team_rows(t).where(F.col("game_date") < cut())
    fitted = estimators.fit_runs(train, _THREE).transform(train)
    return estimators.score_balance(fitted, _THREE, {"runs": (F.col("runs"), F.col("prediction"))}).drop("fitted")


@query("fit_win_balance", _totals(_SIDES, {"won": "CASE WHEN runs > allowed THEN 1.0 ELSE 0.0 END"}, _THREE, _RUNS_BEFORE))
def _(t):
    from pyspark.ml.functions import vector_to_array

    train = _team_rows(t).where(F.col("game_date") < cut())
    fitted = estimators.fit_win(train, _THREE).transform(train)
    return estimators.score_balance(fitted, _THREE, {"won": (F.col("won"), vector_to_array("probability")[1])}).drop("fitted")


_PLAYER_SQL = f"(SELECT anchor, stat, y, CASE WHEN stat = 'hits' THEN 1.0 ELSE 0.0 END AS is_hits, CASE WHEN stat = 'outs' THEN 1.0 ELSE 0.0 END AS is_outs, CAST(player_id % 5 AS DOUBLE) AS f1 FROM (SELECT player_id, anchor, unnest(['hits', 'outs', 'exposure']) AS stat, unnest([hits, outs, exposure]) AS y FROM {_WEEKS}) WHERE player_id % 2 = 0)"


@query("fit_player_balance", _totals(_PLAYER_SQL, {"y": "y"}, ["is_hits", "is_outs", "f1"], "anchor < DATE '2024-01-22'"))
def _(t):
    names, train = ["is_hits", "is_outs", "f1"], _player_rows(t).where("role = 'batter' and anchor < '2024-01-22'")
    fitted = estimators.fit_player(train, "batter", names).transform(train)
    return estimators.score_balance(fitted, names, {"y": (F.col("y"), F.col("prediction"))}).drop("fitted")


_PITCH_SQL = "(SELECT half_id, pitch_result AS cls, pitch_type || '/' || pitch_result AS joint, CAST(batter AS DOUBLE) AS f1, CAST(runner AS DOUBLE) AS f2, plate_x, plate_z FROM {pitch})"
_EARLY = "half_id < DATE '2024-01-15'"


def _class_totals(label):
    """SQL of class_balance, an outcome per class that the training rows have."""
    return f"WITH r AS {_PITCH_SQL}, tr AS (SELECT * FROM r WHERE {_EARLY}), k AS (SELECT DISTINCT {label} AS c FROM tr) " + " UNION ALL ".join(
        f"SELECT c AS outcome, '{x}' AS feature, count(*) AS n, round(sum(CASE WHEN {label} = c THEN {x or '1.0'} ELSE 0 END), 6)::DOUBLE AS observed, true AS balanced FROM tr, k GROUP BY 1" for x in ("", "f1", "f2"))


@query("fit_pa_balance", _class_totals("cls"))
def _(t):
    train = _pitch_rows(t).where("half_id < '2024-01-15'")
    return estimators.class_balance(estimators.fit_pa(train, ["f1", "f2"]), train, ["f1", "f2"], "cls").drop("fitted")


@query("fit_pitch_balance", _class_totals("joint"))
def _(t):
    train = _pitch_rows(t).where("half_id < '2024-01-15'")
    return estimators.class_balance(estimators.fit_pitch(train, ["f1", "f2"])[0], train, ["f1", "f2"], "joint").drop("fitted")


_LONG_SQL = _PITCH_SQL.replace("(SELECT half_id", "(SELECT half_id, coordinate, axis, f1, f2, axis AS is_second, f1 * axis AS f1_x_axis, f2 * axis AS f2_x_axis FROM (SELECT half_id", 1).replace("plate_x, plate_z FROM", "unnest([plate_x, plate_z]) AS coordinate, unnest([0.0, 1.0]) AS axis FROM")[:-1] + ") WHERE coordinate IS NOT NULL)"


@query("fit_location_balance", _totals(_LONG_SQL, {"coordinate": "coordinate"}, ["f1", "f2", "is_second", "f1_x_axis", "f2_x_axis"], _EARLY))
def _(t):
    train = _pitch_rows(t).where("half_id < '2024-01-15'")
    _, model = estimators.fit_pitch(train, ["f1", "f2"])
    long, names = estimators.location_rows(train, ["f1", "f2"])
    return estimators.score_balance(model.transform(long), names, {"coordinate": (F.col("coordinate"), F.col("prediction"))}).drop("fitted")


# Least squares of three features by Cramer's rule, for contributions under coefficients that SQL knows.
_COV = "SELECT " + ", ".join(f"covar_pop({a}, {b}) AS s{i}{j}" for i, a in enumerate(_THREE) for j, b in enumerate(_THREE)) + ", " + ", ".join(f"covar_pop({a}, runs) AS r{i}, avg({a}) AS m{i}" for i, a in enumerate(_THREE)) + " FROM tr"


def _det(columns):
    a, b, c = columns
    return f"({a[0]} * ({b[1]} * {c[2]} - {b[2]} * {c[1]}) - {b[0]} * ({a[1]} * {c[2]} - {a[2]} * {c[1]}) + {c[0]} * ({a[1]} * {b[2]} - {a[2]} * {b[1]}))"


_S = [[f"s{i}{j}" for i in range(3)] for j in range(3)]
_COEFFICIENT = [f"{_det([['r0', 'r1', 'r2'] if k == j else _S[k] for k in range(3)])} / {_det(_S)}" for j in range(3)]


@query("linear_contributions_least_squares", f"WITH r AS {_SIDES}, tr AS (SELECT * FROM r WHERE {_RUNS_BEFORE}), v AS ({_COV}) " + " UNION ALL ".join(f"SELECT game_id, side, '{c}' AS feature, round({_COEFFICIENT[j]} * ({c} - m{j}), 6) AS contribution FROM r, v" for j, c in enumerate(_THREE)))
def _(t):
    """Contributions under a fitted linear model of all features."""
    rows = _team_rows(t)
    train = rows.where(F.col("game_date") < cut())
    coefficients = estimators.fit_linear(train, _THREE, "runs").stages[-1].coefficients.toArray().tolist()
    return estimators.linear_contributions(rows, coefficients, train.agg(*[F.avg(c).alias(c) for c in _THREE]), _THREE, ["game_id", "side"])


# Each estimator beside the baseline of its problem, on the samples both cover ------------------------------------


def _beside(model, base, truth, key):
    """mae and rmse of both, on the same rows."""
    both = truth.join(model.select(*key), key, "left_semi").join(base.select(*key), key, "left_semi")
    rows = [scoring.mae_rmse(p, both, key, []).select(F.lit(n).alias("candidate"), "n", "mae", "rmse") for n, p in (("model", model), ("baseline", base))]
    return rows[0].unionByName(rows[1])


@query("fit_runs_against_baseline")
def _(t):
    rows = _team_rows(t)
    train, test = rows.where(F.col("game_date") < cut()), rows.where(F.col("game_date") >= cut())
    model = estimators.fit_runs(train, ["is_home", "f1", "f2"]).transform(test).select("game_id", "side", F.col("prediction").alias("y_hat"))
    base = test.select("game_id", "side").crossJoin(F.broadcast(aggregates.point_baseline(train, "runs").select(F.col("mean").alias("y_hat"))))  # one row
    return _beside(model, base, test.select("game_id", "side", F.col("runs").alias("y")), ["game_id", "side"])


@query("fit_player_against_baseline")
def _(t):
    rows = _player_rows(t).where("role = 'batter'")
    train, test, key = rows.where("anchor < '2024-01-22'"), rows.where("anchor >= '2024-01-22'"), ["player_id", "anchor", "stat"]
    model = estimators.fit_player(train, "batter", ["is_hits", "is_outs", "f1"]).transform(test).select(*key, F.col("prediction").alias("y_hat"))
    base = test.select(*key).join(aggregates.point_baseline(train, "y", ["stat"]).select("stat", F.col("mean").alias("y_hat")), "stat")
    return _beside(model, base, test.select(*key, "y"), key)


@query("fit_win_against_baseline")
def _(t):
    from pyspark.ml.functions import vector_to_array

    rows, key = _team_rows(t).withColumn("truth", F.col("won").cast("int").cast("string")), ["game_id", "side"]
    train, test = rows.where(F.col("game_date") < cut()), rows.where(F.col("game_date") >= cut())
    p = estimators.fit_win(train, ["is_home", "f1", "f2"]).transform(test).select(*key, F.posexplode(vector_to_array("probability")).alias("cls", "p"))
    model = p.select(*key, F.col("cls").cast("string").alias("cls"), "p")
    return scoring.compare_candidates({"model": model, "baseline": baselines.base_rate_forecast(train, test, key, "truth")}, test.select(*key, "truth"), key)


def _classes_against_baseline(t, label, fitted):
    rows = _pitch_rows(t)
    train, test = rows.where("half_id < '2024-01-15'"), rows.where("half_id >= '2024-01-15'")
    model = estimators.class_probabilities(fitted(train), test, ["event_id"])
    truth = test.select("event_id", F.col(label).alias("truth"))
    return scoring.compare_candidates({"model": model, "baseline": baselines.base_rate_forecast(train, test, ["event_id"], label)}, truth, ["event_id"])


@query("fit_pa_against_baseline")
def _(t):
    return _classes_against_baseline(t, "cls", lambda train: estimators.fit_pa(train, ["f1", "f2"]))


@query("fit_pitch_against_baseline")
def _(t):
    return _classes_against_baseline(t, "joint", lambda train: estimators.fit_pitch(train, ["f1", "f2"])[0])
