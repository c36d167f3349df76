"""Queries of aggregations, windows, ranks, labels and splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from hindcast.operators import aggregates, labels, ranking, splits, windows
from hindcast.plans.registry import query


def cut():
    return F.lit("1998-01-01").cast("date")

PA = ["game_id", "half_id", "pa_id"]
_PA = """WITH pa AS (SELECT *, coalesce(sum(ends_pa) OVER (PARTITION BY game_id, half_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS pa_id FROM {pitch}) """


def _pa(t):
    return windows.assign_pa(t.pitch, ["game_id", "half_id"], ["ts"], "ends_pa")


# Aggregations ----------------------------------------------------------------------------------------------------


@query("collapse_pa", _PA + "SELECT game_id, half_id, pa_id, min_by(pitch_type, ts)::BIGINT AS start_pitch_type, max_by(pitch_result, ts) AS result, count(*) AS pitches FROM pa GROUP BY 1, 2, 3")
def _(t):
    return aggregates.collapse_pa(_pa(t), PA, F.col("ts"), ["pitch_type"], "pitch_result")


for _n in (7, 28):

    @query(f"horizon_counts_{_n}d", f"SELECT player_id, anchor, sum(hits)::BIGINT AS hits, sum(exposure)::BIGINT AS exposure FROM {{log}} JOIN (SELECT DATE '2024-01-01' + 7 * i::INT AS anchor FROM range(-4, 6) r(i)) ON day >= anchor AND day < anchor + {_n} GROUP BY 1, 2")
    def _(t, days=_n):
        return aggregates.horizon_counts(t.log, "ts", days, ["player_id"], ["hits", "exposure"])


@query("season_to_date", "SELECT player_id, sum(hits)::BIGINT AS hits, sum(exposure)::BIGINT AS exposure FROM {log} WHERE day < DATE '2024-01-20' GROUP BY 1")
def _(t):
    return aggregates.season_to_date(t.log, "day", F.lit("2024-01-20").cast("date"), ["player_id"], ["hits", "exposure"])


@query("ratio", "SELECT player_id, day, sum(hits)::BIGINT AS num, sum(outs)::BIGINT AS den, round(sum(hits) / nullif(sum(outs), 0), 6) AS value, CASE WHEN sum(outs) = 0 THEN 'zero denominator' END AS reason FROM {log} GROUP BY 1, 2")
def _(t):
    return aggregates.ratio(t.log, ["player_id", "day"], "hits", "outs")


@query("outs_to_innings", "SELECT player_id, sum(outs)::BIGINT AS outs, (sum(outs) // 3)::BIGINT AS innings, (sum(outs) % 3)::BIGINT AS thirds FROM {log} GROUP BY 1")
def _(t):
    return aggregates.outs_to_innings(t.log, ["player_id"])


@query("season_projection", "WITH a AS (SELECT player_id, sum(hits) AS h, sum(exposure) AS e FROM {log} WHERE day < DATE '2024-01-02' GROUP BY 1), r AS (SELECT player_id, sum(hits) * 0.5 AS h, sum(exposure) * 0.5 AS e FROM {log} WHERE day >= DATE '2024-01-02' GROUP BY 1) SELECT player_id, round(coalesce(a.h, 0) + coalesce(r.h, 0), 6)::DOUBLE AS hits, round(coalesce(a.e, 0) + coalesce(r.e, 0), 6)::DOUBLE AS exposure, round((coalesce(a.h, 0) + coalesce(r.h, 0)) / (coalesce(a.e, 0) + coalesce(r.e, 0)), 6) AS value FROM a FULL JOIN r USING (player_id)")
def _(t):
    d = F.lit("2024-01-02").cast("date")
    actual = aggregates.season_to_date(t.log, "day", d, ["player_id"], ["hits", "exposure"])
    rest = t.log.where(F.col("day") >= d).groupBy("player_id").agg((F.sum("hits") * 0.5).alias("hits"), (F.sum("exposure") * 0.5).alias("exposure"))
    return aggregates.season_projection(actual, rest, "player_id", "hits", "exposure")


@query("base_rate", "SELECT truth, count(*) AS n, (sum(count(*)) OVER ())::BIGINT AS total, round(count(*) / sum(count(*)) OVER (), 6) AS p FROM {final} WHERE game_date < DATE '1998-01-01' GROUP BY 1")
def _(t):
    return aggregates.base_rate(t.final.where(F.col("game_date") < cut()), "truth")


@query("conditional_rate", """WITH tr AS (SELECT * FROM {final} WHERE game_date < DATE '1998-01-01'), cl AS (SELECT DISTINCT truth FROM tr),
 g AS (SELECT DISTINCT home_team, away_team FROM tr), f AS (SELECT home_team, away_team, truth, count(*) AS n FROM tr GROUP BY ALL),
 x AS (SELECT g.home_team, g.away_team, cl.truth, coalesce(f.n, 0) AS n0, (SELECT sum(n) FROM f f2 WHERE f2.home_team = g.home_team AND f2.away_team = g.away_team) AS t0,
  coalesce((SELECT sum(n) FROM f f3 WHERE f3.home_team = g.home_team AND f3.truth = cl.truth), 0) AS n1, (SELECT sum(n) FROM f f4 WHERE f4.home_team = g.home_team) AS t1,
  coalesce((SELECT sum(n) FROM f f5 WHERE f5.truth = cl.truth), 0) AS n2, (SELECT sum(n) FROM f) AS t2
  FROM g CROSS JOIN cl LEFT JOIN f ON f.home_team = g.home_team AND f.away_team = g.away_team AND f.truth = cl.truth)
 SELECT home_team::BIGINT AS home_team, away_team::BIGINT AS away_team, truth, round(CASE WHEN t0 >= 24 THEN (n0 + 0.5) / (t0 + 1.5) WHEN t1 >= 24 THEN (n1 + 0.5) / (t1 + 1.5) ELSE (n2 + 0.5) / (t2 + 1.5) END, 6)::DOUBLE AS p, (CASE WHEN t0 >= 24 THEN 0 WHEN t1 >= 24 THEN 1 ELSE 2 END)::BIGINT AS level FROM x""")
def _(t):
    return aggregates.conditional_rate(t.final.where(F.col("game_date") < cut()), "truth", [["home_team", "away_team"], ["home_team"]], 24, 0.5)


@query("conditional_rate_missing", """WITH tr AS (SELECT home_team, nullif(away_team, 3) AS away_team, CASE WHEN game_id % 9 <> 0 THEN truth END AS truth FROM {final} WHERE game_date < DATE '1998-01-01'), cl AS (SELECT DISTINCT truth FROM tr),
 g AS (SELECT DISTINCT home_team, away_team FROM tr), x AS (SELECT g.home_team, g.away_team, cl.truth,
  (SELECT count(*) FROM tr WHERE tr.home_team = g.home_team AND tr.away_team IS NOT DISTINCT FROM g.away_team AND tr.truth IS NOT DISTINCT FROM cl.truth) AS n0,
  (SELECT count(*) FROM tr WHERE tr.home_team = g.home_team AND tr.away_team IS NOT DISTINCT FROM g.away_team) AS t0,
  (SELECT count(*) FROM tr WHERE tr.away_team IS NOT DISTINCT FROM g.away_team AND tr.truth IS NOT DISTINCT FROM cl.truth) AS n1, (SELECT count(*) FROM tr WHERE tr.away_team IS NOT DISTINCT FROM g.away_team) AS t1,
  (SELECT count(*) FROM tr WHERE tr.truth IS NOT DISTINCT FROM cl.truth) AS n2, (SELECT count(*) FROM tr) AS t2 FROM g CROSS JOIN cl)
 SELECT home_team::BIGINT AS home_team, away_team::BIGINT AS away_team, truth, round(CASE WHEN t0 >= 24 THEN (n0 + 0.5) / (t0 + 2) WHEN t1 >= 24 THEN (n1 + 0.5) / (t1 + 2) ELSE (n2 + 0.5) / (t2 + 2) END, 6)::DOUBLE AS p, (CASE WHEN t0 >= 24 THEN 0 WHEN t1 >= 24 THEN 1 ELSE 2 END)::BIGINT AS level FROM x""")
def _(t):
    """Unknown opponents and results stay conditions and a class of their own."""
    rows = t.final.where(F.col("game_date") < cut()).select("home_team", F.nullif(F.col("away_team"), F.lit(3)).alias("away_team"), F.when(F.col("game_id") % 9 != 0, F.col("truth")).alias("truth"))
    return aggregates.conditional_rate(rows, "truth", [["home_team", "away_team"], ["away_team"]], 24, 0.5)


@query("joint_rate", "SELECT pitch_type::BIGINT AS pitch_type, pitch_result, count(*) AS n, (2 * grouping(pitch_type) + grouping(pitch_result))::BIGINT AS grouping FROM {pitch} GROUP BY GROUPING SETS ((pitch_type, pitch_result), (pitch_type), (pitch_result), ())")
def _(t):
    return aggregates.joint_rate(t.pitch, "pitch_type", "pitch_result")


@query("run_expectancy", "SELECT state::BIGINT AS state, runner::BIGINT AS runner, count(*) AS n, round(CASE WHEN count(*) >= 1100 THEN avg(rem) ELSE (SELECT avg(rem) FROM {state}) END, 6) AS expected FROM {state} GROUP BY 1, 2")
def _(t):
    return aggregates.run_expectancy(t.state, ["state", "runner"], "rem", 1100)


_LEVELS = """WITH s AS (SELECT state, nullif(runner, 2) AS runner, batter, {y} AS y FROM {{state}} JOIN (SELECT event_id, batter FROM {{pitch}}) USING (event_id)), f AS (SELECT state, runner, batter, count(*) AS n, avg(y) AS m FROM s GROUP BY ALL)
 SELECT state::BIGINT AS state, runner::BIGINT AS runner, batter::BIGINT AS batter, n, round(CASE WHEN n >= {least} THEN m WHEN (SELECT count(*) FROM s WHERE s.state = f.state AND s.runner IS NOT DISTINCT FROM f.runner) >= {least} THEN (SELECT avg(y) FROM s WHERE s.state = f.state AND s.runner IS NOT DISTINCT FROM f.runner)
  WHEN (SELECT count(*) FROM s WHERE s.state = f.state) >= {least} THEN (SELECT avg(y) FROM s WHERE s.state = f.state) ELSE (SELECT avg(y) FROM s) END, 6) AS {name} FROM f"""


def _levels(t, y):
    rows = t.state.join(t.pitch.select("event_id", "batter"), "event_id")
    return rows.select("state", F.nullif(F.col("runner"), F.lit(2)).alias("runner"), "batter", y.alias("y"))


@query("run_expectancy_levels", _LEVELS.format(y="rem", least=270, name="expected"))
def _(t):
    """State, runner and batter; then without the batter, then the state alone, then all."""
    return aggregates.run_expectancy(_levels(t, F.col("rem")), ["state", "runner", "batter"], "y", 270, [["state", "runner"], ["state"]])


@query("state_win_rate_levels", _LEVELS.format(y="CASE WHEN game_id % 2 = 0 THEN 1.0 ELSE 0.0 END", least=270, name="win_share"))
def _(t):
    from hindcast.operators import value

    won = F.when(F.col("game_id") % 2 == 0, 1.0).otherwise(0.0)
    return value.state_win_rate(_levels(t, won), ["state", "runner", "batter"], "y", 270, [["state", "runner"], ["state"]])


@query("point_baseline", "SELECT season::BIGINT AS season, round(avg(home_runs), 6) AS mean, round(median(home_runs), 6) AS median FROM {final} GROUP BY 1")
def _(t):
    return aggregates.point_baseline(t.final, "home_runs", ["season"])


@query("point_baseline_sketch", "SELECT season::BIGINT AS season, round(avg(o_totalprice), 6) AS mean, true AS near FROM (SELECT *, year(o_orderdate) AS season FROM {orders}) GROUP BY 1")
def _(t):
    """The sketch's median against exact ranks: no more than half and a thousandth of a season's values lie on either side."""
    rows = t.orders.select(F.year("o_orderdate").alias("season"), "o_totalprice")
    sketch = aggregates.point_baseline(rows, "o_totalprice", ["season"], accuracy=1000)
    both = rows.join(F.broadcast(sketch), "season").groupBy("season", "mean")  # a row per season
    side = lambda c: F.count_if(c) <= F.count(F.lit(1)) * 0.501 + 1
    return both.agg((side(F.col("o_totalprice") < F.col("median")) & side(F.col("o_totalprice") > F.col("median"))).alias("near"))


@query("rate_per_exposure", """WITH h AS (SELECT player_id, sum(hits) AS c, sum(CASE WHEN player_id % 9 <> 2 THEN exposure ELSE 0 END) AS e FROM {log} WHERE player_id % 6 <> 1 GROUP BY 1)
 SELECT p.player_id, round(c / nullif(e, 0) * (10 + p.player_id % 5), 6) AS expected, CASE WHEN h.player_id IS NULL THEN 'no history' WHEN e = 0 THEN 'no exposure' END AS reason
 FROM (SELECT DISTINCT player_id FROM {log}) p LEFT JOIN h ON h.player_id = p.player_id""")
def _(t):
    """Some players have no history, some no exposure in it; all are there."""
    expo = t.log.select("player_id").distinct().withColumn("expected_exposure", 10 + F.col("player_id") % 5)
    hist = t.log.where("player_id % 6 <> 1").withColumn("exposure", F.when(F.col("player_id") % 9 != 2, F.col("exposure")).otherwise(0))
    return aggregates.rate_per_exposure(hist, expo, "player_id", "hits", "exposure")


@query("empirical_pmf", "SELECT k::BIGINT AS k, n, round(n / sum(n) OVER (), 6) AS p, round(sum(n) OVER (ORDER BY k) / sum(n) OVER (), 6) AS cdf, k = 5 AS is_tail FROM (SELECT least(home_runs, 5) AS k, count(*) AS n FROM {final} GROUP BY 1)")
def _(t):
    return aggregates.empirical_pmf(t.final, "home_runs", 5)


@query("empirical_pmf_gaps", "SELECT k::BIGINT AS k, (SELECT count(*) FROM {final} WHERE home_runs IN (1, 6) AND least(home_runs * 2, 9) = k) AS n, round((SELECT count(*) FROM {final} WHERE home_runs IN (1, 6) AND least(home_runs * 2, 9) = k) / (SELECT count(*) FROM {final} WHERE home_runs IN (1, 6)), 6) AS p, round((SELECT count(*) FROM {final} WHERE home_runs IN (1, 6) AND least(home_runs * 2, 9) <= k) / (SELECT count(*) FROM {final} WHERE home_runs IN (1, 6)), 6) AS cdf, k = 9 AS is_tail FROM range(0, 10) r(k)")
def _(t):
    """Counts that training rows never show have probability 0, not no row."""
    return aggregates.empirical_pmf(t.final.where("home_runs in (1, 6)").withColumn("y", F.col("home_runs") * 2), "y", 9)


@query("independent_seasons", "SELECT home_team::BIGINT AS home_team, count(DISTINCT season) AS seasons, count(*) AS forecasts FROM {final} GROUP BY 1")
def _(t):
    return aggregates.independent_seasons(t.final, ["home_team"])


@query("bullpen_usage", "SELECT event_id, coalesce(sum(outs) OVER (PARTITION BY player_id ORDER BY day RANGE BETWEEN INTERVAL 3 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING), 0)::BIGINT AS recent_load FROM {log}")
def _(t):
    return aggregates.bullpen_usage(t.log, ["player_id"], "ts", "outs", 3).select("event_id", "recent_load")


@query("bullpen_usage_by_day", "SELECT event_id, coalesce(sum(outs) OVER (PARTITION BY player_id ORDER BY day RANGE BETWEEN INTERVAL 3 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING), 0)::BIGINT AS recent_load FROM {log}")
def _(t):
    """As bullpen_usage, over totals of days."""
    return aggregates.bullpen_usage(t.log, ["player_id"], "ts", "outs", 3, by_day=True).select("event_id", "recent_load")


_STRENGTH = "SELECT team::BIGINT AS team, count(*) AS games, round(avg(CASE WHEN runs > allowed THEN 1.0 WHEN runs = allowed THEN 0.5 ELSE 0.0 END), 6) AS win_share, round(avg(runs - allowed), 6) AS run_diff FROM {team_game} WHERE status = 'F' AND game_date < DATE '1998-01-01' GROUP BY 1"


@query("team_strength", _STRENGTH)
def _(t):
    return aggregates.team_strength(t.team_game.where("status = 'F'"), cut())


@query("schedule_difficulty", """WITH s AS (SELECT team, avg(CASE WHEN runs > allowed THEN 1.0 WHEN runs = allowed THEN 0.5 ELSE 0.0 END) AS w FROM {team_game} WHERE status = 'F' AND game_date < DATE '1998-01-01' AND team <> 3 GROUP BY 1)
 SELECT g.team::BIGINT AS team, count(*) AS games, count(w) AS rated, round(avg(w), 6) AS difficulty FROM {team_game} g LEFT JOIN s ON s.team = g.opponent WHERE g.status = 'O' GROUP BY 1""")
def _(t):
    """One team has no history: games against it count as games, not as rated ones."""
    return aggregates.schedule_difficulty(t.team_game.where("status = 'O'").select("team", "opponent"), aggregates.team_strength(t.team_game.where("status = 'F' and team <> 3"), cut()))


@query("matchup_split", "SELECT player_id, role_id::BIGINT AS role_id, sum(hits)::BIGINT AS num, sum(exposure)::BIGINT AS den, round(sum(hits) / sum(exposure), 6) AS value, NULL::VARCHAR AS reason FROM {log} GROUP BY 1, 2")
def _(t):
    return aggregates.matchup_split(t.log, ["player_id", "role_id"], "hits", "exposure")


@query("usage_frequency", "SELECT game_id, batter::BIGINT AS batter, count(*) AS n, round(count(*) / sum(count(*)) OVER (PARTITION BY game_id), 6) AS share FROM {pitch} GROUP BY 1, 2")
def _(t):
    return aggregates.usage_frequency(t.pitch, ["game_id"], "batter")


@query("distinct_predictors", "SELECT count(DISTINCT event_type) AS predictors, count(DISTINCT event_type) <= 7 AS within_limit FROM {events}")
def _(t):
    return aggregates.distinct_predictors(t.events.select(F.col("event_type").alias("predictor")))


# Windows ---------------------------------------------------------------------------------------------------------


@query("rolling_days", "SELECT event_id, (sum(hits) OVER w)::BIGINT AS hits_7d FROM {log} WINDOW w AS (PARTITION BY player_id ORDER BY day RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING)")
def _(t):
    return windows.rolling_days(t.log, ["player_id"], "ts", 7, ["hits"]).select("event_id", "hits_7d")


@query("rolling_days_by_day", "SELECT event_id, (sum(hits) OVER w)::BIGINT AS hits_7d FROM {log} WINDOW w AS (PARTITION BY player_id ORDER BY day RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING)")
def _(t):
    """As rolling_days, over totals of days."""
    return windows.rolling_days(t.log, ["player_id"], "ts", 7, ["hits"], by_day=True).select("event_id", "hits_7d")


@query("rolling_games", "SELECT event_id, (sum(hits) OVER w)::BIGINT AS hits_5g FROM {log} WINDOW w AS (PARTITION BY player_id ORDER BY ts ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING)")
def _(t):
    return windows.rolling_games(t.log, ["player_id"], ["ts"], 5, ["hits"]).select("event_id", "hits_5g")


@query("expanding", "SELECT event_id, (sum(hits) OVER w)::BIGINT AS hits_before FROM {log} WINDOW w AS (PARTITION BY player_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)")
def _(t):
    return windows.expanding(t.log, ["player_id"], ["ts"], ["hits"]).select("event_id", "hits_before")


@query("expanding_hot", "SELECT event_id, (sum(hits) OVER w)::BIGINT AS hits_before FROM {log} WINDOW w AS (PARTITION BY player_id % 3 ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)")
def _(t):
    """Three keys hold all rows: each is cut into slices of time."""
    return windows.expanding(t.log.withColumn("third", F.col("player_id") % 3), ["third"], ["ts", "event_id"], ["hits"], hot=100).select("event_id", "hits_before")


@query("previous_pitch", "SELECT event_id, lag(pitch_type) OVER w::BIGINT AS prev1_pitch_type, lag(pitch_result) OVER w AS prev1_pitch_result FROM {pitch} WINDOW w AS (PARTITION BY game_id ORDER BY ts)".replace("lag(pitch_type) OVER w::BIGINT", "(lag(pitch_type) OVER w)::BIGINT"))
def _(t):
    return windows.previous_pitch(t.pitch, ["game_id"], ["ts"], ["pitch_type", "pitch_result"]).select("event_id", "prev1_pitch_type", "prev1_pitch_result")


@query("count_before", "SELECT event_id, coalesce(sum(outs) OVER w, 0)::BIGINT AS outs_before, coalesce(sum(runs) OVER w, 0)::BIGINT AS runs_before FROM {pitch} WINDOW w AS (PARTITION BY game_id, half_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)")
def _(t):
    return windows.count_before(t.pitch, ["game_id", "half_id"], ["ts"], ["outs", "runs"]).select("event_id", "outs_before", "runs_before")


@query("assign_pa", _PA + "SELECT event_id, pa_id FROM pa")
def _(t):
    return _pa(t).select("event_id", "pa_id")


@query("runs_remaining", "SELECT event_id, rem AS runs_remaining FROM {state}")
def _(t):
    return windows.runs_remaining(t.pitch, ["game_id", "half_id"], ["ts"], "runs").select("event_id", "runs_remaining")


@query("rest_days", "SELECT event_id, (day - lag(day) OVER (PARTITION BY player_id ORDER BY ts))::BIGINT AS rest_days FROM {log}")
def _(t):
    return windows.rest_days(t.log, ["player_id"], "ts", ["ts"]).select("event_id", "rest_days")


@query("detect_change", "SELECT event_id, batter::BIGINT AS batter, previous::BIGINT AS previous FROM (SELECT *, lag(batter) OVER w AS previous, row_number() OVER w AS n FROM {pitch} WINDOW w AS (PARTITION BY game_id, half_id ORDER BY ts)) WHERE n > 1 AND batter <> previous")
def _(t):
    return windows.detect_change(t.pitch, ["game_id", "half_id"], ["ts"], "batter").select("event_id", "batter", "previous")


@query("steal_events", "SELECT event_id, CASE WHEN o IS NULL THEN 'unconfirmed' WHEN o > outs THEN 'caught' WHEN r IS DISTINCT FROM runner THEN 'stolen' ELSE 'no change' END AS verdict FROM (SELECT *, lead(outs) OVER w AS o, lead(runner) OVER w AS r FROM {pitch} WINDOW w AS (PARTITION BY game_id, half_id ORDER BY ts)) WHERE pitch_result = 'click'")
def _(t):
    return windows.steal_events(t.pitch, ["game_id", "half_id"], ["ts"], F.col("pitch_result") == "click", "outs", "runner").select("event_id", "verdict")


@query("reliability_bins", "SELECT least(floor(p * 8), 7)::BIGINT AS bin, count(*) AS n, round(avg(p), 6) AS mean_p, round(avg(CASE WHEN truth = 'H' THEN 1.0 ELSE 0.0 END), 6) AS rate FROM {preds} JOIN {final} USING (game_id) WHERE cls = 'H' GROUP BY 1")
def _(t):
    rows = t.preds.where("cls = 'H'").join(t.final, "game_id").withColumn("y", F.col("truth") == "H")
    return windows.reliability_bins(rows, "p", "y", 8)


# Ranks -----------------------------------------------------------------------------------------------------------


@query("order_events", "SELECT event_id, row_number() OVER (PARTITION BY game_id ORDER BY ts, event_id) AS seq FROM {pitch}")
def _(t):
    return ranking.order_events(t.pitch, ["game_id"], ["ts", "event_id"]).select("event_id", "seq")


def _standings(t):
    return ranking.standings(t.team_game.where("status = 'F'"), ["season"], [F.desc("wins"), F.desc("run_diff"), F.col("team")])


@query("standings", "SELECT season::BIGINT AS season, team::BIGINT AS team, wins, losses, draws, run_diff, round(wins / nullif(wins + losses, 0), 6) AS share, rank::BIGINT AS rank FROM {ranked}")
def _(t):
    return _standings(t)


_FIRST = "SELECT season, band, team, 1 AS set, 0 AS rounds, 0::BIGINT AS h FROM (SELECT season, team, {band} AS band, count(*) OVER (PARTITION BY season, {band}) AS n FROM {{{{table}}}}) WHERE n > 1"
_ROUND = """SELECT a.season, a.band, a.team, set + rank() OVER (PARTITION BY a.season, a.band, set ORDER BY coalesce(w, 0) DESC) - 1 AS set,
   CASE WHEN min(coalesce(w, 0)) OVER p <> max(coalesce(w, 0)) OVER p THEN {k} ELSE rounds END AS rounds, CASE WHEN count(*) OVER p > 1 THEN coalesce(w, 0) ELSE h END AS h
   FROM t{j} a LEFT JOIN (SELECT x.season, x.team, count(*) FILTER (g.runs > g.allowed) AS w FROM t{j} x JOIN {{team_game}} g ON g.status = 'F' AND g.season = x.season AND g.team = x.team
     JOIN t{j} y ON y.season = x.season AND y.team = g.opponent AND y.band = x.band AND y.set = x.set GROUP BY 1, 2) b ON b.season = a.season AND b.team = a.team WINDOW p AS (PARTITION BY a.season, a.band, set)"""


def _h2h_sql(band, name):
    """Tied sets, parted again and again: five rounds, of which the last must change nothing."""
    steps = [f"t0 AS ({_FIRST.format(band=band).format()})", *(f"t{k} AS ({_ROUND.format(k=k, j=k - 1)})" for k in range(1, 6))]
    return f"""WITH {", ".join(steps)} SELECT season::BIGINT AS season, band AS {name}, team::BIGINT AS team, h AS h2h_wins, rounds::BIGINT AS rounds, count(*) OVER (PARTITION BY season, band, set) > 1 AS open,
 row_number() OVER (PARTITION BY season, band ORDER BY set, team) AS h2h_rank FROM t5"""


@query("head_to_head_break", _h2h_sql("wins", "wins"))
def _(t):
    return ranking.head_to_head_break(t.team_game.where("status = 'F'"), _standings(t), ["season"], "wins")


@query("head_to_head_break_bands", _h2h_sql("wins // 12", "band"))
def _(t):
    """Ties of many teams, which part in several rounds."""
    table = _standings(t).withColumn("band", F.floor(F.col("wins") / 12))
    return ranking.head_to_head_break(t.team_game.where("status = 'F'"), table, ["season"], "band")


@query("top_candidates", "SELECT game_id, batter::BIGINT AS batter, n, row_number() OVER (PARTITION BY game_id ORDER BY n DESC, batter) AS rank FROM (SELECT game_id, batter, count(*) AS n FROM {pitch} GROUP BY 1, 2) QUALIFY rank <= 2")
def _(t):
    return ranking.top_candidates(aggregates.usage_frequency(t.pitch, ["game_id"], "batter").drop("share"), ["game_id"], 2, [F.desc("n"), F.col("batter")])


@query("modal_score", "SELECT game_id, h::BIGINT AS h, a::BIGINT AS a, round(p, 6) AS p FROM (SELECT x.game_id, x.k AS h, y.k AS a, x.p * y.p AS p FROM {pmf} x JOIN {pmf2} y USING (game_id)) QUALIFY row_number() OVER (PARTITION BY game_id ORDER BY p DESC, h, a) = 1")
def _(t):
    from hindcast.operators.value import joint_score

    return ranking.modal_score(joint_score(t.pmf, t.pmf2), ["game_id"], ["h", "a"])


@query("lineup_estimate", """WITH f AS (SELECT user_id % 10 AS team, event_id % 9 AS slot, user_id AS player, count(*) AS n FROM {events} GROUP BY ALL),
 a AS (SELECT * FROM f QUALIFY row_number() OVER (PARTITION BY team, slot ORDER BY n DESC, player) = 1), b AS (SELECT * FROM a QUALIFY row_number() OVER (PARTITION BY team, player ORDER BY n DESC, slot) = 1)
 SELECT s.team, s.slot, b.player, b.n FROM (SELECT DISTINCT team, slot FROM f) s LEFT JOIN b USING (team, slot)""")
def _(t):
    f = t.events.groupBy((F.col("user_id") % 10).alias("team"), (F.col("event_id") % 9).alias("slot"), F.col("user_id").alias("player")).agg(F.count(F.lit(1)).alias("n"))
    return ranking.lineup_estimate(f, "team", "slot", "player", "n")


# Labels and splits -----------------------------------------------------------------------------------------------


@query("label_game", "SELECT game_id, truth AS cls FROM {final}")
def _(t):
    return labels.label_game(t.game).select("game_id", "cls")


@query("label_pa", _PA + "SELECT game_id, half_id, pa_id, CASE max_by(pitch_result, ts) WHEN 'purchase' THEN 'hit' WHEN 'error' THEN 'out' ELSE 'unmapped' END AS cls FROM pa GROUP BY 1, 2, 3")
def _(t):
    mapping = t.spark.sql("SELECT * FROM VALUES ('purchase', 'hit'), ('error', 'out') AS m(result, cls)")
    return labels.label_pa(_pa(t).withColumnRenamed("pitch_result", "result"), mapping, PA, F.col("ts")).select(*PA, "cls")


@query("label_pitch", "SELECT event_id, pitch_type::BIGINT AS pitch_type, pitch_result, round(plate_x, 6) AS plate_x, round(plate_z, 6) AS plate_z, plate_x IS NOT NULL AND plate_z IS NOT NULL AS valid FROM {pitch}")
def _(t):
    return labels.label_pitch(t.pitch, ["event_id"], "pitch_type", "pitch_result", "plate_x", "plate_z")


def _days(t):
    """Days as targets: captured unless the day number says otherwise."""
    return t.log.select("day").distinct().withColumn("ok", F.dayofmonth("day") != 17)


@query("label_state", """WITH p AS (SELECT DISTINCT player_id FROM {log}), m AS (SELECT * FROM {mondays} UNION ALL SELECT DATE '2024-02-05'),
 s AS (SELECT player_id, anchor, sum(hits) AS h FROM {log} JOIN m ON day >= anchor AND day < anchor + 7 GROUP BY 1, 2),
 x AS (SELECT p.player_id, m.anchor, coalesce(s.h, 0)::BIGINT AS h, CASE WHEN m.anchor >= DATE '2024-02-01' THEN 'out of scope' WHEN m.anchor + 7 > DATE '2024-01-31' THEN 'undetermined' WHEN m.anchor = DATE '2024-01-15' THEN 'unobserved' WHEN coalesce(s.h, 0) = 0 THEN 'confirmed zero' ELSE 'confirmed' END AS state
  FROM p CROSS JOIN m LEFT JOIN s ON s.player_id = p.player_id AND s.anchor = m.anchor)
 SELECT player_id, anchor, state, CASE WHEN starts_with(state, 'confirmed') THEN h END AS hits FROM x""")
def _(t):
    anchors = t.mondays.union(t.spark.sql("SELECT DATE '2024-02-05'"))
    panel = t.log.select("player_id").distinct().crossJoin(anchors)
    sums = aggregates.horizon_counts(t.log, "ts", 7, ["player_id"], ["hits"])
    complete = labels.horizon_complete(_days(t), 7, "day", "ok")
    day = lambda x: F.lit(x).cast("date")
    return labels.label_state(panel, sums, complete.select("anchor", "is_complete"), ["player_id", "anchor"], "hits", day("2024-01-31"), day("2024-02-01"), 7)


@query("horizon_complete", "SELECT anchor, count(*) AS expected, bool_and(day(day) <> 17) AS is_complete FROM (SELECT DISTINCT day FROM {log}) JOIN (SELECT DATE '2024-01-01' + 7 * i::INT AS anchor FROM range(-4, 6) r(i)) ON day >= anchor AND day < anchor + 28 GROUP BY 1")
def _(t):
    return labels.horizon_complete(_days(t), 28, "day", "ok")


@query("train_eligible", "SELECT event_id FROM {log} WHERE day + 7 <= DATE '2024-01-20' AND event_id % 6 <> 0 AND day + 7 + CAST(event_id % 5 AS INT) <= DATE '2024-01-20'")
def _(t):
    rows = t.log.withColumn("label_end", F.date_add("day", 7)).withColumn("available_at", F.when(F.col("event_id") % 6 != 0, F.date_add("label_end", (F.col("event_id") % 5).cast("int"))))
    return labels.train_eligible(rows, F.lit("2024-01-20").cast("date")).select("event_id")


@query("partial_mask", "WITH s AS (SELECT player_id, CAST(date_trunc('week', day) AS DATE) AS anchor, sum(hits)::BIGINT AS hits, sum(outs)::BIGINT AS outs FROM {log} GROUP BY 1, 2) SELECT player_id, anchor, hits, outs FROM s WHERE player_id % 3 <> 0")
def _(t):
    s = aggregates.horizon_counts(t.log, "ts", 7, ["player_id"], ["hits", "outs"]).withColumn("outs", F.when(F.col("player_id") % 3 != 0, F.col("outs")))
    return labels.partial_mask(s.unpivot(["player_id", "anchor"], ["hits", "outs"], "output", "y"), ["player_id", "anchor"], "output", ["hits", "outs"], "complete")


@query("overlap_report", "WITH a AS (SELECT DISTINCT player_id, CAST(date_trunc('week', day) AS DATE) AS anchor FROM {log}) SELECT x.player_id, count(DISTINCT x.anchor) AS anchors, count(y.anchor) AS pairs FROM a x LEFT JOIN a y ON x.player_id = y.player_id AND y.anchor > x.anchor AND y.anchor < x.anchor + 28 GROUP BY 1")
def _(t):
    from hindcast.functions.scalars import monday_anchor

    rows = t.log.select("player_id", monday_anchor(F.col("ts")).alias("anchor"))
    return labels.overlap_report(rows, ["player_id"], 28)


_SPLIT = "CASE WHEN game_date < DATE '1998-01-01' THEN 'train' WHEN game_date < DATE '2000-01-01' THEN 'validation' ELSE 'test' END"

def cuts():
    return cut(), F.lit("2000-01-01").cast("date")


@query("time_split", f"SELECT game_id, {_SPLIT} AS split FROM {{game}}")
def _(t):
    return splits.time_split(t.game, "game_date", cuts()).select("game_id", "split")


@query("propagate_split", f"SELECT l_orderkey AS game_id, l_partkey, l_suppkey, {_SPLIT.replace('CASE', 'CASE WHEN l_orderkey % 10 = 4 THEN NULL', 1)} AS split FROM {{lineitem}} LEFT JOIN {{game}} ON l_orderkey = game_id")
def _(t):
    """Some games have no split: their events are there, without one."""
    rows = t.lineitem.select(F.col("l_orderkey").alias("game_id"), "l_partkey", "l_suppkey")
    return splits.propagate_split(rows, splits.time_split(t.game.where("game_id % 10 <> 4"), "game_date", cuts()))


@query("purge_overlap", f"SELECT game_id, {_SPLIT} AS split FROM {{game}} WHERE game_date >= DATE '1998-01-01' OR game_date + 28 <= DATE '1998-01-01'")
def _(t):
    rows = splits.time_split(t.game, "game_date", cuts()).withColumn("label_end", F.date_add("game_date", 28))
    return splits.purge_overlap(rows, cut()).select("game_id", "split")


@query("rolling_origin", "WITH o AS (SELECT DATE '1997-01-01' AS origin UNION ALL SELECT DATE '1998-01-01' UNION ALL SELECT DATE '1999-01-01') SELECT origin, CASE WHEN game_date >= origin THEN 'eval' ELSE 'train' END AS role, count(*) AS n, round(avg(home_runs), 6) AS mean FROM {game} JOIN o ON game_date >= origin - 365 AND game_date < origin + 90 GROUP BY 1, 2")
def _(t):
    origins = t.spark.sql("SELECT CAST(d AS DATE) AS origin FROM VALUES ('1997-01-01'), ('1998-01-01'), ('1999-01-01') AS o(d)")
    return splits.rolling_origin(t.game, origins, "game_date", 90, 365).groupBy("origin", "role").agg(F.count(F.lit(1)).alias("n"), F.avg("home_runs").alias("mean"))


@query("fit_impute", "SELECT round(avg(plate_x), 6) AS plate_x, round(avg(plate_z), 6) AS plate_z FROM {pitch} WHERE half_id < DATE '2024-01-15'")
def _(t):
    return splits.fit_impute(t.pitch.where("half_id < '2024-01-15'"), ["plate_x", "plate_z"])


@query("apply_impute", "SELECT event_id, round(coalesce(plate_x, (SELECT avg(plate_x) FROM {pitch} WHERE half_id < DATE '2024-01-15')), 6) AS plate_x, plate_x IS NULL AS plate_x_was_missing FROM {pitch}")
def _(t):
    fitted = splits.fit_impute(t.pitch.where("half_id < '2024-01-15'"), ["plate_x"])
    return splits.apply_impute(t.pitch.select("event_id", "plate_x"), fitted)


@query("fit_scale", "SELECT round(avg(value), 6) AS value_mean, round(stddev_samp(value), 6) AS value_dev FROM {events} WHERE ts < TIMESTAMP '2024-01-20'")
def _(t):
    return splits.fit_scale(t.events.where("ts < '2024-01-20'"), ["value"])


@query("apply_scale", "SELECT event_id, round((value - (SELECT avg(value) FROM {events} WHERE ts < TIMESTAMP '2024-01-20')) / (SELECT stddev_samp(value) FROM {events} WHERE ts < TIMESTAMP '2024-01-20'), 6) AS value FROM {events}")
def _(t):
    fitted = splits.fit_scale(t.events.where("ts < '2024-01-20'"), ["value"])
    return splits.apply_scale(t.events.select("event_id", "value"), fitted, ["value"])


@query("fit_encode", "SELECT event_type, row_number() OVER (ORDER BY event_type) - 1 AS code FROM (SELECT DISTINCT event_type FROM {events} WHERE event_type <> 'view')")
def _(t):
    return splits.fit_encode(t.events.where("event_type <> 'view'"), "event_type")


@query("apply_encode", "WITH c AS (SELECT event_type, row_number() OVER (ORDER BY event_type) - 1 AS code FROM (SELECT DISTINCT event_type FROM {events} WHERE event_type <> 'view')) SELECT event_id, coalesce(code, -1) AS code FROM {events} LEFT JOIN c USING (event_type)")
def _(t):
    return splits.apply_encode(t.events, splits.fit_encode(t.events.where("event_type <> 'view'"), "event_type"), "event_type").select("event_id", "code")


@query("screen_features", "SELECT 'away_runs' AS feature, round(corr(away_runs, home_runs), 6) AS r FROM {final} WHERE season < 1998 UNION ALL SELECT 'home_team', round(corr(home_team, home_runs), 6) FROM {final} WHERE season < 1998")
def _(t):
    return splits.screen_features(t.final.where("season < 1998"), ["away_runs", "home_team"], "home_runs")


@query("calibrate_bins", "WITH r AS (SELECT p.game_id, p.p, f.season, f.truth = 'H' AS y, least(floor(p.p * 10), 9)::BIGINT AS bin FROM {preds} p JOIN {final} f USING (game_id) WHERE cls = 'H'), b AS (SELECT bin, avg(CASE WHEN y THEN 1.0 ELSE 0.0 END) AS rate FROM r WHERE season < 1998 GROUP BY 1) SELECT game_id, bin, round(coalesce(rate, p), 6) AS calibrated FROM r LEFT JOIN b USING (bin) WHERE season >= 1998")
def _(t):
    rows = t.preds.where("cls = 'H'").join(t.final, "game_id").select("game_id", "p", "season", (F.col("truth") == "H").alias("y"))
    return splits.calibrate_bins(rows.where("season < 1998"), rows.where("season >= 1998"), "p", "y", 10).select("game_id", "bin", "calibrated")


@query("test_lock_audit", "SELECT user_id AS run_id, count(DISTINCT event_id) AS touched FROM {events} WHERE event_type IN ('click', 'view') AND ts >= TIMESTAMP '2024-01-25' GROUP BY 1")
def _(t):
    ledger = t.events.select(F.col("user_id").alias("run_id"), F.col("event_id").alias("sample_id"), F.when(F.col("event_type").isin("click", "view"), "selection").otherwise("report").alias("purpose"))
    return splits.test_lock_audit(ledger, t.events.where("ts >= '2024-01-25'").select(F.col("event_id").alias("sample_id")), "sample_id")


@query("leak_report", """WITH x AS (SELECT l_orderkey, CASE WHEN o_orderkey IS NULL THEN 'unknown sample' WHEN o_orderkey % 17 = 0 THEN 'no cutoff' WHEN l_quantity = 7 THEN 'no event time' WHEN l_shipdate >= o_orderdate THEN 'event'
   WHEN l_quantity = 13 THEN 'no evidence' WHEN l_shipdate + INTERVAL 60 DAY > o_orderdate THEN 'availability' END AS cause FROM {lineitem} LEFT JOIN {orders} ON l_orderkey = o_orderkey AND o_orderkey % 19 <> 1)
 SELECT cause, count(*) AS n_rows, count(DISTINCT l_orderkey) AS n_samples FROM x WHERE cause IS NOT NULL GROUP BY 1""")
def _(t):
    """Some inputs have no event time, some samples no cutoff, and some inputs no listed sample: none passes for clean."""
    inputs = t.lineitem.select(F.col("l_orderkey").alias("sample_id"), F.when(F.col("l_quantity") != 7, F.col("l_shipdate")).alias("event_ts"), F.when(F.col("l_quantity") != 13, F.col("l_shipdate") + F.expr("INTERVAL 60 DAYS")).alias("available_at"))
    samples = t.orders.where("o_orderkey % 19 <> 1").select(F.col("o_orderkey").alias("sample_id"), F.when(F.col("o_orderkey") % 17 != 0, F.col("o_orderdate")).alias("cutoff"))
    return splits.leak_report(inputs, samples, "sample_id", "event_ts", "available_at")
