"""What the data lacks: equal instants, zero denominators, censored horizons, ties, leaks, plans."""

from __future__ import annotations

import datetime as dt
import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from hindcast.functions import scalars
from hindcast.operators import aggregates, elimination, estimators, gates, joins, labels, quality, ranking, scoring, season, splits, value, windows
from hindcast.plans.fixtures import Tables


def rows(df):
    return [tuple(r) for r in df.collect()]


def day(n):
    return dt.date(2024, 1, n)


def test_asof_equal_instant_needs_sequence(spark):
    left = spark.createDataFrame([(1, 10, 5), (1, 9, 1)], "k int, t int, seq int")
    snaps = spark.createDataFrame([(1, 10, 4, "a"), (1, 3, 0, "b")], "k int, u int, seq_s int, v string")
    plain = joins.join_asof_snapshot(left, snaps, ["k"], "t", "u", ["v"])
    assert sorted(rows(plain.select("t", "v"))) == [(9, "b"), (10, "b")]
    ordered = joins.join_asof_snapshot(left, snaps, ["k"], "t", "u", ["v"], seq=("seq", "seq_s"))
    assert sorted(rows(ordered.select("t", "v"))) == [(9, "b"), (10, "a")]


def test_missing_evidence_is_no_proof(spark):
    df = spark.createDataFrame([(1, day(1)), (2, None)], "id int, a date")
    assert rows(gates.gate_available(df, "a", F.lit(day(2))).select("id")) == [(1,)]


def test_first_failing_reason_and_null_rule(spark):
    df = spark.createDataFrame([(1, None), (2, 3), (3, -1)], "id int, x int")
    ok, bad = gates.split_reasons(df, [("small", F.col("x") >= 0), ("odd", F.col("x") % 2 == 0)])
    assert rows(ok) == []
    assert sorted(rows(bad.select("id", "reason"))) == [(1, "small"), (2, "odd"), (3, "small")]


def test_ratio_of_zero_denominator(spark):
    df = spark.createDataFrame([("a", 1, 0), ("b", 1, 2), ("b", 2, 2)], "k string, n int, d int")
    assert sorted(rows(aggregates.ratio(df, ["k"], "n", "d"))) == [("a", 1, 0, None, "zero denominator"), ("b", 3, 4, 0.75, None)]


def test_label_states(spark):
    anchors = [(p, day(d)) for p in (1, 2) for d in (1, 8, 15, 22, 29)]
    panel = spark.createDataFrame(anchors, "player_id int, anchor date")
    sums = spark.createDataFrame([(1, day(1), 3), (1, day(8), 2), (1, day(15), 5)], "player_id int, anchor date, hits long")
    complete = spark.createDataFrame([(day(1), True), (day(8), False), (day(15), True)], "anchor date, is_complete boolean")
    out = labels.label_state(panel, sums, complete, ["player_id", "anchor"], "hits", F.lit(day(24)), F.lit(day(29)), 7)
    got = {(r["player_id"], r["anchor"].day): (r["state"], r["hits"]) for r in out.collect()}
    assert got[1, 1] == ("confirmed", 3) and got[2, 1] == ("confirmed zero", 0)
    assert got[1, 8] == ("unobserved", None) and got[2, 8] == ("unobserved", None)
    assert got[1, 22] == ("undetermined", None) and got[1, 29] == ("out of scope", None)


def test_no_nested_loop_is_planned(spark, small):
    t = Tables(spark, small)
    horizon = joins.join_horizon(t.log, t.mondays, "ts", 28)
    asof = joins.join_asof_snapshot(t.events.select("user_id", "ts"), t.events.select("user_id", "ts", "value"), ["user_id"], "ts", "ts", ["value"])
    for df in (horizon, asof):
        assert "NestedLoop" not in df._jdf.queryExecution().executedPlan().toString()


def test_later_rows_leave_features_alone(spark, small):
    log = Tables(spark, small).log
    early = log.where("day < '2024-01-15'")

    def features(df):
        df = windows.rolling_days(df, ["player_id"], "ts", 7, ["hits"])
        return {tuple(r) for r in windows.expanding(df, ["player_id"], ["ts"], ["hits"]).where("day < '2024-01-15'").select("event_id", "hits_7d", "hits_before").collect()}

    assert features(log) == features(early)
    assert features(log.orderBy(F.desc("event_id"))) == features(early)


def test_seven_days_never_exceed_twenty_eight(spark, small):
    log = Tables(spark, small).log
    a = aggregates.horizon_counts(log, "ts", 7, ["player_id"], ["hits"]).withColumnRenamed("hits", "h7")
    b = aggregates.horizon_counts(log, "ts", 28, ["player_id"], ["hits"])
    assert quality.qc_counts(a.join(b, ["player_id", "anchor"]), [("h7", "hits")]).count() == 0


def test_flip_only_win_shares(spark):
    with pytest.raises(ValueError):
        scalars.perspective_flip(F.lit(0.4), "win_probability")


def test_half_inning_end_is_worth_nothing(spark):
    states = spark.createDataFrame([("h", 1, 0, 1), ("h", 2, 1, 0)], "half string, seq int, state int, runs int")
    re = spark.createDataFrame([(0, 0.5), (1, 0.9)], "state int, expected double")
    out = {r["seq"]: (round(r["plain"], 6), round(r["with_runs"], 6)) for r in value.run_value(states, re, "half", ["seq"], ["state"], "runs").collect()}
    assert out == {1: (0.4, 1.4), 2: (-0.9, -0.9)}


def test_unseen_category_and_zero_deviation(spark):
    train = spark.createDataFrame([("a", 1.0), ("b", 1.0)], "c string, x double")
    new = spark.createDataFrame([("z", 2.0), (None, 1.0), ("a", 1.0)], "c string, x double")
    assert sorted(rows(splits.apply_encode(new, splits.fit_encode(train, "c"), "c").select("c", "code")), key=str) == [("a", 0), ("z", -1), (None, None)]
    assert {r["x"] for r in splits.apply_scale(new, splits.fit_scale(train, ["x"]), ["x"]).collect()} == {None}


def test_locations_are_never_filled(spark):
    df = spark.createDataFrame([(None, 1.0), (None, None), (1.0, 2.0)], "x double, z double")
    assert sorted(rows(gates.valid_location(df, "x", "z").select("x", "z", "valid", "why_invalid")), key=str) == [
        (1.0, 2.0, True, None), (None, 1.0, False, "no x"), (None, None, False, "no location")]
    none = scoring.location_error(df.where("x is null").select(F.lit(1).alias("k"), F.lit(0.0).alias("x_hat"), F.lit(0.0).alias("z_hat")), df.where("x is null and z is null").select(F.lit(1).alias("k"), "x", "z"), ["k"]).first()
    assert none["mean_distance"] is None and none["valid_share"] == 0


def test_head_to_head(spark):
    games = spark.createDataFrame([(1, 1, 2, 3, 1), (1, 2, 1, 1, 3), (1, 3, 1, 0, 9), (1, 1, 3, 9, 0), (1, 2, 3, 5, 0), (1, 3, 2, 0, 5), (1, 2, 3, 4, 1), (1, 3, 2, 1, 4)], "season int, team int, opponent int, runs int, allowed int")
    table = ranking.standings(games, ["season"], [F.desc("wins"), F.col("team")])
    out = ranking.head_to_head_break(games, table, ["season"], "wins")
    assert sorted(rows(out.select("team", "h2h_wins", "h2h_rank"))) == [(1, 1, 1), (2, 0, 2)]


def test_probabilities_add_up(spark, small):
    t = Tables(spark, small)
    joint = value.joint_score(t.pmf, t.pmf2)
    assert quality.qc_probability(joint, ["game_id"]).count() == 0
    assert quality.qc_score_wdl(joint, value.wdl_from_scores(joint)).count() == 0
    rates = aggregates.conditional_rate(t.final, "truth", [["home_team", "away_team"], ["home_team"]], 20, 0.5)
    assert quality.qc_probability(rates, ["home_team", "away_team"]).count() == 0


def test_lock_status_by_bounds(spark):
    table = spark.createDataFrame([(1, "a", 9), (1, "b", 3), (1, "c", 2), (1, "d", 0)], "season int, team string, wins int")
    left = spark.createDataFrame([(1, "b", "d")] * 5 + [(1, "d", "c"), (1, "d", "d"), (2, "y", "z")], "season int, home string, away string")
    out = {r["team"]: r["status"] for r in season.lock_status(table, left, 1).collect()}
    assert out == {"a": "clinched", "b": "eliminated", "c": "eliminated", "d": "eliminated", "y": "open", "z": "open"}


def test_lock_status_needs_flows(spark):
    """a stands at 10 with no games left, b and c at 9 with a game against each other: one of them must pass to 10."""
    rows = [(1, "a", 10), (1, "b", 10), (1, "c", 10), (1, "d", 9)]
    table, left = spark.createDataFrame(rows, "season int, team string, wins int"), spark.createDataFrame([(1, "b", "c")], "season int, home string, away string")
    out = {r["team"]: (r["beyond"], r["status"]) for r in season.lock_status(table, left, 1).collect()}
    assert out["a"] == (0, "eliminated") and out["b"] == out["c"] == (0, "open")
    assert {r["team"]: r["status"] for r in season.lock_status(table, left, 1, draws=True).collect()}["a"] == "open"


@pytest.mark.parametrize("draws", [False, True])
def test_lock_status_against_all_outcomes(draws):
    rng = random.Random(12)
    for _ in range(150):
        teams = range(rng.randrange(2, 6))
        wins = {t: rng.randrange(4) for t in teams}
        played = [tuple(sorted(rng.sample(list(teams), 2))) for _ in range(rng.randrange(7 if draws else 9))]
        games = {p: played.count(p) for p in played}
        ends = []
        for outcome in itertools.product((0, 1, 2) if draws else (0, 1), repeat=len(played)):
            end = dict(wins)
            for pair, o in zip(played, outcome):
                if o < 2:
                    end[pair[o]] += 1
            ends.append(end)
        for slots in range(1, len(teams) + 1):
            for t in teams:
                sure = all(sum(e[o] >= e[t] for o in teams if o != t) < slots for e in ends)
                out = all(sum(e[o] > e[t] for o in teams if o != t) >= slots for e in ends)
                assert elimination.status_of(t, wins, games, slots, draws) == ("clinched" if sure else "eliminated" if out else "open"), (t, wins, games, slots)


def _h2h(spark, results, wins):
    """Rows of head_to_head_break for games (winner, loser, times) between teams with given wins."""
    games = [(1, a, b, 2, 1) for a, b, n in results for _ in range(n)] + [(1, b, a, 1, 2) for a, b, n in results for _ in range(n)]
    table = spark.createDataFrame([(1, t, w) for t, w in wins.items()], "season int, team int, wins int")
    out = ranking.head_to_head_break(spark.createDataFrame(games, "season int, team int, opponent int, runs int, allowed int"), table, ["season"], "wins")
    return {r["team"]: (r["h2h_rank"], r["rounds"], r["open"]) for r in out.collect()}


def test_circular_tie_stays_open(spark):
    out = _h2h(spark, [(1, 2, 3), (2, 3, 3), (3, 1, 3)], {1: 5, 2: 5, 3: 5, 4: 9})
    assert out == {1: (1, 0, True), 2: (2, 0, True), 3: (3, 0, True)}


def test_tie_of_four_parts_in_two_steps(spark):
    # Among four, 4 wins most and 3 least; 1 and 2 have the same, and only their own games tell that 2 is ahead of 1.
    out = _h2h(spark, [(4, 1, 2), (4, 2, 2), (4, 3, 1), (2, 1, 1), (1, 3, 2), (2, 3, 1), (3, 4, 1)], {1: 7, 2: 7, 3: 7, 4: 7})
    assert out == {4: (1, 1, False), 2: (2, 2, False), 1: (3, 2, False), 3: (4, 1, False)}


def test_crps_of_sparse_support(spark):
    pmf = spark.createDataFrame([(1, 0, 0.5), (1, 5, 0.5), (2, 0, 0.5), (2, 5, 0.5), (3, 2, 1.0), (4, 1, 0.4), (4, 3, 0.4), (5, None, 1.0), (6, 1, None)], "g int, k int, p double")
    y = lambda *r: scoring.crps_discrete(pmf, spark.createDataFrame(r, "g int, y int"), "g").first()
    assert (y((1, 3))["crps"], y((2, 8))["crps"], y((3, -1))["crps"], y((3, 2))["crps"]) == (1.25, 4.25, 3.0, 0.0)
    out = y((4, 3))  # 0.2 isn't listed and stands at 3
    assert abs(out["crps"] - 2 * 0.4**2) < 1e-12 and abs(out["unlisted"] - 0.2) < 1e-12
    out = y((1, 3), (5, 1), (6, 1), (7, 1), (3, None))
    assert (out["n"], out["unforecast"], out["unobserved"], out["crps"]) == (1, 3, 1, 1.25)


def test_samples_without_forecast_count(spark):
    preds, truth = spark.createDataFrame([(1, "H", 0.9), (3, "H", None)], "g int, cls string, p double"), spark.createDataFrame([(1, "H"), (2, "H"), (3, "A"), (4, None)], "g int, truth string")
    conf = scoring.confusion(preds, truth, ["g"])
    assert {(r["truth"], r["predicted"]): r["n"] for r in conf.collect()} == {("H", "H"): 1, ("H", None): 1, ("A", None): 1}
    assert tuple(scoring.accuracy(conf).first()) == (1 / 3, 3)
    assert {r["cls"]: (r["recall"], r["support"]) for r in scoring.class_report(conf).collect()} == {"H": (0.5, 2), "A": (0.0, 1)}
    y = spark.createDataFrame([(1, 1.0), (2, 2.0), (3, None)], "g int, y double")
    out = scoring.interval_score(spark.createDataFrame([(1, 0.0, 3.0), (3, 0.0, 1.0)], "g int, lo double, hi double"), y, ["g"]).first()
    assert (out["n"], out["unforecast"], out["unobserved"], out["coverage"], out["width"]) == (1, 1, 1, 1.0, 3.0)
    ratio = scoring.ratio_mae(spark.createDataFrame([(1, 0.5)], "g int, y_hat double"), spark.createDataFrame([(1, 1, 2), (2, 1, 2), (3, 1, 2), (4, 1, 0)], "g int, num int, den int"), ["g"]).first()
    assert (ratio["n"], ratio["unforecast"], ratio["unobserved"], ratio["coverage"], ratio["den"]) == (1, 2, 1, 0.25, 2)


def test_unknown_state_is_no_end(spark):
    states = spark.createDataFrame([(1, 1, "a", 0), (1, 2, None, 1), (1, 3, "a", 2)], "h int, i int, s string, runs int")
    re = spark.createDataFrame([("a", 0.5)], "s string, expected double")
    assert sorted(rows(value.run_value(states, re, "h", ["i"], ["s"], "runs"))) == [(1, 1, None, None), (1, 2, None, None), (1, 3, -0.5, 1.5)]
    known = re.union(spark.createDataFrame([(None, 0.25)], re.schema))
    assert sorted(rows(value.run_value(states, known, "h", ["i"], ["s"], "runs"))) == [(1, 1, -0.25, -0.25), (1, 2, 0.25, 1.25), (1, 3, -0.5, 1.5)]


def test_nothing_vanishes(spark):
    lev = value.leverage(spark.createDataFrame([("x", "y", 0.5), ("x", "z", 0.5), ("y", "x", 1.0)], "state string, next string, p double"), spark.createDataFrame([("x", 0.5), ("y", 1.0)], "state string, win_share double"))
    assert {r["state"]: (r["swing"], r["covered"]) for r in lev.collect()} == {"x": (None, 0.5), "y": (0.5, 1.0)}
    adv = season.advance_probability(spark.createDataFrame([("a", "b", 0.5), ("a", "c", 0.5), ("b", "a", 1.0)], "team string, opponent string, p_meet double"), spark.createDataFrame([("a", "b", 0.6), ("b", "a", 0.4)], "team string, opponent string, p_win double"))
    assert {r["team"]: (r["p_advance"], r["covered"]) for r in adv.collect()} == {"a": (None, 0.5), "b": (0.4, 1.0)}
    assert quality.qc_probability(spark.createDataFrame([(1, None), (2, 1.0), (3, 1.0), (3, None)], "k int, p double"), ["k"]).select("k").distinct().count() == 2
    inputs = spark.createDataFrame([(1, None, 1), (2, 1, 1), (3, 1, 1), (None, 1, 1)], "s int, e int, a int")
    leaks = splits.leak_report(inputs, spark.createDataFrame([(1, 5), (2, None)], "s int, cutoff int"), "s", "e", "a")
    assert {r["cause"]: (r["n_rows"], r["n_samples"]) for r in leaks.collect()} == {"no event time": (1, 1), "no cutoff": (1, 1), "unknown sample": (2, 2)}


def test_bootstrap_is_seeded_and_paired(spark, small):
    t = Tables(spark, small)
    truth = t.final.select("game_id", "truth", "season")
    same = scoring.bootstrap_compare({"a": t.preds, "b": t.preds}, truth, ["game_id"], "season", "a", replicates=50).collect()
    assert {(r["difference"], r["lo"], r["hi"]) for r in same} == {(0.0, 0.0, 0.0)}
    worse = {"a": t.preds, "b": t.preds.withColumn("p", F.col("p") * 0.5)}
    runs = [{r["candidate"]: tuple(r) for r in scoring.bootstrap_compare(worse, truth, ["game_id"], "season", "a", replicates=50, seed=s).collect()} for s in (1, 1, 2)]
    assert runs[0] == runs[1] and all(abs(r["b"][5] - math.log(2)) < 1e-9 and abs(r["b"][6] - math.log(2)) < 1e-9 for r in runs)
    w = spark.range(400).select(F.explode(F.sequence(F.lit(1), F.lit(50))).alias("b"), "id").select(scoring.poisson_weight(F.col("b"), F.col("id"), 3).alias("w"))
    m = w.agg(F.avg("w").alias("mean"), F.var_samp("w").alias("var")).first()
    assert abs(m["mean"] - 1) < 0.03 and abs(m["var"] - 1) < 0.06


def test_score_balance_tells_fits_from_others(spark):
    rng = random.Random(2)
    data = []
    for _ in range(4000):
        x = rng.random()
        data.append((x, float(sum(rng.random() < 0.02 * math.exp(x) for _ in range(50)))))
    df = spark.createDataFrame(data, "x double, y double")
    fitted = estimators.fit_runs(df, ["x"], "y").transform(df)
    good = estimators.score_balance(fitted, ["x"], {"y": (F.col("y"), F.col("prediction"))}).collect()
    off = estimators.score_balance(fitted, ["x"], {"y": (F.col("y"), F.col("prediction") * 1.01)}).collect()
    assert all(r["balanced"] and r["n"] == 4000 for r in good) and not any(r["balanced"] for r in off)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "k int, ts timestamp_ntz, hits int, exposure int")
    assert aggregates.horizon_counts(none, "ts", 28, ["k"], ["hits"]).count() == 0
    assert windows.rolling_days(none, ["k"], "ts", 7, ["hits"]).count() == 0
    assert aggregates.ratio(none, ["k"], "hits", "exposure").count() == 0


def test_joint_loss_in_one_pass(spark):
    """Repeated and null samples count each; the joint cells are read once, and grouped by sample only."""
    joint = spark.range(98).selectExpr("id div 49 as g", "id % 49 div 7 as h", "id % 7 as a", "(1 + id % 5) / 100.0D as p")
    truth = spark.createDataFrame([(0, 1, 2), (0, 1, 2), (1, 6, 6), (1, None, 3), (7, 1, 1)], "g long, h long, a long")
    out = scoring.joint_and_marginal_loss(joint, truth, ["g"], "h", "a")
    cells = {(r["g"], r["h"], r["a"]): r["p"] for r in joint.collect()}
    rows = [tuple(r) for r in truth.collect()]
    for part, hit in (("joint", lambda c, t: c == t), ("h", lambda c, t: c[:2] == t[:2]), ("a", lambda c, t: (c[0], c[2]) == (t[0], t[2]))):
        p = [sum(v for c, v in cells.items() if hit(c, t)) for t in rows]
        (row,) = out.where(F.col("part") == part).collect()
        assert row["n"] == 5 and row["log_loss"] == pytest.approx(sum(-math.log(max(x, 1e-12)) for x in p) / 5)
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Range (") == 1
