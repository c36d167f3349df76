"""Season tables: titles, entry, series, outlooks from draws."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hindcast.operators.elimination import statuses
from hindcast.operators.scoring import poisson_weight


def regular_title(standings: DataFrame) -> DataFrame:
    return standings.where(F.col("rank") == 1)


def postseason_entry(standings: DataFrame, rules: DataFrame) -> DataFrame:
    """Teams whose rank qualifies under their season's rule; rules has (season, slots)."""
    return standings.join(rules, "season").where(F.col("rank") <= F.col("slots"))


def series_result(games: DataFrame, rules: DataFrame) -> DataFrame:
    """Wins per (series, team) and whether the target of the series' stage is reached; games has (series, stage, team, won)."""
    wins = games.groupBy("series", "stage", "team").agg(F.sum(F.col("won").cast("int")).cast("long").alias("wins"))
    return wins.join(rules, "stage").withColumn("is_winner", F.col("wins") >= F.col("target"))


def final_champion(series: DataFrame, stage: str) -> DataFrame:
    return series.where((F.col("stage") == stage) & F.col("is_winner"))


def expected_wins(actual: DataFrame, remaining: DataFrame) -> DataFrame:
    """Wins so far plus the sum of win probabilities to come: actual (team, wins), remaining (team, p)."""
    rest = remaining.groupBy("team").agg(F.sum("p").alias("rest"))
    return actual.join(rest, "team", "full").select("team", F.coalesce("wins", F.lit(0)).alias("wins"), (F.coalesce("wins", F.lit(0)) + F.coalesce("rest", F.lit(0.0))).alias("expected_wins"))


def lock_status(standings: DataFrame, remaining: DataFrame, slots: int, draws: bool = False) -> DataFrame:
    """clinched, eliminated or open, over all outcomes of the games still to come, beside the bounds on wins.

    standings has (season, team, wins), remaining a row per game (season, home, away).  By bounds a team has clinched
    when fewer than `slots` others can_reach its wins, and is out when `slots` others are beyond what it can reach.
    That is sufficient only, since others play each other and not all of them can win; teams that the bounds leave
    open are decided exactly, by flows (see elimination).  With draws a game may have no winner.  Games of one pair are
    counted before anything is gathered, so a season is as many rows as it has teams and pairs, and each team is a row
    of its own task.  A team without a row in standings has no wins; a game of a team with itself counts for nothing.
    """
    games = remaining.where("home <> away")
    left = games.select("season", F.explode(F.array("home", "away")).alias("team")).groupBy("season", "team").agg(F.count(F.lit(1)).alias("games_left"))
    teams = standings.select("season", "team", "wins").join(left, ["season", "team"], "full").fillna(0, ["wins", "games_left"])
    met = games.groupBy("season", F.least("home", "away").alias("a"), F.greatest("home", "away").alias("b")).agg(F.count(F.lit(1)).alias("n"))
    # From here on a season is as many entries as it has teams, and pairs with games to come.
    table = teams.groupBy("season").agg(F.collect_list(F.struct("team", F.col("wins").cast("long").alias("wins"), (F.col("wins") + F.col("games_left")).cast("long").alias("best"))).alias("table"))
    pairs = met.groupBy("season").agg(F.collect_list(F.struct("a", "b", "n")).alias("games"))
    rows = table.join(pairs, "season", "left").select("season", "table", "games", F.explode("table").alias("t"))
    count = lambda when: F.size(F.filter("table", lambda o: (o["team"] != F.col("t.team")) & when(o))).cast("long")
    rows = rows.withColumns({"can_reach": count(lambda o: o["best"] >= F.col("t.wins")), "beyond": count(lambda o: o["wins"] > F.col("t.best"))})
    rows = rows.withColumn("bound", F.when(F.col("can_reach") < slots, "clinched").when(F.col("beyond") >= slots, "eliminated"))
    rows = rows.select("season", F.col("t.team").alias("team"), "can_reach", "beyond", "bound", *[F.when(F.col("bound").isNull(), F.col(c)).alias(c) for c in ("table", "games")])
    schema = rows.select("season", "team", "can_reach", "beyond", F.lit("").alias("status")).schema
    return rows.repartition("season", "team").mapInArrow(statuses(slots, draws), schema)


def advance_probability(matchups: DataFrame, cond: DataFrame) -> DataFrame:
    """Sum over opponents of the chance of the match-up times the chance to win it.

    covered is the share of a team's possible match-ups whose outcome has a chance; only if all have one there is a sum.
    """
    rows = matchups.where("p_meet > 0").join(cond, ["team", "opponent"], "left")
    out = rows.groupBy("team").agg(F.sum(F.col("p_meet") * F.col("p_win")).alias("p"), F.count_if(F.col("p_win").isNull()).alias("open"),
                                   (F.coalesce(F.sum(F.when(F.col("p_win").isNotNull(), F.col("p_meet"))), F.lit(0.0)) / F.sum("p_meet")).alias("covered"))
    return out.select("team", F.when(F.col("open") == 0, F.col("p")).alias("p_advance"), "covered")


def outlook_from_draws(draws: DataFrame, slots: int, rule: Sequence[Column]) -> DataFrame:
    """Entry and title shares and mean wins and rank from draws (draw_id, team, wins)."""
    ranked = draws.withColumn("rank", F.rank().over(Window.partitionBy("draw_id").orderBy(*rule)))
    return ranked.groupBy("team").agg(
        F.count(F.lit(1)).alias("draws"), F.avg("wins").alias("wins"), F.avg("rank").alias("mean_rank"),
        F.avg((F.col("rank") <= slots).cast("double")).alias("p_entry"), F.avg((F.col("rank") == 1).cast("double")).alias("p_title"))


def draw_stability(draws: DataFrame, rule: Sequence[Column]) -> DataFrame:
    """Spread of title shares between repeats (repeat, draw_id, team, wins); this is no accuracy."""
    ranked = draws.withColumn("rank", F.rank().over(Window.partitionBy("repeat", "draw_id").orderBy(*rule)))
    per = ranked.groupBy("repeat", "team").agg(F.avg((F.col("rank") == 1).cast("double")).alias("p"))
    return per.groupBy("team").agg(F.count(F.lit(1)).alias("repeats"), F.avg("p").alias("mean"), F.stddev_samp("p").alias("spread"))


def draw_intervals(draws: DataFrame, rule: Sequence[Column], *, replicates: int = 200, level: float = 0.95, seed: int = 1) -> DataFrame:
    """Title shares with bootstrap intervals over whole repeats: what other repeats of as many draws might have shown; this is no accuracy."""
    ranked = draws.withColumn("rank", F.rank().over(Window.partitionBy("repeat", "draw_id").orderBy(*rule)))
    per = ranked.groupBy("team", "repeat").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("rank") == 1).alias("titles"))
    drawn = per.withColumn("b", F.explode(F.sequence(F.lit(1), F.lit(replicates)))).withColumn("w", poisson_weight(F.col("b"), F.col("repeat"), seed))
    share = drawn.groupBy("team", "b").agg(F.try_divide(F.sum(F.col("w") * F.col("titles")).cast("double"), F.sum(F.col("w") * F.col("n"))).alias("p"))
    q = share.groupBy("team").agg(F.percentile("p", F.array(F.lit((1 - level) / 2), F.lit((1 + level) / 2))).alias("q"))
    whole = per.groupBy("team").agg(F.count(F.lit(1)).alias("repeats"), (F.sum("titles") / F.sum("n")).alias("p_title"))
    return whole.join(q, "team").select("team", "repeats", "p_title", F.col("q")[0].alias("lo"), F.col("q")[1].alias("hi"))


def replay_fixed(draws: DataFrame, confirmed: DataFrame) -> DataFrame:
    """Drawn results give way to confirmed ones: draws (draw_id, game_id, cls), confirmed (game_id, cls)."""
    fixed = confirmed.select("game_id", F.col("cls").alias("fixed"))
    return draws.join(fixed, "game_id", "left").select("draw_id", "game_id", F.coalesce("fixed", "cls").alias("cls"), F.col("fixed").isNotNull().alias("is_fixed"))
