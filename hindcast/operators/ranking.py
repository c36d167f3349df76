"""Orders, ranks and first-k choices; every tie is broken by a key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hindcast.sources.durable import durable


def order_events(df: DataFrame, part: Sequence[str], keys: Sequence[str]) -> DataFrame:
    return df.withColumn("seq", F.row_number().over(Window.partitionBy(*part).orderBy(*keys)))


def standings(team_games: DataFrame, by: Sequence[str], rule: Sequence[Column]) -> DataFrame:
    """Wins, losses, draws, win share (draws left out) and rank per group by the caller's keys, best first."""
    won, drawn = F.col("runs") > F.col("allowed"), F.col("runs") == F.col("allowed")
    table = team_games.groupBy(*by, "team").agg(
        F.count_if(won).alias("wins"), F.count_if(~won & ~drawn).alias("losses"), F.count_if(drawn).alias("draws"), F.sum(F.col("runs") - F.col("allowed")).cast("long").alias("run_diff"))
    table = table.withColumn("share", F.try_divide(F.col("wins").cast("double"), F.col("wins") + F.col("losses")))
    return table.withColumn("rank", F.rank().over(Window.partitionBy(*by).orderBy(*rule)))


def head_to_head_break(team_games: DataFrame, table: DataFrame, by: Sequence[str], tie: str, most: int = 64) -> DataFrame:
    """Teams that tie on a column, ranked again by wins among themselves until nothing parts them any more.

    Who still ties after a round is a set of its own, whose games among each other alone count in the next one.  The
    work ends when a round parts no set; its h2h_wins are those of a team's last set, `rounds` how many parted it from
    others, and `open` tells that the team's number broke what was left.  Tied sets are a few teams, and
    a set is parted in fewer rounds than it has teams, so `most` is no bound for real tables.
    """
    tied = table.withColumn("__n", F.count(F.lit(1)).over(Window.partitionBy(*by, tie))).where("__n > 1").select(*by, tie, "team")
    sets = durable(tied.select(*by, tie, "team", F.lit(1).alias("set"), F.lit(0).alias("rounds"), F.lit(0).cast("long").alias("h2h_wins")))
    games = None
    for number in range(1, most + 1):
        rival = sets.select(*by, F.col(tie).alias("__tie"), F.col("team").alias("opponent"), F.col("set").alias("__set"))
        games = team_games.select(*by, "team", "opponent", "runs", "allowed") if games is None else games
        met = games.join(sets.select(*by, tie, "team", "set"), [*by, "team"]).join(rival, [*by, "opponent"]).where(F.col(tie).eqNullSafe(F.col("__tie")) & (F.col("set") == F.col("__set")))
        met = met.drop("__tie", "__set")
        wins = met.groupBy(*by, "team").agg(F.count_if(F.col("runs") > F.col("allowed")).alias("__wins"))
        among = Window.partitionBy(*by, tie, "set")
        rows = sets.join(wins, [*by, "team"], "left").withColumn("__wins", F.coalesce("__wins", F.lit(0)))
        rows = rows.withColumn("__parts", F.size(F.collect_set("__wins").over(among)) > 1).withColumn("__size", F.count(F.lit(1)).over(among))
        # A set begins at the rank of its first team; parts of it begin where rank by wins says.
        new = (F.col("set") + F.rank().over(among.orderBy(F.desc("__wins"))) - 1).cast("int")
        rows = rows.select(*by, tie, "team", new.alias("set"), F.when(F.col("__parts"), number).otherwise(F.col("rounds")).alias("rounds"), F.when(F.col("__size") > 1, F.col("__wins")).otherwise(F.col("h2h_wins")).alias("h2h_wins"), "__parts")
        rows = durable(rows)
        sets = rows.drop("__parts")
        if rows.where("__parts").isEmpty():
            break
        # Only games within a set can matter from now on.
        games = durable(met.drop("set", tie))
    last = Window.partitionBy(*by, tie)
    out = sets.withColumn("open", F.count(F.lit(1)).over(Window.partitionBy(*by, tie, "set")) > 1)
    return out.select(*by, tie, "team", "h2h_wins", "rounds", "open", F.row_number().over(last.orderBy("set", "team")).alias("h2h_rank"))


def top_candidates(scores: DataFrame, by: Sequence[str], k: int, order: Sequence[Column]) -> DataFrame:
    return scores.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= k)


def modal_score(joint: DataFrame, by: Sequence[str], cols: Sequence[str], p: str = "p") -> DataFrame:
    """The likeliest score; of equally likely ones the smallest."""
    best = F.max_by(F.struct(*cols, p), F.struct(F.col(p), *[-F.col(c) for c in cols]))
    return joint.groupBy(*by).agg(best.alias("b")).select(*by, "b.*")


def lineup_estimate(freq: DataFrame, team: str, slot: str, player: str, n: str) -> DataFrame:
    """Slot by slot the most frequent player; a player then keeps the slot used most, so some slots stay empty."""
    first = Window.partitionBy(team, slot).orderBy(F.desc(n), player)
    one = Window.partitionBy(team, player).orderBy(F.desc(n), slot)
    chosen = freq.withColumn("__a", F.row_number().over(first)).where("__a = 1").withColumn("__b", F.row_number().over(one))
    slots = freq.select(team, slot).distinct()
    return slots.join(chosen.where("__b = 1").select(team, slot, player, n), [team, slot], "left")
