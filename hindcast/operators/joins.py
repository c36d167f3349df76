"""Joins: equi joins by name, and the as-of and horizon joins rewritten so that no nested loop is planned."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hindcast.functions.scalars import monday_anchor
from hindcast.functions.sizes import few
from hindcast.operators import slices


def join_ids(a: DataFrame, b: DataFrame, on: Sequence[str]) -> DataFrame:
    return a.join(b, list(on), "inner")


def join_population(pop: DataFrame, logs: DataFrame, on: Sequence[str]) -> DataFrame:
    """Every member, with or without records; nothing is filled with zero."""
    return pop.join(logs, list(on), "left")


def join_missing(targets: DataFrame, rows: DataFrame, on: Sequence[str]) -> DataFrame:
    return targets.join(rows, list(on), "left_anti")


def join_common_sample(a: DataFrame, b: DataFrame, on: Sequence[str]) -> DataFrame:
    return a.join(b, list(on), "left_semi")


def join_asof_snapshot(left: DataFrame, snaps: DataFrame, by: Sequence[str], l_ts: str, r_ts: str, values: Sequence[str], seq: tuple[str, str] | None = None, *, hot: int | None = None) -> DataFrame:
    """Each left row with the values of the last snapshot before it; an equal instant counts only by sequence.

    One window over both sides: per key, in time order, the last snapshot so
    far.  At one instant a request stands before the snapshots, unless the
    sequence columns (left, right) say otherwise.

    With hot, keys with more rows than that are cut into time slices; the window
    runs within a slice, and the last snapshot of the slices before is carried into it.
    """
    by, values = list(by), list(values)
    payload = F.struct(*[F.col(c) for c in left.columns])
    order = (lambda side, name: F.col(name) if seq else F.lit(side))
    l_rows = left.select(*by, F.col(l_ts).alias("__ts"), order(0, seq[0] if seq else "").cast("long").alias("__seq"), F.lit(0).alias("__side"), payload.alias("__left"))
    r_rows = snaps.select(*by, F.col(r_ts).alias("__ts"), order(1, seq[1] if seq else "").cast("long").alias("__seq"), F.lit(1).alias("__side"),
                          F.struct(F.col(r_ts).alias("snapshot_ts"), *[F.col(c) for c in values]).alias("__snap"))
    both, part = l_rows.unionByName(r_rows, allowMissingColumns=True), by
    if hot is not None:
        found = slices.cuts(both, by, "__ts", hot)
        both, part = slices.sliced(both, by, "__ts", found), [*by, slices.SLICE]
    w = Window.partitionBy(*part).orderBy("__ts", "__seq", "__side").rowsBetween(Window.unboundedPreceding, -1)
    out = both.withColumn("__last", F.last("__snap", ignorenulls=True).over(w)).where("__side = 0")
    if hot is not None:
        # The last snapshot of each slice, null times and sequences first as in the window, and from it the last of all slices before.
        place = F.struct("__ts", "__seq")
        summary = both.where("__side = 1").groupBy(*part).agg(F.max_by("__snap", place).alias("__snap"))
        slots = both.groupBy(*part).agg(F.lit(1).alias("__n")).join(summary.select(*[F.col(k).alias(f"__{k}") for k in by], F.col(slices.SLICE).alias("__at"), "__snap"), slices._same(by, "__") & (F.col(slices.SLICE) == F.col("__at")), "left").select(*part, "__snap")
        carry = slices.carried(slots, by, {"__carried": F.last("__snap", ignorenulls=True)})
        out = slices.with_carried(out, carry, by).withColumn("__last", F.coalesce("__last", "__carried"))
    return out.select("__left.*", "__last.*")


def horizon_rows(logs: DataFrame, ts: str, days: int) -> DataFrame:
    """Each log row once per Monday anchor whose [anchor, anchor + days) holds it; days is a multiple of 7."""
    week = monday_anchor(F.col(ts))
    return logs.withColumn("anchor", F.explode(F.array(*[F.date_sub(week, 7 * k) for k in range(days // 7)])))


def join_horizon(logs: DataFrame, anchors: DataFrame, ts: str, days: int) -> DataFrame:
    """Log rows with the anchors (a table of Mondays, named anchor) they fall under: an equi join, not a range join."""
    return horizon_rows(logs, ts, days).join(anchors.select("anchor").distinct(), "anchor")


def join_rest_of_season(logs: DataFrame, anchors: DataFrame, ts: str, season: str, end: str) -> DataFrame:
    """Logs on or after an anchor and before its season's end; anchors has (season, anchor, end)."""
    both = logs.join(anchors, season)
    return both.where((F.col(ts) >= F.col("anchor")) & (F.col(ts) < F.col(end)))


def join_boundary_pair(states: DataFrame, game: str, order: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Each state with the next one of its game: structs pre and post (null after the last)."""
    state = F.struct(*cols)
    return states.withColumn("pre", state).withColumn("post", F.lead(state).over(Window.partitionBy(game).orderBy(*order)))


def join_panel(players: DataFrame, anchors: DataFrame) -> DataFrame:
    """Every player at every anchor, whoever appears later; anchors is a table of Mondays, a few hundred rows."""
    return players.crossJoin(few(anchors))


def join_season_rules(df: DataFrame, rules: DataFrame, on: Sequence[str]) -> DataFrame:
    """Adds the rule version of the season; rules has a row per season and version."""
    return df.join(rules, list(on), "left")


def join_participants(pa: DataFrame, keys: Sequence[str], order: Column, who: str) -> DataFrame:
    """The participant at the start of a plate appearance apart from the one credited at its end."""
    return pa.groupBy(*keys).agg(F.min_by(who, order).alias("started"), F.max_by(who, order).alias("credited"))
