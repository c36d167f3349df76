"""Window features: frames end before the current row, so a row never sees itself."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hindcast.operators import slices


def rolling_days(df: DataFrame, part: Sequence[str], ts: str, n: int, cols: Sequence[str], *, by_day: bool = False) -> DataFrame:
    """Totals of the last n days, the row's own day left out; null where there is nothing.

    by_day sums each key's days first, with partial sums, runs the window over days and joins rows to their day: a key
    with very many rows is then no more rows in one task than it has days.
    """
    day = F.unix_date(F.col(ts).cast("date"))
    w = Window.partitionBy(*part).orderBy(day if not by_day else "__day").rangeBetween(-n, -1)
    if not by_day:
        return df.withColumns({f"{c}_{n}d": F.sum(c).over(w) for c in cols})
    days = df.groupBy(*part, day.alias("__day")).agg(*[F.sum(c).alias(f"__{c}") for c in cols])
    totals = days.select(*[F.col(k).alias(f"__key_{k}") for k in part], F.col("__day").alias("__of"), *[F.sum(f"__{c}").over(w).alias(f"{c}_{n}d") for c in cols])
    same = slices._same(part, "__key_") & day.eqNullSafe(F.col("__of"))
    return df.join(totals, same, "left").select(*df.columns, *[f"{c}_{n}d" for c in cols])


def rolling_games(df: DataFrame, part: Sequence[str], order: Sequence[str], n: int, cols: Sequence[str]) -> DataFrame:
    w = Window.partitionBy(*part).orderBy(*order).rowsBetween(-n, -1)
    return df.withColumns({f"{c}_{n}g": F.sum(c).over(w) for c in cols})


def expanding(df: DataFrame, part: Sequence[str], order: Sequence[str], cols: Sequence[str], *, hot: int | None = None) -> DataFrame:
    """Totals of all rows before; null where there is nothing.

    With hot, keys with more rows than that are cut into slices by the first order column: sums within a slice, plus
    the totals of the slices before it.
    """
    before = lambda keys: Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    if hot is None:
        return df.withColumns({f"{c}_before": F.sum(c).over(before(part)) for c in cols})
    rows = slices.sliced(df, part, order[0], slices.cuts(df, part, order[0], hot))
    keys = [*part, slices.SLICE]
    totals = rows.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in cols])
    carry = slices.carried(totals, part, {f"__carried_{c}": F.sum(c) for c in cols})
    rows = slices.with_carried(rows.withColumns({f"__own_{c}": F.sum(c).over(before(keys)) for c in cols}), carry, part)
    own, old = (lambda c: F.col(f"__own_{c}")), (lambda c: F.col(f"__carried_{c}"))
    return rows.select(*df.columns, *[F.coalesce(own(c) + old(c), own(c), old(c)).alias(f"{c}_before") for c in cols])


def previous_pitch(df: DataFrame, part: Sequence[str], order: Sequence[str], cols: Sequence[str], k: int = 1) -> DataFrame:
    w = Window.partitionBy(*part).orderBy(*order)
    return df.withColumns({f"prev{k}_{c}": F.lag(c, k).over(w) for c in cols})


def count_before(df: DataFrame, part: Sequence[str], order: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Balls, strikes or outs before the current pitch: zero at the start."""
    w = Window.partitionBy(*part).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumns({f"{c}_before": F.coalesce(F.sum(c).over(w), F.lit(0)).cast("long") for c in cols})


def assign_pa(df: DataFrame, part: Sequence[str], order: Sequence[str], ends: str) -> DataFrame:
    """Plate appearance numbers from 0: a terminal event ends its own, and the next row opens another."""
    w = Window.partitionBy(*part).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn("pa_id", F.coalesce(F.sum(ends).over(w), F.lit(0)).cast("long"))


def runs_remaining(df: DataFrame, part: Sequence[str], order: Sequence[str], runs: str) -> DataFrame:
    w = Window.partitionBy(*part).orderBy(*order).rowsBetween(0, Window.unboundedFollowing)
    return df.withColumn("runs_remaining", F.sum(runs).over(w).cast("long"))


def rest_days(df: DataFrame, part: Sequence[str], ts: str, order: Sequence[str]) -> DataFrame:
    """Days since the previous appearance; null for the first."""
    w = Window.partitionBy(*part).orderBy(*order)
    return df.withColumn("rest_days", F.date_diff(F.col(ts).cast("date"), F.lag(F.col(ts).cast("date")).over(w)))


def detect_change(df: DataFrame, part: Sequence[str], order: Sequence[str], who: str) -> DataFrame:
    """Rows whose participant differs from the row before; the first row of a part is no change."""
    w = Window.partitionBy(*part).orderBy(*order)
    marked = df.withColumn("previous", F.lag(who).over(w)).withColumn("__n", F.row_number().over(w))
    return marked.where((F.col("__n") > 1) & ~F.col(who).eqNullSafe(F.col("previous"))).drop("__n")


def steal_events(df: DataFrame, part: Sequence[str], order: Sequence[str], is_running: Column, outs: str, runner: str) -> DataFrame:
    """Explicit running events with what the next row shows: an out more, or the runner moved."""
    w = Window.partitionBy(*part).orderBy(*order)
    seen = df.withColumn("outs_after", F.lead(outs).over(w)).withColumn("runner_after", F.lead(runner).over(w))
    verdict = F.when(F.col("outs_after").isNull(), "unconfirmed").when(F.col("outs_after") > F.col(outs), "caught").when(~F.col(runner).eqNullSafe(F.col("runner_after")), "stolen").otherwise("no change")
    return seen.where(is_running).withColumn("verdict", verdict)


def reliability_bins(preds: DataFrame, p: str, y: str, n: int) -> DataFrame:
    """Bins of equal width: count, mean forecast and observed rate."""
    b = F.least(F.floor(F.col(p) * n), F.lit(n - 1)).cast("long").alias("bin")
    return preds.groupBy(b).agg(F.count(F.lit(1)).alias("n"), F.avg(p).alias("mean_p"), F.avg(F.col(y).cast("double")).alias("rate"))
