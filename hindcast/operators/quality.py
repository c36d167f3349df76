"""Quality checks: each returns the failing rows, or counts with their denominators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hindcast.operators.gates import split_reasons


def qc_types(df: DataFrame, schema: Mapping[str, str]) -> DataFrame:
    """Rows in which a present value doesn't convert to its declared type; bad_columns names them."""
    bad = F.array_compact(F.array(*[F.when(F.col(c).isNotNull() & F.col(c).try_cast(t).isNull(), c) for c, t in schema.items()]))
    return df.withColumn("bad_columns", F.array_join(bad, ",")).where("bad_columns <> ''")


def qc_nulls(df: DataFrame) -> DataFrame:
    """(column_name, nulls, n)."""
    counts = df.agg(F.count(F.lit(1)).alias("n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return counts.unpivot("n", list(df.columns), "column_name", "nulls")


def qc_duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def dedupe(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the first in an order that must be total."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def qc_range(df: DataFrame, rules: Mapping[str, tuple]) -> DataFrame:
    """Rows with a present value outside [low, high]; bad_columns names them."""
    bad = F.array_compact(F.array(*[F.when(~F.col(c).between(F.lit(lo), F.lit(hi)), c) for c, (lo, hi) in rules.items()]))
    return df.withColumn("bad_columns", F.array_join(bad, ",")).where("bad_columns <> ''")


def qc_reference(df: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    return df.join(dim.select(key).distinct(), key, "left_anti")


def qc_order(df: DataFrame, part: Sequence[str], seq: str, ts: str) -> DataFrame:
    """Rows after a gap in the sequence or with a time before their predecessor's."""
    w = Window.partitionBy(*part).orderBy(seq)
    df = df.withColumn("gap", F.col(seq) - F.lag(seq).over(w) > 1).withColumn("backwards", F.col(ts) < F.lag(ts).over(w))
    return df.where("coalesce(gap, false) or coalesce(backwards, false)")


def qc_repeat_outcome(df: DataFrame, pa_keys: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Rows beside distinct plate appearances: what counting outcomes by row would add."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct(*pa_keys).alias("n_pa"))


def qc_reconcile(events: DataFrame, official: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Keys whose event sums differ from the official totals, or that one side lacks."""
    sums = events.groupBy(*keys).agg(F.sum(value).alias("from_events"))
    both = sums.join(official.select(*keys, F.col(value).alias("official")), list(keys), "full")
    return both.where(~F.col("from_events").eqNullSafe(F.col("official")))


def quarantine(df: DataFrame, rules: Sequence[tuple[str, Column]]) -> tuple[DataFrame, DataFrame]:
    return split_reasons(df, rules)


def quality_report(results: Mapping[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """(check_name, failures, checked) from each check's failing rows and the rows it looked at."""
    rows = [bad.agg(F.count(F.lit(1)).alias("failures")).select(F.lit(name).alias("check_name"), "failures").crossJoin(
        of.agg(F.count(F.lit(1)).alias("checked"))) for name, (bad, of) in results.items()]
    return reduce(DataFrame.unionByName, rows)


def conditional_verdict(truth: DataFrame, found: DataFrame, key: str, item: str, limits: tuple[float, float]) -> DataFrame:
    """Per item: missing and misclassified shares, and include / limit / exclude by the caller's two limits."""
    both = truth.select(key, F.col(item).alias("t")).join(found.select(key, F.col(item).alias("f")), key, "full")
    counts = both.where("t is not null").groupBy(F.col("t").alias(item)).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("f").isNull()).alias("missing"), F.count_if(F.col("f") != F.col("t")).alias("wrong"))
    worst = (F.col("missing") + F.col("wrong")) / F.col("n")
    return counts.withColumn("verdict", F.when(worst <= limits[0], "include").when(worst <= limits[1], "limit").otherwise("exclude"))


def qc_counts(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Rows with a negative count or a part above its whole."""
    bad = reduce(lambda a, b: a | b, [(F.col(a) < 0) | (F.col(b) < 0) | (F.col(a) > F.col(b)) for a, b in pairs])
    return df.where(F.coalesce(bad, F.lit(False)))


def qc_no_overlap(actual: DataFrame, remaining: DataFrame, key: str, ends: str, begins: str) -> DataFrame:
    """Keys whose actual part doesn't end exactly where the remaining part begins: 'overlap' or 'gap'.

    A key that has only one of the parts is a gap.
    """
    both = actual.join(remaining, key, "full")
    problem = F.when(F.col(ends) > F.col(begins), "overlap").when(~F.col(ends).eqNullSafe(F.col(begins)) | F.col(ends).isNull(), "gap")
    return both.withColumn("problem", problem).where("problem is not null")


def qc_probability(df: DataFrame, key: Sequence[str], p: str = "p", tolerance: float = 1e-9) -> DataFrame:
    """Keys whose probabilities leave [0, 1], don't add up to 1, or are unknown."""
    value = F.col(p).cast("double")
    sums = df.groupBy(*key).agg(F.sum(p).alias("total"), F.min(p).alias("least"), F.max(p).alias("most"), F.count_if(value.isNull() | F.isnan(value)).alias("unknown"))
    return sums.where((F.abs(F.col("total") - 1) > tolerance) | (F.col("least") < 0) | (F.col("most") > 1) | (F.col("unknown") > 0))


def qc_joint_marginal(joint: DataFrame, marginal: DataFrame, key: Sequence[str], p: str = "p", tolerance: float = 1e-9) -> DataFrame:
    sums = joint.groupBy(*key).agg(F.sum(p).alias("from_joint"))
    both = sums.join(marginal.select(*key, F.col(p).alias("reported")), list(key), "full")
    return both.where(~F.coalesce(F.abs(F.col("from_joint") - F.col("reported")) <= tolerance, F.lit(False)))


def qc_score_wdl(dist: DataFrame, wdl: DataFrame, tolerance: float = 1e-9) -> DataFrame:
    """Games whose win/draw/loss differs from the regions of the score distribution (game_id, h, a, p)."""
    from hindcast.operators.value import wdl_from_scores

    both = wdl_from_scores(dist).join(wdl.select("game_id", *[F.col(c).alias(f"{c}_reported") for c in ("p_home", "p_draw", "p_away")]), "game_id", "full")
    good = reduce(lambda a, b: a & b, [F.abs(F.col(c) - F.col(f"{c}_reported")) <= tolerance for c in ("p_home", "p_draw", "p_away")])
    return both.where(~F.coalesce(good, F.lit(False)))


def qc_final_state(states: DataFrame) -> DataFrame:
    """Last states of games that still promise runs or whose win value isn't settled."""
    return states.where("is_final and (coalesce(runs_remaining, -1) <> 0 or coalesce(win_value, -1) not in (0.0, 0.5, 1.0))")
