"""Scalar expressions: Columns in, Columns out."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def monday_anchor(ts: Column, tz: str | None = None) -> Column:
    """The Monday (a date) of a moment; tz converts UTC instants to league time first, league-local input needs none."""
    return F.trunc((F.from_utc_timestamp(ts, tz) if tz else ts).cast("date"), "week")


def horizon_end(anchor: Column, days: int) -> Column:
    return F.date_add(anchor, days)


def status_enum(confirmed: Column, predicted: Column, assumed: Column, evaluable: Column) -> Column:
    """One of five output states; what can't be evaluated comes before all others."""
    return (F.when(~evaluable, "not evaluable").when(confirmed, "confirmed").when(predicted, "predicted").when(assumed, "assumed").otherwise("undetermined"))


def null_not_zero(x: Column, reason: str) -> Column:
    """Keeps null apart from zero: a struct of value and, for null only, the reason."""
    return F.struct(x.alias("value"), F.when(x.isNull(), F.lit(reason)).alias("reason"))


def ratio_of(num: Column, den: Column) -> Column:
    """num / den as a struct (num, den, value, reason); a zero or missing denominator gives null and says so."""
    reason = F.when(den.isNull(), "no denominator").when(den == 0, "zero denominator")
    return F.struct(num.alias("num"), den.alias("den"), F.try_divide(num.cast("double"), den.cast("double")).alias("value"), reason.alias("reason"))


def neg_log(p: Column, eps: float) -> Column:
    return -F.log(F.greatest(p, F.lit(eps)))


def one_hot_sq(p: Column, cls: Column, truth: Column) -> Column:
    return F.pow(p - F.when(cls == truth, 1.0).otherwise(0.0), F.lit(2))


def euclid(dx: Column, dy: Column) -> Column:
    return F.sqrt(dx * dx + dy * dy)


def perspective_flip(p: Column, definition: str) -> Column:
    """A win value from the other team's view; only a win share (draws count half) may be flipped."""
    if definition != "win_share":
        raise ValueError("only a win share can be seen from the other side: a win probability leaves draws out")
    return 1 - p


def round_score(mean: Column) -> Column:
    return F.struct(F.round(mean).cast("long").alias("score"), F.lit("mean_rounded").alias("rule"))


def outs_as_innings(outs: Column) -> Column:
    """Whole innings and thirds; never decimal arithmetic."""
    return F.concat_ws(" ", F.floor(outs / 3).cast("long").cast("string"), F.concat((outs % 3).cast("string"), F.lit("/3")))
