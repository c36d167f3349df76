"""Distributed pyspark.ml estimators, one shared model per problem; every family is our choice."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GeneralizedLinearRegression, IsotonicRegression, LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _fit(train: DataFrame, features: Sequence[str], *stages) -> PipelineModel:
    return Pipeline(stages=[VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="skip"), *stages]).fit(train)


def fit_runs(train: DataFrame, features: Sequence[str], label: str = "runs") -> PipelineModel:
    """Runs of a team in a game: one Poisson model for both sides, on team-view rows."""
    return _fit(train, features, GeneralizedLinearRegression(family="poisson", labelCol=label, maxIter=15, regParam=1e-6))


def fit_pa(train: DataFrame, features: Sequence[str], label: str = "cls") -> PipelineModel:
    """Class probabilities of a plate appearance."""
    return _fit(train, features, StringIndexer(inputCol=label, outputCol="label", handleInvalid="skip", stringOrderType="alphabetAsc"),
                LogisticRegression(family="multinomial", maxIter=20, regParam=1e-4))


def fit_player(train: DataFrame, role: str, features: Sequence[str], label: str = "y") -> PipelineModel:
    """Counts of a role over long (stat, horizon) rows; exposure is a stat of its own, never the future's actual one."""
    return _fit(train.where(F.col("role") == role), features, GeneralizedLinearRegression(family="poisson", labelCol=label, maxIter=15, regParam=1e-6))


def fit_win(train: DataFrame, features: Sequence[str], label: str = "won") -> PipelineModel:
    return _fit(train, features, LogisticRegression(labelCol=label, maxIter=20, regParam=1e-4))


def fit_linear(train: DataFrame, features: Sequence[str], label: str) -> PipelineModel:
    """Least squares, from one sum of the outer products."""
    return _fit(train, features, LinearRegression(labelCol=label, solver="normal"))


def location_rows(rows: DataFrame, features: Sequence[str], axes: Sequence[str] = ("plate_x", "plate_z")) -> tuple[DataFrame, list[str]]:
    """A row per known coordinate, with what the location model takes of it: features, the axis, and both crossed."""
    long = rows.unpivot([c for c in rows.columns if c not in axes], list(axes), "axis", "coordinate").where("coordinate is not null")
    long = long.withColumn("is_second", (F.col("axis") == axes[1]).cast("double"))
    crossed = [f"{c}_x_axis" for c in features]
    return long.withColumns({x: F.col(c) * F.col("is_second") for x, c in zip(crossed, features)}), [*features, "is_second", *crossed]


def fit_pitch(train: DataFrame, features: Sequence[str], joint: str = "joint", axes: Sequence[str] = ("plate_x", "plate_z")) -> tuple[PipelineModel, PipelineModel]:
    """(joint type and result, location): the location model has one row per axis, told apart by features."""
    long, names = location_rows(train.select(*features, *axes), features, axes)
    return fit_pa(train, features, joint), _fit(long, names, LinearRegression(labelCol="coordinate", maxIter=20, regParam=1e-4))


def class_probabilities(model: PipelineModel, df: DataFrame, key: Sequence[str]) -> DataFrame:
    """(key..., cls, p) of a fitted multinomial model."""
    labels = next(s for s in model.stages if hasattr(s, "labels")).labels
    rows = model.transform(df).select(*key, F.posexplode(vector_to_array("probability")).alias("at", "p"))
    return rows.select(*key, F.element_at(F.array(*[F.lit(x) for x in labels]), F.col("at") + 1).alias("cls"), "p")


def score_balance(rows: DataFrame, features: Sequence[str], outcomes: Mapping[str, tuple[Column, Column]], tolerance: float = 0.1) -> DataFrame:
    """(outcome, feature, n, observed, fitted, balanced): the score equations of a fit on its training rows, in one aggregate.

    At the maximum of the likelihood of these families (Poisson and logistic with their own links, least squares) each
    feature's total over the outcome equals its total over the fitted values, and nowhere else, for they are concave.
    outcomes maps a name to (observed, fitted).  balanced says that the score is within `tolerance` of its
    standard error, by the sum of its squares, so that the fit's penalty and its last step are small against
    what the data can tell; feature "" is the intercept.
    """
    terms = [(name, c, F.lit(1.0) if c == "" else F.col(c).cast("double"), y.cast("double"), mu) for name, (y, mu) in outcomes.items() for c in ("", *features)]
    sums = [F.struct(F.lit(name).alias("outcome"), F.lit(c).alias("feature"), F.count(x * (y - mu)).alias("n"), F.sum(F.when((x * (y - mu)).isNotNull(), x * y)).alias("observed"),
                     F.sum(F.when((x * (y - mu)).isNotNull(), x * mu)).alias("fitted"), F.sum(F.pow(x * (y - mu), F.lit(2))).alias("squares")) for name, c, x, y, mu in terms]
    out = rows.agg(F.array(*sums).alias("t")).select(F.explode("t").alias("t")).select("t.*")
    return out.withColumn("balanced", F.abs(F.col("observed") - F.col("fitted")) <= tolerance * F.sqrt("squares")).drop("squares")


def class_balance(model: PipelineModel, train: DataFrame, features: Sequence[str], label: str, tolerance: float = 0.1) -> DataFrame:
    """score_balance of a multinomial model, an outcome per class."""
    labels = next(s for s in model.stages if hasattr(s, "labels")).labels
    rows = model.transform(train).withColumn("__p", vector_to_array("probability"))
    return score_balance(rows, features, {c: ((F.col(label) == c).cast("double"), F.col("__p")[k]) for k, c in enumerate(labels)}, tolerance)


def calibrate_isotonic(calib: DataFrame, preds: DataFrame, p: str = "p", y: str = "y") -> DataFrame:
    """A monotone map fitted on an earlier slice, applied to later forecasts."""
    model = IsotonicRegression(featuresCol=p, labelCol=y, predictionCol="calibrated").fit(calib.select(F.col(p).cast("double").alias(p), F.col(y).cast("double").alias(y)))
    return model.transform(preds)


def linear_contributions(df: DataFrame, coefficients: Sequence[float], train_means: DataFrame, features: Sequence[str], key: Sequence[str]) -> DataFrame:
    """(key..., feature, contribution): coefficient times the distance from the training mean; not causal."""
    means = train_means.select(*[F.col(c).alias(f"__{c}") for c in features])
    rows = df.crossJoin(F.broadcast(means))  # one row
    rows = rows.select(*key, *[(F.lit(float(w)) * (F.col(c) - F.col(f"__{c}"))).alias(c) for c, w in zip(features, coefficients)])
    return rows.unpivot(list(key), list(features), "feature", "contribution")


def mean_contributions(contributions: DataFrame) -> DataFrame:
    return contributions.groupBy("feature").agg(F.avg(F.abs("contribution")).alias("mean_abs"))


def predict_saved(df: DataFrame, path: str) -> DataFrame:
    """Scores with a stored model; nothing is fitted."""
    return PipelineModel.load(path).transform(df)
