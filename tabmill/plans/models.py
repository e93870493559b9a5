"""The study's five model families and the soft / mean voting ensembles.

Forests and boosting are grown by ``tabmill.trees`` (their parameters have Spark ML's names where it has them); linear and
logistic regression are Spark ML's. L2 logistic regression with strength C maps to regParam = 1 / (C * n_train) without
feature standardisation (the features are standardised beforehand).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.linalg import DenseVector, Vectors
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabmill.trees.boosting import BoostingFit, BoostParams, fit_boosting
from tabmill.trees.forest import ForestParams, RandomForestFit, fit_forest

SEED = 42
NO_DEPTH_LIMIT = 0
MODEL_ORDER = ["RF", "XGB", "LGB", "GB", "LR"]
VOTE_MEMBERS = ["RF", "XGB", "LGB", "GB"]
BOOSTING = ("XGB", "LGB", "GB")

# fixed values: library defaults of the untuned models (used by the vote)
DEFAULTS = {
    "RF": {"numTrees": 100, "maxDepth": NO_DEPTH_LIMIT, "minInstancesPerNode": 1, "minRowsToSplit": 2},
    "XGB": {"maxIter": 100, "maxDepth": 6, "stepSize": 0.3, "regLambda": 1.0, "regAlpha": 0.0},
    "LGB": {"maxIter": 100, "maxDepth": NO_DEPTH_LIMIT, "stepSize": 0.1, "numLeaves": 31, "minInstancesPerNode": 20},
    "GB": {"maxIter": 100, "maxDepth": 3, "stepSize": 0.1, "minRowsToSplit": 2},
    "LR": {},
}

# Smaller members for quick runs (tests, driver checks): same families.
LIGHT = {
    "RF": {"numTrees": 20, "maxDepth": 5, "minInstancesPerNode": 1},
    "XGB": {"maxIter": 10, "maxDepth": 4, "stepSize": 0.3},
    "LGB": {"maxIter": 10, "maxDepth": 4, "stepSize": 0.1, "minInstancesPerNode": 20},
    "GB": {"maxIter": 10, "maxDepth": 3, "stepSize": 0.1},
    "LR": {},
}

# fixed values: what the boosting libraries do unless told otherwise
_FAMILY = {
    "XGB": {"l2": 1.0, "min_hessian": 1.0},
    "LGB": {"leaves": 31, "min_rows": 20, "min_hessian": 1e-3, "rate": 0.1},
    "GB": {"newton": False, "rate": 0.1, "depth": 3},
}
_BOOST_NAMES = {"maxIter": "rounds", "maxDepth": "depth", "stepSize": "rate", "regLambda": "l2", "regAlpha": "l1", "numLeaves": "leaves",
                "minInstancesPerNode": "min_rows", "minRowsToSplit": "min_split"}
_FOREST_NAMES = {"numTrees": "trees", "maxDepth": "depth", "minInstancesPerNode": "min_leaf", "minRowsToSplit": "min_split"}


def boost_params(name: str, params: dict) -> BoostParams:
    return BoostParams(**{**_FAMILY[name], **{_BOOST_NAMES[k]: v for k, v in params.items()}})


def forest_params(kind: str, params: dict) -> ForestParams:
    """Regression splits look at all features, classification at the square root of their number."""
    return ForestParams(features="all" if kind == "regression" else "sqrt", seed=SEED, **{_FOREST_NAMES[k]: v for k, v in params.items()})


class TreeModel:
    """A fitted forest or boosting model with the columns of a Spark ML one: ``prediction`` (0 / 1 for labels, then with class
    1's probability in ``p``)."""

    def __init__(self, fit: RandomForestFit | BoostingFit, kind: str, suffix: str = ""):
        self.fit, self.kind, self.suffix = fit, kind, suffix

    @property
    def featureImportances(self) -> DenseVector:  # noqa: N802 - as Spark ML names it
        return Vectors.dense(self.fit.importances)

    def transform(self, df: DataFrame) -> DataFrame:
        out, prediction = f"p{self.suffix}", f"prediction{self.suffix}"
        scored = self.fit.score(df, out)
        label = F.col(out) if self.kind == "regression" else (F.col(out) > 0.5).cast("double")
        return scored.withColumn(prediction, label)


class RandomForestTreeModel(TreeModel):
    pass


class BoostingTreeModel(TreeModel):
    pass


@dataclass
class TreeLearner:
    name: str
    kind: str
    params: dict
    suffix: str = ""

    def fit(self, train: DataFrame) -> TreeModel:
        if self.name == "RF":
            return RandomForestTreeModel(fit_forest(train, forest_params(self.kind, self.params)), self.kind, self.suffix)
        fits, _ = fit_boosting([(train, None)], [(0, boost_params(self.name, self.params))], self.kind)
        return BoostingTreeModel(fits[0], self.kind, self.suffix)


@dataclass
class Prepared:
    """Assembled, standardised train and test frames for one task."""
    train: DataFrame
    test: DataFrame
    features: list[str]
    n_train: int
    folds: list[tuple[DataFrame, DataFrame]]  # (fit rows, validation rows)


def assemble(df: DataFrame, features: list[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=features, outputCol=out, handleInvalid="error").transform(df)


def build(name: str, kind: str, params: dict | None = None, n_train: int | None = None,
          suffix: str = "") -> object:
    """A learner for model family ``name``; ``params`` go by Spark ML's names (``C`` for logistic regression is turned into
    regParam)."""
    params = dict(params or {})
    if name == "RF" or name in BOOSTING:
        return TreeLearner(name, kind, params, suffix)
    cols = {"featuresCol": "features", "labelCol": "y", "predictionCol": f"prediction{suffix}"}
    if kind == "classification":
        cols.update(probabilityCol=f"probability{suffix}", rawPredictionCol=f"raw{suffix}")
    if name == "LR":
        if kind == "regression":
            cols.pop("probabilityCol", None)
            cols.pop("rawPredictionCol", None)
            return LinearRegression(solver="normal", regParam=0.0, **cols, **params)
        c = params.pop("C", 1.0)
        n = max(n_train or 1, 1)
        return LogisticRegression(regParam=1.0 / (c * n), elasticNetParam=0.0,
                                  standardization=False, **cols, **params)
    raise ValueError(f"unknown model {name}")


def positive_probability(col: str = "probability") -> F.Column:
    return vector_to_array(F.col(col))[1]


def predict(model, df: DataFrame, kind: str, suffix: str = "") -> DataFrame:
    out = model.transform(df)
    if kind == "classification":
        if not isinstance(model, TreeModel):
            out = out.withColumn(f"p{suffix}", positive_probability(f"probability{suffix}"))
        out = out.withColumn(f"yhat{suffix}", F.col(f"prediction{suffix}").cast("int"))
    else:
        out = out.withColumn(f"p{suffix}", F.col(f"prediction{suffix}"))
    return out


def fit_vote(train: DataFrame, kind: str, members: list[str] = VOTE_MEMBERS,
             params: dict[str, dict] | None = None, n_train: int | None = None) -> list:
    """Every member on the same train frame; the boosting members grow together, in the same passes."""
    params = params or DEFAULTS
    learners = [build(m, kind, params.get(m), n_train, suffix=f"_{m.lower()}") for m in members]
    boosted = [x for x in learners if isinstance(x, TreeLearner) and x.name in BOOSTING]
    fits = iter(fit_boosting([(train, None)], [(0, boost_params(x.name, x.params)) for x in boosted], kind)[0] if boosted else [])
    return [BoostingTreeModel(next(fits), kind, x.suffix) if x in boosted else x.fit(train) for x in learners]


def predict_vote(models: list, df: DataFrame, kind: str, members: list[str] = VOTE_MEMBERS) -> DataFrame:
    """Members score the same rows one after another (projections, no join);
    the vote is the mean prediction (regression) or mean positive-class
    probability with class 1 above 0.5 (classification; a tie goes to 0)."""
    out = df
    for m, model in zip(members, models):
        out = predict(model, out, kind, suffix=f"_{m.lower()}")
    ps = [F.col(f"p_{m.lower()}") for m in members]
    mean = ps[0]
    for p in ps[1:]:
        mean = mean + p
    mean = mean / F.lit(float(len(ps)))
    out = out.withColumn("p", mean)
    if kind == "classification":
        out = out.withColumn("yhat", (F.col("p") > F.lit(0.5)).cast("int"))
    else:
        out = out.withColumn("prediction", F.col("p"))
    return out


def importances(model, features: list[str]) -> list[tuple[str, float]]:
    """(feature, importance) from a tree model (sums to 1)."""
    v = model.featureImportances.toArray()
    return [(f, float(x)) for f, x in zip(features, v)]


def vote_long(preds: DataFrame, keys: list[str], kind: str) -> DataFrame:
    """The same vote over a long prediction table (one row per model and
    row): a grouped mean of p per row key, class 1 above 0.5."""
    out = preds.groupBy(*keys).agg(F.avg("p").alias("p"))
    if kind == "classification":
        out = out.withColumn("yhat", (F.col("p") > F.lit(0.5)).cast("int"))
    return out
