"""Churn and lifetime-value models: boosted trees, also for the quantiles of a band; or a forest."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import Imputer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.staging import stage
from tidemark.operators.boosting import Ensemble, Growth, Objective, grow
from tidemark.operators.evaluation import (
    best_threshold,
    class_weights,
    risk_level,
    temporal_split,
    threshold_scores,
)
from tidemark.operators.panes import PACKED, many
from tidemark.sources.tables import load_model, load_table, save_model, save_table

KEYS = ["customer_id", "snapshot_date"]
# Columns that are never model inputs.
NOT_FEATURES = (
    "customer_id",
    "snapshot_date",
    "observation_start_date",
    "observation_window_days",
    "segment",
    "segment_name",
    "churn_label",
    "clv_target",
    "is_censored",
    "split",
    "weight",
)


@dataclass(frozen=True)
class TreeRules(Growth):
    forest_trees: int = 100


def model_columns(rows: DataFrame) -> list[str]:
    return [c for c in rows.columns if c not in NOT_FEATURES]


def training_rows(features: DataFrame, targets: DataFrame, target: str) -> DataFrame:
    """Features with the target of the same customer *and* snapshot, split by time.

    Written once: the split, the weights and every training pass read it.
    """
    joined = features.join(targets.select(*KEYS, target), KEYS)
    doubles = {c: F.col(c).cast("double") for c in model_columns(joined)}
    return temporal_split(stage(joined.withColumns(doubles), "training", PACKED if many(targets) else None))


def _inputs(columns: list[str]) -> list:
    filled = [f"{c}__filled" for c in columns]
    return [
        # Medians are learned from the training rows and stored in the model.
        Imputer(strategy="median", inputCols=columns, outputCols=filled),
        VectorAssembler(inputCols=filled, outputCol="inputs"),
    ]


def feature_importance(model: Ensemble, rows: DataFrame, top: int | None = None) -> DataFrame:
    """Total gain per input column, highest first."""
    table = model.importance(rows.sparkSession).orderBy(F.desc("importance"), "feature")
    return table if top is None else table.limit(top)


# --- churn ------------------------------------------------------------------------------


@dataclass(frozen=True)
class ChurnModel:
    model: Ensemble
    columns: tuple[str, ...]
    threshold: float
    thresholds: DataFrame

    def save(self, path: str) -> None:
        """Trees, threshold with all threshold scores, and input columns."""
        self.model.save(self.thresholds.sparkSession, f"{path}/model")
        save_table(self.thresholds.withColumn("model_threshold", F.lit(float(self.threshold))), f"{path}/thresholds")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> ChurnModel:
        model, facts = Ensemble.load(spark, f"{path}/model"), load_table(spark, f"{path}/thresholds")
        return cls(model, model.columns, facts.first()["model_threshold"], facts.drop("model_threshold"))

    def score(self, features: DataFrame) -> DataFrame:
        """Features with ``churn_probability``."""
        return features.withColumn("churn_probability", self.model.predicted(features.sparkSession))

    def predict(self, features: DataFrame) -> DataFrame:
        """Probability, 0/1 decision at the threshold, and risk level per row."""
        p = F.col("churn_probability")
        return self.score(features).select(
            "customer_id",
            "churn_probability",
            (p >= self.threshold).cast("int").alias("churn_prediction"),
            risk_level(p).alias("risk_level"),
        )


def train_churn(
    rows: DataFrame,
    rules: TreeRules = TreeRules(),
    balance: bool = True,
    metric: str = "f_beta",
) -> ChurnModel:
    """Boosted trees on ``training_rows``, then the threshold from validation rows."""
    columns = model_columns(rows)
    weights = class_weights(rows.where(F.col("split") == "train"), balance=balance)
    weighted = rows.join(F.broadcast(weights), "churn_label")
    (model,) = grow(weighted, columns, [Objective("logistic")], F.col("churn_label"), F.col("weight"), rules)
    draft = ChurnModel(model, tuple(columns), 0.5, weights)
    validated = draft.score(rows.where(F.col("split") == "val")).select(
        "churn_label", "churn_probability"
    )
    scores = stage(threshold_scores(validated), "thresholds")
    chosen = best_threshold(scores, metric).first()["threshold"]
    return ChurnModel(model, tuple(columns), chosen, scores)


# --- lifetime value -----------------------------------------------------------------------


def to_log(value: Column) -> Column:
    """log(1 + value); negative revenue counts as 0."""
    return F.log1p(F.greatest(value, F.lit(0.0)))


def from_log(value: Column) -> Column:
    return F.greatest(F.expm1(value), F.lit(0.0))


# Lower bound, median and upper bound of the prediction band.
BAND = (0.1, 0.5, 0.9)
# Points that stand for the training targets of a leaf, each for the same share of them.
LEAF_POINTS = 20


def churn_adjusted(predicted: DataFrame, churn: DataFrame) -> DataFrame:
    """Predictions times the chance to stay; null without a churn probability."""
    stay = 1 - F.col("churn_probability")
    return predicted.join(
        churn.select("customer_id", "churn_probability"), "customer_id", "left"
    ).withColumn("clv_risk_adjusted", F.col("clv_prediction") * stay)


@dataclass(frozen=True)
class Forest:
    """Quantile regression forest: its trees, and the points of all their leaves."""

    model: PipelineModel
    leaves: DataFrame

    def band(self, rows: DataFrame, columns: tuple[str, ...]) -> DataFrame:
        """``rows`` with ``__band``, the quantiles BAND."""
        # The quantiles of all leaves are one small nested array, indexed by
        # tree and leaf: scoring stays a map over rows.
        q = F.transform(
            vector_to_array("leaf").cast("array<int>"),
            lambda leaf, i: F.get(F.get(F.col("__leaves"), i), leaf),
        )
        ready = rows.withColumns({c: F.col(c).cast("double") for c in columns})
        leafed = self.model.transform(ready).withColumn("__leaves", self.leaves.scalar())
        pooled = leafed.withColumn("pool", F.sort_array(F.flatten(q)))

        def at(p: float) -> Column:
            place = F.greatest(F.ceil(F.lit(p) * F.size("pool")), F.lit(1))
            return F.element_at("pool", place.cast("int"))

        return pooled.withColumn("__band", F.array(*[at(p) for p in BAND]))


@dataclass(frozen=True)
class ValueModel:
    model: Ensemble
    columns: tuple[str, ...]
    log_transform: bool
    bands: tuple[Ensemble, ...] = ()
    forest: Forest | None = None

    def save(self, path: str) -> None:
        """Point model, boosters or forest of the band, and settings."""
        spark = SparkSession.getActiveSession()
        facts = [(self.log_transform, len(self.bands), self.forest is not None)]
        save_table(spark.createDataFrame(facts, "log_transform boolean, bands int, forest boolean"), f"{path}/settings")
        self.model.save(spark, f"{path}/model")
        for k, band in enumerate(self.bands):
            band.save(spark, f"{path}/bands/{k}")
        if self.forest is not None:
            save_model(self.forest.model, self.forest.leaves, f"{path}/forest")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> ValueModel:
        known = load_table(spark, f"{path}/settings").first()
        model = Ensemble.load(spark, f"{path}/model")
        bands = tuple(Ensemble.load(spark, f"{path}/bands/{k}") for k in range(known["bands"]))
        forest = Forest(*load_model(spark, f"{path}/forest")) if known["forest"] else None
        return cls(model, model.columns, known["log_transform"], bands, forest)

    def _back(self, col: Column) -> Column:
        return from_log(col) if self.log_transform else F.greatest(col, F.lit(0.0))

    def predict(self, features: DataFrame, bounds: bool = False, keep: tuple[str, ...] = ()):
        """``clv_prediction``, and the 10 to 90 percent band when asked for."""
        spark = features.sparkSession
        out = features.withColumn("clv_prediction", self._back(self.model.predicted(spark)))
        if not bounds:
            return out.select("customer_id", *keep, "clv_prediction")
        if self.forest is not None:
            out = self.forest.band(out, self.columns)
        elif self.bands:
            # Boosters are trained one by one and may cross: their values are put in order.
            out = out.withColumn("__band", F.sort_array(F.array(*[b.predicted(spark) for b in self.bands])))
        else:
            raise ValueError("train the bounds first")
        lower, median, upper = (self._back(F.col("__band")[k]) for k in range(len(BAND)))
        return out.select(
            "customer_id",
            *keep,
            "clv_prediction",
            lower.alias("clv_lower_10pct"),
            median.alias("clv_median"),
            upper.alias("clv_upper_90pct"),
            (upper - lower).alias("clv_uncertainty"),
        )

    def predict_risk_adjusted(self, features: DataFrame, churn: DataFrame) -> DataFrame:
        """Band and prediction times the chance to stay."""
        bounds = bool(self.bands) or self.forest is not None
        return churn_adjusted(self.predict(features, bounds=bounds), churn)


def _value_target(log_transform: bool) -> Column:
    return to_log(F.col("clv_target")) if log_transform else F.col("clv_target")


def train_value(
    rows: DataFrame,
    rules: TreeRules = TreeRules(),
    log_transform: bool = True,
    objective: float | None = None,
    bounds: bool = False,
) -> ValueModel:
    """Point model on (log) future revenue: its mean, or the quantile ``objective``.

    With ``bounds`` the boosters of the band grow in the same passes.
    """
    columns = model_columns(rows)
    point = Objective("squared") if objective is None else Objective("quantile", objective)
    band = [Objective("quantile", q) for q in BAND] if bounds else []
    model, *bands = grow(rows, columns, [point, *band], _value_target(log_transform), rules=rules)
    return ValueModel(model, tuple(columns), log_transform, tuple(bands))


def train_bounds(value: ValueModel, rows: DataFrame, rules: TreeRules = TreeRules()) -> ValueModel:
    """``value`` with boosters of pinball loss for the band and the median."""
    band = [Objective("quantile", q) for q in BAND]
    bands = grow(rows, value.columns, band, _value_target(value.log_transform), rules=rules)
    return replace(value, bands=tuple(bands), forest=None)


def train_forest_bounds(
    value: ValueModel, rows: DataFrame, rules: TreeRules = TreeRules()
) -> ValueModel:
    """The band from a quantile regression forest (Meinshausen, 2006) for the band and the median.

    A row's band comes from the training targets of all leaves it falls in,
    pooled, with a weight of one over the size of the leaf.  Every leaf keeps
    LEAF_POINTS equally weighted quantiles of its targets from a mergeable
    sketch, so a leaf with most of the rows costs no more than any other, and the
    pool is the points of one leaf per tree.
    """
    y = _value_target(value.log_transform)
    train = rows.where(F.col("split") == "train").withColumn("y", y)
    forest = Pipeline(
        stages=[
            *_inputs(list(value.columns)),
            RandomForestRegressor(
                labelCol="y",
                featuresCol="inputs",
                leafCol="leaf",
                numTrees=rules.forest_trees,
                maxDepth=rules.depth,
                minInstancesPerNode=rules.min_rows,
                subsamplingRate=rules.row_share,
                predictionCol="forest_prediction",
                seed=rules.seed,
            ),
        ]
    ).fit(train)
    per_leaf = (
        forest.transform(train)
        .select("y", F.posexplode(vector_to_array("leaf").cast("array<int>")).alias("tree", "leaf"))
        .groupBy("tree", "leaf")
        .agg(
            F.percentile_approx(
                "y", [(i + 0.5) / LEAF_POINTS for i in range(LEAF_POINTS)], 10_000
            ).alias("q")
        )
    )
    # trees x leaves rows: bounded by the model, not by the data.
    spots = F.transform(
        F.sequence(F.lit(0), F.array_max(F.map_keys("m"))), lambda i: F.element_at("m", i)
    )
    per_tree = (
        per_leaf.groupBy("tree")
        .agg(F.map_from_entries(F.collect_list(F.struct("leaf", "q"))).alias("m"))
        .select("tree", spots.alias("q"))
    )
    leaves = per_tree.agg(
        F.transform(F.sort_array(F.collect_list(F.struct("tree", "q"))), lambda s: s["q"]).alias(
            "q"
        )
    )
    return replace(value, bands=(), forest=Forest(forest, stage(leaves, "leaves")))


def coverage(scored: DataFrame, actual: str = "clv_target") -> DataFrame:
    """Share of actual values inside the band."""
    inside = F.greatest(F.col(actual), F.lit(0.0)).between(
        F.col("clv_lower_10pct"), F.col("clv_upper_90pct")
    )
    return scored.agg(
        F.count(F.lit(1)).alias("customers"),
        F.avg(inside.cast("double")).alias("coverage"),
        F.avg("clv_uncertainty").alias("mean_uncertainty"),
    )
