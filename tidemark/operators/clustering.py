"""K-Means segmentation on standardised customer features."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.quantiles import exact_quantiles
from tidemark.functions.staging import stage
from tidemark.operators import kmeans
from tidemark.operators.segments import name_assignments, segment_profiles
from tidemark.sources.tables import load_table, save_table

# The features that describe a customer for clustering, in order.
CLUSTER_FEATURES = (
    "rfm_recency_days",
    "rfm_frequency_count",
    "rfm_monetary_avg",
    "rfm_monetary_total",
    "engagement_score",
    "purchase_frequency_per_month",
    "days_since_first_purchase",
)


@dataclass(frozen=True)
class ClusterRules:
    k_min: int = 3
    k_max: int = 8
    restarts: int = 10
    max_iter: int = 300
    seed: int = 42
    most_segments: int = 6


def cluster_columns(features: DataFrame) -> list[str]:
    present = [c for c in CLUSTER_FEATURES if c in features.columns]
    if not present:
        raise ValueError("no clustering features in the table")
    return present


def as_doubles(features: DataFrame, columns: Sequence[str]) -> DataFrame:
    return features.withColumns({c: F.col(c).cast("double") for c in columns})


def choose_k(inertias: dict[int, float], silhouettes: dict[int, float], most: int = 6) -> int:
    """Best silhouette; above ``most`` clusters the elbow, at most ``most``."""
    best = max(sorted(silhouettes), key=lambda k: silhouettes[k])
    if best <= most:
        return best
    ks = sorted(inertias)
    bend = {
        ks[i]: inertias[ks[i - 1]] - 2 * inertias[ks[i]] + inertias[ks[i + 1]]
        for i in range(1, len(ks) - 1)
    }
    elbow = max(sorted(bend), key=lambda k: bend[k]) if bend else most
    return min(elbow, most)


@dataclass(frozen=True)
class Segmentation:
    """Fill values, scaling and centres learned on one snapshot."""

    medians: tuple[float, ...]
    scales: tuple[tuple[float, float], ...]
    centres: tuple[tuple[float, ...], ...]
    k: int
    inertia: float
    silhouette: float
    columns: tuple[str, ...]
    search: DataFrame | None

    def prepared(self, features: DataFrame) -> DataFrame:
        """``features`` with filled and standardised inputs, and ``segment``."""
        scaled = standardised(median_filled(features, self.columns, self.medians), self.columns, self.scales)
        return scaled.withColumn("segment", nearest_centre(self.columns, self.centres))

    def assign(self, features: DataFrame) -> DataFrame:
        """Nearest centre for every row, of any snapshot; the inputs stay as they are."""
        kept = [c for c in features.columns if c != "segment"]
        inputs = {f"__{c}": F.col(c) for c in self.columns}
        names = [f"__{c}" for c in self.columns]
        scaled = standardised(median_filled(features.withColumns(inputs), names, self.medians), names, self.scales)
        return scaled.select(*kept, nearest_centre(names, self.centres).alias("segment"))

    def save(self, spark: SparkSession, path: str) -> None:
        rows = [
            (c, m, *map(float, s), [float(x[i]) for x in self.centres], self.k, self.inertia, self.silhouette, i)
            for i, (c, m, s) in enumerate(zip(self.columns, self.medians, self.scales))
        ]
        schema = (
            "column string, median double, mean double, deviation double, centres array<double>, "
            "k int, inertia double, silhouette double, place int"
        )
        save_table(spark.createDataFrame(rows, schema), path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Segmentation:
        rows = load_table(spark, path).orderBy("place").collect()  # a row for each input column
        return cls(
            tuple(r["median"] for r in rows),
            tuple((r["mean"], r["deviation"]) for r in rows),
            tuple(zip(*[r["centres"] for r in rows])),
            rows[0]["k"],
            rows[0]["inertia"],
            rows[0]["silhouette"],
            tuple(r["column"] for r in rows),
            None,
        )


def fit_segments(
    latest: DataFrame, k: int | None = None, rules: ClusterRules = ClusterRules()
) -> Segmentation:
    """Fit on the rows of one snapshot; K is searched when not given.

    All restarts of all K are fitted in the same passes over the rows, and the best
    model of each K is judged by its silhouette.
    """
    columns = cluster_columns(latest)
    typed = stage(as_doubles(latest, columns).select("customer_id", *columns), "clustering")
    medians = tuple(0.0 if m is None else m for m in fill_values(typed, columns))  # 0 for a column of nulls
    filled = median_filled(typed, columns, medians)
    scales = scale_values(filled, columns)
    data = kmeans.Vectors(standardised(filled, columns, scales), "customer_id", columns)
    try:
        ks = range(rules.k_min, rules.k_max + 1) if k is None else [k]
        jobs = [(i, rules.seed + r) for i in ks for r in range(rules.restarts)]
        best: dict[int, kmeans.Model] = {}
        for m in kmeans.fit(data, jobs, rules.max_iter):
            if m.k not in best or m.inertia < best[m.k].inertia:
                best[m.k] = m
        scores = dict(zip(best, kmeans.silhouettes(data, list(best.values()))))
    finally:
        data.close()
    inertias = {i: m.inertia for i, m in best.items()}
    search = None
    if k is None:
        k = choose_k(inertias, {i: s for i, (s, _) in scores.items()}, rules.most_segments)
        search = latest.sparkSession.createDataFrame(
            [(i, inertias[i], *scores[i], i == k) for i in sorted(inertias)],
            "k int, inertia double, silhouette double, silhouette_error double, chosen boolean",
        )
    centres = tuple(tuple(map(float, c)) for c in best[k].centres)
    return Segmentation(medians, scales, centres, k, inertias[k], scores[k][0], tuple(columns), search)


def worst_ratio(spread: dict[int, float], centres: dict) -> float | None:
    """Mean over clusters of the worst (spread_i + spread_j) / distance_ij; None for one cluster."""
    worst = []
    for i in spread:
        ratios = []
        for j in spread:
            gap = math.dist(centres[i], centres[j])
            if i != j and gap > 0:
                ratios.append((spread[i] + spread[j]) / gap)
        if ratios:
            worst.append(max(ratios))
    return sum(worst) / len(worst) if worst else None


# --- steps that any grouping can use --------------------------------------------------------


def fill_values(df: DataFrame, columns: Sequence[str]) -> tuple[float | None, ...]:
    """Exact median of each column; None for a column of nulls."""
    return tuple(exact_quantiles(df, F.col(c).cast("double"), [0.5])[0] for c in columns)


def median_filled(
    df: DataFrame, columns: Sequence[str], values: Sequence[float | None] | None = None
) -> DataFrame:
    """``df`` with nulls of ``columns`` replaced by ``values``, or by the exact median of the column."""
    values = fill_values(df, columns) if values is None else values
    filled = {c: F.coalesce(F.col(c).cast("double"), F.lit(v).cast("double")) for c, v in zip(columns, values)}
    return df.withColumns(filled)


def scale_values(df: DataFrame, columns: Sequence[str]) -> tuple[tuple[float, float], ...]:
    """Mean and population deviation of each column; zeros for a column of nulls."""
    parts = [f(c).alias(f"{n}_{i}") for i, c in enumerate(columns) for n, f in (("m", F.avg), ("s", F.stddev_pop))]
    facts = df.agg(*parts).first()
    return tuple((facts[f"m_{i}"] or 0.0, facts[f"s_{i}"] or 0.0) for i in range(len(columns)))


def standardised(
    df: DataFrame, columns: Sequence[str], values: Sequence[tuple[float, float]] | None = None
) -> DataFrame:
    """``df`` with ``columns`` as (x - mean) / population deviation; a constant column is 0."""
    values = scale_values(df, columns) if values is None else values
    scaled = {}
    for c, (mean, deviation) in zip(columns, values):
        scaled[c] = (F.col(c) - F.lit(mean)) / F.lit(deviation) if deviation else F.col(c) * 0.0
    return df.withColumns(scaled)


def nearest_centre(columns: Sequence[str], centres: Sequence[Sequence[float]]) -> Column:
    """Number of the nearest of few fixed centres; the first of equally near ones."""
    away = [
        F.struct(sum(((F.col(c) - F.lit(float(v))) ** 2 for c, v in zip(columns, x)), F.lit(0.0)).alias("d"), F.lit(i).alias("i"))
        for i, x in enumerate(centres)
    ]
    return F.array_min(F.array(*away))["i"]


def group_centres(df: DataFrame, columns: Sequence[str], by: str) -> DataFrame:
    return df.groupBy(by).agg(*[F.avg(c).alias(c) for c in columns])


def group_separation(df: DataFrame, columns: Sequence[str], by: str) -> DataFrame:
    """Davies-Bouldin index of any grouping of few groups: one row."""
    centres = group_centres(df, columns, by)
    named = centres.select(F.col(by).alias("__by"), *[F.col(c).alias(f"__{c}") for c in columns])
    gap = sum(((F.col(c) - F.col(f"__{c}")) ** 2 for c in columns), F.lit(0.0))
    spread = df.join(named, F.col(by) == F.col("__by")).groupBy(by).agg(F.avg(F.sqrt(gap)).alias("spread"))
    at = {r[by]: [r[c] for c in columns] for r in centres.collect()}  # a row for each group
    value = worst_ratio({r[by]: r["spread"] for r in spread.collect()}, at)
    return df.sparkSession.createDataFrame([(len(at), value)], "groups int, davies_bouldin double")


def group_importance(df: DataFrame, columns: Sequence[str], by: str) -> DataFrame:
    """Share of each column in the variance of the group centres."""
    centres = group_centres(df, columns, by)
    long = centres.select(F.explode(F.create_map(*[x for c in columns for x in (F.lit(c), F.col(c))])).alias("feature", "x"))
    per = long.groupBy("feature").agg(F.var_pop("x").alias("v"))
    total = per.agg(F.sum("v").alias("t"))
    return per.select("feature", (F.col("v") / total.scalar()).alias("importance"))


def davies_bouldin(seg: Segmentation, latest: DataFrame) -> DataFrame:
    """Measures of a segmentation over the rows it was fitted on: one row."""
    measured = group_separation(seg.prepared(latest), seg.columns, "segment")
    return measured.select(
        F.lit(seg.k).alias("k"),
        F.lit(float(seg.inertia)).alias("inertia"),
        F.lit(float(seg.silhouette)).alias("silhouette"),
        "davies_bouldin",
    )


def segment_importance(seg: Segmentation, latest: DataFrame) -> DataFrame:
    """Share of each feature in the variance of the segments' centres, highest first."""
    shares = group_importance(seg.prepared(latest), seg.columns, "segment")
    return shares.orderBy(F.desc("importance"), "feature")


def assign_segments(
    seg: Segmentation, features: DataFrame, latest: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """(assignments of all snapshots with names, profiles of the latest one)."""
    profiles = segment_profiles(seg.assign(latest))
    return name_assignments(seg.assign(features), profiles), profiles
