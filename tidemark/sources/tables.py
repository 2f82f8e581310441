"""Reading and writing the tables that stages exchange."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.columns import any_of


def load_table(spark: SparkSession, path: str, kind: str = "parquet") -> DataFrame:
    if kind == "parquet":
        return spark.read.parquet(path)
    if kind == "csv":
        return spark.read.option("header", True).option("escape", '"').csv(path)
    if kind == "json":  # one record per line, as written by save_table
        return spark.read.json(path)
    if kind == "json_document":  # one document per file
        return spark.read.option("multiLine", True).json(path)
    raise ValueError(f"unknown table format: {kind}")


def save_table(df: DataFrame, path: str, kind: str = "parquet", compression: str = "snappy") -> None:
    """Overwrite ``path``; the number of files follows the partitions of ``df``."""
    writer = df.write.mode("overwrite")
    if kind == "parquet":
        writer.option("compression", compression).parquet(path)
    elif kind == "csv":
        writer.option("header", True).option("escape", '"').csv(path)
    elif kind == "json":
        writer.option("ignoreNullFields", False).json(path)
    else:
        raise ValueError(f"unknown table format: {kind}")


def save_features(features: DataFrame, path: str) -> None:
    """Feature store: one folder per snapshot; a re-run replaces only its own snapshots.

    Rows are dealt by ranges of snapshot and customer: a large snapshot becomes as
    many files as its share of the rows, small ones share a task.
    """
    (
        features.repartitionByRange("snapshot_date", "customer_id")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .partitionBy("snapshot_date")
        .parquet(path)
    )


def load_features(spark: SparkSession, path: str) -> DataFrame:
    """Feature store scan; filters on ``snapshot_date`` select folders."""
    return spark.read.parquet(path)


# --- versions of the feature store ------------------------------------------------------

MANIFEST = (
    "version int, folder string, created_at timestamp, n_rows long, n_customers long, n_snapshots long, "
    "statistics array<struct<feature: string, count: long, nulls: long, mean: double, std: double, "
    "min: double, max: double>>"
)


class InvalidFeatures(ValueError):
    """Features that failed a check and were not published."""


def feature_checks(features: DataFrame) -> DataFrame:
    """(check, bad): rows that break a rule of the store; empty tables break one, too."""
    numbers = [f.name for f in features.schema.fields if f.dataType.simpleString() in ("double", "float")]
    endless = any_of([F.isnan(c) | F.col(c).isin(float("inf"), float("-inf")) for c in numbers] or [F.lit(False)])
    keys = ["customer_id", "snapshot_date"]
    one = features.agg(
        F.when(F.count(F.lit(1)) == 0, 1).otherwise(0).cast("long").alias("rows present"),
        *[F.count_if(F.col(k).isNull()).alias(f"{k} present") for k in keys],
        F.count_if(F.coalesce(endless, F.lit(False))).alias("numbers finite"),
    )
    twice = features.groupBy(*keys).agg((F.count(F.lit(1)) - 1).alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
    one = one.withColumn("one row per customer and snapshot", twice.scalar())
    cells = [F.struct(F.lit(c).alias("check"), F.col(f"`{c}`").alias("bad")) for c in one.columns]
    return one.select(F.inline(F.array(*cells)))


def feature_statistics(features: DataFrame) -> DataFrame:
    """One row for each numeric feature, from one scan."""
    kinds = ("double", "float", "int", "bigint", "smallint", "tinyint", "boolean")
    names = [f.name for f in features.schema.fields if f.dataType.simpleString() in kinds and f.name != "customer_id"]
    parts = []
    for i, c in enumerate(names):
        v = F.col(c).cast("double")
        known = {"count": F.count(v), "nulls": F.count_if(v.isNull()), "mean": F.avg(v), "std": F.stddev(v)}
        known |= {"min": F.min(v), "max": F.max(v)}
        parts.append(F.struct(F.lit(c).alias("feature"), *[e.alias(n) for n, e in known.items()]).alias(f"s{i}"))
    return features.agg(*parts).select(F.inline(F.array(*[f"s{i}" for i in range(len(names))])))


def feature_versions(spark: SparkSession, path: str) -> DataFrame:
    """The published versions, as written in their manifests."""
    try:
        return spark.read.schema(MANIFEST).json(f"{path}/manifests/*")
    except AnalysisException:  # no manifest yet
        return spark.createDataFrame([], MANIFEST)


def save_feature_version(features: DataFrame, path: str) -> int:
    """Write a new version aside, check what was written, then publish it; returns its number.

    Readers follow manifests, so they never see a version that is half written or failed a
    check; the versions before stay as they are.  Two writers that publish the same number can't
    both succeed.
    """
    spark = features.sparkSession
    newest = feature_versions(spark, path).agg(F.max("version")).first()[0]
    number = (newest or 0) + 1
    folder = f"versions/{number}-{uuid.uuid4().hex}"
    save_features(features, f"{path}/{folder}")
    written = spark.read.schema(features.schema).parquet(f"{path}/{folder}")
    broken = [f"{r['check']}: {r['bad']}" for r in feature_checks(written).collect() if r["bad"]]
    if broken:
        raise InvalidFeatures("; ".join(broken))
    statistics = feature_statistics(written).agg(F.collect_list(F.struct("*")).alias("s"))  # a row for each feature
    customers = written.select("customer_id").distinct().agg(F.count(F.lit(1)).alias("n"))
    manifest = written.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("snapshot_date").alias("n_snapshots")).select(
        F.lit(number).alias("version"),
        F.lit(folder).alias("folder"),
        F.current_timestamp().alias("created_at"),
        "n_rows",
        customers.scalar().alias("n_customers"),
        "n_snapshots",
        statistics.scalar().alias("statistics"),
    )
    manifest.coalesce(1).write.mode("errorifexists").json(f"{path}/manifests/{number}")
    return number


def load_feature_version(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The newest published version, or a given one."""
    known = feature_versions(spark, path)
    known = known.where(F.col("version") == version) if version else known
    chosen = known.orderBy(F.desc("version")).first()
    if chosen is None:
        raise ValueError(f"no such version in {path}")
    return load_features(spark, f"{path}/{chosen['folder']}")


def feature_metadata(features: DataFrame) -> DataFrame:
    """One row: customers, snapshots, feature columns, and when it was made."""
    names = [c for c in features.columns if c != "customer_id"]
    # First distinct ids, then count: no task holds the set of all customers.
    customers = features.select("customer_id").distinct().agg(F.count(F.lit(1)).alias("n"))
    # One entry per snapshot.
    snapshots = features.agg(F.sort_array(F.collect_set("snapshot_date")).alias("at"))
    return snapshots.select(
        customers.scalar().alias("n_customers"),
        F.size("at").cast("long").alias("n_snapshots"),
        F.lit(len(names)).alias("n_features"),
        F.array(*[F.lit(n) for n in names]).alias("feature_names"),
        F.transform("at", lambda t: F.date_format(t, "yyyy-MM-dd")).alias("snapshot_dates"),
        F.current_timestamp().alias("created_at"),
    )


def save_campaign_lists(assignments: DataFrame, path: str) -> None:
    """CSV lists per campaign, best customers first, without the untargeted.

    Files of a campaign are ordered ranges of expected value, so a campaign
    that holds most customers is still written by many tasks.
    """
    chosen = assignments.where(F.col("campaign_name") != "No Action").select(
        F.lower(F.regexp_replace("campaign_name", " ", "_")).alias("campaign"),
        F.col("customer_id").alias("CustomerID"),
        F.col("churn_prob").alias("Churn Probability"),
        F.col("clv").alias("CLV"),
        F.col("expected_value").alias("Expected Value"),
    )
    order = [F.col("campaign"), F.desc("Expected Value"), F.col("CustomerID")]
    (
        chosen.repartitionByRange(*order)  # ranges by value split a large campaign
        .sortWithinPartitions(*order)
        .write.mode("overwrite")
        .option("header", True)
        .partitionBy("campaign")
        .csv(path)
    )


def save_model(model: PipelineModel, facts: DataFrame, path: str) -> None:
    """A fitted pipeline and its side facts (threshold, importance, profiles)."""
    model.write().overwrite().save(f"{path}/model")
    save_table(facts, f"{path}/facts")


def load_model(spark: SparkSession, path: str) -> tuple[PipelineModel, DataFrame]:
    return PipelineModel.load(f"{path}/model"), load_table(spark, f"{path}/facts")
