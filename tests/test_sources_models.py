import pytest
from pyspark.sql import functions as F

from tidemark.operators import boosting, clustering, prediction
from tidemark.plans import stages
from tidemark.sources import tables, transactions

HEADER = "InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country\n"


@pytest.mark.parametrize("encoding", ["utf-8", "iso-8859-1"])
def test_csv_encodings(spark, tmp_path, encoding):
    text = HEADER + '1,A,"CAFÉ, ""big""",6,12/1/2010 8:26,2.55,17850,France\n'
    path = tmp_path / "raw.csv"
    path.write_bytes(text.encode(encoding))
    row = transactions.read_transactions_csv(spark, str(path)).first()
    assert row["Description"] == 'CAFÉ, "big"' and row["CustomerID"] == "17850"


def test_folder_of_both_encodings(spark, tmp_path):
    for name, encoding in (("a", "utf-8"), ("b", "iso-8859-1"), ("c", "utf-8-sig")):
        text = HEADER + f"{name},A,café \ufffd,6,12/1/2010 8:26,2.55,17850,France\n"
        raw = text.replace(" \ufffd", "") if name == "b" else text
        (tmp_path / f"{name}.csv").write_bytes(raw.encode(encoding))
    read = lambda name: transactions.read_transactions_csv(spark, str(tmp_path / name))
    got = {n: read(f"{n}.csv").first()["Description"] for n in "abc"}
    assert got == {"a": "café \ufffd", "b": "café", "c": "café \ufffd"}
    assert read("c.csv").columns[0] == "InvoiceNo"
    both = read("[ab].csv").collect()
    assert {r["Description"] for r in both} == {"café \ufffd", "café"}


def test_boosting_stops_after_patience():
    losses = [1.0 / (i + 1) for i in range(30)] + [0.5] * 80
    assert boosting.best_round(losses, 50) == (30, True)
    assert boosting.best_round(losses[:60], 50) == (30, False)
    assert boosting.best_round([2.0, 1.0], 50) == (2, False)
    slow = [1.0 - 1e-6 * i for i in range(200)]
    assert boosting.best_round(slow, 50) == (200, False)
    assert boosting.best_round(slow, 50, 1e-4) == (51, True)


def test_boosting_keeps_as_many_rounds_as_help(spark):
    noise = F.rand(5)
    rows = spark.range(3000).select(
        F.col("id").alias("customer_id"),
        F.lit("x").alias("snapshot_date"),
        (F.rand(1) * 100).alias("a"),
        (F.rand(2) * 100).alias("b"),
        F.when(F.col("id") % 3 == 0, "val").otherwise("train").alias("split"),
    ).withColumn("clv_target", F.col("a") * F.col("b") / 10 + noise)
    rules = prediction.TreeRules(rounds=60, patience=5, step=0.1, depth=3)
    model = prediction.train_value(rows, rules)
    assert len(model.model.trees) > 20


@pytest.mark.parametrize("kind", ["parquet", "csv", "json"])
def test_tables_round_trip(spark, tmp_path, kind):
    df = spark.createDataFrame([(1, "a,b"), (2, None)], "k int, v string")
    path = str(tmp_path / kind)
    tables.save_table(df, path, kind)
    tables.save_table(df, path, kind)  # overwrites
    got = {int(r["k"]): r["v"] for r in tables.load_table(spark, path, kind).collect()}
    assert got == {1: "a,b", 2: None}


def test_feature_store_replaces_only_its_snapshots(spark, tmp_path):
    def snap(day, value, n=3):
        return spark.range(n).select(
            F.col("id").alias("customer_id"),
            F.lit(value).alias("x"),
            F.to_timestamp(F.lit(f"{day} 08:26:00")).alias("snapshot_date"),
        )

    path = str(tmp_path / "store")
    tables.save_features(snap("2020-01-31", 1.0).unionByName(snap("2020-02-29", 1.0)), path)
    tables.save_features(snap("2020-02-29", 2.0, 5), path)
    store = tables.load_features(spark, path)
    got = {(r["snapshot_date"].day, r["x"]): r["n"] for r in
           store.groupBy("snapshot_date", "x").agg(F.count("*").alias("n")).collect()}
    assert got == {(31, 1.0): 3, (29, 2.0): 5}
    meta = tables.feature_metadata(store).first()
    assert (meta["n_customers"], meta["n_snapshots"]) == (5, 2)
    assert meta["snapshot_dates"] == ["2020-01-31", "2020-02-29"]


def test_versions_are_checked_before_they_are_published(spark, tmp_path):
    def snap(value, n=3):
        return spark.range(n).select(
            F.col("id").alias("customer_id"), F.lit(value).alias("x"),
            F.to_timestamp(F.lit("2020-01-31 08:26:00")).alias("snapshot_date"),
        )

    path = str(tmp_path / "store")
    with pytest.raises(ValueError, match="no such version"):
        tables.load_feature_version(spark, path)
    assert tables.save_feature_version(snap(1.0), path) == 1
    for bad, said in (
        (snap(float("nan")), "finite: 3"),
        (snap(2.0).unionByName(snap(2.0, 1)), "snapshot: 1"),
        (snap(2.0).withColumn("customer_id", F.lit(None).cast("long")), "customer_id present: 3"),
        (snap(2.0, 0), "rows present"),
    ):
        with pytest.raises(tables.InvalidFeatures, match=said):
            tables.save_feature_version(bad, path)
    assert tables.load_feature_version(spark, path).agg(F.sum("x")).first()[0] == 3.0
    assert tables.save_feature_version(snap(2.0, 5), path) == 2
    assert [tables.load_feature_version(spark, path, v).agg(F.sum("x")).first()[0] for v in (None, 1, 2)] == [10.0, 3.0, 10.0]
    newest = tables.feature_versions(spark, path).orderBy(F.desc("version")).first()
    assert (newest["version"], newest["n_rows"], newest["n_customers"], newest["n_snapshots"]) == (2, 5, 5, 1)
    assert [(s["feature"], s["count"], s["mean"], s["max"]) for s in newest["statistics"]] == [("x", 5, 2.0, 2.0)]


def test_a_latin_file_may_hold_bytes_that_are_valid_utf8(spark, tmp_path):
    rows = "1,A,caf\xe9,6,12/1/2010 8:26,2.55,17850,France\n2,B,\xc3\xa9,6,12/1/2010 8:26,2.55,17850,France\n"
    (tmp_path / "latin.csv").write_bytes((HEADER + rows).encode("iso-8859-1"))
    (tmp_path / "utf.csv").write_bytes((HEADER + "3,C,\xe9,6,12/1/2010 8:26,2.55,17850,France\n").encode())
    got = {r["InvoiceNo"]: r["Description"] for r in transactions.read_transactions_csv(spark, str(tmp_path)).collect()}
    assert got == {"1": "caf\xe9", "2": "\xc3\xa9", "3": "\xe9"}


def test_campaign_lists(spark, tmp_path):
    rows = [(i, "Basic Email" if i % 2 else "No Action", 0.5, 10.0, float(i)) for i in range(20)]
    df = spark.createDataFrame(
        rows, "customer_id long, campaign_name string, churn_prob double, clv double, expected_value double"
    )
    path = str(tmp_path / "lists")
    tables.save_campaign_lists(df, path)
    got = tables.load_table(spark, path, "csv").collect()
    assert {r["campaign"] for r in got} == {"basic_email"} and len(got) == 10
    assert set(got[0].asDict()) == {"CustomerID", "Churn Probability", "CLV", "Expected Value", "campaign"}


@pytest.fixture(scope="module")
def labelled(spark):
    """Customers whose recency decides churn and whose frequency decides revenue."""
    base = spark.range(900).select(
        (F.col("id") % 300).alias("customer_id"),
        (F.to_timestamp(F.lit("2020-01-31 00:00:00"))
         + F.make_dt_interval((F.floor(F.col("id") / 300) * 30).cast("int"))).alias("snapshot_date"),
        (F.pmod(F.xxhash64("id"), F.lit(180))).cast("int").alias("rfm_recency_days"),
        (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(20)) + 1).alias("rfm_frequency_count"),
    )
    features = base.withColumn("rfm_monetary_avg", F.col("rfm_frequency_count") * 2.0)
    churn = base.select(
        "customer_id", "snapshot_date", (F.col("rfm_recency_days") > 90).cast("int").alias("churn_label")
    )
    value = base.select(
        "customer_id", "snapshot_date", (F.col("rfm_frequency_count") * 100.0).alias("clv_target")
    )
    return features, churn, value


RULES = prediction.TreeRules(rounds=8, step=0.3, depth=3, forest_trees=8)


def test_churn_model_learns_and_reloads(spark, labelled, tmp_path):
    features, churn, _ = labelled
    rows = prediction.training_rows(features, churn, "churn_label")
    assert rows.count() == 900  # joined on customer and snapshot, not on customer alone
    model = prediction.train_churn(rows, RULES)
    from tidemark.operators.evaluation import evaluate_binary

    test = model.score(rows.where("split = 'test'"))
    assert evaluate_binary(test, model.threshold).first()["roc_auc"] > 0.95
    top = prediction.feature_importance(model.model, rows, 1).first()
    assert top["feature"] == "rfm_recency_days"
    model.save(str(tmp_path / "m"))
    again = prediction.ChurnModel.load(spark, str(tmp_path / "m"))
    assert (again.threshold, again.columns) == (model.threshold, model.columns)
    assert again.thresholds.count() == model.thresholds.count()
    one = rows.limit(5)
    assert sorted(map(tuple, again.predict(one).collect())) == sorted(map(tuple, model.predict(one).collect()))


@pytest.mark.parametrize("bounds", [prediction.train_bounds, prediction.train_forest_bounds])
def test_value_model_and_band(spark, labelled, tmp_path, bounds):
    features, _, value = labelled
    rows = prediction.training_rows(features, value, "clv_target")
    model = bounds(prediction.train_value(rows, RULES), rows, RULES)
    scored = model.predict(rows.where("split = 'test'"), bounds=True, keep=("clv_target",))
    for r in scored.limit(50).collect():
        assert 0 <= r["clv_lower_10pct"] <= r["clv_median"] <= r["clv_upper_90pct"]
        assert r["clv_prediction"] == pytest.approx(r["clv_target"], rel=0.6)
    assert prediction.coverage(scored).first()["coverage"] > 0.6
    model.save(str(tmp_path / "v"))
    again = prediction.ValueModel.load(spark, str(tmp_path / "v"))
    test = rows.where("split = 'test'")
    ordered = lambda m: sorted(map(tuple, m.predict(test, bounds=True).collect()))
    assert ordered(again) == ordered(model)


def test_band_covers_known_noise(spark):
    """Four fifths of targets lie between the outer quantiles of their known distribution."""
    rows = spark.range(6000).select(
        F.col("id").alias("customer_id"),
        F.lit("x").alias("snapshot_date"),
        (F.floor(F.rand(1) * 4)).alias("a"),
        F.when(F.col("id") % 4 == 0, "test").otherwise("train").alias("split"),
        F.rand(3).alias("u"),
    ).withColumn("clv_target", F.col("a") * 100 + 50 + F.col("u") * 40).drop("u")
    rules = prediction.TreeRules(rounds=5, patience=2, depth=3, forest_trees=10)
    model = prediction.train_forest_bounds(prediction.train_value(rows, rules), rows, rules)
    scored = model.predict(rows.where("split = 'test'"), bounds=True, keep=("clv_target",))
    assert 0.75 < prediction.coverage(scored).first()["coverage"] < 0.85


def test_customers_without_a_churn_score_stay(spark):
    clv = spark.createDataFrame([(1, 10.0), (2, 20.0)], "customer_id long, clv_prediction double")
    churn = spark.createDataFrame([(1, 0.25)], "customer_id long, churn_probability double")
    got = {r["customer_id"]: r["clv_risk_adjusted"] for r in prediction.churn_adjusted(clv, churn).collect()}
    assert got == {1: 7.5, 2: None}


def test_segments_of_separate_groups(spark):
    df = spark.range(90).select(
        F.col("id").alias("customer_id"),
        (F.col("id") % 3 * 60 + F.col("id") % 7).cast("int").alias("rfm_recency_days"),
        (F.col("id") % 3 * 5 + 1).alias("rfm_frequency_count"),
        F.when(F.col("id") == 7, None).otherwise(F.col("id") % 3 * 40.0).alias("rfm_monetary_avg"),
        (F.col("id") % 3 * 90.0).alias("rfm_monetary_total"),
    )
    rules = clustering.ClusterRules(k_min=2, k_max=4, restarts=2)
    seg = clustering.fit_segments(df, rules=rules)
    assert seg.k == 3 and seg.search.where("chosen").first()["k"] == 3
    groups = seg.assign(df).groupBy("segment").count().collect()
    assert sorted(r["count"] for r in groups) == [30, 30, 30]
    assert clustering.davies_bouldin(seg, df).first()["davies_bouldin"] < 0.2
    shares = clustering.segment_importance(seg, df).collect()
    assert sum(r["importance"] for r in shares) == pytest.approx(1.0)


def test_temporary_folder_is_refused_on_a_cluster(spark, monkeypatch):
    from tidemark.functions import staging

    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Conf:
        @staticmethod
        def get(*_):
            return None

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(ValueError, match="checkpoint"):
        staging.work_folder(Session())


def test_workspace_keeps_stage_tables_apart(spark, tmp_path):
    ws = stages.Workspace(spark, str(tmp_path))
    df = spark.range(3)
    assert ws.write(df, "a/b").count() == 3
    assert ws.read("a/b").count() == 3
