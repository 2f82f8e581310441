from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import boosting as b
from tidemark.operators import prediction

RULES = b.Growth(rounds=6, step=0.5, depth=3, row_share=1.0, column_share=1.0, min_rows=5)


@pytest.fixture(scope="module")
def noisy(spark):
    """y = 3 a + noise that is as wide as b."""
    base = spark.range(4000).select(
        F.col("id").alias("customer_id"),
        F.lit("x").alias("snapshot_date"),
        F.floor(F.rand(1) * 10).cast("double").alias("a"),
        F.floor(F.rand(2) * 3 + 1).cast("double").alias("b"),
        F.rand(3).alias("u"),
        F.element_at(F.array(*map(F.lit, ("train", "train", "val", "test"))), (F.col("id") % 4 + 1).cast("int")).alias("split"),
    )
    return base.withColumn("clv_target", 300 + 3 * F.col("a") + 10 * F.col("b") * (F.col("u") - 0.5)).drop("u")


def _same(one, two):
    return all((getattr(x, f) == getattr(y, f)).all() for x, y in zip(one, two) for f in ("feature", "bin", "value"))


def test_growing_on_keeps_the_trees_grown_before(spark, noisy):
    train = noisy.where("split = 'train'")
    short, = b.grow(train, ["a", "b"], [b.Objective("squared")], F.col("clv_target"), rules=RULES)
    long, = b.grow(train, ["a", "b"], [b.Objective("squared")], F.col("clv_target"), rules=b.replace(RULES, rounds=20))
    # Without validation rows all rounds are grown, past the rounds after which margins are written.
    assert (len(short.trees), len(long.trees)) == (6, 20) and _same(short.trees, long.trees[:6])
    assert _same(long.first(6).trees, short.trees)


def test_sums_of_many_files_give_the_same_trees(spark, noisy, monkeypatch):
    args = (["a", "b"], [b.Objective("squared"), b.Objective("quantile", 0.9)], F.col("clv_target"))
    one = b.grow(noisy, *args, rules=RULES)
    monkeypatch.setattr(b, "FEW", 0)
    two = b.grow(noisy, *args, rules=RULES)
    for x, y in zip(one, two):
        assert [t.feature.tolist() for t in x.trees] == [t.feature.tolist() for t in y.trees]
        assert np.allclose([t.value for t in x.trees], [t.value for t in y.trees])


def test_first_split_and_total_gain_by_hand(spark):
    rng = np.random.default_rng(3)
    x, z = rng.integers(0, 12, 400).astype(float), rng.integers(0, 5, 400).astype(float)
    y = np.where(x > 7, 5.0, 1.0) + z * 0.1
    rows = spark.createDataFrame([(*map(float, r), "train") for r in zip(x, z, y)], "x double, z double, y double, split string")
    model, = b.grow(rows, ["x", "z"], [b.Objective("squared")], F.col("y"), rules=b.replace(RULES, rounds=2, depth=1))

    def gain(target, mask):
        r = target - 0.0
        return r[mask].sum() ** 2 / mask.sum() + r[~mask].sum() ** 2 / (~mask).sum() - r.sum() ** 2 / len(r)

    margin, total = np.full(400, y.mean()), {"x": 0.0, "z": 0.0}
    for tree in model.trees:
        best = max(((gain(y - margin, v <= c), n, c) for n, v in (("x", x), ("z", z)) for c in np.unique(v)[:-1]), key=lambda g: g[0])
        name, cut = ("x", "z")[tree.feature[1]], tree.threshold[1]
        assert name == best[1] and tree.gain[1] == pytest.approx(best[0])
        values = {"x": x, "z": z}[name]
        assert ((values <= cut) == ({"x": x, "z": z}[best[1]] <= best[2])).all()
        assert tree.rows[1] == 400 and tree.rows[2] == (values <= cut).sum()
        total[name] += tree.gain[1]
        for side in (values <= cut, values > cut):
            margin[side] += 0.5 * (y - margin)[side].mean()
    assert np.allclose(model.margins(np.stack([x, z], axis=1)), margin)
    found = {r["feature"]: r["importance"] for r in prediction.feature_importance(model, rows).collect()}
    assert found == pytest.approx(total)
    top = prediction.feature_importance(model, rows, 1).first()
    assert top["feature"] == "x"


def test_logistic_margins_by_hand(spark):
    rows = spark.createDataFrame(
        [(float(i % 2), float(i % 2 if i % 10 else 1 - i % 2), 2.0, "train") for i in range(200)], "x double, y double, w double, split string"
    )
    model, = b.grow(rows, ["x"], [b.Objective("logistic")], F.col("y"), F.col("w"), b.replace(RULES, rounds=40, depth=1, step=1.0))
    got = {r["x"]: r["p"] for r in rows.withColumn("p", model.predicted(spark)).collect()}
    assert got[0.0] == pytest.approx(0.2, abs=1e-3) and got[1.0] == pytest.approx(1.0, abs=1e-3)


def test_a_band_of_boosters_covers_known_noise_better_than_a_forest(spark, noisy):
    rules = prediction.TreeRules(rounds=150, patience=20, step=0.1, depth=3, forest_trees=20)
    model = prediction.train_value(noisy, rules, log_transform=False, bounds=True)
    forest = prediction.train_forest_bounds(model, noisy, rules)
    test = noisy.where("split = 'test'")

    def judged(m):
        scored = m.predict(test, bounds=True, keep=("clv_target",)).cache()
        y = F.col("clv_target")
        loss = sum(
            F.avg(F.greatest(q * (y - F.col(c)), (q - 1) * (y - F.col(c))))
            for q, c in zip(prediction.BAND, ("clv_lower_10pct", "clv_median", "clv_upper_90pct"))
        )
        ordered = F.min((F.col("clv_lower_10pct") <= F.col("clv_median")) & (F.col("clv_median") <= F.col("clv_upper_90pct")))
        return *scored.agg(loss, ordered).first(), prediction.coverage(scored).first()["coverage"]

    ours, in_order, share = judged(model)
    theirs, _, _ = judged(forest)
    assert in_order and 0.75 < share < 0.85 and ours < theirs


def test_a_median_objective_resists_outliers(spark, noisy):
    wild = noisy.withColumn("clv_target", F.when(F.col("customer_id") % 40 == 0, 1e5).otherwise(F.col("clv_target")))
    rules = prediction.TreeRules(rounds=60, patience=20, step=0.2, depth=3)
    model = prediction.train_value(wild, rules, log_transform=False, objective=0.5)
    off = model.predict(noisy.where("split = 'test'"), keep=("clv_target",)).agg(F.avg(F.abs(F.col("clv_prediction") - F.col("clv_target"))))
    assert off.first()[0] < 8


def test_nulls_and_empty_tables(spark, noisy, tmp_path):
    holes = noisy.withColumns(
        {"a": F.when(F.col("customer_id") % 5 > 0, F.col("a")), "clv_target": F.when(F.col("customer_id") % 7 > 0, F.col("clv_target"))}
    ).withColumn("c", F.lit(None).cast("double"))
    model, = b.grow(holes, ["a", "b", "c"], [b.Objective("squared")], F.col("clv_target"), rules=RULES)
    assert model.trees and holes.where(model.predicted(spark).isNull()).isEmpty()
    none, = b.grow(holes.where("false"), ["a"], [b.Objective("squared")], F.col("clv_target"), rules=RULES)
    assert none.trees == [] and noisy.select(none.predicted(spark)).distinct().collect() == [(0.0,)]
    model.save(spark, str(tmp_path / "m"))
    again = b.Ensemble.load(spark, str(tmp_path / "m"))
    assert again.losses == model.losses and again.objective == model.objective
    both = holes.select(model.predicted(spark).alias("x"), again.predicted(spark).alias("y"))
    assert both.where("x <> y").isEmpty()


def test_paths_and_ends_are_those_of_a_walk(spark):
    rng = np.random.default_rng(5)
    tree = b.Tree.empty(4)
    for n in range(1, 16):
        if (n == 1 or tree.feature[n // 2] >= 0) and n not in (5, 6):
            tree.feature[n], tree.bin[n] = rng.integers(0, 3), rng.integers(0, 5)
    bins = rng.integers(0, 6, (3, 500)).astype(np.uint8)
    for depth in range(5):
        want = []
        for row in bins.T:
            n = 1
            for _ in range(depth):
                if tree.feature[n] >= 0:
                    n = 2 * n + int(row[tree.feature[n]] > tree.bin[n])
            want.append(n)
        assert tree.ends(depth)[tree.paths(bins, depth)].tolist() == want


def test_nothing_is_written_while_trees_grow(spark, noisy):
    """Margins were once written out whole every few rounds."""
    folder = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(folder.iterdir())
    b.grow(noisy, ["a", "b"], [b.Objective("squared")], F.col("clv_target"), rules=b.replace(RULES, rounds=2 * b.REWRITE + 1, patience=100))
    assert len(set(folder.iterdir()) - before) == 1


def test_an_ensemble_that_has_stopped_leaves_the_passes(spark, noisy, monkeypatch):
    """All objectives were once added up until the last of them stopped."""
    seen, level_pass = [], b._level_pass

    def recorded(state, trees, *rest):
        seen.append(len(trees))
        return level_pass(state, trees, *rest)

    args = (["a", "b"], [b.Objective("squared"), b.Objective("quantile", 0.5)], F.col("clv_target"))
    alone, = b.grow(noisy, args[0], args[1][:1], args[2], rules=RULES)
    monkeypatch.setattr(b, "_level_pass", recorded)
    # The squared losses are the large ones.
    monkeypatch.setattr(b, "best_round", lambda losses, *rest: (len(losses), len(losses) >= (2 if losses[0] > 15 else 4)))
    one, two = b.grow(noisy, *args, rules=RULES)
    assert (len(one.trees), len(two.trees)) == (2, 4) and _same(one.trees, alone.trees[:2])
    assert seen[0] == 2 and seen[-1] == 1


def test_columns_of_a_block_come_back():
    rng = np.random.default_rng(1)
    n = 1000
    block = {"id": np.arange(n) + 7, "y": rng.normal(size=n), "weight": np.ones(n), "held": rng.random(n) < 0.5}
    block["bins"] = rng.integers(0, 64, (3, n)).astype(np.uint8)
    for change in ({}, {"id": np.arange(n) * 2, "y": rng.integers(0, 2, n) * 1.0, "weight": rng.integers(0, 3, n) / 7}, {"held": np.zeros(n, bool)}):
        want = block | change
        packed = b._packed(want)
        found = b._block({c: packed.column(c)[0].as_py() for c in packed.schema.names}, 3)
        assert all((found[c] == want[c]).all() and len(found[c]) == len(want[c]) for c in want)
