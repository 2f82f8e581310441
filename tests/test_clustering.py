import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.operators import clustering, kmeans


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(8)
    spots = np.array([[0, 0], [5, 0], [0, 6], [7, 7]])
    x = np.vstack([rng.normal(s, 0.8, (150, 2)) for s in spots])
    return x, spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "customer_id long, a double, b double")


def _pairwise(x, label):
    """Mean Euclidean silhouette from all distances."""
    away = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    out = []
    for i, k in enumerate(label):
        own = label == k
        if own.sum() == 1:
            out.append(0.0)
            continue
        a = away[i][own].sum() / (own.sum() - 1)
        b = min(away[i][label == j].mean() for j in set(label) - {k})
        out.append((b - a) / max(a, b))
    return np.mean(out)


def _labels(x, centres):
    return ((x[:, None] - centres[None]) ** 2).sum(axis=2).argmin(axis=1)


@pytest.fixture(scope="module")
def fitted(points):
    x, df = points
    data = kmeans.Vectors(df, "customer_id", ["a", "b"])
    return x, data, kmeans.fit(data, [(k, seed) for k in (3, 4, 5) for seed in range(4)])


def test_lloyd_steps_end_in_their_means(fitted):
    x, _, models = fitted
    for m in models:
        label = _labels(x, m.centres)
        assert np.allclose(m.centres, [x[label == k].mean(axis=0) for k in range(m.k)], atol=0.02)
        assert m.inertia == pytest.approx(((x - m.centres[label]) ** 2).sum())
    best = min((m for m in models if m.k == 4), key=lambda m: m.inertia)
    assert sorted(np.bincount(_labels(x, best.centres))) == [150] * 4


def test_sums_of_many_files(points, fitted, monkeypatch):
    x, data, models = fitted
    monkeypatch.setattr(data, "few", False)
    again = kmeans.fit(data, [(3, 0), (4, 1)])
    assert again[0].inertia == pytest.approx(models[0].inertia)


@pytest.mark.parametrize("cells", [kmeans.CELLS, 60])
def test_silhouettes_within_their_bound(fitted, cells):
    x, data, models = fitted
    for m, (found, bound) in zip(models, kmeans.silhouettes(data, models, cells)):
        exact = _pairwise(x, _labels(x, m.centres))
        assert abs(found - exact) <= bound + 1e-9
        # Distinct rows are their own cells; else the error is far under its bound.
        assert abs(found - exact) < (1e-6 if cells > len(x) else 0.02) and (cells < len(x) or bound < 1e-6)


def test_one_cluster_and_copies(spark):
    df = spark.range(50).select(F.col("id").alias("customer_id"), F.lit(1.0).alias("a"), (F.col("id") % 2).cast("double").alias("b"))
    data = kmeans.Vectors(df, "customer_id", ["a", "b"])
    one, two, three = kmeans.fit(data, [(1, 0), (2, 0), (3, 0)])
    assert one.inertia == pytest.approx(12.5) and two.inertia == pytest.approx(0) and three.inertia == pytest.approx(0)
    found = [s for s, _ in kmeans.silhouettes(data, [one, two])]
    assert found == pytest.approx([0.0, 1.0])


def test_model_reloads_and_fills(spark, points, tmp_path):
    _, df = points
    rfm = df.select(
        "customer_id", F.when(F.col("customer_id") % 9 > 0, F.col("a")).alias("rfm_recency_days"), F.col("b").alias("rfm_monetary_avg"),
        F.lit(None).cast("double").alias("engagement_score"), F.lit(9).alias("segment"),
    )
    seg = clustering.fit_segments(rfm, 4, clustering.ClusterRules(restarts=3))
    seg.save(spark, str(tmp_path / "s"))
    again = clustering.Segmentation.load(spark, str(tmp_path / "s"))
    one, two = seg.assign(rfm), again.assign(rfm)
    assert one.columns == rfm.columns and one.where("segment is null").isEmpty()
    assert sorted(map(tuple, one.collect()), key=repr) == sorted(map(tuple, two.collect()), key=repr)
    assert seg.medians[0] == pytest.approx(np.median([r[0] for r in rfm.where("rfm_recency_days is not null").select("rfm_recency_days").collect()]))
    measured = clustering.davies_bouldin(seg, rfm).first()
    assert measured["k"] == 4 and 0 < measured["davies_bouldin"] < 1


def test_blocks_are_read_in_bounded_pieces():
    """Distances of a whole block to all cells were once made in one piece."""
    n = 2 * kmeans.CHUNK + 7
    ids, x = np.arange(n, dtype="<i8"), np.arange(2.0 * n)
    batch = pa.RecordBatch.from_arrays([pa.array([ids.tobytes()] * 2), pa.array([x.tobytes()] * 2)], ["id", "x"])
    pieces = list(kmeans._Blocks(2).read(iter([batch])))
    assert max(len(i) for i, _ in pieces) == kmeans.CHUNK
    assert np.concatenate([i for i, _ in pieces]).tolist() == 2 * ids.tolist()
    assert np.concatenate([v for _, v in pieces]).ravel().tolist() == 2 * x.tolist()
