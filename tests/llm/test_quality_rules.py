import re
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import quality_rules as q
from tidemark.llm.queries import op7_quality_rules

FOLDER = "/root/testdata/sf0.001"


def _counts(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    runs = [tuple(w[k : k + 3]) for k in range(len(w) - 2)]
    often = Counter(runs)
    repeated = {k + j for k, r in enumerate(runs) if often[r] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    symbols = sum(text.count(c) for c in "#*$%&|<>")
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(repeated)


def test_counts(docs, odd):
    rows = odd + [(20, "a b c a b c"), (21, "x x x x"), (22, "a b a b a"), (23, "l 1\nl 1\n \nl 1 \n\nl 1"), (24, "# *|\n<>&$% é")]
    out = q.statistics(docs(rows))
    assert "text" not in out.columns and out.columns.count("n_words") == 1
    got = sorted(tuple(r[c] for c in ("doc_id", *q.COUNTS)) for r in out.where("doc_id is not null").collect())
    assert got == sorted((i, *_counts(t)) for i, t in rows if i is not None)


def test_kept_rows_are_unchanged(docs, odd):
    text = " ".join(f"v{k}" for k in range(60))
    df = docs([*odd, (40, text), (40, text)])
    kept = q.keep(df)
    assert kept.columns == df.columns
    # The long text repeats itself, all others are too short.
    assert [tuple(r)[:2] for r in kept.collect()] == [(40, text), (40, text)]
    assert q.judge(docs([])).count() == 0


def test_chi_square():
    assert q.chi_square_cut(0.05, 5) == pytest.approx(11.07, abs=0.05)
    assert q._chi_square_below(11.07, 5) == pytest.approx(0.95, abs=1e-3)
    assert q.consistency(0.999999, 5) == pytest.approx(1, abs=0.01)


def test_steps_against_numpy(spark):
    """The estimate of one pool equals concentration steps written with matrices."""
    rng = np.random.default_rng(1)
    x = rng.normal(size=(600, 5)) @ rng.normal(size=(5, 5)) * 0.2
    x[:90] += 6
    names = q.DIMENSIONS
    df = spark.createDataFrame([("p", *map(float, r)) for r in x], ["__pool", *names])
    limits = q.Limits()
    estimate = q._starts(df, limits).where("__start = 0")
    med = np.array([np.sort(c)[299] for c in x.T])
    dev = np.array([np.sort(np.abs(c - m))[299] for c, m in zip(x.T, med)])
    mean, cov = med, np.diag(np.maximum(dev * 1.4826, limits.floor) ** 2)
    for _ in range(3):
        estimate = q._step(df, estimate, limits)
        diff = x - mean
        d = np.einsum("ij,ij->i", diff @ np.linalg.inv(cov), diff)
        bucket = np.floor(np.log2(d + 1e-6) * 16)
        cells = sorted(Counter(bucket).items())
        before, near = 0, []
        for b, n in cells:
            if before < 600 * limits.share:
                near.append(b)
            before += n
        some = x[np.isin(bucket, near)]
        mean = some.mean(axis=0)
        cov = q.consistency(limits.share, 5) * np.cov(some.T, bias=True) + np.diag(np.square(limits.floor))
    row = estimate.first()
    low = np.zeros((5, 5))
    for i in range(5):
        for j in range(i + 1):
            low[i, j] = row[f"l_{i}_{j}"]
    assert [row[f"m_{i}"] for i in range(5)] == pytest.approx(list(mean), abs=1e-6)
    assert low @ low.T == pytest.approx(cov, abs=1e-6)
    got = df.crossJoin(estimate.drop("__pool")).select(q.distance(names).alias("d")).collect()
    diff = x - mean
    want = np.einsum("ij,ij->i", diff @ np.linalg.inv(cov), diff)
    assert [r["d"] for r in got] == pytest.approx(list(want), rel=1e-6)


def test_rest_of_smaller_determinant(spark):
    """Both starts go on until they rest; planted outliers don't shape the end."""
    rng = np.random.default_rng(2)
    line = rng.normal(size=(500, 1)) * np.array([[4.0, 4.0, 1.0, 1.0, 1.0]])
    x = line + rng.normal(size=(500, 5)) * 0.3
    # Off the line, yet near the middle of every single dimension.
    x[:100, :2] = rng.normal(size=(100, 2)) * 0.2 + np.array([2.5, -2.5])
    df = spark.createDataFrame([(p, *map(float, r)) for p in "ab" for r in x], ["__pool", *q.DIMENSIONS])
    limits = q.Limits()
    ends = {r["__pool"]: r for r in q.concentrated(df, limits).withColumn("v", q._volume()).collect()}
    assert set(ends) == {"a", "b"} and ends["a"]["v"] == ends["b"]["v"]
    alone = []
    now = q._starts(df.where("__pool = 'a'"), limits)
    for start in range(2):
        one = now.where(f"__start = {start}")
        for _ in range(4):
            one = spark.createDataFrame(q._step(df, one, limits).collect())
        alone.append(one.select(q._volume().alias("v")).first()["v"])
    assert ends["a"]["v"] <= min(alone) + 0.01
    some = spark.createDataFrame([ends["a"]]).drop("__pool")
    far = [r["d"] > q.chi_square_cut(limits.tail, 5) for r in df.where("__pool = 'a'").crossJoin(some).select(q.distance(q.DIMENSIONS).alias("d")).collect()]
    assert sum(far[:100]) >= 95 and not any(far[100:])
    assert q.concentrated(df.where("false"), limits).count() == 0


def test_rows_stay_in_place(spark):
    """Estimates of a hot pool are broadcast: no join of rows by pool."""
    rows = [("hot" if k % 3 else f"p{k % 7}", *(float((k * j) % 11) for j in range(1, 6))) for k in range(900)]
    df = spark.createDataFrame(rows, ["__pool", *q.DIMENSIONS])
    limits = q.Limits()
    for plan in (q._starts(df, limits), q._step(df, q._starts(df, limits), limits)):
        text = plan._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in text and "ShuffledHashJoin" not in text


def test_query_and_clean_documents(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    out = op7_quality_rules(spark, FOLDER)
    rows = out.collect()
    assert len(rows) == len(texts)
    for r in rows:
        counts = _counts(texts[r["doc_id"]])
        assert tuple(r[c] for c in q.COUNTS) == counts
        assert r["base_failed"] == (counts[0] < 50 or 100 * counts[4] > 50 * counts[0])
        assert not (r["base_failed"] and r["kept"])
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    both = out.join(labels, "doc_id").where("not base_failed")
    assert both.where("quality = 1 and not kept").count() == 0
    junk = both.where("quality = 0")
    assert junk.where("not kept").count() >= 0.9 * junk.count()


def test_no_python_in_the_plan(spark):
    plan = op7_quality_rules(spark, FOLDER)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan.replace("PythonSQL", ""))
