import zlib

from pyspark.sql import functions as F

from tidemark.llm import rule_ensemble as e
from tidemark.llm.queries import op10_quality_classifier


def test_statistics_are_finite(docs, odd):
    rows = e.statistics(docs(odd)).collect()
    assert len(rows) == len(odd)
    assert all(r[c] is not None and abs(r[c]) < 1e9 for r in rows for c in e.STATISTICS)


def test_paths_of_a_printed_tree():
    text = """GBTClassificationModel: uid=x, numTrees=2
  Tree 0 (weight 1.0):
    If (feature 3 <= 0.5)
     If (feature 3 <= 0.2)
      Predict: 1.0
     Else (feature 3 > 0.2)
      Predict: 0.0
    Else (feature 3 > 0.5)
     Predict: 0.0
  Tree 1 (weight 0.1):
    If (feature 0 <= -1.5E-4)
     Predict: 1.0
    Else (feature 0 > -1.5E-4)
     Predict: 0.0
"""
    a, b = e.STATISTICS[3], e.STATISTICS[0]
    want = [((a, "<=", 0.5),), ((a, "<=", 0.2),), ((a, "<=", 0.5), (a, ">", 0.2)), ((a, ">", 0.5),), ((b, "<=", -1.5e-4),), ((b, ">", -1.5e-4),)]
    assert sorted(e.paths(text)) == sorted(want)


def test_score_is_the_logistic_sum_of_rules(spark):
    model = e.Ensemble(((((e.STATISTICS[0], "<=", 1.0),), 2.0), (((e.STATISTICS[0], ">", 0.0), (e.STATISTICS[1], ">", 5.0)), -3.0)), 0.5)
    df = spark.createDataFrame([(0.5, 9.0), (2.0, 1.0)], [e.STATISTICS[0], e.STATISTICS[1]])
    got = [r[0] for r in df.select(model.score()).collect()]
    import math

    assert [round(g, 9) for g in got] == [round(1 / (1 + math.exp(-x)), 9) for x in (-0.5, 0.5)]


def test_odd_rows_and_labels(spark, docs, odd):
    df = docs(odd)
    none = spark.createDataFrame([], "doc_id long, quality int")
    rows = e.classify(df, none).collect()
    assert len(rows) == len(odd) and {r["score"] for r in rows} == {0.5}
    for r in rows:
        key = "" if r["doc_id"] is None else str(r["doc_id"])
        assert r["held_out"] == (zlib.crc32(key.encode()) % 5 == 0)
    one = spark.createDataFrame([(k, 1) for k in range(20)] + [(1, None), (None, 0), (2, 7)], "doc_id long, quality int")
    assert {r["score"] for r in e.classify(df, one).collect()} == {1.0}
    assert e.classify(docs([]), one).count() == 0


def test_held_out_labels_are_never_read(spark, docs):
    rows = [(k, ("good words here. " * 9) if k % 3 else "bad*** $$$ |||") for k in range(90)]
    labels = [(k, int(k % 3 > 0)) for k in range(90)]
    wrong = [(k, (1 - q) if zlib.crc32(str(k).encode()) % 5 == 0 else q) for k, q in labels]
    schema = "doc_id long, quality int"
    a, b = (e.classify(docs(rows), spark.createDataFrame(x, schema)).collect() for x in (labels, wrong))
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))
    assert all(r["predicted"] == int(r["doc_id"] % 3 > 0) for r in a)


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    out = op10_quality_classifier(spark, folder)
    seen = out.where("held_out").join(labels, "doc_id")
    right = seen.agg(F.avg((F.col("predicted") == F.col("quality")).cast("int"))).first()[0]
    assert right > 0.95
    assert out.where("score < 0 or score > 1 or score is null").count() == 0
