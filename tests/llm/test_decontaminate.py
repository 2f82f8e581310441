import re

from tidemark.llm import decontaminate as d
from tidemark.llm import text
from tidemark.llm.queries import op2_decontamination


def _words(t):
    return [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").lower()) if w]


def _runs(w, n):
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}


def _brute(docs, items):
    out = set()
    for i, t in docs:
        w = _words(t)
        for k, x in items:
            own = _words(x)
            n = min(5, len(own))
            if own and len(_runs(own, n) & _runs(w, n)) >= 0.8 * len(_runs(own, n)) - 1e-9:
                out.add((i, k))
    return out


ITEM = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi"


def test_against_brute_force(spark, docs, odd):
    w = ITEM.split()
    rows = odd + [
        (10, f"before {ITEM.upper()}, after"),
        (11, " ".join(w[:7]) + " cut " + " ".join(w[7:])),  # four of ten runs are lost
        (12, " ".join(w[:-2])),  # eight of ten runs
        (13, " ".join(w[:-3])),  # seven of ten runs
        (14, ("x y z " * 5000) + ITEM.replace(" ", ", ")),
        (14, "same id, clean"),
        (None, ITEM),
        (15, "short item"), (16, "a short item!"), (17, "solo"),
        (18, ITEM), (18, ITEM),
    ]
    items = [(1, ITEM), (1, ITEM), (2, "Short item"), (3, "solo"), (4, ""), (5, None), (6, "a b c d e"), (None, "other text same id"), (1, "one")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    df = docs(rows)
    got = d.leaks(df, bench).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == _brute(rows, items)
    assert {r["doc_id"] for r in got if r["item_id"] == 1} >= {10, 12, 14, 18, None}
    kept = d.clean(df, bench)
    assert kept.columns == df.columns
    want = [t for i, t in rows if not any(_brute([(i, t)], [x]) for x in items)]
    assert sorted(r["text"] or "" for r in kept.collect()) == sorted(t or "" for t in want)


def test_shuffled_when_too_large_to_broadcast(spark, docs, monkeypatch):
    monkeypatch.setattr(text, "BROADCAST", -1)
    bench = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    found = d.leaks(docs([(1, ITEM), (2, "clean")]), bench).collect()
    assert [(r["doc_id"], r["n_shared"], r["n_shingles"]) for r in found] == [(1, 10, 10)]


def test_common_stem_is_in_no_sketch_but_of_items_without_more(spark, docs):
    """A stem that all items share doesn't make every item a candidate of each document that holds it."""
    stem = "which of the following statements is true about the"
    names = [f"subject{i} ending{i} here{i} with{i} more{i} words{i}" for i in range(40)]
    items = [(i, f"{stem} {x}") for i, x in enumerate(names)] + [(99, stem)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = [(1, f"{stem} nothing"), (2, f"so {stem} {names[7]} end"), (3, " ".join(names)), (4, "clean")]
    prepared = d.prepare(bench)
    lists = [r["__items"] for r in d.sketches(prepared).collect()]
    assert max(map(len, lists)) == 1
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, item_id int, n_shared int")
    got = d.leaks(df, bench)
    assert sorted(got.columns) == ["doc_id", "item_id", "n_shared", "n_shingles", "text_hash"]
    assert {(r["doc_id"], r["item_id"]) for r in got.collect()} == _brute(rows, items) == {(1, 99), (2, 7), (2, 99)}


def test_texts_are_split_once_for_all_widths(spark, docs):
    items = [(1, "one"), (2, "two words"), (3, "three whole words"), (4, "now four words here"), (5, ITEM)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = [(k, t) for k, (_, t) in enumerate(items * 2)] + [(50, "ONE. now, four words; here two words")]
    assert sorted((r["doc_id"], r["item_id"]) for r in d.leaks(docs(rows), bench).collect()) == sorted(_brute(rows, items))
    prepared = d.prepare(bench)
    read = docs(rows).select(d.F.col("doc_id").alias("__id"), text.whole(d.F.col("text")).alias("__text"))
    plan = d.candidates(read, prepared, [1, 2, 3, 4, 5])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 1 and "Union" not in plan


def test_empty_tables(spark, docs):
    bench = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    assert d.leaks(docs([]), bench).count() == 0
    assert d.leaks(docs([(1, ITEM)]), bench.limit(0)).count() == 0
    assert d.clean(docs([(1, ITEM)]), bench.limit(0)).count() == 1


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    read = lambda t, k: [(r[k], r["text"]) for r in spark.read.parquet(f"{folder}/{t}.parquet").collect()]
    rows = op2_decontamination(spark, folder).collect()
    assert {(r["doc_id"], r["item_id"]) for r in rows} == _brute(read("documents", "doc_id"), read("benchmark", "item_id"))
