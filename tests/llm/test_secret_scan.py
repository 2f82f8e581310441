import re

from pyspark.sql import functions as F

from tidemark.llm import secret_scan as s
from tidemark.llm.queries import op9_secret_scan

KEY = "9f86d081884c7d659a2feaa0c55ad015a3bf4f1b"
TOKEN = "ghp_A1b2C3d4E5f6G7h8I9j0K1l2"


def test_candidates_by_brute_force(docs, odd):
    rows = odd + [(30, f'say token = "{KEY}" and {TOKEN}, visit /usr/lib/python3.13/site'), (31, "tel 4916123456789012 x"), (32, KEY + " " + KEY)]
    got = sorted((repr(r["__id"]), r["at"], r["value"]) for r in s.candidates(docs(rows)).collect())
    want = []
    for i, t in rows:
        for at, w in enumerate(re.findall(r"[^\x20\x09-\x0D]+", t or "")):
            want += [(repr(i), at, v) for v in re.findall(s.SHAPE, w) if re.search("[0-9]", v)]
    assert got == sorted(want)


def test_dictionary_and_transitions(docs):
    terms = {r["term"]: r["n"] for r in s.dictionary(docs([(1, "Abc abc, (abc) ab1 x été"), (2, None)])).collect()}
    assert terms == {"abc": 3, "été": 1}
    pairs = {r["pair"]: round(r["log_p"], 4) for r in s.transitions(s.dictionary(docs([(1, "ab ab ac")]))).collect()}
    assert pairs == {"ab": -0.4055, "ac": -1.0986}


def _rows():
    rows = []
    for k in range(60):
        key = "".join("0123456789abcdef"[(k * 7 + j * j * 5 + j * k) % 16] for j in range(40))
        rows.append((k, f'words of text here token = "{key}" and more words'))
        rows.append((100 + k, f"call 49161234567{k:04d} or see https://host{k}.example.com/path/to/page{k}.html soon"))
    return rows


def test_scan_and_redact(docs):
    rows = _rows() + [(500, None), (501, "nothing"), (None, rows_text := f'token = "{KEY}" twice {KEY}'), (0, "same id, clean")]
    df = docs(rows)
    out = s.scan(df).collect()
    assert {r["doc_id"] for r in out if r["secret"]} == {*range(60), None}
    masked = s.redact(df.withColumn("n_chars", F.length("text")))
    assert masked.columns == [*df.columns, "n_chars"] and masked.count() == len(rows)
    texts = {}
    for r in masked.collect():
        texts.setdefault(r["doc_id"], set()).add(r["text"])
        assert r["n_chars"] == (len(r["text"]) if r["text"] is not None else None)
    assert texts[None] == {rows_text.replace(KEY, "[SECRET]")}
    assert texts[500] == {None} and "same id, clean" in texts[0]
    assert all("[SECRET]" not in t for k in range(100, 160) for t in texts[k])


def test_labels_are_used_and_one_class_is_enough(spark, docs):
    df = docs(_rows())
    described = s.describe(s.candidates(df), s.dictionary(df))
    labelled = described.withColumn("label", F.col("host"))
    got = s.scan(df, labelled=labelled).where("secret").select("value").distinct().collect()
    assert got and not any(re.fullmatch("[0-9a-f]{40}", r["value"]) for r in got)
    none = s.judge(described, s.train(described.withColumn("label", F.lit(0.0))))
    assert none.where("secret").count() == 0
    assert s.scan(docs([])).count() == 0 and s.redact(docs([])).count() == 0
    assert s.scan(docs([(1, "no candidates")])).count() == 0


def test_sample_is_bounded(docs):
    df = docs(_rows())
    described = s.label_by_marker(s.describe(s.candidates(df), s.dictionary(df)))
    assert s.train(described, sample=40, trees=2) is not None


def test_sample_holds_both_classes_and_no_hot_finding_fills_it(spark):
    def row(k, label, named):
        return (20.0 + k % 50, (k % 97) / 97, 0.0, (k % 89) / 89, 0.0, 0.3, -5.0, 0.1, 0.0, 0.0, named, named, 0.0, label)

    schema = ", ".join(f"{c} double" for c in [*s.FEATURES, "label"])
    make = lambda rows: spark.createDataFrame(rows, schema)
    clean, secret = [row(k, 0.0, 0.0) for k in range(2000)], [row(k, 1.0, 1.0) for k in range(8)]
    # One secret stands in as many places as all else, and its hash comes first.
    hashes = make([row(k, 1.0, 1.0) for k in range(3000, 5000)]).orderBy(F.xxhash64(*s.FEATURES, "label")).first()
    for rows in (clean + secret, clean + [tuple(hashes)] * 2000):
        judged = s.judge(make(rows), s.train(make(rows), sample=40))
        share = {r["label"]: r["share"] for r in judged.groupBy("label").agg(F.avg(F.col("secret").cast("int")).alias("share")).collect()}
        assert share[1.0] == 1.0 and share[0.0] < 0.1, share


def test_query_finds_planted_tokens(spark):
    folder = "/root/testdata/sf0.01"
    texts = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    want = {(r["doc_id"], v) for r in texts for v in re.findall(r'token = "([0-9a-f]{40})"', r["text"] or "")}
    out = op9_secret_scan(spark, folder)
    got = {(r["doc_id"], r["value"]) for r in out.where("secret").collect()}
    assert want <= got and len(got - want) <= 0.2 * len(want)
    plan = out._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
