import public_tokenizers
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline as p
from tidemark.llm import bpe, decontaminate, quality_rules, queries, secret_scan, simhash

FOLDER = "/root/testdata/sf0.001"


def test_stages_in_order():
    assert [n for n, _ in p.STAGES] == ["quality_rules", "simhash", "decontamination", "secret_scan", "byte_bpe"]


def test_result_follows_from_the_operators(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    bench = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    kept = quality_rules.judge(docs).where("kept").select("doc_id")
    good = docs.join(kept, "doc_id", "left_semi")
    classes = simhash.classes(good.select("doc_id", "text"))
    one = good.join(classes.where("doc_id = component_id"), "doc_id", "left_semi")
    leaked = decontaminate.leaks(one, bench).select("doc_id").distinct()
    clean = one.join(leaked, "doc_id", "left_anti")
    secrets = secret_scan.scan(clean).where("secret").select("doc_id", "value").collect()
    values = {}
    for r in secrets:
        values.setdefault(r["doc_id"], set()).add(r["value"])
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(queries.RANKS), special_tokens={})
    want = {}
    for r in clean.collect():
        text = r["text"]
        for v in sorted(values.get(r["doc_id"], ()), key=len, reverse=True):
            text = text.replace(v, "[SECRET]")
        want[r["doc_id"]] = enc.encode_ordinary(text)
    rows = p.run(spark, FOLDER).collect()
    assert {r["doc_id"]: r["ids"] for r in rows} == want and all(r["exact"] for r in rows)
    assert 0 < len(rows) < docs.count()


def test_clean_documents_stay(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").where("quality = 1")
    good = docs.join(labels, "doc_id", "left_semi").where(F.size(F.split("text", r"\s+")) > 60)
    kept = p.drop_bad(spark, docs, FOLDER)
    assert good.join(kept, "doc_id", "left_anti").count() == 0
    assert kept.columns == docs.columns


def test_every_stage_takes_odd_and_empty_documents(spark, odd):
    docs = spark.createDataFrame([(i, t, "en", None, len(t or "")) for i, t in odd], "doc_id long, text string, lang string, source string, n_chars long")
    for table in (docs, docs.limit(0)):
        for name, step in p.STAGES:
            out = step(spark, table, FOLDER)
            if name != "byte_bpe":
                assert out.columns == table.columns
            assert out.count() <= table.count()
