import random
import re

from tidemark.llm import license_scan as l
from tidemark.llm.queries import op5_license_scan

PHRASES = {("mit", "license"): "mit", ("apache", "license"): "apache", ("general", "public", "license"): "gpl"}


def _base(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    found = [
        (k, k + len(p) - 1, label)
        for k in range(len(w)) for p, label in PHRASES.items() if tuple(w[k : k + len(p)]) == p
    ]
    first = min((f[0] for f in found), default=None)
    last = max((f[0] for f in found), default=None)
    return len(w), len(found), first, last, ",".join(sorted({f[2] for f in found}))


def _check(r, text):
    assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == _base(text)
    assert set(filter(None, r["base_labels"].split(","))) <= set(filter(None, r["labels"].split(",")))
    assert r["labels"] == ",".join(sorted(set(r["labels"].split(",")))) and 0 <= r["score"] <= 1


def test_rows(docs, odd):
    rng = random.Random(3)
    parts = [t for _, t in (*l.BASE, *l.NOTICES)] + ["general public", "the license", "mit", "wörter", "MIT License", "9license"]
    rows = odd + [(100 + k, rng.choice([" ", "\n", ", "]).join(rng.choices(parts, k=rng.randrange(1, 9)))) for k in range(60)]
    out = l.scan(docs(rows))
    assert out.columns.count("labels") == 1 and "ids" in out.columns
    got = sorted(out.collect(), key=repr)
    assert len(got) == len(rows)
    by = {}
    for i, t in rows:
        by.setdefault(i, []).append(_base(t))
    for r in got:
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) in by[r["doc_id"]]


def test_labels_beyond_the_base(docs):
    bsd = l.NOTICES[7][1]
    damaged = bsd.replace("binary", "any binary").replace("permitted", "ALLOWED")
    rows = [(1, "x " + bsd + " y"), (2, damaged), (3, " ".join(bsd.split()[:8])), (4, "Licensed under CC BY-NC 4.0."), (5, "the of and source")]
    got = {r["doc_id"]: r for r in l.scan(docs(rows)).collect()}
    assert got[1]["labels"] == "bsd" and got[1]["score"] == 1
    assert got[2]["labels"] == "bsd" and 0.75 <= got[2]["score"] < 1
    assert got[3]["labels"] == "" and 0 < got[3]["score"] < 0.75
    assert got[4]["labels"] == "cc-by-nc" and got[5]["labels"] == ""
    span = got[1]["spans"][0]
    assert (span["first_word"], span["last_word"]) == (1, len(bsd.split()))


def test_matching_statistics_by_brute_force():
    a = l.automaton()
    rng = random.Random(5)
    runs = {tuple(s[i:j]) for s in a.sequences for i in range(len(s)) for j in range(i + 1, len(s) + 1)}
    for _ in range(60):
        some = rng.choice(a.sequences)
        ids = [*some[rng.randrange(3) :], *rng.choice(a.sequences)[: rng.randrange(9)], rng.randrange(1, 30)]
        for at, (_, n) in enumerate(a.statistics(ids)):
            assert n == max(k for k in range(at + 2) if k == 0 or tuple(ids[at + 1 - k : at + 1]) in runs)


def test_empty_table(docs):
    assert l.scan(docs([])).count() == 0


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = op5_license_scan(spark, folder).collect()
    assert len(rows) == len(texts)
    for r in rows:
        _check(r, texts[r["doc_id"]])
