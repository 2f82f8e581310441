import random
import re

import numpy as np
import pytest
import xxhash

from tidemark.llm import simhash as s
from tidemark.llm.queries import op6_simhash


def _print(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not w:
        return 0
    runs = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _components(rows):
    """(id, fingerprint, component) by comparing all with all."""
    prints = [_print(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                parent[find(i)] = find(j)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return sorted((repr(i), f"{p:016x}", repr(least.get(find(k)))) for k, ((i, _), p) in enumerate(zip(rows, prints)))


def _result(df):
    return sorted((repr(r["doc_id"]), r["fingerprint"], repr(r["component_id"])) for r in df.collect())


def _rows(odd):
    rng = random.Random(1)
    w = [f"w{rng.randrange(500)}" for _ in range(400)]
    near = []
    for k in range(60):
        v = list(w)
        v[rng.randrange(400)] = f"x{k}"
        near.append((200 + k, " ".join(v)))
    return [r for r in odd if len(r[1] or "") < 1000] + near + [(300, " ".join(w)), (301, " ".join(w).upper())]


def test_against_all_pairs(docs, odd):
    rows = _rows(odd)
    assert _result(s.classes(docs(rows))) == _components(rows)


def test_hot_groups_are_dealt_again(spark, monkeypatch):
    monkeypatch.setattr(s, "HOT", 5)
    rng = random.Random(2)
    base = [rng.getrandbits(64) for _ in range(20)]
    prints = {b ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(4))) for b in base for _ in range(30)}
    prints |= {b for b in base}
    signed = [p - 2**64 if p >= 2**63 else p for p in (x % 2**64 for x in prints)]
    df = spark.createDataFrame([(p,) for p in set(signed)], "__fp long")
    got = {r["__fp"]: r["root"] for r in s.roots(df).collect()}
    values = sorted(set(signed))
    parent = {v: v for v in values}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in values:
        for b in values:
            if b < a and ((a ^ b) % 2**64).bit_count() <= 2:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    assert got == {v: find(v) for v in values}


@pytest.mark.parametrize("n", [1, 2, 17, 900])
def test_gray_index_by_brute_force(n):
    rng = np.random.default_rng(n)
    centre = rng.integers(0, 2**64, 9, dtype=np.uint64)
    flips = (np.uint64(1) << rng.integers(0, 64, (n, 3), dtype=np.uint64)) * rng.integers(0, 2, (n, 3), dtype=np.uint64)
    prints = np.unique(centre[rng.integers(0, 9, n)] ^ np.bitwise_xor.reduce(flips, axis=1))
    index = s.GrayIndex(prints)
    who, node = index.search(prints)
    got = {(int(prints[a]), int(index.prints[b])) for a, b in zip(who, node)}
    want = {(int(a), int(b)) for a in prints for b in prints if int(a ^ b).bit_count() <= 2}
    assert got == want


def test_chain_of_links(spark):
    rng = random.Random(7)
    ids = rng.sample(range(-(10**9), 10**9), 400)
    edges = [(max(a, b), min(a, b)) for a, b in zip(ids[:300], ids[1:300])] + [(max(a, b), min(a, b)) for a, b in zip(ids[300:], ids[301:])]
    got = {r["node"]: r["root"] for r in s.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    for part in (ids[:300], ids[300:]):
        assert {got.get(i, i) for i in part} == {min(part)}


def test_first_of_each(docs, odd):
    rows = _rows(odd)
    df = docs(rows)
    kept = s.first_of_each(df)
    assert kept.columns == df.columns
    want = {c for _, _, c in _components(rows)}
    assert sorted(repr(r["doc_id"]) for r in kept.collect()) == sorted(want)


def test_empty_table(docs):
    assert s.classes(docs([])).count() == 0 and s.first_of_each(docs([])).count() == 0


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    assert _result(op6_simhash(spark, folder)) == _components(rows)
