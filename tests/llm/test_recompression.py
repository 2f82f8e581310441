import hashlib
import random

import numpy as np
import pytest

from tidemark.llm import recompression as r
from tidemark.llm.queries import op12_recompression

COLUMNS = ("doc_id", "n_words", "n_removed", "kept_sha256")


def _brute(rows):
    least = {}
    for i, t in rows:
        w = (t or "").encode().split()
        for p in range(len(w) - 12):
            k = tuple(w[p : p + 13])
            least[k] = min(least.get(k, float("inf")), float("inf") if i is None else i)
    out = []
    for i, t in rows:
        w = (t or "").encode().split()
        gone = [False] * len(w)
        for p in range(len(w) - 12):
            if least[tuple(w[p : p + 13])] < (float("inf") if i is None else i):
                gone[p : p + 13] = [True] * 13
        kept = [x for x, g in zip(w, gone) if not g]
        out.append((i, len(w), sum(gone), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return sorted(out, key=repr)


def _text(rng, n, of=300):
    return [f"w{rng.randrange(of)}" for _ in range(n)]


def _rows(odd):
    rng = random.Random(12)
    base = [_text(rng, n) for n in (400, 90, 30, 13, 12)]
    passage = _text(rng, 55)
    rows = [(100 + k, " ".join(w)) for k, w in enumerate(base)]
    rows += [(200 + k, " ".join(_text(rng, 20) + passage + _text(rng, 20))) for k in range(40)]
    rows += [(300 + k, " ".join(base[0][s : s + 13])) for k, s in enumerate(range(0, 380, 17))]
    rows += [(330 + k, " ".join(base[0][s : s + 12] + ["x"] + base[0][s + 13 : s + 40])) for k, s in enumerate(range(0, 300, 23))]
    # Runs and periods, as wholes and cut by other words.
    for k, n in enumerate((12, 13, 14, 40, 5000)):
        rows += [(400 + k, " ".join(["a"] * n)), (410 + k, " ".join(["x", *["a"] * n, "y"])), (420 + k, "a b " * n)]
        rows += [(430 + k, "a a b " * n + "c"), (440 + k, " ".join(_text(rng, 5) + ["a"] * n + _text(rng, 9, 3)))]
    rows += [(500 + k, " ".join(_text(rng, 60, 2))) for k in range(60)]
    rows += [(600, rows[0][1].replace(" ", "\n")), (601, rows[0][1]), (601, rows[0][1]), (50, rows[1][1]), (None, rows[0][1])]
    rows += [(None, rows[2][1]), (602, "　".join(base[1])), (603, "A" + rows[0][1]), (700, " ".join(_text(rng, 30_000)))]
    return rows + odd


@pytest.mark.parametrize("hot", [10_000, 5])
def test_equals_comparing_all_windows(spark, docs, odd, tmp_path, monkeypatch, hot):
    monkeypatch.setattr(r.looked_up, "__defaults__", (hot,))
    rows = _rows(odd)
    docs(rows).write.parquet(f"{tmp_path}/documents.parquet")
    found = op12_recompression(spark, str(tmp_path)).select(*COLUMNS).collect()
    assert sorted((tuple(x) for x in found), key=repr) == _brute(rows)


def test_a_full_filter_loses_nothing(spark, docs, odd, monkeypatch):
    """Where the filter lets everything through, and where texts meet spans by a shuffle."""
    monkeypatch.setattr(r, "FILTER", 64)
    monkeypatch.setattr(r, "PORTION", 500)
    monkeypatch.setattr("tidemark.llm.text.BROADCAST", -1)
    rows = _rows(odd)
    found = r.dedup(docs(rows)).select(*COLUMNS).collect()
    assert sorted((tuple(x) for x in found), key=repr) == _brute(rows)


def test_empty_table(spark, docs):
    assert r.dedup(docs([])).collect() == []


def test_equal_windows_are_filed_under_equal_words():
    rng = random.Random(3)
    for of in (1, 2, 5, 200):
        core = _text(rng, 60, of)
        texts = [" ".join(_text(rng, rng.randrange(9), of) + core[rng.randrange(20) :]).encode() for _ in range(60)]
        words = r.Words(texts)
        at, lo, hi = r.filed(words)
        assert ((at <= lo) & (hi <= at + 13)).all()
        names = [tuple(words.names[s : s + 13].ravel().tolist()) for s in at.tolist()]
        under = {}
        for w, a, b, s in zip(names, lo.tolist(), hi.tolist(), at.tolist()):
            assert under.setdefault(w, (a - s, b - s)) == (a - s, b - s)


def test_rounds_shorten_and_agree_inside():
    rng = random.Random(5)
    core = _text(rng, 400)
    one, two = ("x y z " + " ".join(core)).encode(), (" ".join(_text(rng, 11)) + " " + " ".join(core)).encode()
    words = r.Words([one, two])
    place, _, _ = r.cuts(words, 3)
    assert len(place) < 0.55 * len(words.names)
    inside = [set((place[(place > s + 20) & (place < e - 20)] - e).tolist()) for s, e in zip(words.starts, words.ends)]
    assert inside[0] == {x for x in inside[1] if x >= min(inside[0])} and len(inside[0]) > 100


def test_ranges_have_the_names_of_their_words():
    names = np.random.default_rng(1).integers(0, 2**63, (50, 2)).astype(np.uint64)
    twice = r.Ranges(np.concatenate([names, names[::-1], names]))
    start, end = np.array([3, 103, 0, 100, 3]), np.array([17, 117, 50, 150, 16])
    got = twice.names(start, end)
    assert (got[0] == got[1]).all() and (got[2] == got[3]).all() and (got[0] != got[4]).all()
