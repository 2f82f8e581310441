import hashlib
import random

import numpy as np
import pytest

from tidemark.llm import suffix_dedup as s
from tidemark.llm.queries import op4_suffix_dedup


def _brute(rows):
    """Rows in order; equal rows one after the other."""
    seen, out = set(), []
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    for i, t in order:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - 99):
            w = b[p : p + 100]
            if w in seen:
                gone[p : p + 100] = b"\1" * 100
            seen.add(w)
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1]))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def _result(df):
    return [(r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in df.collect()]


def _text(rng, n):
    return "".join(rng.choice("abcdefgh é\n") for _ in range(n))


def _rows():
    rng = random.Random(4)
    base = [_text(rng, 700) for _ in range(4)]
    line = _text(rng, 70)
    rows = [(k, t) for k, t in enumerate(base)]
    rows += [(10, base[0]), (11, base[1][:350] + "X" + base[1][351:]), (12, base[2][100:260]), (13, base[2][100:199])]
    rows += [(14, "a" * 500), (15, "ab" * 300), (16, base[3] + base[3][50:300]), (17, _text(rng, 99)), (18, "")]
    rows += [(20 + k, _text(rng, 90) + line + _text(rng, 90)) for k in range(30)]
    rows += [(60, base[0][:150] + base[1][:150]), (61, base[0][20:150] + base[1][:130])]
    rows += [(None, base[3]), (62, None), (63, base[2]), (63, base[2]), (64, "x" * 10), (64, "x" * 10)]
    return rows


@pytest.mark.parametrize("hot,batch", [(10_000, 2 << 20), (5, 2000)])
def test_against_brute_force(spark, docs, monkeypatch, hot, batch):
    monkeypatch.setattr(s, "HOT", hot)
    monkeypatch.setattr(s, "BATCH", batch)
    rows = _rows()
    got = _result(s.dedup(docs(rows)))
    assert sorted(map(repr, got)) == sorted(map(repr, _brute(rows)))


def test_repeated_rows_keep_one_text(spark, docs):
    rng = random.Random(9)
    once, cut = _text(rng, 400), _text(rng, 400)
    rows = [(1, once), (1, once), (1, once), (None, cut), (None, cut), (2, cut[:150] + _text(rng, 200))]
    got = _result(s.dedup(docs(rows)))
    assert sorted(map(repr, got)) == sorted(map(repr, _brute(rows)))
    assert sorted(r[2] for r in got if r[0] == 1)[0] == 0


def test_no_documents(spark, docs):
    assert s.dedup(docs([])).count() == 0


def test_suffix_order():
    rng = random.Random(1)
    for _ in range(150):
        n, size = rng.choice([0, 1, 2, 9, 300]), rng.choice([1, 2, 26])
        data = np.array([rng.randrange(size) + rng.choice([0, 200]) for _ in range(n)], np.uint8)
        b = data.tobytes()
        want = sorted(range(n + 1), key=lambda i: b[i:])
        got = s.suffix_order(data, 100)
        assert [b[i : i + 100] for i in got] == [b[i : i + 100] for i in want]
        assert sorted(got.tolist()) == list(range(n + 1))


def test_long_text_in_slices(monkeypatch):
    rng = random.Random(2)
    text = _text(rng, 5000).encode()
    monkeypatch.setattr(s, "SLICE", 1000)
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"__doc": [1], "__th": [2], "__text": [text]})
    parts = list(s._texts(iter([batch])))
    windows = [text[p : p + 100] for p in range(len(text) - 99)]
    got = [part[3][k : k + 100] for part in parts for k in range(len(part[3]) - 99)]
    assert got == windows


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    assert sorted(_result(op4_suffix_dedup(spark, folder))) == sorted(_brute(rows))


def _places(text, doc, step=1 << 20):
    """Anchors of one text as pieces of the kind that tasks send."""
    data = np.frombuffer(text, np.uint8)
    for at in range(0, len(data) - 99, step):
        part = data[at : at + step + 99]
        a = s.anchors(part, np.array([len(part)]))
        n = len(a["h"])
        same = {"doc": np.full(n, doc), "th": np.full(n, 7)}
        yield {"h": a["h"], "c": a["c"], **same, "lo": a["lo"] + at, "ahead": a["at"] - a["lo"], "more": a["hi"] - a["lo"]}


@pytest.mark.parametrize("unit", [b"a", b"abcdefg"])
def test_long_runs_are_few_places(unit):
    """Only the first place of each context leaves a slice, however many a run has."""
    text = unit * (1_000_000 // len(unit))
    (piece,) = _places(text, 1, 2 << 20)
    kept, gone = s.firsts(piece)
    assert len(piece["h"]) > 100_000 and len(kept["h"]) <= 3
    assert len(kept["h"]) + len(gone["h"]) == len(piece["h"])


def test_places_held_do_not_grow_with_copies(monkeypatch):
    """A text in every piece, and an anchor with ever new contexts."""
    rng = np.random.default_rng(3)
    text = bytes(rng.integers(97, 123, 5000, dtype=np.uint8))
    (copy,) = _places(text, 0)
    sizes = []
    real = s.firsts
    monkeypatch.setattr(s, "firsts", lambda p: sizes.append(len(p["h"])) or real(p))

    def pieces():
        for doc in range(1, 400):
            n = 50
            fresh = {"h": np.full(n, 5, np.uint64), "c": rng.integers(0, 2**63, n).astype(np.uint64)}
            fresh |= {k: np.full(n, v) for k, v in {"doc": doc, "th": 1, "ahead": 0, "more": 0}.items()}
            fresh["lo"] = np.arange(n)
            mine = copy | {"doc": np.full(len(copy["h"]), doc)}
            yield {k: np.concatenate([mine[k], fresh[k]]) for k in copy}

    found = {"gone": 0, "windows": 0, "edge": 0}
    for places, what in s.settled(pieces(), 100, 1000):
        found[what] += len(places["h"])
    assert max(sizes) < 1000 + 2 * len(copy["h"]) + 200
    assert found == {"gone": 398 * len(copy["h"]), "windows": 399 * 50, "edge": 0}


def test_equal_windows_are_thinned():
    windows = [b"x" * 100, b"y" * 100, b"x" * 100, b"x" * 100, b"\0" * 100]
    doc, th, lo = np.array([5, 1, 2, 2, 9]), np.zeros(5, np.int64), np.zeros(5, np.int64)
    first, again = s.thinned(doc, th, lo, np.frombuffer(b"".join(windows), np.uint8))
    # The fourth is the third again: one place.
    assert sorted(first.tolist()) == [1, 2, 4] and again.tolist() == [0]


@pytest.mark.parametrize("hot,batch,fold", [(10_000, 2 << 20, 500_000), (5, 2000, 40)])
def test_skew_against_brute_force(spark, docs, monkeypatch, hot, batch, fold):
    """Long runs, and a passage that a third of the documents hold in different surroundings."""
    for name, value in (("HOT", hot), ("BATCH", batch), ("FOLD", fold)):
        monkeypatch.setattr(s, name, value)
    rng = random.Random(6)
    passage = _text(rng, 150)
    rows = [(k, _text(rng, 120) + (passage if k % 3 == 0 else "") + _text(rng, 120)) for k in range(150)]
    rows += [(200, "a" * 20_000), (201, "abcdefg" * 2_000), (202, "b" + "a" * 3_000), (203, rows[0][1]), (203, rows[0][1])]
    got = _result(s.dedup(docs(rows)))
    assert sorted(map(repr, got)) == sorted(map(repr, _brute(rows)))
