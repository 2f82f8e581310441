import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from tidemark.llm import prefix_trie, sequences
from tidemark.llm.queries import op13_prefix_trie

COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def _key(row):
    _, turn, role, text = row
    role, text = role or "", text or ""
    return (turn is not None, turn or 0, role, text)


def _brute(rows):
    """Every prefix of every rebuilt conversation, and every subtree, by walking."""
    by = defaultdict(list)
    for r in rows:
        by[r[0]].append(r)
    convs = {c: [(r[2] or "", r[3] or "") for r in sorted(rs, key=_key)] for c, rs in by.items()}
    built = {}
    for c, own in convs.items():
        h = zlib.crc32(("" if c is None else str(c)).encode()) % 6
        gift = [] if c is None else convs.get(c - c % 100, [])[:h]
        built[c] = tuple(gift + own[h:])
    members = defaultdict(list)
    for c, seq in built.items():
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
    least = {n: min((c for c in m if c is not None), default=None) for n, m in members.items()}
    out = []
    for n, m in members.items():
        under = [x for x in members if x[: len(n)] == n]
        childless = [x for x in under if not any(len(y) == len(x) + 1 and y[: len(x)] == x for y in members)]
        ends = sorted(c for c in m if c is not None and len(built[c]) == len(n))
        out.append(
            (
                least[n],
                len(n),
                least[n[:-1]] if n else None,
                len(m),
                sum(len(x) == len(n) + 1 for x in under),
                len(childless),
                sum((len(members[x]) - 1) * len(x[-1][1]) for x in under if x),
                hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
            )
        )
    return sorted(out, key=repr)


def _rows():
    rng = random.Random(13)
    rows = []
    for c in [*range(0, 40), *range(100, 140), 205, 207, 300, 301, 302]:
        shared = rng.randrange(4)
        for t in range(rng.randrange(1, 9)):
            text = f"t{t} of {shared}" if t < 4 else f"own {rng.randrange(3)}"
            rows.append((c, t, "user" if t % 2 == 0 else "assistant", text))
    rows += [(400, t, "user", f"long {t}") for t in range(75)]
    rows += [(401, t, "user", f"long {t}" if t < 40 else f"other {t}") for t in range(61)]
    rows += [(402, 0, "user", "é😀"), (403, 0, "user", "é😀")]
    rows += [(500, None, "user", "no turn"), (500, None, None, None), (500, 0, "user", ""), (500, 0, "user", "")]
    rows += [(None, 0, "user", "nobody"), (None, 1, None, "x"), (301, 1, "user", "tie"), (301, 1, "user", "tie")]
    rows += [(601, 0, "user", "x" * 20_000), (602, 1, "user", "")]
    return rows


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    def write(rows):
        path = str(tmp_path_factory.mktemp("trie"))
        schema = "conv_id long, turn long, role string, text string, depth int, name string, conv string, at int"
        full = [(*r, 5, "n", "c", 1) for r in rows]
        spark.createDataFrame(full, schema).write.parquet(f"{path}/conversations.parquet")
        return path

    return write


@pytest.mark.parametrize("hot", [sequences.HOT, 3])
def test_equals_walking_every_prefix(spark, folder, monkeypatch, hot):
    monkeypatch.setattr(prefix_trie.looked_up, "__defaults__", (hot,))
    rows = _rows()
    found = op13_prefix_trie(spark, folder(rows)).select(*COLUMNS).collect()
    assert sorted((tuple(r) for r in found), key=repr) == _brute(rows)


def test_empty_table(spark, folder):
    assert op13_prefix_trie(spark, folder([])).collect() == []
