import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest

from tidemark.llm import turn_repair as r
from tidemark.llm.queries import op11_turn_repair

COLUMNS = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
_BLANK = " \t\n\x0b\f\r"


def _damaged(rows):
    out = []
    for c, t, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        k = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if k == 0:
            continue
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        role = "user" if k == 4 else role
        out += [(c, t, role, text)] * (2 if k == 3 else 1)
    return out


def _cheapest(rows):
    """Dijkstra-like search over (rows done, state) with whole edit strings; rows are (role, text, fault)."""
    best = {(0, ""): (0, "", ())}
    for i in range(len(rows) + 1):
        for _ in range(3):  # inserts in front of row i
            for s in ("", "s", "u", "a"):
                if (i, s) not in best:
                    continue
                cost, audit, lines = best[i, s]
                to = "a" if s == "u" else "u"
                way = (cost + 2, audit + "I", lines + (("user:" if to == "u" else "assistant:"),))
                if (i, to) not in best or way[:2] < best[i, to][:2]:
                    best[i, to] = way
        if i == len(rows):
            break
        role, text, fault = rows[i]
        for s in ("", "s", "u", "a"):
            if (i, s) not in best:
                continue
            cost, audit, lines = best[i, s]
            ways = [(s, 3, "D", lines)]
            if fault not in ("blank", "duplicate"):
                more = int(fault == "truncated")
                to = "a" if s == "u" else "u"
                full = {"u": "user", "a": "assistant"}[to]
                if role[:1] == to:
                    ways.append((to, more, "K", lines + (f"{role}:{text}",)))
                ways.append((to, 2 + more, "R", lines + (f"{full}:{text}",)))
                if role[:1] == "s" and s == "":
                    ways.append(("s", more, "K", lines + (f"{role}:{text}",)))
            for to, more, edit, kept in ways:
                way = (cost + more, audit + edit, kept)
                if (i + 1, to) not in best or way[:2] < best[i + 1, to][:2]:
                    best[i + 1, to] = way
    return min((best[len(rows), s] for s in ("", "a") if (len(rows), s) in best), key=lambda w: w[:2])


def _brute(rows):
    by = defaultdict(list)
    for x in _damaged(rows):
        by[x[0]].append(x)
    out = []
    for c in {x[0] for x in rows}:
        own = sorted(by[c], key=lambda x: (x[1] is not None, x[1] or 0, x[2], x[3]))
        seen, judged = set(), []
        for _, _, role, text in own:
            core = text.rstrip(_BLANK)
            fault = "blank" if not core else "duplicate" if (role, text) in seen else "truncated" if core[-1] not in ".!?" else ""
            seen.add((role, text))
            judged.append((role, text, fault))
        turns = [t for _, t, _, _ in own if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        faults = [sum(f == k for _, _, f in judged) for k in ("blank", "duplicate", "truncated")]
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(judged))
        cost, audit, lines = _cheapest(judged)
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out.append((c, gaps, *faults, illegal, cost, audit, digest))
    return sorted(out, key=repr)


def _rows():
    rng = random.Random(11)
    says = ["Yes.", "No!", "open", "  ", "what?", "é😀.", "and\n\tso.\n"]
    rows = []
    for c in range(120):
        for t in range(rng.randrange(1, 11)):
            role = rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "", "sys"])
            rows.append((c, t * rng.choice([1, 1, 1, 2]), role, f"{rng.choice(says)}{'' if rng.random() < 0.2 else t}."))
    for c, n in ((200, 256), (201, 257), (202, 700), (203, 512), (204, 1500)):
        rows += [(c, t, "user" if t % 2 else "assistant", f"line {t}{rng.choice(['.', ''])}") for t in range(n)]
    rows += [(205, 3, "user", "same.")] * 600
    rows += [(300, None, "user", "a."), (300, None, None, None), (300, 5, "assistant", None), (None, 1, "user", "b."), (None, None, "x", "")]
    rows += [(301, 2, "user", "tie."), (301, 2, "assistant", "tie."), (301, 2, "user", "a tie."), (302, 1, "user", "x" * 20_000)]
    return rows


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    def write(rows):
        path = str(tmp_path_factory.mktemp("repair"))
        schema = "conv_id long, turn long, role string, text string, at int, seq string, conv string, blank int"
        spark.createDataFrame([(*x, 5, "n", "c", 1) for x in rows], schema).write.parquet(f"{path}/conversations.parquet")
        return path

    return write


@pytest.mark.parametrize("rules", [r.RULES, 5])
def test_equals_a_search_over_all_edits(spark, folder, monkeypatch, rules):
    monkeypatch.setattr(r, "RULES", rules)
    rows = _rows()
    found = op11_turn_repair(spark, folder(rows)).select(*COLUMNS).collect()
    assert sorted((tuple(x) for x in found), key=repr) == _brute(rows)


def test_empty_table(spark, folder):
    assert op11_turn_repair(spark, folder([])).collect() == []


def test_audits_are_the_least_of_all():
    """All edit strings of short sequences, tried one by one."""
    symbols = {r.symbol(i, f): (role, fault) for i, role in enumerate("sua-") for f, fault in enumerate(r._FAULTS)}
    known = r.terminals()
    rng = random.Random(2)
    for _ in range(300):
        seq = [rng.choice(list(symbols)) for _ in range(rng.randrange(0, 4))]
        best = None
        slots = [["".join(x) for k in range(3) for x in itertools.product("I", repeat=k)] for _ in range(len(seq) + 1)]
        for edits in itertools.product("DKR", repeat=len(seq)):
            for extra in itertools.product(*slots):
                audit = extra[0] + "".join(e + x for e, x in zip(edits, extra[1:]))
                state, cost, i, ok = "", 0, 0, True
                for e in audit:
                    to = "a" if state == "u" else "u"
                    if e == "I":
                        state, cost = to, cost + 2
                        continue
                    role, fault = symbols[seq[i]]
                    i += 1
                    if e == "D":
                        cost += 3
                        continue
                    cost += (fault == "truncated") + (2 if e == "R" else 0)
                    if e == "K":
                        to = role if role in "ua" else "s"
                        ok = ok and role != "-" and (state, to) in {("", "s"), ("", "u"), ("s", "u"), ("u", "a"), ("a", "u")}
                    ok = ok and fault not in ("blank", "duplicate")
                    state = to
                if ok and state in ("", "a"):
                    best = min(best or (cost, audit), (cost, audit))
        matrix = None
        for s in seq:
            matrix = r.product(matrix, known[s]) if matrix else known[s]
        cost, code = r.cheapest(matrix)
        assert (cost, code.translate(str.maketrans("JS", "IR"))) == best


def test_a_grammar_spells_its_sequences(spark):
    rng = random.Random(7)
    seqs = ["".join(rng.choice("EFI") for _ in range(rng.randrange(1, 200))) for _ in range(40)] + ["E" * 256]
    found, rules = r.grammar(spark.createDataFrame([(s, 1) for s in set(seqs)], "seq string, n long"))
    parts = {new: left + right for new, left, right in rules}

    def spelled(text):
        while any(c in parts for c in text):
            text = "".join(parts.get(c, c) for c in text)
        return text

    for row in found.collect():
        assert spelled(row["rest"]) == row["seq"] and (len(row["seq"]) < 100 or len(row["rest"]) < len(row["seq"]) / 3)
