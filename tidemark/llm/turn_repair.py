"""Repair of conversations' structure by a grammar-compressed dynamic program.

A row of a conversation is a symbol: its role (system, user, assistant, another) and its first
fault (none, blank, duplicate, truncated).  The cheapest edits that make the roles
read ``(s?(ua)+)?`` are a shortest path through four states (nothing yet, after a system
turn, after a user's, after an assistant's).  For a sequence of symbols the path is a
min-plus *transfer matrix*: for each state before it and after it the least cost, and the
edits that reach it as a rope (a tree of strings that shares its parts).  Among equal
costs the ASCII-least edits win; two equally dear ways between the same states
over the same rows never begin one with the other, so this choice may be made part by part.

Grammar.  Sequences are cut into blocks of BLOCK rows and equal blocks are kept once.
Re-Pair replaces frequent pairs of neighbouring symbols by new symbols, round after round:
each round counts all pairs in Spark, takes the most frequent ones that can't overlap
(those with an EIGHTH of the top count or more) and replaces them everywhere, until no pair
repeats or there are RULES rules.  Each rule's matrix is the product of its two
parts', made once, bottom-up.  A block's matrix is the product of the few symbols that are left,
whatever their number, so a full dictionary costs time and not results.  Blocks of longer
conversations are paired again, and again, by name: a pair that several conversations share is
one rule of that level.

Skew.  Rows are numbered by ``functions.ordering``, which splits a conversation of any
length over tasks; blocks are bounded; frequent blocks are looked up by broadcast.
The repaired rows of a conversation stream through one task, in order and never held
together, since its digest takes one byte after the other.

Edits: K keep (0), R change of role to user or assistant (2), D delete (3; always for
blank and duplicate rows), I insert an empty turn of user or assistant (2); a truncated row
that is kept adds 1.

Defined results: a null role or text is one space (so the row is blank, or of another role);
rows of equal or null turn are ordered by role, the first 32 characters and the SHA-256 of role and
text, nulls first; repeated rows are duplicates.  A null conv_id is a conversation.  A role
counts by its first character; an empty role has none and is another role.  A
conversation without rows has zeros, no edits and the digest of an empty string.  An
empty table gives an empty result.  Further columns are not read.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.ordering import with_position
from tidemark.functions.staging import stage
from tidemark.llm import sequences
from tidemark.llm.sequences import given_id, known_id, looked_up, name_of, sorted_sha256
from tidemark.llm.text import BLANKS

#: Rows of a block, rules of the grammar, new rules of a round.
BLOCK, RULES, ROUND = 256, 1024, 64
EIGHTH = 8
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
_NOTHING = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"  # of an empty string
_ROLES, _FAULTS = "sua-", ("none", "blank", "duplicate", "truncated")
_LEGAL = ("su", "ua", "au")
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
_STATES = range(4)
#: Rows of a transfer matrix as Spark keeps them.
_CELLS = "array<struct<i int, j int, cost long, code string>>"

# Inside, an edit is one of D, I and J (insert user, assistant), K, R and S (role to user, assistant).
Rope = str | tuple
Matrix = dict[tuple[int, int], tuple[int, Rope]]


# --- transfer matrices -------------------------------------------------------------


def flat(rope: Rope) -> str:
    out, open_ = [], [rope]
    while open_:
        r = open_.pop()
        if isinstance(r, str):
            out.append(r)
        else:
            open_ += (r[1], r[0])
    return "".join(out)


def _better(a: tuple[int, Rope], b: tuple[int, Rope] | None) -> bool:
    return b is None or a[0] < b[0] or (a[0] == b[0] and flat(a[1]) < flat(b[1]))


def product(left: Matrix, right: Matrix) -> Matrix:
    """The cheapest ways through ``left`` and then ``right``."""
    out: Matrix = {}
    for (i, k), (cost, rope) in left.items():
        for j in _STATES:
            if (k, j) in right:
                more, end = right[k, j]
                way = (cost + more, (rope, end) if rope and end else rope or end)
                if _better(way, out.get((i, j))):
                    out[i, j] = way
    return out


def inserts() -> Matrix:
    """Any turns inserted between two rows."""
    ways: Matrix = {(s, s): (0, "") for s in _STATES}
    for s in (_START, _SYSTEM, _ASSISTANT):
        ways[s, _USER] = (INSERT, "I")
    ways[_USER, _ASSISTANT] = (INSERT, "J")
    for s in (_START, _SYSTEM):
        ways[s, _ASSISTANT] = (2 * INSERT, "IJ")
    return ways


def _edit(role: str, fault: str) -> Matrix:
    """One row's edits."""
    ways: Matrix = {(s, s): (DELETE, "D") for s in _STATES}
    if fault in ("blank", "duplicate"):
        return ways
    more = TRUNCATED if fault == "truncated" else 0
    for s in (_START, _SYSTEM, _ASSISTANT):
        cost, edit = (KEEP, "K") if role == "u" else (REROLE, "R")
        ways[s, _USER] = (cost + more, edit)
    cost, edit = (KEEP, "K") if role == "a" else (REROLE, "S")
    ways[_USER, _ASSISTANT] = (cost + more, edit)
    if role == "s":
        ways[_START, _SYSTEM] = (KEEP + more, "K")
    return ways


def symbol(role: int, fault: int) -> str:
    return chr(ord("A") + len(_FAULTS) * role + fault)


def terminals() -> dict[str, Matrix]:
    before = inserts()
    return {
        symbol(r, f): product(before, _edit(role, fault))
        for r, role in enumerate(_ROLES)
        for f, fault in enumerate(_FAULTS)
    }


def matrices(rules: list[tuple[str, str, str]]) -> dict[str, Matrix]:
    """Of all symbols, the rules (symbol, left, right) in the order in which they were made."""
    known = terminals()
    for new, left, right in rules:
        known[new] = product(known[left], known[right])
    return known


def cheapest(matrix: Matrix | None) -> tuple[int, str]:
    """Cost and edits of a whole conversation."""
    ends = product(matrix, inserts()) if matrix else inserts()
    best = None
    for end in (_START, _ASSISTANT):
        way = ends.get((_START, end))
        if way and _better(way, best):
            best = way
    return best[0], flat(best[1])


def _rows_of(matrix: Matrix) -> list[dict]:
    return [{"i": i, "j": j, "cost": c, "code": flat(r)} for (i, j), (c, r) in matrix.items()]


def _matrix_of(rows: list[dict]) -> Matrix:
    return {(r["i"], r["j"]): (r["cost"], r["code"]) for r in rows}


# --- rows and blocks ---------------------------------------------------------------


def _initial(role: Column) -> Column:
    first = F.substring(role, 1, 1)
    return F.when(first.isin(*_ROLES[:3]), first).otherwise(_ROLES[3])


def _read(rows: DataFrame) -> DataFrame:
    """Rows with what orders them; no column is null but ``turn``."""
    spoken = [F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")]
    read = rows.select(known_id(F.col("conv_id")).alias("conv"), F.col("turn").cast("long").alias("turn"), *spoken)
    return read.withColumn("said", sequences.said(F.col("role"), F.col("text")))


def faults(rows: DataFrame) -> DataFrame:
    """(conv, at, turn, role, fault): rows numbered from 1 in each conversation, with initials."""
    inner = F.rtrim(F.col("text"), F.lit(BLANKS))
    light = _read(rows).select(
        "conv",
        "turn",
        "role",
        "said",
        F.substring("text", 1, sequences.HEAD).alias("head"),
        (F.btrim("text", F.lit(BLANKS)) == "").alias("blank"),
        (~F.right(inner, F.lit(1)).isin(".", "!", "?")).alias("cut"),
        F.monotonically_increasing_id().alias("copy"),
    )
    order = [*sequences.turn_order("turn", "role", F.col("head"), "said"), F.col("copy")]
    placed = stage(with_position(light, order, "at", ["conv"]).drop("head", "copy"), "placed")
    first = placed.groupBy("conv", "said").agg(F.min("at").alias("at")).select("conv", "at", F.lit(True).alias("first"))
    fault = F.when(F.col("blank"), 1).when(F.col("first").isNull(), 2).when(F.col("cut"), 3).otherwise(0)
    judged = placed.join(first, ["conv", "at"], "left")
    return judged.select("conv", "at", "turn", _initial(F.col("role")).alias("role"), fault.alias("fault"))


def _counts(judged: DataFrame) -> DataFrame:
    """Counts of each conversation; its rows are first added up by turn."""
    fault = [F.sum((F.col("fault") == k).cast("long")).alias(n) for k, n in enumerate(_FAULTS) if k]
    turns = judged.groupBy("conv", "turn").agg(*fault)
    span = F.max("turn") - F.min("turn") + 1 - F.count("turn")
    return turns.groupBy("conv").agg(F.coalesce(span, F.lit(0)).alias("gaps"), *[F.sum(n).alias(n) for n in _FAULTS[1:]])


def _blocks(judged: DataFrame) -> DataFrame:
    """(conv, block, seq, illegal): symbols of up to BLOCK rows; borders count in the later block."""
    code = F.array(*[F.lit(symbol(r, f)) for r in range(len(_ROLES)) for f in range(len(_FAULTS))])
    place = F.instr(F.lit(_ROLES), F.col("role")) - 1
    sign = F.get(code, (place * len(_FAULTS) + F.col("fault")).cast("int"))
    block = F.floor((F.col("at") - 1) / BLOCK).cast("long")
    rows = judged.select("conv", block.alias("block"), "at", sign.alias("sign"), "role", F.lit(True).alias("own"))
    ends = rows.where(F.col("at") % BLOCK == 0).withColumns({"block": F.col("block") + 1, "own": F.lit(False)})
    held = F.array_sort(F.collect_list(F.struct("at", "sign", "role", "own"))).alias("held")
    every = rows.unionByName(ends).groupBy("conv", "block").agg(held).where(F.exists("held", lambda x: x["own"]))
    h = F.col("held")
    bad = F.filter(h, lambda x, i: (i > 0) & ~F.concat(F.get(h, i - 1)["role"], x["role"]).isin(*_LEGAL))
    seq = F.array_join(F.transform(F.filter(h, lambda x: x["own"]), lambda x: x["sign"]), "")
    return every.select("conv", "block", seq.alias("seq"), F.size(bad).cast("long").alias("illegal"))


# --- grammar -------------------------------------------------------------------------


def chosen(pairs: list[str], counts: list[int]) -> list[str]:
    """The most frequent pairs of which no two can overlap in a text; counts fall."""
    lefts, rights, out = set(), set(), []
    for pair, count in zip(pairs, counts):
        a, b = pair
        if count * EIGHTH < counts[0] or a in rights or b in lefts or (a == b and (a in lefts or b in rights)):
            continue
        lefts.add(a)
        rights.add(b)
        out.append(pair)
    return out


def grammar(seqs: DataFrame) -> tuple[DataFrame, list[tuple[str, str, str]]]:
    """``seqs`` (seq, …) with ``rest``, what Re-Pair leaves of each, and the rules."""
    rules: list[tuple[str, str, str]] = []
    seqs = stage(seqs.withColumn("rest", F.col("seq")), "grammar")
    rest = F.col("rest")
    pair = F.transform(F.sequence(F.lit(1), F.length(rest) - 1), lambda i: F.substring(rest, i, F.lit(2)))
    while len(rules) < RULES:
        found = seqs.where(F.length(rest) > 1).select(F.explode(pair).alias("pair")).groupBy("pair").count()
        top = found.where("count > 1").orderBy(F.desc("count"), "pair").limit(ROUND).collect()
        picked = chosen([r["pair"] for r in top], [r["count"] for r in top])[: RULES - len(rules)]
        if not picked:
            break
        shorter = rest
        for p in picked:
            new = chr(0x100 + len(rules))
            rules.append((new, *p))
            shorter = F.replace(shorter, F.lit(p), F.lit(new))
        seqs = stage(seqs.withColumn("rest", shorter), "grammar")
    return seqs, rules


def _evaluated(seqs: DataFrame, rules: list[tuple[str, str, str]]) -> DataFrame:
    """``seqs`` with the matrix of each sequence, and its cost and edits if it is a whole conversation."""
    keep = ["seq", "n"]
    known = matrices(rules)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [functools.reduce(product, [known[s] for s in rest]) for rest in batch.column("rest").to_pylist()]
            yield _results(batch, keep, found)

    return seqs.mapInArrow(run, f"seq string, n long, cells {_CELLS}, cost long, code string")


def _results(batch: pa.RecordBatch, keep: list[str], found: list[Matrix]) -> pa.RecordBatch:
    kind = pa.list_(pa.struct([("i", pa.int32()), ("j", pa.int32()), ("cost", pa.int64()), ("code", pa.string())]))
    ends = [cheapest(m) for m in found]
    columns = [batch.column(c) for c in keep]
    columns += [pa.array([_rows_of(m) for m in found], kind)]
    columns += [pa.array([c for c, _ in ends], pa.int64()), pa.array([e for _, e in ends], pa.string())]
    return pa.RecordBatch.from_arrays(columns, [*keep, "cells", "cost", "code"])


def _composed(pairs: DataFrame) -> DataFrame:
    """(sym, left_cells, right_cells or null) to (sym, cells, cost, code)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = zip(batch.column("left_cells").to_pylist(), batch.column("right_cells").to_pylist())
            found = [product(_matrix_of(a), _matrix_of(b)) if b else _matrix_of(a) for a, b in sides]
            yield _results(batch, ["sym"], found)

    return pairs.mapInArrow(run, f"sym binary, cells {_CELLS}, cost long, code string")


def _long(blocks: DataFrame, seqs: DataFrame) -> DataFrame:
    """(conv, cost, code) of conversations of several blocks: neighbours are joined level by level."""
    now = stage(blocks.select("conv", "block", name_of(F.col("seq")).alias("sym"), "seq"), "level")
    used = now.select("seq", "sym").distinct()
    known = used.join(seqs, "seq").select("sym", "cells", "cost", "code")
    now, last = now.drop("seq"), now.agg(F.max("block")).first()[0]
    while last:
        held = F.array_sort(F.collect_list(F.struct("block", "sym")))
        both = now.groupBy("conv", F.shiftright("block", 1).alias("block")).agg(held.alias("p"))
        left, right = F.col("p")[0]["sym"], F.get("p", F.lit(1))["sym"]
        sym = F.when(right.isNull(), left).otherwise(name_of(left, right))
        now = stage(both.select("conv", "block", left.alias("l"), right.alias("r"), sym.alias("sym")), "level")
        parts = now.select("l", "r", "sym").distinct()
        parts = parts.join(known.select(F.col("sym").alias("l"), F.col("cells").alias("left_cells")), "l")
        parts = parts.join(known.select(F.col("sym").alias("r"), F.col("cells").alias("right_cells")), "r", "left")
        known = stage(_composed(parts.select("sym", "left_cells", "right_cells")), "level")
        now, last = now.select("conv", "block", "sym"), last >> 1
    return now.join(known, "sym").select("conv", "cost", "code")


def repairs(rows: DataFrame) -> DataFrame:
    """(conv, gaps, blank, duplicate, truncated, illegal, cost, code) of every conversation that has rows."""
    judged = stage(faults(rows), "faults")
    blocks = stage(_blocks(judged), "blocks")
    distinct = blocks.groupBy("seq").agg(F.count(F.lit(1)).alias("n"))
    seqs = stage(_evaluated(*grammar(distinct)), "matrices")
    many = (F.col("block") > 0) | (F.length("seq") == BLOCK)
    short = looked_up(blocks.where(~many), seqs.select("seq", "n", "cost", "code"), ["seq"], "n")
    ways = short.select("conv", "cost", "code").unionByName(_long(blocks.where(many), seqs))
    illegal = blocks.groupBy("conv").agg(F.sum("illegal").alias("illegal"))
    return _counts(judged).join(illegal, "conv").join(ways, "conv")


def repaired(rows: DataFrame, ways: DataFrame) -> DataFrame:
    """The repaired rows (conv, step, edit, turn, role, text), each conversation's together and in order.

    ``edit`` is K, R or I; ``turn`` is that of the row, null for an inserted one.
    """
    order = ["conv", "kind", F.col("turn").asc_nulls_first(), "role", "head", "said"]
    none = {c: F.lit(None).cast(t) for c, t in (("turn", "long"), ("role", "string"), ("said", "binary"))}
    heads = ways.select("conv", F.lit(0).alias("kind"), F.col("code").alias("text"), F.lit("").alias("head"))
    texts = _read(rows).withColumns({"kind": F.lit(1), "head": F.substring("text", 1, sequences.HEAD)})
    every = heads.withColumns(none).unionByName(texts).repartition("conv").sortWithinPartitions(*order)
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string()]
    names = ["conv", "step", "edit", "turn", "role", "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, code, at, step = None, "", 0, 0
        out: list[tuple] = []

        def put(edit: str, turn: int | None, role: str, text: str) -> None:
            nonlocal step
            out.append((conv, step, edit, turn, role, text))
            step += 1

        def inserted() -> None:
            nonlocal at
            while at < len(code) and code[at] in "IJ":
                put("I", None, "user" if code[at] == "I" else "assistant", "")
                at += 1

        def batch_of() -> pa.RecordBatch:
            columns = [pa.array([r[k] for r in out], kind) for k, kind in enumerate(kinds)]
            out.clear()
            return pa.RecordBatch.from_arrays(columns, names)

        for batch in batches:
            for c, kind, turn, role, text in zip(*[column.to_pylist() for column in batch.columns]):
                if kind == 0:
                    inserted()
                    conv, code, at, step = c, text, 0, 0
                    continue
                inserted()
                edit = code[at]
                at += 1
                if edit == "K":
                    put("K", turn, role, text)
                elif edit in "RS":
                    put("R", turn, "user" if edit == "R" else "assistant", text)
            yield batch_of()
        inserted()
        yield batch_of()

    schema = "conv long, step long, edit string, turn long, role string, text string"
    return every.select("conv", "kind", "turn", "role", "text").mapInArrow(run, schema)


def repair(rows: DataFrame, conversations: DataFrame) -> DataFrame:
    """One row for each conv_id of ``conversations``: faults of ``rows``, cheapest edits, digest of the result."""
    ways = stage(repairs(rows), "ways")
    line = F.concat("role", F.lit(":"), "text")
    digests = sorted_sha256(repaired(rows, ways).withColumn("line", line), "conv", "line", "\n")
    convs = conversations.select(known_id(F.col("conv_id")).alias("conv")).distinct()
    found = convs.join(ways, "conv", "left").join(digests, "conv", "left")
    numbers = ("gaps", *_FAULTS[1:], "illegal", "cost")
    return found.select(
        given_id(F.col("conv")).alias("conv_id"),
        *[F.coalesce(n, F.lit(0).cast("long")).alias(n) for n in numbers],
        F.translate(F.coalesce("code", F.lit("")), "JS", "IR").alias("audit"),
        F.coalesce("sha256", F.lit(_NOTHING)).alias("repaired_sha256"),
    )
