"""Chat formatting: roles of transcript lines by a hidden Markov model, then canonical turns.

A transcript is text whose lines may begin with a speaker marker or not, in one row or cut
into numbered rows at line ends.  Each line is one symbol: kind of marker, size, end, capital.
Hidden states are (role, first line of a turn or not).  Where rows end says nothing about
turns, unless ``rows_are_turns`` adds the first line of a row to the symbol.  Start,
transition and emission counts come from all labelled lines; the model is some thousand numbers.

Decoding is exact Viterbi, and no task needs a whole conversation.  Rows are sorted over
ranges of (conversation, number) and those that follow each other are packed in chunks; a
conversation that is one chunk, as most are, is decoded alone.  Otherwise the best way through
a chunk from each state to each state is a small matrix.  Matrices are joined for each range, then
over the ranges, the best states at the borders are found from there down, and each chunk
is decoded between its own.  The chunks of an Arrow batch step together as arrays.

Defined results: null texts are empty and have one empty line; a null row number
comes first; rows of equal number are ordered by a hash of the text; a null conversation is a
conversation; lines of roles other than the model's are not counted.  Of equally probable ways
one is taken.  Turns count from 1; a way that begins inside a turn has a turn 0.  A marker is left out
where a turn begins with it.  An empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.ordering import with_running_totals
from tidemark.functions.staging import stage
from tidemark.llm.text import checked, whole

ROLES = ("system", "user", "assistant")
#: Words that name a speaker, per role (fixed values).
MARKERS = {
    "system": ("system", "instructions", "context"),
    "user": ("user", "human", "question", "q", "you", "customer"),
    "assistant": ("assistant", "ai", "bot", "answer", "a", "model"),
}
STATES = [(role, first) for role in ROLES for first in (True, False)]
#: A chunk is closed beyond so many lines or characters; rows are not cut.
LINES, CHARACTERS = 1_024, 1 << 18
#: Characters of an output batch.
BATCH = 4 << 20
#: Values of the features of a symbol: marker, size, end, capital, row.
FEATURES = (4, 4, 3, 2, 2)
N_SYMBOLS = 4 * 4 * 3 * 2 * 2
#: Stand for the state before a chunk: start of the conversation, not known to the task, no label.
START, EDGE, NONE = -1, -2, 255

_WORDS = "|".join("(" + "|".join(MARKERS[r]) + ")" for r in ROLES)
MARKER = re.compile(rf"[\s#*>\[<|-]*(?:{_WORDS})[\]>*|]*\s*[:>|\]]+\s*", re.IGNORECASE | re.ASCII)


def symbol(line: str, first: bool = False) -> int:
    """``first``: the line begins a row that is known to be a turn."""
    found = MARKER.match(line)
    body = (line[found.end() :] if found else line).strip()
    size = 0 if not body else 1 if len(body) < 40 else 2 if len(body) < 160 else 3
    end = 2 if body.endswith("?") else 1 if body.endswith((".", "!")) else 0
    out = ((found.lastindex if found else 0) * 4 + size) * 3 + end
    return (out * 2 + body[:1].isupper()) * 2 + first


def pack(
    df: DataFrame, conversation: str = "conv_id", number: str = "turn", text: str = "text", role: str | None = None,
    rows_are_turns: bool = False,
) -> DataFrame:
    """(conv, id, open, edge, before, text, symbols, labels): chunks of rows in order, a byte for each line.

    ``id``: range of the sort, then 33 bits in it; ids of a conversation are in order.  ``open``:
    there may be other chunks of the conversation.  ``edge``: first or last chunk of its range.
    With ``role`` every row is one labelled turn; ``before`` is the label of the line before the chunk.
    """
    label = F.col(f"`{role}`").cast("string") if role else F.lit(None).cast("string")
    rows = df.select(
        F.col(f"`{conversation}`").alias("conv"), F.col(f"`{number}`").cast("long").alias("number"),
        whole(F.col(f"`{text}`")).alias("text"), label.alias("role"),
    )
    rows = rows.withColumns({"sort": F.xxhash64("text"), "row": F.monotonically_increasing_id()})
    # The last key lets any number of equal rows be dealt to several ranges.
    keys = [F.col("conv").asc_nulls_first(), F.col("number").asc_nulls_first(), F.col("sort"), F.col("row")]
    ranged = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).select("conv", "text", "role")
    schema = T.StructType([ranged.schema["conv"]]).add("id", "long").add("open", "boolean").add("edge", "boolean")
    schema = schema.add("before", "integer").add("text", "string").add("symbols", "binary").add("labels", "binary")
    codes = {name: 2 * k for k, name in enumerate(ROLES)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 33
        done: list[list] = []  # chunks, of which the last one may still change
        held, n, size = 0, 0, 0
        conv, texts, symbols, labels, before, several = None, [], bytearray(), bytearray(), EDGE, False
        kinds = None

        def close(more: bool) -> None:
            """The chunk ends; ``more``: the conversation goes on."""
            nonlocal n, size, held, several, texts, symbols, labels, before
            alone = not (more or several or n == 0)
            done.append([conv, base + n, not alone, n == 0, before, "\n".join(texts), bytes(symbols), bytes(labels)])
            held += size
            before, several = (labels[-1], True) if more else (START, False)
            n, size, texts, symbols, labels = n + 1, 0, [], bytearray(), bytearray()

        def flush(keep: int) -> pa.RecordBatch:
            nonlocal held
            out, done[:] = done[: len(done) - keep], done[len(done) - keep :]
            held = 0
            types = [kinds, pa.int64(), pa.bool_(), pa.bool_(), pa.int32(), pa.string(), pa.binary(), pa.binary()]
            columns = [pa.array([r[k] for r in out], t) for k, t in enumerate(types)]
            return pa.RecordBatch.from_arrays(columns, schema.names)

        for batch in batches:
            kinds = batch.schema.field(0).type
            for c, x, r in zip(*(batch.column(k).to_pylist() for k in range(3))):
                if texts:
                    if c != conv:
                        close(False)
                    elif len(symbols) >= LINES or size >= CHARACTERS:
                        close(True)
                    if held >= BATCH:
                        yield flush(1)
                conv = c
                parts = x.split("\n")
                texts.append(x)
                size += len(x) + 1
                symbols.append(symbol(parts[0], rows_are_turns))
                symbols.extend(map(symbol, parts[1:]))
                code = codes.get(r, NONE)
                labels.append(code)
                labels.extend([code if code == NONE else code + 1] * (len(parts) - 1))
        if texts:
            close(False)
            # What follows in the next range isn't known here.
            done[-1][2] = done[-1][3] = True
            yield flush(0)

    return stage(ranged.mapInArrow(run, schema), "chunks")


@dataclass(frozen=True)
class Model:
    """Log probabilities."""

    start: tuple[float, ...]
    step: tuple[tuple[float, ...], ...]
    emit: tuple[tuple[float, ...], ...]

    def arrays(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return np.array(self.start), np.array(self.step), np.array(self.emit)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(what, a, b, n) of a task's chunks; what: 0 start, 1 transition, 2 emission."""
    width = NONE + 1
    start, step, emit = np.zeros(width, int), np.zeros((width, width), int), np.zeros((width, N_SYMBOLS), int)
    for batch in batches:
        for before, symbols, labels in zip(*(c.to_pylist() for c in batch.columns)):
            of, seen = np.frombuffer(labels, np.uint8), np.frombuffer(symbols, np.uint8)
            np.add.at(emit, (of, seen), 1)
            np.add.at(step, (of[:-1], of[1:]), 1)
            if before == START:
                start[of[0]] += 1
            elif before != EDGE:
                step[before, of[0]] += 1
    tables = [start[: len(STATES), None], step[: len(STATES), : len(STATES)], emit[: len(STATES)]]
    rows = [(k, a, b, int(t[a, b])) for k, t in enumerate(tables) for a, b in zip(*map(np.ndarray.tolist, t.nonzero()))]
    columns = list(zip(*rows)) if rows else [[]] * 4
    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["what", "a", "b", "n"])


def smoothed(emit: np.ndarray, smooth: float) -> np.ndarray:
    """Counts of symbols, and 16 ``smooth`` more dealt as if a state's features were independent."""
    seen = emit.reshape(len(emit), *FEATURES)
    guess = np.ones_like(seen)
    for axis in range(1, seen.ndim):
        others = tuple(k for k in range(1, seen.ndim) if k != axis)
        own = seen.sum(axis=others, keepdims=True) + smooth
        guess = guess * (own / own.sum(axis=axis, keepdims=True))
    return emit + 16 * smooth * guess.reshape(emit.shape)


def train(chunks: DataFrame, smooth: float = 0.5) -> Model:
    """``chunks``: labelled ones of whole conversations."""
    n = len(STATES)
    start, step, emit = np.full(n, 1e-9), np.full((n, n), 1e-9), np.zeros((n, N_SYMBOLS))
    for a in range(n):
        step[a, a // 2 * 2 + 1] += smooth
        step[a, ::2] += smooth
    start[::2] += smooth
    counted = chunks.select("before", "symbols", "labels").mapInArrow(_counts, "what long, a long, b long, n long")
    # At most 6 x (1 + 6 + N_SYMBOLS) rows.
    for what, a, b, times in counted.groupBy("what", "a", "b").agg(F.sum("n")).collect():
        if what == 0:
            start[a] += times
        else:
            (step if what == 1 else emit)[a, b] += times
    # The first chunk of a range doesn't know the line before it: two rows a range at most.
    at = lambda place: F.conv(F.hex(F.substring("labels", place, 1)), 16, 10).cast("int")
    edges = chunks.where("edge").select("id", "conv", "before", at(1).alias("first"), at(-1).alias("last"))
    earlier = None
    for e in sorted(edges.collect(), key=lambda e: e["id"]):
        if e["before"] == EDGE and e["first"] != NONE:
            if earlier is None or earlier["conv"] != e["conv"]:
                start[e["first"]] += 1
            elif earlier["last"] != NONE:
                step[earlier["last"], e["first"]] += 1
        earlier = e
    norm = lambda x: np.log(x / x.sum(axis=-1, keepdims=True))
    rows = lambda x: tuple(tuple(map(float, r)) for r in x)
    return Model(tuple(map(float, norm(start))), rows(norm(step)), rows(norm(smoothed(emit, smooth))))


def _alike(sequences: Sequence[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(places, lengths, padded symbols) of sequences whose lengths differ less than twice, longest first."""
    lengths = np.array([len(s) for s in sequences])
    order = np.argsort(-lengths, kind="stable")
    sizes = np.frexp(lengths[order])[1]
    for own in np.split(order, np.flatnonzero(np.diff(sizes)) + 1):
        padded = np.zeros((len(own), lengths[own[0]]), np.uint8)
        for k, i in enumerate(own):
            padded[k, : lengths[i]] = np.frombuffer(sequences[i], np.uint8)
        yield own, lengths[own], padded


def _entries(start: np.ndarray, step: np.ndarray) -> np.ndarray:
    """Scores of a first state after each state; the last row is the start of a conversation."""
    return np.vstack([step, start])


def viterbi(model: Model, sequences: Sequence[bytes], enter: np.ndarray, leave: np.ndarray) -> list[bytes]:
    """Best states of each sequence; ``enter``: row of ``_entries``; ``leave``: the state to end in, or -1."""
    start, step, emit = model.arrays()
    by_symbol, first = emit.T, _entries(start, step)
    out: list[bytes] = [b""] * len(sequences)
    if not sequences:
        return out
    for own, lengths, seen in _alike(sequences):
        score = first[enter[own]] + by_symbol[seen[:, 0]]
        back = np.zeros((seen.shape[1], len(own), len(STATES)), np.int8)
        going = [int((lengths > t).sum()) for t in range(seen.shape[1])] + [0]
        for t in range(1, seen.shape[1]):
            n = going[t]
            ways = score[:n, :, None] + step
            back[t, :n] = ways.argmax(axis=1)
            score[:n] = ways.max(axis=1) + by_symbol[seen[:n, t]]
        state = np.where(leave[own] < 0, score.argmax(axis=1), leave[own])
        states = np.zeros(seen.shape, np.uint8)
        for t in range(seen.shape[1] - 1, -1, -1):
            n = going[t]
            states[:n, t] = state[:n]
            state[:n] = back[t, np.arange(n), state[:n]]
        for k, i in enumerate(own):
            out[i] = states[k, : lengths[k]].tobytes()
    return out


def _matrices(model: Model, sequences: Sequence[bytes]) -> list[np.ndarray]:
    """For each sequence the best score from each row of ``_entries`` to each state at its end."""
    start, step, emit = model.arrays()
    by_symbol, first = emit.T, _entries(start, step)
    out: list = [None] * len(sequences)
    for own, lengths, seen in _alike(sequences) if sequences else ():
        best = first[None] + by_symbol[seen[:, 0]][:, None]
        for t in range(1, seen.shape[1]):
            n = int((lengths > t).sum())
            best[:n] = (best[:n, :, :, None] + step).max(axis=2) + by_symbol[seen[:n, t]][:, None]
        for k, i in enumerate(own):
            out[i] = best[k]
    return out


def _joined(pdf: pd.DataFrame) -> np.ndarray:
    ms = _list_of(pdf)
    best = ms[0]
    for m in ms[1:]:
        best = (best[:, :, None] + m[None, : len(STATES)]).max(axis=1)
    return best


def _list_of(pdf: pd.DataFrame) -> list[np.ndarray]:
    return [np.frombuffer(m).reshape(len(STATES) + 1, len(STATES)) for m in pdf["m"]]


def _walk(pdf: pd.DataFrame, enter: int, leave: int) -> pd.DataFrame:
    """``enter`` and ``leave`` of each matrix in order; ``leave`` -1: the best end."""
    ms = _list_of(pdf)
    score, back = ms[0][enter], []
    for m in ms[1:]:
        ways = score[:, None] + m[: len(STATES)]
        back.append(ways.argmax(axis=0))
        score = ways.max(axis=0)
    ends = [int(score.argmax()) if leave < 0 else leave]
    for b in back[::-1]:
        ends.append(int(b[ends[-1]]))
    ends = ends[::-1]
    return pdf.assign(enter=[enter, *ends[:-1]], leave=ends)


def _key(conv: str = "conv"):
    """A conversation as text, null told apart."""
    return F.coalesce(F.concat(F.lit(":"), F.col(conv).cast("string")), F.lit(""))


def _borders(chunks: DataFrame, model: Model) -> DataFrame:
    """(id, enter, leave) of the chunks, by matrices joined for each range, then over the ranges."""

    def leaf(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ms = _matrices(model, batch.column(2).to_pylist())
            column = pa.array([m.tobytes() for m in ms], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), column], ["key", "id", "m"])

    def join(pdf: pd.DataFrame) -> pd.DataFrame:
        return pdf[["key", "part"]].head(1).assign(m=[_joined(pdf.sort_values("id")).tobytes()])

    def over(pdf: pd.DataFrame) -> pd.DataFrame:
        return _walk(pdf.sort_values("part"), len(STATES), -1)[["key", "part", "enter", "leave"]]

    def down(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id")
        return _walk(pdf, int(pdf["enter"].iloc[0]), int(pdf["leave"].iloc[0]))[["id", "enter", "leave"]]

    each = chunks.select(_key().alias("key"), "id", "symbols").mapInArrow(leaf, "key string, id long, m binary")
    each = stage(each.withColumn("part", F.shiftright("id", 33)), "matrices")
    # A group is the chunks of one range, then the ranges of one conversation.
    runs = stage(each.groupBy("key", "part").applyInPandas(join, "key string, part long, m binary"), "matrices")
    known = runs.groupBy("key").applyInPandas(over, "key string, part long, enter int, leave int")
    joined = each.join(known, ["key", "part"])
    return stage(joined.groupBy("key", "part").applyInPandas(down, "id long, enter int, leave int"), "borders")


def _alone(chunks: DataFrame) -> DataFrame:
    return chunks.where("not open").withColumns({"enter": F.lit(len(STATES)), "leave": F.lit(-1)})


def _linked(chunks: DataFrame, model: Model) -> DataFrame:
    several = chunks.where("open")
    return several.join(checked(_borders(several, model), F.lit(16)), "id")


def _decoded(entered: DataFrame, model: Model) -> DataFrame:
    entered = entered.select("conv", "id", "text", "symbols", "labels", "enter", "leave")
    schema = T.StructType(entered.schema.fields[:5]).add("states", "binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            enter, leave = (batch.column(k).to_numpy(zero_copy_only=False).astype(int) for k in (5, 6))
            states = viterbi(model, batch.column(3).to_pylist(), enter, leave)
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(states, pa.binary())], schema.names)

    return entered.mapInArrow(run, schema)


def decode(chunks: DataFrame, model: Model) -> DataFrame:
    """(conv, id, text, symbols, labels, states): a state for each line, by exact Viterbi over every conversation."""
    return _decoded(_alone(chunks), model).unionByName(_decoded(_linked(chunks, model), model))


def pieces(decoded: DataFrame) -> DataFrame:
    """(conv, id, turn, role, n_lines, text): the turns of each chunk; turn 0 goes on from before."""
    schema = T.StructType([decoded.schema["conv"]]).add("id", "long").add("turn", "long").add("role", "string")
    schema = schema.add("n_lines", "long").add("text", "string")
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, held = [], 0
            kind = batch.schema.field(0).type

            def made(rows: list) -> pa.RecordBatch:
                columns = [pa.array([r[k] for r in rows], t) for k, t in enumerate([kind, *types])]
                return pa.RecordBatch.from_arrays(columns, schema.names)

            for conv, i, text, states in zip(*(c.to_pylist() for c in batch.columns)):
                lines = text.split("\n")
                heads = [k for k, s in enumerate(states) if s % 2 == 0]
                inside = not heads or heads[0] > 0
                cuts = [0, *heads] if inside else heads
                for n, (lo, hi) in enumerate(zip(cuts, [*cuts[1:], len(lines)]), 0 if inside else 1):
                    own = lines[lo:hi]
                    if states[lo] % 2 == 0 and (found := MARKER.match(own[0])):
                        own[0] = own[0][found.end() :]
                    out.append((conv, i, n, ROLES[states[lo] // 2], hi - lo, "\n".join(own)))
                held += len(text)
                if held >= BATCH:
                    yield made(out)
                    out, held = [], 0
            yield made(out)

    return decoded.select("conv", "id", "text", "states").mapInArrow(run, schema)


def turns(chunks: DataFrame, model: Model, template: str = "<|{role}|>\n{text}\n") -> DataFrame:
    """(conv, turn, role, n_lines, text, rendered): decoded lines as canonical turns."""
    names = ["conv", "turn", "role", "n_lines", "text"]
    whole_ones = pieces(_decoded(_alone(chunks), model)).select(*names)
    parts = stage(pieces(_decoded(_linked(chunks, model), model)), "pieces")
    # Turns are numbered in each chunk, and chunks by what begins before them.
    last = parts.groupBy(_key().alias("key"), "id").agg(F.max("turn").alias("own"))
    totals = with_running_totals(last, [F.col("id")], {"upto": F.col("own")}, within=["key"])
    before = stage(totals.select("id", (F.col("upto") - F.col("own")).alias("before")), "before")
    numbered = parts.join(checked(before, F.lit(16)), "id").withColumn("turn", F.col("before") + F.col("turn"))
    gathered = numbered.groupBy("conv", "turn").agg(F.sort_array(F.collect_list(F.struct("id", "role", "n_lines", "text"))).alias("x"))
    linked = gathered.select(
        "conv", "turn", F.get("x", F.lit(0))["role"].alias("role"),
        F.aggregate("x", F.lit(0).cast("long"), lambda n, x: n + x.n_lines).alias("n_lines"),
        F.array_join(F.transform("x", lambda x: x.text), "\n").alias("text"),
    )
    head, _, tail = template.partition("{role}")
    middle, _, end = tail.partition("{text}")
    shaped = F.concat(F.lit(head), F.col("role"), F.lit(middle), F.col("text"), F.lit(end))
    return whole_ones.unionByName(linked.select(*names)).withColumn("rendered", shaped)
