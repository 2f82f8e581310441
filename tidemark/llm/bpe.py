"""Byte-level BPE: texts to token ids with offsets, and back to bytes.

The vocabulary is a file of ranks (base64 token, rank).  A tokenizer of the
``tokenizers`` library is built from it in every Python worker: each byte is
written as one printable character, and every way to split a token into two
lower-ranked tokens is a merge, so merging goes by the rank of the result.

A text without runs of white space is cut at its line feeds and before its
spaces.  No match of the pattern crosses such a place, hence the parts are
encoded on their own and a worker encodes equal parts once.  The memory of parts
is bounded: when it is full, parts that are met later are encoded in each batch
anew.  A text with such runs is encoded in one piece.

Defined results: a null text is the empty text (no ids, empty bytes); rows
with equal or null keys stay separate rows; bytes that are no valid UTF-8 count
as U+FFFD; added columns replace columns of the same name, all others are kept.
An id outside the vocabulary and a null in a list of ids raise an error; a null
list is an empty one.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import os
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Text bytes that one output batch stands for, about.
BATCH_BYTES = 4 << 20
#: Parts that a worker remembers, the longest one at a line start, and how many are encoded at once.
MEMORY, LONGEST, JOINED = 300_000, 64, 512
#: White space beside a space or a line feed.
_RUN = re.compile(r"\s[ \n]|[ \n]\s")


@functools.cache
def _byte_characters() -> list[str]:
    """The character for each byte: printable Latin-1 as it is, others from U+0100 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    table, spare = [], 256
    for b in range(256):
        table.append(chr(b if b in plain else spare))
        spare += b not in plain
    return table


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def _spelled(token: bytes) -> str:
    table = _byte_characters()
    return "".join(table[b] for b in token)


class Codec:
    """Encoder and decoder of one vocabulary, built once in a worker."""

    def __init__(self, path: str, pattern: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Regex, Tokenizer, models, pre_tokenizers

        ranks = read_ranks(path)
        merges = [
            (_spelled(token[:i]), _spelled(token[i:]))
            for token, rank in sorted(ranks.items(), key=lambda x: x[1])
            for i in range(1, len(token))
            if max(ranks.get(token[:i], rank), ranks.get(token[i:], rank)) < rank
        ]
        vocabulary = {_spelled(token): rank for token, rank in ranks.items()}
        self.tokenizer = Tokenizer(models.BPE(vocab=vocabulary, merges=merges))
        self.tokenizer.pre_tokenizer = pre_tokenizers.Sequence(
            [
                pre_tokenizers.Split(Regex(pattern), behavior="isolated"),
                pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
            ]
        )
        byte_of = {c: b for b, c in enumerate(_byte_characters())}
        self.bytes_of: list[bytes | None] = [None] * (max(ranks.values()) + 1)
        for spelled, rank in vocabulary.items():
            self.bytes_of[rank] = bytes(byte_of[c] for c in spelled)
        self.table = np.array(self.bytes_of, object)
        self.length_of = np.array([len(b or b"") for b in self.bytes_of], np.int64)
        # Ids of parts after a space, and of parts at the start of a line.
        self.known: dict[str, bytes] = {}
        self.starts: dict[str, bytes] = {}

    def _encode_joined(self, parts: list[str]) -> Iterator[bytes]:
        """Ids of " " + part for each part, from strings of JOINED parts each.

        Ids are dealt to parts by their bytes, since no id reaches over a place
        where one part ends and the next begins with a space.
        """
        joined = [" " + " ".join(parts[at : at + JOINED]) for at in range(0, len(parts), JOINED)]
        done = self.tokenizer.encode_batch_fast(joined, add_special_tokens=False)
        for k, found in enumerate(done):
            some = parts[k * JOINED : (k + 1) * JOINED]
            ids = np.array(found.ids, "<u4")
            ends = np.cumsum([len(p.encode()) + 1 for p in some])
            cuts = [0, *np.searchsorted(np.cumsum(self.length_of[ids]), ends, "right").tolist()]
            raw = ids.tobytes()
            yield from [raw[4 * a : 4 * b] for a, b in zip(cuts, cuts[1:])]

    def _learn(self, new: set[str]) -> None:
        inner = [p for p in new if p and not p[0].isspace() and not p[-1].isspace()]
        self.known.update(zip(inner, self._encode_joined(inner)))
        for p in new.difference(inner):
            self.known[p] = self._alone(" " + p)

    def _alone(self, text: str) -> bytes:
        found = self.tokenizer.encode(text, add_special_tokens=False)
        return np.array(found.ids, "<u4").tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        cut = [None if _RUN.search(t) else [x.split(" ") for x in t.split("\n")] for t in texts]
        new: set[str] = set()
        for lines in cut:
            for parts in lines or ():
                new.update(parts[1:])
        known = self.known
        new = {p for p in new if p not in known}
        self._learn(new)
        out, get, newline = [], self.known.__getitem__, self._alone("\n")
        for t, lines in zip(texts, cut):
            if lines is None:
                out.append(self._alone(t))
                continue
            done: list[bytes] = []
            for parts in lines:
                done += newline, self._first(parts[0])
                done += map(get, parts[1:])
            out.append(b"".join(done[1:]))
        if len(self.known) > MEMORY:
            for p in new:
                del self.known[p]
        return out

    def _first(self, part: str) -> bytes:
        found = self.starts.get(part)
        if found is None:
            found = self._alone(part)
            if len(self.starts) < MEMORY // 8 and len(part) <= LONGEST:
                self.starts[part] = found
        return found

    def offsets(self, text: bytes, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First character and the one after the last of each token.

        A token that holds part of a character counts as holding all of it.
        """
        ends = np.cumsum(self.length_of[ids])
        data = np.frombuffer(text, np.uint8)
        character = np.cumsum((data & 0xC0) != 0x80) - 1
        begins = np.concatenate([[0], ends[:-1]]).astype(np.int64)
        if not len(ids):
            return begins[:0], begins[:0]
        return character[begins], character[ends - 1] + 1

    def decode(self, ids: list[int] | np.ndarray) -> bytes:
        try:
            return b"".join(self.table[np.asarray(ids, np.int64)].tolist())
        except (IndexError, TypeError) as e:
            raise ValueError("an id is not in the vocabulary") from e


@functools.cache
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


def _slices(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about BATCH_BYTES each."""
    start, held = 0, 0
    for i, n in enumerate(sizes.tolist()):
        held += n
        if held >= BATCH_BYTES:
            yield start, i + 1
            start, held = i + 1, 0
    if start < len(sizes):
        yield start, len(sizes)


def _sizes(column: pa.Array, width: int = 1) -> np.ndarray:
    import pyarrow.compute as pc

    kind = column.type
    if pa.types.is_list(kind) or pa.types.is_large_list(kind):
        found = pc.list_value_length(column)
    else:
        found = pc.binary_length(column)
    return pc.fill_null(found, 0).to_numpy(zero_copy_only=False) * width


def _arrays(lists: pa.ListArray) -> list[np.ndarray]:
    """The lists as arrays, without an object per id; a null list is an empty one."""
    if lists.null_count:
        return [np.array(x or [], np.int64) for x in lists.to_pylist()]
    flat = lists.values
    if flat.null_count:
        raise ValueError("a null among the ids")
    ids, ends = flat.to_numpy(zero_copy_only=False), lists.offsets.to_numpy(zero_copy_only=False)
    return [ids[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]


def _lists(values: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    ends = np.concatenate([[0], np.cumsum([len(v) for v in values])]).astype(np.int32)
    flat = np.concatenate(values) if values else np.array([])
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.astype(kind.to_pandas_dtype())))


#: A step on Arrow batches: from the schema of its input to that of its output, and the work.
Batches = Iterator[pa.RecordBatch]
Step = Callable[[T.StructType], tuple[T.StructType, Callable[[Batches], Batches]]]


def chain(df: DataFrame, *steps: Step) -> DataFrame:
    """All steps in one Python worker per task, batch by batch."""
    schema, works = df.schema, []
    for step in steps:
        schema, work = step(schema)
        works.append(work)

    def run(batches: Batches) -> Batches:
        for work in works:
            batches = work(batches)
        return batches

    return df.mapInArrow(run, schema)


def _with(schema: T.StructType, names: list[tuple[str, T.DataType]]) -> T.StructType:
    added = {n.lower() for n, _ in names}
    kept = [f for f in schema.fields if f.name.lower() not in added]
    return T.StructType(kept + [T.StructField(n, t) for n, t in names])


def encoding(path: str, pattern: str, text: str = "text", offsets: bool = False) -> Step:
    def step(given: T.StructType):
        ints = T.ArrayType(T.IntegerType(), False)
        schema = _with(given, [("ids", ints)] + [("starts", ints), ("ends", ints)] * offsets)
        kept = [f.name for f in schema.fields if f.name not in ("ids", "starts", "ends")]

        def run(batches: Batches) -> Batches:
            c = codec(path, pattern)
            for whole in batches:
                column = whole.column(whole.schema.get_field_index(text))
                for lo, hi in _slices(_sizes(column)):
                    raw = [b or b"" for b in column.slice(lo, hi - lo).cast(pa.binary()).to_pylist()]
                    texts = [b.decode("utf-8", "replace") for b in raw]
                    ids = [np.frombuffer(b, "<u4") for b in c.encode(texts)]
                    out = [whole.column(n).slice(lo, hi - lo) for n in kept]
                    out.append(_lists(ids, pa.int32()))
                    if offsets:
                        pairs = [c.offsets(t.encode(), i) for t, i in zip(texts, ids)]
                        out += [_lists([p[k] for p in pairs], pa.int32()) for k in (0, 1)]
                    yield pa.RecordBatch.from_arrays(out, [f.name for f in schema.fields])

        return schema, run

    return step


def decoding(path: str, pattern: str, ids: str = "ids") -> Step:
    def step(given: T.StructType):
        schema = _with(given, [("decoded", T.BinaryType())])
        kept = [f.name for f in schema.fields if f.name != "decoded"]

        def run(batches: Batches) -> Batches:
            import pyarrow.compute as pc

            c = codec(path, pattern)
            for whole in batches:
                column = whole.column(whole.schema.get_field_index(ids))
                for lo, hi in _slices(_sizes(column, 4)):
                    some = column.slice(lo, hi - lo)
                    if (pc.min(some.flatten()).as_py() or 0) < 0:
                        raise ValueError("an id is not in the vocabulary")
                    out = [whole.column(n).slice(lo, hi - lo) for n in kept]
                    out.append(pa.array([c.decode(x) for x in _arrays(some)], pa.binary()))
                    yield pa.RecordBatch.from_arrays(out, [f.name for f in schema.fields])

        return schema, run

    return step


def digesting(ids: str = "ids", decoded: str = "decoded") -> Step:
    def step(given: T.StructType):
        added = [("n_tokens", T.LongType()), ("ids_sha256", T.StringType()), ("decoded_sha256", T.StringType())]
        schema = _with(T.StructType([f for f in given.fields if f.name not in (ids, decoded)]), added)
        kept = [f.name for f in schema.fields[: -len(added)]]

        def run(batches: Batches) -> Batches:
            sha = lambda b: hashlib.sha256(b).hexdigest()
            for batch in batches:
                at = lambda n: batch.column(batch.schema.get_field_index(n))  # noqa: B023, E731
                lists = _arrays(at(ids))
                out = [at(n) for n in kept]
                out.append(pa.array([len(x) for x in lists], pa.int64()))
                out.append(pa.array([sha(x.astype("<u4").tobytes()) for x in lists], pa.string()))
                out.append(pa.array([sha(b or b"") for b in at(decoded).to_pylist()], pa.string()))
                yield pa.RecordBatch.from_arrays(out, [f.name for f in schema.fields])

        return schema, run

    return step


def dropping(*names: str) -> Step:
    """Columns that later steps don't need; they are not sent back to the JVM."""

    def step(given: T.StructType):
        schema = T.StructType([f for f in given.fields if f.name not in names])
        kept = [f.name for f in schema.fields]
        return schema, lambda batches: (b.select(kept) for b in batches)

    return step


def encode(
    df: DataFrame, path: str, pattern: str, text: str = "text", offsets: bool = False
) -> DataFrame:
    """``df`` with ``ids``, and with ``starts`` and ``ends`` (characters) if asked for."""
    return chain(df, encoding(path, pattern, text, offsets))


def decode(df: DataFrame, path: str, pattern: str, ids: str = "ids") -> DataFrame:
    """``df`` with ``decoded``, the bytes that the ids stand for.

    Bytes, not text: a list of ids may begin or end inside a character.
    """
    return chain(df, decoding(path, pattern, ids))


def digest(df: DataFrame, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``df`` without both columns, with n_tokens, ids_sha256 and decoded_sha256."""
    return chain(df, digesting(ids, decoded))
