"""Substring dedup of words by recompression.

Recompression turns every text, in rounds, into ever shorter strings of symbols.  A
round joins runs of equal neighbours and then pairs of neighbours, the left one of
class 0 and the right one of class 1, into new symbols; the class of a symbol is one bit
of its name.  Names are 128-bit digests of the parts, hence global: every task gives
equal parts the same name without a shared dictionary, and a round needs no shuffle.
Whether two neighbours are joined depends on these two symbols alone, so a cut between
symbols is fixed by the few words around it: its *context*, which a round widens by
one symbol on each side and which is tracked exactly, however long a run is.  Equal
strings of words are cut alike wherever a context lies inside of them.

A window of WINDOW words is filed under the first cut of round ROUNDS whose context lies
inside of it: equal windows have this cut at the same place, whatever surrounds them.
A window without such a cut (in runs, and a few others) is filed under its own words.

1. Rows whose whole text stands in a document of a smaller id are known by their
   digest; their windows are all repeats and they are not searched.
2. Contexts are counted over all other documents: (name, smallest and largest doc_id),
   combined before the shuffle.  Only a context of two different documents can hold a
   repeat.
3. The windows under such contexts are named and meet by name; one that starts in a
   document with a smaller id is removed from the later one.

A filter of fixed size (``FILTER`` bits, one bit for a context) tells the third step what
to leave out before its shuffle; what it lets through too much meets nobody there.

Skew.  Windows are counted with map-side combine; those of over HOT places are looked
up by broadcast (``sequences.looked_up``), so a passage in a third of all documents
stays in the tasks where it was found.  Texts meet their removed spans by broadcast, or
by a shuffled join if the spans are too large.

Defined results: a null text has no words; the digest of no words is that of an empty
string.  A null doc_id is larger than any id and not smaller than another null.  Rows of
equal doc_id are judged one by one, none is an earlier document of the other.  An empty
table gives an empty result.  Further columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.staging import stage
from tidemark.llm.sequences import given_id, known_id, looked_up
from tidemark.llm.text import checked, whole

WINDOW, ROUNDS = 13, 3
#: Bits of the filter, and bytes of text that are parsed together.
FILTER, PORTION = 1 << 27, 1 << 20
_U = np.uint64


# --- names ----------------------------------------------------------------------


def mixed(x: np.ndarray) -> np.ndarray:
    """Each word's bits spread over all 64 (finalizer of a 64-bit linear generator)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def joined(left: np.ndarray, right: np.ndarray, salt: int) -> np.ndarray:
    """Names (two columns of 64 bits) of pairs of names or of (name, number)."""
    one = mixed(left[:, 0] * _U(0x9E3779B97F4A7C15) + mixed(right[:, 0] + _U(salt)))
    two = mixed(left[:, 1] * _U(0xD1B54A32D192ED03) + mixed(right[:, 1] ^ _U(salt * 0x2545F491 + 7)))
    return np.stack([mixed(one + two * _U(3)), mixed(two ^ (one >> _U(7)))], axis=1)


_BASES = (0x9E6C63D0876A9A47, 0xC2B2AE3D27D4EB4F)


class Ranges:
    """Names of any ranges of a list of named words, by running sums of powers."""

    def __init__(self, names: np.ndarray):
        n = len(names)
        self.sums, self.back = [], []
        for k, base in enumerate(_BASES):
            power = np.concatenate([np.ones(1, _U), np.cumprod(np.full(n, base, _U))])
            self.sums.append(np.concatenate([np.zeros(1, _U), np.cumsum(names[:, k] * power[:-1])]))
            inverse = pow(base, -1, 1 << 64)
            self.back.append(np.concatenate([np.ones(1, _U), np.cumprod(np.full(n, inverse, _U))]))

    def names(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        own = [(s[end] - s[start]) * b[start] for s, b in zip(self.sums, self.back)]
        length = (end - start).astype(_U)
        return joined(np.stack(own, axis=1), np.stack([length, length], axis=1), 77)


class Words:
    """The words of several texts in one list, with their names."""

    def __init__(self, texts: list[bytes]):
        import xxhash

        found = [t.split() for t in texts]
        self.sizes = np.fromiter(map(len, found), np.int64, len(found))
        self.ends = np.cumsum(self.sizes)
        self.starts = self.ends - self.sizes
        flat = pa.array([w for words in found for w in words], pa.binary()).dictionary_encode()
        digest = xxhash.xxh3_128_digest
        table = b"".join(digest(w) for w in flat.dictionary.to_pylist())
        self.names = np.frombuffer(table, "<u8").reshape(-1, 2)[flat.indices.to_numpy()]

    def of(self, places: np.ndarray) -> np.ndarray:
        """The text of each place."""
        return np.searchsorted(self.ends, places, "right")


def cuts(words: Words, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cuts after ``rounds`` rounds: places, first word of each context, end of each context."""
    n = len(words.names)
    edge = np.zeros(n + 1, bool)
    edge[words.starts] = edge[words.ends] = True
    place = np.arange(n + 1)  # starts of symbols and, at last, the end
    first, last, names = place.copy(), place.copy(), words.names
    for r in range(1, rounds + 1):
        outer = edge[place]
        # Runs of equal neighbours, by length.
        opens = np.ones(len(names), bool)
        opens[1:] = (names[1:] != names[:-1]).any(axis=1) | outer[1:-1]
        at = np.flatnonzero(opens)
        length = np.diff(np.append(at, len(names))).astype(_U)
        base = names[at]
        runs = joined(base, np.stack([length, length], axis=1), 2 * r)
        # Pairs of neighbours of class 0 and class 1.
        kind = mixed(base[:, 0] + _U(r)) >> _U(63)
        follows = np.zeros(len(at), bool)
        follows[1:] = (kind[:-1] == 0) & (kind[1:] == 1) & ~outer[at[1:]]
        head = np.flatnonzero(~follows)
        tail = np.flatnonzero(follows)
        names = runs.copy()
        names[tail - 1] = joined(runs[tail - 1], runs[tail], 2 * r + 1)
        names = names[head]
        kept = np.append(at[head], len(place) - 1)
        # A cut is fixed by the symbols of the round before on both of its sides.
        new = place[kept]
        before, after = first[np.maximum(kept - 1, 0)], last[np.minimum(kept + 1, len(place) - 1)]
        outer = edge[new]
        first, last = np.where(outer, new - 1, before), np.where(outer, new + 1, after)
        place = new
    return place, first, last


def filed(words: Words, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of all windows, and the range of words each is filed under."""
    place, first, last = cuts(words)
    many = np.maximum(words.sizes - window + 1, 0)
    ends = np.cumsum(many)
    at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(words.starts - (ends - many), many)
    k = np.minimum(np.searchsorted(first, at, "left"), len(first) - 1)
    inside = (first[k] >= at) & (last[k] <= at + window)
    return at, np.where(inside, first[k], at), np.where(inside, last[k], at + window)


# --- steps over all documents ------------------------------------------------------


def _portions(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, Words]]:
    """(doc, th, words) of rows with PORTION bytes of text together, or one longer text."""
    for batch in batches:
        texts = batch.column("__text").to_pylist()
        docs, hashes = (batch.column(c).to_numpy() for c in ("__doc", "__th"))
        sizes = np.cumsum([len(t) for t in texts])
        at = 0
        while at < len(texts):
            done = sizes[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(sizes, done + PORTION, "right")))
            yield docs[at:to], hashes[at:to], Words(texts[at:to])
            at = to


def _filed_names(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, Ranges]:
    """Places of windows, one name for what each is filed under, and whether that is another than before."""
    at, lo, hi = filed(words)
    ranges = Ranges(words.names)
    other = np.ones(len(at), bool)
    other[1:] = (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])
    own = ranges.names(lo[other], hi[other])[:, 0]
    return at, own[np.cumsum(other) - 1], other, ranges


def contexts(docs: DataFrame) -> DataFrame:
    """(context, doc) for all windows; neighbours under one context are one row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, _, words in _portions(batches):
            at, names, other, _ = _filed_names(words)
            columns = [names[other].view(np.int64), ids[words.of(at[other])]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["context", "doc"])

    return docs.mapInArrow(run, "context long, doc long")


def _filter_of(shared: DataFrame) -> np.ndarray:
    """A bit for each context, at most FILTER bits whatever the number of contexts."""
    bit = F.col("context").bitwiseAND(F.lit(FILTER - 1))
    mask = F.expr("shiftleft(1L, cast(context & 63 as int))")
    rows = shared.groupBy(F.shiftright(bit, 6).alias("at")).agg(F.bit_or(mask).alias("bits")).toArrow()
    bits = np.zeros(FILTER >> 6, np.int64)
    bits[rows.column("at").to_numpy()] = rows.column("bits").to_numpy()
    return bits.view(_U)


def windows(docs: DataFrame, bits: np.ndarray) -> DataFrame:
    """(a, b, doc, th, at): names and places of the windows whose context the filter knows."""
    known = docs.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, hashes, words in _portions(batches):
            at, names, _, ranges = _filed_names(words)
            bit = names & _U(FILTER - 1)
            at = at[(known.value[(bit >> _U(6)).astype(np.int64)] >> (bit & _U(63))) & _U(1) == 1]
            found = ranges.names(at, at + WINDOW).view(np.int64)
            text = words.of(at)
            place = (at - words.starts[text]).astype(np.int32)
            columns = [found[:, 0], found[:, 1], ids[text], hashes[text], place]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["a", "b", "doc", "th", "at"])

    return docs.mapInArrow(run, "a long, b long, doc long, th long, at int")


def _spans(repeats: DataFrame) -> DataFrame:
    """(doc, th, opens, closes): maximal runs of words that the repeated windows cover."""
    starts = repeats.groupBy("doc", "th").agg(F.sort_array(F.collect_set("at")).alias("p"))
    p = F.col("p")
    after = lambda x, i: (i == 0) | (x > F.get(p, i - 1) + WINDOW)
    before = lambda x, i: (i == F.size(p) - 1) | (F.get(p, i + 1) > x + WINDOW)
    closes = F.transform(F.filter(p, before), lambda x: x + WINDOW)
    return starts.select("doc", "th", F.filter(p, after).alias("opens"), closes.alias("closes"))


def _finish(met: DataFrame) -> DataFrame:
    names = ["doc_id", "n_words", "n_removed", "kept_sha256"]

    def one(text: bytes, copy: bool | None, opens: list | None, closes: list | None) -> tuple[int, int, str]:
        found = text.split()
        n = len(found)
        if copy and n >= WINDOW:
            opens, closes = [0], [n]
        kept, at = [], 0
        for lo, hi in zip(opens or (), closes or ()):
            kept += found[at:lo]
            at = hi
        kept += found[at:]
        return n, n - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("__text", "copy", "opens", "closes")]
            rows = [one(*row) for row in zip(*columns)]
            kinds = (pa.int64(), pa.int64(), pa.string())
            out = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column("__doc"), *out], names)

    return met.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def dedup(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_words, n_removed, kept_sha256), a row for each row of ``df``."""
    value = whole(F.col(text))
    docs = df.select(
        known_id(F.col(key)).alias("__doc"), F.xxhash64(value).alias("__th"), value.cast("binary").alias("__text")
    )
    rows = df.select(
        known_id(F.col(key)).alias("doc"), F.xxhash64(value).alias("th"), F.xxhash64(F.lit(1), value).alias("tg")
    )
    rows = stage(rows, "rows")
    equal = rows.groupBy("th", "tg").agg(F.min("doc").alias("least"), F.max("doc").alias("most"), F.count("*").alias("n"))
    equal = stage(equal.where("least < most"), "equal")
    copies = looked_up(rows, equal, ["th", "tg"], "n").where("least < doc").select("doc", "th").distinct()
    copies = stage(copies, "copies")
    known = checked(copies.withColumnsRenamed({"doc": "__doc", "th": "__th"}), F.lit(16))
    fresh = docs.join(known, ["__doc", "__th"], "left_anti")

    met = contexts(fresh).groupBy("context").agg(F.min("doc").alias("least"), F.max("doc").alias("most"))
    shared = stage(met.where("least < most").select("context"), "shared")
    found = stage(windows(fresh, _filter_of(shared)), "windows")
    sizes = found.groupBy("a", "b").agg(F.min("doc").alias("least"), F.max("doc").alias("most"), F.count("*").alias("n"))
    sizes = stage(sizes.where("least < most").select("a", "b", "least", "n"), "sizes")
    repeats = looked_up(found, sizes, ["a", "b"], "n").where("least < doc")

    none = F.lit(None).cast("array<int>")
    whole_rows = copies.select("doc", "th", none.alias("opens"), none.alias("closes"), F.lit(True).alias("copy"))
    cut = stage(_spans(repeats).withColumn("copy", F.lit(False)).unionByName(whole_rows), "cut")
    size = F.lit(48) + F.greatest(F.size("opens"), F.lit(0)) * 8
    removed = checked(cut.withColumnsRenamed({"doc": "__doc", "th": "__th"}), size)
    result = _finish(docs.join(removed, ["__doc", "__th"], "left"))
    return result.withColumn("doc_id", given_id(F.col("doc_id"))).withColumnRenamed("doc_id", key)
