"""Suffix-array dedup: bytes of repeated strings of WINDOW bytes are removed.

A byte goes if a string of WINDOW bytes covers it that also starts earlier (in a
document of smaller key, or earlier in the same one); strings never cross documents.

A suffix array of a whole corpus is too large for any one machine and mostly
sorts what occurs once.  So equal strings are first brought together:

1. Anchors.  Every window has one anchor, the run of GRAM bytes of smallest hash
   in it (the first of equal ones).  Equal windows have equal anchors at equal
   places.  The windows of one anchor are neighbours; their union is its context.
   Of equal (anchor hash, context hash) in SLICE bytes of text only the first place is
   gathered, packed, at most 2.7 rows per 100 bytes; the others are known to go.
2. Contexts that occur again whole are removed there and then, all but the first.
   Places come in pieces and are folded to the first of each context every FOLD rows.
   A context whose anchor has other contexts as well is an edge: it may share
   some of its windows with another.  Nothing else can hold a repeat.
3. Edges are cut from their texts, dealt to shards by anchor hash, and every
   shard is sorted by induction, in batches of whole groups of BATCH bytes: LMS
   substrings are sorted by inducing, named, ranked by doubling the names until
   WINDOW bytes are covered, and the order of all suffixes is induced from them,
   a bucket and a generation at a time.  Neighbours are compared over WINDOW
   bytes, which gives the groups of equal windows; all but the earliest go.
4. Removed spans are brought to their texts and cut out.

Memory is bounded by the batch, not by the shard: Spark's sorted shuffle is the
disk-backed part.  An anchor with more than HOT distinct contexts (a frequent
line) is not held but dealt anew, window by window, by a hash of the window.  Equal
windows are thinned to the first where they are cut, and again for every BATCH
bytes of one hash.  So no array grows with the number of copies of a text or passage.

Defined results: a null text is empty; texts shorter than WINDOW lose nothing;
a null key is smaller than any other; of rows with equal key and text the first
is judged as usual and the others lose all that a copy loses; rows of equal key
and different text are ordered by a hash of the text.  Keys are integers.
Columns of the input other than key and text are not carried.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.staging import stage
from tidemark.llm.text import whole

WINDOW, GRAM = 100, 20
#: Grams in a window.
SPAN = WINDOW - GRAM + 1
#: Bytes of text per partition, per numpy call, and per sort; distinct contexts of a hot anchor.
PER_PARTITION, SLICE, BATCH, HOT = 16 << 20, 4 << 20, 2 << 20, 10_000
#: Places gathered before they are folded to the first of each context.
FOLD = 500_000
_NULL = -(2**63)
_U = np.uint64


# --- hashes of substrings ---------------------------------------------------------


@functools.cache
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A random word per byte; powers of an odd number and of its inverse modulo 2**64."""
    base = 0x9E3779B97F4A7C15
    inverse = pow(base, -1, 2**64)
    words = np.random.Generator(np.random.PCG64(5)).integers(0, 2**64, 256, dtype=_U)
    powers = []
    for b in (base, inverse):
        run = np.full(SLICE + WINDOW + 1, b, _U)
        run[0] = 1
        powers.append(np.cumprod(run, dtype=_U))
    return words, powers[0], powers[1]


def _mix(x: np.ndarray) -> np.ndarray:
    for shift, factor in ((29, 0xBF58476D1CE4E5B9), (32, 0x94D049BB133111EB)):
        x = (x ^ (x >> _U(shift))) * _U(factor)
    return x ^ (x >> _U(29))


def _prefix(data: np.ndarray) -> np.ndarray:
    words, powers, _ = _tables()
    out = np.zeros(len(data) + 1, _U)
    np.cumsum(words[data] * powers[: len(data)], out=out[1:])
    return out


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    k = 1
    while k * 2 <= width:
        x = np.minimum(x[:-k], x[k:])
        k *= 2
    rest = width - k
    return np.minimum(x[: len(x) - rest], x[rest:])


def anchors(data: np.ndarray, ends: np.ndarray) -> dict[str, np.ndarray]:
    """Anchors of joined texts that end at ``ends``: hash, context hash, first and last window, place.

    At most SLICE + WINDOW bytes.
    """
    none = np.zeros(0, np.int64)
    if len(data) < WINDOW:
        return {"h": none.astype(_U), "c": none.astype(_U), "lo": none, "hi": none, "at": none}
    inverse = _tables()[2]
    prefix = _prefix(data)
    grams = _mix((prefix[GRAM:] - prefix[:-GRAM]) * inverse[: len(data) - GRAM + 1])
    low = _U(0xFFFFFF)
    # The place in the low bits makes the first of equal hashes the smallest.
    keys = (grams & ~low) | np.arange(len(grams), dtype=_U)
    own = (_sliding_min(keys, SPAN) & low).astype(np.int64)
    for e in ends[:-1].tolist():
        own[max(0, e - WINDOW + 1) : e] = -1
    begins = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
    lasts = np.concatenate([begins[1:], [len(own)]]) - 1
    real = own[begins] >= 0
    lo, hi = begins[real], lasts[real]
    at = own[lo]
    shape = ((at - lo) * 256 + (hi - lo)).astype(_U)
    c = _mix((prefix[hi + WINDOW] - prefix[lo]) * inverse[lo]) ^ _mix(shape + _U(1))
    return {"h": grams[at], "c": c, "lo": lo, "hi": hi, "at": at}


# --- induced sorting ----------------------------------------------------------------


def _induce(text: np.ndarray, kind: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """Order of all suffixes from that of the LMS ones (``seeds``, in order of their first byte).

    ``kind``: True where a suffix is smaller than the next one.  A bucket is
    worked off in generations: what it got from other buckets, then what that
    put into the bucket itself, and so on, each in one step.
    """
    queues: list[list[np.ndarray]] = [[] for _ in range(257)]

    def push(found: np.ndarray, small: bool, own: int) -> np.ndarray:
        """Deal the suffixes before ``found`` that are of the kind; those of bucket ``own`` come back."""
        before = found[found > 0] - 1
        before = before[kind[before] == small]
        if not len(before):
            return before
        c = text[before]
        order = np.argsort(c, kind="stable")
        before, c = before[order], c[order]
        cuts = np.flatnonzero(c[1:] != c[:-1]) + 1
        back = before[:0]
        for part, value in zip(np.split(before, cuts), c[np.concatenate([[0], cuts])].tolist()):
            if value == own:
                back = part
            else:
                queues[value].append(part)
        return back

    first = text[seeds]
    cut = np.searchsorted(first, np.arange(258))
    large: list[list[np.ndarray]] = [[] for _ in range(257)]
    for b in range(257):
        while queues[b]:
            now = np.concatenate(queues[b])
            queues[b] = []
            large[b].append(now)
            back = push(now, False, b)
            if len(back):
                queues[b].append(back)
        some = seeds[cut[b] : cut[b + 1]]
        if len(some):
            push(some, False, -1)
    # The end of the text follows from no other suffix.
    queues[0].append(np.array([len(text) - 1], seeds.dtype))
    parts: list[np.ndarray] = []
    for b in range(256, -1, -1):
        small: list[np.ndarray] = []
        while queues[b]:
            now = np.concatenate(queues[b])
            queues[b] = []
            small.append(now)
            back = push(now, True, b)
            if len(back):
                queues[b].append(back)
        own = np.concatenate(large[b])[::-1] if large[b] else seeds[:0]
        if len(own):
            push(own, True, -1)
        parts += [*small, own]
    return np.concatenate(parts)[::-1]


def suffix_order(data: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes of ``data`` in order of their first ``depth`` bytes at least.

    The end of the data is smaller than any byte.
    """
    text = np.concatenate([data.astype(np.int16) + 1, np.zeros(1, np.int16)])
    n = len(text)
    # A suffix is smaller than the next one if its first differing byte is.
    change = np.flatnonzero(text[1:] != text[:-1])
    rises = text[change] < text[change + 1]
    kind = np.ones(n, bool)
    if len(change):
        nth = np.searchsorted(change, np.arange(n - 1))
        kind[: n - 1] = rises[nth]
    lms = np.flatnonzero(kind[1:] & ~kind[:-1]) + 1
    seeds = lms[np.argsort(text[lms], kind="stable")].astype(np.int32)
    order = _induce(text, kind, seeds)
    is_lms = np.zeros(n, bool)
    is_lms[lms] = True
    found = order[is_lms[order]]
    # Names of LMS substrings: equal where length and all bytes are.
    index = np.zeros(n, np.int64)
    index[lms] = np.arange(len(lms))
    length = np.concatenate([np.diff(lms) + 1, [1]])
    a, b = found[:-1], found[1:]
    la, lb = length[index[a]], length[index[b]]
    same = la == lb
    k = 0
    rows = np.flatnonzero(same)
    while len(rows):
        equal = text[a[rows] + k] == text[b[rows] + k]
        same[rows[~equal]] = False
        rows = rows[equal & (la[rows] > k + 1)]
        k += 1
    names = np.zeros(len(lms), np.int64)
    names[index[found]] = np.concatenate([[0], np.cumsum(~same)])
    # An LMS substring is two bytes long at least.
    covered = 1
    while covered * 2 < depth and names.max(initial=0) + 1 < len(lms):
        after = np.full(len(lms), -1, np.int64)
        after[: max(0, len(lms) - covered)] = names[covered:]
        pair = names * (len(lms) + 1) + after + 1
        _, names = np.unique(pair, return_inverse=True)
        covered *= 2
    seeds = lms[np.argsort(names, kind="stable")].astype(np.int32)
    return _induce(text, kind, seeds)


def repeats(data: np.ndarray, starts: np.ndarray, rank: np.ndarray, width: int = WINDOW) -> np.ndarray:
    """Which windows (``starts``, each with ``width`` bytes) equal one of smaller ``rank``."""
    order = suffix_order(data, width)
    number = np.full(len(data) + 1, -1, np.int64)
    number[starts] = np.arange(len(starts))
    found = number[order]
    found = found[found >= 0]
    at = starts[found]
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    words = np.lib.stride_tricks.as_strided(padded, (len(data) + 1, 8), (1, 1)).copy().view(_U).ravel()
    same = np.ones(max(0, len(at) - 1), bool)
    steps = [*range(0, width - 7, 8), *([width - 8] if width % 8 else [])]
    for k in steps:
        same &= words[at[1:] + k] == words[at[:-1] + k]
    group = np.concatenate([[0], np.cumsum(~same)]) if len(at) else np.zeros(0, np.int64)
    least = np.full(group.max(initial=-1) + 1, np.iinfo(np.int64).max)
    np.minimum.at(least, group, rank[found])
    out = np.zeros(len(starts), bool)
    out[found] = rank[found] > least[group]
    return out


# --- first places ---------------------------------------------------------------------

Places = dict[str, np.ndarray]


def _joined(parts: list[Places]) -> Places:
    return {n: np.concatenate([p[n] for p in parts]) for n in parts[0]}


def _some(places: Places, rows: np.ndarray) -> Places:
    return {n: v[rows] for n, v in places.items()}


def firsts(places: Places) -> tuple[Places, Places]:
    """The earliest place (doc, th, lo) of each (h, c), in order of h, and the later ones.

    A place that comes twice (repeated rows) is one place.
    """
    order = np.lexsort([places[n] for n in ("lo", "th", "doc", "c", "h")])
    places = _some(places, order)

    def differs(*names: str) -> np.ndarray:
        other = np.any([places[n][1:] != places[n][:-1] for n in names], axis=0)
        return np.concatenate([[True], other])[: len(order)]

    new = differs("h", "c")
    return _some(places, new), _some(places, ~new & differs("doc", "th", "lo"))


def settled(pieces: Iterator[Places], hot: int, fold: int) -> Iterator[tuple[Places, str]]:
    """Places of one part, each "gone", "edge" or "windows" (an edge to be cut window by window).

    Held are the first places of contexts, of at most ``hot`` contexts for an
    anchor, and as many new places, or ``fold`` of them.
    """
    held: list[Places] = []
    size, base = 0, 0
    frequent = np.zeros(0, _U)

    def folded() -> Iterator[tuple[Places, str]]:
        nonlocal held, size, base, frequent
        first, again = firsts(_joined(held))
        _, group, count = np.unique(first["h"], return_inverse=True, return_counts=True)
        often = (count[group] > hot) | np.isin(first["h"], frequent)
        frequent = np.union1d(frequent, first["h"][often])
        held = [_some(first, ~often)]
        size = base = len(held[0]["h"])
        yield again, "gone"
        yield _some(first, often), "windows"

    for piece in pieces:
        held.append(piece)
        size += len(piece["h"])
        if size - base > max(fold, base):
            yield from folded()
    if held:
        yield from folded()
        _, group, count = np.unique(held[0]["h"], return_inverse=True, return_counts=True)
        yield _some(held[0], count[group] > 1), "edge"


def thinned(doc: np.ndarray, th: np.ndarray, lo: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the earliest of equal windows, and of the later ones; ``data`` has WINDOW bytes for each."""
    windows = np.ascontiguousarray(data).view(np.dtype((np.void, WINDOW)))
    group = np.unique(windows, return_inverse=True)[1]
    row = np.arange(len(doc))
    first, again = firsts({"h": group, "c": np.zeros_like(group), "doc": doc, "th": th, "lo": lo, "row": row})
    return first["row"], again["row"]


# --- the steps on Spark -------------------------------------------------------------

_PACKED = [("h", "<u8"), ("c", "<u8"), ("doc", "<i8"), ("th", "<i8"), ("lo", "<i4"), ("ahead", "u1"), ("more", "u1")]


def _pack(columns: dict[str, np.ndarray]) -> bytes:
    raw = b"".join(columns[n].astype(t).tobytes() for n, t in _PACKED)
    return zstandard.ZstdCompressor(level=1).compress(len(columns["h"]).to_bytes(8, "little") + raw)


def _unpack(blob: bytes) -> dict[str, np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    n, at, out = int.from_bytes(raw[:8], "little"), 8, {}
    for name, t in _PACKED:
        size = n * np.dtype(t).itemsize
        out[name] = np.frombuffer(raw, t, n, at)
        at += size
    return out


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, int, bytes]]:
    """(key, text hash, place of the first byte, bytes) in pieces of at most SLICE and WINDOW bytes."""
    for batch in batches:
        for doc, th, text in zip(*[batch.column(n).to_pylist() for n in ("__doc", "__th", "__text")]):
            for at in range(0, max(1, len(text) - WINDOW + 1), SLICE):
                yield doc, th, at, text[at : at + SLICE + WINDOW - 1]


def _anchor_rows(docs: DataFrame, parts: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, int, int, bytes]] = []
        size = 0

        def flush() -> pa.RecordBatch:
            ends = np.cumsum([len(p[3]) for p in held])
            data = np.frombuffer(b"".join(p[3] for p in held), np.uint8)
            a = anchors(data, ends)
            which = np.searchsorted(ends, a["lo"], "right")
            begin = np.concatenate([[0], ends[:-1]])[which]
            of = lambda k: np.array([p[k] for p in held], np.int64)[which]
            columns = {
                "h": a["h"], "c": a["c"], "doc": of(0), "th": of(1), "lo": a["lo"] - begin + of(2),
                "ahead": a["at"] - a["lo"], "more": a["hi"] - a["lo"],
            }
            # Back in order of the texts: neighbours share their document, which packs well.
            row = {"row": np.arange(len(a["h"]))}
            kept, gone = (_some(p, np.argsort(p["row"])) for p in firsts(columns | row))
            part = (kept["h"] % _U(parts)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            part = part[order]
            cuts = np.flatnonzero(np.diff(part)) + 1
            blobs = [_pack(_some(kept, rows)) for rows in np.split(order, cuts) if len(rows)]
            numbers = part[np.concatenate([[0], cuts])].tolist() if len(part) else []
            if len(gone["h"]):
                # What goes need not meet anything: negative parts, spread by place, without hashes.
                none = np.zeros(len(gone["h"]), _U)
                numbers.append(-1 - (int(gone["th"][0]) ^ int(gone["doc"][-1])) % parts)
                blobs.append(_pack(gone | {"h": none, "c": none}))
            return pa.RecordBatch.from_arrays(
                [pa.array(numbers, pa.int64()), pa.array(blobs, pa.binary())], ["part", "blob"]
            )

        for piece in _texts(batches):
            if held and size + len(piece[3]) > SLICE + WINDOW:
                yield flush()
                held, size = [], 0
            held.append(piece)
            size += len(piece[3])
        if held:
            yield flush()

    return docs.mapInArrow(run, "part long, blob binary")


_FOUND = "doc long, th long, lo int, size int, h long, ahead int"


def _contexts(dealt: DataFrame) -> DataFrame:
    """Spans that go (h null), and edges that are to be sorted (ahead -1: window by window)."""

    def rows(p: Places, what: str) -> pa.RecordBatch:
        n = len(p["h"])
        ahead = np.full(n, -1, np.int32) if what == "windows" else p["ahead"].astype(np.int32)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(p["doc"]), pa.array(p["th"]), pa.array(p["lo"]), pa.array(p["more"].astype(np.int32) + WINDOW),
                pa.array(p["h"].view(np.int64), mask=np.full(n, what == "gone")), pa.array(ahead),
            ],
            ["doc", "th", "lo", "size", "h", "ahead"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blobs = (r for batch in batches for r in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
        for part, own in itertools.groupby(blobs, key=lambda r: r[0]):
            pieces = (_unpack(blob) for _, blob in own)
            for places, what in ((p, "gone") for p in pieces) if part < 0 else settled(pieces, HOT, FOLD):
                if len(places["h"]):
                    yield rows(places, what)

    return dealt.mapInArrow(run, _FOUND)


_MET = ["lo", "size", "h", "ahead"]


def _meet(texts: DataFrame, rows: DataFrame, parts: int) -> DataFrame:
    """Rows of (doc, th, *_MET) and the texts they are about, one after the other in a partition."""
    rows = rows.select("doc", "th", *_MET, F.lit(None).cast("binary").alias("z"))
    texts = texts.select(
        F.col("__doc").alias("doc"), F.col("__th").alias("th"),
        *[F.lit(None).cast(rows.schema[n].dataType).alias(n) for n in _MET], F.col("__z").alias("z"),
    )
    both = rows.unionAll(texts).repartition(parts, "doc", "th")
    return both.sortWithinPartitions("doc", "th", F.col("z").isNotNull(), "lo")


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, bytes | None, list[tuple]]]:
    """(doc, th, text, rows) per text; equal texts follow one another and get the same rows.

    A text of None marks the end of a batch.
    """
    own, rows = None, []
    for batch in batches:
        doc, th, z, *met = [batch.column(n).to_pylist() for n in ("doc", "th", "z", *_MET)]
        for d, t, packed, *row in zip(doc, th, z, *met):
            if own != (d, t):
                own, rows = (d, t), []
            if packed is None:
                rows.append(row)
            else:
                yield d, t, zstandard.decompress(packed), rows
        yield 0, 0, None, []


def _cut(met: DataFrame) -> DataFrame:
    """A row for each edge with its bytes: (h, doc, th, lo, context).

    Of equal windows that are cut together the first has its bytes, the others
    (known to go) have none and are spread by place.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        names = ["h", "doc", "th", "lo", "context"]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
        out: list[tuple] = []
        windows: dict[bytes, tuple[int, int, int]] = {}
        size, before = 0, None
        for doc, th, text, edges in _met(batches):
            if text is not None and before != (doc, th):
                before = (doc, th)
                # A hot anchor's place is here twice if its row is.
                for lo, length, h, ahead in dict.fromkeys(map(tuple, edges)):
                    bytes_ = text[lo : lo + length]
                    size += length
                    if ahead >= 0:
                        out.append((h, doc, th, lo, bytes_))
                        continue
                    for k in range(length - WINDOW + 1):
                        window, place = bytes_[k : k + WINDOW], (doc, th, lo + k)
                        earlier = windows.setdefault(window, place)
                        if earlier is place:
                            size += WINDOW
                            continue
                        windows[window] = min(earlier, place)
                        d, t, at = max(earlier, place)
                        out.append(((d * 0x9E3779B1 + at) & (2**63 - 1), d, t, at, None))
            if size > SLICE or text is None:
                out += [(xxhash.xxh64_intdigest(w) - 2**63, *place, w) for w, place in windows.items()]
                columns = zip(*out) if out else [[]] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns, kinds)], names)
                out, windows, size = [], {}, 0

    return met.mapInArrow(run, "h long, doc long, th long, lo int, context binary")


def _sorted_spans(edges: DataFrame) -> DataFrame:
    """(doc, th, lo, size): runs of windows that repeat an earlier one.  Rows come sorted by h."""

    def spans(doc: np.ndarray, th: np.ndarray, lo: np.ndarray, size: np.ndarray) -> pa.RecordBatch:
        some = [pa.array(doc), pa.array(th), pa.array(lo.astype(np.int32)), pa.array(size.astype(np.int32))]
        return pa.RecordBatch.from_arrays(some, ["doc", "th", "lo", "size"])

    def judge(held: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        h, doc, th, lo, length = (np.concatenate([p[k] for p in held]) for k in range(5))
        data = np.concatenate([p[5] for p in held])
        begin = np.cumsum(length) - length
        count = length - WINDOW + 1
        # Every window of every context.
        which = np.repeat(np.arange(len(h)), count)
        offset = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
        start = lo[which] + offset
        order = np.lexsort((start, th[which], doc[which]))
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        # Rows of one place are one string, not two (it can be an edge only once).
        gone = repeats(data, begin[which] + offset, rank)
        run = gone & ~np.concatenate([[False], gone[:-1] & (which[1:] == which[:-1])])
        last = gone & ~np.concatenate([gone[1:] & (which[1:] == which[:-1]), [False]])
        a, b = np.flatnonzero(run), np.flatnonzero(last)
        return spans(doc[which[a]], th[which[a]], start[a], start[b] - start[a] + WINDOW)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        size, last = 0, None
        for batch in batches:
            known = batch.filter(pc.is_null(batch.column("context")))
            if known.num_rows:
                doc, th, lo = (known.column(n).to_numpy() for n in ("doc", "th", "lo"))
                yield spans(doc, th, lo, np.full(len(lo), WINDOW))
            batch = batch.filter(pc.is_valid(batch.column("context")))
            if not batch.num_rows:
                continue
            h, doc, th, lo = (batch.column(n).to_numpy(zero_copy_only=False) for n in ("h", "doc", "th", "lo"))
            contexts = batch.column("context").to_pylist()
            length = np.array([len(x) for x in contexts], np.int64)
            # Whole groups only: a batch may end where the hash changes.
            edges_ = np.flatnonzero(h[1:] != h[:-1]) + 1
            begins = [0, *edges_.tolist()]
            for a, b in zip(begins, [*begins[1:], len(h)]):
                if size > BATCH and h[a] != last:
                    yield judge(held)
                    held, size = [], 0
                elif size > BATCH and all(g[0][0] == last and np.all(g[4] == WINDOW) for g in held):
                    # Windows of one hash: the first of equal ones stands for them.
                    _, d, t, at, _, data = (np.concatenate(x) for x in zip(*held))
                    first, again = thinned(d, t, at, data)
                    yield spans(d[again], t[again], at[again], np.full(len(again), WINDOW))
                    data = data.reshape(-1, WINDOW)[first].ravel()
                    n = len(first)
                    held = [(np.full(n, last), d[first], t[first], at[first], np.full(n, WINDOW), data)]
                    size = len(data)
                elif size > BATCH and held[0][0][0] != last:
                    # Groups before this one are whole.
                    own = next(k for k, g in enumerate(held) if g[0][0] == last)
                    yield judge(held[:own])
                    held = held[own:]
                    size = sum(len(g[5]) for g in held)
                data = np.frombuffer(b"".join(contexts[a:b]), np.uint8)
                held.append((h[a:b], doc[a:b], th[a:b], lo[a:b].astype(np.int64), length[a:b], data))
                size += len(data)
                last = h[a]
        if held:
            yield judge(held)

    return edges.mapInArrow(run, "doc long, th long, lo int, size int")


def _merged(spans: list[tuple]) -> list[tuple[int, int]]:
    """Spans (in order of their start) as maximal runs (first, end)."""
    out: list[tuple[int, int]] = []
    for lo, size, *_ in spans:
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], lo + size))
        else:
            out.append((lo, lo + size))
    return out


def _finish(met: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64()] * 4 + [pa.string()]
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
        out: list[tuple] = []
        before = None
        for doc, th, text, spans in _met(batches):
            if text is None:
                columns = [pa.array([r[k] for r in out], kind) for k, kind in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays(columns, names)
                out = []
                continue
            copy = before == (doc, th) and len(text) >= WINDOW
            before = (doc, th)
            cuts = [(0, len(text))] if copy else _merged(spans)
            kept, at = hashlib.sha256(), 0
            for lo, hi in cuts:
                kept.update(text[at:lo])
                at = hi
            kept.update(text[at:])
            gone = sum(hi - lo for lo, hi in cuts)
            out.append((None if doc == _NULL else doc, len(text), gone, len(cuts), kept.hexdigest()))

    return met.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def _compressed(docs: DataFrame) -> DataFrame:
    """Texts as compressed bytes, for shuffles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            press = zstandard.ZstdCompressor(level=1)
            z = pa.array([press.compress(x) for x in batch.column("__text").to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("__doc"), batch.column("__th"), z], ["__doc", "__th", "__z"])

    return docs.mapInArrow(run, "__doc long, __th long, __z binary")


def dedup(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_bytes, n_removed, n_spans, kept_sha256), a row for each row of ``df``."""
    docs = df.select(
        F.coalesce(F.col(key).cast("long"), F.lit(_NULL)).alias("__doc"),
        F.xxhash64(whole(F.col(text))).alias("__th"),
        whole(F.col(text)).cast("binary").alias("__text"),
    )
    total = docs.agg(F.sum(F.octet_length("__text"))).first()[0] or 0
    spread = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(spread, -(-total // PER_PARTITION))
    dealt = _anchor_rows(docs, parts * 3).repartition(parts, "part").sortWithinPartitions("part")
    found = stage(_contexts(dealt), "contexts")
    texts = _compressed(docs)
    cut = _cut(_meet(texts, found.where("h is not null"), parts))
    shards = cut.repartition(parts, "h").sortWithinPartitions("h")
    none = [F.lit(None).cast(found.schema[n].dataType).alias(n) for n in ("h", "ahead")]
    sorted_ = _sorted_spans(shards).select("doc", "th", "lo", "size", *none)
    spans = found.where("h is null").unionByName(sorted_)
    return _finish(_meet(texts, spans, parts)).withColumnRenamed("doc_id", key)
