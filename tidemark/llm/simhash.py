"""SimHash near-duplicates: fingerprints, a Gray-order hierarchical index, components.

A fingerprint has 64 bits.  Two fingerprints are linked when they differ in at
most two bits; a component is what links join.

Search.  The 64 bits are four blocks.  Two linked fingerprints agree on two of
the blocks at least, so every distinct fingerprint is dealt to six tables, one
for each pair of blocks, by its bits there, and linked ones meet in one of them.
A group of fingerprints that meet is searched by an index: sorted by Gray rank,
cut into nodes of NODE neighbours, with upper nodes over nodes.  A node holds the
bits that all below it share and its parent does not; a search adds up the
differences on the way down and leaves a node when they are over two.

Skew.  Exact copies are one fingerprint.  A group of over HOT fingerprints is
dealt once more, three times, by parts of its other 32 bits, one of which must
agree as well; what meets then agrees on 42 bits or more, so that no group of
distinct fingerprints has more than 2**22.  A group gives out one link for each
member to the smallest one of its part, never all pairs.

Components of the links are found by alternating large-star and small-star
steps over stage tables, until nothing changes.

Defined results: a null text is empty; a text without words has fingerprint zero
and is linked like any other; rows with equal keys stay separate rows; where
all keys of a component are null, its id is null.  An empty table gives an empty
result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.staging import stage

WORDS, SEED, MOST = 3, 42, 2
NODE, HOT = 16, 50_000
_BLOCKS = [0xFFFF << (16 * i) for i in range(4)]
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def fingerprint(text: bytes, size: int = WORDS) -> int:
    """Bits that are set in over half of the hashes of all runs of ``size`` words."""
    import xxhash

    found = text.translate(_LOWER).split()
    if not found:
        return 0
    joined = b" ".join(found)
    if len(found) <= size:
        return xxhash.xxh64_intdigest(joined, SEED)
    lengths = np.fromiter(map(len, found), np.int64, len(found)) + 1
    ends = np.cumsum(lengths) - 1
    starts = ends - lengths + 1
    last = ends[size - 1 :].tolist()
    hashed = xxhash.xxh64_intdigest
    values = np.array([hashed(joined[a:b], SEED) for a, b in zip(starts.tolist(), last)], "<u8")
    count = np.zeros(64, np.int64)
    # Sums of at most 255 bits fit in a byte.
    for at in range(0, len(values), 255 * 64):
        bits = np.unpackbits(values[at : at + 255 * 64].view(np.uint8), bitorder="little")
        bits = bits.reshape(-1, 64)
        full = len(bits) // 255 * 255
        if full:
            count += bits[:full].reshape(-1, 255, 64).sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
        count += bits[full:].sum(axis=0, dtype=np.int64)
    return int(np.packbits(count * 2 > len(values), bitorder="little").view("<u8")[0])


def with_fingerprints(df: DataFrame, text: str = "text", keep_text: bool = False) -> DataFrame:
    """``df`` with ``__fp``, the fingerprint as a signed 64-bit integer."""
    fields = [f for f in df.schema.fields if keep_text or f.name != text]
    schema = T.StructType(fields + [T.StructField("__fp", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text)).cast(pa.binary())
            prints = np.array([fingerprint(x.as_py() or b"") for x in column], np.uint64)
            out = [batch.column(f.name) for f in fields] + [pa.array(prints.view(np.int64))]
            yield pa.RecordBatch.from_arrays(out, [f.name for f in schema.fields])

    return df.mapInArrow(run, schema)


# --- the index -----------------------------------------------------------------


def gray_rank(x: np.ndarray) -> np.ndarray:
    """Place of each word in the reflected Gray code."""
    for shift in (1, 2, 4, 8, 16, 32):
        x = x ^ (x >> np.uint64(shift))
    return x


class GrayIndex:
    """Levels of nodes over fingerprints in Gray order, the finest level first."""

    def __init__(self, prints: np.ndarray):
        self.prints = prints[np.argsort(gray_rank(prints), kind="stable")]
        mask = np.full(len(self.prints), np.uint64(2**64 - 1))
        pattern = self.prints
        levels = [(mask, pattern)]
        while len(pattern) > 1:
            begins = np.arange(0, len(pattern), NODE)
            one = np.bitwise_and.reduceat(pattern, begins)
            any_ = np.bitwise_or.reduceat(pattern, begins)
            mask = np.bitwise_and.reduceat(mask, begins) & ~(one ^ any_)
            pattern = one & mask
            levels.append((mask, pattern))
        # Bits that the parent holds are taken from the child.
        self.levels = []
        for level, (mask, pattern) in enumerate(levels):
            if level + 1 < len(levels):
                parent = np.repeat(levels[level + 1][0], NODE)[: len(mask)]
                mask = mask & ~parent
            self.levels.append((mask, pattern & mask))

    def search(self, queries: np.ndarray, most: int = MOST) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (place of query, place in ``prints``) of at most ``most`` differing bits."""
        top = len(self.levels[-1][0])
        who = np.repeat(np.arange(len(queries)), top)
        node = np.tile(np.arange(top), len(queries))
        seen = np.zeros(len(who), np.uint8)
        for level in range(len(self.levels) - 1, -1, -1):
            mask, pattern = self.levels[level]
            if level < len(self.levels) - 1:
                child = (node[:, None] * NODE + np.arange(NODE)).ravel()
                who, seen = np.repeat(who, NODE), np.repeat(seen, NODE)
                real = child < len(mask)
                who, node, seen = who[real], child[real], seen[real]
            seen = seen + np.bitwise_count((queries[who] ^ pattern[node]) & mask[node])
            near = seen <= most
            who, node, seen = who[near], node[near], seen[near]
        return who, node


def _parts(n: int, links: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The smallest member that each of ``n`` members is linked to, by any way."""
    label = np.arange(n)
    a = np.concatenate([x for x, _ in links]) if links else np.zeros(0, np.int64)
    b = np.concatenate([x for _, x in links]) if links else a
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        while (new[new] != new).any():
            new = new[new]
        if (new == label).all():
            return label
        label = new


def star(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(member, smallest member of its part) for all members but the smallest."""
    index = GrayIndex(prints)
    own = index.prints
    links = []
    for at in range(0, len(own), 1024):
        who, node = index.search(own[at : at + 1024])
        who = who + at
        up = who < node
        links.append((who[up], node[up]))
    label = _parts(len(own), links)
    far = label != np.arange(len(own))
    return own[far], own[label[far]]


def _dealt(prints: DataFrame) -> DataFrame:
    """(table, key, __fp): every fingerprint in each table it has to be searched in."""
    fp = F.col("__fp")
    signed = lambda m: m - 2**64 if m >= 2**63 else m
    bits = lambda m: fp.bitwiseAND(F.lit(signed(m)).cast("long"))
    pairs = [(i, j) for i in range(4) for j in range(i)]
    coarse = prints.select(
        "__fp",
        F.posexplode(F.array(*[bits(_BLOCKS[i] | _BLOCKS[j]) for i, j in pairs])).alias("table", "key"),
    )
    hot = coarse.groupBy("table", "key").count().where(F.col("count") > HOT).select("table", "key", F.lit(True).alias("hot"))
    marked = coarse.join(hot, ["table", "key"], "left")
    fine = []
    for i, j in pairs:
        low, high = (b for b in range(4) if b not in (i, j))
        rest = _BLOCKS[low] | _BLOCKS[high]
        at = [k for k in range(64) if rest >> k & 1]
        third = [sum(1 << k for k in part) for part in (at[:11], at[11:22], at[22:])]
        fine.append(F.array(*[bits(_BLOCKS[i] | _BLOCKS[j] | m) for m in third]))
    again = F.element_at(F.array(*fine), F.col("table") + 1)
    split = F.when(F.col("hot"), again).otherwise(F.array("key"))
    part = F.when(F.col("hot"), F.lit(1)).otherwise(F.lit(0))
    return marked.select("__fp", (F.col("table") * 4 + part).alias("table"), F.posexplode(split).alias("part", "key")).select(
        "__fp", (F.col("table") + F.when(F.col("table") % 4 > 0, F.col("part")).otherwise(0)).alias("table"), "key"
    )


def links(prints: DataFrame) -> DataFrame:
    """(a, b), a > b in signed order: links that join all linked fingerprints.

    ``prints``: distinct ``__fp``.
    """
    dealt = _dealt(prints).repartition("table", "key").sortWithinPartitions("table", "key")
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = [np.zeros(0, np.int64)] * 3  # the group that the last batch may have cut

        def found(table, key, fp, last: bool):
            edge = np.flatnonzero((table[1:] != table[:-1]) | (key[1:] != key[:-1])) + 1
            ends = [*edge.tolist(), len(fp)]
            begins = [0, *ends[:-1]]
            keep = begins[-1] if not last and len(fp) else len(fp)
            out_a, out_b = [], []
            for lo, hi in zip(begins, ends):
                if hi <= keep and hi - lo > 1:
                    x, y = star(fp[lo:hi].view(np.uint64))
                    out_a.append(x.view(np.int64))
                    out_b.append(y.view(np.int64))
            a = np.concatenate(out_a) if out_a else np.zeros(0, np.int64)
            b = np.concatenate(out_b) if out_b else a
            names = ["a", "b"]
            batch = pa.RecordBatch.from_arrays(
                [pa.array(np.maximum(a, b)), pa.array(np.minimum(a, b))], names
            )
            return batch, [x[keep:] for x in (table, key, fp)]

        for batch in batches:
            new = [batch.column(n).to_numpy(zero_copy_only=False).astype(np.int64) for n in ("table", "key", "__fp")]
            out, rest = found(*[np.concatenate(p) for p in zip(rest, new)], last=False)
            yield out
        yield found(*rest, last=True)[0]

    return dealt.mapInArrow(run, schema)


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node that each linked node reaches, for nodes that are no root."""
    now = stage(edges.where("a > b").distinct(), "links")
    mark = lambda df: df.agg(
        F.count("*"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0))
    ).first()
    was = mark(now)
    while True:
        both = now.select("a", "b").unionAll(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a > b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        # The node itself hangs on its least neighbour, and so do its other neighbours.
        small = large.join(least, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = stage(least.select("a", F.col("m").alias("b")).unionAll(small).distinct(), "links")
        is_ = mark(now)
        if is_ == was:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        was = is_


def roots(rows: DataFrame) -> DataFrame:
    """(__fp, root) for the distinct ``__fp`` of ``rows``, each with the root of its component."""
    prints = stage(rows.select("__fp").distinct(), "prints")
    found = components(links(prints))
    return prints.join(found, F.col("__fp") == F.col("node"), "left").select(
        "__fp", F.coalesce("root", "__fp").alias("root")
    )


def classes(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, fingerprint, component_id), a row for each row of ``df``."""
    rows = stage(with_fingerprints(df.select(key, text), text), "fingerprints")
    # Keys are met per fingerprint first: a group of copies is one row then.
    least = rows.groupBy("__fp").agg(F.min(key).alias("__least"))
    named = stage(least.join(roots(rows), "__fp"), "components")
    of_root = named.groupBy("root").agg(F.min("__least").alias("component_id"))
    named = named.join(of_root, "root").select("__fp", "component_id")
    return rows.join(named, "__fp").select(key, hexadecimal(F.col("__fp")).alias("fingerprint"), "component_id")


def hexadecimal(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def first_of_each(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each component: that of the smallest key; a null key comes last."""
    rows = with_fingerprints(df, text, keep_text=True).withColumn("__row", F.monotonically_increasing_id())
    rows = stage(rows, "fingerprints")
    order = F.struct(F.col(key).isNull().alias("n"), F.col(key).alias("k"), F.col("__row").alias("r"))
    least = rows.groupBy("__fp").agg(F.min(order).alias("__first"))
    named = least.join(roots(rows), "__fp")
    kept = named.groupBy("root").agg(F.min("__first").alias("__first")).select(F.col("__first.r").alias("__row"))
    return rows.join(kept, "__row", "left_semi").select(*[F.col(f"`{c}`") for c in df.columns])
