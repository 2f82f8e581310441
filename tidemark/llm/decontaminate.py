"""Benchmark decontamination: MinHash containment search, then exact containment.

An item leaks into a document that holds at least ``CONTAINED`` of the item's
distinct shingles (runs of five words; an item of fewer words is one shingle).
Words are runs of letters and digits, lower-cased; any other ASCII character
parts words.

Search.  Items are partitioned by size, the number q of their shingles.  A
document may miss at most m = q - ceil(0.8 q) of them, so it holds one at
least of any m + 1.  The item's sketch is the m + 1 shingles that the fewest
items have, of equally rare ones those with the smallest hashes: its length is fixed
by the size partition, and looking it up loses nothing.  A stem that many items share
is in a sketch only where an item has nothing else.  Banded sketches of whole documents
would need thousands of hashes to find 20 shingles among 20,000 and could still miss some.
A document with fewer shingles than a size partition asks for isn't compared with it.

Verification.  The distinct runs of the documents that were found are counted for each
candidate item that has them, as strings.

The texts are read once for all widths of shingles, and once more for the documents that
were found.  Sketches and item shingles are broadcast while they are under BROADCAST bytes, as
measured; a larger benchmark is joined by shuffles.  The rows of a document never
gather in one task: shingles are generated where the text is read, and what is
shuffled is one row per document and item that has a sketch hit, then one for each shingle of theirs.

Defined results: null texts are empty and leak nothing; items without words are
never found; repeated items (same id and text) count once, an id with several
texts has a row for each; each of several equal documents has its rows; a null
document id is a value.  Empty tables give an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions.staging import stage
from tidemark.llm.text import checked, whole

WORDS, CONTAINED = 5, 0.8


def plain_words(text: Column) -> Column:
    apart = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    # One blank at each end at most; the first split costs the most, so only one is made.
    spaced = F.trim(F.regexp_replace(F.lower(text), apart, " "))
    none = F.array().cast("array<string>")
    return F.when(spaced == "", none).otherwise(F.split(spaced, " "))


def shingles(w: Column, size: Column) -> Column:
    """Distinct runs of ``size`` words, in order."""
    runs = F.transform(
        F.sequence(F.lit(0), F.size(w) - size),
        lambda i: F.concat_ws(" ", F.slice(w, i + 1, size)),
    )
    none = F.array().cast("array<string>")
    return F.when(F.size(w) < size, none).otherwise(F.array_distinct(runs))


def run_hash(w: Column, at: Column, size: int) -> Column:
    return F.xxhash64(*[F.get(w, at + k) for k in range(size)])


def prepare(items: DataFrame, key: str = "item_id", text: str = "text") -> DataFrame:
    """A row for each shingle of each distinct item with words: its hash and run, and how many a leak needs of how many."""
    rows = items.select(F.col(key).alias("item_id"), whole(F.col(text)).alias("__t")).distinct()
    rows = rows.select(
        "item_id", F.xxhash64("item_id", "__t").alias("__item"), plain_words(F.col("__t")).alias("__w")
    )
    rows = rows.where(F.size("__w") > 0)
    rows = rows.withColumn("__n", F.least(F.lit(WORDS), F.size("__w")))
    rows = rows.withColumn("__shingles", shingles(F.col("__w"), F.col("__n")))
    q = F.size("__shingles")
    rows = rows.withColumns({"__q": q, "__need": F.ceil(q * CONTAINED - 1e-9).cast("int")})
    rows = rows.select("item_id", "__item", "__n", "__q", "__need", F.explode("__shingles").alias("__run"))
    # The hash of a document's run is of its words, so the words are hashed here too.
    words = F.split("__run", " ")
    hashed = run_hash(words, F.lit(0), WORDS)
    for n in range(1, WORDS):
        hashed = F.when(F.col("__n") == n, run_hash(words, F.lit(0), n)).otherwise(hashed)
    return stage(rows.withColumn("__hash", hashed), "items")


def sketches(items: DataFrame) -> DataFrame:
    """(width, hash, items): the rarest shingles of each item, as many as its size asks for."""
    shared = items.groupBy("__n", "__hash").agg(F.count("*").alias("__often"))
    w = W.partitionBy("__item").orderBy("__often", "__hash", "__run")
    ranked = items.join(shared, ["__n", "__hash"]).withColumn("__place", F.row_number().over(w))
    bottom = ranked.where(F.col("__place") <= F.col("__q") - F.col("__need") + 1)
    return bottom.groupBy("__n", "__hash").agg(F.collect_set(F.struct("__item", "__need")).alias("__items"))


def _runs(rows: DataFrame, widths: list[int]) -> DataFrame:
    """``rows`` (with __w, of which __size words) repeated for each run: __at, __n and __hash.

    Runs of a width that don't fit at a place have a null hash.
    """
    # No filter on the words: it would move below them and split the text twice.
    last = F.size("__w") - min(widths)
    places = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    at = rows.withColumn("__at", F.explode(places))
    fits = lambda n: F.when(F.col("__at") + n <= F.size("__w"), run_hash(F.col("__w"), F.col("__at"), n))
    if len(widths) == 1:
        return at.withColumns({"__n": F.lit(widths[0]), "__hash": fits(widths[0])})
    each = F.explode(F.array(*[F.struct(F.lit(n).alias("n"), fits(n).alias("h")) for n in widths]))
    return at.withColumn("__x", each).withColumns({"__n": F.col("__x.n"), "__hash": F.col("__x.h")}).drop("__x")


def candidates(docs: DataFrame, items: DataFrame, widths: list[int]) -> DataFrame:
    """(__id, __text_hash, __items): documents and the items that a sketch found in them.

    ``docs`` has __id and __text.
    """
    found = stage(sketches(items), "sketches")
    found = checked(found, F.size("__items") * 12 + 32).withColumnRenamed("__items", "__hits")
    w = docs.select("__id", F.xxhash64("__text").alias("__text_hash"), plain_words(F.col("__text")).alias("__w"))
    runs = _runs(w, widths).select("__id", "__text_hash", F.size("__w").alias("__size"), "__n", "__hash")
    hits = runs.join(found, ["__n", "__hash"]).select("__id", "__text_hash", "__size", "__n", F.explode("__hits").alias("__x"))
    hits = hits.where(F.col("__size") - (F.col("__n") - 1) >= F.col("__x.__need"))
    return hits.groupBy("__id", "__text_hash").agg(F.collect_set("__x.__item").alias("__items"))


def leaks(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text",
    item_key: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """(key, text_hash, item_id, n_shared, n_shingles) for each item that a document holds."""
    rows = docs.select(F.col(f"`{key}`").alias("__id"), whole(F.col(f"`{text}`")).alias("__text"))
    prepared = prepare(items, item_key, item_text)
    widths = sorted(r[0] for r in prepared.select("__n").distinct().collect()) or [WORDS]  # of 1 to 5
    found = stage(candidates(rows, prepared, widths), "candidates")
    found = checked(found, F.size("__items") * 8 + 32).withColumnsRenamed({"__id": "__cid", "__text_hash": "__chash"})
    same = F.col("__id").eqNullSafe(F.col("__cid")) & (F.xxhash64("__text") == F.col("__chash"))
    pairs = rows.join(found, same).select(
        "__id", "__chash", "__items", "__text", F.monotonically_increasing_id().alias("__row")
    )
    # Written, since the number of a row must not change.
    pairs = stage(pairs, "found")
    w = pairs.select("__id", "__chash", "__row", "__items", plain_words(F.col("__text")).alias("__w"))
    known = checked(prepared, F.length("__run") + 64)
    hits = _runs(w, widths).join(known, ["__n", "__hash"])
    equal = F.concat_ws(" ", F.slice("__w", F.col("__at") + 1, F.col("__n"))) == F.col("__run")
    hits = hits.where(F.array_contains("__items", F.col("__item")) & equal)
    of = ["__row", "__id", "__chash", "__item", "item_id", "__q", "__need"]
    shared = hits.select(*of, "__run").distinct().groupBy(*of).agg(F.count("*").alias("n_shared"))
    return shared.where(F.col("n_shared") >= F.col("__need")).select(
        F.col("__id").alias(key),
        F.col("__chash").alias("text_hash"),
        "item_id",
        "n_shared",
        F.col("__q").cast("long").alias("n_shingles"),
    )


def clean(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that no item leaks into, unchanged."""
    bad = stage(leaks(docs, items, key, text).select(F.col(key).alias("__bad"), F.col("text_hash").alias("__hash")).distinct(), "leaks")
    bad = checked(bad, F.lit(48))
    same = F.col(f"`{key}`").eqNullSafe(F.col("__bad")) & (
        F.xxhash64(whole(F.col(f"`{text}`"))) == F.col("__hash")
    )
    return docs.join(bad, same, "left_anti")
