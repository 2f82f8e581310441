"""Secret scans: candidates by shape, judged by a random forest.

A candidate is a run of at least ``SHORTEST`` characters of ``[A-Za-z0-9+/_=.-]``
with a digit, inside one word of a text.  Each is described by its length, the
mixture of character kinds, the average log-probability of its character
transitions, the share of its letters that stands in dictionary pieces, whether
it looks like a path or a host, and its neighbouring words.

Transitions and dictionary are learned from all words of the whole corpus (a
count per distinct word, then per pair of characters).  The forest is trained
on distinct labelled findings with weights, at most ``sample`` of each class.  Every
labelled finding is shown twice, once with its neighbours blanked, so that the
forest also learns what the value alone says.

Where no labels are given, ``label_by_marker`` makes them: a value that an
assignment of a credential name precedes is a secret if it mixes letters and
digits; other candidates are none.

Defined results: null texts are empty; texts and tables without candidates give
no rows; equal rows give equal findings, null document ids are values.  If the
labels hold one class only, every candidate gets that class.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.staging import stage
from tidemark.llm.text import whole, words

SHORTEST = 12
SHAPE = rf"[A-Za-z0-9+/_=.-]{{{SHORTEST},}}"
#: Names of credentials, and signs that assign (fixed values).
NAMES = (
    "access_key api_key apikey auth authorization bearer client_secret credential credentials "
    "passphrase passwd password private_key pwd secret secret_key token"
).split()
SIGNS = ["=", ":", ":=", "=>", "->", "is"]
FEATURES = (
    "length digits uppers lowers marks changes transitions coverage path host named assigned quoted"
).split()
CONTEXT = ("named", "assigned", "quoted")


def candidates(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(__id, text_hash, at, value, before2, before, word): one row per word with a candidate."""
    w = df.select(
        F.col(f"`{key}`").alias("__id"),
        F.xxhash64(whole(F.col(f"`{text}`"))).alias("text_hash"),
        words(whole(F.col(f"`{text}`"))).alias("__w"),
    )
    each = w.select("__id", "text_hash", "__w", F.posexplode("__w").alias("at", "word"))
    at, w_ = F.col("at"), F.col("__w")
    each = each.where((F.length("word") >= SHORTEST) & F.col("word").rlike("[0-9]") & F.col("word").rlike(SHAPE))
    near = each.select(
        "__id",
        "text_hash",
        F.col("at").cast("long").alias("at"),
        "word",
        F.coalesce(F.get(w_, at - 1), F.lit("")).alias("before"),
        F.coalesce(F.get(w_, at - 2), F.lit("")).alias("before2"),
        F.explode(F.regexp_extract_all("word", F.lit(SHAPE), F.lit(0))).alias("value"),
    )
    return near.where(F.col("value").rlike("[0-9]"))


def dictionary(df: DataFrame, text: str = "text") -> DataFrame:
    """(term, n): every word of letters in the corpus, lower-cased, and how often it stands there."""
    w = df.select(F.explode(words(whole(F.col(f"`{text}`")))).alias("w"))
    # A word may have marks around it; inside it there are letters only.
    bare = F.btrim(F.col("w"), F.lit(".,;:!?\"'()[]{}*#%&$|"))
    counted = w.groupBy(bare.alias("w")).agg(F.count("*").alias("n"))
    counted = counted.where(F.col("w").rlike(r"^\p{L}{2,24}$"))
    return counted.groupBy(F.lower("w").alias("term")).agg(F.sum("n").alias("n"))


def transitions(terms: DataFrame) -> DataFrame:
    """(pair, log_p): how likely each character follows another in ordinary words."""
    pairs = terms.select(
        "n",
        F.explode(
            F.transform(F.sequence(F.lit(1), F.length("term") - 1), lambda i: F.col("term").substr(i, F.lit(2)))
        ).alias("pair"),
    )
    counts = pairs.groupBy("pair").agg(F.sum("n").alias("n"))
    first = counts.groupBy(F.substring("pair", 1, 1).alias("c")).agg(F.sum("n").alias("all"))
    joined = counts.join(first, F.substring("pair", 1, 1) == F.col("c"))
    return joined.select("pair", F.log(F.col("n") / F.col("all")).alias("log_p"))


def _share(pattern: str) -> Column:
    return F.length(F.regexp_replace("value", pattern, "")) / F.length("value")


def describe(found: DataFrame, terms: DataFrame, least: int = 5) -> DataFrame:
    """``found`` with FEATURES.  Values are looked up once each, however often they occur."""
    values = found.select("value").distinct()
    low = F.lower("value")
    pairs = values.select(
        "value",
        F.explode(
            F.transform(F.sequence(F.lit(1), F.length("value") - 1), lambda i: low.substr(i, F.lit(2)))
        ).alias("pair"),
    )
    # A pair that no word has is as likely as one in ten thousand.
    known = transitions(terms)
    flow = pairs.join(known, "pair", "left").groupBy("value").agg(
        F.avg(F.coalesce("log_p", F.lit(-9.2))).alias("transitions")
    )
    pieces = values.select(
        "value", F.explode(F.filter(F.split(low, r"[^\p{L}]+"), lambda p: F.length(p) >= 3)).alias("term")
    )
    usual = terms.where(F.col("n") >= least).select("term", F.lit(1).alias("usual"))
    covered = pieces.join(usual, "term").groupBy("value").agg(F.sum(F.length("term")).alias("covered"))
    looked = values.join(flow, "value", "left").join(covered, "value", "left")
    looked = looked.select(
        F.col("value").alias("__v"),
        F.coalesce("transitions", F.lit(-9.2)).alias("transitions"),
        (F.coalesce("covered", F.lit(0)) / F.length("value")).alias("coverage"),
    )
    joined = found.join(looked, F.col("value") == F.col("__v"), "left").drop("__v")
    kinds = F.regexp_replace(F.regexp_replace(F.regexp_replace("value", "[0-9]", "0"), "[a-z]", "a"), "[A-Z]", "A")
    changes = F.length(F.regexp_replace(kinds, r"(.)\1*", "x")) - 1
    bare = lambda c: F.btrim(F.lower(c), F.lit("\"'`:=(){}[],;<>-"))
    own_name = F.expr("substring_index(substring_index(word, value, 1), '=', 1)")
    signed = F.col("before").isin(SIGNS) | F.col("before").rlike("[:=]$")
    number = lambda c: c.cast("double")
    return joined.withColumns(
        {
            "length": number(F.length("value")),
            "digits": number(_share("[^0-9]")),
            "uppers": number(_share("[^A-Z]")),
            "lowers": number(_share("[^a-z]")),
            "marks": number(_share("[A-Za-z0-9]")),
            "changes": number(changes / F.length("value")),
            "path": number(F.col("value").rlike(r"^\.{0,2}/|/[^/]*/|\.[a-z]{2,4}$").cast("int")),
            "host": number((F.col("word").contains("@") | F.col("word").contains("://") | F.col("value").rlike(r"^[0-9.]+$|^([a-z0-9-]+\.)+[a-z]{2,}$")).cast("int")),
            "named": number((bare("before").isin(NAMES) | bare("before2").isin(NAMES) | bare(own_name).isin(NAMES)).cast("int")),
            "assigned": number((signed | F.col("word").rlike(r"^[A-Za-z_]+[:=]")).cast("int")),
            "quoted": number(F.col("word").rlike("^[^A-Za-z0-9]*[\"'`]").cast("int")),
        }
    )


def label_by_marker(described: DataFrame) -> DataFrame:
    """``described`` with ``label``: 1.0 for an assigned credential of mixed characters, else 0.0."""
    mixed = (F.col("digits") > 0) & (F.col("lowers") + F.col("uppers") > 0)
    secret = (F.col("named") == 1) & (F.col("assigned") == 1) & mixed & (F.col("host") == 0)
    return described.withColumn("label", F.when(secret, 1.0).otherwise(0.0))


def train(labelled: DataFrame, sample: int = 20_000, trees: int = 20, depth: int = 6, seed: int = 7):
    """A forest, or the only class there is; None for no rows.

    ``sample``: at most so many distinct findings of each class are used.  Equal ones are one,
    with their number as weight.  The sample is a priority sample: the smallest of hash / number,
    where a finding stands for as many as its number, and at least for the inverse of the bound.
    """
    alike = labelled.groupBy(*FEATURES, "label").agg(F.count("*").alias("n"))
    place = (F.pmod(F.xxhash64(*FEATURES, "label"), F.lit(2**52)) + 1) / F.lit(2.0**52)
    alike = stage(alike.withColumn("place", place / F.col("n")), "distinct-findings")
    classes = [r[0] for r in alike.select("label").distinct().limit(3).collect()]
    if len(classes) < 2:
        return classes[0] if classes else None
    picked = []
    for c in classes:
        few = alike.where(F.col("label") == c).orderBy("place").limit(sample)
        size, bound = few.agg(F.count("*"), F.max("place")).first()
        least = 1.0 / bound if size == sample else 0.0
        picked.append(few.withColumn("weight", F.greatest(F.col("n").cast("double"), F.lit(least))))
    few = reduce(DataFrame.unionAll, picked)
    # What was found more than once stays two rows: a node has two at least.
    times = F.least("n", F.lit(2)).cast("int")
    few = few.withColumn("weight", F.col("weight") / times).withColumn("__", F.explode(F.array_repeat(F.lit(1), times)))
    few = few.select(*FEATURES, "label", "weight")
    blank = few.withColumns({c: F.lit(0.0) for c in CONTEXT})
    rows = stage(few.unionByName(blank), "findings")
    both = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows)
    forest = RandomForestClassifier(
        numTrees=trees, maxDepth=depth, seed=seed, featureSubsetStrategy="onethird", minInstancesPerNode=2, weightCol="weight"
    )
    return forest.fit(both.select("features", "label", "weight"))


def judge(described: DataFrame, model, threshold: float = 0.5) -> DataFrame:
    """``described`` with ``score`` and ``secret``."""
    if model is None or isinstance(model, float):
        scored = described.withColumn("score", F.lit(model or 0.0))
    else:
        both = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(described)
        scored = model.transform(both).withColumn("score", F.element_at(vector_to_array("probability"), 2))
    return scored.withColumn("secret", F.col("score") >= threshold)


def scan(
    df: DataFrame, key: str = "doc_id", text: str = "text", labelled: DataFrame | None = None
) -> DataFrame:
    """(key, text_hash, at, value, score, secret): every candidate of every text.

    ``labelled``: described findings with a ``label``; None labels by marker.
    """
    terms = stage(dictionary(df, text), "dictionary")
    found = stage(candidates(df, key, text), "findings")
    described = stage(describe(found, terms), "described")
    model = train(label_by_marker(described) if labelled is None else labelled)
    judged = judge(described, model)
    return judged.select(F.col("__id").alias(key), "text_hash", "at", "value", F.round("score", 6).alias("score"), "secret")


def redact(df: DataFrame, key: str = "doc_id", text: str = "text", mask: str = "[SECRET]", size: str = "n_chars") -> DataFrame:
    """``df`` with secrets masked and ``size``, where it is there, set anew; all rows stay."""
    found = scan(df, key, text).where("secret")
    # The longest first, so that a value inside another one doesn't break it.
    order = F.sort_array(F.collect_set(F.struct(F.length("value").alias("n"), "value")), asc=False)
    bad = found.groupBy(F.col(key).alias("__bad"), F.col("text_hash").alias("__hash")).agg(order.alias("__values"))
    bad = stage(bad, "secrets")
    own = F.xxhash64(whole(F.col(f"`{text}`")))
    joined = df.join(bad, F.col(f"`{key}`").eqNullSafe(F.col("__bad")) & (own == F.col("__hash")), "left")
    masked = F.aggregate("__values", F.col(f"`{text}`"), lambda t, v: F.replace(t, v.value, F.lit(mask)))
    out = {text: F.when(F.col("__values").isNull(), F.col(f"`{text}`")).otherwise(masked)}
    if size in df.columns:
        kind = df.schema[size].dataType
        out[size] = F.when(F.col("__values").isNull(), F.col(f"`{size}`")).otherwise(F.length(masked).cast(kind))
    return joined.select(*[out.get(c, F.col(f"`{c}`")).alias(c) for c in df.columns])
