"""Quality classifier: a sparse ensemble of rules over text statistics.

Boosted trees are grown on a bounded sample of labelled documents.  Every path
from a root to a node is a rule, a conjunction of bounds on statistics.  A lasso
logistic regression over the rules gives most of them weight zero; the others
become one Spark column expression, so that scoring is a narrow projection
with no model object.

Statistics come from the text alone, in one pass over the whole corpus, staged
as a narrow table; training joins labels with that table.

Defined results: a null text is empty and is scored like any other; labels that
are null or neither 0 nor 1 are skipped; several labels of one document all
count; with labels of one class only, the score is that class's; with none it
is 0.5.  Rows with equal or null keys stay separate rows.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.staging import stage
from tidemark.llm.text import count_of, whole, words

STATISTICS = (
    "f_words f_word_length f_longest f_distinct f_capitals f_digits f_symbols f_bars f_shouts "
    "f_stops f_line_words f_same_lines f_first_capitals"
).split()


@dataclass(frozen=True)
class Fit:
    """``sample``: most labelled documents used for fitting, of each class; the rest are left out
    by the order of a hash of the statistics.  The other values shape trees and lasso."""

    sample: int = 10_000
    trees: int = 12
    depth: int = 3
    lasso: float = 0.002
    seed: int = 11


def statistics(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` without its text, with STATISTICS (doubles, finite for every text)."""
    kept = [F.col(f"`{c}`") for c in df.columns if c not in (text, *STATISTICS)]
    t = df.select(*kept, whole(F.col(f"`{text}`")).alias("__t"))
    t = t.withColumns({"__w": words(F.col("__t")), "__l": F.filter(F.split("__t", "\n"), lambda x: x != "")})
    w, n = F.col("__w"), F.size("__w")
    text_, size = F.col("__t"), F.length("__t")
    capitals = size - F.length(F.translate(text_, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    per_char = lambda c: c / F.greatest(size, F.lit(1))
    per_word = lambda c: c / F.greatest(n, F.lit(1))
    lines = F.size("__l")
    number = {
        "f_words": F.log(n + F.lit(1.0)),
        "f_word_length": per_word(size),
        "f_longest": F.log(F.coalesce(F.array_max(F.transform(w, F.length)), F.lit(0)) + F.lit(1.0)),
        "f_distinct": per_word(F.size(F.array_distinct(w))),
        "f_capitals": per_char(capitals),
        "f_digits": per_char(count_of(text_, "0123456789")),
        "f_symbols": per_word(count_of(text_, "#*$%&<>{}^~\\")),
        "f_bars": per_word(count_of(text_, "|")),
        "f_shouts": per_word(count_of(text_, "!?")),
        "f_stops": per_word(count_of(text_, ".")),
        "f_line_words": F.log(n / F.greatest(lines, F.lit(1)) + F.lit(1.0)),
        "f_same_lines": F.lit(1.0) - F.size(F.array_distinct("__l")) / F.greatest(lines, F.lit(1)),
        "f_first_capitals": per_char(capitals) * per_word(size),
    }
    return t.select(*kept, *[number[c].cast("double").alias(c) for c in STATISTICS])


Bound = tuple[str, str, float]  # statistic, "<=" or ">", value


def paths(description: str) -> list[tuple[Bound, ...]]:
    """Rules of a tree ensemble, from its printed form: the way to every node but the roots.

    Bounds on one statistic in one direction are joined to the narrowest.
    """
    line = re.compile(r"^(\s*)(If|Else) \(feature (\d+) (<=|>) (\S+)\)")
    way: list[tuple[int, Bound]] = []
    rules: dict[tuple[Bound, ...], None] = {}
    for found in filter(None, map(line.match, description.splitlines())):
        depth = len(found[1])
        while way and way[-1][0] >= depth:
            way.pop()
        way.append((depth, (STATISTICS[int(found[3])], found[4], float(found[5]))))
        tight: dict[tuple[str, str], float] = {}
        for _, (name, sign, value) in way:
            pick = min if sign == "<=" else max
            tight[name, sign] = pick(value, tight.get((name, sign), value))
        rules[tuple(sorted((name, sign, value) for (name, sign), value in tight.items()))] = None
    return list(rules)


def holds(rule: tuple[Bound, ...]) -> Column:
    one = [F.col(n) <= v if sign == "<=" else F.col(n) > v for n, sign, v in rule]
    return reduce(lambda a, b: a & b, one)


@dataclass(frozen=True)
class Ensemble:
    """Weighted rules and an intercept; ``fixed`` is the score where there is nothing to learn."""

    rules: tuple[tuple[tuple[Bound, ...], float], ...] = ()
    intercept: float = 0.0
    fixed: float | None = None

    def score(self) -> Column:
        if self.fixed is not None:
            return F.lit(self.fixed)
        sums = [F.when(holds(rule), F.lit(w)).otherwise(F.lit(0.0)) for rule, w in self.rules]
        # A tree of sums: a chain of hundreds would be a deep expression.
        while len(sums) > 1:
            sums = [reduce(lambda a, b: a + b, sums[i : i + 2]) for i in range(0, len(sums), 2)]
        raw = F.lit(self.intercept) + (sums[0] if sums else F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-raw))


def fit(labelled: DataFrame, label: str = "label", how: Fit = Fit()) -> Ensemble:
    """``labelled``: STATISTICS and a label of 0 or 1; other rows are skipped."""
    rows = labelled.where(F.col(label).isin(0, 1)).select(*STATISTICS, F.col(label).cast("double").alias("label"))
    order = F.xxhash64(*STATISTICS)
    few = rows.where("label = 0").orderBy(order).limit(how.sample).unionAll(
        rows.where("label = 1").orderBy(order).limit(how.sample)
    )
    few = stage(few, "rule-sample")
    classes = [r[0] for r in few.select("label").distinct().collect()]
    if len(classes) < 2:
        return Ensemble(fixed=float(classes[0]) if classes else 0.5)
    vector = VectorAssembler(inputCols=list(STATISTICS), outputCol="features").transform(few)
    trees = GBTClassifier(maxIter=how.trees, maxDepth=how.depth, stepSize=0.3, seed=how.seed)
    rules = paths(trees.fit(vector.select("features", "label")).toDebugString)
    if not rules:
        share = few.agg(F.avg("label")).first()[0]
        return Ensemble(fixed=float(share))
    named = few.select("label", *[holds(r).cast("double").alias(f"r{i}") for i, r in enumerate(rules)])
    ruled = VectorAssembler(inputCols=[f"r{i}" for i in range(len(rules))], outputCol="features").transform(named)
    lasso = LogisticRegression(elasticNetParam=1.0, regParam=how.lasso, maxIter=60, standardization=False)
    model = lasso.fit(ruled.select("features", "label"))
    weighted = [(r, float(w)) for r, w in zip(rules, model.coefficients.toArray()) if w != 0]
    return Ensemble(tuple(weighted), float(model.intercept))


def classify(
    df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
    folds: int = 5, threshold: float = 0.3, how: Fit = Fit(),
) -> DataFrame:
    """(key, held_out, score, predicted): every row of ``df``.

    Labels of documents whose crc32(key) is a multiple of ``folds`` are never
    used; a null key counts as the empty text.
    """
    rows = stage(statistics(df.select(key, text), text), "statistics")
    # One fold by the same text of the key on both sides.
    held = lambda c: F.crc32(F.coalesce(F.col(c).cast("string"), F.lit("")).cast("binary")) % folds == 0
    known = labels.select(F.col(key).alias("__key"), F.col(label).alias("label")).where(~held("__key"))
    learn = rows.join(known, F.col(key) == F.col("__key"))
    score = fit(learn, "label", how).score()
    scored = rows.select(key, held(key).alias("held_out"), F.round(score, 9).alias("score"))
    return scored.withColumn("predicted", F.when(F.col("score") >= threshold, 1).otherwise(0))
