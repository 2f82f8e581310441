"""Quality rules: fixed limits, then robust outliers of the statistics per language and source.

Every document becomes a vector of transformed statistics.  For each language
and source the minimum-covariance-determinant estimate is found by
concentration steps: the mean and covariance of the share of documents nearest to
the present estimate are the next estimate, until the determinant no longer falls.
There are two starts, medians with absolute deviations and medians with the
covariance of spatial signs (which knows correlations); the end of smaller
determinant counts.  A document is rejected where its squared Mahalanobis
distance is over a cut of the chi-square distribution.

A step is one aggregation: distances go into narrow buckets, moments are summed
per group and bucket (map-side first, so a hot source is a few hundred rows per
task), and running sums over buckets give the moments of the nearest share.  Both
starts of all groups step together, and a group that has come to rest drops out.
Estimates are broadcast while they are under BROADCAST bytes, so rows stay in place.

Defined results: a null text is empty (no words, so it fails the fixed limits);
null languages and sources are groups of their own; groups under ``least``
documents take the estimate of their language, and small languages that of all
documents; equal rows are judged alike and stay separate rows.  An empty table gives an
empty result.  Columns of the input that have the name of a result are replaced.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce
from statistics import NormalDist

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions.staging import stage
from tidemark.llm.text import BLANKS, checked, count_of, whole, without, words

SYMBOLS = "#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
DIMENSIONS = ("x_length", "x_word", "x_symbol", "x_repeat", "x_line")


@dataclass(frozen=True)
class Limits:
    """``share`` of a group that shapes its estimate; ``tail`` of clean rows beyond the cut.

    ``fall``: a group rests when a step lowers the logarithm of its determinant by no
    more.  The floors bound it from below, so that the steps end.
    ``floor``: least standard deviation of each dimension.  Most clean groups
    have no symbols and no repeated lines at all, and a rare symbol there must
    not make an outlier.
    """

    share: float = 0.75
    tail: float = 1e-9
    fall: float = 0.001
    least: int = 200
    min_words: int = 50
    max_repeat_pct: int = 50
    floor: tuple[float, ...] = (0.3, 0.05, 0.03, 0.12, 0.1)


def statistics(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` without its text, with the counts and ``base``."""
    kept = [c for c in df.columns if c not in (*COUNTS, text)]
    t = df.select(*[F.col(f"`{c}`") for c in kept], whole(F.col(f"`{text}`")).alias("__t"))
    lines = F.filter(F.split("__t", "\n"), lambda x: x.rlike(r"[^\x09-\x0D\x20]"))
    t = t.withColumns({"__w": words(F.col("__t")), "__l": lines})
    w, n = F.col("__w"), F.size("__w")
    windows = F.when(
        n >= 4,
        F.transform(
            F.sequence(F.lit(0), n - 3),
            lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)),
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    t = t.select(
        *[F.col(f"`{c}`") for c in kept],
        n.cast("long").alias("n_words"),
        F.length(without(F.col("__t"), BLANKS)).cast("long").alias("word_chars"),
        count_of(F.col("__t"), SYMBOLS).alias("n_symbols"),
        (F.size("__l") - F.size(F.array_distinct("__l"))).cast("long").alias("n_dup_lines"),
        windows.alias("__h"),
    )
    # Windows of three words that occur twice or more, by (hash, position) in
    # order: equal ones are neighbours.  Positions p cover min(3, next p - p) words.
    h = F.col("__h")
    ranked = F.when(
        F.size(F.array_distinct(h)) < F.size(h),
        F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))),
    )
    t = t.withColumn("__r", ranked).drop("__h")
    r = F.col("__r")
    near = F.filter(r, lambda x, k: (x.h == F.get(r, k - 1).h) | (x.h == F.get(r, k + 1).h))
    t = t.withColumn("__p", F.sort_array(F.transform(near, lambda x: x.i))).drop("__r")
    p = F.col("__p")
    steps = F.transform(p, lambda x, k: F.least(F.lit(3), F.coalesce(F.get(p, k + 1) - x, F.lit(3))))
    total = F.aggregate(steps, F.lit(0), lambda a, x: a + x)
    return t.select(
        *[F.col(f"`{c}`") for c in (*kept, *COUNTS[:-1])],
        F.coalesce(total, F.lit(0)).cast("long").alias("n_repeat_words"),
    )


def vector(df: DataFrame) -> DataFrame:
    """``df`` with the transformed statistics."""
    n = F.col("n_words") + 1.0
    share = lambda a, b: F.sqrt(F.col(a) / b)
    return df.withColumns(
        {
            "x_length": F.log(n),
            "x_word": F.log((F.col("word_chars") + 1.0) / n),
            "x_symbol": share("n_symbols", F.col("word_chars") + 1.0),
            "x_repeat": share("n_repeat_words", n),
            "x_line": share("n_dup_lines", n),
        }
    )


def _chi_square_below(x: float, d: int) -> float:
    """Share of the chi-square distribution with ``d`` degrees below ``x`` (gamma series)."""
    a, y = d / 2, x / 2
    term = total = 1 / a
    k = a
    while term > total * 1e-15:
        k += 1
        term *= y / k
        total += term
    return total * math.exp(a * math.log(y) - y - math.lgamma(a))


def chi_square_cut(tail: float, d: int) -> float:
    """Where the chi-square distribution leaves ``tail`` above (Wilson and Hilferty)."""
    z = NormalDist().inv_cdf(1 - tail)
    return d * (1 - 2 / (9 * d) + z * math.sqrt(2 / (9 * d))) ** 3


def consistency(share: float, d: int) -> float:
    """Factor that makes the covariance of the nearest ``share`` that of normal data."""
    return share / _chi_square_below(chi_square_cut(1 - share, d), d + 2)


def distance(names: tuple[str, ...]) -> Column:
    """Squared Mahalanobis distance by forward substitution with columns m_i and l_i_j."""
    z: list[Column] = []
    for i, name in enumerate(names):
        rest = F.col(name) - F.col(f"m_{i}")
        for j in range(i):
            rest = rest - F.col(f"l_{i}_{j}") * z[j]
        z.append(rest / F.col(f"l_{i}_{i}"))
    return sum((x * x for x in z[1:]), z[0] * z[0])


def _cholesky(cov: DataFrame, d: int) -> DataFrame:
    """Columns l_i_j of the lower factor of columns c_i_j; one column after another."""
    for j in range(d):
        rest = F.col(f"c_{j}_{j}")
        for k in range(j):
            rest = rest - F.col(f"l_{j}_{k}") * F.col(f"l_{j}_{k}")
        # The floors keep this positive; the guard is for rounding alone.
        cov = cov.withColumn(f"l_{j}_{j}", F.sqrt(F.greatest(rest, F.lit(1e-12))))
        for i in range(j + 1, d):
            rest = F.col(f"c_{i}_{j}")
            for k in range(j):
                rest = rest - F.col(f"l_{i}_{k}") * F.col(f"l_{j}_{k}")
            cov = cov.withColumn(f"l_{i}_{j}", rest / F.col(f"l_{j}_{j}"))
    return cov.drop(*[f"c_{i}_{j}" for i in range(d) for j in range(i + 1)])


def _pools(df: DataFrame, least: int) -> DataFrame:
    """``df`` with ``__pool``: language and source, language, or all, whichever is large enough."""
    lang, source = F.col("lang").cast("string"), F.col("source").cast("string")
    counts = df.groupBy(lang.alias("__lang"), source.alias("__source")).agg(F.count("*").alias("__n"))
    counts = counts.withColumn("__all", F.sum("__n").over(W.partitionBy("__lang")))
    mark = lambda c: F.coalesce(F.concat(F.lit("="), c), F.lit("null"))
    pool = (
        F.when(F.col("__n") >= least, F.concat_ws("\n", mark(F.col("__lang")), mark(F.col("__source"))))
        .when(F.col("__all") >= least, mark(F.col("__lang")))
        .otherwise("")
    )
    counts = stage(counts.select("__lang", "__source", pool.alias("__pool")), "pools")
    # A row for each language and source: rows with their texts stay where they are.
    counts = checked(counts, 2 * F.coalesce(F.length("__pool"), F.lit(0)) + 64)
    same = lang.eqNullSafe(F.col("__lang")) & source.eqNullSafe(F.col("__source"))
    return df.join(counts, same, "left").drop("__lang", "__source")


_KEY = ("__pool", "__start")
_SHAPE = (
    *(f"m_{i}" for i in range(len(DIMENSIONS))),
    *(f"l_{i}_{j}" for i in range(len(DIMENSIONS)) for j in range(i + 1)),
)


def _starts(df: DataFrame, limits: Limits) -> DataFrame:
    """Estimates to begin with: medians, and deviations (0) or the covariance of spatial signs (1)."""
    d = range(len(DIMENSIONS))
    mid = df.groupBy("__pool").agg(*[F.percentile_approx(x, 0.5).alias(f"m_{i}") for i, x in enumerate(DIMENSIONS)])
    mid = checked(stage(mid, "quality-medians"), F.lit(400))
    m = [f"m_{i}" for i in d]
    off = df.join(mid, "__pool").groupBy("__pool", *m).agg(
        *[F.percentile_approx(F.abs(F.col(x) - F.col(m[i])), 0.5).alias(f"s_{i}") for i, x in enumerate(DIMENSIONS)]
    )
    wide = [F.greatest(F.col(f"s_{i}") * 1.4826, F.lit(limits.floor[i])).alias(f"s_{i}") for i in d]
    off = stage(off.select("__pool", *m, *wide), "quality-deviations")
    plain = off.select(
        "__pool", F.lit(0).alias("__start"), *m,
        *[(F.col(f"s_{i}") if i == j else F.lit(0.0)).alias(f"l_{i}_{j}") for i in d for j in range(i + 1)],
    )
    z = [(F.col(x) - F.col(m[i])) / F.col(f"s_{i}") for i, x in enumerate(DIMENSIONS)]
    size = F.nullif(sum((x * x for x in z[1:]), z[0] * z[0]), F.lit(0.0))
    scales = [f"s_{i}" for i in d]
    signs = df.join(checked(off, F.lit(400)), "__pool").groupBy("__pool", *m, *scales).agg(
        *[F.coalesce(F.avg(z[i] * z[j] / size), F.lit(0.0)).alias(f"c_{i}_{j}") for i in d for j in range(i + 1)]
    )
    cov = {
        f"c_{i}_{j}": F.col(f"c_{i}_{j}") * F.col(f"s_{i}") * F.col(f"s_{j}") * len(DIMENSIONS)
        + (limits.floor[i] ** 2 if i == j else 0.0)
        for i in d for j in range(i + 1)
    }
    signs = signs.withColumns(cov).drop(*scales).withColumn("__start", F.lit(1))
    return plain.unionByName(_cholesky(signs, len(DIMENSIONS)))


def _volume() -> Column:
    """Logarithm of the determinant."""
    return 2 * sum((F.log(f"l_{i}_{i}") for i in range(1, len(DIMENSIONS))), F.log("l_0_0"))


def concentrated(df: DataFrame, limits: Limits) -> DataFrame:
    """(__pool, m_i, l_i_j): for each pool the estimate at rest of smaller determinant."""
    first = stage(_starts(df, limits), "quality-start")
    now = stage(_step(df, first, limits), "quality-estimate")
    rested = []
    while not now.isEmpty():
        before = now.select(*_KEY, _volume().alias("__before"), F.struct(*_SHAPE).alias("__was"))
        moved = _step(df, now, limits).withColumn("__now", _volume())
        both = stage(moved.join(before, list(_KEY)), "quality-estimate")
        falls = F.col("__now") < F.col("__before") - limits.fall
        better = F.when(F.col("__now") < F.col("__before"), F.struct(*_SHAPE)).otherwise(F.col("__was"))
        rested.append(
            both.where(~falls).select(*_KEY, F.least("__now", "__before").alias("__volume"), better.alias("__e"))
        )
        now = both.where(falls).select(*_KEY, *_SHAPE)
    if not rested:
        return first.select("__pool", *_SHAPE)
    ends = reduce(DataFrame.unionAll, rested)
    best = ends.groupBy("__pool").agg(F.min_by("__e", F.struct("__volume", "__start")).alias("__e"))
    return stage(best.select("__pool", "__e.*"), "quality-estimate")


def _step(df: DataFrame, estimate: DataFrame, limits: Limits) -> DataFrame:
    """The estimates from the share of each pool nearest to ``estimate``, a stage table."""
    d = len(DIMENSIONS)
    pairs = [(i, j) for i in range(d) for j in range(i + 1)]
    near = df.join(checked(estimate, F.lit(400)), "__pool").withColumn(
        "__bucket", F.floor(F.log2(distance(DIMENSIONS) + 1e-6) * 16).cast("int")
    )
    # Centred on the present estimate, so that the sums lose no digits.
    x = [F.col(n) - F.col(f"m_{i}") for i, n in enumerate(DIMENSIONS)]
    cells = near.groupBy(*_KEY, "__bucket", *[f"m_{i}" for i in range(d)]).agg(
        F.count("*").alias("n"),
        *[F.sum(x[i]).alias(f"s_{i}") for i in range(d)],
        *[F.sum(x[i] * x[j]).alias(f"q_{i}_{j}") for i, j in pairs],
    )
    up_to = W.partitionBy(*_KEY).orderBy("__bucket").rowsBetween(W.unboundedPreceding, -1)
    cells = cells.withColumns(
        {
            "before": F.coalesce(F.sum("n").over(up_to), F.lit(0)),
            "all": F.sum("n").over(W.partitionBy(*_KEY)),
        }
    ).where(F.col("before") < F.col("all") * limits.share)
    sums = cells.groupBy(*_KEY, *[f"m_{i}" for i in range(d)]).agg(
        F.sum("n").alias("n"),
        *[F.sum(f"s_{i}").alias(f"s_{i}") for i in range(d)],
        *[F.sum(f"q_{i}_{j}").alias(f"q_{i}_{j}") for i, j in pairs],
    )
    scale = consistency(limits.share, d)
    cov = {
        f"c_{i}_{j}": scale * (F.col(f"q_{i}_{j}") - F.col(f"s_{i}") * F.col(f"s_{j}") / F.col("n")) / F.col("n")
        + (limits.floor[i] ** 2 if i == j else 0.0)
        for i, j in pairs
    }
    moved = {f"m_{i}": F.col(f"m_{i}") + F.col(f"s_{i}") / F.col("n") for i in range(d)}
    wide = sums.withColumns({**cov, **moved})
    return _cholesky(
        wide.select(*_KEY, *[f"m_{i}" for i in range(d)], *[f"c_{i}_{j}" for i, j in pairs]), d
    )


def judge(df: DataFrame, text: str = "text", limits: Limits = Limits()) -> DataFrame:
    """``df`` without its text, with the counts, base_failed, ``distance`` and kept."""
    counted = stage(statistics(df.drop("base_failed", "distance", "kept"), text), "quality-counts")
    # The statistics are read again for every step: a narrow table of its own.
    rows = vector(_pools(counted, limits.least))
    seen = rows.where(F.col("n_words") > 0).select("__pool", *DIMENSIONS)
    estimate = concentrated(seen, limits)
    failed = (F.col("n_words") < limits.min_words) | (
        100 * F.col("n_repeat_words") > limits.max_repeat_pct * F.col("n_words")
    )
    cut = chi_square_cut(limits.tail, len(DIMENSIONS))
    known = checked(estimate, F.lit(400))
    judged = rows.join(known, "__pool", "left").withColumns(
        {"base_failed": failed, "distance": distance(DIMENSIONS)}
    )
    added = [c for c in judged.columns if c in DIMENSIONS or c.startswith(("m_", "l_"))]
    kept = ~F.col("base_failed") & (F.coalesce("distance", F.lit(0.0)) <= cut)
    clean = [c for c in counted.columns]
    return judged.withColumn("kept", kept).select(
        *[F.col(f"`{c}`") for c in clean], "base_failed", "distance", "kept"
    )


def keep(df: DataFrame, text: str = "text", limits: Limits = Limits()) -> DataFrame:
    """The rows of ``df`` that are kept, unchanged.

    Verdicts are found by row, not by key, so repeated and null keys do no harm.
    """
    # The row stays beside its statistics: joining it back would shuffle all texts.
    own = {c: F.col(f"`{c}`") for c in (text, "lang", "source")}
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("__row"), *[c.alias(n) for n, c in own.items()])
    return judge(rows, text, limits).where("kept").select("__row.*")
