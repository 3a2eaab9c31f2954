"""Quality rules: text statistics, plain limits, and robust multivariate outliers by minimum covariance determinant."""

from __future__ import annotations

from functools import reduce
from math import erfc, exp, pi, sqrt
from statistics import NormalDist

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from judgeset.llm._tables import Scratch, table

SPACE = "[\\x20\\x09-\\x0D]+"
SYMBOLS = "#*$%&|<>"
#: Measurement floors of the five transformed statistics: a group whose values all agree still has this much spread.
FLOORS = (0.5, 0.08, 0.6, 0.15, 0.8)
P = len(FLOORS)
#: Median of the chi-square distribution with five degrees of freedom.
CHI2_MEDIAN = 4.3515
VECTOR = [f"x{i}" for i in range(P)]
LOWER = [(i, j) for i in range(P) for j in range(i + 1)]


def text_statistics(df: DataFrame, text: str = "text") -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words (all long), from array functions of one row.

    A null text has no words. Words are runs of other characters than space and \\t to \\r. n_repeat_words counts the
    words inside five-word windows that occur twice or more in the text; windows are compared by 64-bit hash.
    """
    words = F.filter(F.split(F.coalesce(F.col(text), F.lit("")), SPACE), lambda w: w != "")
    hashed = df.withColumn("_h", F.transform(words, lambda w: F.xxhash64(w)))
    n = F.size("_h")
    windows = F.when(n >= 5, F.transform(F.sequence(F.lit(0), n - 5), lambda i: F.xxhash64(*[F.get("_h", i + k) for k in range(5)]))).otherwise(F.array().cast("array<bigint>"))
    lines = F.filter(F.split(F.coalesce(F.col(text), F.lit("")), "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    marked = hashed.withColumn("_w", windows).withColumn("_lines", lines)
    repeats = F.size(F.array_distinct("_w")) < F.size("_w")
    sorted_windows = F.sort_array(F.transform("_w", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    marked = marked.withColumn("_s", F.when(repeats, sorted_windows))
    same = lambda s, i: s["h"].eqNullSafe(F.get("_s", i - 1)["h"]) | s["h"].eqNullSafe(F.get("_s", i + 1)["h"])
    marked = marked.withColumn("_at", F.sort_array(F.transform(F.filter("_s", same), lambda s: s["i"])))
    covered = F.aggregate(F.transform("_at", lambda p, i: F.least(F.lit(5), F.coalesce(F.get("_at", i + 1) - p, F.lit(5)))), F.lit(0), lambda a, b: a + b)
    whole = F.coalesce(F.col(text), F.lit(""))
    return marked.select(
        *df.columns,
        n.cast("long").alias("n_words"),
        F.char_length(F.translate(whole, " \t\n\x0b\x0c\r", "")).cast("long").alias("word_chars"),
        (F.octet_length(whole) - F.octet_length(F.translate(whole, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        F.size("_lines").cast("long").alias("n_lines"),
    )


def base_failed(min_words: int = 10, repeat_percent: int = 20) -> Column:
    return (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > repeat_percent * F.col("n_words"))


def _vector() -> list[Column]:
    words, chars = F.col("n_words").cast("double"), F.col("word_chars").cast("double")
    return [
        F.log1p(words),
        F.log((chars + 1) / (words + 1)),
        F.log(F.lit(1e-3) + F.col("n_symbols") / (chars + 1)),
        F.sqrt(F.col("n_repeat_words") / F.greatest(words, F.lit(1.0))),
        F.log(F.lit(5e-2) + F.col("n_dup_lines") / F.greatest(F.col("n_lines").cast("double"), F.lit(1.0))),
    ]


def _distance() -> Column:
    """Squared Mahalanobis distance from the centre m and the inverse Cholesky factor w."""
    rows = [reduce(Column.__add__, [F.col(f"w{i}{j}") * (F.col(f"x{j}") - F.col(f"m{j}")) for j in range(i + 1)]) for i in range(P)]
    return reduce(Column.__add__, [r * r for r in rows])


def _factor(df: DataFrame, keys: list[str]) -> DataFrame:
    """From m and the covariance c (lower triangle): inverse Cholesky factor w and logdet. One row per group."""
    for i, j in LOWER:
        rest = reduce(Column.__add__, [F.col(f"l{i}{k}") * F.col(f"l{j}{k}") for k in range(j)], F.lit(0.0))
        value = F.col(f"c{i}{j}") + (F.lit(FLOORS[i] ** 2) if i == j else F.lit(0.0)) - rest
        df = df.withColumn(f"l{i}{j}", F.sqrt(F.greatest(value, F.lit(1e-12))) if i == j else value / F.col(f"l{j}{j}"))
    for i in range(P):
        for j in range(i, -1, -1):
            rest = reduce(Column.__add__, [F.col(f"l{i}{k}") * F.col(f"w{k}{j}") for k in range(j, i)], F.lit(0.0))
            df = df.withColumn(f"w{i}{j}", (F.lit(1.0) if i == j else -rest) / F.col(f"l{i}{i}"))
    logdet = reduce(Column.__add__, [F.log(F.col(f"l{i}{i}")) for i in range(P)]) * 2
    return df.select(*keys, *[f"m{i}" for i in range(P)], *[f"w{i}{j}" for i, j in LOWER], logdet.alias("logdet"))


def _moments(keys: list[str]) -> list[Column]:
    return [F.avg(f"x{i}").alias(f"m{i}") for i in range(P)] + [F.covar_pop(f"x{i}", f"x{j}").alias(f"c{i}{j}") for i, j in LOWER]


def chi2_cutoff(tail: float) -> float:
    """The number that a chi-square variable with P = 5 degrees of freedom exceeds with probability tail."""
    beyond = lambda x: erfc(sqrt(x / 2)) + sqrt(2 * x / pi) * exp(-x / 2) * (1 + x / 3)
    lo, hi = 0.0, 1400.0
    for _ in range(100):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if beyond(mid) > tail else (lo, mid)
    return hi


def _upper_quantile(tail: float) -> Column:
    """The quantile of tail, from the median and the upper quartile (q) of a variable whose cube root is normal."""
    normal = NormalDist().inv_cdf
    low, high = F.cbrt(F.get("q", 0)), F.cbrt(F.get("q", 1))
    return F.pow(low + F.lit(normal(1 - tail) / normal(0.75)) * (high - low), F.lit(3))


def mcd_outliers(
    df: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    groups: tuple[str, str] = ("lang", "source"),
    support: float = 0.75,
    steps: int = 4,
    tail: float = 1e-3,
) -> DataFrame:
    """Statistics of every row, base_failed, its squared robust distance, and kept.

    Rows that pass the plain limits are turned into five numbers (log words, log word length, log share of symbols,
    root of the share of repeated words, log share of repeated lines). For each language and source, location and
    scatter come from concentration steps: keep the support share of rows nearest to the present estimate, estimate
    again, steps times, from two starts (medians with median absolute deviations, and the spatial sign covariance);
    the start with the smaller determinant wins. Distances are scaled so that their median fits the chi-square law.
    Rows beyond limit, the distance that a share of tail of the ordinary rows should exceed, are rejected. Some of the
    numbers are one value in most texts, so distances spread more than a chi-square law of five degrees; but the cube
    root of a multiple of a chi-square variable is nearly normal whatever its degrees. So limit follows from the group's
    own median and upper quartile of cube roots, and is never below the chi-square quantile. A quarter of a group may be
    outliers without moving it far. Every pass is a partial aggregate over a narrow table; no group meets in a task.
    Quantiles are approximate (to 1 in 2,000 ranks) and may differ a little from run to run in large groups.

    Every group has its own estimate, whatever its size: the floors are part of the scatter, so it is regular even for a
    group of one row (distance 0, kept). distance is null where the plain limits failed. Null languages and sources are
    groups like any other. Repeated rows are judged like others; null or repeated ids are kept as they are. An empty
    table gives no rows. Input columns other than id, text and the two group columns are not read.
    """
    scratch = Scratch(df.sparkSession, "mcd")
    a, b = groups
    rows = df.select(F.col(id_col).alias("_id"), F.col(text).alias("_text"), F.to_json(F.struct(F.col(a).alias("a"), F.col(b).alias("b"))).alias("g"))
    stats = text_statistics(rows, "_text").drop("_text").withColumn("base_failed", base_failed())
    stats = stats.select("*", *[x.alias(f"x{i}") for i, x in enumerate(_vector())])
    stats = scratch.keep(stats, "stats")

    good = stats.filter(~F.col("base_failed"))
    vectors = good.select("g", *VECTOR)
    median = vectors.groupBy("g").agg(*[F.percentile_approx(f"x{i}", 0.5, 2000).alias(f"m{i}") for i in range(P)])
    median = scratch.keep(median, "median")
    centred = vectors.join(median, "g")
    spread = centred.groupBy("g").agg(*[F.percentile_approx(F.abs(F.col(f"x{i}") - F.col(f"m{i}")), 0.5, 2000).alias(f"s{i}") for i in range(P)])
    spread = scratch.keep(spread.join(median, "g"), "spread")
    scaled = [F.col(f"s{i}") * 1.4826 + FLOORS[i] for i in range(P)]
    z = [(F.col(f"x{i}") - F.col(f"m{i}")) / scaled[i] for i in range(P)]
    norm = F.greatest(reduce(Column.__add__, [v * v for v in z]), F.lit(1e-12))
    signs = vectors.join(spread, "g").groupBy("g").agg(*[F.avg(z[i] * z[j] / norm).alias(f"u{i}{j}") for i, j in LOWER])
    signs = signs.join(spread, "g").select("g", F.lit("sign").alias("start"), *[f"m{i}" for i in range(P)], *[(P * F.col(f"u{i}{j}") * scaled[i] * scaled[j]).alias(f"c{i}{j}") for i, j in LOWER])
    plain = spread.select("g", F.lit("mad").alias("start"), *[f"m{i}" for i in range(P)], *[((F.col(f"s{i}") * 1.4826) ** 2 if i == j else F.lit(0.0)).alias(f"c{i}{j}") for i, j in LOWER])
    estimate = scratch.keep(_factor(plain.unionByName(signs), ["g", "start"]), "estimate")

    for _ in range(steps):
        near = vectors.join(estimate, "g").select("g", "start", _distance().alias("d2")).groupBy("g", "start").agg(F.percentile_approx("d2", support, 2000).alias("limit"))
        bounded = scratch.keep(near.join(estimate, ["g", "start"]), "limit")
        inside = vectors.join(bounded, "g").filter(_distance() <= F.col("limit"))
        following = scratch.keep(_factor(inside.groupBy("g", "start").agg(*_moments([])), ["g", "start"]), "estimate")
        scratch.drop(estimate, bounded)
        estimate = following

    best = estimate.groupBy("g").agg(F.min_by(F.struct(*[c for c in estimate.columns if c != "g"]), F.struct("logdet", "start")).alias("e")).select("g", "e.*").drop("start", "logdet")
    middle = vectors.join(best, "g").groupBy("g").agg(F.percentile_approx(_distance(), [0.5, 0.75], 2000).alias("q"))
    scale = F.lit(CHI2_MEDIAN) / F.greatest(F.get("q", 0), F.lit(CHI2_MEDIAN / 4))
    final = scratch.keep(best.join(middle, "g").withColumn("scale", scale).withColumn("limit", F.greatest(F.col("scale") * _upper_quantile(tail), F.lit(chi2_cutoff(tail)))).drop("q"), "final")
    scratch.drop(estimate, median, spread)
    judged = stats.join(final, "g", "left").withColumn("distance", F.when(~F.col("base_failed"), _distance() * F.col("scale")))
    kept = ~F.col("base_failed") & F.coalesce(F.col("distance") <= F.col("limit"), F.lit(True))
    return judged.select(F.col("_id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept"), "distance", "limit")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mcd_outliers(table(spark, sf_dir, "documents"))
