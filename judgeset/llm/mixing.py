"""Mixing sources to target weights: temperature weights, realised as budgeted block permutations."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from judgeset.llm._tables import Scratch, fresh, table

#: The exponent is a multiple of 1 / GRID between 0 (equal weights) and 1 (the sources' own shares).
GRID = 10_000
WORD = "[^\\x20\\x09-\\x0D]+"


@dataclass(frozen=True)
class Target:
    """What the exponent is bisected for: an entropy in nats, or the most repetitions of any source.

    budget is in tokens; None means the smallest budget at which every source is seen once in full.
    """

    max_repeats: float | None = 2.0
    entropy: float | None = None
    budget: int | None = None


def token_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def _key(source: Column) -> Column:
    """Null sources are a source like any other."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(""))


def _hash(value: Column, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}|"), value).cast("binary"))


def _number(h: Column) -> Column:
    """The first 32 bits of a hexadecimal hash."""
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("long")


def temperature(shares: DataFrame, target: Target) -> float:
    """The smallest exponent whose repetitions stay within the limit, or whose entropy does not exceed the target.

    shares has a row per source with its tokens. Both measures fall as the exponent rises, so the grid is bisected in
    sixteenths: each pass is one small aggregate over sources, whatever their number. 1 if no exponent meets the target.
    """
    lo, hi = -1, GRID  # lo does not meet the target, hi is taken to
    top = F.max("tokens")
    while hi - lo > 1:
        tries = sorted({lo + max(1, (hi - lo) * k // 16) for k in range(1, 16)} | {hi - 1} - {lo, hi})
        tries = [t for t in tries if lo < t < hi]
        grid = shares.select(F.col("tokens").cast("double").alias("tokens"), F.explode(F.array(*[F.lit(t) for t in tries])).alias("t")).withColumn("w", F.pow("tokens", F.col("t") / GRID))
        sums = grid.groupBy("t").agg(F.sum("w").alias("z"), F.sum(F.col("w") * F.log("w")).alias("wlog"), top.alias("most"), F.min("tokens").alias("least"))
        a = F.col("t") / GRID
        budget = F.lit(float(target.budget)) if target.budget is not None else F.col("z") * F.pow(F.col("most"), 1 - a)
        if target.entropy is not None:
            good = (F.log("z") - F.col("wlog") / F.col("z")) <= target.entropy
        else:
            good = budget / F.col("z") * F.pow(F.col("least"), a - 1) <= F.lit(float(target.max_repeats)) + 1e-9
        met = sorted(r["t"] for r in sums.filter(good).select("t").collect())  # at most 16 numbers
        hi_new = met[0] if met else hi
        lo = max([t for t in tries if t < hi_new], default=lo)
        hi = hi_new
    return hi / GRID


def mix_sources(df: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text", target: Target = Target(), seed: int = 0) -> DataFrame:
    """df with tokens and copies (long): how often a document is to be seen in the mixture. No row is left out.

    A source's weight is its token share to the exponent of temperature(). budget * weight tokens make a number of
    whole passes over the source and a rest. A source is dealt by hash into about as many blocks as the root of its
    number of documents; the rest takes blocks in a hashed order while they fit, and of the first block that does not
    fit documents in hashed order while they fit. Totals per block and one row per source decide all of it, so no
    source has to meet in one task, and the same documents are chosen on every run.

    Null texts have no tokens; sources without tokens are seen once. Null sources are one source. Rows that repeat an
    id are decided alike; null ids hash like the word null. Columns of df called tokens or copies are replaced, all
    others are passed on. An empty table gives no rows.
    """
    scratch = Scratch(df.sparkSession, "mixing")
    id_hash = _hash(F.coalesce(F.col(doc_id).cast("string"), F.lit("null")), seed)
    # nothing but these three goes into the plan, however long the texts are
    narrow = scratch.keep(df.select(_key(F.col(source)).alias("k"), id_hash.alias("h"), token_count(F.col(text)).alias("n")), "tokens")
    shares = scratch.keep(narrow.groupBy("k").agg(F.sum("n").alias("tokens"), F.count(F.lit(1)).alias("docs")).filter("tokens > 0"), "shares")
    alpha = temperature(shares, target)

    sums = shares.agg(F.sum(F.pow(F.col("tokens").cast("double"), F.lit(alpha))).alias("z"), F.max("tokens").alias("most")).first()
    z, most = (sums["z"] or 1.0), float(sums["most"] or 1)
    budget = float(target.budget) if target.budget is not None else z * most ** (1 - alpha)
    wanted = F.lit(budget / z) * F.pow(F.col("tokens").cast("double"), F.lit(alpha))
    plan = shares.withColumn("passes", wanted / F.col("tokens")).withColumn("whole", F.floor(F.col("passes") + 1e-9))
    plan = plan.withColumn("rest", F.greatest(wanted - F.col("whole") * F.col("tokens"), F.lit(0.0))).withColumn("blocks", F.ceil(F.sqrt(F.col("docs").cast("double"))).cast("long"))

    block = F.pmod(_number(F.col("h")), F.col("blocks"))
    place = _hash(F.concat("k", F.lit("|"), F.col("block").cast("string")), seed)
    dealt = narrow.join(plan.select("k", "blocks", "rest"), "k").withColumn("block", block)
    per_block = dealt.groupBy("k", "block", "rest").agg(F.sum("n").alias("n")).withColumn("place", place)
    upto = F.sum("n").over(W.partitionBy("k").orderBy("place", "block"))
    ordered = per_block.withColumn("before", upto - F.col("n"))
    cut = scratch.keep(ordered.filter("before + n > rest").groupBy("k").agg(F.min(F.struct("place", "block", "before", "rest")).alias("c")).select("k", "c.*"), "cut")
    inside = narrow.join(plan.select("k", "blocks"), "k").withColumn("block", block).join(cut, ["k", "block"])
    same = inside.groupBy("k", "h", "before", "rest").agg(F.sum("n").alias("n"))
    last = same.withColumn("upto", F.col("before") + F.sum("n").over(W.partitionBy("k").orderBy("h"))).filter("upto <= rest").groupBy("k").agg(F.max("h").alias("last"))
    own = ("k", "whole", "blocks", "place", "block", "last")
    k, whole, blocks, cut_place, cut_block, last_h, h = fresh(df, *own, "h")
    decided = plan.select("k", "whole", "blocks").join(cut.select("k", "place", "block"), "k", "left").join(last, "k", "left")
    decided = scratch.keep(decided.select(*[F.col(x).alias(y) for x, y in zip(own, (k, whole, blocks, cut_place, cut_block, last_h), strict=True)]), "decided")

    out = df.withColumn(k, _key(F.col(source))).withColumn(h, id_hash).join(decided, k, "left")
    my_block = F.pmod(_number(F.col(h)), F.col(blocks))
    my_place = _hash(F.concat(k, F.lit("|"), my_block.cast("string")), seed)
    extra = F.when(F.col(cut_place).isNull() | (my_place < F.col(cut_place)), 1).when((my_block == F.col(cut_block)) & (F.col(h) <= F.col(last_h)), 1).otherwise(0)
    copies = F.when(F.col(whole).isNull(), F.lit(1)).otherwise(F.col(whole) + extra).cast("long")
    out = out.select(*df.columns, token_count(F.col(text)).alias(counted := fresh(df, "tokens")[0]), copies.alias(times := fresh(df, "copies")[0]))
    return out.select(*[c for c in df.columns if c.lower() not in ("tokens", "copies")], F.col(counted).alias("tokens"), F.col(times).alias("copies"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents")).select("doc_id", "source", "tokens", "copies")


OP7_SQL = f"""
WITH docs AS (
  SELECT doc_id, source, coalesce('=' || source, '') AS k, md5('0|' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS h,
    len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS n FROM documents),
shares AS (SELECT k, sum(n)::DOUBLE AS tokens, count(*) AS docs FROM docs GROUP BY k HAVING sum(n) > 0),
grid AS (
  SELECT t, sum(pow(tokens, t / {GRID}.0)) AS z, max(tokens) AS most, min(tokens) AS least
  FROM shares, range(0, {GRID} + 1) AS r(t) GROUP BY t),
a AS (
  SELECT coalesce(min(t) FILTER (WHERE pow(most, 1 - t / {GRID}.0) * pow(least, t / {GRID}.0 - 1) <= 2 + 1e-9), {GRID}) / {GRID}.0 AS a FROM grid),
sums AS (SELECT a, sum(pow(tokens, a)) AS z, max(tokens) AS most FROM shares, a GROUP BY a),
plan AS (
  SELECT k, tokens, w, floor(w / tokens + 1e-9) AS whole, greatest(w - floor(w / tokens + 1e-9) * tokens, 0) AS rest, CAST(ceil(sqrt(docs)) AS BIGINT) AS blocks
  FROM (SELECT k, tokens, docs, pow(most, 1 - a) * pow(tokens, a) AS w FROM shares, sums)),
dealt AS (
  SELECT d.*, p.whole, p.rest, p.blocks, CAST('0x' || substr(h, 1, 8) AS BIGINT) % p.blocks AS block FROM docs d LEFT JOIN plan p USING (k)),
placed AS (SELECT *, md5('0|' || k || '|' || CAST(block AS VARCHAR)) AS place FROM dealt),
blocks AS (SELECT k, block, place, rest, sum(n) AS n FROM placed WHERE blocks IS NOT NULL GROUP BY ALL),
ordered AS (SELECT *, sum(n) OVER (PARTITION BY k ORDER BY place, block) - n AS before FROM blocks),
cut AS (SELECT k, arg_min(block, place) AS block, min(place) AS place, arg_min(before, place) AS before, arg_min(rest, place) AS rest FROM ordered WHERE before + n > rest GROUP BY k),
last AS (
  SELECT k, max(h) AS last FROM (
    SELECT k, h, rest, before + sum(n) OVER (PARTITION BY k ORDER BY h) AS upto
    FROM (SELECT p.k, p.h, c.rest, c.before, sum(p.n) AS n FROM placed p JOIN cut c ON p.k = c.k AND p.block = c.block GROUP BY ALL))
  WHERE upto <= rest GROUP BY k)
SELECT p.doc_id, p.source, CAST(p.n AS BIGINT) AS tokens,
  CAST(CASE WHEN p.whole IS NULL THEN 1 ELSE p.whole + CASE WHEN c.place IS NULL OR p.place < c.place OR (p.block = c.block AND p.h <= l.last) THEN 1 ELSE 0 END END AS BIGINT) AS copies
FROM placed p LEFT JOIN cut c ON p.k = c.k LEFT JOIN last l ON p.k = l.k
"""
