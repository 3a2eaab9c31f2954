"""Analysis of request logs: refusals and back-off."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def rate_limit_stats(log: DataFrame) -> DataFrame:
    """Per endpoint: requests, refusals (429), their share, seconds waited and distinct models."""
    n, refused = F.count(F.lit(1)), F.count_if(F.col("status") == 429)
    return log.groupBy("endpoint").agg(
        n.alias("requests"), refused.alias("rate_limited"), F.coalesce(F.try_divide(refused, n), F.lit(0.0)).alias("rate_limited_share"),
        (F.coalesce(F.sum("wait_ms"), F.lit(0)) / 1000.0).alias("wait_secs"), F.countDistinct("model").alias("models"),
    )


def backoff_timeline(log: DataFrame, cap: float = 60.0, chunk: str = "1 day") -> DataFrame:
    """Per request: refusals in a row of its model up to it, and the back-off in seconds after a refusal.

    A success (status below 400) starts anew; other failures change nothing. A model's log is cut into chunks of time,
    counted within each, and carried over from one chunk to the next through one row per chunk, so a busy model is not
    one task. Every row stays: null endpoints and models are keys like any other, requests without a time come first,
    in one chunk. Columns of log may have any names.
    """
    seconds = int(pd.Timedelta(chunk).total_seconds())
    at = F.coalesce(F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / F.lit(1_000_000 * seconds)), F.lit(-(2**62)))
    log = log.select(F.struct("endpoint", "model").alias("k"), at.alias("c"), F.struct("ts", "request_id").alias("o"), F.col("status").alias("s"), F.struct("*").alias("row"))
    order = W.partitionBy("k", "c").orderBy("o")
    upto = order.rowsBetween(W.unboundedPreceding, W.currentRow)
    ok, refused = F.col("s") < 400, F.col("s") == 429
    runs = log.withColumn("g", F.count_if(ok).over(upto))
    inner = W.partitionBy("k", "c", "g").orderBy("o").rowsBetween(W.unboundedPreceding, W.currentRow)
    runs = runs.withColumn("n", F.count_if(refused).over(inner))
    per = runs.groupBy("k", "c").agg(F.max("g").alias("oks"), F.max_by("n", "o").alias("tail"))
    # refusals brought into a chunk: the tails of the chunks since the last one with a success
    seen = W.partitionBy("k").orderBy("c").rowsBetween(W.unboundedPreceding, -1)
    per = per.withColumn("since", F.max(F.when(F.col("oks") > 0, F.col("c"))).over(seen))
    per = per.withColumn("all", F.coalesce(F.sum("tail").over(seen), F.lit(0)))
    before = per.select("k", F.col("c").alias("since"), F.col("all").alias("skip"))
    carried = per.join(before, ["k", "since"], "left").select("k", "c", (F.col("all") - F.coalesce("skip", F.lit(0))).alias("carry"))
    n = F.col("n") + F.when(F.col("g") == 0, F.col("carry")).otherwise(0)
    backoff = F.when(refused, F.least(F.pow(F.lit(2.0), n), F.lit(cap)))
    return runs.join(carried, ["k", "c"]).select("row.*", n.alias("consecutive_429"), backoff.alias("backoff_secs"))
