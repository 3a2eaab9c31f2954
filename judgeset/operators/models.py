"""Choice and cost of models."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from judgeset.config import ModelSpec, total_weight
from judgeset.functions.names import unused
from judgeset.operators.prefix import running
from judgeset.sources.files import shared_path


def choose(slot: Column, models: list[ModelSpec]) -> Column:
    """The model whose cumulative weight is the first above slot (0 to total weight - 1), by binary search: as many
    comparisons as the number of models has digits, whatever they weigh. Null for a null slot."""
    total_weight(models)
    weighed = [m for m in models if m.weight > 0]
    ends = list(accumulate(m.weight for m in weighed))

    def among(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(weighed[lo].id)
        mid = (lo + hi) // 2
        return F.when(slot < F.lit(ends[mid]), among(lo, mid)).otherwise(among(mid + 1, hi))

    return F.when(slot.isNotNull(), among(0, len(weighed) - 1))


def assign_models(df: DataFrame, models: list[ModelSpec], ordinal: str | None = None, key: str = "id", method: str = "round_robin", out: str = "model", path: str | None = None) -> DataFrame:
    """Adds the model of each row: by ordinal mod total weight, or by a hash of key (method "hash", no pass over the
    data). Without an ordinal column the keys are numbered first; see with_ordinal. A null ordinal has no model; other
    columns are passed on, whatever their names."""
    total = total_weight(models)
    if len(models) == 1:
        return df.withColumn(out, F.lit(models[0].id))
    if method == "hash":
        return df.withColumn(out, choose(F.pmod(F.xxhash64(key), F.lit(total)), models))
    if ordinal is not None:
        return df.withColumn(out, choose(F.pmod(F.col(ordinal).cast("bigint"), F.lit(total)), models))
    numbered, name = with_ordinal(df, unused(df, "ordinal"), key, path)
    return numbered.withColumn(out, choose(F.pmod(F.col(name), F.lit(total)), models)).drop(name)


def with_ordinal(df: DataFrame, name: str = "ordinal", key: str = "id", path: str | None = None) -> tuple[DataFrame, str]:
    """df with its keys numbered from 0 in ascending order (null first), and the name of that column.

    The order of the keys alone decides, so numbers are the same on every run and however df is partitioned; rows of one
    key share a number. Only the keys are sorted, by ranges, and written with their parts under path (by default a new
    path in the shared folder), so that counts and numbers follow from one table; df is joined with them.
    """
    keys = df.select(F.col(key).alias("k")).distinct()
    numbers = running(keys, ["k"], {"n": F.lit(1).cast("bigint")}, path or shared_path(df.sparkSession, "ordinals"))
    k, n = unused(df, "k"), unused(df, "n")
    numbers = numbers.select(F.col("k").alias(k), (F.col("n") - 1).alias(n))
    joined = df.join(numbers, F.col(key).eqNullSafe(F.col(k)), "left")
    return joined.select(*[F.col(c) for c in df.columns if c != name], F.col(n).alias(name)), name


def weights(df: DataFrame, models: list[ModelSpec]) -> DataFrame:
    """(judge_model, weight); of repeated ids the last counts."""
    return df.sparkSession.createDataFrame(list({m.id: m.weight for m in models}.items()) or [("", 1)], "judge_model string, weight int")


def setting(model: Column | str, models: list[ModelSpec], field: str, kind: str) -> Column:
    """What is configured for each row's model, null for unknown ones; of repeated ids the last counts. Part of the plan
    itself, since there are only as many models as the user configured."""
    known = {m.id: getattr(m, field) for m in models}
    if not known:
        return F.lit(None).cast(kind)
    pairs = [c for i, v in known.items() for c in (F.lit(i), F.lit(v).cast(kind))]
    return F.create_map(*pairs)[F.col(model) if isinstance(model, str) else model]


def token_cost(tokens_in: Column, tokens_out: Column, price_in: Column, price_out: Column) -> Column:
    return (tokens_in / F.lit(1e6)) * price_in + (tokens_out / F.lit(1e6)) * price_out


def with_cost(df: DataFrame, models: list[ModelSpec], model: str = "model", out: str = "cost_usd") -> DataFrame:
    """Adds each row's cost by its model's prices; unknown models cost nothing."""
    price = lambda side: setting(model, models, f"{side}_price_per_1m", "double")
    cost = token_cost(F.coalesce("tokens_in", F.lit(0)), F.coalesce("tokens_out", F.lit(0)), price("input"), price("output"))
    return df.withColumn(out, F.coalesce(cost, F.lit(0.0)))


def cheapest_model(models: list[ModelSpec]) -> ModelSpec:
    if not models:
        raise ValueError("no models")
    return min(models, key=lambda m: m.input_price_per_1m + m.output_price_per_1m)


def endpoints(models: list[ModelSpec]) -> list[str]:
    return list(dict.fromkeys(m.endpoint for m in models))
