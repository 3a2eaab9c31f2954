"""Settings, checked when they are made."""

from __future__ import annotations

from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession

from judgeset import schemas

STRATEGIES = ("median", "average", "weightedaverage")


@dataclass(frozen=True)
class ModelSpec:
    id: str
    endpoint: str = "openrouter"
    label: str | None = None
    weight: int = 1
    input_price_per_1m: float = 0.0
    output_price_per_1m: float = 0.0
    max_tokens: int = 4096
    temperature: float = 0.7

    def __post_init__(self):
        if self.weight < 0:
            raise ValueError("a weight is 0 or more")


@dataclass(frozen=True)
class EnsembleConfig:
    enabled: bool = False
    num_judges: int = 3
    strategy: str = "median"
    disagreement_threshold: float = 0.15
    hierarchical: bool = False
    uncertain_range: tuple[float, float] = (0.4, 0.7)

    def __post_init__(self):
        if self.strategy not in STRATEGIES:
            raise ValueError(f"strategy is one of {STRATEGIES}")
        if self.num_judges < 1:
            raise ValueError("num_judges is 1 or more")


@dataclass(frozen=True)
class GenerationConfig:
    approval_threshold: float = 0.85
    responses_per_problem: int = 1
    include_rejected: bool = False
    track_costs: bool = True


def models_table(spark: SparkSession, models: list[ModelSpec]) -> DataFrame:
    """One row per model in the given order; as many rows as the user configured."""
    rows = [{"ordinal": i, **asdict(m)} for i, m in enumerate(models)]
    return spark.createDataFrame(rows, schemas.MODELS)


def total_weight(models: list[ModelSpec]) -> int:
    total = sum(m.weight for m in models)
    if total <= 0:
        raise ValueError("the weights of the models add up to 0")
    return total


def check_responses(n: int) -> int:
    if n < 2:
        raise ValueError("preference pairs need 2 responses or more per problem")
    return n
