"""Weights of forecasts; each function maps a DataFrame to one with a ``weight`` column."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

WeightFunction = Callable[[DataFrame], DataFrame]


def uniform(df: DataFrame) -> DataFrame:
    return df.withColumn("weight", F.lit(1.0))


def _nth(df: DataFrame, n: int, order: Column, tiebreak: list[str]) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("forecaster", "event_ticker").orderBy(order, *tiebreak))
    return df.withColumn("weight", F.when(place <= n, 1.0).otherwise(0.0))


def first_n(n: int, tiebreak: list[str]) -> WeightFunction:
    """Weight 1 for a forecaster's first ``n`` rounds of an event, else 0."""
    return lambda df: _nth(df, n, F.asc("round"), tiebreak)


def last_n(n: int, tiebreak: list[str]) -> WeightFunction:
    """Weight 1 for a forecaster's last ``n`` rounds of an event, else 0."""
    return lambda df: _nth(df, n, F.desc("round"), tiebreak)


def exponential(decay: float) -> WeightFunction:
    """Weight ``exp(-decay * time_rank)``."""
    return lambda df: df.withColumn("weight", F.exp(-decay * F.col("time_rank")))


def with_time_rank(df: DataFrame) -> DataFrame:
    """Adds ``time_rank``: 0 for a forecaster's latest round of an event, equal rounds sharing their mean rank."""
    same = F.count(F.lit(1)).over(Window.partitionBy("forecaster", "event_ticker", "round"))
    rank = F.rank().over(Window.partitionBy("forecaster", "event_ticker").orderBy(F.desc("round")))
    return df.withColumn("time_rank", rank + (same - 1) / 2.0 - 1)
