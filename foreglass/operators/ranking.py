"""Leaderboards, market baselines and bootstrap intervals."""

from __future__ import annotations

from math import ceil

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from foreglass.functions.vectors import market_view

#: Score columns in the order in which they are looked for, and whether the lower is the better.
SCORES = {"brier_score": True, "average_return": False, "ece_score": True, "sharpe_ratio": False}
#: Name of the forecaster that stands for the market.
BASELINE = "market-baseline"


def score_column(df: DataFrame) -> str:
    for name in SCORES:
        if name in df.columns:
            return name
    raise ValueError(f"none of {list(SCORES)} among the columns")


def rank_forecasters(df: DataFrame, score: str | None = None, by_round: bool = False, interval: dict | None = None) -> DataFrame:
    """``(rank, forecaster, score[, ci])``: forecasters by weighted mean score, equal scores sharing the smallest rank.

    With ``by_round`` a row's weight is divided by the forecaster's rows of
    the event, so that every event counts the same. ``interval`` holds the
    options of ``bootstrap``, which must not be asked for calibration errors
    and Sharpe ratios: those are one number for each forecaster already.
    Null scores and weights are left out; a forecaster whose weights sum to
    zero has a null score and comes last.
    """
    score = score or score_column(df)
    if interval is not None and score in ("ece_score", "sharpe_ratio"):
        raise ValueError(f"no interval for {score}")
    if "weight" not in df.columns:
        df = df.withColumn("weight", F.lit(1.0))
    rows = df.filter(F.col(score).isNotNull() & F.col("weight").isNotNull() & F.col("forecaster").isNotNull())
    if by_round:
        # the sums of an event first, divided by its number of rows
        rows = rows.groupBy("forecaster", "event_ticker").agg((F.sum(F.col("weight") * F.col(score)) / F.count(F.lit(1))).alias("ws"), (F.sum("weight") / F.count(F.lit(1))).alias("w"))
    else:
        rows = rows.select("forecaster", (F.col("weight") * F.col(score)).alias("ws"), F.col("weight").alias("w"))
    means = rows.groupBy("forecaster").agg(F.try_divide(F.sum("ws"), F.sum("w")).alias("score"))
    order = F.asc_nulls_last("score") if SCORES[score] else F.desc_nulls_last("score")
    # one row for each forecaster: far fewer than rows, and ranked in one window as the report needs it
    ranked = means.select(F.rank().over(Window.orderBy(order)).alias("rank"), "forecaster", "score")
    if interval is None:
        return ranked
    margins = bootstrap(df, score, **interval)
    level = interval.get("level", 0.9)
    return ranked.join(margins, "forecaster", "left").select("rank", "forecaster", "score", F.format_string("±%.4f", "margin").alias(f"{level:.1%} ci"))


def bootstrap(df: DataFrame, score: str, n: int = 1000, level: float = 0.9, num_se: float | None = None, seed: int = 42, grid: float = 1e-6) -> DataFrame:
    """``(forecaster, margin, standard_error)`` of the weighted mean score by resampling each forecaster's rows.

    A resample draws a forecaster's rows with probability proportional to
    their weight and takes the weighted mean. The margin is ``num_se`` times
    the standard error or, without it, the smallest deviation that covers
    ``level`` of the resamples. Rows are first counted by score, rounded to
    ``grid``, and weight; resampling counts gives the same distribution as
    resampling rows, and what gathers for a forecaster is bounded by the grid
    and its distinct weights, not by its rows. Forecasters without weight have
    a null margin.
    """
    if "weight" not in df.columns:
        df = df.withColumn("weight", F.lit(1.0))
    rows = df.select("forecaster", F.col(score).cast("double").alias("s"), F.col("weight").cast("double").alias("w")).filter("forecaster is not null and s is not null and w is not null")
    counts = rows.groupBy("forecaster", (F.round(F.col("s") / grid) * grid).alias("s"), "w").agg(F.count(F.lit(1)).alias("n"))

    def resample(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        rng = np.random.default_rng([seed, *key[0].encode()])
        s, w, c = (pdf[x].to_numpy(float) for x in ("s", "w", "n"))
        chance = w * c
        if chance.sum() <= 0:
            return pd.DataFrame({"forecaster": [key[0]], "margin": [None], "standard_error": [None]})
        draws = rng.multinomial(int(c.sum()), chance / chance.sum(), size=n) if len(s) * n <= 20_000_000 else None
        if draws is None:
            means = np.array([((d := rng.multinomial(int(c.sum()), chance / chance.sum())) * w * s).sum() / (d * w).sum() for _ in range(n)])
        else:
            means = (draws * w * s).sum(axis=1) / (draws * w).sum(axis=1)
        center = (chance * s).sum() / chance.sum()
        error = float(means.std(ddof=1))
        margin = num_se * error if num_se is not None else float(np.sort(np.abs(means - center))[ceil(level * n) - 1])
        return pd.DataFrame({"forecaster": [key[0]], "margin": [margin], "standard_error": [error]})

    return counts.groupBy("forecaster").applyInPandas(resample, "forecaster string, margin double, standard_error double")


def with_market_baseline(df: DataFrame, reference: str | None = None, both_sides: bool = False, row_id: str = "row_id") -> DataFrame:
    """``df`` with rows of the market as a forecaster, one for each submission.

    They take the submission's columns from the forecaster ``reference`` or,
    without one, the first value that is not null in the order of ``row_id``;
    the prediction is the market's own view.
    """
    keys = ["submission_id"]
    if reference is not None:
        base = df.filter(F.col("forecaster") == reference)
    else:
        first = [F.min_by(c, F.when(F.col(c).isNotNull(), F.col(row_id))).alias(c) for c in df.columns if c not in keys]
        base = df.filter("submission_id is not null").groupBy(*keys).agg(*first)
    base = base.withColumn("forecaster", F.lit(BASELINE)).withColumn("prediction", market_view(F.col("odds"), F.col("no_odds"), both_sides))
    return df.unionByName(base.select(df.columns))
