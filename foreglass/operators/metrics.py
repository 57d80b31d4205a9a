"""Scores of forecasts: Brier score, betting return, calibration error, Sharpe ratio."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from foreglass.functions.vectors import total
from foreglass.plans.prefix import exact_quantiles
from foreglass.session import cut


def brier(prediction: Column, outcome: Column) -> Column:
    """Mean squared error of a probability vector; null for ragged, empty or null vectors."""
    squares = F.zip_with(prediction, outcome, lambda p, o: (p - o) * (p - o))
    return F.when((F.size(prediction) == F.size(outcome)) & (F.size(prediction) > 0), total(squares) / F.size(prediction))


def with_brier(df: DataFrame, prediction: str = "prediction", outcome: str = "market_outcome") -> DataFrame:
    """Adds ``brier_score``; a row-local expression, so nothing is shuffled."""
    return df.withColumn("brier_score", brier(F.col(prediction), F.col(outcome)))


def brier_of_maps(prediction: Column, outcome: Column, missing: float | None = 0.0) -> Column:
    """Brier score of two maps over the markets of ``outcome``.

    A market that the prediction lacks counts as ``missing``, or makes the
    score null if that is None. A null prediction has no score. Outcomes other than 0 and 1 or probabilities
    outside 0 to 1 give null, as do empty outcomes.
    """
    keys = F.map_keys(outcome)
    p = F.transform(keys, lambda k: F.coalesce(F.try_element_at(prediction, k), F.lit(missing).cast("double")))
    o = F.transform(keys, lambda k: F.element_at(outcome, k))
    valid = F.forall(o, lambda x: x.isin(0.0, 1.0)) & F.forall(p, lambda x: x.between(0.0, 1.0))
    return F.when(prediction.isNotNull() & valid & (F.size(keys) > 0), brier(p, o))


def market_brier(prices: Column, outcome: Column) -> Column:
    """Brier score of the market itself: the yes price in cents of each market of ``outcome`` as its probability.

    ``prices`` maps markets to a struct with ``yes_ask``. Null where a market of
    the outcome has no price or no outcome, and for no outcome at all.
    """
    entries = F.map_entries(outcome)
    p = F.transform(entries, lambda e: F.try_element_at(prices, e["key"])["yes_ask"] / 100.0)
    return brier(p, F.transform(entries, lambda e: e["value"]))


def average_return(prediction: Column, outcome: Column, odds: Column, no_odds: Column, spread: bool = False) -> Column:
    """Earnings of one unit bet where the forecast sees the largest edge over the price.

    The yes side is taken only if its edge is strictly larger. All goes to the
    first market of the largest edge or, with ``spread``, in even parts to
    every market. A price of zero has an infinite edge if the forecast gives
    the side any chance, else none; a bet at price zero earns nothing that can
    be counted, so its return is null.
    """
    edge = lambda p, q: F.when(q == 0, F.when(p > 0, F.lit(float("inf"))).otherwise(0.0)).otherwise(F.try_divide(p, q))
    markets = F.arrays_zip(prediction.alias("p"), outcome.alias("o"), odds.alias("y"), no_odds.alias("n"))
    # one array of structs, walked once: both edges, then the side taken
    sides = F.transform(markets, lambda m: F.struct(edge(m["p"], m["y"]).alias("yes"), edge(1.0 - m["p"], m["n"]).alias("no"), F.try_divide(m["o"], m["y"]).alias("pay_yes"), F.try_divide(1.0 - m["o"], m["n"]).alias("pay_no")))
    bets = F.transform(sides, lambda s: F.struct(F.greatest(s["yes"], s["no"]).alias("edge"), F.when(s["yes"] > s["no"], s["pay_yes"]).otherwise(s["pay_no"]).alias("pay")))
    if spread:
        return F.aggregate(bets, F.lit(0.0), lambda a, b: a + b["pay"]) / F.size(prediction)
    none = F.struct(F.lit(float("-inf")).alias("edge"), F.lit(None).cast("double").alias("pay"))
    return F.aggregate(bets, none, lambda a, b: F.when(b["edge"] > a["edge"], b).otherwise(a))["pay"]


def bin_edges(n_bins: int) -> list[float]:
    """Inner edges of equal bins, as the floats that evenly spaced points have (0.3 is 3 * 0.1)."""
    step = 1.0 / n_bins
    return [i * step for i in range(1, n_bins)]


def bin_number(p: Column, inner: list[float] | Column) -> Column:
    """Number of inner edges up to ``p``: left edges belong to their bin, the last bin is closed."""
    if isinstance(inner, list):
        inner = F.array(*(F.lit(e) for e in inner)) if inner else F.array().cast("array<double>")
    return F.size(F.filter(inner, lambda e: p >= e))


def exploded_pairs(df: DataFrame, prediction: str, outcome: str, by_market: bool) -> DataFrame:
    """One row for each market: ``forecaster, p, y, w``; with ``by_market`` a row's weight is shared by its markets."""
    weight = F.col("weight") / F.size(prediction) if by_market else F.col("weight")
    rows = df.select("forecaster", weight.alias("w"), F.explode(F.arrays_zip(F.col(prediction).alias("p"), F.col(outcome).alias("y"))).alias("z"))
    return rows.select("forecaster", "w", F.col("z.p").alias("p"), F.col("z.y").alias("y")).filter("p is not null and y is not null and w is not null")


def quantile_edges(pairs: DataFrame, n_bins: int) -> DataFrame:
    """``(forecaster, inner)``: the distinct inner quantile edges of each forecaster's probabilities.

    Exact quantiles over a range sort of counted values, so no task holds a
    forecaster's probabilities.
    """
    edges = exact_quantiles(pairs, ["forecaster"], "p", [i / n_bins for i in range(n_bins + 1)])
    edges = edges.select("forecaster", F.array_distinct("quantiles").alias("e"))
    return edges.select("forecaster", F.slice("e", 2, F.greatest(F.size("e") - 2, F.lit(0))).alias("inner"))


def calibration_bins(df: DataFrame, n_bins: int = 10, strategy: str = "uniform", by_market: bool = True, prediction: str = "prediction", outcome: str = "market_outcome") -> DataFrame:
    """``(forecaster, bin, weight_sum, confidence, accuracy, count)`` of each bin with weight.

    Weights are scaled so that a forecaster's weights sum to its number of
    pairs; a bin's count is the whole part of its scaled weight. Forecasters
    without weight are left out.
    """
    pairs = exploded_pairs(df, prediction, outcome, by_market)
    if strategy == "quantile":
        pairs = pairs.join(quantile_edges(pairs, n_bins), "forecaster").withColumn("bin", bin_number(F.col("p"), F.col("inner"))).drop("inner")
    elif strategy == "uniform":
        pairs = pairs.withColumn("bin", bin_number(F.col("p"), bin_edges(n_bins)))
    else:
        raise ValueError(f"unknown binning strategy {strategy}")
    bins = pairs.groupBy("forecaster", "bin").agg(F.sum("w").alias("sw"), F.sum(F.col("w") * F.col("p")).alias("swp"), F.sum(F.col("w") * F.col("y")).alias("swy"), F.count(F.lit(1)).alias("pairs"))
    whole = bins.groupBy("forecaster").agg(F.sum("sw").alias("all_w"), F.sum("pairs").alias("n"))
    joined = bins.join(whole, "forecaster").filter("all_w > 0 and sw > 0")
    count = F.floor(F.col("sw") * F.col("n") / F.col("all_w") + 1e-9)  # 3.9999... is 4
    return joined.select("forecaster", "bin", F.col("sw").alias("weight_sum"), (F.col("swp") / F.col("sw")).alias("confidence"), (F.col("swy") / F.col("sw")).alias("accuracy"), count.cast("long").alias("count"), "n")


def calibration_error(df: DataFrame, **options) -> DataFrame:
    """``(forecaster, ece_score)``: expected calibration error over bins with a count above zero."""
    bins = calibration_bins(df, **options)
    gap = F.when(F.col("count") > 0, F.abs(F.col("confidence") - F.col("accuracy")) * F.col("count") / F.col("n")).otherwise(0.0)
    return bins.groupBy("forecaster").agg(F.sum(gap).alias("ece_score"))


def sharpe(df: DataFrame, value: str, baseline: float = 0.0, by_event: bool = False) -> DataFrame:
    """``(forecaster, sharpe_ratio, mean_excess_return, std_excess_return)``.

    The sample deviation divides the mean excess over ``baseline``; with
    ``by_event`` the weighted mean of each event comes first. Where the
    deviation is zero or undefined the ratio is 0 for a zero mean, else
    infinite with its sign. Null values are left out.
    """
    rows = df
    if by_event:
        # sums skip nulls by themselves: a filter would be pushed below and work the value out twice
        weighted = F.struct((F.col(value) * F.col("weight")).alias("vw"), F.when(F.col(value).isNotNull(), F.col("weight")).alias("w"))
        rows = df.select("forecaster", "event_ticker", weighted.alias("r")).groupBy("forecaster", "event_ticker").agg(F.try_divide(F.sum("r.vw"), F.sum("r.w")).alias(value))
    excess = F.col(value) - baseline
    out = rows.groupBy("forecaster").agg(F.avg(excess).alias("mean_excess_return"), F.stddev_samp(excess).alias("std_excess_return")).filter("mean_excess_return is not null")
    m, s = F.col("mean_excess_return"), F.col("std_excess_return")
    ratio = F.when(s > 0, m / s).when(m == 0, 0.0).otherwise(F.signum(m) * float("inf"))
    return out.select("forecaster", ratio.alias("sharpe_ratio"), "mean_excess_return", "std_excess_return")


def score_summary(df: DataFrame, by: list[str] | None = None, score: str = "brier_score") -> DataFrame:
    """Counts, distinct events and submissions, mean, median, minimum, maximum and deviation of the scores and of the event means.

    Medians are exact and come from a range sort; null keys are left out.
    """
    keys = list(by or [])
    stats = lambda c, prefix: [F.avg(c).alias(f"{prefix}mean"), F.min(c).alias(f"{prefix}min"), F.max(c).alias(f"{prefix}max"), F.stddev_samp(c).alias(f"{prefix}std")]
    median = lambda rows, c, prefix: exact_quantiles(rows, keys, c, [0.5]).select(*keys, F.col("quantiles")[0].alias(f"{prefix}median"))
    # read several times below, so what led to the scores runs once
    rows = cut(df.filter(F.col(score).isNotNull()).select(*keys, "event_ticker", "submission_id", score))
    events = rows.groupBy(*keys, "event_ticker").agg(F.avg(score).alias("event_mean"))
    own = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("event_ticker").alias("n_events"), F.countDistinct("submission_id").alias("n_submissions"), *stats(score, ""))
    out = own
    for part in (median(rows, score, ""), events.groupBy(*keys).agg(*stats("event_mean", "event_")), median(events, "event_mean", "event_")):
        # without keys one row each, also of no scores
        out = out.join(part, keys) if keys else out.join(F.broadcast(part), F.lit(True), "left")
    return out


def event_mean(df: DataFrame, score: str = "brier_score") -> DataFrame:
    """Valid scores, their mean, the mean of the event means, and the number of events."""
    rows = df.filter(F.col(score).isNotNull())
    events = rows.groupBy("event_ticker").agg(F.sum(score).alias("s"), F.count(F.lit(1)).alias("n"))
    return events.agg(F.sum("n").cast("long").alias("n_valid"), (F.sum("s") / F.sum("n")).alias("mean_score"), F.avg(F.col("s") / F.col("n")).alias("event_mean_score"), F.count(F.lit(1)).alias("n_events"))
