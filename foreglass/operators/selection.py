"""Per-group selection of forecasts, deduplication, limits and membership."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from foreglass.functions.vectors import not_nan
from foreglass.plans.prefix import best_of_blocks, group_positions
from foreglass.plans.skew import skewed_left_join

GROUP = "submission_id"
#: The key that makes a selected row unique.
ROW_KEY = ["forecaster", "event_ticker", "submission_id", "round"]


def lower_is_better(metric: str) -> bool:
    return metric == "brier_score"


def with_group(df: DataFrame, stats: DataFrame, spread: list[str]) -> DataFrame:
    """``df`` with statistics of its group. They are aggregated before the shuffle; rows of hot groups are salted for the join."""
    return skewed_left_join(df.filter(F.col(GROUP).isNotNull()), stats, GROUP, spread)


def with_positions(df: DataFrame, metric: str, row_id: str, keep: int | None = None) -> DataFrame:
    """Adds ``position``: the place of a row in its group by metric, best first, ties by ``row_id``, null metrics last.

    Places come from a range-partitioned sort with prefix-summed counts, so a
    group may be larger than any task; the columns travel with it. With
    ``keep`` only places up to it come out, and a hot group shrinks before the
    sort.
    """
    value = not_nan(F.col(metric))
    order = value if lower_is_better(metric) else -value
    keyed = df.filter(F.col(GROUP).isNotNull()).withColumn("__order", F.coalesce(order, F.lit(float("inf"))))
    if keep is not None:
        keyed = best_of_blocks(keyed, GROUP, ["__order", row_id], keep)
    return group_positions(keyed, GROUP, ["__order", row_id], keep).drop("__order")


def top_absolute(df: DataFrame, metric: str, row_id: str, top_k: int = -1, top_p: float = 0.1, min_val: float = -1.0) -> DataFrame:
    """The best ``top_k`` rows of each submission or, without it, the best share ``top_p`` of them, at least one.

    With ``min_val`` above zero only scores that are no worse than it stay.
    Rows without a submission are left out. An empty input stays empty.
    """
    if top_k <= 0 and not 0 < top_p < 1:
        raise ValueError("top_p must lie between 0 and 1")
    if top_k > 0:
        kept = with_positions(df, metric, row_id, top_k)
    else:
        placed = with_positions(df, metric, row_id)
        sizes = df.groupBy(GROUP).agg(F.count(F.lit(1)).alias("group_size"))
        kept = with_group(placed, sizes, [row_id]).filter(F.col("position") <= F.greatest(F.lit(1), F.floor(F.col("group_size") * top_p))).drop("group_size")
    kept = kept.drop("position").select(df.columns)
    if min_val > 0:
        kept = kept.filter(F.col(metric) <= min_val if lower_is_better(metric) else F.col(metric) >= min_val)
    return kept


def _group_statistics(df: DataFrame, metric: str) -> DataFrame:
    """Size, mean, deviation and range of each submission, and the most rows any forecaster has in it."""
    value = not_nan(F.col(metric))
    by_forecaster = df.groupBy(GROUP, "forecaster").agg(F.count(F.lit(1)).alias("rows"))
    repeats = by_forecaster.groupBy(GROUP).agg(F.max("rows").alias("most_rows"))
    stats = df.groupBy(GROUP).agg(F.count(F.lit(1)).alias("group_size"), F.count(value).alias("scored"), F.avg(value).alias("group_mean"), F.stddev_samp(value).alias("group_std"), F.min(value).alias("group_min"), F.max(value).alias("group_max"))
    return stats.join(repeats, GROUP)


def with_z_score(df: DataFrame, metric: str, row_id: str, max_mean: float = -1.0) -> DataFrame:
    """Rows of groups that a z-score makes sense for, with ``z_score``.

    Left out are groups of one row, groups in which a forecaster stands twice,
    groups without deviation and, with ``max_mean`` above zero, groups whose
    mean is better than it (too easy).
    """
    stats = _group_statistics(df, metric).filter("group_size >= 2 and most_rows = 1 and group_std > 0")
    if max_mean > 0:
        stats = stats.filter(F.col("group_mean") >= max_mean if lower_is_better(metric) else F.col("group_mean") <= max_mean)
    joined = with_group(df, stats.select(GROUP, "group_mean", "group_std"), [row_id]).filter("group_std is not null")
    return joined.withColumn("z_score", (not_nan(F.col(metric)) - F.col("group_mean")) / F.col("group_std")).drop("group_mean", "group_std")


def _extreme(metric: str, threshold: Column | float) -> Column:
    return F.col("z_score") < -F.lit(threshold) if lower_is_better(metric) else F.col("z_score") > F.lit(threshold)


def top_z_score(df: DataFrame, metric: str, row_id: str, min_z: float = 1.5, max_mean: float = -1.0, min_val: float = -1.0) -> DataFrame:
    """Rows far better than their group, optionally no worse than ``min_val``."""
    kept = with_z_score(df, metric, row_id, max_mean).filter(_extreme(metric, min_z))
    if min_val > 0:
        kept = kept.filter(F.col(metric) <= min_val if lower_is_better(metric) else F.col(metric) >= min_val)
    return kept.select(df.columns)


def ambiguous(df: DataFrame, metric: str, row_id: str, min_val: float = 0.25, max_val: float = 0.15, top_k: int = -1) -> DataFrame:
    """The best rows of groups that nobody got right.

    For a metric whose lower values are better: groups in which all scores are
    above ``max_val``, of them the rows below ``min_val``; a missing score
    fails its group. Otherwise with the bounds the other way. At most
    ``top_k`` rows of a group if it is above zero.
    """
    stats = df.groupBy(GROUP).agg(F.count(F.lit(1)).alias("group_size"), F.count(not_nan(F.col(metric))).alias("scored"), F.min(not_nan(F.col(metric))).alias("group_min"), F.max(not_nan(F.col(metric))).alias("group_max")).filter("scored = group_size")
    asc = lower_is_better(metric)
    stats = stats.filter(F.col("group_min") > max_val if asc else F.col("group_max") < max_val).select(GROUP, F.lit(True).alias("kept_group"))
    kept = with_group(df, stats, [row_id]).filter("kept_group").filter(F.col(metric) < min_val if asc else F.col(metric) > min_val).select(df.columns)
    if top_k > 0:
        kept = with_positions(kept, metric, row_id, top_k).select(df.columns)
    return kept


def combine(parts: list[DataFrame], row_id: str, everything: DataFrame) -> DataFrame:
    """Union of filter results; of rows with the same key the one of the earliest part, then of the smallest ``row_id``. Without parts: ``everything``."""
    if not parts:
        return everything
    numbered = None
    for i, part in enumerate(parts):
        part = part.withColumn("__part", F.lit(i))
        numbered = part if numbered is None else numbered.unionByName(part)
    return first_of(numbered, ROW_KEY, ["__part", row_id]).drop("__part")


def first_of(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key. The aggregate keeps one row a task before the shuffle, however hot the key; null keys are equal."""
    row = F.struct(*(F.col(c) for c in df.columns))
    picked = df.groupBy(*(F.col(k).alias(f"__k{i}") for i, k in enumerate(keys))).agg(F.min_by(row, F.struct(*order)).alias("row"))
    return picked.select("row.*")


def deduplicate_problems(df: DataFrame, row_id: str, strategy: str = "first", seed: int = 42) -> DataFrame:
    """One row for each (event, submission): the first, a seeded random one, or the best scored; other names mean the first."""
    keys = ["event_ticker", "submission_id"]
    if strategy == "random":
        keyed = df.withColumn("__order", F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(row_id).cast("string"))))
        return first_of(keyed, keys, ["__order", row_id]).drop("__order")
    if strategy == "best_brier":
        keyed = df.withColumn("__order", F.coalesce(not_nan(F.col("brier_score")), F.lit(float("inf"))))
        return first_of(keyed, keys, ["__order", row_id]).drop("__order")
    return first_of(df, keys, [row_id])


def limit_problems(df: DataFrame, row_id: str, most: int | None = None, shuffle: bool = True, seed: int = 42) -> DataFrame:
    """At most ``most`` rows: a seeded sample, or the first ones without ``shuffle``.

    A global sort over range partitions, so ``most`` may be larger than a task;
    rows of the same ``row_id`` count once.
    """
    if most is None:
        return df
    order = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(row_id).cast("string"))) if shuffle else F.lit("")
    keyed = df.withColumn("__all", F.lit(0)).withColumn("__draw", order)
    return group_positions(best_of_blocks(keyed, "__all", ["__draw", row_id], most), "__all", ["__draw", row_id], most).select(df.columns)


def head(df: DataFrame, n: int = 10) -> DataFrame:
    """Some ``n`` rows to try things out with."""
    return df.limit(n)


def cap_per_event(df: DataFrame, order: list[str], most: int = 5, event: str = "event_ticker") -> DataFrame:
    """The first ``most`` rows of each event; the rank limit also runs before the shuffle."""
    return df.withColumn("__n", F.row_number().over(Window.partitionBy(event).orderBy(*order))).filter(F.col("__n") <= most).drop("__n")


def remaining_work(df: DataFrame, done: DataFrame, keys: tuple[str, ...] = ("submission_id", "forecaster")) -> tuple[DataFrame, DataFrame]:
    """``(rows still to do, results still wanted)``."""
    return df.join(done.select(*keys).distinct(), list(keys), "left_anti"), done.join(df.select(*keys).distinct(), list(keys), "left_semi")


def exclude_pairs(df: DataFrame, test_set: DataFrame, keys: tuple[str, ...] = ("event_ticker", "submission_id")) -> DataFrame:
    """Rows whose keys, as text, are not in the test set; null equals null. A test set that lacks a key excludes nothing."""
    if any(k not in test_set.columns for k in keys):
        return df
    held = test_set.select(*(F.col(k).cast("string").alias(f"__{k}") for k in keys)).distinct()
    condition = None
    for k in keys:
        same = F.col(k).cast("string").eqNullSafe(F.col(f"__{k}"))
        condition = same if condition is None else condition & same
    return df.join(held, condition, "left_anti")
