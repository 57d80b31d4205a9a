"""Budgeted samples, model assignment and group-aware splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from foreglass.plans.prefix import best_of_blocks, group_positions, running_total


def seeded(seed: int, *columns: str) -> Column:
    """A reproducible order that does not depend on partitions."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns)))


def category_distribution(df: DataFrame, least: float = 0.01, normalise: bool = True) -> DataFrame:
    """``(category, n, share)`` of the categories with at least the share ``least``; with ``normalise`` off, of all."""
    counts = df.groupBy("category").agg(F.count(F.lit(1)).alias("n"))
    total = F.broadcast(counts.agg(F.sum("n").alias("total")))  # one row
    shares = counts.crossJoin(total).select("category", "n", (F.col("n") / F.col("total")).alias("share"))
    return shares.filter(F.col("share") >= least) if normalise else shares


def category_sample(df: DataFrame, budgets: dict[str, int], row_id: str, per_event: int, other: int = 0, seed: int = 42) -> DataFrame:
    """A sample with a budget for each category, what is not listed sharing ``other``, and at most ``per_event`` rows of an event.

    Rows in seeded order; the event's cap comes first, then the category's
    budget, which equals taking rows one by one as each event has one category.
    """
    budget = F.create_map(*(F.lit(x) for item in budgets.items() for x in item)) if budgets else F.create_map().cast("map<string,int>")
    named = df.withColumn("__draw", seeded(seed, row_id)).withColumn("__category", F.when(F.col("category").isin(list(budgets)), F.col("category")).otherwise("Other"))
    capped = named.withColumn("__n", F.row_number().over(Window.partitionBy("event_ticker").orderBy("__draw", row_id))).filter(F.col("__n") <= per_event)
    most = max([*budgets.values(), other])
    places = group_positions(best_of_blocks(capped, "__category", ["__draw", row_id], most), "__category", ["__draw", row_id], most)
    return places.filter(F.col("position") <= F.coalesce(F.try_element_at(budget, F.col("__category")), F.lit(other))).select(df.columns)


def assign_repetitive(df: DataFrame, models: list[str]) -> DataFrame:
    """Every row for every model."""
    return df.withColumn("augmenter", F.explode(F.array(*(F.lit(m) for m in models))))


def assign_random(df: DataFrame, models: list[str], fraction: float, row_id: str, overlap: bool = True, seed: int = 42, same_sample: bool = False) -> DataFrame:
    """A seeded share ``fraction`` of the rows for each model.

    With ``overlap`` each model draws from all rows, by default a sample of
    its own (``same_sample`` gives all models the same one); without it the
    samples are disjoint, so the fractions must not exceed one together.
    """
    if not overlap and len(models) * fraction > 1 + 1e-9:
        raise ValueError("disjoint samples would need more than all rows")
    size = int(df.count() * fraction)
    ordered = lambda salt: group_positions(df.select(F.lit(0).alias("__all"), seeded(salt, row_id).alias("__draw"), row_id), "__all", ["__draw", row_id]).select(row_id, "position")
    if not overlap:
        index = F.floor((F.col("position") - 1) / max(1, size)).cast("int")
        drawn = ordered(seed).filter(F.col("position") <= size * len(models)).select(row_id, F.array(*(F.lit(m) for m in models))[index].alias("augmenter"))
    else:
        drawn = None
        for i, model in enumerate(models):
            own = ordered(seed if same_sample else seed + i).filter(F.col("position") <= size).select(row_id, F.lit(model).alias("augmenter"))
            drawn = own if drawn is None else drawn.union(own)
    return df.join(drawn, row_id)


def split_by_event(df: DataFrame, test_size: float, seed: int = 42, event: str = "event_ticker") -> DataFrame:
    """Adds ``split``: whole events go to the test split until it holds ``test_size`` of all rows.

    Events in seeded order or, with seed -1, from the smallest; the event that
    crosses the border still belongs to the test split. Null events are an
    event of their own.
    """
    sizes = df.groupBy(event).agg(F.count(F.lit(1)).alias("n"))
    target = int(df.count() * test_size)
    draw = F.format_string("%020d", "n") if seed == -1 else seeded(seed, event)
    keyed = sizes.select(F.coalesce(event, F.lit("\u0000")).alias("__event"), "n", draw.alias("__draw"))
    placed = running_total(keyed, ["__draw", "__event"], "n")
    test = placed.filter(F.col("running") < target).select("__event", F.lit("test").alias("split"))
    joined = df.withColumn("__event", F.coalesce(event, F.lit("\u0000"))).join(test, "__event", "left")
    return joined.withColumn("split", F.coalesce("split", F.lit("train"))).drop("__event")
