"""Problem 1: a sample that matches target category proportions.

Method: weights are raked by iterative proportional fitting over several
margins, rows are drawn by weighted exponential keys, minimums are repaired
and the remaining gaps reported.
"""

from __future__ import annotations

import heapq
from functools import cached_property

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F

from foreglass.plans.prefix import group_positions
from foreglass.session import cut, discard, written

#: Most cells (combinations of margin values) that are fitted on the driver; more are fitted as a table.
DRIVER_CELLS = 200_000
#: Rounds of the fitting at most, and the change of all weights at which it ends.
ROUNDS = 200
TOLERANCE = 1e-9


def plain_name(name: Column) -> Column:
    """A name in lower case without outer white space; null if blank."""
    return F.nullif(F.lower(F.regexp_replace(name, r"^[\s\p{Z}]+|[\s\p{Z}]+$", "")), F.lit(""))


def rake(counts: np.ndarray, targets: list[np.ndarray], rounds: int = ROUNDS, tolerance: float = TOLERANCE) -> np.ndarray:
    """Weights for each cell so that the weighted counts meet every margin's shares.

    ``counts`` has an axis for each margin. Margin values without rows are left
    out and the rest of that margin rescaled: what cannot be met shows as a gap
    later. Empty counts give weights of 1.
    """
    weights = np.ones(counts.shape)
    if not counts.sum():
        return weights
    for _ in range(rounds):
        change = 0.0
        for axis, target in enumerate(targets):
            others = tuple(a for a in range(counts.ndim) if a != axis)
            now = (counts * weights).sum(axis=others)
            wanted = np.where(now > 0, target, 0.0)
            wanted = wanted / wanted.sum() if wanted.sum() else wanted
            factor = np.divide(wanted * counts.sum(), now, out=np.ones_like(now), where=now > 0)
            change = max(change, float(np.abs(factor - 1).max()))
            weights = weights * factor.reshape([-1 if a == axis else 1 for a in range(counts.ndim)])
        if change < tolerance:
            break
    return weights


def rake_table(cells: DataFrame, targets: dict[str, DataFrame], rounds: int = ROUNDS, tolerance: float = TOLERANCE) -> DataFrame:
    """The same fit on a table of cells: ``(*margins, n, weight)`` from ``(*margins, n)`` and, for each margin, ``(margin, share)``.

    For more cells than the driver should hold. Each round writes the weights;
    only its largest change reaches the driver.
    """
    fitted = written(cells.withColumn("weight", F.lit(1.0)))
    total = F.broadcast(cells.agg(F.sum("n").cast("double").alias("total")))
    for _ in range(rounds):
        table = fitted
        for margin, shares in targets.items():
            now = table.groupBy(margin).agg(F.sum(F.col("n") * F.col("weight")).alias("now")).filter("now > 0").join(shares, margin)
            whole = F.broadcast(now.agg(F.sum("share").alias("whole")))
            wanted = F.when(F.col("whole") > 0, F.try_divide(F.col("share"), F.col("whole"))).otherwise(F.lit(0.0))
            factor = now.crossJoin(total).crossJoin(whole).select(margin, (wanted * F.col("total") / F.col("now")).alias("factor"))
            change = f"change_{margin}"
            table = table.join(factor, margin, "left").withColumn("factor", F.coalesce("factor", F.lit(1.0))).withColumn("weight", F.col("weight") * F.col("factor")).withColumn(change, F.abs(F.col("factor") - 1)).drop("factor")
        new = written(table)
        discard(fitted)
        changes = [f"change_{m}" for m in targets]
        largest = new.agg(F.max(F.greatest(*changes, F.lit(0.0)))).first()[0]
        fitted = new.drop(*changes)
        fitted._scratch_path = new._scratch_path
        if largest is None or largest < tolerance:
            break
    return fitted


def repaired_quotas(targets: list[dict], available: dict[str, int], size: int) -> dict[str, int]:
    """Rows to draw from each category: ``size`` in all where there are so many.

    Every row that a category could give is a slot. Slots up to a category's
    minimum come first, then the j-th by (j - 1/2) / share, so that shares are
    met to the nearest row, what a minimum adds is taken from the others in
    proportion, and what a category lacks is drawn from those that have more.
    Categories with a share of zero give their minimum only.
    """
    have = {t["name"]: available.get(t["name"], 0) for t in targets}
    least = {t["name"]: min(have[t["name"]], t["min_rows"]) for t in targets}
    share = {t["name"]: t["share"] for t in targets}
    if sum(least.values()) >= size:
        quota, left = {}, size
        for n in sorted(least):
            quota[n] = min(least[n], left)
            left -= quota[n]
        return {t["name"]: quota[t["name"]] for t in targets}
    upto = lambda level: {n: max(least[n], min(have[n], int(level * share[n] + 0.5))) for n in have}
    low, high = 0.0, max([have[n] / share[n] for n in have if share[n] > 0], default=0.0) + 1
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if sum(upto(middle).values()) <= size else (low, middle)
    quota = upto(low * (1 - 1e-9))
    queue = [((quota[n] + 0.5) / share[n], n) for n in have if share[n] > 0 and quota[n] < have[n]]
    heapq.heapify(queue)
    left = size - sum(quota.values())  # a few slots at the level itself
    while left > 0 and queue:
        _, n = heapq.heappop(queue)
        quota[n] += 1
        left -= 1
        if quota[n] < have[n]:
            heapq.heappush(queue, ((quota[n] + 0.5) / share[n], n))
    return quota


def round_half_up(x: float) -> int:
    return int(np.floor(x + 0.5 + 1e-9))


class RakedSample:
    """A drawn sample with its report; nothing runs before it is asked for.

    Records are the distinct pairs (event, record) whose category is listed,
    apart from case and outer white space; null, blank and unlisted categories
    and null ids are left out. At most ``per_event`` records of an event count
    for a category, and at most ``per_event`` of an event are drawn: where
    categories share an event, those that need all their records come first,
    then all take turns, the scarcer first, each in seeded order. A record listed under several categories
    counts for each and is drawn for the scarcest. The targets are a parameter
    table of some dozens of rows; ``sample_size`` is bounded by it too.
    """

    def __init__(self, df: DataFrame, targets: DataFrame, event: str, record: str, category: str, margin: str | None = None, per_event: int = 5, seed: int = 42, driver_cells: int = DRIVER_CELLS):
        self.spark = df.sparkSession
        listed = targets.select("category", "target_share", "min_rows", "sample_size").distinct().collect()
        self.targets = [{"name": r.category, "share": r.target_share, "min_rows": r.min_rows} for r in sorted(listed, key=lambda r: r.category)]
        self.size = listed[0].sample_size if listed else 0
        for t in self.targets:
            t["wanted"] = max(t["min_rows"], round_half_up(t["share"] * self.size))
        self.per_event, self.seed, self.driver_cells = per_event, seed, driver_cells
        names = F.broadcast(self.spark.createDataFrame([(t["name"],) for t in self.targets], "category string").withColumn("plain", plain_name(F.col("category"))))
        picked = df.select(F.col(event).alias("event"), F.col(record).alias("record"), plain_name(F.col(category)).alias("plain"), F.coalesce(F.col(margin).cast("string") if margin else F.lit(""), F.lit("")).alias("margin")).filter("event is not null and record is not null")
        self.listed = picked.join(names, "plain").groupBy("event", "record", "category").agg(F.min("margin").alias("margin"))

    @cached_property
    def available(self) -> dict[str, int]:
        """Records of each category, at most ``per_event`` of an event: what could be drawn for it alone."""
        by_event = self.listed.groupBy("category", "event").agg(F.least(F.count(F.lit(1)), F.lit(self.per_event)).alias("n"))
        return {r.category: r.n for r in by_event.groupBy("category").agg(F.sum("n").alias("n")).collect()}  # a row for each target

    @cached_property
    def pool(self) -> DataFrame:
        """``(event, record, category, margin)`` of the records that the event's cap leaves."""
        scarcity = [(t["name"], t["wanted"] / self.available[t["name"]]) for t in self.targets if self.available.get(t["name"])]
        ranks = F.broadcast(self.spark.createDataFrame(scarcity, "category string, scarcity double"))
        one = self.listed.join(ranks, "category").groupBy("event", "record").agg(F.max(F.struct("scarcity", "category", "margin")).alias("r")).select("event", "record", "r.*")
        order = F.md5(F.concat_ws("|", F.lit(str(self.seed)), "event", "record"))
        # the rank limits are applied before the shuffle too, so a hot event sends per_event rows a task
        own = one.withColumn("turn", F.row_number().over(Window.partitionBy("event", "category").orderBy(order, "record"))).filter(F.col("turn") <= self.per_event)
        ranked = own.withColumn("place", F.row_number().over(Window.partitionBy("event").orderBy(F.col("scarcity") < 1, "turn", F.desc("scarcity"), "category")))
        return cut(ranked.filter(F.col("place") <= self.per_event).select("event", "record", "category", "margin"))

    @cached_property
    def cells(self) -> DataFrame:
        return written(self.pool.groupBy("category", "margin").agg(F.count(F.lit(1)).alias("n")))

    @cached_property
    def weights(self) -> DataFrame:
        """``(category, margin, weight)``: the targets are the category shares and the pool's own shares of the margin."""
        shares = self.spark.createDataFrame([(t["name"], float(t["share"])) for t in self.targets], "category string, share double")
        if self.cells.count() > self.driver_cells:
            total = self.cells.agg(F.sum("n").alias("total"))
            own = self.cells.groupBy("margin").agg(F.sum("n").alias("m")).crossJoin(F.broadcast(total)).select("margin", (F.col("m") / F.col("total")).alias("share"))
            return rake_table(self.cells, {"category": shares, "margin": own}).select("category", "margin", "weight")
        cells = self.cells.collect()  # at most driver_cells rows
        names, values = [t["name"] for t in self.targets], sorted({c.margin for c in cells})
        counts = np.zeros((len(names), max(1, len(values))))
        place = {v: j for j, v in enumerate(values)}
        for c in cells:
            counts[names.index(c.category), place[c.margin]] = c.n
        weights = rake(counts, [np.array([t["share"] for t in self.targets]), counts.sum(axis=0) / max(1.0, counts.sum())])
        flat = [(c.category, c.margin, float(weights[names.index(c.category), place[c.margin]])) for c in cells]
        return self.spark.createDataFrame(flat, "category string, margin string, weight double")

    @cached_property
    def quotas(self) -> dict[str, int]:
        have = {r.category: r.n for r in self.cells.groupBy("category").agg(F.sum("n").alias("n")).collect()}  # a row for each target
        return repaired_quotas(self.targets, have, self.size)

    @cached_property
    def rows(self) -> DataFrame:
        """``(event, record, category, margin, position)``: the drawn records, by exponential keys with the raked weights."""
        u = (F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(f"{self.seed} draw"), "event", "record")), 1, 12), 16, 10).cast("double") + 0.5) / float(2**48)
        keyed = self.pool.join(self.weights, ["category", "margin"]).withColumn("key", -F.log(u) / F.greatest("weight", F.lit(1e-300)))
        most = max([*self.quotas.values(), 1])
        placed = group_positions(keyed.select("category", "key", "event", "record", "margin"), "category", ["key", "event", "record", "margin"], keep=most)
        quotas = F.broadcast(self.spark.createDataFrame(list(self.quotas.items()), "category string, quota long"))
        return cut(placed.join(quotas, "category").filter("position <= quota").select("event", "record", "category", "margin", "position"))

    def shortfalls(self) -> DataFrame:
        """``(category, target_share, min_rows, wanted, available, short)``: what the records of each category lack for its target. Draws nothing."""
        out = [(t["name"], t["share"], t["min_rows"], t["wanted"], have := self.available.get(t["name"], 0), max(0, t["wanted"] - have)) for t in self.targets]
        return self.spark.createDataFrame(out, "category string, target_share double, min_rows int, wanted long, available long, short long")

    def report(self) -> DataFrame:
        """The shortfalls with the rows drawn of each category, their share and the gap to the target share."""
        drawn = self.rows.groupBy("category").agg(F.count(F.lit(1)).alias("drawn"))
        return self._gaps(self.shortfalls().join(F.broadcast(drawn), "category", "left"))

    def unmet(self) -> DataFrame:
        """The rows of the report whose target the draw missed and no record is left to repair.

        A category draws no more than it has in the pool, and there no more
        than its supply, so a want of records always shows in the draw; a gap
        without one (rounding, or minimums of others) is no want.
        """
        return self.report().filter((F.col("drawn") < F.col("wanted")) & (F.col("available") < F.col("wanted")))

    def margin_report(self) -> DataFrame:
        """``(margin, available, target_share, drawn, drawn_share, gap)`` of the second margin; its target is its share of the pool."""
        pool = self.cells.groupBy("margin").agg(F.sum("n").alias("available"))
        total = F.broadcast(pool.agg(F.sum("available").alias("total")))
        shares = pool.crossJoin(total).select("margin", "available", (F.col("available") / F.col("total")).alias("target_share"))
        return self._gaps(shares.join(self.rows.groupBy("margin").agg(F.count(F.lit(1)).alias("drawn")), "margin", "left"))

    def _gaps(self, counted: DataFrame) -> DataFrame:
        size = F.broadcast(self.rows.agg(F.greatest(F.count(F.lit(1)), F.lit(1)).alias("size")))
        share = F.col("drawn") / F.col("size")
        return counted.withColumn("drawn", F.coalesce("drawn", F.lit(0)).cast("long")).crossJoin(size).withColumn("drawn_share", share).withColumn("gap", F.col("target_share") - share).drop("size")
