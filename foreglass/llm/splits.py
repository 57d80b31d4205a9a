"""Problem 2: splits that keep related records together.

Method: random-mate contraction. In every round each vertex draws a coin;
vertices with tails collapse into a neighbour with heads, by SQL joins, until
no edge is left. The collapse maps are then unwound to one label for each
vertex, and whole components go to splits by cumulative weight.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from foreglass.plans.prefix import running_total
from foreglass.plans.skew import skewed_left_join
from foreglass.session import discard, written


def plain_ticker(ticker: Column) -> Column:
    """A ticker in upper case without outer white space; null if blank."""
    return F.nullif(F.upper(F.regexp_replace(ticker, r"^[\s\p{Z}]+|[\s\p{Z}]+$", "")), F.lit(""))


def plain_hex(identifier: Column) -> Column:
    """The hexadecimal digits of an identifier in lower case; null if there are none or all are zero."""
    digits = F.regexp_replace(F.lower(identifier), "[^0-9a-f]", "")
    return F.when(digits.rlike("[1-9a-f]"), digits)


def _tails(vertex: str, turn: int) -> Column:
    return (F.xxhash64(F.lit(turn), vertex) % 2) == 0


def _relabel(edges: DataFrame, parents: DataFrame) -> DataFrame:
    """Edges between what their ends collapsed into, without loops and copies, smaller end first."""
    for end in ("u", "v"):
        edges = edges.join(parents.select(F.col("vertex").alias(end), F.col("parent").alias(f"{end}_parent")), end, "left")
        edges = edges.withColumn(end, F.coalesce(f"{end}_parent", end)).drop(f"{end}_parent")
    u, v = F.least("u", "v"), F.greatest("u", "v")
    return edges.select(u.alias("u"), v.alias("v")).filter("u != v").distinct()


def contract(edges: DataFrame) -> list[DataFrame]:
    """The collapse map ``(vertex, parent)`` of each round until no edge is left.

    In expectation a quarter or more of the vertices that still have an edge
    vanish in a round. Each round is written and read again: a checkpoint would
    carry the plan's constraints along, which grow exponentially here.
    """
    edges = written(edges.filter("u is not null and v is not null and u != v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct())
    maps: list[DataFrame] = []
    turn = 0
    while not edges.isEmpty():
        turn += 1
        both = edges.select("u", "v").union(edges.select("v", "u"))
        chosen = both.filter(_tails("u", turn) & ~_tails("v", turn)).groupBy(F.col("u").alias("vertex")).agg(F.min("v").alias("parent"))
        maps.append(written(chosen))
        left, edges = edges, written(_relabel(edges, maps[-1]))
        discard(left)
    return maps


def unwind(maps: list[DataFrame]) -> DataFrame | None:
    """``(vertex, root)`` of every vertex that collapsed, from the last round back to the first.

    Each round writes the labels of its own vertices only; it looks their
    parents up among those of all later rounds, which are fewer and fewer.
    """
    labels = None
    for collapsed in reversed(maps):
        if labels is None:
            labels = collapsed.select("vertex", F.col("parent").alias("root"))
            continue
        up = labels.select(F.col("vertex").alias("parent"), "root")
        own = written(collapsed.join(up, "parent", "left").select("vertex", F.coalesce("root", "parent").alias("root")))
        discard(collapsed)
        labels = own.union(labels)
    return labels


def components(links: DataFrame, schema: str = "vertex string, root string") -> DataFrame:
    """``(vertex, root)`` of the vertices of ``links(u, v)`` that share a component with another; roots of themselves are left out.

    A null end binds nothing. An empty input gives an empty result.
    """
    labels = unwind(contract(links))
    return links.sparkSession.createDataFrame([], schema) if labels is None else labels


def bound_labels(rows: DataFrame, hub: str, spoke: str) -> tuple[DataFrame, DataFrame]:
    """``(hub labels, spoke labels)`` of the graph in which every row binds its ``hub`` to its ``spoke``.

    The spokes are the first to collapse: each into its smallest hub, which
    ties the spoke's other hubs to that one. Only hubs tied to another hub stay
    in the contraction, so it shrinks with the links between hubs, not with
    the rows.
    """
    pairs = rows.select(F.col(hub).alias("hub"), F.col(spoke).alias("spoke")).filter("hub is not null and spoke is not null").distinct()
    pairs = written(pairs)
    mates = pairs.groupBy("spoke").agg(F.min("hub").alias("mate"), F.count(F.lit(1)).alias("hubs"))
    links = pairs.join(mates.filter("hubs > 1"), "spoke").filter("hub != mate").select(F.col("mate").alias("u"), F.col("hub").alias("v"))
    roots = components(links)
    spokes = mates.join(roots.withColumnRenamed("vertex", "mate"), "mate", "left").select("spoke", F.coalesce("root", "mate").alias("root"))
    return roots, spokes


def members(roots: DataFrame) -> DataFrame:
    """``(vertex, root)`` with the smallest vertex of each component as its root, roots included: the classes, one row for each vertex.

    A vertex bound to no other is in no row.
    """
    every = roots.union(roots.select(F.col("root").alias("vertex"), "root").distinct())
    least = every.groupBy("root").agg(F.min("vertex").alias("least"))
    return every.join(least, "root").select("vertex", F.col("least").alias("root"))


def bound_pairs(roots: DataFrame) -> DataFrame:
    """``(a, b)``, a < b: all pairs of vertices that ``(vertex, root)`` puts into one component."""
    members = roots.union(roots.select(F.col("root").alias("vertex"), "root").distinct())
    other = members.select(F.col("vertex").alias("b"), "root")
    return members.withColumnRenamed("vertex", "a").join(other, "root").filter("a < b").select("a", "b")


def split_together(rows: DataFrame, identifier: str, hub: Column, spoke: Column, shares: list[tuple[str, float]], seed: int = 42) -> DataFrame:
    """``(identifier, component, split_name)``: rows bound by ``hub`` or ``spoke``, directly or through others, share a split.

    Components go to the splits from the largest to the smallest by the
    weight before them, so each split misses its share by less than the
    component at its border, there a small one; equal weights in seeded order.
    A component is named by its smallest hub. A row without hub and spoke is
    a component of its own; an identifier counts once, under its smallest hub
    and spoke; a null identifier comes out nowhere. ``shares`` are rescaled to
    sum to 1.
    """
    rows = rows.select(F.col(identifier).alias("id"), hub.alias("hub"), spoke.alias("spoke")).filter("id is not null")
    roots, spokes = bound_labels(rows, "hub", "spoke")
    hubs = written(members(roots))
    spokes = spokes.join(hubs.select(F.col("vertex").alias("__vertex"), F.col("root").alias("__least")), F.col("root") == F.col("__vertex"), "left").select("spoke", F.coalesce("__least", "root").alias("root"))
    one = rows.groupBy("id").agg(F.min(F.struct("hub", "spoke")).alias("row")).select("id", "row.hub", "row.spoke")
    named = skewed_left_join(one, hubs.select(F.col("vertex").alias("hub"), F.col("root").alias("hub_root")), "hub", ["id"])
    named = skewed_left_join(named, spokes.select("spoke", F.col("root").alias("spoke_root")), "spoke", ["id"])
    own = F.concat(F.lit("row "), F.col("id").cast("string"))
    alone = F.concat(F.lit("spoke "), F.col("spoke"))
    named = written(named.select("id", F.coalesce("hub_root", "hub", "spoke_root", alone, own).alias("component")))
    sizes = named.groupBy("component").agg(F.count(F.lit(1)).alias("weight")).withColumn("down", -F.col("weight")).withColumn("draw", F.md5(F.concat_ws("|", F.lit(str(seed)), "component")))
    ordered = running_total(sizes, ["down", "draw", "component"], "weight")
    total = F.broadcast(sizes.agg(F.sum("weight").alias("total")))
    whole, edge, split = sum(s for _, s in shares), 0.0, None
    for name, share in shares:
        edge += share / whole
        here = F.col("running") < F.col("total") * edge
        split = F.when(here, name) if split is None else split.when(here, name)
    assigned = ordered.crossJoin(total).select("component", split.otherwise(shares[-1][0]).alias("split_name"))
    return skewed_left_join(named, assigned, "component", ["id"]).withColumnRenamed("id", identifier)
