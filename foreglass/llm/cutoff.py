"""Problem 5: a score cutoff for each source that keeps a target fraction.

Method: multi-sequence selection. The scores lie in locally sorted arrays,
written once; in every round the arrays of all open sources propose pivots, the
pivots are ranked in every array by searchsorted, and the summed ranks narrow
the index range of every source until its cutoff is found.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from foreglass.plans.prefix import run_starts
from foreglass.session import partitions, written

#: Most rows of an array.
ARRAY_ROWS = 50_000
#: Pivots of a source in a round: the expected place in each array, and places this many standard deviations around it.
SPREAD = (-4.0, -1.0, -0.25, 0.0, 0.25, 1.0, 4.0)
#: Percentiles of the expected place over the arrays, for open parts of a few scores each.
PERCENTILES = (0.02, 0.1, 0.3, 0.7, 0.9, 0.98)
#: An open range of so many scores is settled by making all of them pivots.
FEW = 64


def sorted_arrays(df: DataFrame, source: str, score: str, identifier: str, rows: int = ARRAY_ROWS) -> DataFrame:
    """``(source, array, scores, ids)``: the rows of each source as arrays sorted by score, each of at most ``rows`` rows.

    One shuffle by ranges of (source, hash of the identifier): a partition's
    rows follow from the size of the input, however large a source is, which
    then lies in as many partitions as it needs. Copies of a row meet in one
    partition, where they count once.
    """
    df = df.select(F.col(source).alias("source"), F.col(score).cast("double").alias("score"), F.col(identifier).alias("id"))
    ranged = df.repartitionByRange(partitions(df), "source", F.xxhash64("id"), "id").sortWithinPartitions("source", "score", "id")

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            while size >= rows:
                table = pa.Table.from_batches(held)
                yield from arrays(table.slice(0, rows))
                rest = table.slice(rows)
                held, size = rest.to_batches(), rest.num_rows
        if size:
            yield from arrays(pa.Table.from_batches(held))

    last: list = []

    def arrays(table: pa.Table) -> Iterator[pa.RecordBatch]:
        table = table.combine_chunks()
        source, scores, ids = (table.column(c).chunk(0) for c in ("source", "score", "id"))
        new_source = run_starts(source)
        fresh = new_source | run_starts(scores) | run_starts(ids)
        row = (source[0].as_py(), scores[0].as_py(), ids[0].as_py())
        fresh[0] = [row] != last
        last[:] = [tuple(c[len(c) - 1].as_py() for c in (source, scores, ids))]
        begins = np.flatnonzero(new_source)
        counts = np.add.reduceat(fresh.astype(np.int64), begins)
        offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
        some = pa.array(counts > 0)
        lists = [pa.ListArray.from_arrays(offsets, c.filter(pa.array(fresh))).filter(some) for c in (scores, ids)]
        yield pa.RecordBatch.from_arrays([source.take(pa.array(begins)).filter(some), *lists], names=["source", "scores", "ids"])

    kinds = {f.name: f.dataType for f in df.schema.fields}
    schema = T.StructType([T.StructField("source", kinds["source"]), T.StructField("scores", T.ArrayType(T.DoubleType())), T.StructField("ids", T.ArrayType(kinds["id"]))])
    return ranged.mapInArrow(gather, schema).withColumn("array", F.monotonically_increasing_id())


def _proposals(open_arrays: DataFrame) -> DataFrame:
    """``(source, pivots)``: scores of the open parts of a source's arrays, near where the cutoff is expected.

    Each array proposes the ends of its open part and the scores around the
    expected place in it. A source's pivots are the medians of these over its
    arrays and further percentiles of the expected place: sketches of fixed
    size, combined before the shuffle, that return proposed scores. Of an open
    range that was narrowed to ``FEW`` scores all are pivots.
    """
    slots = [f"s{i}" for i in range(len(SPREAD) + 2)]

    def propose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, first, begin, width = _open_ranges(batch)
            share = (batch.column("k").to_numpy() - batch.column("before").to_numpy()) / batch.column("open").to_numpy()
            deviation = np.sqrt(np.maximum(share * (1 - share) * width, 0.25))
            places = [np.zeros_like(width), width - 1] + [np.clip(np.rint(share * width + s * deviation).astype(np.int64) - 1, 0, width - 1) for s in SPREAD]
            use = np.flatnonzero(width > 0)
            columns = [pa.array(values[(first + begin + place)[use]]) for place in places]
            narrowed = batch.column("low").is_valid().to_numpy(zero_copy_only=False) | batch.column("high").is_valid().to_numpy(zero_copy_only=False)
            sizes = np.where(narrowed & (batch.column("open").to_numpy() <= FEW), width, 0)[use]
            ends = np.cumsum(sizes)
            few = values[np.repeat((first + begin)[use] - (ends - sizes), sizes) + np.arange(sizes.sum())]
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(few))
            yield pa.RecordBatch.from_arrays([batch.column("source").take(pa.array(use)), *columns, lists], names=["source", *slots, "few"])

    kind = open_arrays.schema["source"].dataType.simpleString()
    picked = open_arrays.mapInArrow(propose, f"source {kind}, " + ", ".join(f"{s} double" for s in slots) + ", few array<double>")
    middle = slots[2 + SPREAD.index(0.0)]
    medians = F.array(*(F.percentile_approx(s, 0.5, 1000) for s in slots))
    around = F.percentile_approx(middle, list(PERCENTILES), 1000)
    return picked.groupBy("source").agg(F.array_distinct(F.concat(medians, around, F.flatten(F.collect_list("few")))).alias("pivots"))


def _values(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """All scores of the arrays of a batch one after another, and where each array begins."""
    scores = batch.column("scores")
    offsets = scores.offsets.to_numpy()
    return scores.values.to_numpy(zero_copy_only=False), offsets[:-1]


def _open_ranges(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All scores, where each array begins, and begin and length of its open part: above ``low`` and below ``high``, where these are known."""
    values, first = _values(batch)
    begin, end = np.zeros(batch.num_rows, np.int64), np.diff(batch.column("scores").offsets.to_numpy()).astype(np.int64)
    for bound, side, place in (("low", "right", begin), ("high", "left", end)):
        column = batch.column(bound)
        limit = column.to_numpy(zero_copy_only=False)
        sizes = np.diff(batch.column("scores").offsets.to_numpy())
        for i in np.flatnonzero(column.is_valid().to_numpy(zero_copy_only=False)):
            place[i] = np.searchsorted(values[first[i]:first[i] + sizes[i]], limit[i], side)
    return values, first, begin, np.maximum(end - begin, 0)


def _ranks(arrays: DataFrame) -> DataFrame:
    """``(source, pivot, below, upto)``: scores below and up to each pivot, over all arrays of its source."""

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, first = _values(batch)
            n = np.diff(batch.column("scores").offsets.to_numpy())
            pivots = batch.column("pivots")
            at, flat = pivots.offsets.to_numpy(), pivots.values.to_numpy(zero_copy_only=False)
            below, upto = np.zeros(len(flat), np.int64), np.zeros(len(flat), np.int64)
            for i in range(batch.num_rows):
                own, mine = values[first[i]:first[i] + n[i]], slice(at[i], at[i + 1])
                below[mine], upto[mine] = np.searchsorted(own, flat[mine], "left"), np.searchsorted(own, flat[mine], "right")
            row = np.repeat(np.arange(batch.num_rows), np.diff(at))
            used = slice(at[0], at[-1])
            yield pa.RecordBatch.from_arrays([batch.column("source").take(pa.array(row)), pa.array(flat[used]), pa.array(below[used]), pa.array(upto[used])], names=["source", "pivot", "below", "upto"])

    kind = arrays.schema["source"].dataType.simpleString()
    counted = arrays.mapInArrow(rank, f"source {kind}, pivot double, below long, upto long")
    return counted.groupBy("source", "pivot").agg(F.sum("below").alias("below"), F.sum("upto").alias("upto"))


def _narrowed(state: DataFrame, counts: DataFrame) -> DataFrame:
    """The state after a round: the cutoff where a pivot is the one, else a smaller open range."""
    k, here = F.col("k"), F.struct("pivot", "below", "upto")
    found = counts.join(state.select("source", "k"), "source").groupBy("source").agg(
        F.min(F.when((F.col("below") < k) & (k <= F.col("upto")), F.col("pivot"))).alias("found"),
        F.max(F.when(F.col("upto") < k, here)).alias("lower"),
        F.min(F.when(F.col("below") >= k, here)).alias("upper"),
    )
    joined = state.drop("cutoff").join(found, "source")
    end = F.coalesce("upper.below", F.col("before") + F.col("open"))
    begin = F.coalesce("lower.upto", "before")
    return joined.select("source", "n", "k", begin.alias("before"), (end - begin).alias("open"), F.coalesce("lower.pivot", "low").alias("low"), F.coalesce("upper.pivot", "high").alias("high"), F.col("found").alias("cutoff"))


def select_ranks(arrays: DataFrame, wanted: DataFrame) -> tuple[DataFrame, int]:
    """``((source, n, cutoff), rounds)``: the k-th lowest score of each source in ``wanted(source, n, k)``, over all its arrays.

    The state of a round, an index range for each open source, is a table; the
    driver only sees whether one is open. Pivots lie in the open range, so
    every round takes at least one distinct score from it. Infinite scores are
    scores like others: bounds that are not known yet are null. Only the
    directory of the arrays is joined by source, the scores by array.
    """
    places, scores = arrays.select("source", "array"), arrays.select("array", "scores")
    nothing = F.lit(None).cast("double")
    state = written(wanted.select("source", "n", "k", F.lit(0).cast("long").alias("before"), F.col("n").alias("open"), nothing.alias("low"), nothing.alias("high"), nothing.alias("cutoff")))
    found, rounds = state.filter("cutoff is not null").select("source", "n", "cutoff"), 0
    while not state.filter("cutoff is null").isEmpty():
        rounds += 1
        still = state.filter("cutoff is null")
        pivots = _proposals(places.join(still, "source").join(scores, "array"))
        counts = _ranks(places.join(pivots, "source").join(scores, "array").select("source", "scores", "pivots"))
        state = written(_narrowed(still, counts))
        found = found.union(state.filter("cutoff is not null").select("source", "n", "cutoff"))
    return found, rounds


def cutoffs(df: DataFrame, source: str, score: str, identifier: str, share: tuple[int, int], array_rows: int = ARRAY_ROWS) -> tuple[DataFrame, DataFrame]:
    """``(report, kept)`` for keeping ``share[0] / share[1]`` of each source, lowest scores first.

    ``report(source, cutoff, n_scored, n_kept)``; ``kept(source, id, score)``.
    With n rows in a source the cutoff is its k-th lowest score, k = max(1,
    floor(n * share)); every row up to and including the cutoff is kept, so
    ties may keep more than k. Null sources, null and NaN scores are left out;
    copies of a row count once. An empty input gives two empty results.
    """
    df = df.filter(F.col(source).isNotNull() & F.col(score).isNotNull() & ~F.isnan(score))
    arrays = written(sorted_arrays(df, source, score, identifier, array_rows))
    p, q = share
    sizes = arrays.groupBy("source").agg(F.sum(F.size("scores")).alias("n"))
    found, _ = select_ranks(arrays, sizes.withColumn("k", F.greatest(F.lit(1), F.expr(f"n * {p} div {q}"))))
    decided = arrays.select("source", "array").join(found, "source").join(arrays.drop("source"), "array")
    decided = decided.withColumn("kept", F.size(F.filter("scores", lambda s: s <= F.col("cutoff"))))
    report = decided.groupBy("source").agg(F.first("cutoff").alias("cutoff"), F.first("n").alias("n_scored"), F.sum("kept").alias("n_kept"))
    kept = decided.select("source", F.explode(F.slice(F.arrays_zip("ids", "scores"), F.lit(1), F.col("kept"))).alias("row")).select("source", F.col("row.ids").alias("id"), F.col("row.scores").alias("score"))
    return report, kept
