"""Exact positions and running totals over globally sorted rows, without a single-partition window."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from foreglass.plans.skew import skewed_left_join
from foreglass.session import cut, partitions

#: Rows of a task that are pruned together.
BLOCK_ROWS = 200_000


def range_sorted(df: DataFrame, order: list[str]) -> DataFrame:
    """``df`` sorted by ``order`` over all partitions, cut, with the partition's number as ``__part``.

    Equal keys always land in one partition. Key columns must not be NaN. The
    number of partitions follows the size of the input.
    """
    df = df.repartitionByRange(partitions(df), *order).sortWithinPartitions(*order)
    return cut(df.withColumn("__part", F.spark_partition_id()))


def run_starts(keys: pa.Array) -> np.ndarray:
    """True where a value differs from the one before it (the first is always True)."""
    first = np.ones(len(keys), bool)
    if len(keys) > 1:
        a, b = keys[1:], keys[:-1]
        first[1:] = pc.if_else(pc.or_(pc.is_null(a), pc.is_null(b)), pc.xor(pc.is_null(a), pc.is_null(b)), pc.fill_null(pc.not_equal(a, b), False)).to_numpy(zero_copy_only=False)
    return first


class _Counter:
    """Counts the distinct rows of each group along sorted batches."""

    def __init__(self, group: str, order: list[str]):
        self.group, self.order, self.last_row, self.last_group, self.count = group, order, None, None, 0

    def positions(self, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, pa.Array]:
        """(indices of rows that repeat no row before them, their positions from 1, their groups)."""
        fresh = np.zeros(batch.num_rows, bool)
        for name in self.order:
            fresh |= run_starts(batch.column(name))
        row = tuple(batch.column(name)[0].as_py() for name in self.order)
        fresh[0] = row != self.last_row
        self.last_row = tuple(batch.column(name)[batch.num_rows - 1].as_py() for name in self.order)
        index = np.flatnonzero(fresh)
        groups = batch.column(self.group).take(pa.array(index))
        if not len(index):
            return index, index, groups
        starts = run_starts(groups)
        same = groups[0].as_py() == self.last_group and self.last_group is not None
        place = np.arange(len(index))
        start = np.maximum.accumulate(np.where(starts, place, 0))
        position = place - start + 1
        if same:
            first_run = len(index) if not starts[1:].any() else int(np.argmax(starts[1:])) + 1
            position[:first_run] += self.count
        self.last_group, self.count = groups[len(index) - 1].as_py(), int(position[-1])
        return index, position, groups


def group_positions(df: DataFrame, group: str, order: list[str], keep: int | None = None) -> DataFrame:
    """Distinct rows of ``df`` with their exact position in the group, from 1, in the order ``group, *order``.

    One range-partitioned sort; then each partition counts its first and last
    group, the counts are prefix-summed (two rows for each partition reach the
    driver, whatever the data's size) and added to the local positions, so
    that a group may span any number of partitions. Rows equal in all keys
    count once. ``group`` must not be null. With ``keep`` only positions up to
    it come out.
    """
    keys = [group, *order]
    ordered = range_sorted(df, keys)

    def edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter, part, first, n_first, done = _Counter(group, keys), None, None, 0, False
        for batch in batches:
            if not batch.num_rows:
                continue
            part = batch.column("__part")[0].as_py()
            index, position, groups = counter.positions(batch)
            if first is None and len(index):
                first = groups[0].as_py()
            if len(index) and not done:
                own = np.flatnonzero(~np.asarray(pc.equal(groups, pa.scalar(first, groups.type)).to_numpy(zero_copy_only=False)))
                end = own[0] if len(own) else len(index)
                n_first = int(position[end - 1]) if end else n_first
                done = bool(len(own))
        if part is not None:
            yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "first": pa.array([str(first)]), "n_first": pa.array([n_first], pa.int64()), "last": pa.array([str(counter.last_group)]), "n_last": pa.array([counter.count], pa.int64())})

    found = ordered.select(*keys, "__part").mapInArrow(edges, "part int, first string, n_first long, last string, n_last long").collect()
    offsets, run, count = {}, None, 0
    for row in sorted(found, key=lambda r: r.part):
        offsets[row.part] = count if row.first == run else 0
        count = offsets[row.part] + row.n_first if row.first == row.last else row.n_last
        run = row.last

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter, lead, leading = _Counter(group, keys), None, True
        for batch in batches:
            if not batch.num_rows:
                continue
            index, position, groups = counter.positions(batch)
            if not len(index):
                continue
            if leading:
                lead = groups[0].as_py() if lead is None else lead
                offset = offsets.get(batch.column("__part")[0].as_py(), 0)
                mine = pc.equal(groups, pa.scalar(lead, groups.type)).to_numpy(zero_copy_only=False)
                position = position + np.where(mine, offset, 0)
                leading = bool(mine.all())
            if keep is not None:
                chosen = position <= keep
                index, position = index[chosen], position[chosen]
            if len(index):
                rows = batch.take(pa.array(index))
                columns = [rows.column(n) for n in names] + [pa.array(position, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=[*names, "position"])

    names = [c for c in ordered.columns if c != "__part"]
    schema = T.StructType([*(f for f in ordered.schema.fields if f.name != "__part"), T.StructField("position", T.LongType())])
    return ordered.mapInArrow(place, schema)


def running_total(df: DataFrame, order: list[str], weight: str, total: str = "running") -> DataFrame:
    """``df`` with the sum of ``weight`` over all rows before each row in the order ``order`` (a total order).

    Sums by range partition reach the driver: one number for each partition.
    """
    ordered = range_sorted(df, order)
    sums = {r["__part"]: r["s"] for r in ordered.groupBy("__part").agg(F.sum(weight).alias("s")).collect()}
    before, acc = {}, 0
    for part in sorted(sums):
        before[part], acc = acc, acc + (sums[part] or 0)
    names = [c for c in ordered.columns if c != "__part"]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carried = None
        for batch in batches:
            if not batch.num_rows:
                continue
            carried = before[batch.column("__part")[0].as_py()] if carried is None else carried
            values = np.nan_to_num(batch.column(weight).to_numpy(zero_copy_only=False).astype("float64"))
            sums_ = np.cumsum(values)
            out = carried + sums_ - values
            carried += float(sums_[-1])
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(out, pa.float64())], names=[*names, total])

    schema = T.StructType([*(f for f in ordered.schema.fields if f.name != "__part"), T.StructField(total, T.DoubleType())])
    return ordered.mapInArrow(add, schema)


def best_of_blocks(df: DataFrame, group: str, order: list[str], n: int, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``df`` with only the ``n`` first distinct rows of each group among the rows of a block of a task, in the order ``order``.

    Nothing is shuffled. Before a sort it shrinks a hot group to ``n`` rows for
    each block. Keys ascend, nulls first; all columns stay.
    """
    keys = [group, *order]

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= block_rows:
                yield from prune(held)
                held, rows = [], 0
        if rows:
            yield from prune(held)

    def prune(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(held)
        sort = pc.sort_indices(table.select(keys), sort_keys=[(k, "ascending") for k in keys], null_placement="at_start")
        columns = [table.column(k).take(sort).combine_chunks() for k in keys]
        fresh = np.zeros(table.num_rows, bool)
        for column in columns:
            fresh |= run_starts(column)
        rank = np.cumsum(fresh)
        base = np.maximum.accumulate(np.where(run_starts(columns[0]), rank, 0))
        yield from table.take(sort.filter(pa.array(fresh & (rank - base < n)))).to_batches()

    return df.mapInArrow(best, df.schema)


def exact_quantiles(df: DataFrame, keys: list[str], value: str, points: list[float]) -> DataFrame:
    """``(*keys, quantiles)``: exact interpolated quantiles of ``value`` for each combination of ``keys``, or of all rows.

    Equal values are counted before they are shuffled; the counted values are
    range-sorted and their counts prefix-summed, so no task holds the values of
    a key. Null and NaN values and null keys are left out.
    """
    keep = F.col(value).isNotNull() & ~F.isnan(value)
    for k in keys:
        keep = keep & F.col(k).isNotNull()
    counted = df.filter(keep).groupBy(*keys, F.col(value).cast("double").alias("__v")).agg(F.count(F.lit(1)).alias("__n"))
    placed = running_total(counted, [*keys, "__v"], "__n", "__before")
    wholes = placed.groupBy(*keys).agg(F.min("__before").alias("__start"), F.sum("__n").alias("__total"))
    if len(keys) == 1:
        joined = skewed_left_join(placed, wholes, keys[0], ["__v"])
    else:
        joined = placed.join(wholes, keys) if keys else placed.crossJoin(F.broadcast(wholes))  # one row
    place = F.col("__before") - F.col("__start")
    at = lambda h: F.max(F.when(place <= h, F.col("__v")))
    last = F.col("__total") - 1
    found = joined.groupBy(*keys).agg(F.first("__total").alias("__total"), *(f(i, q) for i, q in enumerate(points) for f in (lambda i, q: at(F.floor(last * q)).alias(f"__lo{i}"), lambda i, q: at(F.ceil(last * q)).alias(f"__hi{i}"))))
    value_at = lambda i, q: F.col(f"__lo{i}") + (F.col(f"__hi{i}") - F.col(f"__lo{i}")) * (last * q - F.floor(last * q))
    return found.filter("__total is not null").select(*keys, F.array(*(value_at(i, q) for i, q in enumerate(points))).alias("quantiles"))
