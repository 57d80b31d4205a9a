"""Parameter sweeps, estimates and descriptions, each in one pass over the scored rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from foreglass.operators.selection import ROW_KEY, _extreme, _group_statistics, ambiguous, combine, lower_is_better, top_absolute, top_z_score, with_group, with_positions, with_z_score
from foreglass.functions.vectors import not_nan

Z_VALUES = (1.0, 1.25, 1.5, 1.75, 2.0, 2.5, 3.0)
AMBIGUOUS_VALUES = (0.15, 0.2, 0.25, 0.3, 0.35, 0.4)


def _sweep(rows: DataFrame, name: str, kept: dict[float, object]) -> DataFrame:
    """``(parameter, value, n_rows, n_events)`` from one condition for each value."""
    found = rows.select("event_ticker", F.explode(F.array(*(F.struct(F.lit(float(v)).alias("value"), c.alias("kept")) for v, c in kept.items()))).alias("s")).filter("s.kept")
    counted = found.groupBy(F.col("s.value").alias("value"), "event_ticker").agg(F.count(F.lit(1)).alias("n"))
    sums = counted.groupBy("value").agg(F.sum("n").alias("n_rows"), F.count("event_ticker").alias("n_events"))
    values = rows.sparkSession.createDataFrame([(float(v),) for v in kept], "value double")
    out = values.join(F.broadcast(sums), "value", "left")  # a row for each value of the sweep
    return out.select(F.lit(name).alias("parameter"), "value", F.coalesce("n_rows", F.lit(0)).cast("long").alias("n_rows"), F.coalesce("n_events", F.lit(0)).cast("long").alias("n_events"))


def sweep_z(df: DataFrame, metric: str, row_id: str, values=Z_VALUES, max_mean: float = -1.0, min_val: float = -1.0) -> DataFrame:
    """Rows and events that each z threshold would keep; the z-score is computed once."""
    scored = with_z_score(df, metric, row_id, max_mean)
    if min_val > 0:
        scored = scored.filter(F.col(metric) <= min_val if lower_is_better(metric) else F.col(metric) >= min_val)
    return _sweep(scored, "min_z", {v: _extreme(metric, v) for v in values})


def sweep_ambiguous(df: DataFrame, metric: str, row_id: str, values=AMBIGUOUS_VALUES, max_val: float = 0.15, top_k: int = -1) -> DataFrame:
    """Rows and events that each ``min_val`` of the ambiguous filter would keep; positions are computed once."""
    stats = _group_statistics(df, metric).filter((F.col("scored") == F.col("group_size")) & (F.col("group_min") > max_val)).select("submission_id", F.lit(True).alias("kept_group"))
    rows = with_group(df, stats, [row_id]).filter("kept_group")
    if top_k > 0:
        # rows below a bound are the first of their group, so the place among all rows decides
        rows = with_positions(rows, metric, row_id).filter(F.col("position") <= top_k)
    return _sweep(rows, "min_val", {v: F.coalesce(not_nan(F.col(metric)) < v, F.lit(False)) for v in values})


def estimate_traces(df: DataFrame, metric: str, row_id: str, models: int, ratio: float, prefix: str = "market-baseline", z: dict | None = None, amb: dict | None = None, absolute: dict | None = None) -> DataFrame:
    """Rows of each filter, of their union, and the traces that augmenting them would give."""
    rows = df.filter(~F.col("forecaster").startswith(prefix))
    parts = {"z_score": top_z_score(rows, metric, row_id, **(z or {})), "ambiguous": ambiguous(rows, metric, row_id, **(amb or {}))}
    if absolute is not None:
        parts["absolute"] = top_absolute(rows, metric, row_id, **absolute)
    union = combine(list(parts.values()), row_id, rows)
    tagged = None
    for name, part in [*parts.items(), ("union", union)]:
        keyed = part.select(F.lit(name).alias("filter"), *ROW_KEY)
        tagged = keyed if tagged is None else tagged.union(keyed)
    counted = tagged.groupBy("filter").agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.withColumn("n_traces", F.floor(F.col("n_rows") * models * ratio).cast("long"))


def describe_schema(df: DataFrame) -> DataFrame:
    """``(column, dtype, non_null, nulls)`` of every column, in one aggregation."""
    counts = df.agg(F.count(F.lit(1)).alias("__all"), *(F.count(F.col(c)).alias(c) for c in df.columns))
    rows = F.array(*(F.struct(F.lit(c).alias("column"), F.lit(t).alias("dtype"), F.col(c).alias("non_null"), (F.col("__all") - F.col(c)).alias("nulls")) for c, t in df.dtypes))
    return counts.select(F.explode(rows).alias("r")).select("r.*")


def error_summary(errors: DataFrame) -> DataFrame:
    """Number of errors of each type."""
    return errors.filter("error_type is not null").groupBy("error_type").agg(F.count(F.lit(1)).alias("n"))


def report(sweeps: list[DataFrame], estimates: DataFrame) -> str:
    """The sweeps and estimates as text."""
    lines = []
    for sweep in sweeps:
        rows = sweep.orderBy("value").collect()  # one row for each value
        lines += [f"{rows[0].parameter}:"] if rows else []
        lines += [f"  {r.value:<6g} {r.n_rows:>10} rows {r.n_events:>8} events" for r in rows]
    lines += ["traces:"] + [f"  {r['filter']:<10} {r.n_rows:>10} rows {r.n_traces:>10} traces" for r in estimates.orderBy("filter").collect()]
    return "\n".join(lines)
