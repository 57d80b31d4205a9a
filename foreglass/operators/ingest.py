"""From raw predictions and market snapshots to scored-ready forecasts."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window, functions as F

from foreglass.functions import text
from foreglass.functions.vectors import price_vector, same_length, sorted_values
from foreglass.operators.weights import WeightFunction, uniform, with_time_rank

#: Least liquidity of a usable market row.
MIN_LIQUIDITY = 100


def time_window(column: str, after: str | datetime | None, before: str | datetime | None) -> Column:
    """Strictly after and strictly before; an open side is None."""
    kept = F.lit(True)
    if after is not None:
        kept = kept & (F.col(column) > F.lit(after).cast("timestamp_ntz"))
    if before is not None:
        kept = kept & (F.col(column) < F.lit(before).cast("timestamp_ntz"))
    return kept


def scan_predictions(df: DataFrame, after=None, before=None, agents_only: bool = False) -> DataFrame:
    rows = df.filter(time_window("created_at", after, before))
    return rows.filter(F.col("forecaster").startswith("agent-")) if agents_only else rows


def scan_submissions(df: DataFrame, after=None, before=None) -> DataFrame:
    return df.filter(time_window("snapshot_time", after, before))


def scan_events(df: DataFrame) -> DataFrame:
    """Events whose outcome is known."""
    return df.filter(F.col("market_outcome").isNotNull())


def valid_market(use_bid: bool = False) -> Column:
    """A usable market row: both asks above zero, enough liquidity and, with bids, both bids present."""
    ok = (F.col("yes_ask") > 0) & (F.col("no_ask") > 0) & (F.col("liquidity") >= MIN_LIQUIDITY)
    if use_bid:
        ok = ok & F.col("yes_bid").isNotNull() & F.col("no_bid").isNotNull()
    return F.coalesce(ok, F.lit(False))


def canonical_markets(markets: DataFrame) -> DataFrame:
    """``(event_ticker, titles)``: the distinct titles of each event's first snapshot, sorted."""
    first = markets.groupBy("event_ticker").agg(F.min("created_at").alias("created_at"))
    titles = markets.join(first, ["event_ticker", "created_at"]).select("event_ticker", "market_title").distinct()
    return titles.groupBy("event_ticker").agg(F.array_sort(F.collect_list("market_title")).alias("titles"))


def complete_snapshots(markets: DataFrame, canonical: DataFrame, row_id: str) -> DataFrame:
    """``(event_ticker, created_at, market_data)`` of the snapshots that hold all canonical titles, each title's first row by ``row_id``."""
    one = markets.groupBy("event_ticker", "created_at", "market_title").agg(F.min_by(F.struct("yes_ask", "yes_bid", "no_ask", "no_bid", "liquidity"), row_id).alias("prices"))
    wanted = canonical.select("event_ticker", F.explode("titles").alias("market_title"), F.size("titles").alias("n_titles"))
    held = one.join(wanted, ["event_ticker", "market_title"])
    grouped = held.groupBy("event_ticker", "created_at").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("market_title", "prices")))).alias("market_data"), F.first("n_titles").alias("n_titles"), F.count(F.lit(1)).alias("n"))
    return grouped.filter("n = n_titles").select("event_ticker", "created_at", "market_data")


def with_round(snapshots: DataFrame, time: str = "created_at", tiebreak: tuple[str, ...] = ()) -> DataFrame:
    """Adds ``round``: 0 for an event's first snapshot."""
    return snapshots.withColumn("round", F.row_number().over(Window.partitionBy("event_ticker").orderBy(time, *tiebreak)) - 1)


def process(predictions: DataFrame, submissions: DataFrame, markets: DataFrame, events: DataFrame, use_bid: bool = False) -> tuple[DataFrame, DataFrame]:
    """``(predictions, submissions)`` with rounds, market data and outcomes.

    Markets of known events, usable rows, snapshots that hold all canonical
    markets, numbered; submissions find their snapshot by its time alone, so
    two submissions at one time both come out; only submissions with a
    prediction stay.
    """
    events = scan_events(events).select("event_ticker", "title", "market_outcome", "category", "close_time")
    known = markets.join(events.select("event_ticker"), "event_ticker", "left_semi").filter(valid_market(use_bid))
    known = known.withColumn("__row", F.struct(*sorted(known.columns)))
    canonical = canonical_markets(known)
    snapshots = with_round(complete_snapshots(known, canonical, "__row")).withColumnRenamed("created_at", "snapshot_time")
    full = snapshots.join(events, "event_ticker")
    ids = submissions.select(F.col("submission_id").alias("found_id"), "snapshot_time")
    full = full.join(ids, "snapshot_time", "left").withColumn("submission_id", F.coalesce("found_id", F.lit(""))).drop("found_id")
    times = submissions.select("submission_id", "snapshot_time")
    joined = predictions.join(times, "submission_id").join(full.select("event_ticker", "snapshot_time", "title", "round").distinct(), ["event_ticker", "snapshot_time"])
    kept = full.join(joined.select("submission_id").distinct(), "submission_id", "left_semi")
    return joined, kept


def load(predictions: DataFrame, submissions: DataFrame, markets: DataFrame | None, events: DataFrame, after=None, before=None, agents_only: bool = False, exclude: list[str] | None = None, use_bid: bool = False) -> dict[str, DataFrame]:
    """The tables ``predictions`` and ``submissions`` in a time window, without the excluded forecasters.

    With ``markets`` they are the raw tables of a database and go through
    ``process``: rounds, market data and outcomes come from the snapshots. Else
    they have them already.
    """
    if "created_at" in predictions.columns:
        predictions = scan_predictions(predictions, after, before, agents_only)
    submissions = scan_submissions(submissions, after, before)
    if exclude:
        predictions = predictions.filter(~F.col("forecaster").isin(exclude))
    if markets is None:
        return {"predictions": predictions, "submissions": submissions}
    made, kept = process(predictions.drop("round", "title"), submissions, markets, events, use_bid)
    texts = {c: F.to_json(c) for c in ("market_data", "market_outcome") if dict(kept.dtypes)[c] != "string"}
    return {"predictions": made, "submissions": kept.withColumns(texts)}


def forecasts_from_tables(predictions: DataFrame, submissions: DataFrame, markets: DataFrame, events: DataFrame, weight: WeightFunction = uniform, **window) -> DataFrame:
    """Forecast rows straight from the four raw tables of a database; ``window`` holds the options of ``load``."""
    loaded = load(predictions, submissions, markets, events, **window)
    return parse_and_merge(loaded["predictions"], loaded["submissions"], weight)


def parse_and_merge(predictions: DataFrame, submissions: DataFrame, weight: WeightFunction = uniform, on: tuple[str, ...] = ("event_ticker", "round")) -> DataFrame:
    """Forecast rows with vectors ordered by market name, ``time_rank`` and ``weight``.

    Rows whose three vectors differ in length are dropped; only lengths are
    compared, not names. JSON counts in any notation that ``text.plain_json``
    reads; unreadable JSON gives null vectors and so no row.
    """
    told = text.read_prediction(F.col("prediction"))
    read = predictions.select("forecaster", "submission_id", *on, told.alias("told"))
    left = read.select("forecaster", "submission_id", *on, sorted_values(text.read_probabilities(F.col("told.probabilities"))).alias("prediction"), F.col("told.rationale").alias("rationale"))
    read = submissions.select(*on, "snapshot_time", "close_time", text.read_prices(F.col("market_data")).alias("prices"), text.read_outcome(F.col("market_outcome")).alias("outcome"))
    right = read.select(*on, "snapshot_time", "close_time", price_vector(F.col("prices"), "yes_ask").alias("odds"), price_vector(F.col("prices"), "no_ask").alias("no_odds"), sorted_values(F.col("outcome")).alias("market_outcome"))
    rows = left.join(right, list(on)).filter(same_length(F.col("prediction"), F.col("odds"), F.col("market_outcome")))
    return weight(with_time_rank(rows))
