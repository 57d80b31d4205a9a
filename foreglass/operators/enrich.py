"""Joins that add sources, predictions, event details and market data to selected rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from foreglass.functions import text

SOURCE_FIELDS = ("url", "summary", "contributor", "title")


def aggregate_sources(usage: DataFrame, sources: DataFrame) -> DataFrame:
    """``(submission_id, sources)``: the distinct sources of each submission, sorted, as an array of structs.

    Distinct pairs are made before the shuffle by submission. A submission's
    array is bounded by its distinct sources.
    """
    pairs = usage.select("submission_id", "source_id").distinct().join(sources.select("source_id", *SOURCE_FIELDS), "source_id")
    return pairs.groupBy("submission_id").agg(F.array_sort(F.collect_set(F.struct(*SOURCE_FIELDS))).alias("sources"))


def by_contributor(df: DataFrame, contributors: list[str]) -> DataFrame:
    """Rows whose first source is by one of the contributors; the contributor is then dropped from all sources."""
    kept = df.filter((F.size("sources") > 0) & F.col("sources")[0]["contributor"].isin(contributors)) if contributors else df
    return without_contributor(kept)


def without_contributor(df: DataFrame) -> DataFrame:
    return df.withColumn("sources", F.transform("sources", lambda s: s.dropFields("contributor")))


def with_sources(df: DataFrame, aggregated: DataFrame) -> DataFrame:
    """Only rows whose submission has sources."""
    return df.join(aggregated, "submission_id")


def with_predictions(df: DataFrame, predictions: DataFrame) -> DataFrame:
    """Adds the prediction JSON of (submission, forecaster); rows without one are dropped."""
    return df.join(predictions.select("submission_id", "forecaster", "prediction").filter("prediction is not null"), ["submission_id", "forecaster"])


def with_event_details(df: DataFrame, events: DataFrame, categories: list[str] | None = None) -> DataFrame:
    """Adds title, category and rules, '' where missing. With ``categories`` only rows of these."""
    details = events.select("event_ticker", "title", "category", "rules")
    out = df.join(details, "event_ticker", "left")
    if categories:
        out = out.filter(F.col("category").isin(categories))
    return out.withColumns({c: F.coalesce(c, F.lit("")) for c in ("title", "category", "rules")})


def with_market_data(df: DataFrame, submissions: DataFrame) -> DataFrame:
    """Adds outcome and market data of the submission, parsed from any notation; each row of a repeated submission comes out."""
    parsed = submissions.select("submission_id", text.read_outcome(F.col("market_outcome")).alias("market_outcome"), text.read_prices(F.col("market_data")).alias("market_data"))
    return df.join(parsed, "submission_id", "left")


def enrich(df: DataFrame, aggregated: DataFrame, predictions: DataFrame, events: DataFrame, submissions: DataFrame, categories: list[str] | None = None) -> DataFrame:
    """Sources, prediction, event details and market data, in this order."""
    out = with_event_details(with_predictions(with_sources(df, aggregated), predictions), events, categories)
    return with_market_data(out, submissions)


def with_augmented_titles(df: DataFrame, augmented: DataFrame) -> DataFrame:
    """Replaces the title by the event's augmented one, unless that is null, empty or 'nan'."""
    titles = augmented.select("event_ticker", "augmented_title").distinct()
    out = df.join(titles, "event_ticker", "left")
    better = F.nullif(F.nullif(F.col("augmented_title"), F.lit("")), F.lit("nan"))
    return out.withColumn("title", F.coalesce(better, "title")).drop("augmented_title")


def paste(left: DataFrame, right: DataFrame, row_id: str) -> DataFrame:
    """Two tables side by side by an explicit row number; a row that only one of them has is an error."""
    both = left.withColumn("__left", F.lit(True)).join(right.withColumn("__right", F.lit(True)), row_id, "full_outer")
    whole = F.col("__left").isNotNull() & F.col("__right").isNotNull()
    return both.filter(F.when(whole, True).otherwise(F.raise_error(F.concat(F.lit("row without partner: "), F.col(row_id).cast("string"))).cast("boolean"))).drop("__left", "__right")


def sampled_with_details(sampled: DataFrame, titles: DataFrame, events: DataFrame, usage: DataFrame, sources: DataFrame) -> DataFrame:
    """Sampled rows with the event's augmented title and rules and, as JSON text, the distinct sources of the submission.

    All three are left joins: titles and rules may be null, a submission
    without sources has '[]'. Sources are objects of summary, source_id,
    ranking, title and url, sorted; repeated titles and events count once.
    """
    fields = [F.col("summary"), F.col("source_id"), F.col("popularity_score").alias("ranking"), F.col("title"), F.col("url")]
    pairs = usage.select("submission_id", "source_id").distinct().join(sources.select(*{*sources.columns}), "source_id")
    listed = pairs.groupBy("submission_id").agg(F.to_json(F.array_sort(F.collect_set(F.struct(*fields)))).alias("sources"))
    titled = sampled.join(titles.select("event_ticker", "augmented_title").distinct(), "event_ticker", "left")
    ruled = titled.join(events.select("event_ticker", "rules").distinct(), "event_ticker", "left")
    return ruled.join(listed, "submission_id", "left").withColumn("sources", F.coalesce("sources", F.lit("[]")))
