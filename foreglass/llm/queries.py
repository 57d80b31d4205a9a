"""Queries of the training-data operators, each over its whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from foreglass.llm.cutoff import cutoffs
from foreglass.llm.defects import defects
from foreglass.llm.language import Languages, labelled_sample
from foreglass.llm.leaks import leaks
from foreglass.llm.pieces import pieces
from foreglass.llm.raking import RakedSample
from foreglass.llm.splits import bound_labels, bound_pairs, members, plain_hex, plain_ticker, split_together
from foreglass.llm.tokens import encode
from foreglass.llm.topn import top_n
from foreglass.llm.truncation import truncated, truncation_rates


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _raked(spark: SparkSession, sf_dir: str) -> RakedSample:
    return RakedSample(read(spark, sf_dir, "sampled_rows"), read(spark, sf_dir, "category_targets"), "event_ticker", "submission_id", "category", margin="round")


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Categories whose target the raked, drawn and repaired sample misses for want of records."""
    return _raked(spark, sf_dir).unmet().select("category")


def p1_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target, supply and drawn rows of each category, and the gaps left."""
    return _raked(spark, sf_dir).report()


def p1_margins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target share and drawn rows of each round, the second margin, and the gaps left."""
    return _raked(spark, sf_dir).margin_report().withColumnRenamed("margin", "round")


def p1_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The drawn records."""
    return _raked(spark, sf_dir).rows.select(F.col("event").alias("event_ticker"), F.col("record").alias("submission_id"), "category")


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of tickers bound by shared submissions, directly or through a chain."""
    rows = read(spark, sf_dir, "predictions").select(plain_ticker(F.col("event_ticker")).alias("hub"), plain_hex(F.col("submission_id")).alias("spoke"))
    roots, _ = bound_labels(rows, "hub", "spoke")
    return bound_pairs(roots).select(F.col("a").alias("event_ticker_a"), F.col("b").alias("event_ticker_b"))


def p2_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every ticker with the smallest one it is bound to, and how many are bound together."""
    rows = read(spark, sf_dir, "predictions").select(plain_ticker(F.col("event_ticker")).alias("hub"), plain_hex(F.col("submission_id")).alias("spoke"))
    roots, _ = bound_labels(rows, "hub", "spoke")
    found = members(roots)
    sizes = found.groupBy("root").agg(F.count(F.lit(1)).alias("n_bound"))
    tickers = rows.select(F.col("hub").alias("vertex")).filter("vertex is not null").distinct()
    out = tickers.join(found.join(sizes, "root"), "vertex", "left")
    return out.select(F.col("vertex").alias("event_ticker"), F.coalesce("root", "vertex").alias("class"), F.coalesce("n_bound", F.lit(1)).cast("long").alias("n_bound"))


def p2_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The split of each prediction."""
    shares = [(r.split_name, r.share) for r in read(spark, sf_dir, "split_shares").collect()]  # some rows of configuration
    shares.sort(key=lambda s: (-s[1], s[0]))
    rows = split_together(read(spark, sf_dir, "predictions"), "prediction_id", plain_ticker(F.col("event_ticker")), plain_hex(F.col("submission_id")), shares)
    return rows.select("prediction_id", "component", "split_name")


def _truncated(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return truncated(read(spark, sf_dir, "model_outputs"), "output_id", "model", "content", "market_outcome")


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outputs that stop before the answer was finished."""
    return _truncated(spark, sf_dir)[0].filter("truncated").select("output_id")


def p3_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The share of broken-off outputs of each model."""
    return truncation_rates(_truncated(spark, sf_dir)[0]).withColumnRenamed("source", "model")


def p3_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lengths at which a model's outputs end far too often, and bands of lengths in which they break off."""
    return _truncated(spark, sf_dir)[1].withColumnRenamed("source", "model")


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of ``brier_scores`` with a submission and a score from 0 to 1."""
    return read(spark, sf_dir, "brier_scores").filter("submission_id is not null and not isnan(brier_score) and brier_score between 0 and 1")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three best-scored rows of each submission."""
    return top_n(scored(spark, sf_dir), "submission_id", ["brier_score", "forecaster", "score_id"], 3).select("submission_id", "score_id")


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows up to the score that keeps one fifth of each submission."""
    _, kept = cutoffs(scored(spark, sf_dir), "submission_id", "brier_score", "score_id", (1, 5))
    return kept.select(F.col("source").alias("submission_id"), F.col("id").alias("score_id"))


def p5_cutoffs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cutoff, scored and kept rows of each submission."""
    report, _ = cutoffs(scored(spark, sf_dir), "submission_id", "brier_score", "score_id", (1, 5))
    return report.withColumnRenamed("source", "submission_id")


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unusable answers with their kind of defect."""
    answers = {name: F.col(f"augmented_rationale.{name}") for name in ("source_analysis", "market_analysis", "rationale")}
    languages = Languages.fit(*labelled_sample(read(spark, sf_dir, "documents"), "doc_id", "text", "lang"))
    return defects(read(spark, sf_dir, "augmented_reasoning"), "aug_id", answers, ["title", "original_rationale"], "original_rationale", languages)


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document."""
    return encode(read(spark, sf_dir, "documents"), "doc_id", "text")


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold passages of evaluation items."""
    return leaks(read(spark, sf_dir, "documents"), "doc_id", "text", read(spark, sf_dir, "eval_items"), "item_id", "text")


def p10_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of every document over 512 tokens, with 64 tokens of overlap."""
    return pieces(read(spark, sf_dir, "documents"), "doc_id", "text", 512, 64)


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that have to be cut."""
    return p10_pieces(spark, sf_dir).filter("piece = 0").select("doc_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "p1_found": p1_found,
    "p1_report": p1_report,
    "p1_margins": p1_margins,
    "p1_sample": p1_sample,
    "p2_found": p2_found,
    "p2_members": p2_members,
    "p2_splits": p2_splits,
    "p3_found": p3_found,
    "p3_rates": p3_rates,
    "p3_lengths": p3_lengths,
    "p4_found": p4_found,
    "p5_found": p5_found,
    "p5_cutoffs": p5_cutoffs,
    "p6_found": p6_found,
    "p8_ids": p8_ids,
    "p9_found": p9_found,
    "p10_found": p10_found,
    "p10_pieces": p10_pieces,
}
