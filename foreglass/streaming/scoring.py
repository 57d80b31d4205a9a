"""Scoring of model outputs as they arrive. The scores are row-local, so batch and stream share one expression."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from foreglass.functions.text import plain_json, probabilities_of, read_outcome, split_thinking, tagged_probabilities
from foreglass.operators.metrics import brier_of_maps


def score_outputs(df: DataFrame) -> DataFrame:
    """Adds ``prediction`` (market -> probability) and ``brier_score`` to rows with ``content`` and ``market_outcome``; both null if unreadable.

    Probabilities and outcomes count in any notation that ``text.plain_json`` reads.
    """
    _, content = split_thinking(F.col("content"))
    read = df.withColumns({"__block": plain_json(tagged_probabilities(content)), "__outcome": read_outcome(F.col("market_outcome"))})
    scored = read.withColumn("prediction", probabilities_of(F.col("__block")))
    return scored.withColumn("brier_score", brier_of_maps(F.col("prediction"), F.col("__outcome"))).drop("__block", "__outcome")


def stream_scores(spark: SparkSession, source: str, schema: StructType, sink: str, checkpoint: str):
    """Scores new files of ``source`` into parquet files; every input row is written once."""
    rows = score_outputs(spark.readStream.schema(schema).parquet(source))
    return rows.writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
