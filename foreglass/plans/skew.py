"""Salting of hot keys: a fixed number of rows for each salt, and a fixed bound on what is broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

#: A key is hot from this many rows on; each of its salts gets about so many.
HOT_ROWS = 100_000
#: Hot keys that are salted at most, the largest ones: the bound of the broadcast.
MOST_HOT_KEYS = 100_000


def hot_keys(df: DataFrame, key: str, hot_rows: int = HOT_ROWS, most: int = MOST_HOT_KEYS) -> DataFrame:
    """``(key, salts)`` of the keys with more than ``hot_rows`` rows, one salt for each ``hot_rows`` rows.

    Counts are combined before the shuffle. The result has at most ``most``
    rows, whatever the data, and may be broadcast: each task keeps its largest
    ``most`` before they meet. A key beyond them holds less than one part in
    ``most`` of all rows and is left to the adaptive skew join, which splits by
    bytes.
    """
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > hot_rows)
    return counts.orderBy(F.desc("__n"), key).limit(most).select(key, F.ceil(F.col("__n") / hot_rows).cast("int").alias("salts"))


def salted(df: DataFrame, key: str, spread: list[str], hot: DataFrame, salt: str = "salt") -> DataFrame:
    """``df`` with a salt: rows of a hot key go to several salts by the hash of ``spread``, other rows to salt 0."""
    hot = F.broadcast(hot.withColumnRenamed(key, "__hot_key"))
    return (
        df.join(hot, df[key] == F.col("__hot_key"), "left")
        .withColumn(salt, F.when(F.col("salts").isNull(), 0).otherwise(F.pmod(F.xxhash64(*spread), F.col("salts"))).cast("int"))
        .drop("__hot_key", "salts")
    )


def skewed_left_join(left: DataFrame, right: DataFrame, key: str, spread: list[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Left join on ``key`` where a key of ``left`` may hold a great part of its rows.

    Rows of hot keys are salted by ``spread``; the rows of ``right`` with such a
    key are repeated once for each salt. Both sides must use the same name for
    ``key``; null keys find no partner.
    """
    hot = hot_keys(left.filter(F.col(key).isNotNull()), key, hot_rows)
    left = salted(left, key, spread, hot, "__salt")
    hot = F.broadcast(hot.withColumnRenamed(key, "__hot_key"))
    right = right.join(hot, right[key] == F.col("__hot_key"), "left").withColumn("__salt", F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1)))
    return left.join(right.drop("__hot_key", "salts"), [key, "__salt"], "left").drop("__salt")
