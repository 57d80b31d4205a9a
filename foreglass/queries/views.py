"""The test tables in the shape of forecasts, in Spark and as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from foreglass.functions.vectors import not_nan


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def forecasts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as forecasts: customer = event, order = submission, supplier = forecaster, segment = category, three markets."""
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.col("o_orderdate").alias("snapshot_time"))
    orders = orders.withColumn("round", F.row_number().over(Window.partitionBy("o_custkey").orderBy("snapshot_time", "o_orderkey")).cast("long") - 1)
    customers = read(spark, sf_dir, "customer").select("c_custkey", F.col("c_mktsegment").alias("category"))
    rows = read(spark, sf_dir, "lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(customers, F.col("o_custkey") == F.col("c_custkey"))
    key = F.col("o_orderkey") * 31
    asks = [(1 + (key + 17 * (i + 1)) % 98) / 100.0 for i in range(3)]
    no_asks = [(100 - (key + 17 * (i + 1)) % 98) / 100.0 for i in range(3)]
    row_id = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", F.date_format("l_shipdate", "yyyyMMdd"))
    return rows.select(
        F.concat(F.lit("S"), "l_suppkey").alias("forecaster"), F.concat(F.lit("E"), "o_custkey").alias("event_ticker"), F.concat(F.lit("O"), "o_orderkey").alias("submission_id"),
        "category", "snapshot_time", "round", row_id.alias("row_id"), F.lit(1.0).alias("weight"),
        F.array(F.col("l_discount") * 10, (F.col("l_quantity") - 1) / 49, F.col("l_tax") / 0.08).alias("prediction"),
        F.array(*(F.when(F.col("o_custkey") % 3 == i, 1.0).otherwise(0.0) for i in range(3))).alias("market_outcome"),
        F.array(*asks).alias("odds"), F.array(*no_asks).alias("no_odds"),
    )


FORECASTS_SQL = """
 fx as (select concat('S', cast(l_suppkey as varchar)) forecaster, concat('E', cast(o_custkey as varchar)) event_ticker, concat('O', cast(o_orderkey as varchar)) submission_id,
  c_mktsegment category, o_orderdate snapshot_time, round, 1.0::double weight,
  concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, cast(l_quantity as varchar), strftime(l_shipdate, '%Y%m%d')) row_id,
  l_discount*10 p1, (l_quantity-1)/49 p2, l_tax/0.08 p3,
  case when o_custkey%3=0 then 1.0e0 else 0.0e0 end y1, case when o_custkey%3=1 then 1.0e0 else 0.0e0 end y2, case when o_custkey%3=2 then 1.0e0 else 0.0e0 end y3,
  (1+(o_orderkey*31+17)%98)/100.0e0 a1, (1+(o_orderkey*31+34)%98)/100.0e0 a2, (1+(o_orderkey*31+51)%98)/100.0e0 a3,
  (100-(o_orderkey*31+17)%98)/100.0e0 n1, (100-(o_orderkey*31+34)%98)/100.0e0 n2, (100-(o_orderkey*31+51)%98)/100.0e0 n3
  from lineitem join (select *, row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) - 1 round from orders) o on l_orderkey = o_orderkey
  join customer on o_custkey = c_custkey),
 sc as (select *, ((p1-y1)*(p1-y1) + (p2-y2)*(p2-y2) + (p3-y3)*(p3-y3)) / 3 brier_score from fx)"""


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``brier_scores`` once for each delivered row, missing and impossible scores as null."""
    rows = read(spark, sf_dir, "brier_scores").distinct()
    value = not_nan(F.col("brier_score"))
    return rows.withColumn("brier_score", F.when(value.between(0, 1), value)).withColumnRenamed("score_id", "row_id")


SCORES_SQL = " b as (select distinct score_id row_id, forecaster, event_ticker, submission_id, weight, round, case when not isnan(brier_score) and brier_score between 0 and 1 then brier_score end brier_score from brier_scores)"


def markets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as market rows: user = event, type = market, day = snapshot; the lowest id of a (user, day, type)."""
    rows = read(spark, sf_dir, "events").select(F.concat(F.lit("U"), "user_id").alias("event_ticker"), F.col("event_type").alias("market_title"), F.date_trunc("day", "ts").cast("timestamp_ntz").alias("created_at"), "event_id", (1 + F.col("event_id") % 99).cast("double").alias("yes_ask"), (F.col("value") * 10).alias("liquidity"), F.get_json_object("props", "$.k").cast("double").alias("yes_bid"))
    one = rows.groupBy("event_ticker", "created_at", "market_title").agg(F.min_by(F.struct("event_id", "yes_ask", "liquidity", "yes_bid"), "event_id").alias("r")).select("event_ticker", "created_at", "market_title", "r.*")
    return one.withColumn("no_ask", 101 - F.col("yes_ask")).withColumn("no_bid", F.col("no_ask") - 2)


MARKETS_SQL = """
 mk as (select event_ticker, market_title, created_at, event_id, yes_ask, 101 - yes_ask no_ask, 99 - yes_ask no_bid, liquidity, yes_bid from (
  select concat('U', cast(user_id as varchar)) event_ticker, event_type market_title, date_trunc('day', ts) created_at, event_id, cast(1 + event_id % 99 as double) yes_ask, value * 10 liquidity, cast(json_extract(props, '$.k') as double) yes_bid,
   row_number() over (partition by user_id, date_trunc('day', ts), event_type order by event_id) rn from events) where rn = 1),
 vm as (select * from mk where yes_ask > 0 and no_ask > 0 and liquidity >= 100)"""
