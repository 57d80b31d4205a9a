import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from foreglass.operators import metrics, ranking, weights


def values(df, column):
    return [r[column] for r in df.collect()]


def test_brier_of_ragged_and_null_vectors(spark):
    df = spark.createDataFrame([(1, [0.5, 0.5], [1.0, 0.0]), (2, [0.5], [1.0, 0.0]), (3, None, [1.0]), (4, [], [])], "i int, prediction array<double>, market_outcome array<double>")
    assert values(metrics.with_brier(df).orderBy("i"), "brier_score") == [0.25, None, None, None]


def test_brier_of_maps(spark):
    df = spark.createDataFrame([(1, {"A": 0.6}, {"A": 1.0, "B": 0.0}), (2, {"A": 1.6}, {"A": 1.0}), (3, {"A": 0.5}, {"A": 0.5}), (4, None, {"A": 1.0})], "i int, p map<string,double>, o map<string,double>")
    zero = values(df.orderBy("i").select(metrics.brier_of_maps(F.col("p"), F.col("o")).alias("b")), "b")
    assert zero[0] == pytest.approx(0.08) and zero[1:3] == [None, None]
    strict = values(df.orderBy("i").select(metrics.brier_of_maps(F.col("p"), F.col("o"), None).alias("b")), "b")
    assert strict[0] is None and strict[3] is None


def test_return_takes_the_first_largest_edge_and_survives_price_zero(spark):
    df = spark.createDataFrame([
        (1, [0.5, 0.5], [1.0, 0.0], [0.25, 0.25], [0.8, 0.8]),
        (2, [0.2, 0.8], [0.0, 1.0], [0.5, 0.5], [0.5, 0.5]),
        (3, [0.5], [1.0], [0.0], [1.0]),
    ], "i int, p array<double>, o array<double>, q array<double>, n array<double>")
    r = values(df.orderBy("i").select(metrics.average_return(F.col("p"), F.col("o"), F.col("q"), F.col("n")).alias("r")), "r")
    assert r[0] == 4.0  # tie of edges: the first market
    assert r[1] == 2.0  # the no side of the first market has the same edge and comes first
    assert r[2] is None


def test_bin_edges_are_the_floats_of_linspace():
    assert metrics.bin_edges(10) == list(np.linspace(0, 1, 11)[1:-1])


def test_calibration_error_against_numpy(spark):
    rng = np.random.default_rng(0)
    rows = [(f"f{i % 3}", "e", [float(p) for p in np.round(rng.random(2), 1)], [float(y) for y in rng.integers(0, 2, 2)], 1.0) for i in range(300)]
    df = spark.createDataFrame(rows, "forecaster string, event_ticker string, prediction array<double>, market_outcome array<double>, weight double")
    found = {r.forecaster: r.ece_score for r in metrics.calibration_error(df).collect()}
    for name in ("f0", "f1", "f2"):
        p = np.array([x for r in rows if r[0] == name for x in r[2]])
        y = np.array([x for r in rows if r[0] == name for x in r[3]])
        bins = np.digitize(p, np.linspace(0, 1, 11)[1:-1])
        expected = sum(abs(p[bins == k].mean() - y[bins == k].mean()) * (bins == k).sum() / len(p) for k in range(10) if (bins == k).any())
        assert found[name] == pytest.approx(expected)


def test_calibration_without_weight_and_unknown_strategy(spark):
    df = spark.createDataFrame([("f", "e", [0.5], [1.0], 0.0)], "forecaster string, event_ticker string, prediction array<double>, market_outcome array<double>, weight double")
    assert metrics.calibration_error(df).count() == 0
    with pytest.raises(ValueError):
        metrics.calibration_bins(df, strategy="other")


def test_sharpe_without_deviation(spark):
    df = spark.createDataFrame([("one", "e", 1.0, 2.0), ("same", "e", 1.0, 1.0), ("same", "e", 1.0, 1.0), ("gone", "e", 1.0, None)], "forecaster string, event_ticker string, weight double, r double")
    found = {r.forecaster: r.sharpe_ratio for r in metrics.sharpe(df, "r", 1.0).collect()}
    assert found == {"one": math.inf, "same": 0.0}


def test_rank_shares_the_smallest_and_zero_weights_come_last(spark):
    df = spark.createDataFrame([("a", "e", 1.0, 0.2), ("b", "e", 1.0, 0.2), ("c", "e", 1.0, 0.5), ("d", "e", 0.0, 0.1), ("x", "e", 1.0, None)], "forecaster string, event_ticker string, weight double, brier_score double")
    rows = {r.forecaster: (r["rank"], r.score) for r in ranking.rank_forecasters(df).collect()}
    assert rows == {"a": (1, 0.2), "b": (1, 0.2), "c": (3, 0.5), "d": (4, None)}
    with pytest.raises(ValueError):
        ranking.rank_forecasters(df.withColumnRenamed("brier_score", "ece_score"), interval={})


def test_bootstrap_is_seeded_and_near_the_analytic_error(spark):
    rng = np.random.default_rng(1)
    df = spark.createDataFrame([("f", "e", 1.0, float(x)) for x in rng.random(2000)], "forecaster string, event_ticker string, weight double, brier_score double")
    first, again = (ranking.bootstrap(df, "brier_score", n=400).collect()[0] for _ in range(2))
    assert first == again
    assert first.standard_error == pytest.approx(0.2887 / math.sqrt(2000), rel=0.2)
    assert first.margin == pytest.approx(1.645 * first.standard_error, rel=0.2)


def test_market_baseline_takes_first_values_that_are_not_null(spark):
    rows = [(1, "s", "e", "f", None, [0.4], [0.7], [0.1]), (2, "s", "e", "g", 1.0, [0.5], [0.6], [0.2])]
    df = spark.createDataFrame(rows, "row_id int, submission_id string, event_ticker string, forecaster string, weight double, odds array<double>, no_odds array<double>, prediction array<double>")
    (base,) = ranking.with_market_baseline(df, both_sides=True).filter("forecaster = 'market-baseline'").collect()
    assert base.weight == 1.0 and base.prediction == [pytest.approx(0.35)]


def test_time_rank_and_weights(spark):
    df = spark.createDataFrame([(1, "f", "e", 0), (2, "f", "e", 1), (3, "f", "e", 1), (4, "f", "e", 2)], "row_id int, forecaster string, event_ticker string, round int")
    ranked = weights.with_time_rank(df)
    assert {r.row_id: r.time_rank for r in ranked.collect()} == {1: 3.0, 2: 1.5, 3: 1.5, 4: 0.0}
    assert {r.row_id: r.weight for r in weights.last_n(2, ["row_id"])(df).collect()} == {1: 0.0, 2: 1.0, 3: 0.0, 4: 1.0}
    assert {r.row_id: r.weight for r in weights.first_n(1, ["row_id"])(df).collect()} == {1: 1.0, 2: 0.0, 3: 0.0, 4: 0.0}
    assert all(r.weight == 1.0 for r in weights.uniform(df).collect())
