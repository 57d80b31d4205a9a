"""Predictions and market data count in whatever notation they are written."""

import json

import pytest
from pyspark.sql import functions as F

from foreglass.functions import text
from foreglass.operators import enrich
from foreglass.queries.core import QUERIES

NOTATIONS = {
    "plain": json.dumps,
    "indented": lambda v: "\n " + json.dumps(v, indent=1, ensure_ascii=False),
    "mark": lambda v: "﻿" + json.dumps(v),
    "fenced": lambda v: f"```json\n{json.dumps(v)}\n```",
    "string": lambda v: json.dumps(json.dumps(v)),
    "comma": lambda v: json.dumps(v)[:-1] + ",}" if isinstance(v, dict) else json.dumps(v)[:-1] + ",]",
    "python": repr,
}
NAMES = ["Ann's Cup", "Élan", "Bob (draw)"]
WHY = 'It\'s "even", says \\ Ann\nand {others}'


def forecast(kind, values):
    listed = [{"market": m, "probability": p, "evidence": [{"source_id": 1, "weight": 0.5}]} for m, p in zip(NAMES, values)]
    parts = {"array": listed, "twice": [{"market": NAMES[0], "probability": 0.99}, *listed], "words": [{"market": m, "probability": str(p)} for m, p in zip(NAMES, values)], "object": dict(zip(NAMES, values)), "inner": {m: {"probability": p} for m, p in zip(NAMES, values)}}[kind]
    return {"rationale": WHY, "probabilities": parts}


def prices(as_list, asks):
    fields = {m: {"yes_ask": a, "yes_bid": None, "no_ask": 101 - a, "no_bid": 1, "levels": [{"price": a, "size": 3}]} for m, a in zip(NAMES, asks)}
    return [{"market": m, **f} for m, f in fields.items()] if as_list else fields


SUBMISSION = "submission_id string, event_ticker string, round int, snapshot_time string, close_time string, market_data string, market_outcome string"
PREDICTION = "prediction_id long, submission_id string, forecaster string, event_ticker string, round int, prediction string"
DAMAGED = [None, "", "nothing", "[]", '"{}"', '{"rationale": "r", "probabilities": [{"market": "A", "proba', json.dumps(forecast("array", [0.1, 0.2, 0.3])) + " {}", '{"rationale": "r", "probabilities": [{"probability": 0.5}, {"probability": 0.2}, {"probability": 0.2}]}']


def test_forecasts_against_brute_force_in_every_notation(spark, tmp_path):
    submissions, predictions, expected = [], [], {}
    for e, (form, write) in enumerate((as_list, w) for as_list in (False, True) for w in NOTATIONS.values()):
        outcome = {m: int(i == e % 3) for i, m in enumerate(NAMES)}
        submissions.append((f"s{e}", f"e{e}", 0, "t", "c", write(prices(form, [40 + e, 20, 50])), write(outcome)))
        kinds = [(kind, outer, w) for kind in ("array", "twice", "words", "object", "inner") for outer in (False, True) for w in NOTATIONS.values()]
        for n, (kind, outer, told) in enumerate(kinds):
            values = [(n + e) % 90 / 100, 0.25, 0.4]
            value = forecast(kind, values)
            predictions.append((1000 * e + n, f"s{e}", f"f{n}", f"e{e}", 0, told({"prediction": value, "meta": {"attempt": 2}} if outer else value)))
            expected[f"f{n}", f"e{e}"] = round(sum((p - outcome[m]) ** 2 for m, p in zip(NAMES, values)) / 3, 6)
        predictions += [(1000 * e + 900 + i, f"s{e}", f"bad{i}", f"e{e}", 0, t) for i, t in enumerate(DAMAGED)]
    spark.createDataFrame(submissions, SUBMISSION).write.parquet(f"{tmp_path}/submissions.parquet")
    spark.createDataFrame(predictions, PREDICTION).write.parquet(f"{tmp_path}/predictions.parquet")
    rows = QUERIES["forecasts_from_json"](spark, str(tmp_path)).collect()
    found = {(r.forecaster, r.event_ticker): r.brier_score for r in rows}
    assert len(rows) == len(found) and found.keys() == expected.keys()
    assert {k for k in found if found[k] != pytest.approx(expected[k], abs=1e-6)} == set()


@pytest.mark.parametrize("name", NOTATIONS)
def test_rationales_and_market_data_in_every_notation(spark, name):
    write = NOTATIONS[name]
    rows = [("s", write({"prediction": forecast("array", [0.1, 0.2, 0.3])}), write(prices(True, [40, 20, 50])), write({NAMES[0]: 1, NAMES[1]: 0}))]
    df = spark.createDataFrame(rows, "submission_id string, prediction string, market_data string, market_outcome string")
    rationale, probabilities = text.told(F.col("prediction"))
    told = df.select(rationale.alias("r"), probabilities.alias("p")).collect()[0]
    assert told.r == WHY and json.loads(told.p) == forecast("array", [0.1, 0.2, 0.3])["probabilities"]
    (row,) = enrich.with_market_data(df.select("submission_id"), df).collect()
    assert row.market_outcome == {NAMES[0]: 1.0, NAMES[1]: 0.0}
    assert {m: (p.yes_ask, p.yes_bid, p.no_ask, p.no_bid, p.liquidity) for m, p in row.market_data.items()} == {m: (a, None, 101 - a, 1, None) for m, a in zip(NAMES, [40, 20, 50])}


def test_tolerant_json_leaves_no_half_read_values(spark):
    texts = ['{"a": 1, "b": [1, 2', "{'a': 1, 'b': [None, 2]}", '{"a": 1} {"a": 2}', "{'a': {1, 2}}", '"\\ud800"', '{"a": 5, "a": 6}']
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = {r.i: r.v and (r.v.a, r.v.b) for r in text.tolerant_json(df, "t", "struct<a: int, b: array<int>>", "v").collect()}
    assert [got[i] for i in (1, 5)] == [(1, [None, 2]), (6, None)] and not any(got[i] for i in (0, 2, 3))
