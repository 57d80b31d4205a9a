"""Markets' own scores, models asked row by row, pasting, sampler joins, and results that survive a failed run."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from foreglass.functions import text
from foreglass.operators import enrich, ingest, metrics, selection
from foreglass.plans import judge
from foreglass.plans.config import PipelineConfig
from foreglass.plans.prefix import best_of_blocks, exact_quantiles
from foreglass.plans.prompts import PromptTemplate
from foreglass.sources import io


def test_market_brier(spark):
    prices = {"A": {"yes_ask": 60}, "B": {"yes_ask": 50}}
    rows = [(json.dumps(prices), '{"A": 1, "B": 0}'), (json.dumps(prices), '{"A": 1, "C": 0}'), (json.dumps({"A": {}}), '{"A": 1}'), (None, '{"A": 1}'), (json.dumps(prices), None), (json.dumps(prices), "{}"), (str([{"market": "A", "yes_ask": 60, "no_ask": None}]), "{'A': 1}")]
    df = spark.createDataFrame(rows, "m string, o string")
    read = df.select(text.read_prices(F.col("m")).alias("m"), text.read_outcome(F.col("o")).alias("o"))
    got = [r[0] for r in read.select(metrics.market_brier(F.col("m"), F.col("o"))).collect()]
    assert got == pytest.approx([(0.16 + 0.25) / 2, None, None, None, None, None, 0.16])


def test_pasting_by_row_number(spark):
    left = spark.createDataFrame([(0, "e", "s"), (1, "f", "t")], "row_id int, event_ticker string, submission_id string")
    right = spark.createDataFrame([(1, "b"), (0, "a")], "row_id int, content string")
    assert sorted((r.event_ticker, r.content) for r in enrich.paste(left, right, "row_id").collect()) == [("e", "a"), ("f", "b")]
    with pytest.raises(Exception, match="row without partner: 1"):
        enrich.paste(left, right.filter("row_id = 0"), "row_id").collect()
    assert enrich.paste(left.limit(0), right.limit(0), "row_id").count() == 0


def test_two_tables_as_splits(spark, tmp_path):
    a = spark.createDataFrame([(1, "x")], "i int, c string")
    io.write_splits({"sft": a, "raw": a.union(a)}, str(tmp_path / "d"))
    assert {r.split: r["count"] for r in spark.read.parquet(str(tmp_path / "d")).groupBy("split").count().collect()} == {"sft": 1, "raw": 2}


def chats(spark):
    m = lambda *roles: [{"role": r, "content": f"{r} text"} for r in roles]
    rows = [("e1", "s1", "{}", m("system", "user")), ("e2", "s2", "{}", m("system", "user", "assistant")), ("e3", "s3", "{}", m("user")), ("e4", "s4", "{}", None)]
    return spark.createDataFrame(rows, "event_ticker string, submission_id string, market_outcome string, messages array<struct<role: string, content: string>>")


def test_models_are_asked_without_the_expected_answer(spark, tmp_path):
    def client(messages):
        assert [m["role"] for m in messages] == ["system", "user"]
        return {"content": messages[1]["content"].upper(), "reasoning": "r"}

    rows = {r.event_ticker: (r.content, r.reasoning, r.error_type) for r in judge.evaluate(chats(spark), client).collect()}
    assert rows == {"e1": ("USER TEXT", "r", None), "e2": ("USER TEXT", "r", None), "e3": (None, None, None), "e4": (None, None, None)}

    def broken():
        raise RuntimeError("no server")

    started = []

    def plain():
        started.append(1)
        return lambda messages: "plain"

    models = {"org/a:1": plain, "down": broken, "b": lambda: client}
    both, errors = judge.evaluate_models(chats(spark), models, str(tmp_path / "m"))
    assert errors == {"down": "RuntimeError: no server"}
    assert {(r.model, r.content) for r in both.filter("content is not null").collect()} == {("org/a:1", "plain"), ("b", "USER TEXT")}
    judge.evaluate_models(chats(spark), models, str(tmp_path / "m"))
    assert len(started) == 1  # saved answers are not asked for again


def test_a_failed_run_keeps_its_batches(spark, tmp_path):
    df = spark.range(50).select("id", F.floor(F.col("id") / 5).cast("int").alias("batch_id"))
    folder, marks = str(tmp_path / "answers"), tmp_path / "marks"
    marks.mkdir()

    def answer(part, fail_at=None):
        def run(batches):
            for pdf in batches:
                if fail_at is not None and (pdf["batch"] >= fail_at).any():
                    raise ValueError("stop")
                (marks / f"{pdf['id'].min()}-{fail_at}").touch()
                yield pdf

        return part.coalesce(1).mapInPandas(run, part.schema)

    with pytest.raises(Exception, match="stop"):
        judge.in_batches(df, lambda p: answer(p, 6), folder, 2)
    done = len(list(marks.iterdir()))
    got = judge.in_batches(df, answer, folder, 2)
    assert sorted((r.id, r.batch_id) for r in got.collect()) == [(i, i // 5) for i in range(50)]
    assert done == 3 and len(list(marks.iterdir())) == 5
    assert judge.in_batches(df.limit(0), answer, str(tmp_path / "none"), 2).count() == 0


def test_sampler_joins(spark):
    sampled = spark.createDataFrame([("e", "s"), ("f", "t"), (None, None)], "event_ticker string, submission_id string")
    titles = spark.createDataFrame([("e", "clear"), ("e", "clear")], "event_ticker string, augmented_title string")
    events = spark.createDataFrame([("f", "rules")], "event_ticker string, rules string")
    usage = spark.createDataFrame([("s", 1), ("s", 1), ("s", 2)], "submission_id string, source_id long")
    sources = spark.createDataFrame([(1, "u1", "b", "c", "t1", 0.5), (2, "u2", "a", "c", "t2", None)], "source_id long, url string, summary string, contributor string, title string, popularity_score double")
    rows = {r.submission_id: r for r in enrich.sampled_with_details(sampled, titles, events, usage, sources).collect()}
    assert len(rows) == 3 and rows["s"].augmented_title == "clear" and rows["t"].rules == "rules" and rows["t"].sources == rows[None].sources == "[]"
    assert [s["summary"] for s in json.loads(rows["s"].sources)] == ["a", "b"]


def test_settings_of_a_composed_yaml(tmp_path, monkeypatch):
    monkeypatch.setenv("SOME_DB", "jdbc:x")
    values = {
        "defaults": [{"data": "default"}], "hydra": {"run": {"dir": "x"}}, "data": {"db_url": "${oc.env:SOME_DB,null}"},
        "augment": {"event": {"use_openrouter": False}, "reasoning": {"use_openrouter": True, "existing_augmented_reasoning_df": None, "strategy": {"_target_": "some.module.RepetitiveStrategy"}}},
        "output": {"dataset": {"push_to_hub": False, "repo_id": None, "private": True, "n_jobs": 8}},
        "prompts": {"event_augment": {"use_default": False, "custom_path": str(tmp_path / "p.yaml")}},
    }
    io.write_yaml(values, str(tmp_path / "c.yaml"))
    c = PipelineConfig.from_yaml(tmp_path / "c.yaml")
    assert c.data.db_url == "jdbc:x" and c.augment.reasoning.strategy.fraction == 0.6 and c.to_dict()["prompts"]["prediction"] == {"use_default": True, "custom_path": None}
    assert PipelineConfig.from_dict({"data": {"db_url": "${oc.env:NO_SUCH_NAME,null}"}}).data.db_url is None
    io.write_yaml({"name": "event_augment", "version": 2.0, "description": "d", "required_variables": ["raw"], "system_prompt": "s", "user_prompt_template": "T {raw}", "metadata": {}}, str(tmp_path / "p.yaml"))
    t = PromptTemplate.from_yaml(str(tmp_path / "p.yaml"))
    assert t.render(raw="x") == "T x" and t.version == "2.0"


def test_csv_tables_keep_their_types(spark, tmp_path):
    df = spark.createDataFrame([(1, 0.5, ["a", 'q"\n'], {"k": 1}, None)], "i long, d double, a array<string>, m map<string,int>, s string")
    io.write_frame(df, str(tmp_path / "t"), "csv")
    again = io.read_frame(spark, str(tmp_path / "t"))
    assert again.schema.simpleString() == df.schema.simpleString() and again.collect() == df.collect()


def test_forecasts_from_raw_tables(spark):
    prices = (50.0, 48.0, 51.0, 49.0, 200.0)
    markets = spark.createDataFrame([("e", t, d, *prices) for d in ("2025-03-01", "2025-03-02") for t in "AB"], "event_ticker string, market_title string, created_at string, yes_ask double, yes_bid double, no_ask double, no_bid double, liquidity double").withColumn("created_at", F.to_timestamp_ntz("created_at"))
    events = spark.createDataFrame([("e", "T", '{"A": 1, "B": 0}', "c", None)], "event_ticker string, title string, market_outcome string, category string, close_time string")
    submissions = spark.createDataFrame([("s1", "2025-03-01"), ("s2", "2025-03-02"), ("old", "2020-01-01")], "submission_id string, snapshot_time string").withColumn("snapshot_time", F.to_timestamp_ntz("snapshot_time"))
    told = json.dumps({"rationale": "r", "probabilities": {"A": 0.9, "B": 0.2}})
    predictions = spark.createDataFrame([("s1", "e", "agent-f", told, "2025-03-01"), ("s2", "e", "agent-f", told, "2025-03-02"), ("s2", "e", "human", told, "2025-03-02"), ("s2", "e", "agent-x", told, "2025-03-02")], "submission_id string, event_ticker string, forecaster string, prediction string, created_at string").withColumn("created_at", F.to_timestamp_ntz("created_at"))
    rows = ingest.forecasts_from_tables(predictions, submissions, markets, events, after="2025-01-01", before="2026-01-01", agents_only=True, exclude=["agent-x"]).collect()
    assert sorted((r.submission_id, r["round"], r.forecaster, r.time_rank) for r in rows) == [("s1", 0, "agent-f", 1.0), ("s2", 1, "agent-f", 0.0)]
    assert all(r.odds == [0.5, 0.5] and r.market_outcome == [1.0, 0.0] for r in rows)


def test_exact_quantiles_against_numpy(spark):
    rng = np.random.default_rng(1)
    rows = [(f"g{i % 5}", float(v)) for i, v in enumerate(np.round(rng.random(999), 2))] + [("one", 3.0), (None, 1.0), ("g1", None), ("g1", float("nan"))]
    df = spark.createDataFrame(rows, "g string, v double").repartition(7)
    points = [0.0, 0.1, 0.5, 0.93, 1.0]
    got = {r.g: r.quantiles for r in exact_quantiles(df, ["g"], "v", points).collect()}
    assert set(got) == {"g0", "g1", "g2", "g3", "g4", "one"}
    for g, q in got.items():
        assert q == pytest.approx(np.quantile([v for k, v in rows if k == g and v is not None and v == v], points))
    (whole,) = exact_quantiles(df, [], "v", [0.5]).collect()
    assert whole.quantiles == pytest.approx([np.median([v for _, v in rows if v is not None and v == v])])
    assert exact_quantiles(df.limit(0), [], "v", [0.5]).count() == 0


def test_blocks_keep_the_best_rows_with_all_columns(spark):
    df = spark.createDataFrame([("g", i % 7, i, f"x{i}") for i in range(100)] + [("h", 1, 200, None)], "g string, s int, i int, extra string").coalesce(1)
    kept = best_of_blocks(df, "g", ["s", "i"], 3, block_rows=1000).collect()
    assert sorted((r.g, r.i, r.extra) for r in kept) == [("g", 0, "x0"), ("g", 7, "x7"), ("g", 14, "x14"), ("h", 200, None)]
    most = selection.limit_problems(df.withColumn("row_id", F.col("i")), "row_id", 10, shuffle=False)
    assert sorted(r.i for r in most.collect()) == list(range(10)) and selection.head(df, 3).count() == 3


def test_score_files_and_their_summary(spark, tmp_path):
    rows = spark.createDataFrame([("e", "s", 0.5, "x"), ("e", "t", 0.1, "x"), ("f", "u", None, "x")], "event_ticker string, submission_id string, brier_score double, more string")
    for name in ("a", "b"):
        io.write_scores(rows, str(tmp_path), name)
    again = io.read_scores(spark, str(tmp_path))
    assert again.count() == 6 and {r.file.rsplit("/", 1)[-1] for r in again.collect()} == {"a_brier_score.csv", "b_brier_score.csv"}
    io.write_summary(metrics.score_summary(again, ["file"]), str(tmp_path / "summary.json"))
    records = json.loads(io.read_text(spark, str(tmp_path / "summary.json")))
    assert [(r["n"], round(r["mean"], 9), round(r["median"], 9), r["n_events"]) for r in records] == [(2, 0.3, 0.3, 1)] * 2
    with pytest.raises(FileNotFoundError):
        io.read_scores(spark, str(tmp_path), "*none.csv")


def test_a_database_needs_a_table_or_a_query(spark):
    for table, query in ((None, None), ("t", "select 1")):
        with pytest.raises(ValueError, match="either"):
            io.read_jdbc(spark, "jdbc:x", table, query)
    with pytest.raises(ValueError, match="URL"):
        io.read_jdbc(spark, None, "t")
