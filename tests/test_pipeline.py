import json

import pytest
from pyspark.sql import functions as F

from foreglass.operators import enrich, ingest
from foreglass.plans import judge, prompts
from foreglass.plans.config import PipelineConfig
from foreglass.plans.runner import Runner
from foreglass.sources import io, schemas
from foreglass.streaming.scoring import stream_scores


def test_market_rules(spark):
    rows = [("e", "A", 1.0, 50.0, 48.0, 51.0, 49.0, 100.0), ("e", "B", 1.0, 50.0, None, 51.0, 49.0, 99.0), ("e", "C", 1.0, 0.0, 1.0, 51.0, 1.0, 500.0), ("e", "D", 1.0, 5.0, None, 51.0, 1.0, 500.0), ("e", "E", 1.0, 5.0, 1.0, 51.0, 1.0, None)]
    df = spark.createDataFrame(rows, "event_ticker string, market_title string, created_at double, yes_ask double, yes_bid double, no_ask double, no_bid double, liquidity double")
    assert sorted(r.market_title for r in df.filter(ingest.valid_market()).collect()) == ["A", "D"]
    assert [r.market_title for r in df.filter(ingest.valid_market(True)).collect()] == ["A"]


def test_process_builds_rounds_from_complete_snapshots(spark):
    prices = (50.0, 48.0, 51.0, 49.0, 200.0)
    markets = spark.createDataFrame([("e", t, d, *prices) for d, ts in [("2025-01-01", "AB"), ("2025-01-02", "A"), ("2025-01-03", "AB")] for t in ts] + [("unknown", "A", "2025-01-01", *prices)], "event_ticker string, market_title string, created_at string, yes_ask double, yes_bid double, no_ask double, no_bid double, liquidity double").withColumn("created_at", F.to_timestamp_ntz("created_at"))
    events = spark.createDataFrame([("e", "T", '{"A": 1, "B": 0}', "c", None)], "event_ticker string, title string, market_outcome string, category string, close_time string")
    submissions = spark.createDataFrame([("s1", "2025-01-01"), ("s2", "2025-01-03"), ("s3", "2025-01-03")], "submission_id string, snapshot_time string").withColumn("snapshot_time", F.to_timestamp_ntz("snapshot_time"))
    predictions = spark.createDataFrame([("s1", "e", "f"), ("s3", "e", "f")], "submission_id string, event_ticker string, forecaster string")
    made, kept = ingest.process(predictions, submissions, markets, events)
    assert sorted((r.submission_id, r["round"]) for r in made.collect()) == [("s1", 0), ("s3", 1)]
    assert sorted((r.submission_id, r["round"], len(r.market_data)) for r in kept.collect()) == [("s1", 0, 2), ("s3", 1, 2)]


def test_parse_drops_ragged_rows_and_orders_by_market(spark):
    predictions = spark.createDataFrame([("f", "s", "e", 0, json.dumps({"rationale": "r", "probabilities": [{"market": "B", "probability": 0.2}, {"market": "A", "probability": 0.1}, {"market": "B", "probability": 0.9}]})), ("g", "s", "e", 0, json.dumps({"probabilities": [{"market": "A", "probability": 0.2}]})), ("h", "s", "e", 0, "{")], "forecaster string, submission_id string, event_ticker string, round int, prediction string")
    prices = {"B": {"yes_ask": 40, "no_ask": 61}, "A": {"yes_ask": 60, "no_ask": 41}}
    submissions = spark.createDataFrame([("e", 0, "t", "c", json.dumps(prices), json.dumps({"B": 0, "A": 1}))], "event_ticker string, round int, snapshot_time string, close_time string, market_data string, market_outcome string")
    (row,) = ingest.parse_and_merge(predictions, submissions).collect()
    assert (row.forecaster, row.prediction, row.odds, row.market_outcome, row.weight) == ("f", [0.1, 0.9], [0.6, 0.4], [1.0, 0.0], 1.0)


def test_sources(spark):
    usage = spark.createDataFrame([("s", 1), ("s", 1), ("s", 2), ("t", 3)], "submission_id string, source_id long")
    sources = spark.createDataFrame([(1, "b", "x", "c1", "t"), (2, "a", "y", "c2", "t")], "source_id long, url string, summary string, contributor string, title string")
    found = enrich.aggregate_sources(usage, sources)
    (row,) = found.collect()
    assert [s.url for s in row.sources] == ["a", "b"]
    assert enrich.by_contributor(found, ["c1"]).count() == 0  # only the first source decides
    assert enrich.by_contributor(found, ["c2"]).count() == 1


def test_calls_are_retried_by_kind():
    waits, calls = [], []

    def failing(message, times):
        def client(system, user):
            calls.append(1)
            if len(calls) <= times:
                raise RuntimeError(message)
            return "ok"
        return client

    assert judge.call(failing("rate limit reached", 2), "", "", sleep=waits.append)[0] == "ok" and waits == [1.0, 2.0]
    calls.clear()
    assert judge.call(failing("could not parse", 9), "", "", sleep=waits.append)[1] == "parse_error" and len(calls) == 1
    for message, kind in [("Request timed out", "timeout"), ("api down", "api_error"), ("odd", "unknown"), ("validation", "parse_error")]:
        assert judge.classify_error(RuntimeError(message)) == kind


def test_ask_keeps_failed_rows(spark):
    def client(system, user):
        if user == "bad":
            raise ValueError("json")
        return {"echo": user}

    rows = judge.ask(spark.createDataFrame([(1, "good"), (2, "bad"), (3, None)], "i int, prompt string"), client, "s").orderBy("i").collect()
    assert [(r.answer, r.error_type) for r in rows] == [('{"echo": "good"}', None), (None, "parse_error"), (None, None)]


def test_prompt_templates(spark, tmp_path):
    t = prompts.PromptTemplate("n", "s", "Hello {name} {{x}}")
    assert t.render(name="you") == "Hello you {x}" and len(t.hash) == 8
    assert spark.range(1).select(t.column(name=F.lit("you")).alias("x")).collect()[0].x == "Hello you {x}"
    with pytest.raises(KeyError):
        t.render()
    t.to_yaml(str(tmp_path / "p.yaml"))
    registry = prompts.PromptRegistry()
    assert registry.load(str(tmp_path / "p.yaml")).hash == t.hash and registry.names() == ["n"]


def test_files(spark, tmp_path):
    df = spark.createDataFrame([("f", '{"a": "x\ny, \\"q\\""}', 1)], "forecaster string, text string, n int")
    path = io.write_frame(df, str(tmp_path / "a.csv"), "csv")
    assert io.read_frame(spark, path, "forecaster string, text string, n int").collect() == df.collect()
    io.write_frame(df, str(tmp_path / "b"))
    assert io.read_frame(spark, str(tmp_path / "b")).collect() == df.collect()
    with pytest.raises(FileNotFoundError):
        io.read_frame(spark, str(tmp_path / "none.csv"))
    assert io.read_many(spark, [path, str(tmp_path / "none.csv")], "forecaster string, text string, n int", strict=False).count() == 1
    with pytest.raises(FileNotFoundError):
        io.read_many(spark, [path, str(tmp_path / "none.csv")])
    scores = spark.createDataFrame([("e", "s", 0.5)], schemas.SCORED_OUTPUTS)
    io.write_frame(scores.coalesce(1), str(tmp_path / "scores/deep/m"), "csv")
    (part,) = (tmp_path / "scores/deep/m").glob("*.csv")
    part.rename(tmp_path / "scores/deep/x_brier_score.csv")
    assert [r.brier_score for r in io.read_scores(spark, str(tmp_path / "scores")).collect()] == [0.5]


def test_config(tmp_path):
    io.write_yaml({"run": {"name": "r"}, "filter": {"z_score": {"min_z": 2}}}, str(tmp_path / "c.yaml"))
    c = PipelineConfig.from_yaml(tmp_path / "c.yaml")
    assert c.run.name == "r" and c.filter.z_score.min_z == 2 and c.filter.ambiguous.top_k == 3
    with pytest.raises(ValueError):
        PipelineConfig.from_dict({"run": {"nmae": "r"}})


def fixture_files(spark, folder):
    outcome = {"A": 1, "B": 0}
    predictions, submissions, events, usage = [], [], [], []
    for e in range(6):
        events.append((f"e{e}", f"title {e}", '["A", "B"]', json.dumps(outcome), "Sports", None, "rules"))
        submissions.append((f"s{e}", f"e{e}", f"title {e}", 0, "2025-02-01 00:00:00", None, json.dumps({"A": {"yes_ask": 60, "no_ask": 41}, "B": {"yes_ask": 40, "no_ask": 61}}), json.dumps(outcome), "Sports"))
        usage.append((f"s{e}", 1))
        for f in range(12):
            p = 0.9 if f == 0 else 0.3 + 0.01 * f
            predictions.append((e * 100 + f, f"s{e}", f"agent-{f}", f"e{e}", f"title {e}", 0, json.dumps({"rationale": f"because {f}", "probabilities": [{"market": "A", "probability": p}, {"market": "B", "probability": 1 - p}]})))
    tables = {"predictions": predictions, "submissions": submissions, "events": events, "sources": [(1, "u", "summary", "c", "t", 1.0)], "source_usage": usage}
    paths = {}
    for name, rows in tables.items():
        cast = schemas.BY_NAME[name].replace("timestamp_ntz", "string")
        paths[name] = io.write_frame(spark.createDataFrame(rows, cast), f"{folder}/{name}.csv", "csv")
    return {"predictions_path": paths["predictions"], "submissions_path": paths["submissions"], "events_path": paths["events"], "sources_path": paths["sources"], "source_usage_path": paths["source_usage"]}


def fake(system, user):
    if system == prompts.TITLE.system:
        return '"Clear title"'
    return {"source_analysis": "by sources", "market_analysis": "by market", "rationale": "better than the original rationale"}


def test_both_pipelines_and_resuming(spark, tmp_path):
    data = fixture_files(spark, tmp_path / "in")
    settings = {"run": {"name": "one"}, "data": data, "output": {"base_dir": str(tmp_path / "runs"), "dataset": {"test_size": 0.3}}, "augment": {"reasoning": {"strategy": {"fraction": 1.0}}}}
    state = Runner(spark, PipelineConfig.from_dict(settings), fake).run()
    rows = state.tables["dataset"].collect()
    assert rows and all([m.role for m in r.messages] == ["system", "user", "assistant"] for r in rows)
    assert all("given context" in r.messages[2].content for r in rows)
    events = {}
    for r in rows:
        events.setdefault(r.event_ticker, set()).add(r.split)
    assert all(len(s) == 1 for s in events.values()) and {s for x in events.values() for s in x} == {"train", "test"}
    meta = json.loads((tmp_path / "runs/one/metadata.json").read_text())
    assert [s["name"] for s in meta["stages"]] == ["data_loading", "evaluation", "filtering", "event_augment", "reason_augment", "dataset_creation"]

    settings["run"] = {"name": "one", "resume_from": "dataset_creation", "new_run_name": "two"}
    again = Runner(spark, PipelineConfig.from_dict(settings), fake)
    assert again.run().tables["dataset"].count() == len(rows) and again.name == "two"

    settings["run"] = {"name": "rl", "pipeline_type": "rl"}
    settings["rl_selection"] = {"max_problems": 4}
    rl = Runner(spark, PipelineConfig.from_dict(settings), fake).run().tables["dataset"].collect()
    assert len(rl) == 4 and all([m.role for m in r.messages] == ["system", "user"] and "Clear title" in r.messages[1].content for r in rl)


def test_runner_says_what_is_wrong(spark, tmp_path):
    out = {"output": {"base_dir": str(tmp_path)}}
    with pytest.raises(ValueError, match="URL"):
        Runner(spark, PipelineConfig.from_dict({"run": {"name": "x"}, **out})).run()
    assert "URL" in json.loads((tmp_path / "x/metadata.json").read_text())["stages"][0]["error"]
    with pytest.raises(FileNotFoundError):
        Runner(spark, PipelineConfig.from_dict({"run": {"name": "gone", "resume_from": "filtering"}, **out})).run()
    with pytest.raises(ValueError, match="no stage"):
        Runner(spark, PipelineConfig.from_dict({"run": {"end_at": "nowhere"}, **out})).run()


def test_scores_of_a_stream(spark, tmp_path):
    schema = "event_ticker string, content string, market_outcome string"
    df = spark.createDataFrame([("e", '<think>x</think><probabilities>{"A": 0.5}</probabilities>', '{"A": 1}'), ("e", "none", '{"A": 1}')], schema)
    df.write.parquet(str(tmp_path / "in"))
    q = stream_scores(spark, str(tmp_path / "in"), df.schema, str(tmp_path / "out"), str(tmp_path / "state"))
    q.awaitTermination(60)
    assert sorted((r.brier_score is None, r.brier_score) for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [(False, 0.25), (True, None)]
