"""The stages of the two pipelines: functions from state to tables."""

from __future__ import annotations

from abc import ABC, abstractmethod
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

from foreglass.functions import text
from foreglass.operators import enrich, ingest, metrics, sampling, selection
from foreglass.plans.config import PipelineConfig, declare
from foreglass.plans.judge import Client, ask, batched, in_batches
from foreglass.plans.prompts import PREDICTION, REASONING, TITLE, PromptTemplate
from foreglass.session import written
from foreglass.sources import io, schemas

# The names of all settings in this module, and their defaults, are those that a run's YAML carries.
declare("run", seed=42)
declare("output", base_dir="data/runs")
for _name in ("reasoning_augment", "event_augment", "prediction"):
    declare(f"prompts.{_name}", use_default=True, custom_path=None)


@dataclass
class State:
    """Named tables, in the order in which they came about."""

    tables: dict[str, DataFrame] = field(default_factory=dict)

    def need(self, *names: str) -> list[DataFrame]:
        if missing := [n for n in names if n not in self.tables]:
            raise ValueError(f"tables missing: {missing}")
        return [self.tables[n] for n in names]


class Stage(ABC):
    """A step: what it needs, and the tables it adds."""

    name: str
    needs: tuple[str, ...] = ()
    gives: tuple[str, ...] = ()
    raw = False

    def __init__(self, spark: SparkSession, config: PipelineConfig, client: Client | None = None, folder: str | None = None):
        self.spark, self.config, self.client, self.folder = spark, config, client, folder

    def prompt(self, template: PromptTemplate) -> PromptTemplate:
        """The template, or the run's own one in its place."""
        own = getattr(self.config.prompts, template.name)
        return template if own.use_default or not own.custom_path else PromptTemplate.from_yaml(own.custom_path)

    def validate(self, state: State) -> None:
        state.need(*self.needs)

    @abstractmethod
    def run(self, state: State) -> dict[str, DataFrame]:
        """The new tables, lazy."""


declare("data", db_url=None, filter_time_before="2025-12-15 00:00:00", filter_time_after="2025-01-01 00:00:00", filter_agent_only=False, predictions_path=None, submissions_path=None)
declare("data", exclude_forecasters=[], events_path=None, markets_path=None, sources_path=None, source_usage_path=None, use_bid=False)


class Load(Stage):
    """Files if both paths are set, else the database, whose market rows become rounds and snapshots."""

    name, gives, raw = "data_loading", ("predictions", "submissions", "events", "sources", "source_usage"), True

    def run(self, state):
        c = self.config.data
        if bool(c.predictions_path) != bool(c.submissions_path):
            raise ValueError("predictions_path and submissions_path belong together")
        read = lambda table, path=None: io.read_frame(self.spark, path, schemas.BY_NAME[table]) if path else io.read_jdbc(self.spark, c.db_url, table)
        out = {"predictions": read("predictions", c.predictions_path), "submissions": read("submissions", c.submissions_path), "events": read("events", c.events_path), "sources": read("sources", c.sources_path), "source_usage": read("source_usage", c.source_usage_path)}
        markets = read("markets", c.markets_path) if c.markets_path or not c.predictions_path else None
        return out | ingest.load(out["predictions"], out["submissions"], markets, out["events"], c.filter_time_after, c.filter_time_before, c.filter_agent_only, c.exclude_forecasters, c.use_bid)


class Score(Stage):
    """Brier scores with uniform weights; rows delivered more than once count once."""

    name, needs, gives = "evaluation", ("predictions", "submissions"), ("scores",)

    def run(self, state):
        predictions, submissions = state.need(*self.needs)
        predictions = predictions.select("forecaster", "submission_id", "event_ticker", "round", "prediction").distinct()
        submissions = submissions.select("submission_id", "event_ticker", "round", "snapshot_time", "close_time", "market_data", "market_outcome").distinct()
        rows = metrics.with_brier(ingest.parse_and_merge(predictions, submissions))
        key = F.md5(F.to_json(F.struct("forecaster", "event_ticker", "submission_id", "round", "prediction")))
        return {"scores": rows.select("forecaster", "event_ticker", "submission_id", "weight", "round", "brier_score", key.alias("row_id"))}


declare("filter", metric_col="brier_score")
declare("filter.z_score", enabled=True, min_z=1.5, max_mean=-1, min_val=0.15)
declare("filter.ambiguous", enabled=True, min_val=0.25, max_val=0.15, top_k=3)
declare("filter.absolute", enabled=False, top_k=-1, top_p=0.1, min_val=-1)
declare("data", filter_contributor_only=None, filter_category=None)


class Filter(Stage):
    """The per-group filters, combined, then enriched."""

    name, needs, gives = "filtering", ("scores", "predictions", "submissions", "events", "sources", "source_usage"), ("filtered", "augmented_filtered")

    def run(self, state):
        scores, predictions, submissions, events, sources, usage = state.need(*self.needs)
        if not scores.filter(F.col("forecaster").startswith("market-baseline")).isEmpty():
            raise ValueError("market baselines are no forecasts to learn from")
        f, m = self.config.filter, self.config.filter.metric_col
        parts = []
        if f.z_score.enabled:
            parts.append(selection.top_z_score(scores, m, "row_id", f.z_score.min_z, f.z_score.max_mean, f.z_score.min_val))
        if f.ambiguous.enabled:
            parts.append(selection.ambiguous(scores, m, "row_id", f.ambiguous.min_val, f.ambiguous.max_val, f.ambiguous.top_k))
        if f.absolute.enabled:
            parts.append(selection.top_absolute(scores, m, "row_id", f.absolute.top_k, f.absolute.top_p, f.absolute.min_val))
        filtered = selection.combine(parts, "row_id", scores)
        return {"filtered": filtered, "augmented_filtered": _enriched(self.config, filtered, predictions, submissions, events, sources, usage)}


def _enriched(config: PipelineConfig, rows, predictions, submissions, events, sources, usage) -> DataFrame:
    aggregated = enrich.by_contributor(enrich.aggregate_sources(usage, sources), config.data.filter_contributor_only or [])
    return enrich.enrich(rows, aggregated, predictions, events, submissions, config.data.filter_category)


declare("rl_selection", test_set_path=None, dedup_strategy="first", max_problems=-1, shuffle=True)


class SelectProblems(Stage):
    """Problems for reinforcement learning: not in the test set, one row each, at most so many."""

    name, needs, gives = "rl_selection", Filter.needs, ("rl_augmented",)

    def run(self, state):
        scores, predictions, submissions, events, sources, usage = state.need(*self.needs)
        c, seed = self.config.rl_selection, self.config.run.seed
        if c.test_set_path and io.exists(self.spark, c.test_set_path):
            scores = selection.exclude_pairs(scores, io.read_frame(self.spark, c.test_set_path))
        rows = selection.deduplicate_problems(scores, "row_id", c.dedup_strategy, seed)
        rows = selection.limit_problems(rows, "row_id", c.max_problems if c.max_problems > 0 else None, c.shuffle, seed)
        return {"rl_augmented": _enriched(self.config, rows, predictions, submissions, events, sources, usage)}


declare("augment.event", unused=["use_openrouter"], enabled=True, model="default", batch_size=100, timeout=180)


class AugmentTitles(Stage):
    """A clearer title for each event; failed calls leave null, so the old title stays."""

    name, needs, gives = "event_augment", ("events",), ("augmented_events",)

    def run(self, state):
        rows = state.tables.get("augmented_filtered", state.tables.get("rl_augmented"))
        if rows is None:
            raise ValueError("tables missing: augmented_filtered or rl_augmented")
        titles = rows.select("event_ticker", "title").distinct()
        if not self.config.augment.event.enabled:
            return {"augmented_events": titles.withColumn("augmented_title", F.col("title"))}
        (events,) = state.need("events")
        prompt = self.prompt(TITLE)
        asked = titles.join(events.select("event_ticker", "markets", "rules").distinct(), "event_ticker", "left")
        asked = asked.withColumn("prompt", prompt.column(raw=F.coalesce("title", F.lit("")), rules=F.coalesce("rules", F.lit("")), outcome=text.market_list_text(F.coalesce("markets", F.lit("")))))
        answered = written(ask(asked, self.client, prompt.system, timeout=self.config.augment.event.timeout))  # no answer is paid for twice
        return {"augmented_events": answered.select("event_ticker", "title", text.clean_title(F.col("answer")).alias("augmented_title"))}


# The strategy names of a run's YAML, given as the last part of ``_target_``.
STRATEGIES = {
    "UniformRandomStrategy": lambda df, models, c: sampling.assign_random(df, models, c.fraction, "row_id", c.overlap, c.seed),
    "RepetitiveStrategy": lambda df, models, c: sampling.assign_repetitive(df, models),
}
declare("augment.reasoning", unused=["use_openrouter"], enabled=True, models=["model-a", "model-b"], batch_size=100, start_from_batch=0, timeout=200, existing_augmented_reasoning_df=None, batches_per_save=100)
declare("augment.reasoning.strategy", _target_="UniformRandomStrategy", overlap=True, fraction=0.6, seed=2025)


class AugmentReasoning(Stage):
    """Better rationales by one or more models; results already there are kept."""

    name, needs, gives = "reason_augment", ("augmented_filtered", "augmented_events"), ("augmented_reasoning", "reasoning_errors")

    def run(self, state):
        rows, titles = state.need(*self.needs)
        c = self.config.augment.reasoning
        rows = enrich.with_augmented_titles(rows, titles)
        existing = None
        if (path := c.existing_augmented_reasoning_df) and io.exists(self.spark, path):
            existing = io.read_frame(self.spark, path, schemas.AUGMENTED_REASONING)
            rows, existing = selection.remaining_work(rows, existing)
        rationale, probabilities = text.told(F.col("prediction"))
        rows = rows.withColumns({"original_rationale": rationale, "probabilities": probabilities})
        rows = rows.filter("title != '' and size(sources) > 0 and original_rationale != '' and probabilities != ''")
        strategy = c.strategy.to_dict()["_target_"].rsplit(".", 1)[-1]
        if strategy not in STRATEGIES:
            raise ValueError(f"no strategy {strategy} among {sorted(STRATEGIES)}")
        assigned = STRATEGIES[strategy](rows, c.models, c.strategy)
        event = F.concat(F.lit("Event: "), F.col("title"), F.lit("\nOutcomes: "), F.array_join(F.map_keys("market_outcome"), ", "))
        template = self.prompt(REASONING)
        prompt = template.column(event_info=event, sources=text.sources_text(F.col("sources")), market_data=F.coalesce(F.to_json("market_data"), F.lit("{}")), vanilla_rationale=F.col("original_rationale"), llm_prediction=F.col("probabilities"))
        asked = batched(assigned.withColumn("prompt", prompt), ["row_id", "augmenter"], c.batch_size, c.start_from_batch)
        picked = written(asked.select("event_ticker", "submission_id", "title", "forecaster", "augmenter", "original_rationale", "prompt", "batch_id"))
        answer = lambda df: ask(df, self.client, template.system, timeout=c.timeout)
        answered = in_batches(picked, answer, f"{self.folder}/answers", c.batches_per_save) if self.folder else written(answer(picked))
        parsed = answered.withColumn("augmented_rationale", F.from_json("answer", "struct<source_analysis: string, market_analysis: string, rationale: string>"))
        done = parsed.select("event_ticker", "submission_id", "title", "forecaster", "augmenter", "original_rationale", "augmented_rationale")
        if existing is not None:
            done = done.unionByName(existing.select(done.columns), allowMissingColumns=True)
        return {"augmented_reasoning": done, "reasoning_errors": answered.select("event_ticker", "submission_id", "forecaster", "augmenter", "error_type", "error").filter("error_type is not null")}


for _name in ("dataset", "rl_dataset"):
    declare(f"output.{_name}", unused=["push_to_hub", "repo_id", "private", "n_jobs"], test_size=0.1, conversational=True)


class CreateDataset(Stage):
    """Chat rows with the improved reasoning as the answer, split by event."""

    name, needs, gives = "dataset_creation", ("augmented_reasoning", "augmented_filtered"), ("dataset",)

    def run(self, state):
        reasoning, rows = state.need(*self.needs)
        cleaned = text.clean_rationales(reasoning)
        if cleaned.isEmpty():
            raise ValueError("no usable rationale")
        keys = ["event_ticker", "submission_id", "forecaster"]
        details = selection.first_of(rows.withColumn("__row", F.col("row_id")), keys, ["__row"]).select(*keys, "sources", "market_data", "market_outcome", "prediction")
        joined = cleaned.join(details, keys, "left")
        _, probabilities = text.told(F.col("prediction"))
        chats = joined.select(*keys, "augmenter", F.to_json("market_outcome").alias("market_outcome"), _messages(self.prompt(PREDICTION), text.assistant_text(F.col("augmented_rationale"), probabilities)).alias("messages"))
        rows = sampling.split_by_event(chats.filter("messages is not null"), self.config.output.dataset.test_size, self.config.run.seed)
        return {"dataset": _shaped(rows, self.config.output.dataset.conversational)}


class CreateRLDataset(Stage):
    """Chat rows without an answer."""

    name, needs, gives = "rl_dataset_creation", ("rl_augmented", "augmented_events"), ("dataset",)

    def run(self, state):
        rows, titles = state.need(*self.needs)
        rows = enrich.with_augmented_titles(rows, titles)
        chats = rows.select("event_ticker", "submission_id", F.to_json("market_outcome").alias("market_outcome"), _messages(self.prompt(PREDICTION), None).alias("messages"))
        split = sampling.split_by_event(chats, self.config.output.rl_dataset.test_size, self.config.run.seed)
        return {"dataset": _shaped(split, self.config.output.rl_dataset.conversational)}


def _messages(template: PromptTemplate, answer):
    outcomes = F.array_join(F.map_keys("market_outcome"), ", ")
    prompt = text.user_prompt(F.col("title"), F.coalesce(outcomes, F.lit("")), text.sources_text(F.col("sources")), F.to_json("market_data"))
    system, user = F.lit(template.system), template.column(prompt=prompt)
    return text.chat(system, user) if answer is None else F.when(answer.isNotNull(), text.chat(system, user, answer))


def _shaped(df: DataFrame, conversational: bool) -> DataFrame:
    if conversational:
        return df
    prompt = F.filter("messages", lambda m: m["role"] != "assistant")
    completion = F.filter("messages", lambda m: m["role"] == "assistant")
    return df.withColumns({"prompt": prompt, "completion": completion}).drop("messages")


SFT = [Load, Score, Filter, AugmentTitles, AugmentReasoning, CreateDataset]
RL = [Load, Score, SelectProblems, AugmentTitles, CreateRLDataset]
BY_NAME = {s.name: s for s in [*SFT, *RL]}
