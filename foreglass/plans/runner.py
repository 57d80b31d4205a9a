"""Runs a pipeline stage by stage, with checkpoints, resuming and metadata."""

from __future__ import annotations

import json
import time
from dataclasses import asdict, dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from foreglass.plans import stages
from foreglass.plans.config import PipelineConfig, declare
from foreglass.plans.judge import Client
from foreglass.plans.prompts import REGISTRY
from foreglass.session import scratch
from foreglass.sources import io

# Names and defaults that a run's YAML carries.
declare("run", name=None, resume_from=None, new_run_name=None, end_at=None, skip_stages=[], pipeline_type="sft")
declare("output.checkpoints", enabled=True, format="parquet", skip_raw_data=False)


@dataclass
class StageRecord:
    """What a stage did; rows are counted while they are written, never by a job of their own."""

    name: str
    started: str
    seconds: float = 0.0
    inputs: dict[str, int] = field(default_factory=dict)
    rows: dict[str, int] = field(default_factory=dict)
    error: str | None = None


class Runner:
    """A run in ``<base_dir>/<name>/<stage>/<table>``. The name is fixed once, when the runner is made."""

    def __init__(self, spark: SparkSession, config: PipelineConfig, client: Client | None = None):
        self.spark, self.config, self.client = spark, config, client
        self.name = config.run.name or datetime.now(timezone.utc).strftime("run-%Y%m%d-%H%M%S")
        self.order = stages.RL if config.is_rl else stages.SFT
        self.records: list[StageRecord] = []
        self.state = stages.State()

    @property
    def directory(self) -> str:
        return f"{self.config.output.base_dir}/{self.name}"

    def plan(self) -> list[type[stages.Stage]]:
        """The stages to run: from ``resume_from`` to ``end_at`` without the skipped ones."""
        run, names = self.config.run, [s.name for s in self.order]
        for name in [run.resume_from, run.end_at, *run.skip_stages]:
            if name is not None and name not in names:
                raise ValueError(f"no stage {name} among {names}")
        first = names.index(run.resume_from) if run.resume_from else 0
        last = names.index(run.end_at) + 1 if run.end_at else len(names)
        return [s for s in self.order[first:last] if s.name not in run.skip_stages]

    def restore(self) -> None:
        """The checkpoints of the stages before ``resume_from``; a new run name leaves the old run as it is."""
        before = [s.name for s in self.order].index(self.config.run.resume_from)
        if not io.exists(self.spark, self.directory):
            raise FileNotFoundError(self.directory)
        for stage in self.order[:before]:
            for table in stage.gives:
                path = f"{self.directory}/{stage.name}/{table}"
                if io.exists(self.spark, path):
                    self.state.tables[table] = io.read_frame(self.spark, path)
        if new := self.config.run.new_run_name:
            if io.exists(self.spark, f"{self.config.output.base_dir}/{new}"):
                raise FileExistsError(new)
            self.name = new

    def run(self) -> stages.State:
        """Runs the planned stages. Intermediate tables go when a stage's tables are written; without checkpoints they stay."""
        if self.config.run.resume_from:
            self.restore()
        counted: dict[str, int] = {}
        for kind in self.plan():
            record = StageRecord(kind.name, datetime.now(timezone.utc).isoformat(), inputs={t: counted[t] for t in kind.needs if t in counted})
            self.records.append(record)
            began = time.monotonic()
            try:
                stage = kind(self.spark, self.config, self.client, f"{self.directory}/{kind.name}" if self.config.output.checkpoints.enabled else None)
                stage.validate(self.state)
                if self._kept(stage):
                    with scratch(self.spark):
                        tables = {table: self._checkpoint(stage, table, df, record) for table, df in stage.run(self.state).items()}
                else:
                    tables = stage.run(self.state)
                self.state.tables.update(tables)
                counted |= record.rows
            except Exception as error:
                record.error = f"{type(error).__name__}: {error}"
                raise
            finally:
                record.seconds = time.monotonic() - began
                self._metadata()
        return self.state

    def _kept(self, stage: stages.Stage) -> bool:
        c = self.config.output.checkpoints
        return c.enabled and not (stage.raw and c.skip_raw_data)

    def _checkpoint(self, stage: stages.Stage, table: str, df: DataFrame, record: StageRecord) -> DataFrame:
        """The table as it was written, so nothing is computed twice; in any format with its own types."""
        path, seen = f"{self.directory}/{stage.name}/{table}", Observation()
        df = df.observe(seen, F.count(F.lit(1)).alias("rows"))
        if table == "dataset":
            io.write_dataset(df, path)
        else:
            io.write_frame(df, path, self.config.output.checkpoints.format)
        record.rows[table] = seen.get["rows"]
        return io.read_frame(self.spark, path)

    def _metadata(self) -> None:
        if not self.config.output.checkpoints.enabled:
            return
        io.write_text(self.spark, f"{self.directory}/metadata.json", json.dumps({"run": self.name, "config": self.config.to_dict(), "stages": [asdict(r) for r in self.records]}, indent=2))
        io.write_text(self.spark, f"{self.directory}/prompts_used.json", json.dumps(REGISTRY.used(), indent=2))
