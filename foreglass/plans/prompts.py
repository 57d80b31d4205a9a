"""Prompt templates and their registry."""

from __future__ import annotations

import hashlib
import string
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, functions as F

from foreglass.sources.io import read_yaml, write_yaml


# The fields of a prompt file, and what they are here.
_NAMES = {"system_prompt": "system", "user_prompt_template": "user", "required_variables": "required"}


@dataclass
class PromptTemplate:
    """A system text and a user text with ``{variables}``."""

    name: str
    system: str
    user: str
    version: str = "1"
    required: tuple[str, ...] = ()
    metadata: dict = field(default_factory=dict)

    def __post_init__(self):
        self.required = tuple(self.required) or tuple(dict.fromkeys(n for _, n, _, _ in string.Formatter().parse(self.user) if n))

    def render(self, **values: str) -> str:
        if missing := sorted(set(self.required) - set(values)):
            raise KeyError(f"{self.name}: {missing}")
        return self.user.format(**values)

    def column(self, **values: Column) -> Column:
        """The user text as an expression over columns; a null value gives a null prompt."""
        if missing := sorted(set(self.required) - set(values)):
            raise KeyError(f"{self.name}: {missing}")
        parts = []
        for literal, name, _, _ in string.Formatter().parse(self.user):
            parts.append(F.lit(literal))
            if name:
                parts.append(values[name])
        return F.concat(*parts)

    @property
    def hash(self) -> str:
        """Eight hexadecimal digits that change with the texts."""
        return hashlib.md5((self.system + self.user).encode()).hexdigest()[:8]

    @classmethod
    def from_yaml(cls, path: str) -> PromptTemplate:
        """A template from its own fields or from those of ``_NAMES``; a description is left out."""
        values = {_NAMES.get(k, k): v for k, v in read_yaml(path).items() if k != "description"}
        return cls(**{**values, "version": str(values.get("version", "1"))})

    def to_yaml(self, path: str) -> None:
        write_yaml({**asdict(self), "required": list(self.required)}, path)


class PromptRegistry:
    """Templates by name."""

    def __init__(self):
        self._templates: dict[str, PromptTemplate] = {}

    def register(self, template: PromptTemplate) -> PromptTemplate:
        self._templates[template.name] = template
        return template

    def get(self, name: str) -> PromptTemplate:
        if name not in self._templates:
            raise KeyError(f"no prompt {name}; there are {self.names()}")
        return self._templates[name]

    def load(self, path: str) -> PromptTemplate:
        return self.register(PromptTemplate.from_yaml(path))

    def names(self) -> list[str]:
        return sorted(self._templates)

    def used(self) -> dict:
        return {n: {"version": t.version, "hash": t.hash} for n, t in sorted(self._templates.items())}


REGISTRY = PromptRegistry()
# Names and variables of the templates, which custom prompt files use too.
TITLE = REGISTRY.register(PromptTemplate("event_augment", "You write clear titles for forecasting questions. Answer with the title only.", "Title: {raw}\nRules: {rules}\nOutcomes: {outcome}\n\nWrite a title that can be understood without the rules and outcomes."))
REASONING = REGISTRY.register(PromptTemplate("reasoning_augment", "You improve the reasoning behind a forecast without changing its probabilities. Answer with source_analysis, market_analysis and rationale.", "{event_info}\n\nSources:\n{sources}\n\nMarket prices: {market_data}\n\nForecast: {llm_prediction}\n\nReasoning so far: {vanilla_rationale}"))
PREDICTION = REGISTRY.register(PromptTemplate("prediction", "You forecast the outcomes of events. Give your reasoning, then the probability of each outcome as JSON between <probabilities> tags.", "{prompt}"))
