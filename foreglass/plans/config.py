"""Settings of a run: built from what each stage declares next to its code, filled from plain YAML."""

from __future__ import annotations

import copy
import importlib
import os
import re
from collections.abc import Iterable
from pathlib import Path

from foreglass.sources.io import read_yaml

_DEFAULTS: dict = {}
_UNUSED: set[tuple[str, ...]] = set()
#: Sections of a composed YAML that say nothing about a run.
_IGNORED = ("defaults", "hydra")
_REFERENCE = re.compile(r"\$\{oc\.env:(\w+)(?:,([^}]*))?\}")


def declare(section: str, unused: Iterable[str] = (), **settings) -> None:
    """Settings of a dotted section with their defaults; ``unused`` names are accepted and have no effect here."""
    place = _DEFAULTS
    for name in section.split("."):
        place = place.setdefault(name, {})
    place.update(settings)
    _UNUSED.update((*section.split("."), name) for name in unused)


class Settings:
    """A section: settings and sections as attributes."""

    def __init__(self, values: dict):
        self._values = {k: Settings(v) if isinstance(v, dict) else v for k, v in values.items()}

    def __getattr__(self, name: str):
        if name.startswith("_") or name not in self._values:
            raise AttributeError(name)
        return self._values[name]

    def to_dict(self) -> dict:
        return {k: v.to_dict() if isinstance(v, Settings) else v for k, v in self._values.items()}


class PipelineConfig(Settings):
    """All settings of a run. Unknown names are an error."""

    def __init__(self, values: dict | None = None):
        importlib.import_module("foreglass.plans.runner")  # it and the stages declare the settings
        given = {k: v for k, v in (values or {}).items() if k not in _IGNORED}
        super().__init__(_merged(_DEFAULTS, given, ()))

    @property
    def is_rl(self) -> bool:
        return self.run.pipeline_type == "rl"

    @classmethod
    def from_dict(cls, values: dict) -> PipelineConfig:
        return cls(values)

    @classmethod
    def from_yaml(cls, path: str | Path) -> PipelineConfig:
        return cls(read_yaml(str(path)))


def _merged(defaults: dict, given: dict, place: tuple[str, ...]) -> dict:
    unused = {p[-1] for p in _UNUSED if p[:-1] == place}
    if unknown := sorted(set(given) - set(defaults) - unused):
        raise ValueError(f"unknown settings of {'.'.join(place) or 'the run'}: {unknown}")
    out = copy.deepcopy(defaults)
    for name, value in given.items():
        if name in defaults:
            section = isinstance(defaults[name], dict)
            out[name] = _merged(defaults[name], value or {}, (*place, name)) if section else _resolved(value)
    return out


def _resolved(value):
    """A value with ``${oc.env:NAME,default}`` looked up in the environment; ``null`` is None."""
    if not isinstance(value, str) or not (found := _REFERENCE.fullmatch(value)):
        return value
    known = os.environ.get(found[1], found[2])
    return None if known in (None, "null", "") else known
