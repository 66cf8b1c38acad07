"""Settings of a build from a TOML or JSON file."""

from __future__ import annotations

import json
import tomllib
from dataclasses import dataclass, field, fields
from typing import Any


@dataclass(frozen=True)
class Settings:
    """What a build reads; models are named tables of their own settings, others stay in ``more``."""

    state: str = "out/state"
    input: str = ""
    output: str = "out/final"
    max_defs: int = 5
    max_total_words: int = 100
    checkpoint: int = 100
    lm_timeout: int = 120
    max_retry_count: int = 3
    models: dict[str, dict[str, Any]] = field(default_factory=dict)
    more: dict[str, Any] = field(default_factory=dict)


def parse(text: str) -> Settings:
    """TOML, or JSON in whatever file. A value of another kind than its setting is an error."""
    try:
        found = json.loads(text) if text.lstrip().startswith("{") else tomllib.loads(text)
    except ValueError as e:
        raise ValueError(f"settings can't be read: {e}") from e
    if "max_words" in found:  # the setting's old name
        found.setdefault("max_total_words", found.pop("max_words"))
    known = {f.name: f.type for f in fields(Settings) if f.name not in ("models", "more")}
    given = {k: v for k, v in found.items() if k in known}
    for k, v in given.items():
        if known[k] == "int" and (not isinstance(v, int) or isinstance(v, bool)) or known[k] == "str" and not isinstance(v, str):
            raise ValueError(f"{k} is {known[k]}, not {v!r}")
    models = {k: v for k, v in found.items() if k not in known and isinstance(v, dict)}
    return Settings(**given, models=models, more={k: v for k, v in found.items() if k not in known and k not in models})


def load(spark, path: str) -> Settings:
    """Settings of a file in any store that Spark reads; no path: the defaults."""
    return parse("\n".join(r["value"] for r in spark.read.text(path, wholetext=True).collect())) if path else Settings()
