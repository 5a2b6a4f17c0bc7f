"""Layered configuration: deep-merged mappings, dotted overrides, typed stage parameters."""

from __future__ import annotations

import copy
import hashlib
import json
from dataclasses import dataclass, field
from pathlib import Path
from typing import Any


def merge(base: dict, over: dict) -> dict:
    """``over`` on ``base``; mappings merge, all else is replaced."""
    out = copy.deepcopy(base)
    for k, v in over.items():
        out[k] = merge(out[k], v) if isinstance(v, dict) and isinstance(out.get(k), dict) else copy.deepcopy(v)
    return out


def scalar(text: str) -> Any:
    """true, false, null, a number, a JSON list or mapping, or the text itself."""
    low = text.strip().lower()
    if low in ("true", "false"):
        return low == "true"
    if low in ("null", "none", ""):
        return None
    try:
        return json.loads(text)
    except ValueError:
        return text


def assign(config: dict, dotted: str) -> dict:
    """``a.b.c=value`` set in a copy."""
    path, _, value = dotted.partition("=")
    if not _:
        raise ValueError(f"{dotted}: expected key=value")
    over: Any = scalar(value)
    for key in reversed(path.split(".")):
        over = {key: over}
    return merge(config, over)


def load(files: list[str], overrides: list[str] = ()) -> dict:
    """Files of JSON or YAML, later ones on earlier ones, then the overrides."""
    out: dict = {}
    for name in files:
        text = Path(name).read_text()
        if name.endswith((".yaml", ".yml")):
            import yaml

            got = yaml.safe_load(text) or {}
        else:
            got = json.loads(text)
        out = merge(out, got)
    for o in overrides:
        out = assign(out, o)
    return out


def digest(value: Any) -> str:
    return hashlib.sha256(json.dumps(value, sort_keys=True, default=str).encode()).hexdigest()


@dataclass(frozen=True)
class Param:
    """A stage parameter: default and limits."""

    default: Any = None
    least: float | None = None
    most: float | None = None
    choices: tuple = ()
    required: bool = False


def checked(stage: str, params: dict[str, Param], given: dict) -> dict:
    """Given values over defaults; an error names what is wrong.  Unknown keys pass."""
    out = {k: p.default for k, p in params.items()} | {"enabled": True} | given
    for k, p in params.items():
        v = out[k]
        if p.required and v in (None, "", []):
            raise ValueError(f"{stage}.{k} is required")
        if v is not None and ((p.least is not None and v < p.least) or (p.most is not None and v > p.most)):
            raise ValueError(f"{stage}.{k}: {v} is out of range")
        if p.choices and v not in p.choices:
            raise ValueError(f"{stage}.{k}: {v} is not one of {', '.join(map(str, p.choices))}")
    return out


@dataclass
class Config:
    """``pipeline``: stage names in order; ``stages``: their parameters; ``root``: the folder of
    relative paths.  A file system's scheme may stand before any path."""

    pipeline: list[str]
    stages: dict[str, dict] = field(default_factory=dict)
    run_dir: str = "runs"
    seed: int = 0
    fail_fast: bool = True
    root: str = "."
    name: str = ""

    @classmethod
    def of(cls, raw: dict) -> Config:
        known = {"pipeline", "stages", "run_dir", "seed", "fail_fast", "paths", "project_name", "logging"}
        if extra := set(raw) - known:
            raise ValueError(f"unknown settings: {', '.join(sorted(extra))}")
        paths = raw.get("paths") or {}
        return cls(list(raw.get("pipeline", [])), dict(raw.get("stages", {})), raw.get("run_dir") or paths.get("run_dir", "runs"), int(raw.get("seed", 0)), bool(raw.get("fail_fast", True)), paths.get("root", "."), raw.get("project_name", ""))
