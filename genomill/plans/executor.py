"""Stages as a DAG over named artifacts: levels, caching, atomic outputs, provenance."""

from __future__ import annotations

import contextlib
import json
import os
import pickle
import platform
import time
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import UTC, datetime

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from .. import __version__
from ..shipping import ship
from .config import Config, Param, checked, digest


@dataclass(frozen=True)
class Stage:
    """``run(ctx, cfg)`` returns artifacts by role: DataFrames, or JSON-like values."""

    name: str
    run: Callable[[Context, dict], dict]
    needs: tuple[str, ...] = ()
    takes: tuple[str, ...] = ()
    makes: tuple[str, ...] = ()
    params: dict[str, Param] = field(default_factory=dict)


class Registry:
    def __init__(self) -> None:
        self._stages: dict[str, Stage] = {}

    def register(self, name: str, **how) -> Callable:  # noqa: ANN003
        def add(f: Callable) -> Callable:
            if name in self._stages:
                raise ValueError(f"stage {name} is registered twice")
            self._stages[name] = Stage(name, f, **how)
            return f

        return add

    def __getitem__(self, name: str) -> Stage:
        if name not in self._stages:
            raise KeyError(f"unknown stage {name}; known: {', '.join(sorted(self._stages))}")
        return self._stages[name]

    def names(self) -> list[str]:
        return sorted(self._stages)

    def plugins(self, group: str) -> None:
        """Loads entry points, which register stages when imported."""
        from importlib.metadata import entry_points

        for point in entry_points(group=group):
            point.load()


class Names:
    """Named objects of one kind, for plugins to add to; a name is taken once."""

    def __init__(self, kind: str) -> None:
        self.kind, self._held = kind, {}

    def register(self, name: str) -> Callable:
        def add(value: object) -> object:
            if name in self._held:
                raise ValueError(f"{self.kind} {name} is registered twice")
            self._held[name] = value
            return value

        return add

    def __getitem__(self, name: str) -> object:
        if name not in self._held:
            raise KeyError(f"unknown {self.kind} {name}; known: {', '.join(sorted(self._held))}")
        return self._held[name]

    def names(self) -> list[str]:
        return sorted(self._held)


STAGES = Registry()
DATASETS, REFERENCES, ANALYSES = Names("dataset"), Names("reference"), Names("analysis")


def map_parallel(spark: SparkSession, func: Callable, items: list) -> list:
    """``[func(x) for x in items]``, each call a task of its own.  Items and results have to be
    few and small: they pass through the driver."""
    ship(spark)
    rows = [(i, pickle.dumps(x)) for i, x in enumerate(items)]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for i, x in zip(f["i"].tolist(), f["x"], strict=True):
                yield pd.DataFrame({"i": [i], "x": [pickle.dumps(func(pickle.loads(x)))]})  # noqa: S301 - the driver's own

    each = spark.createDataFrame(rows, "i bigint, x binary").repartition(max(1, len(rows)), "i")
    return [pickle.loads(r["x"]) for r in sorted(each.mapInPandas(run, "i bigint, x binary").collect())]  # noqa: S301


class Store:
    """A folder of any file system that Spark can write to, by Hadoop paths.  A path without a
    scheme is of the session's default file system; if that is local, it is made absolute."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self._paths = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        if "://" not in folder and str(self._conf.get("fs.defaultFS", "file:///")).startswith("file"):
            folder = f"file://{os.path.abspath(folder)}"
        self.folder = folder.rstrip("/")
        self._fs = self._paths(self.folder).getFileSystem(self._conf)

    def path(self, name: str = "") -> str:
        return f"{self.folder}/{name}" if name else self.folder

    def _at(self, name: str):  # noqa: ANN202
        return self._paths(self.path(name))

    def exists(self, name: str) -> bool:
        return self._fs.exists(self._at(name))

    def names(self, name: str = "") -> list[tuple[str, bool]]:
        """(name, whether it is a folder) of what is in a folder, in order."""
        return sorted((f.getPath().getName(), f.isDirectory()) for f in self._fs.listStatus(self._at(name)))

    def state(self, name: str) -> list:
        """Length and time of a file, or of the files of a folder."""
        if self._fs.getFileStatus(self._at(name)).isDirectory():
            return [[f.getPath().getName(), f.getLen(), f.getModificationTime()] for f in sorted(self._fs.listStatus(self._at(name)), key=lambda f: f.getPath().getName())]
        status = self._fs.getFileStatus(self._at(name))
        return [status.getLen(), status.getModificationTime()]

    def read(self, name: str) -> str:
        stream = self._fs.open(self._at(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        """All or nothing."""
        head, _, tail = name.rpartition("/")
        other = f"{head + '/' if head else ''}.{tail}.{uuid.uuid4().hex}"
        stream = self._fs.create(self._at(other), True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        self.move(other, name)

    def move(self, name: str, to: str) -> None:
        """Renames within the file system; what was there goes."""
        self.delete(to)
        if not self._fs.rename(self._at(name), self._at(to)):
            raise OSError(f"{self.path(name)} can't be renamed to {self.path(to)}")

    def delete(self, name: str) -> None:
        self._fs.delete(self._at(name), True)


@dataclass
class Context:
    spark: SparkSession
    seed: int
    folder: str
    artifacts: dict[str, object] = field(default_factory=dict)
    root: str = "."

    def path(self, name: str) -> str:
        """A path of the configuration, below its root unless it is absolute."""
        name = str(name)
        return name if "://" in name or os.path.isabs(name) or self.root in ("", ".") else f"{self.root.rstrip('/')}/{name}"

    def get(self, *roles: str):  # noqa: ANN201
        """The first of the roles that there is."""
        for r in roles:
            if r in self.artifacts:
                return self.artifacts[r]
        raise KeyError(f"no artifact {' or '.join(roles)}")


def levels(stages: list[Stage]) -> list[list[Stage]]:
    """Stages whose inputs are made by earlier levels or come from outside; names sorted within
    a level.  Two makers of one role, and cycles, are errors."""
    maker: dict[str, str] = {}
    for s in stages:
        for role in s.makes:
            if role in maker:
                raise ValueError(f"{role} is made by {maker[role]} and {s.name}")
            maker[role] = s.name
    waits = {s.name: {maker[r] for r in (*s.needs, *s.takes) if r in maker and maker[r] != s.name} for s in stages}
    left, done, out = {s.name: s for s in stages}, set(), []
    while left:
        ready = sorted(n for n in left if waits[n] <= done)
        if not ready:
            raise ValueError(f"cycle among {', '.join(sorted(left))}")
        out.append([left.pop(n) for n in ready])
        done |= set(ready)
    return out


class Executor:
    """Runs a configuration; a stage whose fingerprint (its parameters and those of all that it
    depends on, and the state of the files that they name) has outputs already is not run
    again.  Outputs are written beside their place, in the run's file system, and renamed; a
    failed stage leaves none.  A file ``pause`` or ``cancel`` in the run's folder stops the run
    before its next level, which the record calls interrupted; to run again goes on there."""

    def __init__(self, spark: SparkSession, config: Config, registry: Registry = STAGES, workers: int = 2) -> None:
        self.spark, self.config, self.registry, self.workers = spark, config, registry, workers

    def plan(self) -> list[list[tuple[Stage, dict]]]:
        stages = [self.registry[n] for n in self.config.pipeline]
        cfg = {s.name: checked(s.name, s.params, self.config.stages.get(s.name, {})) for s in stages}
        return [[(s, cfg[s.name]) for s in level] for level in levels([s for s in stages if cfg[s.name]["enabled"]])]

    def run(self, run_id: str = "run", artifacts: dict | None = None, dry_run: bool = False) -> dict:
        record: dict = {"run_id": run_id, "project": self.config.name, "config": digest(vars(self.config)), "started": datetime.now(UTC).isoformat(), "stages": {}}
        plan = self.plan()
        if dry_run:
            return record | {"plan": [[s.name for s, _ in level] for level in plan]}
        store = Store(self.spark, f"{self.config.run_dir.rstrip('/')}/{run_id}")
        ctx = Context(self.spark, self.config.seed, store.path(), dict(artifacts or {}), self.config.root)
        prints: dict[str, str] = {r: r for r in ctx.artifacts}
        record |= {"versions": {"python": platform.python_version(), "spark": self.spark.version, "package": __version__}, "status": "done"}
        ship(self.spark)
        for level in plan:
            if stop := next((x for x in ("cancel", "pause") if store.exists(x)), None):
                record |= {"status": "interrupted", "by": stop, "left": [s.name for rest in plan[plan.index(level) :] for s, _ in rest]}
                store.write("provenance.json", json.dumps(record, indent=1, default=str))
                break

            def one(item: tuple[Stage, dict]) -> tuple[Stage, dict]:
                return item[0], self._stage(ctx, store, *item, prints)

            with ThreadPoolExecutor(self.workers) as pool:
                done = list(pool.map(one, level))
            for stage, got in done:
                record["stages"][stage.name] = {k: v for k, v in got.items() if k != "artifacts"}
                ctx.artifacts |= got["artifacts"]
                prints |= dict.fromkeys(got["artifacts"], got["fingerprint"])
            if any(g["status"] == "failed" for _, g in done):
                record["status"] = "failed"
            store.write("provenance.json", json.dumps(record, indent=1, default=str))
            store.write("provenance.md", summary(record))
            if self.config.fail_fast and record["status"] == "failed":
                break
        record["artifacts"] = ctx.artifacts
        return record

    def _inputs(self, ctx: Context, cfg: dict) -> dict[str, list]:
        """The state of the files that parameters name."""
        out = {}
        for key, value in cfg.items():
            for v in value if isinstance(value, (list, tuple)) else [value]:
                if isinstance(v, str) and ("/" in v or "." in v) and " " not in v:
                    path = ctx.path(v)
                    with contextlib.suppress(Exception):  # a value that is no path
                        folder, _, name = path.rstrip("/").rpartition("/")
                        at = Store(ctx.spark, folder or ".")
                        if at.exists(name):
                            out[f"{key}:{v}"] = at.state(name)
        return out

    def _stage(self, ctx: Context, store: Store, stage: Stage, cfg: dict, prints: dict[str, str]) -> dict:
        began, inputs = time.time(), self._inputs(ctx, cfg)
        mark = digest([stage.name, cfg, ctx.seed, inputs, {r: prints.get(r) for r in (*stage.needs, *stage.takes)}])
        home = stage.name
        try:
            if missing := [r for r in stage.needs if r not in ctx.artifacts]:
                raise KeyError(f"needs {', '.join(missing)}")
            if store.exists(f"{home}/fingerprint") and store.read(f"{home}/fingerprint") == mark:
                return {"status": "cached", "fingerprint": mark, "artifacts": self._load(store, home), "seconds": 0.0}
            staged = f".{stage.name}.{uuid.uuid4().hex}"
            try:
                for role, value in stage.run(ctx, cfg).items():
                    if isinstance(value, DataFrame):
                        value.write.parquet(store.path(f"{staged}/{role}"))
                    else:
                        store.write(f"{staged}/{role}.json", json.dumps(value, default=str))
                store.write(f"{staged}/fingerprint", mark)
                store.move(staged, home)
            finally:
                store.delete(staged)
            return {"status": "done", "fingerprint": mark, "inputs": inputs, "artifacts": self._load(store, home), "seconds": time.time() - began}
        except Exception as e:
            return {"status": "failed", "fingerprint": mark, "artifacts": {}, "error": f"{type(e).__name__}: {e}"[:2000], "seconds": time.time() - began}

    def _load(self, store: Store, home: str) -> dict:
        out: dict = {}
        for name, folder in store.names(home):
            if folder:
                out[name] = self.spark.read.parquet(store.path(f"{home}/{name}"))
            elif name.endswith(".json") and not name.startswith("."):
                out[name.removesuffix(".json")] = json.loads(store.read(f"{home}/{name}"))
        return out


def summary(record: dict) -> str:
    """The record as Markdown."""
    rows = [f"| {n} | {g['status']} | {g['seconds']:.1f} | `{g['fingerprint'][:12]}` |" for n, g in record["stages"].items()]
    versions = ", ".join(f"{k} {v}" for k, v in record.get("versions", {}).items())
    return "\n".join([f"# Run {record['run_id']}", "", f"{record.get('status', '')}; started {record['started']}; {versions}", "", "| stage | status | s | fingerprint |", "|-|-|-|-|", *rows, ""])
