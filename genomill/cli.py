"""Command line: ``python -m genomill.cli version | stages | config | run``."""

from __future__ import annotations

import argparse
import json

from . import __version__


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="genomill")
    sub = p.add_subparsers(dest="command", required=True)
    sub.add_parser("version")
    sub.add_parser("stages")
    for name in ("config", "run"):
        s = sub.add_parser(name)
        s.add_argument("-c", "--config", action="append", default=[])
        s.add_argument("-s", "--set", action="append", default=[])
        if name == "run":
            s.add_argument("--dry-run", action="store_true")
            s.add_argument("--run-id", default="run")
    a = p.parse_args(argv)
    if a.command == "version":
        print(__version__)
        return 0
    from .plans import config, stages  # noqa: F401 - registers the stages
    from .plans.executor import STAGES, Executor

    if a.command == "stages":
        print("\n".join(STAGES.names()))
        return 0
    raw = config.load(a.config, a.set)
    if a.command == "config":
        print(json.dumps(raw, indent=1))
        return 0
    if a.dry_run:
        print(json.dumps(Executor(None, config.Config.of(raw)).run(a.run_id, dry_run=True)["plan"]))
        return 0
    from pyspark.sql import SparkSession

    record = Executor(SparkSession.builder.getOrCreate(), config.Config.of(raw)).run(a.run_id)
    print(json.dumps(record["stages"], indent=1, default=str))
    return int(any(s["status"] == "failed" for s in record["stages"].values()))


if __name__ == "__main__":
    raise SystemExit(main())
