"""python -m tessella [--root DIR] COMMAND: 0 is success, 1 an error or findings that block, 2 a wrong call."""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from tessella.plans.workspace import Workspace
from tessella.schemas import EngineError

COMMANDS = ("validate-source", "scan", "validate", "generate", "package", "report", "status", "next-batch", "import-batch", "export")


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    parser = argparse.ArgumentParser(prog="tessella")
    parser.add_argument("--root", default=".")
    sub = parser.add_subparsers(dest="command", required=True)
    for c in COMMANDS:
        p = sub.add_parser(c)
        if c == "next-batch":
            p.add_argument("--limit", type=int, default=100)
        if c == "import-batch":
            p.add_argument("path")
    try:
        args = parser.parse_args(argv)
    except SystemExit as e:
        return int(e.code or 0)
    spark = spark or SparkSession.builder.appName("tessella").getOrCreate()
    w = Workspace(spark, args.root)
    shared = args.command in ("status", "validate-source")
    try:
        with w.locked(shared):
            if not shared:
                w.recover()
            call = getattr(w, args.command.replace("-", "_"))
            out = call(args.limit) if args.command == "next-batch" else call(args.path) if args.command == "import-batch" else call()
            if not shared and args.command != "report":
                w.report()
    except (EngineError, OSError, KeyError) as e:
        print(f"error: {e}", file=sys.stderr)
        return 1
    print(out if not isinstance(out, dict) else json.dumps(out, ensure_ascii=False, sort_keys=True))
    return 1 if out is False or (args.command == "import-batch" and out["blocking"]) else 0


if __name__ == "__main__":
    sys.exit(main())
