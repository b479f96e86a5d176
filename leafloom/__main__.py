"""The command line: a query over a data folder, or the names of a bundle.

``python -m leafloom run QUERY DATA OUT`` writes a registered query's rows as Parquet; ``python -m leafloom list`` names
the queries; ``python -m leafloom bundle [--bundle-id ID] [--baseline-bundle-id ID]`` says which bundles are compared.
"""

from __future__ import annotations

import argparse
import json
from datetime import UTC, datetime


def arguments(given: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="leafloom")
    commands = parser.add_subparsers(dest="command", required=True)
    run = commands.add_parser("run")
    for name in ("query", "data", "out"):
        run.add_argument(name)
    commands.add_parser("list")
    bundle = commands.add_parser("bundle")
    bundle.add_argument("--bundle-id")
    bundle.add_argument("--baseline-bundle-id")
    return parser.parse_args(given)


def main(given: list[str] | None = None) -> None:
    args = arguments(given)
    if args.command == "bundle":
        from leafloom.operators.bundle import bundle_ids

        own, baseline = bundle_ids(datetime.now(UTC).date().isoformat(), args.bundle_id, args.baseline_bundle_id)
        print(json.dumps({"bundle": own, "baseline": baseline}))
        return
    from leafloom.plans import registry

    if args.command == "list":
        print("\n".join(sorted(registry.QUERIES)))
        return
    if args.query not in registry.QUERIES:
        raise SystemExit(f"no query is named {args.query}")
    from pyspark.sql import SparkSession

    spark = SparkSession.builder.appName(f"leafloom {args.query}").getOrCreate()
    registry.QUERIES[args.query](spark, args.data).write.mode("overwrite").parquet(args.out)


if __name__ == "__main__":
    main()
