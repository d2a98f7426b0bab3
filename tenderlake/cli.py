"""python -m tenderlake.cli normalize --input DIR --output DIR [--format tables], or analyze --tables DIR --order ID --output DIR."""

from __future__ import annotations

import argparse
from pathlib import Path

from tenderlake.operators.normalize import judged, split_counts
from tenderlake.session import Scratch, session
from tenderlake.sources.records import ADAPTERS, read_records
from tenderlake.sources.sinks import export_json, write_tables


def normalize(args: argparse.Namespace) -> None:
    source, target = args.input.resolve(), args.output.resolve()
    if target == source:
        raise SystemExit("the output folder must not be the input folder: a later run would read its own results")
    spark = session()
    scratch = Scratch(spark, "normalize")
    rows = scratch.save(judged(ADAPTERS[args.adapter](read_records(spark, str(source)))), "judged")
    if args.format == "json":
        good, bad = export_json(rows, target)
    else:
        write_tables(rows, str(target))
        good, bad = split_counts(rows).first()
    scratch.drop(rows)
    # Fixed value: the line that tells the counts.
    print(f"normalized={good} review={bad}")


def analyze(args: argparse.Namespace) -> None:
    from tenderlake.plans.analyze import analyze_order

    for name, n in analyze_order(session(), args.tables, args.order, args.output).items():
        print(f"{name}={n}")


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser()
    commands = parser.add_subparsers(required=True)
    one = commands.add_parser("normalize")
    one.add_argument("--input", type=Path, required=True)
    one.add_argument("--output", type=Path, required=True)
    one.add_argument("--adapter", default="canonical", choices=sorted(ADAPTERS))
    one.add_argument("--format", default="json", choices=["json", "tables"], help="two JSON arrays, or Parquet tables written in parallel")
    one.set_defaults(run=normalize)
    two = commands.add_parser("analyze")
    two.add_argument("--tables", required=True)
    two.add_argument("--order", type=int, required=True)
    two.add_argument("--output", type=Path, required=True)
    two.set_defaults(run=analyze)
    args = parser.parse_args(argv)
    args.run(args)


if __name__ == "__main__":
    main()
