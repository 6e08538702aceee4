"""Command line: collect, generate-sample, analyze."""

from __future__ import annotations

import argparse
import json
from datetime import datetime, timezone

from fernlight.settings import Settings


def build_parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="fernlight", description="Signals from short posts, on Spark")
    verbs = parser.add_subparsers(dest="command", required=True)
    collect = verbs.add_parser("collect", help="add landed posts (JSON lines) to a store")
    collect.add_argument("--input", required=True)
    collect.add_argument("--target", type=int, default=2000)
    collect.add_argument("--hours", type=int, default=24)
    collect.add_argument("--output", default="data/raw/posts")
    sample = verbs.add_parser("generate-sample", help="write synthetic posts")
    sample.add_argument("--count", type=int, default=2500)
    sample.add_argument("--seed", type=int, default=42)
    sample.add_argument("--output", default="data/sample/posts")
    analyze = verbs.add_parser("analyze", help="signals, summary and vectors of a store")
    analyze.add_argument("--input", required=True)
    analyze.add_argument("--output", default="data/output")
    analyze.add_argument("--window-minutes", type=int, default=None)
    for verb in (collect, sample, analyze):
        verb.add_argument("--as-of", type=datetime.fromisoformat, default=None, help="ISO time that stands for now")
    return parser


def main(argv: list[str] | None = None) -> None:
    args = build_parser().parse_args(argv)
    settings = Settings.from_env()
    from pyspark.sql import SparkSession
    from pyspark.sql import functions as F

    from fernlight.plans import runs
    from fernlight.sources import landing, posts, sinks, synthetic

    sinks.configure_logging(settings.log_level)
    spark = SparkSession.builder.appName("fernlight").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    as_of = args.as_of or datetime.now(timezone.utc)
    as_of = as_of if as_of.tzinfo else as_of.replace(tzinfo=timezone.utc)
    if args.command == "collect":
        out = runs.ingest(spark, landing.read_json(spark, args.input), args.output, target=args.target, hours=args.hours, as_of=as_of, settings=settings)
    elif args.command == "generate-sample":
        out = {"written": posts.write_posts(synthetic.clean_sample(spark, args.count, args.seed, F.lit(as_of)), args.output, rows_per_file=settings.rows_per_file), "output": args.output}
    else:
        out = runs.analyze(spark, args.input, args.output, minutes=args.window_minutes or settings.window_minutes, as_of=as_of, features=settings.vector_features)
    print(json.dumps(out, indent=2, ensure_ascii=False))


if __name__ == "__main__":
    main()
