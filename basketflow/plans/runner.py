"""The two jobs in a row, as a function and for spark-submit."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from basketflow import schemas, session
from basketflow.plans import cleaning, curation, history, recommend, runs
from basketflow.sources import catalog
from basketflow.sources.zones import Zones
from basketflow.streaming.arrivals import on_notifications
from basketflow.streaming.incremental import incremental_clean


def run_all(
    spark: SparkSession, zones: Zones, strict: bool = False, resume: bool = False
) -> dict[str, dict[str, int]]:
    """Clean, then curate, as one run at a time. An error in the first stops
    the second; `resume` goes on after the last stage that was finished."""
    stages = [
        ("clean", lambda: cleaning.clean_all(spark, zones, strict)),
        ("features", lambda: curation.curate_features(spark, zones)),
        ("ml_dataset", lambda: curation.curate_ml_dataset(spark, zones)),
    ]
    return runs.run(spark, zones, stages, resume)["clean"]


def parser() -> argparse.ArgumentParser:
    args = argparse.ArgumentParser(prog="basketflow")
    args.add_argument("job", choices=["clean", "curate", "curate-new", "all", "sql", "train", "score", "stream", "arrivals"])
    args.add_argument("--root", help="folder that holds all zones not given below")
    for zone in ("raw", "clean", "curated", "consumption", "quarantine"):
        args.add_argument(f"--{zone}", help=f"{zone} zone")
    args.add_argument("--model", help="where the model is kept (train, score)")
    args.add_argument("--trees", action="store_true", help="train boosted trees")
    args.add_argument("--strict", action="store_true", help="reject decimal text in whole-number columns")
    args.add_argument("--models", help="folder of models, of which the newest scores (score)")
    args.add_argument("--prefix", default="data/", help="folder of the raw tables within the raw zone")
    args.add_argument("--tables", nargs="+", choices=sorted(schemas.DECLARED), default=sorted(schemas.DECLARED),
                      help="tables to take new files of (stream)")
    args.add_argument("--inbox", help="folder of notification messages (arrivals)")
    args.add_argument("--checkpoint", help="folder of stream progress (stream, arrivals)")
    args.add_argument("--resume", action="store_true", help="go on after the last finished stage (all)")
    args.add_argument("--query", help="SQL over the curated tables (sql)")
    args.add_argument("--output", help="folder of the result (sql)")
    args.add_argument("--shuffle-partitions", type=int)
    return args


def zones_from(args: argparse.Namespace) -> Zones:
    names = ("raw", "clean", "curated", "consumption", "quarantine")
    given = {name: getattr(args, name) for name in names}
    if args.root:
        defaults = Zones.under(args.root)
        given = {name: value or getattr(defaults, name) for name, value in given.items()}
    return Zones(**{name: (value or "").rstrip("/") for name, value in given.items()}, prefix=args.prefix)


def needed_zones(job: str) -> tuple[str, ...]:
    return {
        "clean": ("raw", "clean", "quarantine"),
        "curate": ("clean", "curated"),
        "curate-new": ("clean", "curated"),
        "all": ("raw", "clean", "quarantine", "curated"),
        "sql": ("curated",),
        "train": ("curated",),
        "score": ("curated", "consumption"),
        "stream": ("raw", "clean", "quarantine"),
        "arrivals": ("raw", "clean", "quarantine", "curated"),
    }[job]


def main(argv: list[str] | None = None) -> None:
    arguments = parser()
    args = arguments.parse_args(argv)
    zones = zones_from(args)
    missing = [f"--{zone}" for zone in needed_zones(args.job) if not getattr(zones, zone)]
    if args.job == "train" and not args.model or args.job == "score" and not (args.model or args.models):
        missing.append("--model")
    if args.job in ("stream", "arrivals") and not args.checkpoint:
        missing.append("--checkpoint")
    if args.job == "sql":
        missing += [f"--{name}" for name in ("query", "output") if not getattr(args, name)]
    if args.job == "arrivals" and not args.inbox:
        missing.append("--inbox")
    if missing:
        arguments.error(f"{args.job} needs {', '.join(missing)}")
    spark = session.build(shuffle_partitions=args.shuffle_partitions)
    if args.job in ("clean", "all"):
        whole = args.job == "all"
        done = run_all(spark, zones, args.strict, args.resume) if whole else cleaning.clean_all(spark, zones, args.strict)
        for table, counts in done.items():
            print(table, counts)
    if args.job == "curate":
        curation.curate_all(spark, zones)
    if args.job == "sql":
        catalog.write_result(spark, zones, args.query, args.output)
    if args.job == "curate-new":
        print(history.curate_new(spark, zones))
    if args.job == "train":
        recommend.train_job(spark, zones, args.model, args.trees)
    if args.job == "score":
        recommend.score_job(spark, zones, args.model, args.models)
    if args.job == "stream":
        for table in args.tables:
            incremental_clean(spark, zones, table, f"{args.checkpoint}/{table}", strict=args.strict)
    if args.job == "arrivals":
        on_notifications(spark, zones, args.inbox, args.checkpoint, then=history.curate_new, strict=args.strict)
