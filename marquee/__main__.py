"""Command line: ``python -m marquee collect|enrich|drain|report ...``.

Settings come from the environment under their published names. Submit with
``spark-submit`` to use a cluster's session.
"""

from __future__ import annotations

import argparse
import os

from pyspark.sql import DataFrame, SparkSession

from marquee.config import JobConfig
from marquee.operators.pages import lookup_two_call
from marquee.plans.collect import collect_dataset
from marquee.plans.enrich import run_enrichment
from marquee.plans.report import deliver, report
from marquee.schemas import DATASET_COLUMNS, STATE
from marquee.session import ENGINE_CONF, drop_scratch
from marquee.sources import catalogue, datasets
from marquee.sources import responses as stored
from marquee.sources.store import Store
from marquee.streaming.drain import Drain

# File names of the catalogue exports.
TITLES, RATINGS, CREDITS = "title.basics.tsv.gz", "title.ratings.tsv.gz", "title.principals.tsv.gz"


def _collect(spark: SparkSession, args: argparse.Namespace, cfg: JobConfig) -> None:
    lake = f"{args.store}/landed"
    titles = catalogue.land_titles(
        catalogue.read_titles(spark, f"{args.raw}/{TITLES}"), f"{lake}/titles")
    ratings = catalogue.land_ratings(
        catalogue.read_ratings(spark, f"{args.raw}/{RATINGS}"), f"{lake}/ratings")
    credits = catalogue.land_credits(
        catalogue.read_credits(spark, f"{args.raw}/{CREDITS}"), f"{lake}/credits")
    bodies = stored.read_bodies(spark, args.responses)
    # Many small files: listed and parsed once per kind, whatever reads them afterwards.
    searches = stored.land(stored.search_responses(bodies), f"{lake}/searches")
    parses = stored.land(stored.parse_responses(bodies), f"{lake}/parses")

    def lookup(rows: DataFrame, bound: int) -> DataFrame:
        return lookup_two_call(rows, searches, parses, bound)

    rows = collect_dataset(titles, ratings, credits, lookup, cfg)
    Store(spark, args.store).publish(rows, spark.createDataFrame([], STATE), cfg, "collect")


def _enrich(spark: SparkSession, args: argparse.Namespace, cfg: JobConfig) -> None:
    answers = stored.combined_responses(
        stored.read_bodies(spark, args.responses), cfg.search_limit)
    print(run_enrichment(Store(spark, args.store), answers, cfg).asDict())


def _drain(spark: SparkSession, args: argparse.Namespace, cfg: JobConfig) -> None:
    name = "retry" if cfg.retry_failed else "first"
    print("version", Drain(Store(spark, args.store), name, cfg).run(args.responses))


def _report(spark: SparkSession, args: argparse.Namespace, cfg: JobConfig) -> None:
    rows = Store(spark, args.store).dataset()
    if args.minimum_rows is None:
        lines = report(rows.select(*DATASET_COLUMNS), cfg, f"{args.out}/profile")
    else:
        lines = deliver(rows, cfg, f"{args.out}/dataset", f"{args.out}/profile", args.minimum_rows)
    for row in lines.collect():
        print(row["line"])


def _import(spark: SparkSession, args: argparse.Namespace, cfg: JobConfig) -> None:
    rows = datasets.typed_dataset(datasets.read_dataset_csv(spark, args.dataset))
    state = datasets.read_state_json(spark, args.state)
    Store(spark, args.store).publish(rows, state, cfg)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="marquee")
    jobs = parser.add_subparsers(dest="job", required=True)
    needs = {
        "collect": (_collect, ["raw", "responses"]),
        "import": (_import, ["dataset", "state"]),
        "enrich": (_enrich, ["responses"]),
        "drain": (_drain, ["responses"]),
        "report": (_report, ["out"]),
    }
    for job, (_, options) in needs.items():
        command = jobs.add_parser(job)
        for option in ["store", *options]:
            command.add_argument(f"--{option}", required=True)
        if job == "report":
            command.add_argument("--minimum-rows", type=int)
    args = parser.parse_args(argv)
    cfg = JobConfig.from_settings(os.environ, drain=args.job == "drain")
    spark = SparkSession.builder.appName(f"marquee-{args.job}").config(
        "spark.ui.enabled", "false").getOrCreate()
    for key, value in ENGINE_CONF.items():
        spark.conf.set(key, value)
    try:
        needs[args.job][0](spark, args, cfg)
    finally:
        drop_scratch(spark)


if __name__ == "__main__":
    main()
