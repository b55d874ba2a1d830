"""Command line of the jobs, for ``spark-submit`` with this package installed.

    spark-submit carebase/jobs.py refine --raw s3a://lake/raw --refined s3a://lake/refined
    spark-submit carebase/jobs.py ingest --inbox s3a://inbox --landing s3a://lake/raw \\
        --state s3a://lake/state --refined s3a://lake/refined
    spark-submit carebase/jobs.py views --refined s3a://lake/refined --curated s3a://lake/curated
    spark-submit carebase/jobs.py register --refined s3a://lake/refined --store s3a://lake/views
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession

from carebase.datasets import CLAIMS, STAFFING, pick_datasets
from carebase.functions.columns import BAD_VALUE_MODES
from carebase.plans.ingest import ingest
from carebase.plans.months import WORK_MONTH
from carebase.plans.refine import RefineOptions, refine_all
from carebase.plans.view_store import store_curated_views
from carebase.plans.views import refresh_views, write_views
from carebase.session import session_builder
from carebase.sources.listing import list_files
from carebase.sources.refined import WRITE_MODES, read_refined


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="carebase")
    jobs = parser.add_subparsers(dest="job", required=True)

    reading = argparse.ArgumentParser(add_help=False)
    reading.add_argument("--refined", required=True)
    reading.add_argument("--write-mode", choices=WRITE_MODES, default="overwrite", type=str.lower)
    reading.add_argument("--no-header", action="store_true")
    reading.add_argument("--delimiter", default=",")
    reading.add_argument("--fail-on-missing", action="store_true")
    reading.add_argument("--keep-going", action="store_true", help="succeed if datasets failed")
    reading.add_argument("--ignore-lineage", action="store_true")
    reading.add_argument("--at-once", type=int, default=4, help="datasets refined at a time")
    reading.add_argument("--skip-stored", action="store_true", help="append no row twice")
    reading.add_argument("--by-month", action="store_true", help="staffing in months")
    reading.add_argument("--single-line", default="", help="comma list of datasets to be split")
    reading.add_argument("--on-bad-value", choices=BAD_VALUE_MODES, default="raise")

    refine = jobs.add_parser("refine", parents=[reading])
    refine.add_argument("--raw", required=True)
    refine.add_argument("--datasets", default="", help="comma list; all known ones by default")

    run = jobs.add_parser("ingest", parents=[reading])
    run.add_argument("--inbox", required=True)
    run.add_argument("--state", required=True)
    run.add_argument("--landing", help="copy files there first; without it they are read in place")
    run.add_argument("--bucket", default="")
    run.add_argument("--prefix", default="")

    views = jobs.add_parser("views")
    views.add_argument("--refined", required=True)
    views.add_argument("--curated", required=True)
    views.add_argument("--on-bad-value", choices=("raise", "null"), default="raise")
    views.add_argument("--refresh", action="store_true", help="read changed months only")

    register = jobs.add_parser("register")
    register.add_argument("--refined", required=True)
    register.add_argument("--store", required=True)
    return parser


def main(arguments: Sequence[str] | None = None, spark: SparkSession | None = None) -> None:
    args = _parser().parse_args(arguments)
    spark = spark or session_builder(f"carebase-{args.job}").getOrCreate()
    if args.job == "register":
        store = store_curated_views(spark, args.store, args.refined, ("provnum", "state"))
        print("\n".join(store.definitions()))
        return
    if args.job == "views" and args.refresh:
        ties = {"load_tie_break": ("provnum", "state"), "on_bad_value": args.on_bad_value}
        refresh = refresh_views(spark, args.refined, args.curated, **ties)
        print("\n".join(refresh.paths.values()))
        return
    if args.job == "views":
        paths = write_views(
            read_refined(spark, args.refined, STAFFING),
            read_refined(spark, args.refined, CLAIMS),
            args.curated,
            load_tie_break=("provnum", "state"),
            on_bad_value=args.on_bad_value,
        )
        print("\n".join(paths.values()))
        return
    options = RefineOptions(
        header=not args.no_header,
        sep=args.delimiter,
        mode=args.write_mode,
        skip_missing=not args.fail_on_missing,
        ignore_lineage=args.ignore_lineage,
        skip_stored=args.skip_stored,
        at_once=args.at_once,
        on_bad_value=args.on_bad_value,
        partition={STAFFING: WORK_MONTH} if args.by_month else {},
        single_line=frozenset(pick_datasets(args.single_line)) if args.single_line else frozenset(),
    )
    common = {"fail_on_error": not args.keep_going, "options": options}
    if args.job == "refine":
        results = refine_all(spark, args.raw, args.refined, args.datasets, **common)
    else:
        run = ingest(
            spark,
            list_files(spark, args.inbox),
            args.state,
            args.refined,
            landing_root=args.landing,
            bucket=args.bucket,
            prefix=args.prefix,
            **common,
        )
        run.counts.show()
        results = run.results
    results.show(truncate=False)


if __name__ == "__main__":
    main()
