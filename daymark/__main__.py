"""``python -m daymark JOB ...`` runs one job; ``spark-submit`` gives it a cluster."""

from __future__ import annotations

import argparse
import time

from pyspark.sql import SparkSession

from daymark import plans, sources, streaming
from daymark.session import configure


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="daymark", description="Jobs on daily snapshots.")
    jobs = parser.add_subparsers(dest="job", required=True)

    def job(name: str, help_: str, *required: str) -> argparse.ArgumentParser:
        sub = jobs.add_parser(name, help=help_)
        for argument in required:
            sub.add_argument(f"--{argument}", required=True)
        return sub

    sub = job("capture", "store the table rows of HTML pages as a capture", "pages", "raw")
    sub.add_argument("--capture-ts", type=float, help="epoch seconds; now if left out")
    sub.add_argument("--page-col", help="the column with the number of the page, to keep row order")
    stored = job("dates", "print the newest date and the one it is compared with", "raw")
    job("audit", "print the raw files that lack a column's header", "raw")
    sub = job("extract", "write the refined rows of two dates", "raw", "d0", "base")
    sub.add_argument("--d2", default="", help="left out if there is no earlier date")
    layouts = [stored, sub]
    job("transform", "write the summary and the comparison of the refined rows", "base")
    sub = job("load", "write and register the result tables", "base", "database")
    sub.add_argument("--replace-date", help="also drop what is stored for this date and not new")
    sub = job("publish", "like load, but readers see all of a result's new rows at once", "base", "database")
    sub.add_argument("--replace-date", help="also drop what is shown for this date and not new")
    sub = job("run-latest", "extract, transform and load the newest date", "raw", "base", "database")
    sub.add_argument("--back", type=int, default=2)
    sub.add_argument(
        "--replace", action="store_true", help="also drop what is stored for that date and not new"
    )
    sub.add_argument(
        "--least-share", type=float, help="stop if the rows fall below this share of what is usual"
    )
    job("history", "print what earlier runs counted", "base")
    layouts.append(sub)
    sub = job("backfill", "write the summary and the comparison of all dates", "raw", "base")
    layouts.append(sub)
    sub.add_argument("--database", help="where the summary table is registered, if anywhere")
    sub.add_argument("--back", type=int, default=2)
    sub = job("update", "bring the results of all dates up to date with the raw files", "raw", "base")
    sub.add_argument("--back", type=int, default=2)
    sub = job("ingest", "refine the files that landed since the last run", "raw", "out", "checkpoint")
    sub.add_argument(
        "--max-files-per-batch", type=int, default=streaming.ingest.MAX_FILES_PER_BATCH
    )
    sub = job("land", "like ingest, with a record of one row per date", "raw", "out")
    sub.add_argument("--max-files-per-lot", type=int, default=plans.landing.MAX_FILES_PER_LOT)
    for sub in layouts:
        sub.add_argument(
            "--layout",
            choices=sorted(sources.layouts.LAYOUTS),
            default="partitions",
            help="partitions: RAW/dt_ptcm=YYYYMMDD/; captures: RAW/YYYYMMDD/<epoch>.parquet",
        )
    return parser


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    spark = configure(SparkSession.builder.appName(f"daymark {args.job}")).getOrCreate()
    if args.job == "capture":
        pages = spark.read.parquet(args.pages)
        capture_ts = time.time() if args.capture_ts is None else args.capture_ts
        plans.capture(pages, args.raw, capture_ts, page_col=args.page_col)
    elif args.job == "dates":
        dates = sources.layout(args.layout).dates(spark, args.raw)
        print(*sources.latest_dates(spark, args.raw, dates=dates))
    elif args.job == "audit":
        found = sources.audit_headers(spark, args.raw).where("size(missing) > 0")
        for row in found.orderBy("file").toLocalIterator():
            print(row["file"], row["n_rows"], ", ".join(row["missing"]), sep="\t")
    elif args.job == "extract":
        plans.store_refined(spark, args.raw, args.d0, args.d2, args.base, args.layout)
    elif args.job == "transform":
        plans.store_results(spark, args.base)
    elif args.job == "load":
        plans.load_stored(spark, args.base, args.database, args.replace_date)
    elif args.job == "publish":
        dates = [args.replace_date] if args.replace_date else []
        print(*plans.publish_stored(spark, args.base, args.database, dates))
    elif args.job == "update":
        print(*plans.update_results(spark, args.raw, args.base, args.back))
    elif args.job == "run-latest":
        where = args.raw, args.base, args.database
        print(*plans.run_latest(spark, *where, args.back, args.replace, args.layout, args.least_share))
    elif args.job == "backfill":
        plans.store_backfill(spark, args.raw, args.base, args.back, args.database, args.layout)
    elif args.job == "history":
        found = plans.compare_runs(plans.read_history(spark, args.base))
        for row in found.orderBy("stage", "dt_ptcm", "started").toLocalIterator():
            print(*row, sep="\t")
    elif args.job == "land":
        print(*plans.ingest_landed(spark, args.raw, args.out, args.max_files_per_lot))
    else:
        streaming.ingest_new_files(
            spark, args.raw, args.out, args.checkpoint, args.max_files_per_batch
        )


if __name__ == "__main__":
    main()
