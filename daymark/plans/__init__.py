from daymark.plans.backfill import (
    compare_dates,
    refine_dates,
    store_backfill,
    summarise_dates,
)
from daymark.plans.history import check_run, compare_runs, new_run, read_history, record_run
from daymark.plans.incremental import Update, update_results
from daymark.plans.jobs import (
    capture,
    extract,
    load,
    load_stored,
    run_latest,
    store_refined,
    store_results,
    transform,
)
from daymark.plans.landing import ingest_landed, read_landed
from daymark.plans.publish import comparison_results, publish, publish_stored, summary_results

__all__ = [
    "Update",
    "capture",
    "check_run",
    "compare_dates",
    "compare_runs",
    "comparison_results",
    "extract",
    "ingest_landed",
    "load",
    "load_stored",
    "new_run",
    "publish",
    "publish_stored",
    "read_history",
    "read_landed",
    "record_run",
    "refine_dates",
    "run_latest",
    "store_backfill",
    "store_refined",
    "store_results",
    "summarise_dates",
    "summary_results",
    "transform",
    "update_results",
]
