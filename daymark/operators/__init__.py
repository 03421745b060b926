from daymark.operators.captures import latest_capture
from daymark.operators.columns import (
    apply_positional_schema,
    conform,
    preview,
    refine,
    rename_columns,
)
from daymark.operators.compare import (
    compare_all_dates,
    compare_date_pairs,
    compare_snapshots,
    date_pairs,
)
from daymark.operators.completeness import (
    capture_gaps,
    capture_report,
    latest_complete_capture,
    page_runs,
)
from daymark.operators.html import concat_pages, html_table_rows
from daymark.operators.metrics import observe_refined, quality_metrics
from daymark.operators.summarise import summarise

__all__ = [
    "apply_positional_schema",
    "capture_gaps",
    "capture_report",
    "compare_all_dates",
    "compare_date_pairs",
    "compare_snapshots",
    "concat_pages",
    "conform",
    "date_pairs",
    "html_table_rows",
    "latest_capture",
    "latest_complete_capture",
    "observe_refined",
    "page_runs",
    "preview",
    "quality_metrics",
    "refine",
    "rename_columns",
    "summarise",
]
