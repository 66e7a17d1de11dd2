from tripstrata.plans.bronze import bronze_frame, load_bronze
from tripstrata.plans.dashboard import dashboard
from tripstrata.plans.gold import (
    build_demand,
    build_durations,
    build_revenue,
    build_unified,
    merge_summary,
    replace_summary_months,
    replace_unified_months,
)
from tripstrata.plans.pipeline import (
    Layers,
    PipelineCounts,
    refresh_months,
    refresh_new_files,
    run_pipeline,
)
from tripstrata.plans.silver import (
    SilverCounts,
    build_silver,
    checked_frame,
    dedup_keys,
    rebuild_months,
    silver_report,
    with_duration,
)

__all__ = [
    "Layers",
    "PipelineCounts",
    "SilverCounts",
    "bronze_frame",
    "build_demand",
    "build_durations",
    "build_revenue",
    "build_silver",
    "build_unified",
    "checked_frame",
    "dashboard",
    "dedup_keys",
    "load_bronze",
    "rebuild_months",
    "refresh_months",
    "refresh_new_files",
    "merge_summary",
    "replace_summary_months",
    "replace_unified_months",
    "run_pipeline",
    "silver_report",
    "with_duration",
]
