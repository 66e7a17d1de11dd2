from tripstrata.operators.audit import expected_months, latest_month, loaded_months, missing_partitions
from tripstrata.operators.dedup import dedup_first, dedup_report
from tripstrata.operators.marts import (
    demand_parts,
    demand_patterns,
    duration_histogram,
    duration_parts,
    duration_sketches,
    duration_stats,
    merge_demand,
    merge_duration_sketches,
    merge_durations,
    merge_revenue,
    revenue,
    revenue_by_zone_hour,
    revenue_parts,
)
from tripstrata.operators.quality import (
    apply_rules,
    merge_rule_counters,
    route,
    rule_alerts,
    rule_counters,
    rule_report,
    split,
)
from tripstrata.operators.reports import (
    demand_by_hour,
    demand_by_hour_type,
    demand_by_zone,
    distinct_values,
    duration_summary,
    filter_types,
    label_zones,
    monthly_counts,
    pivot_hourly,
    profile,
    revenue_by_hour_type,
    revenue_by_type,
    top_zones,
    total_trips,
    trips_by_type,
)
from tripstrata.operators.unify import incomplete_sources, narrow, unify_trips

__all__ = [
    "apply_rules",
    "dedup_first",
    "dedup_report",
    "demand_by_hour",
    "demand_by_hour_type",
    "demand_by_zone",
    "demand_parts",
    "demand_patterns",
    "distinct_values",
    "duration_histogram",
    "duration_parts",
    "duration_sketches",
    "duration_stats",
    "duration_summary",
    "expected_months",
    "filter_types",
    "incomplete_sources",
    "label_zones",
    "latest_month",
    "loaded_months",
    "merge_demand",
    "merge_duration_sketches",
    "merge_durations",
    "merge_revenue",
    "merge_rule_counters",
    "missing_partitions",
    "monthly_counts",
    "narrow",
    "pivot_hourly",
    "profile",
    "revenue",
    "revenue_by_hour_type",
    "revenue_by_type",
    "revenue_by_zone_hour",
    "revenue_parts",
    "route",
    "rule_alerts",
    "rule_counters",
    "rule_report",
    "split",
    "top_zones",
    "total_trips",
    "trips_by_type",
    "unify_trips",
]
