from spindlewatch.operators.distribution import distribution_stats, global_stats
from spindlewatch.operators.latest import (
    failed_keys,
    flag_ever_failed,
    hot_keys,
    latest_instants,
    latest_rows,
    latest_rows_with_history,
)
from spindlewatch.operators.newest import merge_newest, read_newest, vacuum_newest
from spindlewatch.operators.ranking import count_by, distinct_by, sum_by, top_k
from spindlewatch.operators.sketches import (
    QUARTILES,
    combined,
    measured_rank_errors,
    percentile_name,
    sketched_stats,
    sketches,
)
from spindlewatch.operators.totals import add_to_totals, read_totals

__all__ = [
    "QUARTILES",
    "add_to_totals",
    "combined",
    "count_by",
    "distinct_by",
    "distribution_stats",
    "failed_keys",
    "flag_ever_failed",
    "global_stats",
    "hot_keys",
    "latest_instants",
    "latest_rows",
    "latest_rows_with_history",
    "measured_rank_errors",
    "merge_newest",
    "percentile_name",
    "read_newest",
    "read_totals",
    "sketched_stats",
    "sketches",
    "sum_by",
    "top_k",
    "vacuum_newest",
]
