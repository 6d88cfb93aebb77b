"""DataFrame -> DataFrame operators: rollups, keyed aggregates, nesting, key checks."""

from docroll.operators.combine import combine_by_key
from docroll.operators.joins import (
    check_orphans,
    first_per_key,
    key_match_counts,
    orphans,
)
from docroll.operators.key_filter import (
    filtered_join,
    filtered_order_rollup,
    filtered_orphans,
    key_filter,
    may_match,
)
from docroll.operators.keyed import (
    combine_mean,
    count_by,
    global_int_mean,
    keyed_last_doubled,
    keyed_sum,
    row_count,
)
from docroll.operators.nest import Child, group_documents, list_total, nest
from docroll.operators.ordered import fold_by_key, running_fold, with_positions, write_sorted
from docroll.operators.rollup_state import add_to_order_state, kept_order_rollup
from docroll.operators.rollups import bucket_counts, customer_rollup, order_rollup, sorted_head

__all__ = [
    "Child",
    "add_to_order_state",
    "bucket_counts",
    "check_orphans",
    "combine_by_key",
    "combine_mean",
    "count_by",
    "customer_rollup",
    "filtered_join",
    "filtered_order_rollup",
    "filtered_orphans",
    "first_per_key",
    "fold_by_key",
    "global_int_mean",
    "group_documents",
    "kept_order_rollup",
    "key_filter",
    "key_match_counts",
    "keyed_last_doubled",
    "keyed_sum",
    "list_total",
    "may_match",
    "nest",
    "order_rollup",
    "orphans",
    "row_count",
    "running_fold",
    "sorted_head",
    "with_positions",
    "write_sorted",
]
