from bancalyt.operators.aggregates import indicator_rates, pivot_columns, pivot_counts, share_of_total
from bancalyt.operators.joins import (
    exclude,
    hot_keys,
    preaggregate_join,
    salted_join,
    spread_join,
)
from bancalyt.operators.ordering import (
    neighbor_diff,
    rank_all,
    rank_within,
    sort_spec,
    top_k,
    top_n_per_group,
)
from bancalyt.operators.sketches import distinct_sketches, error_bound, estimated, merged_sketches

__all__ = [
    "distinct_sketches", "error_bound", "estimated", "exclude", "hot_keys", "indicator_rates", "merged_sketches",
    "neighbor_diff", "pivot_columns", "pivot_counts", "preaggregate_join", "rank_all", "rank_within", "salted_join",
    "share_of_total", "sort_spec", "spread_join", "top_k", "top_n_per_group",
]
