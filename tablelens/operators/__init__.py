from . import (
    aggregate,
    anchored,
    calendar,
    classify,
    day_states,
    distinct_periods,
    incremental,
    joins,
    key_index,
    keyed,
    normalize,
    paging,
    quality,
    quantiles,
    rank_index,
    rule_tables,
    summary,
)

__all__ = [
    "aggregate",
    "anchored",
    "calendar",
    "classify",
    "day_states",
    "distinct_periods",
    "incremental",
    "joins",
    "key_index",
    "keyed",
    "normalize",
    "paging",
    "quality",
    "quantiles",
    "rank_index",
    "rule_tables",
    "summary",
]
