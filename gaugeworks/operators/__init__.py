from gaugeworks.operators.deltas import counter_delta
from gaugeworks.operators.joins import asof_lookback, exclude, expand_dotted, first_match, names_at
from gaugeworks.operators.ranking import latest_date_per_group, latest_per_key, rank_within, topk_union

__all__ = [
    "asof_lookback",
    "counter_delta",
    "exclude",
    "expand_dotted",
    "first_match",
    "latest_date_per_group",
    "latest_per_key",
    "names_at",
    "rank_within",
    "topk_union",
]
