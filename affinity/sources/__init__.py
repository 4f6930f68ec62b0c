"""Readers. Every reader returns a typed DataFrame; malformed rows are dropped."""

from affinity.sources.readers import (
    SCORE_SCHEMA,
    key_bounds,
    key_predicates,
    read_baskets,
    read_features,
    read_pairs,
    read_ratings,
    read_scores,
    read_wide_scores,
)
from affinity.sources.tables import item_scores, load_table, scores_view

__all__ = [
    "SCORE_SCHEMA",
    "read_scores",
    "read_features",
    "read_pairs",
    "read_ratings",
    "read_wide_scores",
    "read_baskets",
    "key_predicates",
    "key_bounds",
    "load_table",
    "item_scores",
    "scores_view",
]
