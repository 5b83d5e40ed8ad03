"""Relational operators of the feature engine."""

from clickfold.operators.folds import (
    Fold,
    Panes,
    assign_folds,
    combine_logs,
    history_panes,
    history_rows,
    label_rows,
    reference_folds,
    sliding_folds,
)
from clickfold.operators.attach import attach_tables
from clickfold.operators.history import (
    HISTORY_KEYS,
    attach_history,
    entity_history,
    history_aggregates,
    merge_history,
)
from clickfold.operators.joins import natural_left_join, stack_folds
from clickfold.operators.label import (
    average_rank,
    first_last_flags,
    hourly_counts,
    key_stats,
    keyed_counts,
    label_count,
    label_features,
    label_ratios,
    label_stats_tables,
    predicted_rank_counts,
)
from clickfold.operators.sampling import balanced_sample
from clickfold.operators.smoothing import fit_smoothing, rate_counts, smoothed_rate

__all__ = [
    "Fold", "Panes", "assign_folds", "combine_logs", "history_panes", "history_rows", "label_rows", "reference_folds",
    "sliding_folds", "HISTORY_KEYS", "attach_history", "entity_history", "merge_history",
    "natural_left_join", "stack_folds", "average_rank", "first_last_flags", "hourly_counts",
    "key_stats", "label_count", "label_features", "label_ratios", "predicted_rank_counts",
    "balanced_sample", "fit_smoothing", "rate_counts", "smoothed_rate", "attach_tables", "keyed_counts",
    "history_aggregates", "label_stats_tables",
]
