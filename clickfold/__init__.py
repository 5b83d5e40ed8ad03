"""clickfold: a Spark-native impression-log feature and conversion engine.

Reads an ad-impression log, cuts it into label/history folds, builds count,
purchase, rate, rank and flag features per entity, fits and scores a
conversion model, and smooths conversion rates -- all as Spark DataFrame
plans.
"""

from clickfold.functions.categories import parse_categories
from clickfold.operators.folds import assign_folds, combine_logs, reference_folds, sliding_folds
from clickfold.operators.history import entity_history, merge_history
from clickfold.operators.joins import natural_left_join, stack_folds
from clickfold.operators.label import (
    average_rank,
    first_last_flags,
    hourly_counts,
    key_stats,
    label_count,
    label_features,
)
from clickfold.operators.sampling import balanced_sample
from clickfold.operators.smoothing import fit_smoothing, rate_counts, smoothed_rate
from clickfold.plans.features import build_features, prepare_log, prepare_logs
from clickfold.plans.model import (
    correlation_screen,
    fit_conversion_model,
    log_loss,
    score,
    screened_columns,
    validate,
)
from clickfold.session import configure
from clickfold.sources.log import read_log, write_log
from clickfold.sources.sink import write_scores

__version__ = "0.1.0"

__all__ = [
    "parse_categories", "assign_folds", "combine_logs", "reference_folds", "sliding_folds", "entity_history",
    "merge_history", "natural_left_join", "stack_folds", "average_rank", "first_last_flags",
    "hourly_counts", "key_stats", "label_count", "label_features", "balanced_sample",
    "fit_smoothing", "rate_counts", "smoothed_rate", "build_features", "prepare_log", "prepare_logs",
    "correlation_screen", "fit_conversion_model", "log_loss", "score", "screened_columns",
    "validate", "configure", "read_log", "write_log", "write_scores",
]
