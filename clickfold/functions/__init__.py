"""Scalar Column functions (JVM-side builtins only, no Python UDFs)."""

from clickfold.functions.arith import clip_probability, complement, guarded_ratio, log_loss_term
from clickfold.functions.categories import (
    category_levels,
    leaf_category,
    parse_categories,
    predicted_categories,
    predicted_rank,
    shared_category_count,
    unpredicted_category_count,
)
from clickfold.functions.digamma import digamma
from clickfold.functions.timefmt import epoch_to_local, hour_of_day, timestamp_text

__all__ = [
    "category_levels", "leaf_category", "parse_categories", "predicted_categories",
    "predicted_rank", "shared_category_count", "unpredicted_category_count",
    "clip_probability", "complement", "guarded_ratio", "log_loss_term", "digamma",
    "epoch_to_local", "hour_of_day", "timestamp_text",
]
