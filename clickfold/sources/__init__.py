"""Sources and sinks: the impression log readers and the score writer."""

from clickfold.sources.log import (
    LOG_SCHEMA,
    SCORE_SCHEMA,
    derived_log,
    order_log,
    read_log,
    read_table,
    mark_score_log,
    split_train_score,
)
from clickfold.sources.sink import read_scores, write_scores

__all__ = [
    "LOG_SCHEMA", "SCORE_SCHEMA", "derived_log", "order_log", "read_log", "read_table",
    "mark_score_log", "split_train_score", "write_scores", "read_scores",
]
