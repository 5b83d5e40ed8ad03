"""Feature-table assembly (J5, M1 inputs): parse -> folds -> label-day
features -> history features, all folds at once.

``fold_id`` is part of every key, so the six folds are one Spark plan with
23 history aggregates and 7 label-day stats tables in total, instead of the
reference's per-fold repetition.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from clickfold.functions.categories import parse_categories
from clickfold.operators.folds import (
    Fold,
    Panes,
    assign_folds,
    combine_logs,
    history_panes,
    reference_folds,
)
from clickfold.operators.attach import attach_tables
from clickfold.operators.history import all_history_columns, history_aggregates, merge_history
from clickfold.operators.label import (
    finish_label_features,
    label_features,
    label_stats_tables,
    long_label_folds,
)
from clickfold.session import cut_lineage, write_table
from clickfold.sources.log import derived_log, mark_score_log

# The derived log's calendar (FIXTURES.md section 2): label
# days 20-24 of January 2024, scoring log from day 25 on, training log before it.
DERIVED_YEAR, DERIVED_MONTH = 2024, 1
SCORE_START = dt.datetime(2024, 1, 25)
# Earliest history day of the reference folds (train4: [18, 20)).
LOG_START = dt.datetime(2024, 1, 18)


@dataclass
class Prepared:
    log: DataFrame          # both logs, with log_source
    labels: DataFrame
    history: DataFrame      # a copy of a row per fold
    panes: Panes            # the same history without copies
    folds: list[Fold]


def materialize(df: DataFrame, how: str | None) -> DataFrame:
    """``persist`` (memory, spilling to disk), ``checkpoint`` (reliable, in
    the shared checkpoint folder; cuts lineage) or ``None`` (recompute)."""
    if how == "persist":
        return df.persist(StorageLevel.MEMORY_AND_DISK)
    if how == "checkpoint":
        return cut_lineage(df)
    return df


def prepare_log(log: DataFrame, folds: list[Fold] | None = None, materialize_as: str | None = None,
                history_materialize_as: str | None = None) -> Prepared:
    """Parse a log with ``log_source`` (P2-P9) and tag fold roles.

    ``materialize_as`` applies to the label rows, which the assembly reads
    three times (stats pass, hourly table, final join).  The history rows
    are read once by the one-pass aggregate, so by default they are not
    materialised.
    """
    folds = folds or reference_folds()
    log = parse_categories(log)
    labels, history = assign_folds(log, folds)
    return Prepared(log, materialize(labels, materialize_as),
                    materialize(history, history_materialize_as), history_panes(log, folds), folds)


def prepare_logs(train_log: DataFrame, score_log: DataFrame | None,
                 folds: list[Fold] | None = None, materialize_as: str | None = None,
                 history_materialize_as: str | None = None) -> Prepared:
    """``prepare_log`` for a training and a scoring log of their own."""
    return prepare_log(combine_logs(train_log, score_log), folds, materialize_as,
                       history_materialize_as)


def prepare_derived(spark: SparkSession, sf_dir: str, grain: str = "hour",
                    materialize_as: str | None = None,
                    history_materialize_as: str | None = None,
                    only: tuple[int, ...] | None = None) -> Prepared:
    """The derived log over the driver tables, cut into the reference folds
    (or ``only`` some of them: the others are never built)."""
    log = derived_log(spark, sf_dir, grain=grain, since=LOG_START)
    folds = [f for f in reference_folds(DERIVED_YEAR, DERIVED_MONTH) if only is None or f.fold_id in only]
    return prepare_log(mark_score_log(log, SCORE_START), folds, materialize_as, history_materialize_as)


def build_features(prep: Prepared, compat: bool = False, extras: bool = False,
                   one_pass: bool = True) -> DataFrame:
    """Label rows + 38 label-day columns + 92 history columns (133 engineered
    in all with the 3 parse columns).  History columns stay NULL for keys
    unseen in the fold's history; they are never filled here."""
    spans = long_label_folds(prep.folds)
    if one_pass:    # all tables of both families meet the label rows together
        # Written once: three passes read it, each without joining the log's dimensions again.
        labels = write_table(prep.labels, name="labels")
        tables = label_stats_tables(labels, extras, spans=spans) + list(history_aggregates(prep.panes).values())
        out = finish_label_features(attach_tables(labels, tables), labels, compat, extras)
    else:
        lab = label_features(prep.labels, compat=compat, extras=extras, one_pass=False,
                             spans=spans)
        out = merge_history(lab, prep.panes, one_pass=False)
    return out.select(*feature_table_columns(prep, extras))


def feature_table_columns(prep: Prepared, extras: bool = False) -> list[str]:
    from clickfold.operators.label import label_feature_columns
    return list(prep.labels.columns) + label_feature_columns(extras) + all_history_columns()
