"""Fold construction (W1, F1, F2): an event-time sliding window done once.

A fold is (label range, history range).  Each range is half open,
``[start, end)``; a missing end is open ended (F2).  The folds are a handful
of parameters, so their conditions are an inline array per log row: the log
is read once per role, with no join and no shuffle.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickfold.functions.timefmt import ntz_literal

TS = "context_timestamp"


@dataclass(frozen=True)
class Fold:
    fold_id: int
    name: str
    label_source: str
    label_start: dt.datetime | None
    label_end: dt.datetime | None
    hist_start: dt.datetime | None
    hist_end: dt.datetime | None


def sliding_folds(base: dt.date, label_days: list[int], history_days: int = 2,
                  validate_day: int | None = None, test_history_from: int | None = None,
                  first_id: int = 1) -> list[Fold]:
    """Folds of one label day each with the ``history_days`` before it.

    ``label_days`` become train folds in the given order; ``validate_day``
    adds an open-ended label fold (``>= day``); ``test_history_from`` adds the
    scoring fold, whose label rows are the whole scoring log and whose
    history is the training log from that day on.
    """
    def day(d: int) -> dt.datetime:
        return dt.datetime(base.year, base.month, 1) + dt.timedelta(days=d - 1)

    folds: list[Fold] = []
    fid = first_id
    for d in label_days:
        folds.append(Fold(fid, f"train{fid - first_id + 1}", "train", day(d), day(d + 1),
                          day(d - history_days), day(d)))
        fid += 1
    if validate_day is not None:
        folds.append(Fold(fid, f"train{fid - first_id + 1}", "train", day(validate_day), None,
                          day(validate_day - history_days), day(validate_day)))
        fid += 1
    if test_history_from is not None:
        folds.append(Fold(fid, "test", "score", None, None, day(test_history_from), None))
    return folds


def reference_folds(year: int = 2024, month: int = 1) -> list[Fold]:
    """The reference's six folds: label days 23, 22, 21, 20 (train1-4), an
    open-ended day 24 (validate, stacked as train5), and the scoring log with
    history from day 23 on (test)."""
    return sliding_folds(dt.date(year, month, 1), [23, 22, 21, 20], history_days=2,
                         validate_day=24, test_history_from=23)


def _in_range(ts, start: dt.datetime | None, end: dt.datetime | None):
    cond = ts.isNotNull()
    if start is not None:
        cond = cond & (ts >= ntz_literal(start))
    if end is not None:
        cond = cond & (ts < ntz_literal(end))
    return cond


def _on_days(log: DataFrame, ranges: list[tuple[str, dt.datetime | None, dt.datetime | None]]) -> DataFrame:
    """The folders of a landed log (``sources.log.land_log``) that some
    ``(source, start, end)`` needs; any other log stays as it is.  The
    condition is on partition columns alone, so other folders are not listed."""
    if not {"log_source", "log_day"} <= set(log.columns):
        return log
    some = F.lit(False)
    for source, start, end in ranges:
        here = F.col("log_source") == source
        if start is not None:
            here = here & (F.col("log_day") >= F.lit(start.date()))
        if end is not None:
            here = here & (F.col("log_day") <= F.lit((end - dt.timedelta(microseconds=1)).date()))
        some = some | here
    return log.where(some).drop("log_day")


def _tag(log: DataFrame, roles: list[tuple[int, Column]]) -> DataFrame:
    """One row per role that a log row plays, with its ``fold_id`` in front.

    The roles are an inline array of a few conditions, so the log is read
    once, without a join.  Their union is a plain filter first, so that its
    bounds can reach the scan."""
    if not roles:
        return log.where("false").select(F.lit(0).alias("fold_id"), "*")
    some = roles[0][1]
    for _, cond in roles[1:]:
        some = some | cond
    ids = F.filter(F.array(*[F.when(cond, F.lit(fid)) for fid, cond in roles]),
                   lambda x: x.isNotNull())
    return log.where(some).select(F.explode(ids).alias("fold_id"), *log.columns)


def combine_logs(train_log: DataFrame, score_log: DataFrame | None) -> DataFrame:
    """Both logs as one, with ``log_source`` ('train' or 'score'); scoring
    rows have a NULL label."""
    out = train_log.withColumn("log_source", F.lit("train"))
    if score_log is None:
        return out
    if "is_trade" not in score_log.columns:
        score_log = score_log.withColumn("is_trade", F.lit(None).cast("int"))
    return out.unionByName(score_log.withColumn("log_source", F.lit("score")),
                           allowMissingColumns=True)


def label_rows(log: DataFrame, folds: list[Fold]) -> DataFrame:
    """Label role: every (fold_id, log row) whose time is in the label range
    of a fold with the row's source."""
    log = _on_days(log, [(f.label_source, f.label_start, f.label_end) for f in folds])
    ts, source = F.col(TS), F.col("log_source")
    roles = [(f.fold_id, (source == f.label_source) & _in_range(ts, f.label_start, f.label_end))
             for f in folds]
    return _tag(log, roles).drop("log_source")


def history_rows(log: DataFrame, folds: list[Fold]) -> DataFrame:
    """History role: every (fold_id, training-log row) in the history range.

    A row plays at most ``history_days`` history roles, so the tagged table
    is a bounded multiple of the input.
    """
    log = _on_days(log, [("train", f.hist_start, f.hist_end) for f in folds])
    train = log.where(F.col("log_source") == "train")
    roles = [(f.fold_id, _in_range(F.col(TS), f.hist_start, f.hist_end)) for f in folds]
    return _tag(train, roles).drop("log_source")


@dataclass(frozen=True)
class Panes:
    """History role without copies: training-log rows, each once, with the
    ``pane`` its time falls in.  A pane is a stretch of time between two
    neighbouring range limits, so every fold's history is a sum of panes."""
    df: DataFrame
    folds: dict[int, list[int]]     # fold_id: its panes

    @property
    def count(self) -> int:
        return 1 + max((k for own in self.folds.values() for k in own), default=-1)


def history_panes(log: DataFrame, folds: list[Fold]) -> Panes:
    """Cut the training log at all limits of the folds' history ranges."""
    log = _on_days(log, [("train", f.hist_start, f.hist_end) for f in folds])
    first, last = dt.datetime.min, dt.datetime.max
    ranges = {f.fold_id: (f.hist_start or first, f.hist_end or last) for f in folds}
    limits = sorted({t for r in ranges.values() for t in r})
    cuts = list(zip(limits, limits[1:]))
    used = [c for c in cuts if any(a <= c[0] and c[1] <= b for a, b in ranges.values())]
    ts, pane, some = F.col(TS), F.lit(None).cast("int"), F.lit(False)
    for k, (a, b) in enumerate(used):
        inside = _in_range(ts, None if a == first else a, None if b == last else b)
        pane, some = F.when(inside, F.lit(k)).otherwise(pane), some | inside
    df = log.where((F.col("log_source") == "train") & some).drop("log_source")
    return Panes(df.withColumn("pane", pane),
                 {i: [k for k, c in enumerate(used) if a <= c[0] and c[1] <= b]
                  for i, (a, b) in ranges.items()})


def assign_folds(log: DataFrame, folds: list[Fold] | None = None) -> tuple[DataFrame, DataFrame]:
    """Both roles of a log with ``log_source`` (``combine_logs``): ``(labels,
    history)``."""
    folds = folds or reference_folds()
    return label_rows(log, folds), history_rows(log, folds)
