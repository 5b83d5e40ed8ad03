"""End-to-end flow on native log files: read the training and scoring logs,
build the fold features, fit the conversion model on the training folds,
score the scoring fold and write ``instance_id predicted_score``.

    python -m clickfold.plans.run TRAIN_LOG SCORE_LOG OUT_DIR \\
        [--year 2018 --month 9 --label-days 23 22 21 20 --validate-day 24
         --history-days 2 --test-history-from 23 --tz Asia/Shanghai --rounds 700]
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickfold.operators.folds import Fold, sliding_folds
from clickfold.plans import model as M
from clickfold.plans.features import build_features, prepare_logs
from clickfold.session import configure, ensure_checkpoint_dir
from clickfold.sources.log import read_log
from clickfold.sources.sink import write_scores


def run_flow(spark: SparkSession, train: DataFrame, score: DataFrame, out_dir: str | None,
             folds: list[Fold], rounds: int = M.ROUNDS, model_dir: str | None = None) -> DataFrame:
    """Features for every fold, fit on the label folds, score the scoring fold.

    Returns the scores; writes them to ``out_dir`` (and the model to
    ``model_dir``) when given.
    """
    configure(spark)
    prep = prepare_logs(train, score, folds)
    feats = build_features(prep)
    test_ids = [f.fold_id for f in folds if f.label_source == "score"]
    cols = M.feature_columns(feats)
    model = M.fit_conversion_model(feats.where(~F.col("fold_id").isin(*test_ids)), cols,
                                   rounds=rounds)
    if model_dir:
        M.save_model(model, model_dir)
    scores = M.score(model, feats.where(F.col("fold_id").isin(*test_ids)), cols)
    if out_dir:
        write_scores(scores, out_dir)
    return scores


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("train_log")
    ap.add_argument("score_log")
    ap.add_argument("out_dir")
    ap.add_argument("--format", default="csv")
    ap.add_argument("--year", type=int, default=2018)
    ap.add_argument("--month", type=int, default=9)
    ap.add_argument("--label-days", type=int, nargs="+", default=[23, 22, 21, 20])
    ap.add_argument("--validate-day", type=int, default=24)
    ap.add_argument("--history-days", type=int, default=2)
    ap.add_argument("--test-history-from", type=int, default=23)
    ap.add_argument("--tz", default="UTC")
    ap.add_argument("--rounds", type=int, default=M.ROUNDS)
    ap.add_argument("--model-dir", default=None)
    a = ap.parse_args(argv)
    spark = SparkSession.builder.appName("clickfold").getOrCreate()
    ensure_checkpoint_dir(spark)
    train = read_log(spark, a.train_log, fmt=a.format, labelled=True, tz=a.tz)
    score = read_log(spark, a.score_log, fmt=a.format, labelled=False, tz=a.tz)
    folds = sliding_folds(dt.date(a.year, a.month, 1), a.label_days, a.history_days,
                          validate_day=a.validate_day, test_history_from=a.test_history_from)
    run_flow(spark, train, score, a.out_dir, folds, a.rounds, a.model_dir)


if __name__ == "__main__":
    main()
