"""History aggregation (H), guarded ratio and leak-freedom."""

from pyspark.sql import functions as F

from clickfold.functions.arith import guarded_ratio
from clickfold.operators.history import HISTORY_KEYS, attach_history, merge_history
from tests.conftest import SF_SMALL, rows


def test_history_join_golden(spark):
    hist = spark.createDataFrame([(1, 1), (1, 0), (2, 0)], "k long, is_trade int") \
        .withColumn("fold_id", F.lit(1))
    lab = spark.createDataFrame([(10, 1), (11, 2), (12, 3), (13, None)], "rid long, k long") \
        .withColumn("fold_id", F.lit(1))
    out = attach_history(lab, hist, ["k"], "k")
    assert rows(out, "rid", "k_count", "k_buy_count", "k_buy_ratio", "k_not_buy_count") == [
        (10, 2, 1, 0.5, 1), (11, 1, 0, 0.0, 1), (12, None, None, None, None),
        (13, None, None, None, None)]


def test_ratio_guard(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 0.0), (1.0, None)], "x double, y double")
    got = [r[0] for r in df.select(guarded_ratio("x", "y")).collect()]
    assert got == [0.5, -1.0, None]


def test_one_pass_equals_per_key(spark):
    from clickfold.plans.features import prepare_derived
    p = prepare_derived(spark, SF_SMALL)
    a = merge_history(p.labels, p.history, one_pass=True)
    b = merge_history(p.labels, p.history, one_pass=False)
    cols = ["fold_id", "instance_id"] + [f"{k}_{m}" for k, _ in HISTORY_KEYS
                                         for m in ("count", "buy_count", "buy_ratio")]
    assert rows(a, *cols) == rows(b, *cols)
    c = a.where(F.col("user_item_count") != F.col("user_item_buy_count")
                + F.col("user_item_not_buy_count"))
    assert c.count() == 0


def test_history_is_leak_free(spark):
    """Flipping labels of label rows must not change any history column."""
    from clickfold.plans.features import prepare_logs
    from clickfold.operators.folds import reference_folds
    from clickfold.sources.log import derived_log, split_train_score
    from clickfold.plans.features import SCORE_START
    import datetime as dt
    log = derived_log(spark, SF_SMALL)
    train, score = split_train_score(log, SCORE_START)
    folds = reference_folds()
    p1 = prepare_logs(train, score, folds)
    # Flip is_trade on day 23 (train1's label day) only.
    from clickfold.functions.timefmt import ntz_literal
    d23 = (F.col("context_timestamp") >= ntz_literal(dt.datetime(2024, 1, 23))) \
        & (F.col("context_timestamp") < ntz_literal(dt.datetime(2024, 1, 24)))
    flipped = train.withColumn("is_trade", F.when(d23, 1 - F.col("is_trade"))
                               .otherwise(F.col("is_trade")))
    p2 = prepare_logs(flipped, score, folds)
    keys = [(p, k) for p, k in HISTORY_KEYS if p in ("item", "user", "user_item", "shop")]
    a = merge_history(p1.labels.where("fold_id = 1"), p1.history, keys, one_pass=False)
    b = merge_history(p2.labels.where("fold_id = 1"), p2.history, keys, one_pass=False)
    cols = ["instance_id"] + [f"{p}_buy_count" for p, _ in keys]
    assert rows(a, *cols) == rows(b, *cols)
