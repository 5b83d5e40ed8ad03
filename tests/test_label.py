"""Golden tables `rank_ties`, `flags`, `context_flags_compat` and label-day
counts (FIXTURES.md section 3)."""

import pytest
from pyspark.sql import functions as F

from clickfold.operators.label import (
    average_rank,
    first_last_flags,
    hourly_counts,
    label_count,
    label_features,
)
from tests.conftest import rows


def _frame(spark, data):
    df = spark.createDataFrame(data, "rid long, k long, ts string")
    return (df.withColumn("fold_id", F.lit(1))
              .withColumn("context_timestamp", F.to_timestamp_ntz("ts")))


def test_average_rank_ties(spark):
    df = _frame(spark, [(1, 1, "2024-01-01 00:00:01"), (2, 1, "2024-01-01 00:00:01"),
                        (3, 1, "2024-01-01 00:00:02"), (4, 1, "2024-01-01 00:00:03"),
                        (5, None, "2024-01-01 00:00:01")])
    out = average_rank(df, ["k"], "k")
    assert rows(out, "rid", "k_rank_up", "k_rank_down") == [
        (1, 1.5, 3.5), (2, 1.5, 3.5), (3, 3.0, 2.0), (4, 4.0, 1.0), (5, None, None)]


def test_rank_matches_pandas_on_random_ties(spark):
    import numpy as np
    import pandas as pd
    rng = np.random.default_rng(7)
    pdf = pd.DataFrame({"rid": range(300), "k": rng.integers(0, 5, 300),
                        "sec": rng.integers(0, 20, 300)})
    pdf["ts"] = pd.to_datetime("2024-01-01") + pd.to_timedelta(pdf.sec, unit="s")
    pdf["ts"] = pdf.ts.dt.strftime("%Y-%m-%d %H:%M:%S")
    exp_up = pdf.groupby("k")["ts"].rank(ascending=True)
    exp_down = pdf.groupby("k")["ts"].rank(ascending=False)
    df = _frame(spark, [(int(r.rid), int(r.k), r.ts) for r in pdf.itertuples()])
    got = {r["rid"]: (r["k_rank_up"], r["k_rank_down"])
           for r in average_rank(df, ["k"], "k").collect()}
    for rid in range(300):
        assert got[rid] == (exp_up[rid], exp_down[rid])


def test_first_last_flags(spark):
    data = [(1, 1, "2024-01-01 00:00:01"),                                    # single
            (2, 2, "2024-01-01 00:00:01"), (3, 2, "2024-01-01 00:00:02"),
            (4, 2, "2024-01-01 00:00:03"),                                    # a,b,c
            (5, 3, "2024-01-01 00:00:01"), (6, 3, "2024-01-01 00:00:01"),
            (7, 3, "2024-01-01 00:00:02"),                                    # a,a,b
            (8, 4, "2024-01-01 00:00:05"), (9, 4, "2024-01-01 00:00:05"),     # a,a
            (10, None, "2024-01-01 00:00:05")]                                # NULL key
    df = _frame(spark, data)
    out = first_last_flags(df, ["k"], "k")
    assert rows(out, "rid", "k_first", "k_last") == [
        (1, -1, -1), (2, 1, 0), (3, 0, 0), (4, 0, 1), (5, 1, 0), (6, 1, 0), (7, 0, 1),
        (8, 1, 1), (9, 1, 1), (10, 0, 0)]
    compat = first_last_flags(df, ["k"], "k", zero_last=True)
    assert {r["k_last"] for r in compat.collect()} == {0}


def test_label_count_counts_non_null_column(spark):
    df = spark.createDataFrame([(1, 1, 10), (2, 1, None), (3, 2, 7)],
                               "rid long, k long, v long").withColumn("fold_id", F.lit(1)) \
        .withColumn("context_timestamp", F.to_timestamp_ntz(F.lit("2024-01-01 00:00:00")))
    out = label_count(df, ["k"], "k_count_label", "v")
    assert rows(out, "rid", "k_count_label") == [(1, 1), (2, 1), (3, 1)]


def test_hourly_counts_ignore_date(spark):
    df = _frame(spark, [(1, 1, "2024-01-01 05:10:00"), (2, 2, "2024-01-02 05:20:00"),
                        (3, 3, "2024-01-01 06:00:00")])
    df = (df.withColumn("item_id", F.col("k")).withColumn("user_id", F.col("k"))
            .withColumn("shop_id", F.col("k")).withColumn("context_id", F.col("k"))
            .withColumn("context_page_id", F.col("k")).withColumn("item_brand_id", F.col("k")))
    out = hourly_counts(df)
    assert rows(out, "rid", "item_count_hour") == [(1, 2), (2, 2), (3, 1)]


def test_label_features_row_count_and_identities(spark):
    from clickfold.plans.features import prepare_derived
    from tests.conftest import SF_SMALL
    p = prepare_derived(spark, SF_SMALL)
    out = label_features(p.labels, one_pass=True)
    assert out.count() == p.labels.count()
    bad = out.where(
        (F.col("user_rank_up") + F.col("user_rank_down") != F.col("user_count_label") + 1)
        | (F.col("item_rank_up") + F.col("item_rank_down") != F.col("item_count_label") + 1))
    assert bad.count() == 0


def test_extras_match_stand_alone_operators(spark):
    from clickfold.operators.label import CATEGORY_RANK_KEY, predicted_rank_counts
    from clickfold.plans.features import prepare_derived
    from tests.conftest import SF_SMALL
    p = prepare_derived(spark, SF_SMALL)
    full = label_features(p.labels, extras=True, one_pass=True)
    pref, keys = CATEGORY_RANK_KEY
    alone = predicted_rank_counts(average_rank(p.labels, keys, pref))
    cols = ["fold_id", "instance_id", f"{pref}_rank_up", f"{pref}_rank_down",
            "user_predict_category", "item_predict_category"]
    assert rows(full, *cols) == rows(alone, *cols)
    measured = label_features(p.labels, one_pass=True)
    plain = label_features(p.labels, one_pass=False)
    assert rows(measured, *measured.columns) == rows(plain, *measured.columns)


def test_feature_table_compat_only_changes_context_last(spark):
    from clickfold.plans.catalog import feature_output_columns, feature_table
    from tests.conftest import SF_SMALL
    a = feature_table(spark, SF_SMALL)
    b = feature_table(spark, SF_SMALL, compat=True)
    assert {r[0] for r in b.select("context_last").distinct().collect()} == {0}
    cols = [c for c in feature_output_columns() if c != "context_last"]
    assert rows(a, *cols) == rows(b, *cols)


def test_hot_key_of_many_days_is_spread(spark):
    """A key with 10**6 seconds: right positions, one task per day at most."""
    import datetime as dt

    from clickfold.operators.label import key_stats
    n = 10**6
    df = spark.range(n).select(
        F.lit(1).alias("fold_id"), F.lit(7).alias("k"), F.col("id").alias("rid"),
        F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, 0, id)")
        .alias("context_timestamp"))
    old = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.enabled")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        st = key_stats(df, ["k"], "k", counted=("n_all", "rid"), flags=True)
        got = st.withColumn("p", F.spark_partition_id()).agg(
            F.countDistinct("p").alias("tasks"), F.count("*").alias("n"),
            F.sum((F.col("k_rank_up") + F.col("k_rank_down") != n + 1).cast("int")).alias("bad"),
            F.sum((F.col("k_rank_up") != F.timestamp_diff(
                "SECOND", F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz"), F.col("context_timestamp")) + 1)
                .cast("int")).alias("off"),
            F.sum("k_first").alias("first"), F.sum("k_last").alias("last"), F.min("n_all").alias("all")).first()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old[0])
        spark.conf.set("spark.sql.adaptive.enabled", old[1])
    assert (got["n"], got["bad"], got["off"], got["first"], got["last"], got["all"]) == (n, 0, 0, 1, 1, n)
    assert got["tasks"] > 4


def test_days_outside_long_folds_need_no_second_level(spark):
    import datetime as dt

    from clickfold.operators.folds import Fold, sliding_folds
    from clickfold.operators.label import long_label_folds
    folds = sliding_folds(dt.date(2018, 9, 1), [23, 22], 2, validate_day=24, test_history_from=23)
    folds.append(Fold(9, "two days", "train", dt.datetime(2018, 9, 1), dt.datetime(2018, 9, 3), None, None))
    df = spark.createDataFrame([(f.fold_id,) for f in folds], "fold_id int")
    assert sorted(r[0] for r in df.where(long_label_folds(folds)).collect()) == [3, 4, 9]


def test_hourly_distinct_sketches_merge_days(spark):
    """Sketches of days, made once, give each fold's distinct counts."""
    import datetime as dt

    from clickfold.operators.folds import assign_folds, combine_logs, sliding_folds
    from clickfold.operators.label import (
        SKETCH_ERROR,
        hourly_distinct_estimates,
        hourly_sketches,
        hourly_table,
    )
    folds = sliding_folds(dt.date(2024, 1, 1), [3, 2], 1, validate_day=4, test_history_from=3)
    log = spark.range(60_000).selectExpr(
        "id AS instance_id", "timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, id % 168) "
        "AS context_timestamp", "int(id % 2) AS is_trade", "id % 9000 AS item_id", "string(id % 70) AS s",
        "IF(id % 3 = 0, NULL, 1) AS few")
    both = combine_logs(log, log.where("instance_id % 2 = 0").drop("is_trade"))
    cols = [("a", "item_id"), ("b", "s"), ("c", "few")]
    labels, _ = assign_folds(both, folds)
    want = {(r["fold_id"], r["_hour"]): r for r in hourly_table(labels, cols, distinct=True).collect()}
    got = hourly_distinct_estimates(hourly_sketches(both, cols), folds, cols).collect()
    assert len(got) == len(want) == 24 * 3 + 12
    for r in got:
        w = want[r["fold_id"], r["_hour"]]
        for c in "abc":
            assert abs(r[c] - w[c]) <= SKETCH_ERROR * w[c], (r, w)
    half = sliding_folds(dt.date(2024, 1, 1), [3], 1)
    cut = [type(half[0])(1, "x", "train", dt.datetime(2024, 1, 3, 12), None, None, None)]
    with pytest.raises(ValueError):
        hourly_distinct_estimates(hourly_sketches(both, cols), cut, cols)
