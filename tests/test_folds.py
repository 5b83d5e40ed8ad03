"""Fold construction (W1, F1, F2) and golden `day_edges`."""

import datetime as dt

from pyspark.sql import functions as F

from clickfold.operators.folds import (
    Fold,
    assign_folds,
    combine_logs,
    reference_folds,
    sliding_folds,
)
from clickfold.plans.features import prepare_derived
from tests.conftest import SF_SMALL


def test_day_edges(spark):
    folds = reference_folds(2018, 9)
    log = spark.createDataFrame([(1, "2018-09-23 00:00:00", 0), (2, "2018-09-22 23:59:59", 1)],
                                "instance_id long, ts string, is_trade int") \
        .withColumn("context_timestamp", F.to_timestamp_ntz("ts"))
    labels, history = assign_folds(combine_logs(log, None), folds)
    lab = {(r["fold_id"], r["instance_id"]) for r in labels.collect()}
    his = {(r["fold_id"], r["instance_id"]) for r in history.collect()}
    assert (1, 1) in lab and (1, 1) not in his        # day 23 is train1's label day
    assert (1, 2) in his and (1, 2) not in lab        # 22 23:59:59 is in [21, 23)
    assert (2, 2) in lab                              # and in train2's label day


def test_fold_spec_shape():
    folds = sliding_folds(dt.date(2018, 9, 1), [23, 22], 2, validate_day=24, test_history_from=23)
    assert [f.name for f in folds] == ["train1", "train2", "train3", "test"]
    assert folds[2].label_end is None and folds[3].label_source == "score"


def test_no_history_row_reaches_its_label_day(spark):
    p = prepare_derived(spark, SF_SMALL)
    spec = {f.fold_id: f for f in p.folds}
    for r in p.history.groupBy("fold_id").agg(F.max("context_timestamp").alias("mx")).collect():
        f = spec[r["fold_id"]]
        if f.label_start is not None:
            assert r["mx"] < f.label_start


def test_fold_counts_sf0001(spark):
    p = prepare_derived(spark, SF_SMALL)
    # FIXTURES.md: day 23 rows and [21, 23) rows of the derived log at sf0.001.
    assert p.labels.where("fold_id = 1").count() == 25
    assert p.history.where("fold_id = 1").count() == 70
    assert p.labels.where("fold_id = 6").where(F.col("is_trade").isNotNull()).count() == 0


def test_whole_scoring_log_is_scored(spark):
    """The scoring fold is open-ended: every event from day 25 on is in it,
    and its hours are counted over several days."""
    from clickfold.functions.timefmt import hour_of_day
    from clickfold.operators.label import hourly_counts
    p = prepare_derived(spark, SF_SMALL)
    test = p.labels.where("fold_id = 6")
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    assert test.count() == ev.where("ts >= timestamp_ntz'2024-01-25 00:00:00'").count()
    assert test.select(F.to_date("context_timestamp")).distinct().count() > 1
    got = hourly_counts(test).select(hour_of_day("context_timestamp").alias("h"),
                                     "item_count_hour").distinct().collect()
    want = {r["h"]: r["n"] for r in test.groupBy(hour_of_day("context_timestamp").alias("h"))
            .agg(F.count("item_id").alias("n")).collect()}
    assert {r["h"]: r["item_count_hour"] for r in got} == want


def test_combined_logs_keep_their_columns(spark):
    a = spark.createDataFrame([(1, 5, 1)], "instance_id long, x int, is_trade int")
    b = spark.createDataFrame([(2, "z")], "instance_id long, y string")
    got = {r["instance_id"]: r.asDict() for r in combine_logs(a, b).collect()}
    assert got[1]["log_source"] == "train" and got[1]["y"] is None
    assert got[2]["log_source"] == "score" and got[2]["is_trade"] is None


def test_folds_do_not_depend_on_session_zone(spark):
    p = prepare_derived(spark, SF_SMALL)
    base = sorted((r["fold_id"], r["instance_id"]) for r in p.labels.collect())
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        q = prepare_derived(spark, SF_SMALL)
        assert sorted((r["fold_id"], r["instance_id"]) for r in q.labels.collect()) == base
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_panes_hold_each_history_row_once(spark):
    """Range limits cut the log; a fold is the sum of its panes."""
    from clickfold.operators.folds import combine_logs, history_panes, history_rows
    rows_ = [(i, dt.datetime(2018, 9, 1) + dt.timedelta(hours=7 * i), i % 2) for i in range(120)]
    log = spark.createDataFrame(rows_, "instance_id long, context_timestamp timestamp_ntz, is_trade int")
    log = combine_logs(log.unionAll(spark.createDataFrame([(999, None, 1)], log.schema)), None)
    folds = sliding_folds(dt.date(2018, 9, 1), [23, 22, 21], 2, validate_day=24, test_history_from=23)
    folds.append(Fold(9, "all", "train", None, None, None, None))
    panes = history_panes(log, folds)
    assert panes.df.groupBy("instance_id").count().where("count > 1").count() == 0
    assert [len(panes.folds[f.fold_id]) for f in folds][:3] == [2, 2, 2]
    want = {f: set() for f in panes.folds}
    for r in history_rows(log, folds).collect():
        want[r["fold_id"]].add(r["instance_id"])
    got = {r["instance_id"]: r["pane"] for r in panes.df.collect()}
    for f, own in panes.folds.items():
        assert {i for i, k in got.items() if k in own} == want[f], f


def test_pane_sums_equal_counts_per_fold(spark):
    from clickfold.operators.history import entity_history
    from clickfold.plans.features import prepare_derived
    from tests.conftest import SF_SMALL, rows
    p = prepare_derived(spark, SF_SMALL)
    for prefix, keys in (("user_item", ("user_id", "item_id")), ("shop", ("shop_id",))):
        a, b = (entity_history(h, keys, prefix) for h in (p.panes, p.history))
        assert sorted(a.columns) == sorted(b.columns)
        assert rows(a, *a.columns) == rows(b, *a.columns)
