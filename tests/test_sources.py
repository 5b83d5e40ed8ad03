"""Sources and sinks: native space-separated log (S1/S2, P1) and scores (S3)."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from clickfold.sources.log import read_log
from clickfold.sources.sink import read_scores, write_scores
from tests.conftest import rows

HEADER = ("instance_id item_id item_category_list item_property_list item_brand_id item_city_id "
          "item_price_level item_sales_level item_collected_level item_pv_level user_id "
          "user_gender_id user_age_level user_occupation_id user_star_level context_id "
          "context_timestamp context_page_id predict_category_property shop_id "
          "shop_review_num_level shop_review_positive_rate shop_star_level shop_score_service "
          "shop_score_delivery shop_score_description is_trade")


VALUES = dict(zip(HEADER.split(), ["11", "22", "1;2", "3;4", "33", "44", "3", "3", "5", "7", "55", "0",
                                   "1", "2", "3", "66", "1537632000", "4", "2:-1;5:6", "77", "4",
                                   "0.5", "5", "0.25", "0.75", "1.0", "0"]))


def _file(names, rows=(VALUES,), folder=None):
    folder = folder or tempfile.mkdtemp(prefix="clickfold-test-")
    path = os.path.join(folder, f"log-{len(os.listdir(folder))}.txt")
    with open(path, "w") as fh:
        fh.write(" ".join(names) + "\n")
        for r in rows:
            fh.write(" ".join(r[n] for n in names) + "\n")
    return path


def test_read_native_log_with_zone(spark):
    path = _file(HEADER.split())
    utc = read_log(spark, path, tz="UTC")
    bj = read_log(spark, path, tz="Asia/Shanghai")
    ts_utc = utc.select(F.date_format("context_timestamp", "yyyy-MM-dd HH:mm:ss")).first()[0]
    ts_bj = bj.select(F.date_format("context_timestamp", "yyyy-MM-dd HH:mm:ss")).first()[0]
    assert ts_utc == "2018-09-22 16:00:00"
    assert ts_bj == "2018-09-23 00:00:00"
    r = utc.first()
    assert r["instance_id"] == 11 and r["is_trade"] == 0 and r["shop_review_num_level"] == 4


def test_columns_are_bound_by_the_header(spark):
    names = sorted(HEADER.split(), reverse=True)
    r = read_log(spark, _file(names)).first().asDict()
    assert r["instance_id"] == 11 and r["item_id"] == 22 and r["shop_id"] == 77
    assert r["shop_score_service"] == 0.25


def test_more_and_fewer_columns(spark):
    """Unknown columns are carried as text; optional ones may be missing."""
    names = ["note", *[n for n in HEADER.split() if n != "item_price_level"]]
    df = read_log(spark, _file(names, [{**VALUES, "note": "0012"}]))
    assert df.columns == names and df.first()["note"] == "0012"
    with pytest.raises(ValueError, match="item_id"):
        read_log(spark, _file([n for n in HEADER.split() if n != "item_id"]))
    score = [n for n in HEADER.split() if n != "is_trade"]
    with pytest.raises(ValueError, match="is_trade"):
        read_log(spark, _file(score))
    assert "is_trade" not in read_log(spark, _file(score), labelled=False).columns


def test_files_with_other_headers_raise(spark):
    folder = tempfile.mkdtemp(prefix="clickfold-test-")
    _file(HEADER.split(), folder=folder)
    _file(sorted(HEADER.split()), folder=folder)
    with pytest.raises(Exception):
        read_log(spark, folder).collect()


def test_dimension_keys_negative_and_many(spark):
    """The derived log takes any item key: no cap, and keys as Spark's own %
    gives them."""
    import json
    from clickfold.sources.log import derived_log
    d = tempfile.mkdtemp(prefix="clickfold-dims-")
    keys = list(range(-15_000, 15_000))
    spark.createDataFrame([(i, "2024-01-20 10:00:00", 1, "view", json.dumps({"k": k}))
                           for i, k in enumerate(keys)],
                          "event_id long, ts string, user_id long, event_type string, props string") \
        .withColumn("ts", F.to_timestamp_ntz("ts")).write.parquet(f"{d}/events.parquet")
    spark.createDataFrame([(k, f"b{k}", "t", 2) for k in (-3, 7, 14_999)],
                          "p_partkey long, p_brand string, p_type string, p_size int") \
        .write.parquet(f"{d}/part.parquet")
    spark.createDataFrame([(-3, 5, 10.0), (7, 6, 20.0)],
                          "s_suppkey long, s_nationkey int, s_acctbal double") \
        .write.parquet(f"{d}/supplier.parquet")
    spark.createDataFrame([(1, "seg")], "c_custkey long, c_mktsegment string") \
        .write.parquet(f"{d}/customer.parquet")
    log = {r["item_id"]: r for r in derived_log(spark, d).collect()}
    assert len(log) == len(keys)
    assert log[-3]["item_city_id"] == 5 and log[-3]["item_brand_id"] == "b-3"
    assert log[-13]["item_city_id"] == 5 and log[7]["item_city_id"] == 6 == log[14_997]["item_city_id"]
    assert log[14_999]["item_brand_id"] == "b14999" and log[4]["item_city_id"] is None


def test_scores_round_trip_with_cr(spark):
    d = tempfile.mkdtemp(prefix="clickfold-test-")
    out = os.path.join(d, "ans")
    df = spark.createDataFrame([(1, 0.25), (2, 0.125)], "instance_id long, predicted_score double")
    write_scores(df, out)
    part = [f for f in os.listdir(out) if f.startswith("part-") and os.path.getsize(
        os.path.join(out, f)) > 0][0]
    raw = open(os.path.join(out, part), "rb").read()
    assert raw.startswith(b"instance_id predicted_score\r")
    assert b"\n" not in raw
    assert rows(read_scores(spark, out), "instance_id", "predicted_score") == [(1, 0.25), (2, 0.125)]


def test_landed_log_prunes_folders_of_other_days(spark, tmp_path):
    import datetime as dt

    from clickfold.operators.folds import assign_folds, history_panes, sliding_folds
    from clickfold.operators.folds import combine_logs as both
    from clickfold.sources.log import land_log, read_landed_log
    log = spark.range(40 * 24).selectExpr(
        "id AS instance_id", "timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, id) "
        "AS context_timestamp", "int(id % 2) AS is_trade")
    none = spark.createDataFrame([(-1, None, 1)], "instance_id long, context_timestamp timestamp_ntz, is_trade int")
    folds = sliding_folds(dt.date(2024, 1, 1), [9, 8], 2, test_history_from=30)
    plain = both(log.unionAll(none), log.where("instance_id > 700").drop("is_trade"))
    land_log(plain, str(tmp_path / "log"))
    landed = read_landed_log(spark, str(tmp_path / "log"))
    for a, b in zip(assign_folds(plain, folds), assign_folds(landed, folds)):
        assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.select(*a.columns).collect()))
    a, b = history_panes(plain, folds), history_panes(landed, folds)
    assert a.folds == b.folds and sorted(map(tuple, a.df.collect())) == sorted(map(tuple, b.df.select(*a.df.columns).collect()))
    labels = assign_folds(landed, folds[:2])[0]
    plan = labels._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "log_day" in plan[plan.index("PartitionFilters"):]
    days = {f.split("log_day=")[1].split("/")[0] for f in labels.select("instance_id", "context_timestamp").where("1=1")
            .selectExpr("input_file_name() AS f").distinct().toPandas()["f"]}
    assert days == {"2024-01-08", "2024-01-09"}
