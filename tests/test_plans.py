"""Plan properties: no Python UDF, no Cartesian product, one scan of the log
per role, filters reach the Parquet scan, joins without broadcasts."""

import pytest
from pyspark.sql import functions as F

from clickfold.plans import catalog
from tests.conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_feature_plan_has_no_udf_or_cartesian(spark):
    plan = _plan(catalog.q_feature_table(spark, SF_SMALL))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "PythonUDF"):
        assert bad not in plan


def _scans(plan: str, table: str) -> int:
    return len([x for x in plan.splitlines() if "FileScan" in x and f"{table}.parquet" in x])


@pytest.mark.parametrize("name", ["fold_labels", "rank_user", "fold_history"])
def test_log_is_read_once_without_a_nested_loop(spark, name):
    plan = _plan(catalog.queries()[name](spark, SF_SMALL))
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "PythonUDF" not in plan
    # rank_user joins the ranks of the label rows back to them, and adds the
    # totals of earlier days for the folds of several days.
    assert _scans(plan, "events") == (3 if name == "rank_user" else 1)
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts," in plan


def test_label_ratios_read_the_log_for_the_rows_only(spark):
    plan = _plan(catalog.queries()["label_ratios"](spark, SF_SMALL))
    assert _scans(plan, "events") == 1 and "NestedLoop" not in plan


def test_building_a_log_query_runs_no_job(spark):
    tracker = spark.sparkContext.statusTracker()
    before = len(tracker.getJobIdsForGroup(None))
    catalog.queries()["hist_user_shop"](spark, SF_SMALL)
    # Reading a Parquet file's schema is the only job allowed (one per table).
    assert len(tracker.getJobIdsForGroup(None)) - before <= 10


def test_rank_query_shuffles_preaggregated_rows(spark):
    plan = _plan(catalog.queries()["rank_user"](spark, SF_SMALL))
    window = plan[plan.index("Window"):]
    exchange = window.index("Exchange hashpartitioning")
    assert "HashAggregate" in window[:window.index("FileScan")]
    assert "partial_count" in window[exchange:]


@pytest.mark.parametrize("name", ["hist_user_gender", "label_ratios", "predicted_rank_counts"])
def test_large_table_joins_give_the_same_rows(spark, name):
    """Without broadcasts, as for tables of any size."""
    want = sorted(map(tuple, catalog.queries()[name](spark, SF_SMALL).collect()), key=repr)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        df = catalog.queries()[name](spark, SF_SMALL)
        got = sorted(map(tuple, df.collect()), key=repr)
        assert "SortMergeJoin" in _plan(df)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert got == want


def test_feature_table_without_broadcasts(spark):
    cols = catalog.feature_output_columns()
    want = sorted(map(tuple, catalog.q_feature_table(spark, SF_SMALL).select(*cols).collect()), key=repr)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        got = sorted(map(tuple, catalog.q_feature_table(spark, SF_SMALL).select(*cols).collect()), key=repr)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert got == want


def test_label_stats_pass_has_few_shuffles_for_all_keys(spark):
    from clickfold.operators.label import combined_label_stats, long_label_folds
    from clickfold.plans.features import prepare_derived
    p = prepare_derived(spark, SF_SMALL, materialize_as="checkpoint")   # isolate the pass
    stats, _ = combined_label_stats(p.labels, extras=True, spans=long_label_folds(p.folds))
    plan = stats._jdf.queryExecution().executedPlan().toString()
    # the partial aggregate's and the day window's shuffle of all rows, and for the
    # folds of several days the day totals' (aggregate, window, join): whatever the key count
    assert plan.count("Exchange hashpartitioning") <= 6, plan
    assert plan.count("Window") >= 2 and "Expand" in plan


def test_history_pass_is_one_aggregate(spark):
    from clickfold.operators.history import combined_history
    from clickfold.plans.features import prepare_derived
    p = prepare_derived(spark, SF_SMALL, history_materialize_as="checkpoint")
    agg, _ = combined_history(p.history)
    plan = agg._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1, plan
    assert "Expand" in plan


def test_large_sets_meet_the_label_rows_in_one_narrow_join(spark):
    """Without broadcasts: one join of short rows, and few shuffles of rows."""
    from clickfold.operators.attach import attach_tables
    from clickfold.operators.history import history_aggregates
    from clickfold.operators.label import label_stats_tables
    from clickfold.plans.features import prepare_derived
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        p = prepare_derived(spark, SF_SMALL)
        tables = label_stats_tables(p.labels) + list(history_aggregates(p.panes).values())
        assert len(tables) == 30
        plan = _plan(attach_tables(p.labels, tables))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert plan.count("SortMergeJoin") == 2
    # probes and stacked tables, gathered rows, and the label rows themselves
    assert plan.count("Exchange hashpartitioning") <= 5, plan


def test_narrow_join_equals_plain_joins(spark):
    from clickfold.operators.attach import Keyed, narrow_join
    rows = spark.createDataFrame([(1, "a:1", None, 5), (1, "a:1", None, 5), (2, None, "b", 6), (3, "a", ":1a", 7)],
                                 "k long, s string, t string, x int")
    one = spark.createDataFrame([("a:1", ":1", 1, 1.5), ("a", ":1a", 2, None)],
                                "s string, t string, n int, d double")
    two = spark.createDataFrame([(1, 2**40, True), (3, None, False), (9, 1, True)], "k long, m long, f boolean")
    tables = [Keyed(one.drop("t"), ["s"]), Keyed(two.select("k", "m"), ["k"]),
              Keyed(one.select("s", "t", one.n.alias("both")), ["s", "t"])]
    want = rows
    for t in tables:
        want = want.join(t.df, t.keys, "left")
    got = narrow_join(rows, tables).select(*want.columns)
    assert got.dtypes == want.dtypes
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def test_broadcast_tables_are_bounded_together(spark):
    """Tables that are small one by one but not all together: a query's
    broadcast tables lie in the driver at the same time."""
    from clickfold.operators.attach import BROADCAST_TOTAL, Keyed, attach_tables
    rows = spark.range(30).withColumn("s", (F.col("id") % 7).cast("string"))
    tables = [Keyed(spark.range(20).select("id", (F.col("id") * i).alias(f"v{i}")), ["id"], 20) for i in range(12)]
    tables.append(Keyed(spark.range(3).select(F.col("id").cast("string").alias("s"), F.lit(1).alias("w")), ["s"], 3))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "2k")
        found = attach_tables(rows, tables)
        assert 20 * 64 == tables[0].size < 2048 and 12 * tables[0].size > BROADCAST_TOTAL * 2048
        # 3 rows with a text and 6 tables stay plain joins, the other 6 meet in the narrow join.
        kept = [c for c in found.columns if c.startswith("v")][:6]
        assert len(kept) == 6 and len({"v6", "v7"} & set(kept)) == 2, found.columns
        got = sorted(map(tuple, found.select("id", "w", *[f"v{i}" for i in range(12)]).collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    want = [(i, 1 if i % 7 < 3 else None, *[i * k if i < 20 else None for k in range(12)]) for i in range(30)]
    assert got == want


def test_label_rows_join_the_dimensions_once(spark):
    """All passes of the assembly read the label rows from one written table."""
    from clickfold.plans.features import build_features, prepare_derived
    plan = _plan(build_features(prepare_derived(spark, SF_SMALL)))
    assert _scans(plan, "part") == _scans(plan, "customer") == 0
