"""Model stage (M1-M6), log loss (golden `logloss`) and the smoother."""

import math

import pytest

from clickfold.functions.digamma import digamma
from clickfold.operators.smoothing import fit_smoothing, rate_counts, smoothed_rate
from clickfold.plans import model as M


def test_log_loss_golden(spark):
    a = spark.createDataFrame([(1, 1.0), (0, 0.0)], "is_trade int, predicted_score double")
    b = spark.createDataFrame([(1, 0.5), (0, 0.5)], "is_trade int, predicted_score double")
    la = M.log_loss(a).first()["log_loss"]
    lb = M.log_loss(b).first()["log_loss"]
    assert 0 < la < 1e-14
    assert lb == pytest.approx(0.693147, abs=1e-6)


def test_pearson_constant_column_is_null(spark):
    df = spark.createDataFrame([(1, 0, 1.0), (1, 1, 2.0), (1, 0, 3.0)],
                               "c int, is_trade int, x double")
    out = {r["feature"]: r["corr"] for r in M.correlation_screen(df, ["c", "x"]).collect()}
    assert out["c"] is None
    assert out["x"] == pytest.approx(0.0, abs=1e-9)


def _psi(x):
    """digamma by the recurrence to large arguments and the series there."""
    shift = 0.0
    while x < 60:
        shift += 1.0 / x
        x += 1.0
    return math.log(x) - 0.5 / x - 1 / (12 * x**2) + 1 / (120 * x**4) - 1 / (252 * x**6) - shift


def test_digamma_column(spark):
    xs = [0.01, 0.5, 1.0, 2.0, 10.0, 123.4]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in xs], "x double")
           .select(digamma("x")).collect()]
    assert got == pytest.approx([_psi(x) for x in xs], rel=1e-10, abs=1e-10)
    assert got[2] == pytest.approx(-0.5772156649015329, abs=1e-10)


def _counts(spark):
    data = [(i, 20 + i % 7, (i * 5) % 9) for i in range(200)]
    return spark.createDataFrame(data, "item_id long, imp long, clk long")


def test_smoothing_steps_follow_the_fixed_point(spark):
    a, b = 1.0, 1.0
    rows = [(20 + i % 7, (i * 5) % 9) for i in range(200)]
    for _ in range(30):
        d = sum(_psi(m + a + b) - _psi(a + b) for m, _ in rows)
        a, b = (a * sum(_psi(c + a) - _psi(a) for _, c in rows) / d,
                b * sum(_psi(m - c + b) - _psi(b) for m, c in rows) / d)
    fit = fit_smoothing(_counts(spark), 1.0, 1.0, 30, 1e-10)
    assert (fit.alpha, fit.beta) == pytest.approx((a, b), rel=1e-9)
    assert fit.steps == 30 and not fit.converged


def test_smoothing_without_entities(spark):
    fit = fit_smoothing(_counts(spark).where("1 = 0"), 2.0, 3.0, 5)
    assert (fit.alpha, fit.beta, fit.steps, fit.converged) == (2.0, 3.0, 0, False)


def test_smoothing_stop_rule_discards_last_step(spark):
    fit = fit_smoothing(_counts(spark), 1.0, 1.0, 100, epsilon=1e9)
    assert (fit.alpha, fit.beta, fit.steps, fit.converged) == (1.0, 1.0, 0, True)


def test_smoothed_rate(spark):
    from clickfold.operators.smoothing import SmoothingFit
    c = spark.createDataFrame([(1, 10, 3)], "item_id long, imp long, clk long")
    r = smoothed_rate(c, SmoothingFit(2.0, 6.0, 1, True)).first()["smoothed_rate"]
    assert r == pytest.approx(5.0 / 18.0)


def test_rate_counts(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (2, 0)], "k long, is_trade int")
    got = sorted((r["k"], r["imp"], r["clk"]) for r in rate_counts(df, ["k"]).collect())
    assert got == [(1, 2, 1), (2, 1, 0)]


def test_fit_and_score_small(spark):
    from clickfold.plans.catalog import feature_table
    from tests.conftest import SF_SMALL
    feats = feature_table(spark, SF_SMALL)
    cols = M.feature_columns(feats)
    assert "user_rank_down" not in cols and "instance_id" not in cols and "fold_id" not in cols
    model = M.fit_conversion_model(feats.where("fold_id < 6"), cols, rounds=5)
    scored = M.score(model, feats.where("fold_id = 6"), cols)
    vals = [r["predicted_score"] for r in scored.collect()]
    assert len(vals) == feats.where("fold_id = 6").count()
    assert all(0.0 <= v <= 1.0 and not math.isnan(v) for v in vals)


def test_fit_does_not_depend_on_the_cluster(spark):
    """Other shuffle partitions, another order of the rows: the same scores."""
    from tests.conftest import rows
    data = [(i, i % 7 < 3 and 1 or 0, float(i % 11), f"t{i % 5}", i % 3) for i in range(400)]
    df = spark.createDataFrame(data, "instance_id long, is_trade int, x double, t string, y int")
    old = spark.conf.get("spark.sql.shuffle.partitions")
    got = []
    try:
        for parts, frame in (("3", df.repartition(2)), ("11", df.orderBy("x", "t").repartition(7))):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            model = M.fit_conversion_model(frame, ["x", "t", "y"], rounds=4, min_child=2)
            got.append(rows(M.score(model, df, ["x", "t", "y"]), "instance_id", "predicted_score"))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert [i for i, _ in got[0]] == [i for i, _ in got[1]]
    assert [p for _, p in got[0]] == pytest.approx([p for _, p in got[1]], abs=1e-9)


def test_validate_returns_log_loss(spark):
    from clickfold.plans.catalog import feature_table
    from tests.conftest import SF_SMALL
    feats = feature_table(spark, SF_SMALL)
    r = M.validate(feats, (1, 2, 3, 4), 5, rounds=3).first()
    assert r["n"] == feats.where("fold_id = 5").count()
    assert 0.0 < r["log_loss"] < 5.0


def test_screened_columns_drop_strong_negative(spark):
    df = spark.createDataFrame([(y, 1.0 - y, float(i % 3), i) for i, y in
                                enumerate([0, 1, 0, 1, 1, 0, 0, 1])],
                               "is_trade int, neg double, noise double, instance_id long")
    cols = M.screened_columns(df, ["neg", "noise"])
    assert cols == ["noise"]


def test_saved_model_scores_like_the_fitted_one(spark):
    import tempfile
    from clickfold.plans.catalog import feature_table
    from tests.conftest import SF_SMALL, rows
    feats = feature_table(spark, SF_SMALL)
    cols = M.feature_columns(feats)
    model = M.fit_conversion_model(feats.where("fold_id < 6"), cols, rounds=3)
    path = tempfile.mkdtemp(prefix="clickfold-model-") + "/m"
    M.save_model(model, path)
    test = feats.where("fold_id = 6")
    a = rows(M.score(model, test, cols), "instance_id", "predicted_score")
    b = rows(M.score(M.load_model(path), test, cols), "instance_id", "predicted_score")
    assert a == b


def test_text_columns_are_numbers_or_codes(spark):
    df = spark.createDataFrame([("12", 1), ("a1", 2), (None, 3), ("a1", 4), ("1.5", 5)], "c string, n long")
    got = M.model_matrix(df, ["c", "n"], keep=()).orderBy("n").collect()
    assert [r["c"] for r in got] == [12.0, None, None, None, 1.5]
    codes = [r["c_code"] for r in got]
    assert codes[0] is codes[2] is codes[4] is None and codes[1] == codes[3] >= 0
    assert [r["n"] for r in got] == [1.0, 2.0, 3.0, 4.0, 5.0]


def test_registered_model_queries_fit_all_rounds():
    import inspect
    from clickfold.plans import catalog
    for name in ("train_and_score", "validate"):
        assert inspect.signature(catalog.queries()[name]).parameters["rounds"].default == M.ROUNDS == 700


def test_validate_gives_the_base_rates_loss(spark):
    data = [(i, fold, int(i % 4 == 0), float(i % 4)) for fold in (1, 2) for i in range(80)]
    feats = spark.createDataFrame(data, "instance_id long, fold_id int, is_trade int, x double")
    r = M.validate(feats, (1,), 2, rounds=10, min_child=2, subsample=1.0, colsample=1.0).first()
    assert r["n"] == 80
    assert r["base_log_loss"] == pytest.approx(-(0.25 * math.log(0.25) + 0.75 * math.log(0.75)))
    assert r["log_loss"] < r["base_log_loss"]


def test_one_pass_correlation_equals_numpy(spark):
    """Missing values on either side, large ids, constants, several tasks."""
    import random

    import numpy as np
    r = random.Random(2)
    data = []
    for i in range(3000):
        y = None if i % 17 == 0 else r.randrange(2)
        data.append((y, r.gauss(0, 1) + (y or 0), None if r.random() < 0.4 else 2.0**25 + r.randrange(9),
                     5, None, r.randrange(3) + 1e9 * (y or 0)))
    df = spark.createDataFrame(data, "is_trade int, a double, b double, c int, d double, e double").repartition(5)
    got = {x["feature"]: x["corr"] for x in M.correlation_screen(df, ["a", "b", "c", "d", "e"]).collect()}
    for j, name in ((1, "a"), (2, "b"), (5, "e")):
        pairs = [(x[0], x[j]) for x in data if x[0] is not None and x[j] is not None]
        y, x = np.array(pairs).T
        assert got[name] == pytest.approx(np.corrcoef(x, y)[0, 1], abs=2e-6)
    assert got["c"] is None and got["d"] is None
    assert M.correlation_screen(df.where("1 = 0"), ["a"]).first()["corr"] is None


def test_validate_takes_no_job_per_level(spark):
    """Above 65,536 rows ``validate`` took five jobs a round."""
    from clickfold.plans import model as M

    rows = spark.range(0, 72_000, 1, 4).selectExpr(
        "id AS instance_id", "CAST(1 + id % 5 AS int) AS fold_id", "CAST(xxhash64(id) % 3 = 0 AS int) AS is_trade",
        "CAST(id % 11 AS double) AS a", "CAST(id % 7 AS double) AS b")
    rows = rows.unionAll(rows.where("fold_id < 5"))
    sc = spark.sparkContext
    sc.setJobGroup("validate", "validate")
    try:
        found = M.validate(rows, (1, 2, 3, 4), 5, rounds=8)
        jobs = len(sc.statusTracker().getJobIdsForGroup("validate"))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert 0 < jobs < 16 and found.first()["n"] == 14_400
