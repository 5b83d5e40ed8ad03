"""Natural left join (J4), stacking (U1) and balanced sampling."""

from pyspark.sql import functions as F

from clickfold.operators.joins import natural_left_join, stack_folds
from clickfold.operators.sampling import balanced_sample
from tests.conftest import rows


def test_natural_join_null_never_matches(spark):
    left = spark.createDataFrame([(1, "a", 1), (2, "b", None), (3, "c", 3)],
                                 "g long, t string, z long")
    right = spark.createDataFrame([(1, "a", 10, 1), (2, "b", 20, None), (3, "c", 30, 4)],
                                  "g long, t string, w long, z long")
    out = natural_left_join(left, right)
    assert sorted(out.columns) == ["g", "t", "w", "z"]
    assert rows(out, "g", "w") == [(1, 10), (2, None), (3, None)]


def test_stack_by_name(spark):
    a = spark.createDataFrame([(1, 2)], "x long, y long")
    b = spark.createDataFrame([(4, 3)], "y long, x long")
    assert rows(stack_folds([a, b]), "x", "y") == [(1, 2), (3, 4)]


def test_balanced_sample_keeps_negatives_and_is_deterministic(spark):
    df = spark.range(2000).select(F.col("id").alias("instance_id"),
                                  (F.col("id") % 3 == 0).cast("int").alias("is_trade"))
    s1 = balanced_sample(df)
    s2 = balanced_sample(df)
    assert s1.where("is_trade = 0").count() == df.where("is_trade = 0").count()
    pos = s1.where("is_trade = 1").count()
    total_pos = df.where("is_trade = 1").count()
    assert 0.35 * total_pos < pos < 0.65 * total_pos
    assert rows(s1, "instance_id") == rows(s2, "instance_id")
