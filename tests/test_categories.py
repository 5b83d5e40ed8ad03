"""Golden table `categories` (FIXTURES.md section 3): P2-P9."""

from clickfold.functions.categories import parse_categories


def test_category_parsing(spark):
    df = spark.createDataFrame(
        [(1, "0;7;9", "9:x,y;7:z"), (2, "0;7", "9:x;7:z"), (3, "0;7", "-1"), (4, "0", "9:x")],
        "instance_id long, item_category_list string, predict_category_property string")
    out = {r["instance_id"]: r for r in parse_categories(df, with_shared=True).collect()}
    got = {k: (r["item_category_list_2"], r["predict_category_property_rank"],
               r["item_category_count"], r["item_category_common_count"])
           for k, r in out.items()}
    assert got == {
        1: ("9", 0, 1, 2),
        2: ("7", 1, 1, 1),
        3: ("7", -1, 2, 0),
        4: (None, None, 1, 0),   # the reference raises on a one-level path
    }


def test_duplicate_levels_counted_once(spark):
    df = spark.createDataFrame([("a;b;b", "x:1")], "item_category_list string, "
                               "predict_category_property string")
    r = parse_categories(df).first()
    assert r["item_category_count"] == 2
