"""Impression-log sources (S1, S2) and the derived log over the driver tables.

The native log is space-separated text with a header row; its schema is
declared, never inferred.  ``context_timestamp`` arrives as epoch seconds and
is turned into a zone-less local wall clock (P1) with an explicit zone.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickfold.functions.timefmt import (
    epoch_to_local,
    ntz_literal,
    truncate_to_hour,
    truncate_to_second,
)

_FIELDS = [
    ("instance_id", T.LongType()),
    ("item_id", T.LongType()),
    ("item_category_list", T.StringType()),
    ("item_property_list", T.StringType()),
    ("item_brand_id", T.LongType()),
    ("item_city_id", T.LongType()),
    ("item_price_level", T.IntegerType()),
    ("item_sales_level", T.IntegerType()),
    ("item_collected_level", T.IntegerType()),
    ("item_pv_level", T.IntegerType()),
    ("user_id", T.LongType()),
    ("user_gender_id", T.IntegerType()),
    ("user_age_level", T.IntegerType()),
    ("user_occupation_id", T.IntegerType()),
    ("user_star_level", T.IntegerType()),
    ("context_id", T.LongType()),
    ("context_timestamp", T.LongType()),
    ("context_page_id", T.IntegerType()),
    ("predict_category_property", T.StringType()),
    ("shop_id", T.LongType()),
    ("shop_review_num_level", T.IntegerType()),
    ("shop_review_positive_rate", T.DoubleType()),
    ("shop_star_level", T.IntegerType()),
    ("shop_score_service", T.DoubleType()),
    ("shop_score_delivery", T.DoubleType()),
    ("shop_score_description", T.DoubleType()),
]

#: Schema of the scoring log (no label).
SCORE_SCHEMA = T.StructType([T.StructField(n, t, True) for n, t in _FIELDS])
#: Schema of the training log: scoring columns plus the 0/1 label.
LOG_SCHEMA = T.StructType(SCORE_SCHEMA.fields + [T.StructField("is_trade", T.IntegerType(), True)])


#: Columns the engine needs; the others are carried if they are there.
REQUIRED = ("instance_id", "item_id", "item_category_list", "user_id", "context_id",
            "context_timestamp", "predict_category_property", "shop_id")


def read_log(spark: SparkSession, path: str, fmt: str = "csv", labelled: bool = True,
             tz: str = "UTC", schema: T.StructType | None = None,
             required: tuple[str, ...] = REQUIRED) -> DataFrame:
    """Read a training (S1) or scoring (S2) log.

    ``fmt='csv'`` reads the native layout: one space as separator, header row.
    The header gives the columns and their order: known ones get their
    declared type, others stay text, and every file's header must be the
    same.  A missing required column raises.  ``context_timestamp`` becomes a
    ``timestamp_ntz`` wall clock in ``tz``.  Parquet files may already hold a
    timestamp; then it is kept as is.
    """
    schema = schema or (LOG_SCHEMA if labelled else SCORE_SCHEMA)
    if fmt == "csv":
        reader = spark.read.option("sep", " ").option("header", True)
        names = reader.csv(path).columns
        known = {f.name: f for f in schema.fields}
        read = T.StructType([known.get(n, T.StructField(n, T.StringType(), True)) for n in names])
        df = (reader.schema(read).option("enforceSchema", False).option("mode", "FAILFAST")
              .csv(path))
    else:
        df = spark.read.format(fmt).load(path)
    missing = [c for c in (*required, *(["is_trade"] if labelled else [])) if c not in df.columns]
    if missing:
        raise ValueError(f"the log lacks the columns {', '.join(missing)}")
    ts_type = df.schema["context_timestamp"].dataType
    if isinstance(ts_type, (T.LongType, T.IntegerType, T.DoubleType)):
        df = df.withColumn("context_timestamp", epoch_to_local("context_timestamp", tz))
    elif isinstance(ts_type, T.TimestampType):
        df = df.withColumn("context_timestamp", F.col("context_timestamp").cast("timestamp_ntz"))
    return df


def write_log(log: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write a log in the native layout: one space as separator, header row,
    ``context_timestamp`` as epoch seconds of its (UTC) wall clock."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    out = log.withColumn("context_timestamp",
                         F.timestamp_diff("SECOND", epoch, F.col("context_timestamp")))
    out.write.mode(mode).option("sep", " ").option("header", True).csv(path)


#: Partition columns of a landed log.
LOG_SOURCE, LOG_DAY = "log_source", "log_day"


def land_log(log: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Land a log (``combine_logs`` / ``mark_score_log``) as Parquet, one
    folder per source and day, so that folds read the folders of their days
    only.  Days become few files; a very large day is split adaptively, and
    rows without a time get a folder of their own."""
    out = log.withColumn(LOG_DAY, F.to_date("context_timestamp"))
    out.hint("rebalance", LOG_SOURCE, LOG_DAY).write.mode(mode).partitionBy(LOG_SOURCE, LOG_DAY).parquet(path)


def read_landed_log(spark: SparkSession, path: str) -> DataFrame:
    """A landed log; fold construction prunes it by ``log_day``."""
    return spark.read.parquet(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def derived_log(spark: SparkSession, sf_dir: str, grain: str = "hour",
                since: dt.datetime | None = None, until: dt.datetime | None = None) -> DataFrame:
    """Impression log with the reference's shape, derived from ``events``,
    ``part``, ``supplier`` and ``customer`` (FIXTURES.md section 2).

    ``since`` / ``until`` bound the raw ``events.ts`` (pushed to the Parquet
    scan) so that fold construction reads only the days it uses.

    The dimensions are left joins that the engine plans: it broadcasts the
    tables whose files are under its threshold; the others are sort-merge
    joins between plain exchanges, whose hot keys (few items or shops with
    very many events) adaptive execution splits.
    """
    ev = read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "props")
    if since is not None:
        ev = ev.where(F.col("ts") >= ntz_literal(since))
    if until is not None:
        ev = ev.where(F.col("ts") < ntz_literal(until))
    ev = ev.withColumn("k", F.get_json_object("props", "$.k").cast("long"))
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type", "p_size")
    supp = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey", "s_acctbal")
    cust = read_table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")

    ev = ev.withColumn("shop_key", F.col("k") % 10)
    j = (ev.join(part, ev.k == part.p_partkey, "left")
           .join(supp, F.col("shop_key") == supp.s_suppkey, "left")
           .join(cust, ev.user_id == cust.c_custkey, "left"))
    ts = truncate_to_hour("ts") if grain == "hour" else truncate_to_second("ts")
    brand, ptype = F.col("p_brand"), F.col("p_type")
    eid = F.col("event_id")
    category_path = F.concat(F.lit("root;"), ptype,
                             F.when(F.col("p_size") % 2 == 0, F.concat(F.lit(";"), brand))
                             .otherwise(F.lit("")))
    predicted = (F.when(eid % 3 == 0, F.concat(brand, F.lit(":1;"), ptype, F.lit(":2")))
                  .when(eid % 3 == 1, F.concat(F.lit("OTHER:3;"), ptype, F.lit(":1,2;"), brand,
                                               F.lit(":1")))
                  .otherwise(F.lit("-1")))
    return j.select(
        eid.alias("instance_id"),
        F.col("user_id"),
        F.col("k").alias("item_id"),
        F.col("shop_key").alias("shop_id"),
        ((eid * 7919) % 401).alias("context_id"),
        ts.alias("context_timestamp"),
        F.when(F.col("event_type") == "purchase", 1).otherwise(0).alias("is_trade"),
        brand.alias("item_brand_id"),
        F.col("s_nationkey").alias("item_city_id"),
        (F.col("user_id") % 3).alias("user_gender_id"),
        F.col("c_mktsegment").alias("user_occupation_id"),
        (eid % 20).alias("context_page_id"),
        F.floor(F.col("s_acctbal") / 1000).cast("int").alias("shop_review_num_level"),
        category_path.alias("item_category_list"),
        predicted.alias("predict_category_property"),
    )


def split_train_score(log: DataFrame, score_start: dt.datetime) -> tuple[DataFrame, DataFrame]:
    """Cut one labelled log into a training log (before ``score_start``) and
    a scoring log (from it on, label withheld)."""
    ts = F.col("context_timestamp")
    return (log.where(ts < ntz_literal(score_start)),
            log.where(ts >= ntz_literal(score_start)).drop("is_trade"))


def mark_score_log(log: DataFrame, score_start: dt.datetime) -> DataFrame:
    """One labelled log as both logs in one frame (one scan): ``log_source``
    is 'score', and the label NULL, from ``score_start`` on."""
    scored = F.col("context_timestamp") >= ntz_literal(score_start)
    return log.withColumns({
        "log_source": F.when(scored, F.lit("score")).otherwise(F.lit("train")),
        "is_trade": F.when(~scored, F.col("is_trade"))})


def order_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second log for the smoother and the benchmark: ``lineitem`` joined to
    ``orders`` (user = customer, item = part, shop = supplier, day grain,
    label = returned)."""
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag")
    od = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    j = li.join(od, li.l_orderkey == od.o_orderkey, "inner")
    return j.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("instance_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("l_partkey").alias("item_id"),
        F.col("l_suppkey").alias("shop_id"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("context_timestamp"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("is_trade"),
    )
