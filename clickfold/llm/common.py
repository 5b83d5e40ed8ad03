"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
import shutil
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from clickfold.session import write_table

#: The white space that separates words: space and U+0009 to U+000D.
WHITE = " \t\n\x0b\x0c\r"


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Hand this package to the executors' Python workers (once per
    application), for clusters and sessions on which it is not installed."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    at = tempfile.mkdtemp(prefix="clickfold-zip-")
    sc.addPyFile(shutil.make_archive(f"{at}/clickfold", "zip", root, "clickfold"))
    _shipped.add(sc.applicationId)


_held: list[dict] = []


def hold_only(cache: dict | None = None) -> None:
    """Empty what other operators remember in this worker, which outlives
    tasks and stages; ``cache`` (or nothing) is remembered from now on."""
    for other in _held:
        if other is not cache:
            other.clear()
    _held[:] = [] if cache is None else [cache]


def strip_white(text: Column) -> Column:
    return F.trim(text, F.lit(WHITE))


def words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text as an array; NULL or blank: empty."""
    t = strip_white(F.coalesce(text, F.lit("")))
    return F.when(t == "", F.array().cast("array<string>")).otherwise(
        F.split(t, "[\\x20\\x09-\\x0D]+"))


def uniform_key(*cols: Column) -> Column:
    """A hash-random key below 2**60 that any engine with MD5 can repeat."""
    text = F.concat_ws("/", *[F.coalesce(c.cast("string"), F.lit("")) for c in cols])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def running_before(df: DataFrame, group: str, key: str, value: str, ties: list[str],
                   out: str) -> DataFrame:
    """Add ``out``: the sum of ``value`` over the rows of the same ``group``
    that come before in the order (``key``, ``ties``).

    ``key`` is uniform below 2**60, so equal slices of its range are the range
    partitions of a sort.  A group of n rows gets ceil(sqrt(n)) slices: their
    totals give the offset of each slice and a window orders the rows of one
    slice, so a group with a third of all rows is spread over many tasks.
    ``df`` should be a written table; it is read three times.
    """
    slices = write_table(df.groupBy(group).agg(
        F.ceil(F.sqrt(F.count(F.lit(1)).cast("double"))).cast("long").alias("_k")), name="slices")
    cut = df.join(slices, group).withColumn(
        "_b", F.shiftright(F.shiftright(F.col(key), 30) * F.col("_k"), 30)).drop("_k")
    totals = cut.groupBy(group, "_b").agg(F.sum(value).alias("_t"))
    w = Window.partitionBy(group).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(group, "_b", F.coalesce(F.sum("_t").over(w), F.lit(0)).alias("_o"))
    inside = (Window.partitionBy(group, "_b").orderBy(key, *ties)
              .rowsBetween(Window.unboundedPreceding, -1))
    return (cut.join(offsets, [group, "_b"])
            .withColumn(out, F.col("_o") + F.coalesce(F.sum(value).over(inside), F.lit(0)))
            .drop("_b", "_o"))


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components: ``(node, component)`` for every node of an edge
    list, where ``component`` is the smallest node id that can be reached.

    Rounds of contraction: each node points to its smallest neighbour,
    pointers are followed to their ends, the edges are renamed and thinned
    out, until none is left; each round at least halves the nodes that still
    have edges.  A round is a partial aggregate and joins between written
    tables (so that a node with very many edges can be split by adaptive
    execution); nothing is collected.
    """
    spark = edges.sparkSession
    e = write_table(edges.where(F.col(a) != F.col(b))
                    .select(F.least(a, b).cast("long").alias("a"),
                            F.greatest(a, b).cast("long").alias("b")).distinct(), name="edges")
    moves: list[DataFrame] = []
    while not e.isEmpty():
        both = e.select(F.col("b").alias("u"), F.col("a").alias("v")).unionAll(
            e.select(F.col("a").alias("u"), F.col("a").alias("v")))
        m = write_table(both.groupBy("u").agg(F.min("v").alias("v")), name="moves")
        while True:
            jump = m.select(F.col("u").alias("v"), F.col("v").alias("w"))
            nxt = write_table(m.join(jump, "v").select("u", F.col("w").alias("v"),
                                                       (F.col("w") != F.col("v")).alias("moved")),
                              name="moves")
            done = nxt.where("moved").isEmpty()
            m = nxt.drop("moved")
            if done:
                break
        moves.append(m)
        left = m.select(F.col("u").alias("a"), F.col("v").alias("x"))
        right = m.select(F.col("u").alias("b"), F.col("v").alias("y"))
        e = write_table(
            e.join(left, "a").join(right, "b").where("x != y")
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(),
            name="edges")
    if not moves:
        return spark.createDataFrame([], T.StructType([T.StructField("node", T.LongType()),
                                                       T.StructField("component", T.LongType())]))
    # From the last round back: where each node's target went afterwards.
    final = moves[-1].select(F.col("u").alias("node"), F.col("v").alias("component"))
    for m in reversed(moves[:-1]):
        later = final.select(F.col("node").alias("v"), F.col("component").alias("_c"))
        final = write_table(m.join(later, "v", "left").select(
            F.col("u").alias("node"), F.coalesce("_c", "v").alias("component")), name="final")
    return final
