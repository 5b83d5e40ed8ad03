"""Mixing sources to target weights.

Each document gets a hash-random key.  Within its source the documents are
ordered by that key, a distributed prefix sum of their sizes is taken, and
the order is cut where the source's budget ends: whole epochs first, then
the part of one more epoch.  ``mix`` counts the words taken exactly;
``mixed_documents`` takes the document at the cut whole or not at all.

Cases: NULL or blank text has size 0 and is never taken; NULL source is a
source of its own and comes last; repeated rows are documents of their own;
a source without words has target 0; rows with equal keys are ordered by
doc_id and size; very long texts are counted whole; an empty table gives an empty mix; only
``doc_id``, ``text`` and ``source`` are read, other columns are ignored (or
carried whole by ``mixed_documents``), whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clickfold.llm.common import running_before, uniform_key, words
from clickfold.session import write_table

WEIGHTS = (3, 1, 2)
PERCENT = 150
EPOCHS = 2


def source_targets(sizes: DataFrame, weights=WEIGHTS, percent: int = PERCENT,
                   epochs: int = EPOCHS) -> DataFrame:
    """One row per source: ``source``, ``source_no``, ``source_size``, ``target``.

    ``sizes`` has ``source`` and ``size``.  Targets share ``percent`` of all
    sizes by weight.  Repeated resharing of what exceeds ``epochs`` times a
    source's size ends where sources are full in the order of size / weight:
    with the sources in that order, a source is full if its share of what the
    ones before it leave is at least its limit.
    """
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    w = F.array(*[F.lit(x) for x in weights])
    s = (sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
         .withColumn("source_no", F.row_number().over(order).cast("long"))
         .withColumn("_w", F.get(w, ((F.col("source_no") - 1) % len(weights)).cast("int"))
                     .cast("long"))
         .withColumn("_limit", F.col("source_size") * epochs))
    by_need = Window.orderBy(F.col("_limit") / F.col("_w"), "source_no")
    everything = Window.partitionBy()
    before = by_need.rowsBetween(Window.unboundedPreceding, -1)
    # All in hundredths of a word, so that shares stay whole numbers.
    s = s.withColumns({
        "_left": F.sum("source_size").over(everything) * percent
        - 100 * F.coalesce(F.sum("_limit").over(before), F.lit(0)),
        "_weights": F.sum("_w").over(by_need.rowsBetween(0, Window.unboundedFollowing)),
    })
    # limit <= weight * left / weights; once this fails it fails for all later ones.
    full = 100 * F.col("_limit") * F.col("_weights") <= F.col("_w") * F.col("_left")
    s = s.withColumn("_open", F.min(F.when(~full, F.struct(
        F.col("_limit") / F.col("_w"), "source_no", "_left", "_weights"))).over(everything))
    target = F.when(full, F.col("_limit").cast("double")).otherwise(
        (F.col("_w") * F.col("_open._left")).cast("double")
        / (100 * F.col("_open._weights")).cast("double"))
    return s.select("source", "source_no", "source_size", target.alias("target"))


def mix(docs: DataFrame, weights=WEIGHTS, percent: int = PERCENT, epochs: int = EPOCHS,
        carry: bool = False) -> DataFrame:
    """One row per document: ``doc_id, source, size, source_size, target,
    full`` (whole epochs), ``part`` (words of one more epoch) and ``taken``
    (all words taken); with ``carry`` also the input row as ``_row``."""
    def sized(df: DataFrame, *more) -> DataFrame:
        return df.select("doc_id", "source", F.size(words(F.col("text"))).cast("long")
                         .alias("size"), uniform_key(F.col("doc_id")).alias("_key"), *more)

    narrow = write_table(sized(docs), name="sizes")
    targets = write_table(source_targets(narrow, weights, percent, epochs), name="targets")
    if carry:
        row = F.struct(*[F.col(c) for c in docs.columns]).alias("_row")
        narrow = write_table(sized(docs, row), name="carried")
    # The targets are one row per source; the engine broadcasts the written
    # table if its size allows, else it joins (and splits hot sources).
    d = (narrow.join(targets.withColumnRenamed("source", "_s"),
                     F.col("source").eqNullSafe(F.col("_s"))).drop("_s"))
    d = running_before(d, "source_no", "_key", "size", ["doc_id", "size"], "_before")
    budget = F.floor("target").cast("long")
    d = d.withColumn("full", F.when(F.col("source_size") > 0, F.expr(
        "floor(target) div source_size")).otherwise(F.lit(0)).cast("long"))
    rest = budget - F.col("full") * F.col("source_size") - F.col("_before")
    d = d.withColumn("part", F.greatest(F.lit(0), F.least(rest, F.col("size"))).cast("long"))
    d = d.withColumn("taken", F.col("full") * F.col("size") + F.col("part"))
    return d.drop("_before", "_key", "source_no")


def mixed_documents(docs: DataFrame, weights=WEIGHTS, percent: int = PERCENT,
                    epochs: int = EPOCHS) -> DataFrame:
    """The mix itself: the rows of the documents taken, once per epoch, with
    all their columns and whole texts.  The document at a source's cut is
    taken if at least half of its words are before the cut, so a source's
    words differ from its budget by at most half of that document."""
    d = mix(docs, weights, percent, epochs, carry=True)
    last = ((F.col("part") > 0) & (2 * F.col("part") >= F.col("size"))).cast("int")
    d = d.withColumn("_copy", F.explode(F.array_repeat(
        F.lit(True), F.when(F.col("size") > 0, F.col("full").cast("int") + last).otherwise(0))))
    return d.select(*[F.col("_row")[c].alias(c) for c in docs.columns])
