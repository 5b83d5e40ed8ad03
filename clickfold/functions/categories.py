"""Category path and predicted-category parsing.

``item_category_list`` is a ``;``-separated path (``root;mid[;leaf]``) and
``predict_category_property`` a ``;``-separated list of ``cat:props``
pieces.  Everything is array expressions, so it stays in whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickfold.functions._util import col

# Separators of the two list columns.
PATH_SEP = ";"
PRED_SEP = ";"
PRED_KV_SEP = ":"


def category_levels(path="item_category_list") -> Column:
    """Path text -> array of levels."""
    return F.split(col(path), PATH_SEP)


def leaf_category(path="item_category_list") -> Column:
    """Third level if present, else second; NULL for a one-level path.

    ``F.get`` returns NULL out of range where ``arr[i]`` raises under ANSI.
    """
    levels = category_levels(path)
    return F.coalesce(F.get(levels, 2), F.get(levels, 1))


def predicted_categories(pred="predict_category_property") -> Column:
    """Category part (before ``:``) of every predicted piece."""
    return F.transform(F.split(col(pred), PRED_SEP),
                       lambda piece: F.get(F.split(piece, PRED_KV_SEP), 0))


def predicted_rank(leaf, pred="predict_category_property") -> Column:
    """0-based first position of the leaf among predicted categories, else -1.

    ``array_position`` is 1-based and 0 when absent, so subtracting one gives
    -1 for "not predicted"; a NULL leaf stays NULL.
    """
    return (F.array_position(predicted_categories(pred), col(leaf)) - 1).cast("int")


def shared_category_count(path="item_category_list", pred="predict_category_property") -> Column:
    """Number of distinct path levels that are also predicted."""
    return F.size(F.array_intersect(category_levels(path), predicted_categories(pred)))


def unpredicted_category_count(path="item_category_list",
                               pred="predict_category_property") -> Column:
    """Number of distinct path levels that are not predicted."""
    return F.size(F.array_except(category_levels(path), predicted_categories(pred)))


def parse_categories(df: DataFrame, with_shared: bool = False) -> DataFrame:
    """Add ``item_category_list_2``, ``predict_category_property_rank`` and
    ``item_category_count`` (and optionally ``item_category_common_count``)."""
    leaf = leaf_category("item_category_list")
    out = (df.withColumn("item_category_list_2", leaf)
             .withColumn("predict_category_property_rank",
                         predicted_rank("item_category_list_2"))
             .withColumn("item_category_count", unpredicted_category_count()))
    if with_shared:
        out = out.withColumn("item_category_common_count", shared_category_count())
    return out
