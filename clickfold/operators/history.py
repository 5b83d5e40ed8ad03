"""History aggregation (op family H, H01-H23) and its merge into label rows.

One generic operator replaces the 23 hand-written ones: for a key list it
counts history rows and purchases per ``(fold_id, *keys)`` in a single
``agg`` (partial aggregation on the map side, so a hot key costs one row
per task before the shuffle), then derives the guarded ratio and the
complement.  NULL keys are filtered first: "unseen in history" is the NULL
produced by the later left join.

Given ``Panes``, rows are counted once per key and pane, in one row per key,
and the overlapping folds add up their panes; given fold-tagged rows (one
copy per fold), they are counted per fold.  The results are the same.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickfold.functions.arith import complement, guarded_ratio
from clickfold.operators.attach import Keyed, SetTables, attach_tables, grouping_id
from clickfold.operators.folds import Panes

LABEL_COL = "is_trade"

# The 23 history keys in the reference's merge order and the
# column prefix each one produces.  Single keys first, then user pairs.
HISTORY_KEYS: list[tuple[str, tuple[str, ...]]] = [
    ("item", ("item_id",)),
    ("user", ("user_id",)),
    ("context", ("context_id",)),
    ("context_timestamp", ("context_timestamp",)),
    ("shop", ("shop_id",)),
    ("item_brand", ("item_brand_id",)),
    ("user_gender", ("user_gender_id",)),
    ("item_city", ("item_city_id",)),
    ("context_page", ("context_page_id",)),
    ("user_occupation", ("user_occupation_id",)),
    ("shop_review_num_level", ("shop_review_num_level",)),
    ("item_category_list_2", ("item_category_list_2",)),
    ("user_item", ("user_id", "item_id")),
    ("user_shop", ("user_id", "shop_id")),
    ("user_context", ("user_id", "context_id")),
    ("user_context_timestamp", ("user_id", "context_timestamp")),
    ("user_item_brand_id", ("user_id", "item_brand_id")),
    ("user_user_gender_id", ("user_id", "user_gender_id")),
    ("user_item_city_id", ("user_id", "item_city_id")),
    ("user_context_page_id", ("user_id", "context_page_id")),
    ("user_user_occupation_id", ("user_id", "user_occupation_id")),
    ("user_shop_review_num_level", ("user_id", "shop_review_num_level")),
    ("user_item_category_list_2", ("user_id", "item_category_list_2")),
]

MEASURES = ("count", "buy_count", "buy_ratio", "not_buy_count")


def history_columns(prefix: str) -> list[str]:
    return [f"{prefix}_{m}" for m in MEASURES]


def all_history_columns() -> list[str]:
    return [c for p, _ in HISTORY_KEYS for c in history_columns(p)]


def keys_not_null(keys) -> F.Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return cond


def _pane_sums(panes: Panes) -> list[Column]:
    """Per pane the rows (``_c<pane>``) and purchases (``_b<pane>``)."""
    out = []
    for k in range(panes.count):
        here = F.col("pane") == k
        out += [F.count(F.when(here, F.lit(1))).alias(f"_c{k}"),
                F.sum(F.when(here, F.col(LABEL_COL).cast("long"))).alias(f"_b{k}")]
    return out


def _fold_sums(sums: DataFrame, panes: Panes, cols: list[str]) -> DataFrame:
    """``fold_id, *cols, _cnt, _buy`` from one row of pane sums per key."""
    rows = []
    for fold, own in panes.folds.items():
        if own:
            buys = [F.col(f"_b{k}") for k in own]
            buy = reduce(add, [F.coalesce(b, F.lit(0).cast("long")) for b in buys])
            rows.append(F.struct(F.lit(fold).alias("fold_id"),
                                 reduce(add, [F.col(f"_c{k}") for k in own]).alias("_cnt"),
                                 F.when(F.coalesce(*buys).isNotNull(), buy).alias("_buy")))
    if not rows:
        zero = F.lit(0).cast("long")
        rows.append(F.struct(F.lit(0).alias("fold_id"), zero.alias("_cnt"), zero.alias("_buy")))
    seen = F.filter(F.array(*rows), lambda r: r["_cnt"] > 0)
    return sums.select(F.inline(seen), *cols).select("fold_id", *cols, "_cnt", "_buy")


def entity_history(history: DataFrame | Panes, keys, prefix: str,
                   group: tuple[str, ...] = ("fold_id",)) -> DataFrame:
    """``(fold_id, *keys) -> {prefix}_count, _buy_count, _buy_ratio, _not_buy_count``."""
    keys = list(keys)
    cnt, buy = f"{prefix}_count", f"{prefix}_buy_count"
    if isinstance(history, Panes):
        sums = history.df.where(keys_not_null(keys)).groupBy(*keys).agg(*_pane_sums(history))
        return split_history(_fold_sums(sums, history, keys), prefix, keys, group)
    agg = (history.where(keys_not_null(keys))
           .groupBy(*group, *keys)
           .agg(F.count(F.lit(1)).alias(cnt),
                F.sum(F.col(LABEL_COL).cast("long")).alias(buy)))
    return agg.select(*group, *keys, cnt, buy,
                      guarded_ratio(buy, cnt).alias(f"{prefix}_buy_ratio"),
                      complement(cnt, buy).alias(f"{prefix}_not_buy_count"))


def attach_history(labels: DataFrame, history: DataFrame | Panes, keys, prefix: str,
                   group: tuple[str, ...] = ("fold_id",)) -> DataFrame:
    """Left-join one history table into the label rows.

    Row count is unchanged: the aggregate is unique on its key.  Which side
    is broadcast is left to adaptive execution, which decides on the
    measured size of the materialised aggregate.
    """
    agg = entity_history(history, keys, prefix, group)
    return labels.join(agg, [*group, *keys], "left")


def combined_history(history: DataFrame | Panes,
                     key_table: list[tuple[str, tuple[str, ...]]] | None = None,
                     group: tuple[str, ...] = ("fold_id",)) -> tuple[DataFrame, list[str]]:
    """Every key set's (count, purchases) from ONE scan: a GROUPING SETS
    aggregate tagged with Spark's grouping id ``_gid``.

    The scan, the set expansion and the partial (map-side) aggregation run
    once instead of once per key; only partial aggregates are shuffled.
    NULL keys form their own groups here and are dropped when splitting,
    which equals filtering them before grouping.
    """
    key_table = key_table or HISTORY_KEYS
    paned = isinstance(history, Panes)
    cols = [] if paned else list(group)
    for _, keys in key_table:
        cols += [k for k in keys if k not in cols]
    if paned:
        agg = history.df.groupingSets([list(keys) for _, keys in key_table], *cols).agg(
            *_pane_sums(history), F.grouping_id().alias("_gid"))
        return _fold_sums(agg, history, [*cols, "_gid"]), cols
    sets = [[*group, *keys] for _, keys in key_table]
    agg = (history.groupingSets(sets, *cols)
           .agg(F.count(F.lit(1)).alias("_cnt"),
                F.sum(F.col(LABEL_COL).cast("long")).alias("_buy"),
                F.grouping_id().alias("_gid")))
    return agg, cols


def split_history(part: DataFrame, prefix: str, keys, group: tuple[str, ...] = ("fold_id",)) -> DataFrame:
    """One key's table out of its set of ``combined_history``."""
    cnt, buy = f"{prefix}_count", f"{prefix}_buy_count"
    part = part.where(keys_not_null(keys)).select(
        *group, *keys, F.col("_cnt").alias(cnt), F.col("_buy").alias(buy))
    return part.select(*group, *keys, cnt, buy,
                       guarded_ratio(buy, cnt).alias(f"{prefix}_buy_ratio"),
                       complement(cnt, buy).alias(f"{prefix}_not_buy_count"))


def history_aggregates(history: DataFrame | Panes,
                       key_table: list[tuple[str, tuple[str, ...]]] | None = None,
                       group: tuple[str, ...] = ("fold_id",)) -> dict[str, Keyed]:
    """Per-key history tables from one pass: the combined aggregate is written
    once, one folder per key set (``SetTables``)."""
    key_table = key_table or HISTORY_KEYS
    agg, cols = combined_history(history, key_table, group)
    sets, out = SetTables(agg, name="history"), {}
    for prefix, keys in key_table:
        gid = grouping_id(cols, {*group, *keys})
        out[prefix] = Keyed(split_history(sets[gid], prefix, keys, group), [*group, *keys], sets.rows(gid))
    return out


def merge_history(labels: DataFrame, history: DataFrame | Panes,
                  key_table: list[tuple[str, tuple[str, ...]]] | None = None,
                  group: tuple[str, ...] = ("fold_id",), one_pass: bool = True) -> DataFrame:
    """All history features (J5): one left join per key.

    ``one_pass=True``: one GROUPING SETS scan, written once; the engine then
    knows each table's size when it chooses the joins.  ``False``: one
    aggregate and one plain left join per key, which adaptive execution
    chooses as it runs.
    """
    key_table = key_table or HISTORY_KEYS
    if one_pass:
        tables = history_aggregates(history, key_table, group)
        return attach_tables(labels, [tables[p] for p, _ in key_table])
    out = labels
    for prefix, keys in key_table:
        out = out.join(entity_history(history, keys, prefix, group), [*group, *keys], "left")
    return out
