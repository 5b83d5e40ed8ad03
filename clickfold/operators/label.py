"""Label-day features: counts (L1-L7), ratios (L8-L10), hourly counts
(L11-L16, X2), tie-averaged ranks (R1-R14, X1), first/last flags (E1-E5)
and predicted-rank counts (X3, X4).

Skew-safe shape.  Every per-key feature is a function of the key's
timestamp multiset only, so it is computed on ``(fold_id, *keys, ts) -> n``
-- a partial aggregate that shrinks a hot key to one row per distinct
timestamp before any shuffle -- and joined back to the rows.  Running
positions are sums of two levels: within a day of a key, and over the days
before it.  So no window sees more than one row per second of a day, however
many impressions a key has and however long the label range is; a hot key is
spread over as many tasks as it has days.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickfold.functions.arith import guarded_ratio
from clickfold.operators.attach import Keyed, SetTables, attach_tables, grouping_id
from clickfold.functions.timefmt import hour_of_day
from clickfold.operators.history import keys_not_null

TS = "context_timestamp"
GROUP = ("fold_id",)

# Label-day count keys with the column whose non-null values
# are counted (L1-L7, in the reference's order).
LABEL_COUNTS: list[tuple[str, tuple[str, ...], str]] = [
    ("user_count_label", ("user_id",), "user_id"),
    ("user_item_count_label", ("user_id", "item_id"), "item_id"),
    ("user_shop_count_label", ("user_id", "shop_id"), "item_id"),
    ("user_context_count_label", ("user_id", "context_id"), "item_id"),
    ("item_count_label", ("item_id",), "item_id"),
    ("shop_count_label", ("shop_id",), "shop_id"),
    ("context_count_label", ("context_id",), "context_id"),
]

# Ratio outputs L8-L10 as (output, numerator, denominator).
LABEL_RATIOS: list[tuple[str, str, str]] = [
    ("user_item_user_ratio_label", "user_item_count_label", "user_count_label"),
    ("user_shop_user_ratio_label", "user_shop_count_label", "user_count_label"),
    ("user_context_user_ratio_label", "user_context_count_label", "user_count_label"),
]

# Rank keys R1-R7 (up) / R8-R14 (down), in the reference's order.
RANK_KEYS: list[tuple[str, tuple[str, ...]]] = [
    ("user", ("user_id",)),
    ("item", ("item_id",)),
    ("shop", ("shop_id",)),
    ("context", ("context_id",)),
    ("user_item", ("user_id", "item_id")),
    ("user_shop", ("user_id", "shop_id")),
    ("user_context", ("user_id", "context_id")),
]
# Option X1: user x leaf-category ranks.
CATEGORY_RANK_KEY = ("user_item_category_list_2", ("user_id", "item_category_list_2"))

# Hourly counts L11-L16 as (output, counted column); X2 extra.
HOURLY_COUNTS: list[tuple[str, str]] = [
    ("item_count_hour", "item_id"),
    ("user_count_hour", "user_id"),
    ("shop_count_hour", "shop_id"),
    ("context_count_hour", "context_id"),
    ("context_page_count_hour", "context_page_id"),
    ("item_brand_count_hour", "item_brand_id"),
]
CATEGORY_HOURLY = ("item_category_list_2_count_hour", "item_category_list_2")

# first/last flag keys E1-E5 (E2/E3 are one key here).
FLAG_KEYS: list[tuple[str, tuple[str, ...]]] = [
    ("user", ("user_id",)),
    ("item", ("item_id",)),
    ("shop", ("shop_id",)),
    ("context", ("context_id",)),
]

# Option X3/X4: counts per (entity, predicted rank).
PREDICTED_RANK_COUNTS: list[tuple[str, tuple[str, ...]]] = [
    ("user_predict_category", ("user_id", "predict_category_property_rank")),
    ("item_predict_category", ("item_id", "predict_category_property_rank")),
]

SINGLE = -1   # flag for a key seen once


def running_stats(agg: DataFrame, part: list[str], sums: list[str] = (),
                  spans: Column | None = None) -> DataFrame:
    """For rows unique on ``(*part, ts)`` with their number ``_n``: add
    ``_before`` (rows of the key at earlier times), ``_total``, ``_min`` and
    ``_max`` (its time range) and the key's totals of ``sums``.

    ``part`` must not be NULL.  ``spans`` tells the rows whose key may have
    more than one day (default: all); the others need no second level.
    """
    day = agg.withColumn("_slice", F.to_date(TS))
    inside = Window.partitionBy(*part, "_slice")
    earlier = inside.orderBy(TS).rowsBetween(Window.unboundedPreceding, -1)
    n, ts = F.col("_n"), F.col(TS)
    inner = day.select(
        "*", F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias("_before"),
        F.sum(n).over(inside).alias("_total"), F.min(ts).over(inside).alias("_min"),
        F.max(ts).over(inside).alias("_max"), *[F.sum(c).over(inside).alias(f"_all{c}") for c in sums])
    slices = (day if spans is None else day.where(spans)).groupBy(*part, "_slice").agg(
        F.sum(n).alias("_n"), F.min(ts).alias("_a"), F.max(ts).alias("_b"), *[F.sum(c).alias(c) for c in sums])
    key = Window.partitionBy(*part)
    days = key.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    outer = slices.select(
        *part, "_slice", F.coalesce(F.sum("_n").over(days), F.lit(0)).alias("_o_before"),
        F.sum("_n").over(key).alias("_o_total"), F.min("_a").over(key).alias("_o_min"),
        F.max("_b").over(key).alias("_o_max"), *[F.sum(c).over(key).alias(f"_o_all{c}") for c in sums])
    both = inner.join(outer, [*part, "_slice"], "left")
    found = [(F.col("_before") + F.coalesce("_o_before", F.lit(0))).alias("_before")]
    found += [F.coalesce(f"_o{c}", c).alias(c) for c in ("_total", "_min", "_max", *[f"_all{c}" for c in sums])]
    return both.select(*agg.columns, *found)


def rank_columns(up: str, down: str) -> list[Column]:
    """Average ranks over ties from ``running_stats``."""
    n, before = F.col("_n"), F.col("_before")
    half = (n + F.lit(1)).cast("double") / F.lit(2.0)
    return [(before + half).alias(up), (F.col("_total") - before - n + half).alias(down)]


def flag_columns(first: str, last: str) -> list[Column]:
    """First / last flags from ``running_stats``."""
    single = F.col("_total") == 1
    return [F.when(single, F.lit(SINGLE)).when(F.col(TS) == F.col(edge), F.lit(1)).otherwise(F.lit(0)).alias(name)
            for name, edge in ((first, "_min"), (last, "_max"))]


def long_label_folds(folds) -> Column:
    """Rows of the folds whose label range may be longer than one day."""
    def short(f):
        return (f.label_start is not None and f.label_end is not None
                and f.label_start.date() == (f.label_end - dt.timedelta(microseconds=1)).date())
    return F.col("fold_id").isin([f.fold_id for f in folds if not short(f)])


def key_stats(labels: DataFrame, keys, prefix: str, counted: tuple[str, str] | None = None,
              ranks: bool = True, flags: bool = False, group=GROUP,
              spans: Column | None = None) -> DataFrame:
    """Per ``(group, *keys, ts)``: count, average ranks and flags of the key.

    ``counted = (output, column)`` adds the per-key count of non-null
    ``column`` values.  Ranks average over ties like ``rank(method='average')``:
    a timestamp shared by ``n`` rows after ``b`` earlier rows takes
    ``b + (n + 1) / 2`` upward and ``total - b - n + (n + 1) / 2`` downward.
    A row without a time has no day and ranks nowhere.
    """
    keys = list(keys)
    aggs = [F.count(F.lit(1)).alias("_n")]
    if counted is not None:
        aggs.append(F.count(F.col(counted[1])).alias("_c"))
    g = labels.where(keys_not_null([*keys, TS])).groupBy(*group, *keys, TS).agg(*aggs)
    g = running_stats(g, [*group, *keys], [] if counted is None else ["_c"], spans)
    out = [*group, *keys, TS]
    if counted is not None:
        out.append(F.col("_all_c").alias(counted[0]))
    if ranks:
        out += rank_columns(f"{prefix}_rank_up", f"{prefix}_rank_down")
    if flags:
        out += flag_columns(f"{prefix}_first", f"{prefix}_last")
    return g.select(*out)


def _attach(labels: DataFrame, stats: DataFrame, keys, group=GROUP) -> DataFrame:
    return labels.join(stats, [*group, *keys, TS], "left")


def _fill_flags(df: DataFrame, prefix: str, zero_last: bool = False) -> DataFrame:
    first, last = f"{prefix}_first", f"{prefix}_last"
    df = df.withColumn(first, F.coalesce(F.col(first), F.lit(0)))
    last_col = F.lit(0) if zero_last else F.coalesce(F.col(last), F.lit(0))
    return df.withColumn(last, last_col)


def average_rank(df: DataFrame, keys, prefix: str, group=GROUP,
                 spans: Column | None = None) -> DataFrame:
    """Add ``{prefix}_rank_up`` / ``{prefix}_rank_down`` (NULL for a NULL key)."""
    return _attach(df, key_stats(df, keys, prefix, group=group, spans=spans), keys, group)


def label_count(df: DataFrame, keys, output: str, counted: str, group=GROUP,
                source: DataFrame | None = None) -> DataFrame:
    """Add ``output`` = non-null ``counted`` values of the row's key group.

    ``source`` (default ``df``) is the frame counted; pass the base label rows
    when ``df`` already carries earlier joins, so each count aggregates the
    base rows instead of re-running the joins beneath it.
    """
    src = source if source is not None else df
    st = (src.where(keys_not_null(keys)).groupBy(*group, *keys)
             .agg(F.count(F.col(counted)).alias(output)))
    return df.join(st, [*group, *keys], "left")


def first_last_flags(df: DataFrame, keys, prefix: str, zero_last: bool = False,
                     group=GROUP, spans: Column | None = None) -> DataFrame:
    """Add ``{prefix}_first`` / ``{prefix}_last``: -1 for a key seen once,
    1 on rows at the key's earliest (latest) time, else 0; 0 for a NULL key.
    ``zero_last=True`` reproduces the reference's context defect (always 0)."""
    st = key_stats(df, keys, prefix, ranks=False, flags=True, group=group, spans=spans)
    return _fill_flags(_attach(df, st, keys, group), prefix, zero_last)


def label_ratios(df: DataFrame) -> DataFrame:
    """L8-L10 from the count columns (guarded ratio)."""
    for out, num, den in LABEL_RATIOS:
        df = df.withColumn(out, guarded_ratio(num, den))
    return df


def hourly_table(df: DataFrame, counts=None, group=GROUP, distinct: bool = False) -> DataFrame:
    """``(group, hour) -> non-null counts`` (or exact counts of distinct
    values); at most 24 rows per fold."""
    counts = counts or HOURLY_COUNTS
    how = F.count_distinct if distinct else F.count
    return (df.withColumn("_hour", hour_of_day(TS))
              .groupBy(*group, "_hour")
              .agg(*[how(F.col(c)).alias(o) for o, c in counts]))


def hourly_counts(df: DataFrame, counts=None, group=GROUP,
                  source: DataFrame | None = None, distinct: bool = False) -> DataFrame:
    """Add the hourly counts of the row's hour of day (ignores the date).

    The hourly table has at most 24 rows per fold -- a bound fixed by the
    clock and the fold spec, not by the data -- so it is broadcast.
    ``source`` (default ``df``) is the frame counted: the base label rows
    when ``df`` already carries other joins.  ``distinct`` counts distinct
    values instead (an addition; the reference counts rows).
    """
    table = F.broadcast(hourly_table(source if source is not None else df, counts, group, distinct))
    return (df.withColumn("_hour", hour_of_day(TS))
              .join(table, [*group, "_hour"], "left").drop("_hour"))


#: Distinct-count sketches keep 2**SKETCH_BITS registers; SKETCH_ERROR is three
#: standard errors of such a sketch.
SKETCH_BITS = 12
SKETCH_ERROR = 3 * 1.04 / 2 ** (SKETCH_BITS / 2)


def hourly_sketches(log: DataFrame, counts=None, bits: int = SKETCH_BITS) -> DataFrame:
    """Mergeable distinct-count sketches per ``(log_source, day, hour)`` of a
    log with ``log_source``: one small row per day and hour, made once however
    many folds read the day."""
    counts = counts or HOURLY_COUNTS
    rows = log.where(F.col(TS).isNotNull()).select(
        "log_source", F.to_date(TS).alias("day"), hour_of_day(TS).alias("_hour"),
        *[F.col(c).cast("string").alias(o) for o, c in counts])
    return rows.groupBy("log_source", "day", "_hour").agg(
        *[F.hll_sketch_agg(o, F.lit(bits)).alias(o) for o, _ in counts])


def hourly_distinct_estimates(sketches: DataFrame, folds, counts=None) -> DataFrame:
    """``(fold_id, hour) -> estimated distinct values`` by merging the day
    sketches of each fold's label range, within ``SKETCH_ERROR`` (about three
    times in a thousand beyond it).  Label ranges must begin and end at
    midnight, as sketches cannot be cut."""
    counts = counts or HOURLY_COUNTS
    roles = []
    for f in folds:
        for limit in (f.label_start, f.label_end):
            if limit is not None and limit.time() != dt.time():
                raise ValueError(f"fold {f.fold_id}: day sketches need label limits at midnight")
        here = F.col("log_source") == f.label_source
        if f.label_start is not None:
            here = here & (F.col("day") >= F.lit(f.label_start.date()))
        if f.label_end is not None:
            here = here & (F.col("day") < F.lit(f.label_end.date()))
        roles.append(F.when(here, F.lit(f.fold_id)))
    own = F.filter(F.array(*roles), lambda x: x.isNotNull())
    tagged = sketches.select(F.explode(own).alias("fold_id"), "_hour", *[o for o, _ in counts])
    return tagged.groupBy("fold_id", "_hour").agg(*[
        F.hll_sketch_estimate(F.hll_union_agg(o)).alias(o) for o, _ in counts])


def keyed_counts(df: DataFrame, counts, group=GROUP, source: DataFrame | None = None) -> DataFrame:
    """Add several per-key counts ``(output, keys, counted column or None)``
    from one pass over ``source`` (default ``df``): GROUPING SETS, written
    once, then joined by key."""
    src = source if source is not None else df
    cols = list(group)
    for _, keys, _ in counts:
        cols += [k for k in keys if k not in cols]
    counted = sorted({c for _, _, c in counts if c is not None})
    agg = src.groupingSets([[*group, *keys] for _, keys, _ in counts], *cols).agg(
        F.count(F.lit(1)).alias("_n"), *[F.count(F.col(c)).alias(f"_n_{c}") for c in counted],
        F.grouping_id().alias("_gid"))
    sets = SetTables(agg, name="counts")
    tables = []
    for out, keys, c in counts:
        gid = grouping_id(cols, {*group, *keys})
        part = sets[gid].where(keys_not_null(keys))
        n = F.col("_n" if c is None else f"_n_{c}")
        tables.append(Keyed(part.select(*group, *keys, n.alias(out)), [*group, *keys], sets.rows(gid)))
    return attach_tables(df, tables)


def predicted_rank_counts(df: DataFrame, group=GROUP,
                          source: DataFrame | None = None) -> DataFrame:
    """Rows per (user, predicted rank) and (item, predicted rank)."""
    return keyed_counts(df, [(out, keys, None) for out, keys in PREDICTED_RANK_COUNTS], group, source)


def label_feature_columns(extras: bool = False) -> list[str]:
    cols = [o for o, _, _ in LABEL_COUNTS] + [o for o, _, _ in LABEL_RATIOS]
    cols += [f"{p}_rank_up" for p, _ in RANK_KEYS]
    cols += [f"{p}_rank_down" for p, _ in RANK_KEYS]
    cols += [o for o, _ in HOURLY_COUNTS]
    cols += [f"{p}_{s}" for p, _ in FLAG_KEYS for s in ("first", "last")]
    if extras:
        cols += [f"{CATEGORY_RANK_KEY[0]}_rank_up", f"{CATEGORY_RANK_KEY[0]}_rank_down",
                 CATEGORY_HOURLY[0]] + [o for o, _ in PREDICTED_RANK_COUNTS]
    return cols


def _stat_specs(extras: bool = False):
    """(prefix, keys, counted-count output or None, flags?) per stats key."""
    counted = {keys: (out, c) for out, keys, c in LABEL_COUNTS}
    flagged = {keys for _, keys in FLAG_KEYS}
    specs = [(p, keys, counted.get(keys), keys in flagged) for p, keys in RANK_KEYS]
    if extras:
        specs.append((CATEGORY_RANK_KEY[0], CATEGORY_RANK_KEY[1], None, False))
    return specs


def label_stats_tables(labels: DataFrame, extras: bool = False, group=GROUP,
                       spans: Column | None = None) -> list[Keyed]:
    """Every stats table of ``key_stats`` from ONE pass.

    A GROUPING SETS aggregate gives ``(set, fold, keys, ts) -> n`` for all
    keys at once; ``running_stats`` by the set id and all key columns (those
    outside a set are constant there) turns counts into running positions,
    totals and extremes.  The result is written once and split per key.
    """
    specs = _stat_specs(extras)
    stats, cols = combined_label_stats(labels, extras, group, spans)
    sets = SetTables(stats, name="label-stats")
    out = []
    for prefix, keys, cnt, flags in specs:
        gid = grouping_id([*cols, TS], {*group, *keys, TS})
        sel = [*group, *keys, TS]
        if cnt is not None:
            sel.append(F.col(f"_cnt_{cnt[1]}").alias(cnt[0]))
        sel += [F.col("_up").alias(f"{prefix}_rank_up"), F.col("_down").alias(f"{prefix}_rank_down")]
        if flags:
            sel += [F.col("_first").alias(f"{prefix}_first"), F.col("_last").alias(f"{prefix}_last")]
        df = sets[gid].where(keys_not_null(keys)).select(*sel)
        out.append(Keyed(df, [*group, *keys, TS], sets.rows(gid)))
    return out


def combined_label_stats(labels: DataFrame, extras: bool = False, group=GROUP,
                         spans: Column | None = None) -> tuple[DataFrame, list[str]]:
    """The unsplit one-pass stats of all sets (rows with NULL keys left out)."""
    specs = _stat_specs(extras)
    cols = list(group)
    for _, keys, _, _ in specs:
        cols += [k for k in keys if k not in cols]
    counted_cols = sorted({c for _, _, cnt, _ in specs if cnt for c in [cnt[1]]})
    sets = [[*group, *keys, TS] for _, keys, _, _ in specs]
    agg = (labels.where(F.col(TS).isNotNull()).groupingSets(sets, *cols, TS)
           .agg(F.count(F.lit(1)).alias("_n"),
                *[F.count(F.col(c)).alias(f"_c_{c}") for c in counted_cols],
                F.grouping_id().alias("_gid")))
    whole = F.lit(False)
    for _, keys, _, _ in specs:
        gid = grouping_id([*cols, TS], {*group, *keys, TS})
        whole = whole | ((F.col("_gid") == gid) & keys_not_null(keys))
    # Outside its set a key column is NULL; a constant lets it be joined on.
    fill = [F.coalesce(F.col(c), F.lit("" if isinstance(labels.schema[c].dataType, T.StringType) else 0)
                       .cast(labels.schema[c].dataType)).alias(c) for c in cols]
    agg = agg.where(whole).select("_gid", *fill, TS, "_n", *[f"_c_{c}" for c in counted_cols])
    stats = running_stats(agg, ["_gid", *cols], [f"_c_{c}" for c in counted_cols], spans)
    return stats.select(
        "_gid", *cols, TS, *[F.col(f"_all_c_{c}").alias(f"_cnt_{c}") for c in counted_cols],
        *rank_columns("_up", "_down"), *flag_columns("_first", "_last")), cols


def label_features(labels: DataFrame, compat: bool = False, extras: bool = False,
                   group=GROUP, one_pass: bool = False, spans: Column | None = None) -> DataFrame:
    """All 38 label-day columns (plus X1-X4 when ``extras``).

    One stats table per rank key carries that key's count, both ranks and,
    for user / item / shop / context, both flags: seven joins in all, plus a
    broadcast join of the hourly table.  ``one_pass=True`` builds the stats
    tables in one pass (``label_stats_tables``); otherwise each is its own
    plan and join choice is left to adaptive execution.
    ``compat=True`` keeps the reference's ``context_last`` defect (always 0).
    """
    if one_pass:
        out = attach_tables(labels, label_stats_tables(labels, extras, group, spans))
    else:
        out = labels
        for prefix, keys, cnt, flags in _stat_specs(extras):
            st = key_stats(labels, keys, prefix, counted=cnt, ranks=True, flags=flags,
                           group=group, spans=spans)
            out = out.join(st, [*group, *keys, TS], "left")
    return finish_label_features(out, labels, compat, extras, group)


def finish_label_features(out: DataFrame, labels: DataFrame, compat: bool = False,
                          extras: bool = False, group=GROUP) -> DataFrame:
    """Flags, ratios and hourly counts for rows that carry the stats tables;
    other columns of ``out`` stay."""
    more = [c for c in out.columns if c not in labels.columns]
    for prefix, keys in FLAG_KEYS:
        out = _fill_flags(out, prefix, zero_last=compat and prefix == "context")
    out = label_ratios(out)
    hourly = list(HOURLY_COUNTS) + ([CATEGORY_HOURLY] if extras else [])
    out = hourly_counts(out, hourly, group, source=labels)
    if extras:
        out = predicted_rank_counts(out, group, source=labels)
    mine = label_feature_columns(extras)
    return out.select(*labels.columns, *mine, *[c for c in more if c not in mine])
