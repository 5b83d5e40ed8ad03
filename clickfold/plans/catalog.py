"""

Every query reads the driver tables of ``sf_dir`` (whole tables) and
returns a DataFrame whose column names match ``clickfold.plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickfold.functions.categories import parse_categories
from clickfold.functions.digamma import digamma
from clickfold.functions.timefmt import timestamp_text
from clickfold.operators.folds import reference_folds
from clickfold.operators.history import (
    HISTORY_KEYS,
    all_history_columns,
    attach_history,
    entity_history,
    history_columns,
)
from clickfold.operators.joins import natural_left_join, stack_folds
from clickfold.operators.label import (
    CATEGORY_HOURLY,
    CATEGORY_RANK_KEY,
    FLAG_KEYS,
    HOURLY_COUNTS,
    LABEL_COUNTS,
    LABEL_RATIOS,
    PREDICTED_RANK_COUNTS,
    RANK_KEYS,
    SKETCH_ERROR,
    average_rank,
    first_last_flags,
    hourly_counts,
    hourly_distinct_estimates,
    hourly_sketches,
    hourly_table,
    keyed_counts,
    label_count,
    label_feature_columns,
    label_ratios,
    long_label_folds,
    predicted_rank_counts,
)
from clickfold.operators.sampling import balanced_sample
from clickfold.operators.smoothing import fit_smoothing, rate_counts, smoothed_rate
from clickfold.plans import model as M
from clickfold.plans.features import (
    DERIVED_MONTH,
    DERIVED_YEAR,
    SCORE_START,
    build_features,
    prepare_derived,
    prepare_log,
)
from clickfold.session import table_path, write_table
from clickfold.sources.log import (
    derived_log,
    land_log,
    mark_score_log,
    order_log,
    read_landed_log,
    read_log,
    read_table,
    split_train_score,
    write_log,
)
from clickfold.sources.sink import read_scores, write_scores

# Fixed values of the smoother run: start point, step cap and tolerance.
SMOOTH_ALPHA0, SMOOTH_BETA0, SMOOTH_ITER, SMOOTH_EPS = 1.0, 1.0, 1000, 1e-10
# Boosting rounds of the registered model queries: the reference's.
QUERY_ROUNDS = M.ROUNDS
TRAIN_FOLDS = (1, 2, 3, 4, 5)
TEST_FOLD = 6
PARSE_COLS = ("item_category_list_2", "predict_category_property_rank", "item_category_count")

Query = Callable[[SparkSession, str], DataFrame]
ID = ("fold_id", "instance_id")


def q_parse_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = parse_categories(derived_log(spark, sf_dir), with_shared=True)
    return log.select("instance_id", "item_category_list_2", "predict_category_property_rank",
                      "item_category_count", "item_category_common_count")


def q_fold_labels(spark, sf_dir):
    p = prepare_derived(spark, sf_dir)
    return p.labels.select(*ID, timestamp_text("context_timestamp").alias("context_timestamp"),
                           "is_trade")


def q_fold_history(spark, sf_dir):
    p = prepare_derived(spark, sf_dir)
    return p.history.select(*ID, timestamp_text("context_timestamp").alias("context_timestamp"),
                            "is_trade")


def _hist_query(prefix, keys) -> Query:
    def q(spark, sf_dir):
        p = prepare_derived(spark, sf_dir)
        return attach_history(p.labels, p.panes, keys, prefix).select(
            *ID, *history_columns(prefix))
    q.__name__ = f"q_hist_{prefix}"
    return q


def _standalone_query(prefix, keys) -> Query:
    def q(spark, sf_dir):
        p = prepare_derived(spark, sf_dir)
        agg = entity_history(p.panes, keys, prefix)
        return agg.withColumn("context_timestamp", timestamp_text("context_timestamp"))
    return q


def _label_count_query(name, keys, counted) -> Query:
    def q(spark, sf_dir):
        p = prepare_derived(spark, sf_dir)
        return label_count(p.labels, keys, name, counted).select(*ID, name)
    return q


def q_label_ratios(spark, sf_dir):
    p = prepare_derived(spark, sf_dir)
    df = keyed_counts(p.labels, LABEL_COUNTS[:4])
    return label_ratios(df).select(*ID, *[o for o, _, _ in LABEL_RATIOS])


def q_hourly_counts(spark, sf_dir):
    p = prepare_derived(spark, sf_dir)
    cols = list(HOURLY_COUNTS) + [CATEGORY_HOURLY]
    return hourly_counts(p.labels, cols).select(*ID, *[o for o, _ in cols])


def q_hourly_distinct(spark, sf_dir):
    """L11-L16 as counts of distinct values per hour of day."""
    p = prepare_derived(spark, sf_dir)
    return hourly_counts(p.labels, distinct=True).select(*ID, *[o for o, _ in HOURLY_COUNTS])


def q_hourly_distinct_sketch(spark, sf_dir):
    """The exact distinct counts next to the day sketches' estimates: whether
    each estimate is within the sketches' stated error."""
    p = prepare_derived(spark, sf_dir)
    exact = hourly_table(p.labels, distinct=True)
    est = hourly_distinct_estimates(hourly_sketches(p.log), p.folds)
    names = [o for o, _ in HOURLY_COUNTS]
    both = exact.join(est.select("fold_id", "_hour", *[F.col(o).alias(f"_{o}") for o in names]),
                      ["fold_id", "_hour"], "left")
    near = [(F.abs(F.col(f"_{o}") - F.col(o)) <= SKETCH_ERROR * F.col(o)).alias(f"{o}_near") for o in names]
    return both.select("fold_id", F.col("_hour").alias("hour"), *names, *near)


def _rank_query(prefix, keys) -> Query:
    def q(spark, sf_dir):
        p = prepare_derived(spark, sf_dir)
        return average_rank(p.labels, keys, prefix, spans=long_label_folds(p.folds)).select(
            *ID, f"{prefix}_rank_up", f"{prefix}_rank_down")
    return q


def _flag_query(prefix, keys, zero_last=False) -> Query:
    def q(spark, sf_dir):
        p = prepare_derived(spark, sf_dir)
        return first_last_flags(p.labels, keys, prefix, zero_last=zero_last,
                                spans=long_label_folds(p.folds)).select(
            *ID, f"{prefix}_first", f"{prefix}_last")
    return q


def q_predicted_rank_counts(spark, sf_dir):
    p = prepare_derived(spark, sf_dir)
    return predicted_rank_counts(p.labels).select(*ID, *[o for o, _ in PREDICTED_RANK_COUNTS])


def q_natural_left_join(spark, sf_dir):
    """J4 as the reference uses it: rows meet a (key, earliest time) table on
    every shared column."""
    p = prepare_derived(spark, sf_dir)
    left = p.labels.select("fold_id", "instance_id", "user_id", "context_timestamp")
    right = (p.labels.groupBy("fold_id", "user_id")
             .agg(F.min("context_timestamp").alias("context_timestamp"))
             .withColumn("user_first", F.lit(1)))
    return natural_left_join(left, right).select(*ID, "user_first")


def q_stack_folds(spark, sf_dir):
    p = prepare_derived(spark, sf_dir)
    parts = [p.labels.where(F.col("fold_id") == f).select(*ID, "is_trade") for f in TRAIN_FOLDS]
    return stack_folds(parts)


def feature_table(spark, sf_dir, compat: bool = False,
                  materialize_labels: str | None = None,
                  only: tuple[int, ...] | None = None) -> DataFrame:
    """The whole assembly.  History rows feed one GROUPING SETS pass; label
    rows feed three (stats pass, hourly table, final join) and are re-read
    column-pruned by each rather than checkpointed (a row checkpoint would
    write every column and serve every read whole).  Pass
    ``materialize_labels="checkpoint"`` when the log source is expensive to
    recompute."""
    p = prepare_derived(spark, sf_dir, materialize_as=materialize_labels, only=only)
    return build_features(p, compat=compat)


def feature_output_columns() -> list[str]:
    return [*ID, "is_trade", *PARSE_COLS, *label_feature_columns(), *all_history_columns()]


def q_feature_table(spark, sf_dir):
    return feature_table(spark, sf_dir).select(*feature_output_columns())


def q_correlation_screen(spark, sf_dir):
    return M.correlation_screen(feature_table(spark, sf_dir, only=TRAIN_FOLDS))


def q_balanced_sample(spark, sf_dir):
    p = prepare_derived(spark, sf_dir)
    train = p.labels.where(F.col("fold_id").isin(*TRAIN_FOLDS))
    return balanced_sample(train).select(*ID, "is_trade")


def _baseline_scores(spark, sf_dir) -> DataFrame:
    """Deterministic predictor: the item's purchase ratio in the fold's
    history (0 when unseen)."""
    p = prepare_derived(spark, sf_dir)
    df = attach_history(p.labels, p.panes, ("item_id",), "item")
    return df.select(*ID, "is_trade",
                     F.coalesce(F.col("item_buy_ratio"), F.lit(0.0)).alias("predicted_score"))


def q_log_loss(spark, sf_dir):
    s = _baseline_scores(spark, sf_dir).where(F.col("fold_id").isin(*TRAIN_FOLDS))
    out = M.log_loss(s, by=("fold_id",))
    return out.select("fold_id", "n", F.round("log_loss", 6).alias("log_loss"))


def q_write_scores(spark, sf_dir):
    """S3 round trip: test-fold scores written as space-separated text with CR
    line ends into the shared checkpoint folder, then read back."""
    s = _baseline_scores(spark, sf_dir).where(F.col("fold_id") == TEST_FOLD)
    path = table_path(spark, "scores")
    write_scores(s, path)
    return read_scores(spark, path)


def _item_counts(spark, sf_dir) -> DataFrame:
    """Written once: the fit and the smoothed rates both read it."""
    return write_table(rate_counts(order_log(spark, sf_dir), ["item_id"]), name="rate-counts")


def _fit(counts):
    return fit_smoothing(counts, SMOOTH_ALPHA0, SMOOTH_BETA0, SMOOTH_ITER, SMOOTH_EPS)


def q_smoothing_fit(spark, sf_dir):
    fit = _fit(_item_counts(spark, sf_dir))
    return fit.frame(spark).select(F.round("alpha", 6).alias("alpha"),
                                   F.round("beta", 6).alias("beta"))


def q_smoothed_rate(spark, sf_dir):
    counts = _item_counts(spark, sf_dir)
    out = smoothed_rate(counts, _fit(counts))
    return out.select("item_id", "imp", "clk", F.round("smoothed_rate", 6).alias("smoothed_rate"))


def q_digamma(spark, sf_dir):
    """P20 as a Column over the arguments that line items give."""
    li = read_table(spark, sf_dir, "lineitem")
    x = F.round(F.col("l_quantity").cast("double") * (F.col("l_discount").cast("double") + 0.01), 4)
    return li.select(x.alias("x")).where("x > 0").distinct().select(
        "x", F.round(digamma("x"), 8).alias("psi"))


def _model_parts(spark, sf_dir, only=None):
    feats = write_table(feature_table(spark, sf_dir, only=only), name="features")
    return feats, M.feature_columns(feats)


def q_model_columns(spark, sf_dir):
    """M1: the columns of the training matrix in order, and how many of its
    rows have a value there."""
    feats = feature_table(spark, sf_dir, only=TRAIN_FOLDS)
    mat = M.model_matrix(feats, M.feature_columns(feats), keep=())
    row = F.array(*[F.struct(F.lit(i).alias("position"), F.lit(c).alias("feature"),
                             F.count(c).alias("n_present")) for i, c in enumerate(mat.columns, 1)])
    return mat.agg(row.alias("a")).select(F.inline("a"))


def q_train_and_score(spark, sf_dir, rounds: int = QUERY_ROUNDS):
    """M3, M4: fit on the training folds, score the scoring fold."""
    feats, cols = _model_parts(spark, sf_dir)
    model = M.fit_conversion_model(feats.where(F.col("fold_id").isin(*TRAIN_FOLDS)), cols,
                                   rounds=rounds)
    return M.score(model, feats.where(F.col("fold_id") == TEST_FOLD), cols)


def q_validate(spark, sf_dir, rounds: int = QUERY_ROUNDS):
    """M6: fit on folds 1-4, log loss on fold 5 next to that of the training
    folds' base rate."""
    feats, _ = _model_parts(spark, sf_dir, only=TRAIN_FOLDS)
    return M.validate(feats, TRAIN_FOLDS[:4], TRAIN_FOLDS[4], rounds=rounds)


def q_native_log_roundtrip(spark, sf_dir):
    """S1 + P1 on the whole derived log: written in the native text layout
    (space separated, epoch seconds) with its columns in another order, read
    back by the header, parsed."""
    log = derived_log(spark, sf_dir, grain="second")
    path = table_path(spark, "native")
    write_log(log.select(*sorted(log.columns, reverse=True)), path)
    back = parse_categories(read_log(spark, path, tz="UTC", schema=_native(log)))
    return back.select("instance_id", timestamp_text("context_timestamp").alias("context_timestamp"),
                       "is_trade", "item_category_list_2", "predict_category_property_rank",
                       "item_category_count")


def q_native_score_log(spark, sf_dir):
    """The scoring log (no label) in the native layout with one more
    column, which is carried as text."""
    _, log = split_train_score(derived_log(spark, sf_dir, grain="second"), SCORE_START)
    path = table_path(spark, "native")
    write_log(log.select((F.col("instance_id") % 7).alias("extra"), *sorted(log.columns)), path)
    back = read_log(spark, path, labelled=False, tz="UTC", schema=_native(log))
    return back.select("instance_id", timestamp_text("context_timestamp").alias("context_timestamp"),
                       "user_id", "item_category_list", "extra")


def q_landed_fold_labels(spark, sf_dir):
    """Both logs landed by source and day, then cut into folds that
    read only the folders of their days."""
    log = mark_score_log(derived_log(spark, sf_dir), SCORE_START)
    path = table_path(spark, "landed")
    land_log(log, path)
    p = prepare_log(read_landed_log(spark, path), reference_folds(DERIVED_YEAR, DERIVED_MONTH))
    return p.labels.select(*ID, timestamp_text("context_timestamp").alias("context_timestamp"),
                           "is_trade")


def _native(log: DataFrame) -> T.StructType:
    return T.StructType([T.StructField(f.name, T.LongType() if f.name == "context_timestamp"
                                       else f.dataType, True) for f in log.schema.fields])


def queries() -> dict[str, Query]:
    out: dict[str, Query] = {
        "parse_categories": q_parse_categories,
        "fold_labels": q_fold_labels,
        "fold_history": q_fold_history,
    }
    for prefix, keys in HISTORY_KEYS:
        out[f"hist_{prefix}"] = _hist_query(prefix, keys)
    for prefix, keys in HISTORY_KEYS:
        if "context_timestamp" in keys:
            out[f"hist_standalone_{prefix}"] = _standalone_query(prefix, keys)
    for name, keys, counted in LABEL_COUNTS:
        out[f"label_counts_{name.removesuffix('_count_label')}"] = _label_count_query(
            name, keys, counted)
    out["label_ratios"] = q_label_ratios
    out["hourly_counts"] = q_hourly_counts
    out["hourly_distinct"] = q_hourly_distinct
    out["hourly_distinct_sketch"] = q_hourly_distinct_sketch
    for prefix, keys in RANK_KEYS:
        out[f"rank_{prefix}"] = _rank_query(prefix, keys)
    out["rank_user_category"] = _rank_query(*CATEGORY_RANK_KEY)
    for prefix, keys in FLAG_KEYS:
        out[f"first_last_{prefix}"] = _flag_query(prefix, keys)
    out["first_last_context_compat"] = _flag_query("context", ("context_id",), zero_last=True)
    out["predicted_rank_counts"] = q_predicted_rank_counts
    out["natural_left_join"] = q_natural_left_join
    out["stack_folds"] = q_stack_folds
    out["feature_table"] = q_feature_table
    out["correlation_screen"] = q_correlation_screen
    out["balanced_sample"] = q_balanced_sample
    out["log_loss"] = q_log_loss
    out["write_scores"] = q_write_scores
    out["smoothing_fit"] = q_smoothing_fit
    out["smoothed_rate"] = q_smoothed_rate
    out["native_log_roundtrip"] = q_native_log_roundtrip
    out["native_score_log"] = q_native_score_log
    out["landed_fold_labels"] = q_landed_fold_labels
    out["digamma"] = q_digamma
    out["model_columns"] = q_model_columns
    out["train_and_score"] = q_train_and_score
    out["validate"] = q_validate
    return out
