"""DuckDB SQL for the correctness oracle.

Each statement rebuilds the derived log from the driver tables and answers
the query in an independently shaped way (text time comparisons as the
reference does, correlated subqueries instead of joins, row_number averages
instead of running sums), so it checks semantics rather than re-running the
Spark plan.
"""

from __future__ import annotations

from clickfold.operators.history import HISTORY_KEYS, MEASURES
from clickfold.operators.label import (
    FLAG_KEYS,
    HOURLY_COUNTS,
    LABEL_COUNTS,
    LABEL_RATIOS,
    PREDICTED_RANK_COUNTS,
    RANK_KEYS,
    label_feature_columns,
)

TRAIN_FOLDS = (1, 2, 3, 4, 5)
TEST_FOLD = 6
LABEL_FEATURES = label_feature_columns()
# Model columns (M1) of the derived log, in table order: raw ids kept by M1,
# parse columns, label and history features; then the unseen indicators.
_M1_DROP = {"user_rank_down", "user_first", "item_category_list_2_not_buy_count",
            "item_category_list_2_count"}
RAW = ("user_gender_id", "user_occupation_id", "context_page_id", "shop_review_num_level")
TEXT = ("user_occupation_id", "item_category_list_2")
MODEL_FEATURES = [c for c in (
    [*RAW, "item_category_list_2", "predict_category_property_rank", "item_category_count"]
    + LABEL_FEATURES
    + [f"{p}_{m}" for p, _ in HISTORY_KEYS for m in MEASURES]) if c not in _M1_DROP]

# Derived log, parse columns and fold roles (FIXTURES.md section 2).
PRELUDE = """
WITH ev AS (
  SELECT event_id, ts, user_id, event_type,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
  FROM events
),
rawlog AS (
  SELECT e.event_id AS instance_id, e.user_id, e.k AS item_id, e.k % 10 AS shop_id,
         (e.event_id * 7919) % 401 AS context_id,
         strftime(e.ts, '%Y-%m-%d %H:00:00') AS context_timestamp,
         CASE WHEN e.event_type = 'purchase' THEN 1 ELSE 0 END AS is_trade,
         p.p_brand AS item_brand_id, s.s_nationkey AS item_city_id,
         e.user_id % 3 AS user_gender_id, c.c_mktsegment AS user_occupation_id,
         e.event_id % 20 AS context_page_id,
         CAST(floor(s.s_acctbal / 1000) AS INT) AS shop_review_num_level,
         'root;' || p.p_type || CASE WHEN p.p_size % 2 = 0 THEN ';' || p.p_brand ELSE '' END
           AS item_category_list,
         CASE e.event_id % 3
           WHEN 0 THEN p.p_brand || ':1;' || p.p_type || ':2'
           WHEN 1 THEN 'OTHER:3;' || p.p_type || ':1,2;' || p.p_brand || ':1'
           ELSE '-1' END AS predict_category_property
  FROM ev e
  LEFT JOIN part p ON p.p_partkey = e.k
  LEFT JOIN supplier s ON s.s_suppkey = e.k % 10
  LEFT JOIN customer c ON c.c_custkey = e.user_id
),
split AS (
  SELECT *, string_split(item_category_list, ';') AS cats,
         list_transform(string_split(predict_category_property, ';'),
                        lambda x: string_split(x, ':')[1]) AS pcs
  FROM rawlog
),
leafed AS (SELECT *, coalesce(cats[3], cats[2]) AS leaf FROM split),
plog AS (
  SELECT * EXCLUDE (cats, pcs, leaf), leaf AS item_category_list_2,
         CASE WHEN leaf IS NULL THEN NULL
              ELSE CAST(coalesce(list_position(pcs, leaf), 0) - 1 AS INT) END
           AS predict_category_property_rank,
         CAST(len(list_distinct(list_filter(cats, lambda x: NOT list_contains(pcs, x)))) AS INT)
           AS item_category_count,
         CAST(len(list_distinct(list_filter(cats, lambda x: list_contains(pcs, x)))) AS INT)
           AS item_category_common_count
  FROM leafed
),
spec(fold_id, lab_lo, lab_hi, his_lo, his_hi, src) AS (VALUES
  (1, '2024-01-23', '2024-01-24', '2024-01-21', '2024-01-23', 'train'),
  (2, '2024-01-22', '2024-01-23', '2024-01-20', '2024-01-22', 'train'),
  (3, '2024-01-21', '2024-01-22', '2024-01-19', '2024-01-21', 'train'),
  (4, '2024-01-20', '2024-01-21', '2024-01-18', '2024-01-20', 'train'),
  (5, '2024-01-24', NULL, '2024-01-22', '2024-01-24', 'train'),
  (6, NULL, NULL, '2024-01-23', NULL, 'score')
),
trainlog AS (SELECT * FROM plog WHERE context_timestamp < '2024-01-25'),
scorelog AS (
  SELECT * REPLACE (CAST(NULL AS INT) AS is_trade) FROM plog
  WHERE context_timestamp > '2024-01-25'
),
lab AS (
  SELECT CAST(s.fold_id AS INT) AS fold_id, t.* FROM trainlog t JOIN spec s
    ON s.src = 'train' AND t.context_timestamp > s.lab_lo
   AND (s.lab_hi IS NULL OR t.context_timestamp < s.lab_hi)
  UNION ALL
  SELECT CAST(s.fold_id AS INT) AS fold_id, t.* FROM scorelog t JOIN spec s ON s.src = 'score'
),
his AS (
  SELECT CAST(s.fold_id AS INT) AS fold_id, t.* FROM trainlog t JOIN spec s
    ON t.context_timestamp > s.his_lo AND (s.his_hi IS NULL OR t.context_timestamp < s.his_hi)
)
"""


def _match(keys, a="h", b="l"):
    return " AND ".join([f"{a}.fold_id = {b}.fold_id"] + [f"{a}.{k} = {b}.{k}" for k in keys])


def history_select(prefix: str, keys) -> str:
    """Correlated count / sum per label row (no join to an aggregate)."""
    m = _match(keys)
    c, b = f"{prefix}_count", f"{prefix}_buy_count"
    return f"""
SELECT fold_id, instance_id, {c}, {b},
       CASE WHEN {c} = 0 THEN -1.0 ELSE {b} / {c} END AS {prefix}_buy_ratio,
       {c} - {b} AS {prefix}_not_buy_count
FROM (
  SELECT l.fold_id, l.instance_id,
         (SELECT nullif(count(*), 0) FROM his h WHERE {m}) AS {c},
         (SELECT CAST(sum(h.is_trade) AS BIGINT) FROM his h WHERE {m}) AS {b}
  FROM lab l
)"""


def history_sql() -> dict[str, str]:
    return {f"hist_{p}": history_select(p, keys) for p, keys in HISTORY_KEYS}


def standalone_sql() -> dict[str, str]:
    out = {}
    for p, keys in HISTORY_KEYS:
        if "context_timestamp" not in keys:
            continue
        k = ", ".join(keys)
        out[f"hist_standalone_{p}"] = f"""
SELECT fold_id, {k}, count(*) AS {p}_count, CAST(sum(is_trade) AS BIGINT) AS {p}_buy_count,
       CAST(sum(is_trade) AS DOUBLE) / count(*) AS {p}_buy_ratio,
       count(*) - CAST(sum(is_trade) AS BIGINT) AS {p}_not_buy_count
FROM his WHERE {" AND ".join(f"{x} IS NOT NULL" for x in keys)}
GROUP BY fold_id, {k}"""
    return out


def label_count_sql() -> dict[str, str]:
    out = {}
    for name, keys, counted in LABEL_COUNTS:
        k = ", ".join(keys)
        nn = " AND ".join(f"{x} IS NOT NULL" for x in keys)
        out[f"label_counts_{name.removesuffix('_count_label')}"] = f"""
, g AS (SELECT fold_id, {k}, count({counted}) AS {name} FROM lab WHERE {nn} GROUP BY fold_id, {k})
SELECT l.fold_id, l.instance_id, g.{name}
FROM lab l LEFT JOIN g ON {_match(keys, 'g', 'l')}"""
    return out


def label_ratio_sql() -> str:
    counts = []
    for name, keys, counted in LABEL_COUNTS[:4]:
        counts.append(f"(SELECT nullif(count(x.{counted}), 0) FROM lab x WHERE "
                      f"{_match(keys, 'x', 'l')}) AS {name}")
    sel = ",\n       ".join(f"CASE WHEN {d} = 0 THEN -1.0 ELSE CAST({n} AS DOUBLE) / {d} END AS {o}"
                            for o, n, d in LABEL_RATIOS)
    return f"""
SELECT fold_id, instance_id,
       {sel}
FROM (SELECT l.fold_id, l.instance_id, {", ".join(counts)} FROM lab l)"""


def hourly_sql(extra: bool = True) -> str:
    cols = list(HOURLY_COUNTS) + ([("item_category_list_2_count_hour", "item_category_list_2")]
                                  if extra else [])
    aggs = ", ".join(f"count({c}) AS {o}" for o, c in cols)
    outs = ", ".join(f"h.{o}" for o, _ in cols)
    return f"""
, hr AS (SELECT fold_id, CAST(substr(context_timestamp, 12, 2) AS INT) AS hh, {aggs}
         FROM lab GROUP BY ALL)
SELECT l.fold_id, l.instance_id, {outs}
FROM lab l JOIN hr h ON h.fold_id = l.fold_id
 AND h.hh = CAST(substr(l.context_timestamp, 12, 2) AS INT)"""


def hourly_distinct_sql(sketch: bool = False) -> str:
    aggs = ", ".join(f"count(DISTINCT {c}) AS {o}" for o, c in HOURLY_COUNTS)
    hours = f"SELECT fold_id, CAST(substr(context_timestamp, 12, 2) AS INT) AS hour, {aggs}"
    if sketch:
        near = ", ".join(f"true AS {o}_near" for o, _ in HOURLY_COUNTS)
        return f"{hours}, {near} FROM lab GROUP BY ALL"
    outs = ", ".join(f"h.{o}" for o, _ in HOURLY_COUNTS)
    return f"""
, hr AS ({hours} FROM lab GROUP BY ALL)
SELECT l.fold_id, l.instance_id, {outs}
FROM lab l JOIN hr h ON h.fold_id = l.fold_id
 AND h.hour = CAST(substr(l.context_timestamp, 12, 2) AS INT)"""


def rank_select(prefix: str, keys) -> str:
    """Average of row_number over each tie group, both directions."""
    k = ", ".join(keys)
    nn = " AND ".join(f"{x} IS NOT NULL" for x in keys)
    return f"""
, r AS (
  SELECT fold_id, instance_id, {k}, context_timestamp,
         row_number() OVER (PARTITION BY fold_id, {k} ORDER BY context_timestamp) AS rn_up,
         row_number() OVER (PARTITION BY fold_id, {k} ORDER BY context_timestamp DESC) AS rn_down
  FROM lab WHERE {nn}
),
a AS (
  SELECT fold_id, instance_id,
         avg(rn_up) OVER (PARTITION BY fold_id, {k}, context_timestamp) AS up,
         avg(rn_down) OVER (PARTITION BY fold_id, {k}, context_timestamp) AS down
  FROM r
)
SELECT l.fold_id, l.instance_id, CAST(a.up AS DOUBLE) AS {prefix}_rank_up,
       CAST(a.down AS DOUBLE) AS {prefix}_rank_down
FROM lab l LEFT JOIN a USING (fold_id, instance_id)"""


def rank_sql() -> dict[str, str]:
    out = {f"rank_{p}": rank_select(p, keys) for p, keys in RANK_KEYS}
    out["rank_user_category"] = rank_select(
        "user_item_category_list_2", ("user_id", "item_category_list_2"))
    return out


def flag_select(prefix: str, keys, zero_last: bool = False) -> str:
    k = ", ".join(keys)
    nn = " AND ".join(f"{x} IS NOT NULL" for x in keys)
    last = "0" if zero_last else f"""CASE WHEN g.n IS NULL THEN 0 WHEN g.n = 1 THEN -1
            WHEN l.context_timestamp = g.hi THEN 1 ELSE 0 END"""
    return f"""
, g AS (SELECT fold_id, {k}, count(*) AS n, min(context_timestamp) AS lo,
               max(context_timestamp) AS hi FROM lab WHERE {nn} GROUP BY fold_id, {k})
SELECT l.fold_id, l.instance_id,
       CAST(CASE WHEN g.n IS NULL THEN 0 WHEN g.n = 1 THEN -1
            WHEN l.context_timestamp = g.lo THEN 1 ELSE 0 END AS INT) AS {prefix}_first,
       CAST({last} AS INT) AS {prefix}_last
FROM lab l LEFT JOIN g ON {_match(keys, 'g', 'l')}"""


def flag_sql() -> dict[str, str]:
    out = {f"first_last_{p}": flag_select(p, keys) for p, keys in FLAG_KEYS}
    out["first_last_context_compat"] = flag_select("context", ("context_id",), zero_last=True)
    return out


def parse_sql() -> str:
    return """
SELECT instance_id, item_category_list_2, predict_category_property_rank,
       item_category_count, item_category_common_count
FROM plog"""


def fold_sql() -> dict[str, str]:
    return {
        "fold_labels": "SELECT fold_id, instance_id, context_timestamp, is_trade FROM lab",
        "fold_history": "SELECT fold_id, instance_id, context_timestamp, is_trade FROM his",
    }


def as_subquery(body: str) -> str:
    """A body is either a SELECT or ``, cte AS (...) SELECT``; nest it."""
    b = body.strip()
    return f"(WITH {b[1:]})" if b.startswith(",") else f"({b})"


def predicted_rank_sql() -> str:
    gs, sel, joins = [], [], []
    for i, (out, keys) in enumerate(PREDICTED_RANK_COUNTS):
        k = ", ".join(keys)
        nn = " AND ".join(f"{x} IS NOT NULL" for x in keys)
        gs.append(f"p{i} AS (SELECT fold_id, {k}, count(*) AS {out} FROM lab WHERE {nn} "
                  f"GROUP BY fold_id, {k})")
        sel.append(f"p{i}.{out}")
        joins.append(f"LEFT JOIN p{i} ON {_match(keys, f'p{i}', 'l')}")
    return f"""
, {", ".join(gs)}
SELECT l.fold_id, l.instance_id, {", ".join(sel)}
FROM lab l {" ".join(joins)}"""


def natural_join_sql() -> str:
    return """
SELECT fold_id, instance_id, user_first
FROM (SELECT fold_id, instance_id, user_id, context_timestamp FROM lab)
NATURAL LEFT JOIN (SELECT fold_id, user_id, min(context_timestamp) AS context_timestamp,
                          1 AS user_first FROM lab GROUP BY fold_id, user_id)"""


def stack_sql() -> str:
    parts = [f"SELECT fold_id, instance_id, is_trade FROM lab WHERE fold_id = {f}"
             for f in TRAIN_FOLDS]
    return "\n" + "\nUNION ALL BY NAME\n".join(parts)


def feature_body(raw: tuple[str, ...] = ()) -> str:
    """Every engineered column joined on (fold_id, instance_id)."""
    pieces: list[tuple[str, list[str]]] = []
    for name, keys, _ in LABEL_COUNTS:
        pieces.append((label_count_sql()[f"label_counts_{name.removesuffix('_count_label')}"],
                       [name]))
    pieces.append((label_ratio_sql(), [o for o, _, _ in LABEL_RATIOS]))
    for p, keys in RANK_KEYS:
        pieces.append((rank_select(p, keys), [f"{p}_rank_up", f"{p}_rank_down"]))
    pieces.append((hourly_sql(extra=False), [o for o, _ in HOURLY_COUNTS]))
    for p, keys in FLAG_KEYS:
        pieces.append((flag_select(p, keys), [f"{p}_first", f"{p}_last"]))
    for p, keys in HISTORY_KEYS:
        pieces.append((history_select(p, keys), [f"{p}_{m}" for m in MEASURES]))
    joins, cols = [], {}
    for i, (body, names) in enumerate(pieces):
        joins.append(f"LEFT JOIN {as_subquery(body)} f{i} USING (fold_id, instance_id)")
        for n in names:
            cols[n] = f"f{i}.{n}"
    order = [*LABEL_FEATURES, *[f"{p}_{m}" for p, _ in HISTORY_KEYS for m in MEASURES]]
    sel = ",\n       ".join(f"{cols[c]} AS {c}" for c in order)
    return f"""
SELECT l.fold_id, l.instance_id, l.is_trade, l.item_category_list_2,
       l.predict_category_property_rank, l.item_category_count,{"".join(f" l.{r}," for r in raw)}
       {sel}
FROM lab l
{chr(10).join(joins)}"""


def feature_sql() -> str:
    return feature_body()


def correlation_sql() -> str:
    rows = []
    for c in MODEL_FEATURES:
        x = f"CAST(concat('0x', substr(md5({c}), 1, 13)) AS BIGINT)" if c in TEXT else c
        r = f"round(corr(CAST({x} AS DOUBLE), CAST(is_trade AS DOUBLE)), 6)"
        rows.append(f"SELECT '{c}' AS feature, CASE WHEN isnan({r}) THEN NULL ELSE {r} END AS corr "
                    f"FROM ft")
    body = "\nUNION ALL\n".join(rows)
    return f"""
, ft AS (SELECT * FROM {as_subquery(feature_body(RAW))} x WHERE fold_id IN {tuple(TRAIN_FOLDS)}),
cs AS ({body})
SELECT feature, corr, coalesce(corr >= -0.2, true) AS keep FROM cs"""


def balanced_sql() -> str:
    return f"""
SELECT fold_id, instance_id, is_trade FROM lab
WHERE fold_id IN {tuple(TRAIN_FOLDS)}
  AND (is_trade = 0
       OR CAST(concat('0x', substr(md5(CAST(instance_id AS VARCHAR)), 1, 8)) AS BIGINT) % 6
          IN (0, 1, 2))"""


_BASELINE = f"""
, base AS (
  SELECT fold_id, instance_id, is_trade, coalesce(item_buy_ratio, 0.0) AS predicted_score
  FROM {as_subquery(history_select("item", ("item_id",)))} h JOIN lab USING (fold_id, instance_id)
)"""


def log_loss_sql() -> str:
    eps = "CAST(1e-15 AS DOUBLE)"
    return _BASELINE + f"""
, clipped AS (
  SELECT fold_id, CAST(is_trade AS DOUBLE) AS y,
         least(greatest(predicted_score, {eps}), 1.0 - {eps}) AS p
  FROM base WHERE fold_id IN {tuple(TRAIN_FOLDS)}
)
SELECT fold_id, count(*) AS n, round(-avg(y * ln(p) + (1 - y) * ln(1 - p)), 6) AS log_loss
FROM clipped GROUP BY fold_id"""


def write_scores_sql() -> str:
    return _BASELINE + f"""
SELECT instance_id, predicted_score FROM base WHERE fold_id = {TEST_FOLD}"""


def digamma_sql(x: str) -> str:
    """psi(x) for x > 0: recurrence to x + 8, then the asymptotic series."""
    y = f"(({x}) + 8.0)"
    inv = f"(1.0 / ({y} * {y}))"
    series = (f"{inv} * (1.0/12 - {inv} * (1.0/120 - {inv} * (1.0/252 - {inv} * "
              f"(1.0/240 - {inv} * (1.0/132)))))")
    shift = " + ".join(f"1.0 / (({x}) + {j}.0)" for j in range(8))
    return f"(ln({y}) - 0.5 / {y} - {series} - ({shift}))"


SMOOTH_COUNTS = """
cnt AS (
  SELECT l.l_partkey AS item_id, count(*) AS imp,
         CAST(sum(CASE WHEN l.l_returnflag = 'R' THEN 1 ELSE 0 END) AS BIGINT) AS clk
  FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
  GROUP BY l.l_partkey
)"""


def smoothing_cte(alpha0=1.0, beta0=1.0, iters=1000, eps=1e-10) -> str:
    a, b = "it.a", "it.b"
    pa = digamma_sql(a)
    pb = digamma_sql(b)
    pab = digamma_sql(f"{a} + {b}")
    num_a = f"sum(CASE WHEN w = 'c' THEN n * ({digamma_sql(f'v + {a}')} - {pa}) END)"
    num_b = f"sum(CASE WHEN w = 'n' THEN n * ({digamma_sql(f'v + {b}')} - {pb}) END)"
    den = f"sum(CASE WHEN w = 'm' THEN n * ({digamma_sql(f'v + {a} + {b}')} - {pab}) END)"
    return f"""WITH RECURSIVE {SMOOTH_COUNTS},
hist AS (
  SELECT 'c' AS w, CAST(clk AS DOUBLE) AS v, count(*) AS n FROM cnt GROUP BY clk
  UNION ALL SELECT 'n', CAST(imp - clk AS DOUBLE), count(*) FROM cnt GROUP BY imp - clk
  UNION ALL SELECT 'm', CAST(imp AS DOUBLE), count(*) FROM cnt GROUP BY imp
),
it(i, a, b, done) AS (
  SELECT 0, CAST({alpha0} AS DOUBLE), CAST({beta0} AS DOUBLE), false
  UNION ALL
  SELECT i + 1, CASE WHEN conv THEN a ELSE na END, CASE WHEN conv THEN b ELSE nb END, conv
  FROM (
    SELECT i, a, b, na, nb, (abs(na - a) < {eps} AND abs(nb - b) < {eps}) AS conv
    FROM (
      SELECT it.i, it.a, it.b, it.a * {num_a} / {den} AS na, it.b * {num_b} / {den} AS nb
      FROM it, hist WHERE NOT it.done AND it.i < {iters}
      GROUP BY it.i, it.a, it.b
    )
  )
),
fit AS (SELECT a, b FROM it ORDER BY i DESC LIMIT 1)"""


def smoothing_fit_sql() -> str:
    return smoothing_cte() + "\nSELECT round(a, 6) AS alpha, round(b, 6) AS beta FROM fit"


def smoothed_rate_sql() -> str:
    return smoothing_cte() + """
SELECT item_id, imp, clk, round((clk + a) / (imp + a + b), 6) AS smoothed_rate FROM cnt, fit"""


def native_roundtrip_sql() -> str:
    """Derived log at second grain, parsed (the round trip must be lossless)."""
    return PRELUDE.replace("strftime(e.ts, '%Y-%m-%d %H:00:00')", "strftime(e.ts, '%Y-%m-%d %H:%M:%S')") + """
SELECT instance_id, context_timestamp, is_trade, item_category_list_2,
       predict_category_property_rank, item_category_count
FROM plog"""


def native_score_sql() -> str:
    """The scoring part of the log at second grain, as text was written."""
    return PRELUDE.replace("strftime(e.ts, '%Y-%m-%d %H:00:00')", "strftime(e.ts, '%Y-%m-%d %H:%M:%S')") + """
SELECT instance_id, context_timestamp, user_id, item_category_list,
       CAST(instance_id % 7 AS VARCHAR) AS extra
FROM plog WHERE context_timestamp >= '2024-01-25'"""


def digamma_query_sql() -> str:
    return f"""
WITH a AS (SELECT DISTINCT round(CAST(l_quantity AS DOUBLE) * (CAST(l_discount AS DOUBLE) + 0.01), 4) AS x
           FROM lineitem)
SELECT x, round({digamma_sql('x')}, 8) AS psi FROM a WHERE x > 0"""


def model_columns_sql() -> str:
    counts = []
    for c in MODEL_FEATURES:
        number = f"TRY_CAST({c} AS DOUBLE)"
        counts += ([(c, f"count({number})"), (f"{c}_code", f"count(CASE WHEN {number} IS NULL THEN {c} END)")]
                   if c in TEXT else [(c, f"count({c})")])
    rows = "\nUNION ALL\n".join(
        f"SELECT CAST({i} AS INT) AS position, '{c}' AS feature, {n} AS n_present FROM ft"
        for i, (c, n) in enumerate(counts, 1))
    return f"""
, ft AS (SELECT * FROM {as_subquery(feature_body(RAW))} x WHERE fold_id IN {tuple(TRAIN_FOLDS)})
{rows}"""


def oracle_sql() -> dict[str, str]:
    out = {"parse_categories": parse_sql()}
    out.update(fold_sql())
    out.update(history_sql())
    out.update(standalone_sql())
    out.update(label_count_sql())
    out["label_ratios"] = label_ratio_sql()
    out["hourly_counts"] = hourly_sql()
    out["hourly_distinct"] = hourly_distinct_sql()
    out["hourly_distinct_sketch"] = hourly_distinct_sql(sketch=True)
    out["landed_fold_labels"] = out["fold_labels"]
    out.update(rank_sql())
    out.update(flag_sql())
    out["predicted_rank_counts"] = predicted_rank_sql()
    out["natural_left_join"] = natural_join_sql()
    out["stack_folds"] = stack_sql()
    out["feature_table"] = feature_sql()
    out["correlation_screen"] = correlation_sql()
    out["balanced_sample"] = balanced_sql()
    out["log_loss"] = log_loss_sql()
    out["write_scores"] = write_scores_sql()
    out["model_columns"] = model_columns_sql()
    full = {k: PRELUDE + v for k, v in out.items()}
    full["native_log_roundtrip"] = native_roundtrip_sql()
    full["native_score_log"] = native_score_sql()
    full["digamma"] = digamma_query_sql()
    full["smoothing_fit"] = smoothing_fit_sql()
    full["smoothed_rate"] = smoothed_rate_sql()
    return full
