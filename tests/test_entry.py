"""Driver contract: entry() runs, every query has a callable, oracle keys
are a subset, and a sample of queries matches DuckDB at sf0.001."""


import duckdb
import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMALL

SAMPLE = ["parse_categories", "hist_user_item", "rank_shop", "first_last_context",
          "hourly_counts", "smoothing_fit", "log_loss"]


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["fold_id", "instance_id", "item_count", "item_buy_count",
                          "item_buy_ratio", "item_not_buy_count"]


def test_oracle_keys_subset():
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q)
    own = {n for n in q if not n.startswith("op") and n != "pipeline"}
    # Scores of boosted trees have no SQL form: tests/test_boosting.py has a plain version.
    assert own - set(o) == {"train_and_score", "validate"} and len(own) == 69


@pytest.mark.parametrize("name", SAMPLE)
def test_matches_duckdb(spark, name):
    con = duckdb.connect()
    for t in ("events", "part", "supplier", "customer", "orders", "lineitem"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    df = entry.queries()[name](spark, SF_SMALL)
    rel = con.execute(entry.oracle_sql()[name])
    dcols = [d[0] for d in rel.description]
    assert sorted(df.columns) == sorted(dcols)
    order = sorted(df.columns)

    def canon(rs, cols):
        idx = [cols.index(c) for c in order]
        return sorted((tuple(r[i] for i in idx) for r in rs), key=repr)

    assert canon([tuple(r) for r in df.collect()], df.columns) == canon(rel.fetchall(), dcols)


def test_query_plans_have_unique_columns(spark):
    cheap = [n for n in entry.queries() if n not in ("train_and_score", "write_scores", "validate",
                                                     "native_log_roundtrip", "native_score_log",
                                                     "landed_fold_labels",
                                                     "pipeline") and not n.startswith("op")]
    for name in cheap:
        cols = entry.queries()[name](spark, SF_SMALL).columns
        assert len(cols) == len(set(cols)), name
