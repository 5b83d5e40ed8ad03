"""Property tests (hypothesis): tie-averaged ranks and flags equal pandas'
reading of the reference semantics on generated groups."""

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clickfold.operators.label import key_stats

ROWS = st.lists(st.tuples(st.integers(0, 3), st.integers(0, 5)), min_size=1, max_size=40)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(ROWS)
def test_ranks_and_flags_match_pandas(spark, data):
    pdf = pd.DataFrame(data, columns=["k", "sec"])
    pdf["rid"] = range(len(pdf))
    pdf["ts"] = (pd.Timestamp("2024-01-01") + pd.to_timedelta(pdf.sec, unit="s")).dt.strftime(
        "%Y-%m-%d %H:%M:%S")
    up = pdf.groupby("k")["ts"].rank(ascending=True)
    down = pdf.groupby("k")["ts"].rank(ascending=False)
    n = pdf.groupby("k")["ts"].transform("size")
    first = pdf.ts == pdf.groupby("k")["ts"].transform("min")
    last = pdf.ts == pdf.groupby("k")["ts"].transform("max")
    exp = {}
    for i in range(len(pdf)):
        single = n[i] == 1
        exp[i] = (up[i], down[i], -1 if single else int(first[i]), -1 if single else int(last[i]))

    df = (spark.createDataFrame([(int(r.rid), int(r.k), r.ts) for r in pdf.itertuples()],
                                "rid long, k long, ts string")
          .withColumn("fold_id", F.lit(1))
          .withColumn("context_timestamp", F.to_timestamp_ntz("ts")))
    stats = key_stats(df, ["k"], "k", ranks=True, flags=True)
    got = {r["rid"]: (r["k_rank_up"], r["k_rank_down"], r["k_first"], r["k_last"])
           for r in df.join(stats, ["fold_id", "k", "context_timestamp"], "left").collect()}
    assert got == exp
