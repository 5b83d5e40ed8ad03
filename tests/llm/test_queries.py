import duckdb
import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMALL

TABLES = ("documents", "embeddings", "conversations", "pages", "labels")


def test_every_operator_is_registered():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in entry.queries() and "pipeline" not in entry.oracle_sql()


@pytest.mark.parametrize("name", [n for n in entry.oracle_sql() if n.startswith("op")])
def test_matches_duckdb(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    df = entry.queries()[name](spark, SF_SMALL)
    rel = con.execute(entry.oracle_sql()[name])
    cols = [d[0] for d in rel.description]
    assert sorted(df.columns) == sorted(cols)
    want = sorted((dict(zip(cols, r)) for r in rel.fetchall()), key=lambda r: str(sorted(r.items())))
    got = sorted((r.asDict() for r in df.collect()), key=lambda r: str(sorted(r.items())))
    assert got == want
