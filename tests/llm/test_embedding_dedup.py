import math
import random

import pytest

from clickfold.llm import embedding_dedup as D

SCHEMA = "vec_id long, embedding array<float>, label int, n_links long, digest string"


def brute(rows):
    def usable(v, label):
        return (label is not None and v and all(x is not None and math.isfinite(x) for x in v)
                and any(v))

    def cos(x, y):
        return sum(a * b for a, b in zip(x, y)) / math.sqrt(
            sum(a * a for a in x)) / math.sqrt(sum(b * b for b in y))

    n, comp, links = len(rows), list(range(len(rows))), [0] * len(rows)
    for i in range(n):
        for j in range(i):
            (_, x, lx), (_, y, ly) = rows[i], rows[j]
            if usable(x, lx) and usable(y, ly) and lx == ly and len(x) == len(y) and cos(x, y) >= 0.93:
                links[i] += 1
                links[j] += 1
                a, b = comp[i], comp[j]
                comp = [b if c == a else c for c in comp]
    name = {}
    for i, c in enumerate(comp):
        if rows[i][0] is not None:
            name[c] = min(name.get(c, rows[i][0]), rows[i][0])
    return sorted(((r[0], links[i], name.get(comp[i])) for i, r in enumerate(rows)), key=repr)


def vectors(seed=1, n=150, dim=6):
    import struct
    r, rows = random.Random(seed), []
    single = lambda x: struct.unpack("f", struct.pack("f", x))[0]
    for i in range(n):
        v = [single(r.gauss(0, 1)) for _ in range(dim)]
        if i % 3 and rows:
            v = [single(x + r.gauss(0, 0.12)) for x in rows[-1][1]]
        rows.append((1000 - i, v, i % 2 if i % 11 else 5))
    rows += [(2000 + i, [single(x * 2) for x in rows[4][1]], rows[4][2]) for i in range(12)]
    rows += [(3000 + i, rows[7][1], rows[7][2]) for i in range(8)]
    return rows


@pytest.mark.parametrize("cell,most", [(512, 2048), (9, 2048), (9, 4), (3, 2048)])
def test_matches_brute_force(spark, monkeypatch, cell, most):
    monkeypatch.setattr(D, "CELL", cell)
    monkeypatch.setattr(D, "MAX_PIVOTS", most)
    rows = vectors()
    df = spark.createDataFrame([(*r, 0, "x") for r in rows], SCHEMA).repartition(3)
    got = D.dedup(df).collect()
    assert sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in got), key=repr) == brute(rows)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got)


def test_tight_clump_is_not_compared_pair_by_pair(spark, monkeypatch):
    """Whole cells inside the radius are counted without a comparison."""
    monkeypatch.setattr(D, "CELL", 8)
    r = random.Random(3)
    rows = [(i, [1.0 + r.gauss(0, 0.01), r.gauss(0, 0.01), r.gauss(0, 0.01)], 1) for i in range(60)]
    df = spark.createDataFrame([(*x, 0, "x") for x in rows], SCHEMA)
    got = D.dedup(df).collect()
    assert {(x["n_links"], x["component_id"]) for x in got} == {(59, 0)}


def test_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None, 1), (2, [], 1), (3, [0.0, 0.0], 1), (4, [1.0, None], 1), (5, [1.0, nan], 1),
            (6, [1.0, inf], 1), (7, [1.0, 1.0], None), (8, [1.0, 1.0], None), (9, [1.0, 2.0], 1),
            (10, [1.0, 2.0, 0.0], 1), (11, [2.0, 4.0], 1), (11, [2.0, 4.0], 1), (None, [1.0, 2.0], 1),
            (13, [-1.0, -2.0], 1), (14, [0.0, 1.0], 2), (15, [-0.0, 1.0], 2), (None, None, None)]
    df = spark.createDataFrame([(*r, 0, "x") for r in rows], SCHEMA)
    got = D.dedup(df)
    found = sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in got.collect()), key=repr)
    want = brute(rows)
    assert [x for x in found if x[0] is not None] == [x for x in want if x[0] is not None]
    assert sorted(x[1] for x in found if x[0] is None) == [0, 3]
    assert D.dedup(df.where("1 = 0")).count() == 0


@pytest.mark.parametrize("most", [2048, 0])
def test_no_task_holds_a_whole_label(spark, monkeypatch, tmp_path, most):
    """One label in which no bound rules out a cell (or without pivots): both
    sides of a cell are cut, so a task holds far less than the label."""
    join = D._join_chunk

    def recorded(least):
        run, folder = join(least), str(tmp_path)

        def sized(key, table):
            import uuid
            with open(f"{folder}/{uuid.uuid4().hex}", "w") as f:
                f.write(str(table.num_rows))
            return run(key, table)

        return sized

    monkeypatch.setattr(D, "CELL", 4)
    monkeypatch.setattr(D, "MAX_PIVOTS", most)
    monkeypatch.setattr(D, "_join_chunk", recorded)
    r = random.Random(5)
    rows = [(i, [r.gauss(0, 1) for _ in range(64)], 1) for i in range(240)]
    rows += [(1000 + i, [x + r.gauss(0, 0.05) for x in rows[i][1]], 1) for i in range(60)]
    df = spark.createDataFrame([(*x, 0, "x") for x in rows], SCHEMA)
    got = D.dedup(df).collect()
    assert sorted(((x["vec_id"], x["n_links"], x["component_id"]) for x in got), key=repr) == brute(rows)
    sizes = [int(p.read_text()) for p in tmp_path.iterdir()]
    assert max(sizes) < 100 < len(rows)
