"""Periodic runs against a plain version, and their cases."""

import random

import pytest

from clickfold.llm import periodic_runs
from clickfold.llm.suffix_runs import Extensions, runs
from tests.llm.conftest import no_documents, odd_documents, prose


def plain(s, least=2, times=2):
    """All runs by comparing every pair of places."""
    n, spans = len(s), {}
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and s[j] == s[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, times * q):
                spans.setdefault((i, j - i + q), q)     # q ascends: the smallest stays
            i = max(j, i + 1)
    return sorted(((i, n, q) for (i, n), q in spans.items()), key=lambda r: (r[0], r[2]))


def sequence(r):
    s = [r.randint(1, r.choice([1, 2, 3])) for _ in range(r.randrange(0, 40))]
    if r.random() < 0.6 and s:
        p = r.randrange(1, 9)
        s = s[len(s) // 2:] + (s[:p] * 20)[:r.randrange(1, 70)] + s
    return s


def test_runs_match_plain_version():
    r = random.Random(5)
    for _ in range(1500):
        s = sequence(r)
        assert runs(s) == plain(s)
        assert runs(s, 6, 4) == plain(s, 6, 4)


def test_common_extensions():
    r = random.Random(6)
    s = [r.randint(1, 2) for _ in range(60)]
    e = Extensions(s)
    import numpy as np
    i, j = np.triu_indices(60, 1)
    want = [next((k for k in range(60 - b) if s[a + k] != s[b + k]), 60 - b) for a, b in zip(i, j)]
    assert e.common(i, j).tolist() == want


def test_regions_leave_out_no_run():
    r = random.Random(7)
    texts = []
    for _ in range(400):
        parts = [sequence(r) for _ in range(r.randrange(1, 4))]
        texts.append(b" ".join(b"w%d" % x + (b"" if k % 2 else b"z") for k, p in enumerate(parts)
                               for x in [*p, 100 + k, 200 + k]))
    for text, where in zip(texts, periodic_runs.regions(texts)):
        words = text.split()
        assert periodic_runs.text_runs(words, where) == plain(words, 6, 4)


@pytest.mark.parametrize("n", [5, 6, 40_000])
def test_one_word_repeated(n):
    words = [b"a"] * n
    where = periodic_runs.regions([b" ".join(words)])[0]
    assert periodic_runs.text_runs(words, where) == ([(0, n, 1)] if n >= 6 else [])


def test_best_run_is_exact_and_first():
    assert periodic_runs.best_run([(0, 8, 2), (9, 13, 3), (40, 26, 6)]) == 1
    assert periodic_runs.best_run([(0, 8, 2), (9, 12, 3)]) == 0
    assert periodic_runs.best_run([]) is None


def test_find_runs(spark):
    text = "x " + "a b c " * 5 + "a  b\n y " + "z " * 6
    df = spark.createDataFrame([(1, text), (2, prose(1, 30_000)), (1, text), (3, "q r " * 2000)],
                               "doc_id long, text string")
    got = {r.doc_id: r for r in periodic_runs.find_runs(df).collect()}
    assert [tuple(r) for r in got[1].runs] == [(1, 17, 3), (19, 6, 1)]
    assert got[1].collapsed == "x a b c y z" and got[1].best == 1 and got[1].n_words == 25
    assert got[2].runs == [] and got[2].best is None and got[2].collapsed == prose(1, 30_000)
    assert got[3].collapsed == "q r"


def test_odd_documents(spark):
    docs = odd_documents(spark)
    got = periodic_runs.find_runs(docs).collect()
    assert len(got) == docs.count()
    for r, d in zip(got, docs.collect()):
        words = (d.text or "").encode().split()
        assert r.doc_id == d.doc_id and r.n_words == len(words)
        if len(words) < 1000:
            assert [tuple(x) for x in r.runs] == plain(words, 6, 4)
    assert periodic_runs.find_runs(no_documents(spark)).collect() == []
