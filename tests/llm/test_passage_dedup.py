"""Substring dedup against a plain version, and its cases."""

import random

import numpy as np
import pytest

from clickfold.llm import passage_dedup
from clickfold.llm.word_hashes import gram_hashes, word_hashes
from tests.llm.conftest import no_documents, odd_documents, prose

W = passage_dedup.WINDOW


def plain(rows):
    """Brute force: ``(doc_id, n_words, n_removed, kept)`` of every row."""
    split = [(d, (t or "").encode().split()) for d, t in rows]
    first = {}
    for d, ws in split:
        for i in range(len(ws) - W + 1):
            if d is not None:
                key = tuple(ws[i:i + W])
                first[key] = min(d, first.get(key, d))
    out = []
    for d, ws in split:
        stay = np.ones(len(ws), bool)
        for i in range(len(ws) - W + 1):
            if d is not None and first[tuple(ws[i:i + W])] < d:
                stay[i:i + W] = False
        out.append((d, len(ws), int((~stay).sum()),
                    b" ".join(w for w, s in zip(ws, stay) if s).decode()))
    return out


def check(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = [tuple(r) for r in passage_dedup.remove_repeats(df).collect()]
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(got, key=key) == sorted(plain(rows), key=key)
    return got


def corpus(seed, n):
    """Documents cut and pasted from each other, with edits and few words."""
    r = random.Random(seed)
    rows = []
    for d in range(n):
        ws = [r.choice("abcdefgh") * r.randrange(1, 3) for _ in range(r.randrange(0, 60))]
        for _ in range(r.randrange(3)):
            if rows:
                other = r.choice(rows)[1].split()
                i = r.randrange(len(other) + 1)
                part = other[i:i + r.randrange(8, 40)]
                if part and r.random() < 0.5:
                    part[r.randrange(len(part))] = "edit%d" % r.randrange(3)
                at = r.randrange(len(ws) + 1)
                ws[at:at] = part
        rows.append((r.randrange(10 * n), r.choice([" ", "\n", " \t"]).join(ws)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_matches_plain_version(spark, seed):
    got = check(spark, corpus(seed, 150))
    assert sum(r[2] for r in got) > 500


def test_later_documents_that_agree_around_an_anchor(spark):
    base = prose(3, 60).split()
    changed = base[:20] + ["new"] + base[21:]
    rows = [(1, " ".join(base)), (5, " ".join(changed)), (9, "x " + " ".join(changed) + " y"),
            (7, " ".join(changed[14:27]))]
    got = dict((r[0], r[2]) for r in check(spark, rows))
    assert got[1] == 0 and got[7] == 13 and got[9] == 60


def test_hot_passage_is_dealt_and_blocks_are_compiled(spark, monkeypatch):
    monkeypatch.setattr(passage_dedup, "STREAMS", 4)
    passage = prose(8, 30)
    rows = [(i, f"{prose(100 + i, 20)} {passage} {prose(500 + i, 20)}") for i in range(60)]
    got = check(spark, rows)
    assert sum(r[2] for r in got) >= 59 * 30


def test_periodic_long_and_repeated_rows(spark):
    rows = [(1, "a " * 5000), (2, "a " * 40), (3, "a b " * 300), (4, "b a " * 20), (4, "b a " * 20),
            (4, prose(4, 40)), (2, prose(4, 40)), (6, prose(9, 20_000)), (7, prose(9, 20_000)[500:9000])]
    check(spark, rows)


def test_odd_documents(spark):
    rows = [(r.doc_id, r.text) for r in odd_documents(spark).select("doc_id", "text").collect()]
    got = [tuple(r) for r in passage_dedup.remove_repeats(odd_documents(spark)).collect()]
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(got, key=key) == sorted(plain(rows), key=key)
    assert passage_dedup.remove_repeats(no_documents(spark)).collect() == []


def test_word_hashes_are_those_of_the_words():
    texts = [b"", b"one two  one\n", "É\t漢 one two".encode(), b" "]
    h, doc = word_hashes(texts)
    words = [w for t in texts for w in t.split()]
    assert doc.tolist() == [1, 1, 1, 2, 2, 2, 2]
    assert all((h[i] == h[j]) == (words[i] == words[j]) for i in range(7) for j in range(7))
    g = gram_hashes(h, 2)
    assert g[0] == g[5] and len(g) == 6


def test_workers_hand_on_small_batches(spark, monkeypatch):
    """Rows are unpacked and handed on in slices, whatever an Arrow batch holds."""
    import pyarrow as pa

    monkeypatch.setattr(passage_dedup, "SLICE", 100)
    monkeypatch.setattr(passage_dedup, "DIGESTS", 5)
    batch = pa.RecordBatch.from_pydict({"k": list(range(7)), "text": ["a" * 60, None, "b" * 40, "c" * 500, "", "d", None]})
    parts = list(passage_dedup._parts(batch, "text"))
    assert [p.num_rows for p in parts] == [3, 1, 3] and pa.Table.from_batches(parts).column("k").to_pylist() == list(range(7))
    assert list(passage_dedup._parts(batch.slice(0, 0), "text")) == []
    check(spark, corpus(3, 80))
