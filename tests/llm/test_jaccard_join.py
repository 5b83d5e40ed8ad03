import random

import numpy as np
import pytest

from clickfold.llm import jaccard_join as J
from tests.llm.conftest import ODD_TEXTS, no_documents, odd_documents, prose


def brute(docs, width, percent):
    """Component per document by comparing all pairs of word n-gram sets."""
    sets = {}
    for i, (d, t) in enumerate(docs):
        w = (t or "").encode().lower().split()
        grams = {tuple(w[k:k + width]) for k in range(len(w) - width + 1)} or ({tuple(w)} if w else set())
        sets[i] = (d, grams)
    comp = {i: i for i in sets}
    for i, (_, a) in sets.items():
        for j, (_, b) in sets.items():
            both = len(a & b)
            if i < j and a and b and 100 * both >= percent * (len(a) + len(b) - both):
                old, new = comp[j], comp[i]
                comp = {k: new if c == old else c for k, c in comp.items()}
    names = {}
    for i, c in comp.items():
        names.setdefault(c, []).append(sets[i][0])
    return {i: (sets[i][0], len(sets[i][1]), min(names[c])) for i, c in comp.items()}


def edited(text, k, seed):
    r, w = random.Random(seed), text.split()
    for _ in range(k):
        w[r.randrange(len(w))] = f"new{r.randrange(10 ** 6)}"
    return " ".join(w)


def corpus():
    passage = prose(99, 60)
    docs, r = [], random.Random(4)
    for g in range(12):
        base = prose(100 + g, r.randrange(5, 220))
        docs += [base] * (g % 3) + [edited(base, k, g * 50 + k) for k in range(6)]
    docs += [prose(500 + i, 50) + " " + passage for i in range(30)]       # share a passage only
    docs += [edited(prose(7, 120), 1 + k % 3, 900 + k) for k in range(60)]  # many near copies
    r.shuffle(docs)
    return list(enumerate(docs, 10))


@pytest.mark.parametrize("width,percent", [(3, 90), (5, 80)])
def test_matches_brute_force(spark, monkeypatch, width, percent):
    docs = corpus()
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    want = sorted(brute(docs, width, percent).values())
    got = sorted(tuple(r)[:3] for r in J.join(df, width, percent).collect())
    assert got == want


def test_large_blocks_match_brute_force(spark, monkeypatch):
    """Small sub-blocks, so that pivots and the cross comparison decide."""
    monkeypatch.setattr(J, "BLOCK", 5)
    monkeypatch.setattr(J, "PIVOTS", 2)
    monkeypatch.setattr(J, "CROSS", 7)
    docs = corpus()
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = sorted(tuple(r)[:3] for r in J.join(df, 5, 80).collect())
    assert got == sorted(brute(docs, 5, 80).values())


def test_sets_that_link_share_a_key():
    """Whatever is called frequent, linked sets meet in a key."""
    r = random.Random(1)
    for percent in (60, 80, 90):
        for n in (1, 2, 5, 9, 10, 30, 100, 700):
            for _ in range(12):
                x = {r.getrandbits(64) for _ in range(n)}
                y = set(x)
                for h in r.sample(sorted(x), r.randrange(0, max(1, n * (100 - percent) // 100) + 1)):
                    y.discard(h)
                    if r.random() < 0.5:
                        y.add(r.getrandbits(64))
                if 100 * len(x & y) < percent * len(x | y) or x == y:
                    continue
                hot = np.array(sorted(r.sample(sorted(x), r.randrange(0, n + 1))), np.uint64)
                cuts = J.Cuts(percent, hot)
                a, b = (set(cuts.keys(np.array(sorted(s), np.uint64)).tolist()) for s in (x, y))
                assert a & b, (percent, n)


def test_tree_prunes_no_similar_pair():
    r = random.Random(2)
    sets = []
    for g in range(25):
        base = [r.getrandbits(64) for _ in range(r.randrange(1, 120))]
        for _ in range(4):
            s = {h for h in base if r.random() > 0.05} or {base[0]}
            sets.append(np.array(sorted(s), np.uint64))
    a, b = J.Tree.of(sets).pairs(80)
    found = {frozenset(p) for p in zip(a.tolist(), b.tolist())}
    for i in range(len(sets)):
        for j in range(i):
            assert not J.similar(sets[i], sets[j], 80) or frozenset((i, j)) in found
    assert len(found) < len(sets) * (len(sets) - 1) / 4      # and most others


def test_cases(spark):
    got = [tuple(r) for r in J.join(odd_documents(spark), 3, 90).collect()]
    assert len(got) == len(ODD_TEXTS) + 4
    by = {}
    for d, n, c, _ in got:
        by.setdefault(d, set()).add((n, c))
    assert by[0] == {(0, 0)} and by[1] == {(0, 1)} and by[2] == {(0, 2)}
    assert by[3] == {(1, 3)} and by[4] == {(1, 4)} and by[5] == {(1, 4)}
    assert by[10] == {(58, 10)} == by[11] and by[None] == {(1, 3), (0, None)}
    assert J.join(no_documents(spark)).count() == 0


def test_keep_one(spark):
    df = odd_documents(spark)
    kept = J.keep_one(df, 3, 80)
    assert kept.columns == df.columns
    ids = sorted((r["doc_id"] for r in kept.collect()), key=lambda x: (x is None, x))
    assert ids == [0, 1, 2, 3, 4, 6, 7, 8, 9, 10, 13, 14, None]


def test_a_row_without_doc_id_bridges(spark):
    """A - N - C: the ends link through a row whose doc_id is NULL."""
    words = [f"w{i}" for i in range(140)]
    n = " ".join(words[:-6])
    a, c = " ".join(words), " ".join(words[6:-6])
    sets = [set(J.shingles(t, 5).tolist()) for t in (a, n, c)]
    least = [len(x & y) / len(x | y) for x, y in ((sets[0], sets[1]), (sets[1], sets[2]))]
    percent = int(100 * min(least))
    assert 100 * len(sets[0] & sets[2]) < percent * len(sets[0] | sets[2])
    df = spark.createDataFrame([(5, a), (None, n), (9, c)], "doc_id long, text string")
    assert {(r[0], r[2]) for r in J.join(df, 5, percent).collect()} == {(5, 5), (None, 5), (9, 5)}
    assert [tuple(r) for r in J.keep_one(df, 5, percent).collect()] == [(5, a)]


def test_two_texts_under_one_doc_id_both_stay(spark):
    rows = [(7, prose(1, 80)), (7, prose(2, 80)), (7, prose(2, 80)), (None, prose(3, 80)),
            (None, edited(prose(3, 80), 1, 5)), (None, prose(4, 80)), (8, prose(2, 80))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = sorted((str(d), t) for d, t in J.keep_one(df, 5, 80).collect())
    texts = {t for _, t in kept}
    assert len(kept) == 4 and [d for d, _ in kept] == ["7", "7", "None", "None"]
    assert {prose(1, 80), prose(2, 80), prose(4, 80)} < texts


def test_screen_keeps_every_linked_document(spark):
    """Folded bitmaps of several lengths exclude no pair that links."""
    r, sets = random.Random(8), []
    for g in range(20):
        base = [r.getrandbits(64) for _ in range(r.randrange(60, 180))]
        sets += [np.array(sorted(h for h in base if r.random() > 0.05), np.uint64) for _ in range(4)]
    maps = J.fold([J.bitmap(s, J.map_bits(2 * len(s))) for s in sets])
    n = np.array([len(s) for s in sets])
    a, b = J.Tree(maps, n, *np.array([J.smallest(s) for s in sets], np.uint64).T).pairs(80)
    found = {frozenset(p) for p in zip(a.tolist(), b.tolist())}
    for i in range(len(sets)):
        for j in range(i):
            assert not J.similar(sets[i], sets[j], 80) or frozenset((i, j)) in found
    assert len(found) < len(sets) * 8


def test_traversal_opens_few_pairs_at_a_time(monkeypatch):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 60, np.int64).astype(np.uint64)
    sets = [np.unique(np.concatenate([base[i % 3:], rng.integers(0, 1 << 63, 6, np.int64).astype(np.uint64)]))
            for i in range(200)]
    tree = J.Tree.of(sets)
    whole = set(zip(*(x.tolist() for x in tree.pairs(80))))
    monkeypatch.setattr(J, "PAIRS", 4)
    parts = [list(zip(a.tolist(), b.tolist())) for a, b in tree.some_pairs(80)]
    assert max(map(len, parts)) <= 4 * J.Tree.FAN ** 2 < len(whole)
    got = [p for part in parts for p in part]
    assert len(got) == len(set(got)) and set(got) == whole


def test_large_blocks_of_short_texts_are_dealt_to_few_groups(spark, monkeypatch):
    """Signatures were copied to every 512 documents of a large block, which
    grew with the square of the block."""
    head = "one line that chains all of these short texts into one block of candidates "
    rows = [(i, head + f"x{i} y{i} z{i}") for i in range(2600)]
    seen, screen = [], J._screen
    monkeypatch.setattr(J, "_screen", lambda blocks, *more: seen.append(blocks.count()) or screen(blocks, *more))
    monkeypatch.setattr(J, "HOT_COUNT", 1 << 30)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = J.join(docs, 5, 80).count()
    assert got == 2600 and seen and max(seen) <= 6 * 2600


def test_texts_and_shuffles_go_behind_their_last_reader(spark, tmp_path):
    import glob
    from urllib.parse import urlparse

    from clickfold.session import drop_tables, ensure_checkpoint_dir

    drop_tables(spark)
    docs = spark.createDataFrame([(i, f"a b c d e f g h i j {i % 3}") for i in range(30)],
                                 "doc_id long, text string").repartition(4)
    J.keep_one(docs, 5, 80).count()
    at = urlparse(ensure_checkpoint_dir(spark)).path
    assert glob.glob(f"{at}/clickfold-named-*") and not glob.glob(f"{at}/clickfold-block_texts-*")
