import hashlib

from clickfold.llm import source_mixing as M
from tests.llm.conftest import ODD_TEXTS, no_documents, odd_documents, prose


def brute(docs):
    """(doc_id, source, size) -> taken and targets, by repeated resharing."""
    sources = sorted({s for _, s, _ in docs}, key=lambda s: (s is None, s or ""))
    size = {s: sum(z for _, x, z in docs if x == s) for s in sources}
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(sources)}
    total, target, open_ = 1.5 * sum(size.values()), {}, set(sources)
    while open_:
        left = total - sum(target.values())
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] >= 2 * size[s]}
        for s in over or set(open_):
            target[s] = 2 * size[s] if over else share[s]
        open_ -= over or set(open_)
    taken = {}
    for s in sources:
        budget, rows = int(target[s] + 1e-9), [(d, z) for d, x, z in docs if x == s]
        rows.sort(key=lambda r: (int(hashlib.md5(str(r[0]).encode()).hexdigest()[:15], 16), r))
        full = budget // size[s] if size[s] else 0
        rest = budget - full * size[s]
        for d, z in rows:
            part = min(z, rest)
            rest -= part
            taken.setdefault(d, []).append(full * z + part)
    return target, taken


def test_matches_brute_force(spark):
    texts = [(i, prose(i, 1 + (i * 37) % 150), [None, "é", "z", "a", "hot"][min(4, i % 9)])
             for i in range(120)]
    df = spark.createDataFrame(texts, "doc_id long, text string, source string").repartition(4)
    got = M.mix(df).collect()
    target, taken = brute([(r["doc_id"], r["source"], r["size"]) for r in got])
    for r in got:
        assert r["size"] == 1 + (r["doc_id"] * 37) % 150
        assert abs(r["target"] - target[r["source"]]) < 1e-6
        assert [r["taken"]] == taken[r["doc_id"]] and r["taken"] <= 2 * r["size"]
    for s in target:
        mine = sum(r["taken"] for r in got if r["source"] == s)
        assert abs(mine - target[s]) < 1
    again = {r["doc_id"]: r["taken"] for r in M.mix(df.repartition(7)).collect()}
    assert again == {r["doc_id"]: r["taken"] for r in got}


def test_mixed_documents_are_whole_and_near_the_words_taken(spark):
    texts = [(i, f" {prose(i, 20 + i)}\n\t", "ab"[i % 2], 5) for i in range(9)]
    df = spark.createDataFrame(texts, "doc_id long, text string, source string, taken long")
    want = {r["doc_id"]: (r["taken"], r["size"], r["source"]) for r in M.mix(df).collect()}
    out = M.mixed_documents(df)
    assert out.columns == df.columns
    times, original = {}, dict((i, t) for i, t, *_ in texts)
    for r in out.collect():
        times[r["doc_id"]] = times.get(r["doc_id"], 0) + 1
        assert original[r["doc_id"]] == r["text"] and r["taken"] == 5
    for source in "ab":
        mine = [(d, *v[:2]) for d, v in want.items() if v[2] == source]
        off = [times.get(d, 0) * size - taken for d, taken, size in mine]
        assert sum(x != 0 for x in off) <= 1                      # the document at the cut
        assert all(2 * abs(x) <= size for x, (_, _, size) in zip(off, mine))


def test_cases(spark):
    got = M.mix(odd_documents(spark)).collect()
    assert len(got) == len(ODD_TEXTS) + 4
    assert all(r["size"] == 0 == r["taken"] for r in got if r["doc_id"] in (0, 1, 2))
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in got)
    assert M.mixed_documents(odd_documents(spark)).columns == odd_documents(spark).columns
    assert M.mix(no_documents(spark)).count() == 0
    assert M.mixed_documents(no_documents(spark)).count() == 0
    blank = spark.createDataFrame([(1, None, "a"), (2, " ", None)], "doc_id long, text string, source string")
    assert [(r["target"], r["taken"]) for r in M.mix(blank).collect()] == [(0.0, 0)] * 2
    assert M.mixed_documents(blank).count() == 0
