import random

from clickfold.llm.common import components, running_before, words
from tests.conftest import rows


def test_words_are_split_at_ascii_white_space_only(spark):
    df = spark.createDataFrame([(" a\x0bb c\td ",), ("",), (None,), (" \n",)], "t string")
    got = [r[0] for r in df.select(words(df.t)).collect()]
    assert got == [["a", "b c", "d"], [], [], []]


def test_components_match_union_find(spark):
    r = random.Random(5)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(170)]
    edges += [(i, i + 1) for i in range(400, 460)] + [(500, k) for k in range(501, 560)] + [(7, 7)]
    up = {}

    def root(i):
        while up.setdefault(i, i) != i:
            i = up[i]
        return i

    for a, b in edges:
        if a != b:
            x, y = sorted((root(a), root(b)))
            up[y] = x
    got = dict(rows(components(spark.createDataFrame(edges, "a long, b long")), "node", "component"))
    assert got == {k: root(k) for k in up}


def test_components_of_nothing(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_running_before_is_a_prefix_sum(spark):
    r = random.Random(3)
    data = [(g, r.randrange(1 << 60), r.randrange(9), i) for i, g in enumerate([1] * 200 + [2] * 3)]
    df = spark.createDataFrame(data, "g long, k long, v long, i long")
    got = {x["i"]: x["before"] for x in running_before(df, "g", "k", "v", ["i"], "before").collect()}
    for g in (1, 2):
        total = 0
        for _, k, v, i in sorted((x for x in data if x[0] == g), key=lambda x: (x[1], x[3])):
            assert got[i] == total
            total += v


def test_a_worker_remembers_for_one_operator_at_a_time(tokenizers_of):
    from clickfold.llm import jaccard_join, token_memo

    path = tokenizers_of("word_bpe_49k.json")
    ids = token_memo.memo(path).encode(["one two three"])
    assert path in token_memo._memos
    sets = jaccard_join.shingles("one two three", 3).tolist()
    assert not token_memo._memos and len(jaccard_join._vocabulary) == 3
    assert token_memo.memo(path).encode(["one two three"]) == ids
    assert not jaccard_join._vocabulary
    assert jaccard_join.shingles("one two three", 3).tolist() == sets
