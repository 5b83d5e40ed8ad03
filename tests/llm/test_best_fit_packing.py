import struct

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from clickfold.llm import best_fit_packing as P
from clickfold.llm.token_memo import Memo
from tests.llm.conftest import ODD_TEXTS, no_documents, odd_documents


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=80))
def test_plan_uses_every_piece_once(lengths):
    counts = np.bincount(np.array(lengths, int), minlength=41)
    plan = P.pack_lengths(counts, 40)
    used = np.zeros(41, int)
    for items, often in plan:
        assert often > 0 and sum(items) <= 40
        np.add.at(used, items, often)
    assert (used[1:] == counts[1:]).all()


def test_exact_complements_of_one_two_and_three():
    def n(lengths, size=100):
        return sum(o for _, o in P.pack_lengths(np.bincount(lengths, minlength=size + 1), size))

    assert n([60] * 5 + [40] * 5) == 5
    assert n([50] * 6) == 3
    assert n([70, 20, 10] * 4) == 4
    assert n([61, 19, 13, 7] * 3) == 3
    assert n([100] * 2) == 2 and n([51] * 3) == 3


def test_nearly_full_at_size():
    rng = np.random.default_rng(3)
    lengths = np.clip(rng.lognormal(6, 1, 20_000).astype(int), 1, 4096)
    plan = P.pack_lengths(np.bincount(lengths, minlength=4097))
    assert sum(o for _, o in plan) <= -(-int(lengths.sum()) // 4096) + 2


def _check(df, packed, tokenizer, size):
    memo, want = Memo(tokenizer), {}
    for r in df.collect():
        ids = memo.encode([r["text"]])[0] + struct.pack("<I", P.END_ID)
        want.setdefault(r["doc_id"], []).append(ids)
    got = packed.collect()
    places, pieces = {}, {}
    for r in got:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        pieces.setdefault(r["doc_id"], []).append((r["piece"], r["start"], r["length"], r["ids_crc32"]))
        assert r["piece"] * size == r["start"] and (r["length"] <= size)
    for spans in places.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= size
    import zlib
    for d, texts in want.items():
        cut = sorted((k, i // 4, len(t[i:i + 4 * size]) // 4, zlib.crc32(t[i:i + 4 * size]))
                     for t in texts for k, i in enumerate(range(0, len(t), 4 * size)))
        assert cut == sorted(pieces[d])
    return got


def test_documents(spark, tokenizers_of):
    path = tokenizers_of("word_bpe_49k.json")
    df = odd_documents(spark).repartition(3)
    packed = P.pack_documents(df, path, size=64, with_ids=True)
    got = _check(df, packed, path, 64)
    assert len({r["doc_id"] for r in got}) == len(ODD_TEXTS) + 1
    whole = {r["sequence_id"]: r for r in P.sequences(packed).collect()}
    by = {}
    for r in sorted(got, key=lambda r: r["offset"]):
        by[r["sequence_id"]] = by.get(r["sequence_id"], b"") + bytes(r["ids"])
    assert {k: bytes(r["ids"]) for k, r in whole.items()} == by
    total = sum(r["length"] for r in got)
    assert len(by) <= -(-total // 64) + 2
    assert P.pack_documents(no_documents(spark), path).count() == 0


def test_hot_length(spark, tokenizers_of):
    df = spark.createDataFrame([(i, "same words here") for i in range(300)], "doc_id long, text string")
    _check(df, P.pack_documents(df, tokenizers_of("word_bpe_49k.json"), size=16),
           tokenizers_of("word_bpe_49k.json"), 16)
