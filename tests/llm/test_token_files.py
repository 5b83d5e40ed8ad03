import io
import random
import struct
import zlib

import pyarrow as pa
import pytest

from clickfold.llm import token_files as K
from clickfold.llm.token_memo import Memo, text_slices
from tests.llm.conftest import ODD_TEXTS, no_documents, odd_documents

ODD = ["a\t  b", "x\n\n y", "  lead", "trail  ", "a  b", "é́ ́x", "a's 'll\x1c y", "ΑΣ ΑΣ. İ",
       "<|endoftext|> a<|endoftext|>B <|ENDOFTEXT|>", " ", "\n\n", "a\0b c", "\x85  x", "A B\tC"]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_memo_gives_the_ids_of_whole_texts(tokenizers_of, name):
    memo = Memo(tokenizers_of(name))
    texts = ODD + [t for t in ODD_TEXTS]
    for _ in range(2):
        got = memo.encode(texts)
        for t, ids in zip(texts, got):
            want = memo.tokenizer.encode(t or "", add_special_tokens=False).ids
            assert ids == struct.pack(f"<{len(want)}I", *want), repr(t)[:60]


def test_memo_forgets_and_stays_right(tokenizers_of, monkeypatch):
    from clickfold.llm import token_memo
    monkeypatch.setattr(token_memo, "MEMO_SIZE", 20)
    memo = Memo(tokenizers_of("byte_bpe_50k.json"))
    for k in range(30):
        text = " ".join(f"w{i % 13} v{i}" for i in range(k, k + 9))
        assert memo.encode([text])[0] == struct.pack(
            "<%dI" % len(w := memo.tokenizer.encode(text).ids), *w)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_memo_of_a_column_gives_the_ids_of_whole_texts(tokenizers_of, name):
    memo, rng = Memo(tokenizers_of(name)), random.Random(5)
    parts = [*" \n.,;:!?|'<>#&", *"aZé\u0301Σİß9\t\x0b\x1c\x85\u3000\0漢", "  ", "\n\n", "ab", " The", "'s",
             "'LL", "word", "<|endoftext|>", "<|startoftext|>", "<|", "x" * 60, "e.g.", "...", "3,5"]
    texts = ["".join(rng.choices(parts, k=rng.randrange(14))) for _ in range(3000)]
    texts[::7] = [None] * len(texts[::7])
    batch = pa.RecordBatch.from_pydict({"text": pa.array(texts)}).slice(5)
    slices = [memo.encode(x.column("text")) for x in text_slices([batch], limit=4000)]
    assert len(slices) > 5
    for t, ids in zip(texts[5:], sum(slices, []), strict=True):
        want = memo.tokenizer.encode(t or "", add_special_tokens=False).ids
        assert ids == struct.pack(f"<{len(want)}I", *want), repr(t)


def test_memo_looks_up_distinct_pieces_only(tokenizers_of):
    class Counting(dict):
        n, missing = 0, []

        def get(self, *x):
            Counting.n += 1
            return super().get(*x)

        def __getitem__(self, x):
            Counting.n += 1
            return super().__getitem__(x)

    memo = Memo(tokenizers_of("byte_bpe_50k.json"))
    texts = ["It was, as it was. " * 500] * 20
    want = memo.encode(texts)
    memo.seen = Counting(memo.seen)
    assert memo.encode(texts) == want and Counting.n < 50


def _file(docs, frame_bytes=64):
    out = io.BytesIO()
    w = K.ShardWriter(out, frame_bytes)
    for d, ids in docs:
        w.add(d, struct.pack(f"<{len(ids)}I", *ids))
    w.close()
    return out.getvalue(), w


def test_frames_are_independent_and_checked():
    docs = [(None, [1]), (None, []), *((i, list(range(i))) for i in range(40)), (39, [5]), (39, [6])]
    data, w = _file(docs)
    r = K.ShardReader(io.BytesIO(data))
    assert w.docs == len(docs) and w.ids == sum(len(x) for _, x in docs) and w.bytes == len(data)
    back = [(d, list(struct.unpack(f"<{len(x) // 4}I", x))) for k in range(len(r.frames)) for d, x in r.frame(k)]
    assert back == docs
    assert [len(x) // 4 for x in r.documents(39)] == [39, 1, 1] and r.documents(99) == []
    # Only the frames of the document are read; a damaged one is noticed.
    f = r.frames[1]
    broken = bytearray(data)
    broken[f.offset + f.packed - 1] ^= 1
    bad = K.ShardReader(io.BytesIO(bytes(broken)))
    last = len(bad.frames) - 1
    assert list(bad.frame(last)) == list(r.frame(last))
    with pytest.raises(Exception):
        list(bad.frame(1))
    with pytest.raises(ValueError):
        K.ShardReader(io.BytesIO(data[:-1] + b"x"))


def test_any_zstandard_reader_reads_the_frames():
    import zstandard
    docs = [(i, [i, 7]) for i in range(50)]
    data, _ = _file(docs)
    raw = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True).read()
    assert raw.count(struct.pack("<I", 7)) >= 50


def test_empty_file():
    data, w = _file([])
    assert K.ShardReader(io.BytesIO(data)).frames == [] and w.docs == 0


def test_round_trip_of_documents(spark, tokenizers_of):
    path = tokenizers_of("byte_bpe_50k.json")
    df = odd_documents(spark)
    files = K.write_files(df.repartition(4), path, frame_bytes=500)
    got = sorted(((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"])
                  for r in K.read_files(files).collect()), key=lambda x: x[1])
    memo = Memo(path)
    ids = {}
    for r in df.collect():
        ids.setdefault(r["doc_id"], []).append(memo.encode([r["text"]])[0] + b"\0\0\0\0")
    assert sum(n for _, _, n, _ in got) == sum(len(x) // 4 for v in ids.values() for x in v)
    keys = [(d is not None, d or 0) for d, *_ in got]
    assert keys == sorted(keys) and len(got) == len(ODD_TEXTS) + 4
    at = 0
    for d, start, n, crc in got:
        assert start == at and (n, crc) in [(len(x) // 4, zlib.crc32(x)) for x in ids[d]]
        at += n
    found = K.fetch(files, [13, 3, 77])
    assert [struct.pack(f"<{len(x)}I", *x) for x in found[13]] == ids[13]
    assert len(found[3]) == 3 and found[77] == []
    empty = K.write_files(no_documents(spark), path)
    assert empty.count() == 0 and K.read_files(empty).count() == 0
