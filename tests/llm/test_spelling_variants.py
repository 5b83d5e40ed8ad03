"""Spelling variants against a plain version, and their cases."""

import random
import re
import zlib
from collections import Counter

from clickfold.llm import spelling_variants
from tests.llm.conftest import no_documents, odd_documents


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain(counts, least_length=6, least_count=5, ratio=5):
    v = {w: n for w, n in counts.items() if len(w) >= least_length and n >= least_count}
    near = {w: [x for x in v if one_edit(w, x)] for w in v}
    form = {}
    for w in v:
        best = min(near[w], key=lambda x: (-v[x], x), default=None)
        form[w] = best if best is not None and v[best] >= ratio * v[w] else None
    rows = []
    for w in v:
        root = w
        while form[root] is not None:
            root = form[root]
        rows.append((w, form[w], root, v[w], len(near[w]), v.get(form[w])))
    return sorted(rows)


def got(spark, counts):
    df = spark.createDataFrame(list(counts.items()) or [], "word string, n long")
    return sorted(tuple(r) for r in spelling_variants.variants(df).collect())


def vocabulary(seed, n):
    """Words over few letters with each other's edits, some of them nested."""
    r = random.Random(seed)
    words = {"".join(r.choice("abé") for _ in range(r.randrange(5, 10))) for _ in range(n)}
    for w in list(words):
        for _ in range(2):
            i = r.randrange(len(w) + 1)
            words.add(r.choice([w[:i] + w[i + 1:], w[:i] + "z" + w[i:], w[:i] + "ÿ" + w[i + 1:], w + "a"]))
    return {w: r.choice([4, 5, 6, 25, 30, 200, 1000]) for w in words}


def test_matches_plain_version(spark):
    counts = vocabulary(3, 150)
    want = plain(counts)
    assert got(spark, counts) == want
    assert sum(r[4] for r in want) > 200 and any(r[2] not in (r[0], r[1]) for r in want)


def test_long_words_share_levels(spark):
    base = "".join(random.Random(4).choice("abcd") for _ in range(90))
    words = [base, base + "x", base[1:], "x" + base, base[:45] + "q" + base[46:], base[:70] + base[71:],
             base[:70] + "yy" + base[72:], "abcdef", "abcdeg", "bcdefg"]
    counts = {w: 10 ** (1 + i % 3) for i, w in enumerate(words)}
    assert got(spark, counts) == plain(counts)


def test_no_words(spark):
    assert got(spark, {}) == []
    assert got(spark, {"abcdef": 4, "abc": 100}) == []
    assert spelling_variants.variants(
        spelling_variants.word_counts(no_documents(spark))).collect() == []


def test_counts_and_planted_damage(spark):
    docs = odd_documents(spark)
    texts = [(1, "Straße ÀB×c ABCdef_abcDEF 12 naïve-word"), (1, "abcdef"), (None, "abcdef ABCDEF")]
    docs = docs.select("doc_id", "text").unionAll(spark.createDataFrame(texts, "doc_id long, text string"))
    want = Counter()
    for r in docs.collect():
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r.text or "")
        for w in re.findall("[A-Za-zÀ-ÿ]+", low):
            h = zlib.crc32(f"{r.doc_id}:{w}".encode())
            if r.doc_id is not None and h % 7 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            if len(w) >= 3:
                want[w] += 1
    assert dict(map(tuple, spelling_variants.word_counts(docs, 3, damage=7).collect())) == want
    assert "Àb×c" in want
