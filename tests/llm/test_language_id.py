import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickfold.llm import language_id as L
from tests.llm.conftest import ODD_TEXTS, no_documents, odd_documents

SYLLABLES = {"aa": "ka lo mi su te".split(), "bb": "schr ung ich ein der".split(),
             "cc": "oui eau tion les que".split()}


def corpus(spark, n=240):
    r = random.Random(1)
    rows = []
    for i in range(n):
        lang = sorted(SYLLABLES)[i % 3]
        text = " ".join("".join(r.choice(SYLLABLES[lang]) for _ in range(r.randrange(1, 4)))
                        for _ in range(r.randrange(3, 60)))
        rows.append((i, text, lang if i % 17 else None))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_held_out_accuracy(spark):
    df = corpus(spark).repartition(3)
    out = L.identify(df).withColumnRenamed("doc_id", "d").join(df, F.col("d") == F.col("doc_id"))
    rows = out.where("lang IS NOT NULL").collect()
    held = [r for r in rows if r["held_out"]]
    assert held and sum(r["lang_pred"] == r["lang"] for r in held) >= 0.97 * len(held)
    assert all(0.0 <= r["score"] <= 1.0 for r in rows)
    import zlib
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)


def test_nothing_is_learned_from_the_test_fold(spark):
    """Other languages, sources and texts in the test fold change no prediction
    of the rest."""
    df = corpus(spark).repartition(2)
    fold = L.is_held_out(F.col("doc_id"))
    changed = df.withColumns({"lang": F.when(fold, F.lit("zz")).otherwise(F.col("lang")),
                              "text": F.when(fold, F.lit("zz zz")).otherwise(F.col("text"))})
    a = {r["doc_id"]: r for r in L.identify(df).where("NOT held_out").collect()}
    b = {r["doc_id"]: r for r in L.identify(changed).where("NOT held_out").collect()}
    assert {k: r["lang_pred"] for k, r in a.items()} == {k: r["lang_pred"] for k, r in b.items()}
    assert all(a[k]["score"] == pytest.approx(b[k]["score"], abs=1e-6) for k in a)


def test_weights_are_sparse_and_calibrated(spark):
    df = corpus(spark)
    m = L.fit(df, L.Settings(l1=0.5))
    assert m.languages == ["aa", "bb", "cc"] and m.temperature > 0
    assert (m.weights == 0).mean() > 0.9
    hotter = L.Model(m.languages, m.idf, m.weights, m.bias, m.temperature * 2, m.bits)
    z = np.array([0.03, 0.01, 0.0])
    assert hotter.scores(z).max() < m.scores(z).max()


def test_ngrams_fold_case_and_non_letters():
    a, b = (L.ngram_counts(t, 15) for t in ("Ab1-2 ÉCOLE!", "ab   école"))
    assert (a[0] == b[0]).all() and (a[1] == b[1]).all()
    assert L.has_letter("1 é") and L.has_letter("漢") and L.has_letter("ǅ")
    assert not L.has_letter("12 +_- ½") and not L.has_letter(None)


def test_bounded_sample(spark):
    df = corpus(spark, 300)
    s = L.Settings(max_training_docs=60)
    n = L.training_sample(df, s).count()
    assert 30 <= n <= 90
    with pytest.raises(ValueError):
        L.training_sample(df, L.Settings(max_languages=2)).count()


def test_cases(spark):
    got = L.identify(odd_documents(spark)).collect()
    assert len(got) == len(ODD_TEXTS) + 4
    by = {r["doc_id"]: r for r in got}
    for d in (0, 1, 2, 14):
        assert by[d]["lang_pred"] == "und" and by[d]["score"] == 0.0
    assert by[13]["lang_pred"] in ("en", "de")
    assert L.identify(no_documents(spark)).count() == 0
    kept = L.keep_identified(odd_documents(spark), least=0.0)
    assert kept.columns == odd_documents(spark).columns and kept.count() == len(ODD_TEXTS) - 4 + 3
