import corpus_pipeline as P
from clickfold.llm import jaccard_join as J
from clickfold.llm.best_fit_packing import SIZE
from tests.conftest import SF_SMALL
from tests.llm.conftest import no_documents, odd_documents
from tests.llm.test_quality_rules import brute as measures

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def test_stages_in_order():
    assert [n for n, _ in P.STAGES] == ["language_id", "quality_rules", "ngram_jaccard", "source_mixing",
                                        "best_fit_packing"]
    assert P.ORACLE_SQL is None


def test_each_stage_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    stage = dict(P.STAGES)
    known = stage["language_id"](spark, docs, SF_SMALL)
    assert known.columns == docs.columns
    assert known.count() >= 0.97 * docs.where("text rlike '[A-Za-z]'").count()

    good = stage["quality_rules"](spark, docs, SF_SMALL)
    want = set()
    for r in docs.collect():
        m = measures(r["text"])
        if not (m["n_words"] < 50 or 100 * m["n_repeat_words"] > 50 * m["n_words"]
                or m["n_symbols"] > m["n_words"] or 100 * m["n_dup_lines"] > 30 * m["n_lines"]
                or not 2 * m["n_words"] <= m["word_chars"] <= 15 * m["n_words"]
                or 2 * m["n_letters"] < m["word_chars"]):
            want.add(r["doc_id"])
    assert {r["doc_id"] for r in good.collect()} == want

    sets = {r["doc_id"]: set(J.shingles(r["text"], 5).tolist()) for r in docs.collect()}
    comp = {d: d for d in sets}
    for a in sorted(sets):
        for b in sorted(sets):
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 80 * len(sets[a] | sets[b]):
                old, new = max(comp[a], comp[b]), min(comp[a], comp[b])
                comp = {k: new if c == old else c for k, c in comp.items()}
    one = stage["ngram_jaccard"](spark, docs, SF_SMALL)
    assert one.columns == docs.columns
    assert sorted(r["doc_id"] for r in one.collect()) == sorted(d for d, c in comp.items() if c == d)


def test_whole_run(spark):
    packed = P.run(spark, SF_SMALL)
    seqs = {}
    for r in packed.collect():
        seqs.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for spans in seqs.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= SIZE
    total = sum(n for s in seqs.values() for _, n in s)
    assert len(seqs) <= -(-total // SIZE) + 3


def test_odd_and_no_documents(spark):
    odd = odd_documents(spark).withColumnRenamed("size", "n_chars")
    for docs in (odd, no_documents(spark)):
        for name, stage in P.STAGES:
            out = stage(spark, docs, "")
            if name != "best_fit_packing":
                assert out.columns == docs.columns
            out.count()
