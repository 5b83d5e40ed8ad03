from collections import Counter

from clickfold.llm import quality_rules as Q
from tests.llm.conftest import ODD_TEXTS, no_documents, odd_documents, prose

TEXTS = [*ODD_TEXTS, "a b c " * 30, "x y z\nx y z\n\nx y z \n" * 4, prose(3, 80) + "\n" + prose(3, 80),
         "p q r s p q r s t", "w " * 60, "\n".join(["same line here"] * 3 + ["other line"])]


def brute(text):
    t = text or ""
    w = [x for x in t.replace("\t", " ").replace("\n", " ").replace("\x0b", " ").replace("\x0c", " ")
         .replace("\r", " ").split(" ") if x]
    lines = [x for x in t.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    wins = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    often = Counter(wins)
    covered = {j for i, x in enumerate(wins) if often[x] > 1 for j in (i, i + 1, i + 2)}
    return {"n_words": len(w), "word_chars": sum(map(len, w)),
            "n_symbols": sum(c in "#*$%&|<>" for c in t),
            "n_dup_lines": len(lines) - len(set(lines)), "n_lines": len(lines),
            "n_repeat_words": len(covered), "n_letters": sum(c.isalpha() for c in t)}


def test_measures_match_brute_force(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    for r in Q.measure(df).collect():
        want = brute(TEXTS[r["doc_id"]])
        assert {k: r[k] for k in want} == want, TEXTS[r["doc_id"]]


def test_bits_policies_and_ablations(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    book = Q.ledger(df)
    bits = {r["doc_id"]: r["fail_bits"] for r in book.collect()}
    for i, t in enumerate(TEXTS):
        m = brute(t)
        assert bool(bits[i] & 1) == (m["n_words"] < 50)
        assert bool(bits[i] & 2) == (100 * m["n_repeat_words"] > 50 * m["n_words"])
        assert bool(bits[i] & 4) == (m["n_symbols"] > m["n_words"])
    for name, mask in Q.POLICIES.items():
        kept = {r["doc_id"] for r in Q.apply_policy(book, name).where("kept").collect()}
        assert kept == {i for i, b in bits.items() if not b & mask}
    got = {r["rule"]: r for r in Q.ablations(book, "v2").collect()}
    for rule in Q.RULES:
        m = [b & Q.POLICIES["v2"] for b in bits.values()]
        assert got[rule.name]["failed"] == sum(bool(b & rule.mask) for b in m)
        assert got[rule.name]["only"] == sum(b == rule.mask for b in m)
        assert got[rule.name]["kept_without"] == sum(not b & ~rule.mask for b in m)
    s = Q.bit_summary(book).first()
    any_, all_ = 0, -1
    for b in bits.values():
        any_, all_ = any_ | b, all_ & b
    assert (s["any_failed"], s["all_failed"]) == (any_, all_)


def test_plan_is_native_and_keeps_rows_whole(spark):
    df = odd_documents(spark)
    kept = Q.keep(df, "v2")
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [10, 11, 12, 13]
    assert Q.ledger(df).count() == len(ODD_TEXTS) + 4
    assert Q.ledger(no_documents(spark)).count() == 0
    assert Q.keep(no_documents(spark)).count() == 0
