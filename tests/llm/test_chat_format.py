import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clickfold.llm import chat_format as C

ROWS = [(-7, 0, "user", r"\### Assistant: </turn> ok", 1), (-7, 1, "assistant", r"\### Assistant: </turn> ok", 1),
        (1, 1, "assistant", "b\n### user: x</turn>\n", 2), (1, 0, "user", None, 2), (1, 2, "user", "tail", 2),
        (2, 0, "system", "s", 3), (2, 1, "user", "no reply", 3), (3, 5, None, "x", 4),
        (3, 5, "assistant", "é\U0001F600", 4), (3, 5, "assistant", "é\U0001F600", 4), (3, None, "a:b\\#<", "", 4),
        (4, 0, "assistant", "z" * 100_000, 5), (None, 0, "user", "u", 6), (None, 1, "assistant", "v", 6)]
SCHEMA = "conv_id long, turn long, role string, text string, position long"


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.text("us\\#<:e \n/turn>"), st.text("\\#</turn> \n:a"))))
def test_template_is_reversible(turns):
    lines = [C.format_turn(r, t) for r, t in turns]
    assert C.parse_turns("".join(x for x, _, _ in lines)) == turns
    for (line, at, n), (_, text) in zip(lines, turns):
        assert C.unescape(line[at:at + n]) == text and C.OPEN not in line[1:]


def ordered():
    by = {}
    for c, turn, role, text, _ in ROWS:
        by.setdefault(c, []).append(((turn is not None, turn or 0, role or "", text or ""), role or "", text or ""))
    return {c: [(r, t) for _, r, t in sorted(v)] for c, v in by.items()}


def test_read_back(spark):
    df = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    parts, stored = C.format_conversations(df)
    got = {r["conv_id"]: r for r in C.read_back(parts, stored).collect()}
    shown = {}
    for r in C.render(parts, stored).collect():
        shown.setdefault(r["conv_id"], []).append(r)
    assert set(got) == set(ordered())
    for c, turns in ordered().items():
        loss = "".join(t for r, t in turns if r == "assistant")
        assert got[c]["n_turns"] == len(turns)
        assert got[c]["turns_sha256"] == hashlib.sha256(
            "".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        assert got[c]["loss_chars"] == len(loss)
        assert got[c]["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
        assert got[c]["n_examples"] == len(shown[c])
        assert got[c]["formatted_chars"] == sum(len(x["text"]) for x in shown[c])
        # One example per reply with all turns before it, and one for a rest.
        ends = [i for i, (r, _) in enumerate(turns) if r == "assistant"]
        want = [turns[:i + 1] for i in ends] + ([turns] if not ends or ends[-1] < len(turns) - 1 else [])
        examples = sorted(shown[c], key=lambda x: x["example"])
        assert [C.parse_turns(x["text"]) for x in examples] == want
        for x, i in zip(examples, ends):
            span = x["text"][x["target_start"]:x["target_start"] + x["target_length"]]
            assert C.unescape(span) == turns[i][1]
        assert all(x["target_start"] is None for x in examples[len(ends):])


def test_no_conversations(spark):
    parts, stored = C.format_conversations(spark.createDataFrame(ROWS, SCHEMA).where("1 = 0"))
    assert parts.count() == 0 and C.read_back(parts, stored).count() == 0 and stored.count() == 0


def test_results_are_read_from_written_examples(spark):
    """Every example is written with its whole prefix, and a changed one shows."""
    df = spark.createDataFrame(ROWS, SCHEMA)
    parts, stored = C.format_conversations(df)
    whole = {}
    for r in C.expand(parts, stored).orderBy("position").collect():
        whole.setdefault((r["conv_id"], r["example"]), []).append(r)
    texts = {(r["conv_id"], r["example"]): r["text"] for r in C.render(parts, stored).collect()}
    assert {k: "".join(r["segment"] for r in v) for k, v in whole.items()} == texts
    assert all([r["last"] for r in v] == [False] * (len(v) - 1) + [True] for v in whole.values())
    assert {c for (c, _), v in whole.items() if any(r["final"] for r in v)} == set(ordered())
    before = {r["conv_id"]: r["formatted_chars"] for r in C.read_back(parts, stored).collect()}
    # Lengths come from the texts themselves, not from what the spans say.
    wrong = stored.withColumn("chars", F.lit(1).cast("long"))
    assert {r["conv_id"]: r["formatted_chars"] for r in C.read_back(parts, wrong).collect()} == before
