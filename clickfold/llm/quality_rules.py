"""Quality rules as a bitmask ledger (native DataFrame functions only).

Every rule is evaluated once per document.  The ledger stores one bit per
failed rule next to the measurements, so that a policy is a mask: versions
of a policy and ablations of single rules are bitwise work on the ledger and
never look at a text again.

Cases: NULL or blank text has no words (it fails ``few_words``); a NULL
doc_id and repeated rows are judged row by row; an empty table gives an empty
ledger; only ``doc_id`` and ``text`` are read, other columns are ignored (or
carried whole by ``keep``), whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickfold.llm.common import WHITE, strip_white, words

SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Rule:
    """``fails`` is a SQL condition over the measurements."""
    bit: int
    name: str
    fails: str

    @property
    def mask(self) -> int:
        return 1 << self.bit


#: A bit keeps its meaning for good; a changed rule takes a new bit.
RULES = (
    Rule(0, "few_words", "n_words < 50"),
    Rule(1, "repeated_words", "100 * n_repeat_words > 50 * n_words"),
    Rule(2, "symbols", "n_symbols > n_words"),
    Rule(3, "duplicate_lines", "100 * n_dup_lines > 30 * n_lines"),
    Rule(4, "word_length", "word_chars < 2 * n_words OR word_chars > 15 * n_words"),
    Rule(5, "letters", "2 * n_letters < word_chars"),
)
BASE = 0b11
#: Versioned policies: the mask of the rules that reject.
POLICIES = {"base": BASE, "v1": 0b001111, "v2": 0b111111}
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines",
            "n_letters")


def _repeat_words(df: DataFrame) -> DataFrame:
    """``n_repeat_words``: words inside 3-word windows that occur twice or
    more.  Windows are compared by 64-bit hashes; positions are only sorted
    for texts in which some window repeats."""
    df = df.withColumn("_h", F.transform(
        F.slice("_w", 1, F.greatest(F.size("_w") - 2, F.lit(0))),
        lambda w, i: F.xxhash64(w, F.get("_w", i + 1), F.get("_w", i + 2))))
    df = df.withColumn("_s", F.when(
        F.size(F.array_distinct("_h")) < F.size("_h"),
        F.sort_array(F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    df = df.withColumn("_p", F.sort_array(F.filter(F.transform(
        "_s", lambda e, k: F.when((e["h"] == F.get("_s", k - 1)["h"])
                                  | (e["h"] == F.get("_s", k + 1)["h"]), e["i"])),
        lambda x: x.isNotNull())))
    steps = F.transform("_p", lambda p, k: F.least(
        F.lit(3), F.coalesce(F.get("_p", k + 1) - p, F.lit(3))))
    return df.withColumn("n_repeat_words", F.coalesce(
        F.aggregate(steps, F.lit(0), lambda a, x: a + x), F.lit(0)).cast("long")).drop(
        "_h", "_s", "_p")


def measure(docs: DataFrame, carry: bool = False) -> DataFrame:
    """``doc_id`` and the measurements; with ``carry`` the whole input row as
    the struct ``_row`` too."""
    t = F.coalesce(F.col("text"), F.lit(""))
    rest = [F.struct(*[F.col(c) for c in docs.columns]).alias("_row")] if carry else []
    df = docs.select(F.col("doc_id"), t.alias("_t"), *rest)
    df = df.withColumns({
        "_w": words(F.col("_t")),
        "_l": F.filter(F.split("_t", "\n"), lambda x: strip_white(x) != ""),
        "word_chars": F.length(F.translate("_t", WHITE, "")).cast("long"),
        "n_symbols": (F.length("_t") - F.length(F.translate("_t", SYMBOLS, ""))).cast("long"),
        "n_letters": F.length(F.regexp_replace("_t", "[^\\p{L}]+", "")).cast("long"),
    })
    df = df.withColumns({
        "n_words": F.size("_w").cast("long"),
        "n_lines": F.size("_l").cast("long"),
        "n_dup_lines": (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long"),
    })
    df = _repeat_words(df.drop("_t", "_l"))
    # A row number never is negative.  Being undetermined, it keeps filters on
    # the measurements above them; pushed below, each use would repeat them.
    df = df.withColumn("n_words", F.when(F.monotonically_increasing_id() >= 0, F.col("n_words")))
    return df.select("doc_id", *MEASURES, *(["_row"] if carry else []))


def fail_bits(rules: tuple[Rule, ...] = RULES) -> Column:
    bits = F.lit(0).cast("long")
    for r in rules:
        bits = bits.bitwiseOR(F.when(F.expr(r.fails), F.lit(r.mask)).otherwise(F.lit(0)))
    return bits


def ledger(docs: DataFrame, rules: tuple[Rule, ...] = RULES, carry: bool = False) -> DataFrame:
    """One row per document: measurements and ``fail_bits`` (bit k is set if
    the rule with that bit failed)."""
    return measure(docs, carry).withColumn("fail_bits", fail_bits(rules))


def passes(policy: str | int) -> Column:
    mask = POLICIES[policy] if isinstance(policy, str) else policy
    return F.col("fail_bits").bitwiseAND(F.lit(mask)) == 0


def apply_policy(book: DataFrame, policy: str | int) -> DataFrame:
    """Ledger rows with ``kept`` by one version of the policy."""
    return book.withColumn("kept", passes(policy))


def keep(docs: DataFrame, policy: str | int = "v2") -> DataFrame:
    """The documents that pass, with all their columns."""
    return ledger(docs, carry=True).where(passes(policy)).select("_row.*")


def ablations(book: DataFrame, policy: str | int = "v2",
              rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per rule of a policy: documents that fail it (``failed``), that fail
    nothing else (``only``), and that are kept without it (``kept_without``).

    The ledger is first counted by its masked bits, at most 2**rules rows.
    """
    mask = POLICIES[policy] if isinstance(policy, str) else policy
    used = [r for r in rules if r.mask & mask]
    counts = book.groupBy(F.col("fail_bits").bitwiseAND(F.lit(mask)).alias("bits")).agg(
        F.count(F.lit(1)).alias("n"))
    each = F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(r.mask).cast("long").alias("m"))
                     for r in used])
    n = F.col("n")
    return (counts.select("bits", "n", F.explode(each).alias("r"))
            .select("bits", "n", "r.rule", "r.m")
            .groupBy("rule").agg(
                F.sum(F.when(F.col("bits").bitwiseAND(F.col("m")) != 0, n).otherwise(0))
                .alias("failed"),
                F.sum(F.when(F.col("bits") == F.col("m"), n).otherwise(0)).alias("only"),
                F.sum(F.when(F.col("bits").bitwiseAND(F.bitwise_not(F.col("m"))) == 0, n)
                      .otherwise(0)).alias("kept_without")))


def bit_summary(book: DataFrame) -> DataFrame:
    """Bits that some row, every row and an odd number of rows failed."""
    return book.agg(F.bit_or("fail_bits").alias("any_failed"),
                    F.bit_and("fail_bits").alias("all_failed"),
                    F.bit_xor("fail_bits").alias("parity"))
