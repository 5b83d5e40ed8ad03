"""Registered queries over the training-data tables, one per operator.

Each applies its operator with production parameters to whole tables; the
operators hold the work, the functions here only pick the columns of the
result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickfold.llm import (
    best_fit_packing,
    chat_format,
    embedding_dedup,
    jaccard_join,
    language_id,
    license_scan,
    oracles,
    passage_dedup,
    periodic_runs,
    quality_rules,
    source_mixing,
    spelling_variants,
    token_files,
    url_filter,
)
from clickfold.llm.common import ship_package, words


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join(_table(spark, sf_dir, "documents"), width=3, percent=90)


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = token_files.write_files(_table(spark, sf_dir, "documents"),
                                    tokenizer_path("byte_bpe_50k.json"), end_id=0)
    return token_files.read_files(files)


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(_table(spark, sf_dir, "documents"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as files of a tree: source / thousands / hundreds; each
    25th number is its directory's licence file by name."""
    d, number = _table(spark, sf_dir, "documents"), F.col("doc_id").cast("string")
    folder = [F.coalesce("source", F.lit("none")), F.expr("doc_id div 1000").cast("string"),
              F.expr("doc_id div 100").cast("string")]
    name = F.when(F.col("doc_id") % 25 == 0, F.concat(F.lit("LICENSE-"), number)).otherwise(
        F.concat(number, F.lit(".txt")))
    files = d.select(F.col("doc_id").alias("file_id"), F.when(
        F.col("doc_id").isNotNull(), F.concat_ws("/", F.lit(""), *folder, name)).alias("path"), "text")
    return license_scan.scan(files).withColumnRenamed("file_id", "doc_id")


def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.dedup(_table(spark, sf_dir, "embeddings"), least=0.93)


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    labelled = url_filter.page_labels(pages, _table(spark, sf_dir, "labels"))
    rules = [url_filter.Rule("block", "net/"), url_filter.Rule("allow", "example.net/en/"),
             url_filter.Rule("block", "example.com/de/"), url_filter.Rule("allow", "org/fr/")]
    return url_filter.judge(pages, labelled, rules)


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    book = quality_rules.ledger(_table(spark, sf_dir, "documents"))
    book = quality_rules.apply_policy(book, "v2")
    base = ~quality_rules.passes("base")
    return book.withColumn("base_failed", base).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "n_lines", "n_letters", "fail_bits")


def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = source_mixing.mix(_table(spark, sf_dir, "documents"))
    return d.select("doc_id", "size", "source_size", "target", "taken")


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    ok = "\\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", ok), (-7, 1, "assistant", ok)],
                                  "conv_id long, turn long, role string, text string")
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat_format.read_back(*chat_format.format_conversations(turns.unionByName(extra)))


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit_packing.pack_documents(_table(spark, sf_dir, "documents"),
                                           tokenizer_path("word_bpe_49k.json"))


def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = passage_dedup.remove_repeats(_table(spark, sf_dir, "documents"))
    return d.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def _planted(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` with every tenth text made periodic from a word on."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    docs = docs.select("doc_id", "text", h.alias("h"))
    tenth = F.coalesce(F.col("h") % 10 == 0, F.lit(False))
    n = docs.where(tenth).select("doc_id", words(F.col("text")).alias("w"),
                                 F.expr("h div 10").alias("g"))
    n = n.withColumn("n", F.size("w")).where("n > 0")
    n = n.withColumn("a", F.expr("int(g % n)"))
    n = n.withColumn("p", F.expr("int(1 + (n - a) div (3 + g % 8))"))
    text = F.expr("""concat_ws(' ', slice(w, 1, a), slice(flatten(array_repeat(
        slice(w, a + 1, p), int((n - a) div p) + 1)), 1, n - a))""")
    return docs.where(~tenth).select("doc_id", "text").unionAll(
        docs.where(tenth).where(F.size(words(F.col("text"))) == 0).select("doc_id", "text")).unionAll(
        n.select("doc_id", text.alias("text")))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = periodic_runs.find_runs(_planted(_table(spark, sf_dir, "documents")))
    lines = F.expr("""concat_ws('', transform(runs, r -> concat(
        string(r.start), ',', string(r.length), ',', string(r.period), '\n')))""")
    d = d.withColumn("r", F.when(F.col("best").isNotNull(),
                                 F.get(F.col("runs"), F.col("best").cast("int"))))
    return d.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "r.start", "r.length", "r.period",
        F.expr("1000 * r.length div r.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = spelling_variants.word_counts(_table(spark, sf_dir, "documents"), damage=199)
    return spelling_variants.variants(counts)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}


def oracle_sql() -> dict[str, str]:
    return oracles.oracle_sql()
