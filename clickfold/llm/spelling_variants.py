"""Spelling variants: words that differ by one code point, by a relational trie.

The words are the nodes and edges of a trie that is a table: a node is a
prefix, an edge leads by one code point to the next prefix and tells what is
below it.  The frontier holds states (word, position, node, edits).  Level by
level it meets the edges of that depth in a join: without an edit a state
walks on, or takes an edge by a replaced, an inserted or (by skipping a code
point of the word) a deleted code point; with its edit spent it only walks on.
A one-edit state that ends on a word is a neighbour.

The one edit leaves the first or the last half of a word as it is.  So the
trie holds words forwards and backwards, and a word starts below its first
half in each: no state ever branches near the root.  Edges look ahead (the
code points that follow, and the rest where only one word is below), so a
state that cannot end on a word is not kept.

``variants`` adds the groups: a word's form is its most frequent neighbour if
that is ``RATIO`` times as frequent, and its root is where the forms lead.

Cases: NULL or empty text has no words; texts and words of any length are
whole (a node deeper than ``LONG`` code points is named by a digest of its
prefix; the frontier takes one join per level that two words share); equally
frequent neighbours: the first in code-point order; repeated rows count as
often as they occur; a row without ``doc_id`` counts its words as they stand;
an empty table gives an empty result; only ``doc_id`` and ``text`` are read,
whatever other columns there are.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickfold.session import write_table

#: Shortest word, fewest occurrences, and the ratio of a form to its variant.
LEAST_LENGTH = 6
LEAST_COUNT = 5
RATIO = 5
#: Prefixes up to this many code points name their node themselves.
LONG = 64
#: Levels that have a folder of their own in the edge table.
LEVELS = 40
#: Distinct words a task holds before it sends their counts (layout only).
HELD = 300_000

_RUN = re.compile("[A-Za-zÀ-ÿ]+")


def word_counts(docs: DataFrame, least_length: int = LEAST_LENGTH, damage: int | None = None) -> DataFrame:
    """``word, n`` over all texts: runs of letters, A-Z in lower case.

    With ``damage``, a run of a document loses one code point if the CRC-32 of
    ``<doc_id>:<run>`` is a multiple of it (planted misspellings)."""
    def run(batches):
        held: dict[str, int] = {}

        def rows():
            out = pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()),
                                              pa.array(held.values(), pa.int64())], ["word", "n"])
            held.clear()
            return out

        for batch in batches:
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                text = (text.as_py() or "").encode().lower().decode()
                name = zlib.crc32(b"%d:" % doc) if damage and doc is not None else None
                for w, n in Counter(_RUN.findall(text)).items():
                    if len(w) < least_length:
                        continue
                    if name is not None and not (h := zlib.crc32(w.encode(), name)) % damage:
                        w = w[:h % len(w)] + w[h % len(w) + 1:]
                        if len(w) < least_length:
                            continue
                    held[w] = held.get(w, 0) + n
                if len(held) > HELD:
                    yield rows()
        if held:
            yield rows()

    counts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n"))


def _name(text: Column) -> Column:
    """A word or prefix, or a digest of a long one."""
    return F.when(F.length(text) <= LONG, text).otherwise(F.concat(F.lit("#"), F.md5(text)))


def _bit(letter: Column) -> Column:
    """The bit of a code point in a set of code points (several share one)."""
    one = F.call_function("shiftleft", F.lit(1).cast("long"),
                          F.pmod(F.xxhash64(letter), F.lit(62)).cast("int"))
    return F.when(letter != "", one).otherwise(F.lit(0).cast("long"))


def _oriented(words: DataFrame) -> DataFrame:
    """Each word forwards and backwards: ``key`` (its name), ``text`` as read
    in that direction, ``way``, ``half`` (where its states start)."""
    both = words.select("word", _name(F.col("word")).alias("key"), F.explode(F.array(
        F.struct(F.lit(">").alias("way"), F.col("word").alias("text")),
        F.struct(F.lit("<").alias("way"), F.reverse("word").alias("text")))).alias("o"))
    return both.select("key", "o.way", "o.text", F.expr("length(word) div 2").alias("half"))


def trie_edges(oriented: DataFrame, from_depth: int) -> DataFrame:
    """The edge table, one folder per level: ``node, letter, child``, and of
    the child: ``own`` (the name of the word that ends there), ``below`` (the
    words at or below it), ``only`` and ``rest`` (if one: its name, and a hash
    of what follows) and ``ahead`` (the set of code points that follow)."""
    at = oriented.where(F.length("text") > from_depth).select(
        "key", "way", "text", F.explode(F.sequence(F.lit(from_depth), F.length("text") - 1)).alias("depth"))
    child = F.substring("text", F.lit(1), F.col("depth") + 1)
    rows = at.select(
        "depth", F.concat("way", _name(F.substring("text", F.lit(1), F.col("depth")))).alias("node"),
        F.substring("text", F.col("depth") + 1, F.lit(1)).alias("letter"),
        F.concat("way", _name(child)).alias("child"), "key",
        (F.length("text") == F.col("depth") + 1).alias("ends"),
        F.xxhash64(F.expr("substring(text, depth + 2)")).alias("rest"),
        _bit(F.substring("text", F.col("depth") + 2, F.lit(1))).alias("ahead"))
    edges = rows.groupBy("depth", "node", "letter", "child").agg(
        F.max(F.when(F.col("ends"), F.col("key"))).alias("own"), F.count(F.lit(1)).alias("below"),
        F.min("key").alias("only"), F.min("rest").alias("rest"), F.bit_or("ahead").alias("ahead"))
    return write_table(edges.withColumn("level", F.least("depth", F.lit(LEVELS))),
                       partition_by="level", name="trie-edges")


def _step(frontier: DataFrame, edges: DataFrame) -> DataFrame:
    """One level: the states that the edges lead to, ``near`` set on those
    that are neighbours."""
    spent = F.col("edits") == 1
    skip = frontier.where(~spent).where("pos < length(text)").select(
        "key", "text", (F.col("pos") + 1).alias("pos"), "node", F.lit(1).alias("edits"))
    here = F.substring("text", F.col("pos") + 1, F.lit(1))
    met = frontier.unionByName(skip).withColumn("here", here).join(edges, "node")
    same = F.col("letter") == F.col("here")
    to = F.when(spent, F.when(same, F.array(F.struct(F.lit(1).alias("by"), F.lit(1).alias("edits")))))
    walk = F.struct(F.lit(1).alias("by"), F.lit(0).alias("edits"))
    replace = F.struct(F.lit(1).alias("by"), F.lit(1).alias("edits"))
    insert = F.struct(F.lit(0).alias("by"), F.lit(1).alias("edits"))
    to = to.when(~spent & same, F.array(walk, insert))
    to = to.when(~spent & (F.col("here") == ""), F.array(insert))
    to = to.when(~spent, F.array(replace, insert))
    out = met.select("key", "text", "pos", "child", "own", "below", "only", "rest", "ahead",
                     F.explode(to).alias("to"))
    out = out.select("key", "text", (F.col("pos") + F.col("to.by")).alias("pos"),
                     F.col("child").alias("node"), F.col("to.edits").alias("edits"),
                     "own", "below", "only", "rest", "ahead")
    spent, left = F.col("edits") == 1, F.length("text") - F.col("pos")
    alone = F.col("below") == 1
    near = F.when(spent & alone, F.when(
        F.col("rest") == F.xxhash64(F.expr("substring(text, pos + 1)")), F.col("only")))
    near = near.when(spent & ~alone & (left == 0), F.col("own"))
    near = near.when(~spent & (left == 1), F.col("own"))
    follows = F.col("ahead").bitwiseAND(_bit(F.substring("text", F.col("pos") + 1, F.lit(1)))) != 0
    goes_on = ~alone & (~spent | ((left > 0) & follows))
    return (out.withColumn("near", near).withColumn("goes_on", goes_on)
            .where(F.col("near").isNotNull() | F.col("goes_on"))
            .select("key", "text", "pos", "node", "edits", "near", "goes_on"))


def neighbours(words: DataFrame) -> DataFrame:
    """``key, near``: the names of all pairs (both ways) of the distinct words
    in ``word`` that differ by exactly one inserted, deleted or replaced code
    point."""
    oriented = write_table(_oriented(words), name="trie-words")
    span = oriented.agg(F.min("half"), F.max("half")).first()
    if span[0] is None:
        return oriented.select("key", F.col("key").alias("near"))
    edges = trie_edges(oriented, span[0])
    starts = oriented.select(
        "key", "text", F.col("half").alias("pos"), F.col("half").alias("depth"),
        F.concat("way", _name(F.expr("substring(text, 1, half)"))).alias("node"),
        F.lit(0).alias("edits"))
    cols = ["key", "text", "pos", "node", "edits"]
    found, frontier, depth = [], None, span[0]
    while depth <= span[1] or frontier is not None:
        if depth <= span[1]:
            new = starts.where(F.col("depth") == depth).select(*cols)
            frontier = new if frontier is None else frontier.unionByName(new)
        level = edges.where((F.col("level") == min(depth, LEVELS)) & (F.col("depth") == depth))
        states = write_table(_step(frontier, level.drop("depth", "level")), name="trie-states")
        found.append(states.where("near IS NOT NULL").select("key", "near"))
        states = states.where("goes_on").select(*cols)
        frontier = None if states.isEmpty() else states
        depth += 1
    out = found[0]
    for f in found[1:]:
        out = out.unionAll(f)
    return out.where("key != near").distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """``word, root``: where following ``form`` ends, by pointer doubling."""
    at = write_table(forms.select("word", F.col("form").alias("root")), name="forms")
    while True:
        nxt = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = write_table(at.join(nxt, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"),
            F.col("next").isNotNull().alias("moved")), name="forms")
        if moved.where("moved").isEmpty():
            return moved.drop("moved")
        at = moved.drop("moved")


def variants(counts: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT,
             ratio: int = RATIO) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of the words of ``counts``
    (``word, n``) that are long and frequent enough."""
    words = write_table(counts.where((F.length("word") >= least_length) & (F.col("n") >= least_count))
                        .select("word", "n", _name(F.col("word")).alias("key")), name="words")
    pairs = write_table(neighbours(words), name="neighbours")
    other = words.select(F.col("key").alias("near"), F.col("word").alias("near_word"),
                         F.col("n").alias("near_n"))
    best = pairs.join(other, "near").groupBy("key").agg(
        F.count(F.lit(1)).alias("n_near"),
        F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near_word").alias("form"))).alias("b"))
    of = words.join(best, "key", "left")
    is_form = -F.col("b.less") >= ratio * F.col("n")
    table = write_table(of.select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(is_form, F.col("b.form")).alias("form"),
        F.when(is_form, -F.col("b.less")).alias("form_n")), name="variants")
    roots = _roots(table.where("form IS NOT NULL"))
    return table.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
