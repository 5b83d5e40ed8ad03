"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it are
its context, and only its reply is trainable.  Turns behind the last reply
(or all turns, where there is none) become one example without a target, so
that no turn is lost.

The formatted text of an example is the formatted text of its conversation up
to its target, so the texts of all examples together would grow with the
square of a conversation's length.  What is kept is stored once: the *segments*
(one per turn, with its place) and, per example, the last segment, the length
of its text and the span of its target.  ``expand`` writes every example with
all turns of its prefix, a row per turn, so that no text is held as a whole,
and ``read_back`` reads nothing but these; ``render`` joins single texts.

Template of a turn (``role`` and ``text`` escaped):

    ### role: text</turn>\\n

A backslash goes before every backslash, ``#``, ``<`` and, in a role, ``:`` of
the content, so a marker never occurs inside it and the texts come back
exactly.

Cases: NULL text and NULL role are empty; turns are ordered by ``turn`` (NULL
first), ties by role and text, and repeated rows are turns of their own; a
NULL conv_id is a conversation of its own; an empty table gives no examples;
only ``conv_id, turn, role, text`` are read, whatever other columns there
are.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clickfold.session import write_table

TRAINED_ROLE = "assistant"
OPEN, AFTER_ROLE, CLOSE = "### ", ": ", "</turn>\n"

_ESCAPED = re.compile(r"[\\#<]")
_ESCAPED_ROLE = re.compile(r"[\\#<:]")
_BACK = re.compile(r"\\(.)", re.S)
_TURN = re.compile(r"### ((?:[^\\#<:]|\\.)*): ((?:[^\\#<]|\\.)*)</turn>\n", re.S)

SEGMENTS = ("conv_id long, position long, start long, length long, target_start long, "
            "target_length long, example long, segment string")


def escape(text: str) -> str:
    return _ESCAPED.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return _BACK.sub(r"\1", text)


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """The formatted turn and the span of its text in it."""
    head = OPEN + _ESCAPED_ROLE.sub(lambda m: "\\" + m[0], role) + AFTER_ROLE
    body = escape(text)
    return head + body + CLOSE, len(head), len(body)


def parse_turns(formatted: str) -> list[tuple[str, str]]:
    """The ``(role, text)`` turns of a formatted text; raises if it is not one."""
    turns, at = [], 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if m is None:
            raise ValueError(f"no turn at character {at}")
        turns.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    return turns


def _rows(batches, names):
    for batch in batches:
        yield from zip(*(batch.column(c).to_pylist() for c in names))


def segments(conversations: DataFrame) -> DataFrame:
    """One row per turn: its place in the conversation's formatted text, the
    span of the trainable text (lengths in code points; NULL if none) and the
    number of the example whose last turn it is.

    Turns stream through sorted, so a task holds one turn at a time."""
    names = [x.split()[0] for x in SEGMENTS.split(", ")]

    def run(batches):
        held, position, start, example, out = (), 0, 0, 0, []
        for conv, role, text in _rows(batches, ["conv_id", "role", "text"]):
            if (conv,) != held:
                held, position, start, example = (conv,), 0, 0, 0
            line, at, length = format_turn(role, text)
            trained = role == TRAINED_ROLE
            out.append((conv, position, start, len(line), start + at if trained else None,
                        length if trained else None, example, line))
            position, start, example = position + 1, start + len(line), example + trained
            if len(out) >= 2000:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in _typed(out)], names)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in _typed(out)], names)

    def _typed(rows):
        kinds = [pa.int64()] * 7 + [pa.string()]
        return [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]

    turns = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return (turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
            .mapInArrow(run, SEGMENTS))


def examples(parts: DataFrame) -> DataFrame:
    """One row per example: ``conv_id, example, last_position, chars`` (length
    of its text) and the span of its target (NULL without one)."""
    return parts.groupBy("conv_id", "example").agg(
        F.max("position").alias("last_position"), F.max(F.col("start") + F.col("length")).alias("chars"),
        F.max("target_start").alias("target_start"), F.max("target_length").alias("target_length"))


def render(parts: DataFrame, wanted: DataFrame) -> DataFrame:
    """The texts of some examples (rows of ``examples``): ``conv_id, example,
    text, target_start, target_length``.  Each text holds its whole context."""
    e = wanted.select("conv_id", "example", "last_position", "target_start", "target_length")
    p = parts.select(F.col("conv_id").alias("_c"), "position", "segment")
    on = F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("position") <= F.col("last_position"))
    return (e.join(p, on).groupBy("conv_id", "example", "target_start", "target_length")
            .agg(F.sort_array(F.collect_list(F.struct("position", "segment"))).alias("p"))
            .select("conv_id", "example", F.array_join(F.col("p.segment"), "").alias("text"),
                    "target_start", "target_length"))


def expand(parts: DataFrame, shown: DataFrame) -> DataFrame:
    """All examples with their whole prefix: ``conv_id, example, position,
    segment`` and, in the row of the last turn, ``target_at`` and
    ``target_length`` (the span trained in that segment).  ``final`` marks the
    conversation's last example, whose prefix is the whole conversation."""
    longest = F.max("last_position").over(Window.partitionBy("conv_id"))
    e = shown.select("conv_id", "example", "last_position", "target_start", "target_length",
                     (F.col("last_position") == longest).alias("final"))
    p = parts.select(F.col("conv_id").alias("_c"), "position", "start", "segment")
    on = F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("position") <= F.col("last_position"))
    last = F.col("position") == F.col("last_position")
    return e.join(p, on).select(
        "conv_id", "example", "position", "segment", last.alias("last"),
        F.when(last, F.col("target_start") - F.col("start")).alias("target_at"),
        F.when(last, F.col("target_length")).alias("target_length"), "final")


def read_back(parts: DataFrame, shown: DataFrame) -> DataFrame:
    """Per conversation, from its examples written out (``expand``): ``conv_id,
    n_turns, turns_sha256`` (prefix of the final example), ``loss_chars,
    loss_sha256`` (masked text of every example), ``formatted_chars`` (all
    examples' texts together) and ``n_examples``."""
    def run(batches):
        names = ["conv_id", "segment", "chars", "target"]
        held, state, out = (), None, []

        def close():
            turns, sha, loss, chars, total, count = state
            return held[0], turns, sha.hexdigest(), chars, loss.hexdigest(), total, count

        for conv, line, size, target in _rows(batches, names):
            if (conv,) != held:
                if held:
                    out.append(close())
                held, state = (conv,), [0, hashlib.sha256(), hashlib.sha256(), 0, 0, 0]
            (role, text), = parse_turns(line)
            state[0] += 1
            state[1].update(f"{role}\n{text}\n".encode())
            if size is not None:        # an example ends with this turn
                state[4] += size
                state[5] += 1
            if target is not None:
                loss = unescape(target)
                state[2].update(loss.encode())
                state[3] += len(loss)
            if len(out) >= 2000:
                yield pack(out)
                out = []
        if held:
            out.append(close())
        if out:
            yield pack(out)

    def pack(rows):
        c = list(zip(*rows))
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(c, kinds)], [
            "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars",
            "n_examples"])

    written = write_table(expand(parts, shown), name="expanded")
    masked = F.substr("segment", (F.col("target_at") + 1).cast("int"), F.col("target_length").cast("int"))
    # Per example the length of its text and its masked text, at its last turn.
    e = written.groupBy(F.col("conv_id").alias("_c"), "example").agg(
        F.max(F.when(F.col("last"), F.col("position"))).alias("_p"),
        F.sum(F.length("segment")).alias("chars"), F.max(F.when(F.col("last"), masked)).alias("target"))
    on = F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("position") == F.col("_p"))
    rows = written.where("final").select("conv_id", "position", "segment").join(e, on, "left")
    return (rows.repartition("conv_id").sortWithinPartitions("conv_id", "position").mapInArrow(
        run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
             "loss_sha256 string, formatted_chars long, n_examples long"))


def format_conversations(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Write the segments and the examples over them, and return both."""
    parts = write_table(segments(conversations), name="segments")
    return parts, write_table(examples(parts), name="examples")
