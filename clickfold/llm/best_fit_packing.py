"""Best-fit packing by exact-complement hashing.

Documents are tokenised, ended by an id and cut into pieces of at most one
sequence.  Packing looks at the histogram of piece lengths only: at most
``size`` counts, whatever the corpus.  From the longest length down, a piece
opens a sequence, and its gap is looked up among the sums of one, two and
three available lengths; a combination that fills the gap exactly is taken as
often as the counts allow.  What has no exact complement takes the longest
available length that fits, again and again (best fit).  The plan is a list
of (lengths, how often).

Spark then numbers the pieces of each length (a distributed prefix sum, so a
length that a third of all pieces share is spread over many tasks) and every
piece finds its sequence and offset from (length, number) in the plan.

Cases: NULL or empty text is the end id alone; repeated rows are documents of
their own; a text of exactly ``size`` - 1 ids fills a sequence; an empty table
gives no sequences; only ``doc_id`` and ``text`` are read, whatever other
columns there are.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickfold.llm.common import running_before, uniform_key
from clickfold.llm.token_memo import memo, text_slices
from clickfold.session import write_table

SIZE = 4096
END_ID = 1

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def token_pieces(docs: DataFrame, tokenizer: str, end_id: int = END_ID,
                 size: int = SIZE, with_ids: bool = True) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` and, ``with_ids``, ``ids``
    (little-endian unsigned 32-bit) of every piece of every document."""
    end = struct.pack("<I", end_id)

    def cut(batches):
        code = memo(tokenizer)
        for batch in text_slices(batches):
            rows = []
            for d, ids in zip(batch.column("doc_id").to_pylist(),
                              code.encode(batch.column("text"))):
                ids += end
                for k, at in enumerate(range(0, len(ids), 4 * size)):
                    part = ids[at:at + 4 * size]
                    row = (d, k, at // 4, len(part) // 4, zlib.crc32(part))
                    rows.append((*row, part) if with_ids else row)
            cols = list(zip(*rows))
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][:len(cols)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, types)], names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        cut, _PIECES + ", ids binary" * with_ids)


def _complement(left: np.ndarray, gap: int) -> list[int] | None:
    """Up to three available lengths that fill ``gap`` exactly, fewest and
    longest first; ``left`` has the number of pieces left by length."""
    if left[gap]:
        return [gap]
    have = left[:gap + 1] > 0

    def pair(g: int, most: int) -> list[int] | None:
        """a >= b with a + b = g and a <= most."""
        lo, hi = (g + 1) // 2, min(most, g - 1)
        if hi < lo:
            return None
        both = have[lo:hi + 1] & have[g - hi:g - lo + 1][::-1]
        for a in np.flatnonzero(both)[::-1]:
            a = int(a) + lo
            if 2 * a != g or left[a] > 1:
                return [a, g - a]
        return None

    if found := pair(gap, gap):
        return found
    for a in np.flatnonzero(have[:gap - 1])[::-1]:
        a = int(a)
        if 3 * a < gap:
            return None
        left[a] -= 1
        have[a] = left[a] > 0
        rest = pair(gap - a, a)
        left[a] += 1
        have[a] = True
        if rest:
            return [a, *rest]
    return None


def pack_lengths(counts: np.ndarray, size: int = SIZE) -> list[tuple[list[int], int]]:
    """The plan for ``counts[length]`` pieces: ``(lengths, how often)``."""
    left = counts.astype(np.int64).copy()
    left[0] = 0
    plan: list[tuple[list[int], int]] = []
    for length in range(size, 0, -1):
        while left[length]:
            left[length] -= 1
            items, gap, more = [length], size - length, []
            if gap:
                more = _complement(left, gap)
                if more is None:
                    more = []
                    taken = np.zeros(0, np.int64)
                    while gap:
                        fits = np.flatnonzero(left[:gap + 1])
                        if not len(fits):
                            break
                        a = int(fits[-1])
                        left[a] -= 1
                        more.append(a)
                        gap -= a
                        # The rest of the gap may now have an exact complement.
                        if gap and (tail := _complement(left, gap)):
                            for b in tail:
                                left[b] -= 1
                            more += tail
                            break
                    taken = np.asarray(more, np.int64)
                    np.add.at(left, taken, 1)
            items += more
            left[length] += 1
            kinds, per = np.unique(items, return_counts=True)
            often = int((left[kinds] // per).min())
            left[kinds] -= often * per
            plan.append((items, often))
    return plan


def plan_slots(plan: list[tuple[list[int], int]], size: int = SIZE) -> dict[str, np.ndarray]:
    """The plan as runs sorted by (length, first number): pieces of a length
    with numbers from ``key`` on go to sequences from ``seq`` on at ``offset``."""
    used = np.zeros(size + 1, np.int64)
    key, seq, offset, at = [], [], [], 0
    for items, often in plan:
        place = 0
        for length in items:
            key.append((length << 48) + int(used[length]))
            seq.append(at)
            offset.append(place)
            used[length] += often
            place += length
        at += often
    order = np.argsort(np.array(key, np.int64), kind="stable")
    return {"key": np.array(key, np.int64)[order], "seq": np.array(seq, np.int64)[order],
            "offset": np.array(offset, np.int64)[order]}


def pack(pieces: DataFrame, size: int = SIZE) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces (a written table with
    ``doc_id, piece, length`` and any more narrow columns)."""
    spark = pieces.sparkSession
    counts = np.zeros(size + 1, np.int64)
    # At most ``size`` rows.
    for row in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect():
        counts[row["length"]] = row["n"]
    slots = spark.sparkContext.broadcast(plan_slots(pack_lengths(counts, size), size))

    @F.pandas_udf("sequence_id long, offset long")
    def place(length, number):  # noqa: ANN001
        import pandas as pd

        s = slots.value
        want = (length.to_numpy(np.int64) << 48) + number.to_numpy(np.int64)
        k = np.searchsorted(s["key"], want, side="right") - 1
        return pd.DataFrame({"sequence_id": s["seq"][k] + want - s["key"][k],
                             "offset": s["offset"][k]})

    ties = [c for c in ("doc_id", "piece", "ids_crc32") if c in pieces.columns]
    keyed = pieces.withColumns({"_key": uniform_key(F.col("doc_id"), F.col("piece")),
                                "_one": F.lit(1).cast("long")})
    numbered = running_before(keyed, "length", "_key", "_one", ties, "_number")
    placed = numbered.withColumn("_at", place("length", "_number"))
    return placed.select(*pieces.columns, F.col("_at.sequence_id").alias("sequence_id"),
                         F.col("_at.offset").alias("offset"))


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences: ``sequence_id, n_tokens, ids`` with the pieces'
    ids in the order of their offsets.  A sequence holds at most ``size`` ids."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"),
                                             parts.alias("_p")).select(
        "sequence_id", "n_tokens",
        F.aggregate("_p", F.lit(b"").cast("binary"),
                    lambda a, x: F.concat(a, x["ids"])).alias("ids"))


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = END_ID, size: int = SIZE,
                   with_ids: bool = False) -> DataFrame:
    """Tokenise, cut and pack documents; ``with_ids`` keeps each piece's ids."""
    pieces = write_table(token_pieces(docs, tokenizer, end_id, size, with_ids), name="pieces")
    return pack(pieces, size)
