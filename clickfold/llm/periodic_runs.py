"""Periodic runs: stretches of consecutive words that repeat themselves.

A run is a stretch of words with smallest period q (words q apart are equal),
at least ``max(LEAST, TIMES * q)`` words long, that no neighbouring word
extends with the same period.  ``find_runs`` returns all runs of every whole
text and the text without the repetitions (a word goes if a run contains it
behind that run's first q words).

Runs come from suffix trees (``suffix_runs``): Ukkonen trees of the words and
of their reversal, constant-time common extensions by Euler tours, and Lyndon
roots extended in both directions.  Trees are built over the regions of a text
that can hold a run at all: within a run every three words occur again at a
distance of at most q, so only such stretches (found with array sorts over
whole texts), with what may belong to a run around them, are candidates.
This leaves out nothing; the trees decide.

Each document is judged alone, in the task that reads it: no shuffle.

Cases: NULL or blank text has no words and no runs; texts of any length are
taken whole, and one of n equal words is one run; equally strong runs: the
smallest start, then period, is the ``best``; repeated rows and rows without
``doc_id`` are rows of their own; an empty table gives an empty result; only
``doc_id`` and ``text`` are read, whatever other columns there are.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickfold.llm.suffix_runs import runs
from clickfold.llm.token_memo import text_batches
from clickfold.llm.word_hashes import gram_hashes, mix, word_hashes

#: Shortest run, and how often its period must fit.
LEAST = 6
TIMES = 4
_GRAM = 3
#: Bytes of text hashed at a time (layout only).
SLICE = 1 << 21
#: Rounds of the candidate filter (each only leaves out what can't be a run).
_ROUNDS = 8

_SCHEMA = ("doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, "
           "best long, collapsed string")


def regions(texts: list[bytes]) -> list[list[tuple[int, int]]]:
    """Per text the word ranges ``[i, j)`` that can hold a run."""
    out: list[list[tuple[int, int]]] = [[] for _ in texts]
    h, doc = word_hashes(texts)
    n = len(h) - _GRAM + 1
    if n <= 0:
        return out
    key = gram_hashes(h, _GRAM) ^ mix(doc[:n].astype(np.uint64))
    order = np.argsort(key, kind="stable")
    again = (key[order[1:]] == key[order[:-1]]) & (doc[order[1:]] == doc[order[:-1]])
    gap = np.zeros(n, np.int64)
    gap[order[1:][again]] = (order[1:] - order[:-1])[again]
    # A run of period q and length L holds L - q - 2 grams in a row with gaps
    # of at most q; TIMES * q <= L bounds q by the number of these grams.
    at = np.flatnonzero((gap > 0) & (doc[:n] == doc[_GRAM - 1:]))
    for _ in range(_ROUNDS):
        if not len(at):
            return out
        new = np.append(True, (np.diff(at) > 1) | (doc[at[1:]] != doc[at[:-1]]))
        start = np.flatnonzero(new)
        size = np.diff(np.append(start, len(at)))
        most = (size + _GRAM - 1) // (TIMES - 1)
        good = (gap[at] <= np.repeat(most, size)) & (np.repeat(size, size) >= LEAST - _GRAM)
        if good.all():
            break
        at = at[good]
    if not len(at):
        return out
    new = np.append(True, (np.diff(at) > 1) | (doc[at[1:]] != doc[at[:-1]]))
    start = np.flatnonzero(new)
    size = np.diff(np.append(start, len(at)))
    most = (size + _GRAM - 1) // (TIMES - 1)
    first = np.searchsorted(doc, np.arange(len(texts) + 1))
    for i, j, q in zip(at[start].tolist(), (at[start] + size).tolist(), most.tolist()):
        d = int(doc[i])
        lo, hi = int(first[d]), int(first[d + 1])
        i, j = max(lo, i - q - 1) - lo, min(hi, j + _GRAM) - lo
        if out[d] and i <= out[d][-1][1]:
            i, j = min(i, out[d][-1][0]), max(j, out[d].pop()[1])
        out[d].append((i, j))
    return out


def text_runs(words: list[bytes], where: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """All runs of a text, given the ranges that can hold any."""
    found = set()
    for i, j in where:
        numbers: dict[bytes, int] = {}
        coded = [numbers.setdefault(w, len(numbers) + 1) for w in words[i:j]]
        for start, length, q in runs(coded, LEAST, TIMES):
            a, b = i + start, i + start + length
            if a == i:
                while a > 0 and words[a - 1] == words[a - 1 + q]:
                    a -= 1
            if b == j:
                while b < len(words) and words[b] == words[b - q]:
                    b += 1
            found.add((a, b - a, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def best_run(found: list[tuple[int, int, int]]) -> int | None:
    """The number of the run with the greatest exact length / period."""
    best = None
    for k, (_, length, q) in enumerate(found):
        if best is None or length * found[best][2] > found[best][1] * q:
            best = k
    return best


def collapse(words: list[bytes], found: list[tuple[int, int, int]]) -> list[bytes]:
    if not found:
        return words
    stay = np.ones(len(words), bool)
    for start, length, q in found:
        stay[start + q:start + length] = False
    return [words[i] for i in np.flatnonzero(stay).tolist()]


def find_runs(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, runs`` (by start, then period)``, best`` (number of
    the strongest run, from 0, or NULL)``, collapsed`` (the words that stay,
    joined by one space) for every row."""
    def run(batches):
        for batch, texts in text_batches(batches, SLICE):
            texts = [(t or "").encode() for t in texts]
            rows = []
            for doc, text, where in zip(batch.column("doc_id").to_pylist(), texts, regions(texts)):
                words = text.split()
                found = text_runs(words, where)
                kept = b" ".join(collapse(words, found))
                rows.append((doc, len(words), [dict(zip(("start", "length", "period"), r))
                                               for r in found], best_run(found), kept))
            kind = pa.list_(pa.struct([(x, pa.int64()) for x in ("start", "length", "period")]))
            types = [pa.int64(), pa.int64(), kind, pa.int64(), pa.binary()]
            arrays = [pa.array(c, t) for c, t in zip(zip(*rows), types)]
            arrays[4] = arrays[4].cast(pa.string())
            yield pa.RecordBatch.from_arrays(
                arrays, ["doc_id", "n_words", "runs", "best", "collapsed"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _SCHEMA)
