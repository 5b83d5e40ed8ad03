"""Substring dedup by repeated-phrase automata.

A window is ``WINDOW`` consecutive words of one document.  A word goes if a
window covers it whose words also start somewhere in a document with a smaller
``doc_id``; windows are judged on the input, not on what is left.

1. *Anchors.*  The window's anchor is its ``GRAM``-word gram of least hash, so
   equal windows have equal anchors and a document sends about a fifth of its
   words.  An anchor that one document holds alone cannot belong to a repeated
   window.  For the others, the smallest holding document is the anchor's
   *first document*.
2. *Stretches.*  Each document is read again with its shared anchors: runs of
   windows whose anchors have the same first document make a stretch.
   Documents whose whole text occurs before need no stretch: all their windows
   do.
3. *Automata.*  The stretches of a first document are its confirmed passages.
   They are compiled into Aho-Corasick automata over word numbers, one shard
   per first document (large ones in blocks), and the stretches of every other
   document that met one of its anchors stream through; each match is exact.
   A first document that very many others repeat is dealt over several tasks.
4. *Around an anchor* later documents may agree with each other but not with
   the first document.  Windows that the automaton did not find are compared
   with each other by 128-bit digests of their words.
5. The spans found are cut from the whole texts.

Cases: NULL or blank text has no words; with fewer than ``WINDOW`` words
nothing goes; texts of any length are taken whole; rows of one ``doc_id`` are
versions of that document, each judged and returned as a row of its own
(repeated rows alike), and never repeat each other; a row without ``doc_id``
is neither smaller nor larger than any and stays whole; an empty table gives
an empty result; only ``doc_id`` and ``text`` are read, whatever other columns
there are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickfold.llm.word_hashes import gram_hashes, word_hashes
from clickfold.session import write_table

#: Words of a window, and of the grams among which its anchor is chosen.
WINDOW = 13
GRAM = 5
#: Bytes of text hashed at a time; stretches of one task and windows of one
#: automaton (layout only, results do not depend on them).
SLICE = 1 << 21
STREAMS = 512
BLOCK = 50_000
#: Digests that a worker holds before it hands them on (layout only).
DIGESTS = 20_000


def _slices(ids: list, texts: list[bytes]) -> Iterator[tuple[list, list[bytes]]]:
    at, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= SLICE:
            yield ids[at:i + 1], texts[at:i + 1]
            at, size = i + 1, 0
    if at < len(texts):
        yield ids[at:], texts[at:]


def _parts(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """``batch`` in slices of about ``SLICE`` bytes of a text or binary
    column, so that a worker unpacks few of its rows at a time."""
    ends = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy().cumsum(dtype=np.int64)
    at = 0
    while at < batch.num_rows:
        done = int(ends[at - 1]) if at else 0
        end = max(at + 1, int(np.searchsorted(ends, done + SLICE, side="right")))
        yield batch.slice(at, end - at)
        at = end


def _anchors(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """``(text, first word of the window, anchor)`` of every window."""
    h, doc = word_hashes(texts)
    n = len(h) - WINDOW + 1
    if n <= 0:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.uint64))
    g = gram_hashes(h, GRAM)
    views = np.lib.stride_tricks.sliding_window_view(g, WINDOW - GRAM + 1)
    inside = np.flatnonzero(doc[:n] == doc[WINDOW - 1:])
    first = np.searchsorted(doc, np.arange(len(texts)))
    return doc[inside], inside - first[doc[inside]], views.min(1)[inside]


def _pack(docs: DataFrame) -> DataFrame:
    """``doc_id, fp, z``: a fingerprint that tells versions of a document
    apart, and the text as a zstandard frame (what a shuffle carries)."""
    def run(batches):
        code = zstandard.ZstdCompressor(level=1)
        for batch in (part for b in batches for part in _parts(b, "text")):
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("fp"),
                 pa.array([code.compress(t) for t in texts], pa.binary())], ["doc_id", "fp", "z"])

    return docs.mapInArrow(run, "doc_id long, fp long, z binary")


def _shared_anchors(docs: DataFrame) -> DataFrame:
    """``doc_id, h, first``: the anchors that several documents hold, with the
    smallest of these documents.  Rows of an anchor are streamed in order, so a
    frequent anchor takes no memory."""
    def send(batches):
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            for own, texts in _slices(ids, batch.column("text").cast(pa.binary()).to_pylist()):
                doc, _, h = _anchors(texts)
                new = np.ones(len(h), bool)
                new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
                doc, h = doc[new], h[new]
                order = np.lexsort((h, doc))
                doc, h = doc[order], h[order]
                new = np.ones(len(h), bool)
                new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h[new].view(np.int64)), pa.array(np.array(own, np.int64)[doc[new]])],
                    ["h", "doc_id"])

    def meet(batches):
        held = None     # the anchor at the end of the last batch: (h, doc_id, already shared)
        for batch in batches:
            h, d = (batch.column(c).to_numpy() for c in ("h", "doc_id"))
            if not len(h):
                continue
            if held:
                h, d = np.append(held[0], h), np.append(held[1], d)
            start = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
            count = np.diff(np.append(start, len(h)))
            shared = d[start] != d[start + count - 1]
            if held and held[2] and h[0] == held[0]:
                shared[0] = True
            out = np.repeat(shared, count)
            first = np.repeat(d[start], count)
            if held and held[2]:
                out[0] = False      # this row was given before
            held = (h[-1], first[-1], bool(shared[-1]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(x[out]) for x in (d, h, first)], ["doc_id", "h", "first"])

    rows = docs.select("doc_id", "text").mapInArrow(send, "h long, doc_id long")
    return (rows.repartition("h").sortWithinPartitions("h", "doc_id")
            .mapInArrow(meet, "doc_id long, h long, first long"))


def _runs(start: np.ndarray) -> Iterator[tuple[int, int]]:
    """Word spans covered by windows that start at ``start`` (ascending)."""
    if len(start):
        cut = np.flatnonzero(np.diff(start) > WINDOW) + 1
        for part in np.split(start, cut):
            yield int(part[0]), int(part[-1]) + WINDOW


def _stretches(docs: DataFrame, shared: DataFrame, repeats: DataFrame) -> DataFrame:
    """``first, doc_id, fp, at, text``: runs of consecutive windows whose
    anchors have the same first document."""
    none = F.lit(None)
    rows = _pack(docs).select("doc_id", F.lit(1).alias("kind"), "fp", "z",
                              none.cast("long").alias("h"), none.cast("long").alias("first"))
    rows = rows.unionAll(shared.select("doc_id", F.lit(0).alias("kind"), none.cast("long"),
                                       none.cast("binary"), "h", "first"))
    rows = rows.unionAll(repeats.select("doc_id", F.lit(0).alias("kind"), "fp",
                                        none.cast("binary"), none.cast("long"), none.cast("long")))

    def cut(doc: int, texts: list[tuple[int, bytes]], anchors: list[tuple[np.ndarray, np.ndarray]]):
        h = np.concatenate([a for a, _ in anchors])
        first = np.concatenate([f for _, f in anchors])
        order = np.argsort(h, kind="stable")
        h, first = h[order], first[order]
        for fp, text in texts:
            _, at, own = _anchors([text])
            own = own.view(np.int64)
            k = np.minimum(np.searchsorted(h, own), len(h) - 1)
            hit = np.flatnonzero(h[k] == own)
            if not len(hit):
                continue
            words, at, whose = text.split(), at[hit], first[k[hit]]
            new = np.flatnonzero((np.diff(at) > 1) | (np.diff(whose) != 0)) + 1
            for part in np.split(np.arange(len(at)), new):
                i, j = int(at[part[0]]), int(at[part[-1]]) + WINDOW
                yield int(whose[part[0]]), doc, fp, i, b" ".join(words[i:j])

    def run(batches):
        code = zstandard.ZstdDecompressor()
        doc, texts, anchors, skip, out, size = None, [], [], set(), [], 0

        def batch_of(rows):
            cols = zip(*rows)
            types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
            arrays = [pa.array(c, pa.binary() if t == pa.string() else t).cast(t)
                      for c, t in zip(cols, types)]
            return pa.RecordBatch.from_arrays(arrays, ["first", "doc_id", "fp", "at", "text"])

        def done():
            kept = [(fp, t) for fp, t in texts if fp not in skip]
            return list(cut(doc, kept, anchors)) if anchors and kept else []

        for batch in batches:
            ids, kinds, fps, zs = (batch.column(c).to_pylist() for c in ("doc_id", "kind", "fp", "z"))
            hs = batch.column("h").fill_null(0).to_numpy()
            firsts = batch.column("first")
            none_first = firsts.is_null().to_numpy(zero_copy_only=False)
            firsts = firsts.fill_null(0).to_numpy()
            i = 0
            while i < len(ids):
                if ids[i] != doc:
                    out += done()
                    doc, texts, anchors, skip = ids[i], [], [], set()
                    if sum(len(r[4]) for r in out) > SLICE:
                        yield batch_of(out)
                        out = []
                if kinds[i]:
                    if all(fp != fps[i] for fp, _ in texts):
                        texts.append((fps[i], code.decompress(zs[i])))
                    i += 1
                    continue
                j = i
                while j < len(ids) and ids[j] == doc and not kinds[j]:
                    j += 1
                skip |= {fp for fp in fps[i:j] if fp is not None}
                own = np.arange(i, j)[~none_first[i:j]]
                if len(own):
                    anchors.append((hs[own], firsts[own]))
                i = j
        out += done() if doc is not None else []
        if out:
            yield batch_of(out)

    return (rows.repartition("doc_id").sortWithinPartitions("doc_id", "kind")
            .mapInArrow(run, "first long, doc_id long, fp long, at long, text string"))


def _found(stretches: DataFrame) -> DataFrame:
    """``doc_id, fp, i, j, digests``: word spans that the automata of the first
    documents find, and (where ``digests`` is not NULL) spans that they do not,
    with a digest of each window."""
    import ahocorasick  # noqa: F401  (fails here rather than in a task)

    passages = stretches.where("doc_id = first")
    streams = stretches.where("doc_id > first")
    counts = write_table(streams.groupBy("first").agg(
        F.ceil(F.count(F.lit(1)) / STREAMS).cast("int").alias("k")), name="phrase-counts")
    salt = F.pmod(F.xxhash64("doc_id"), F.col("k")).cast("int")
    cols = ["first", "salt", "kind", "doc_id", "fp", "at", "text"]
    rows = streams.join(counts, "first").select(
        "first", salt.alias("salt"), F.lit(1).alias("kind"), "doc_id", "fp", "at", "text")
    rows = rows.unionAll(passages.join(counts, "first").select(
        "first", F.explode(F.expr("sequence(0, k - 1)")).alias("salt"), F.lit(0).alias("kind"),
        "doc_id", "fp", "at", "text"))

    def compile_(passages: list[list[bytes]]):
        """Automata over word numbers, and the numbers (0: any other word)."""
        import ahocorasick

        numbers: dict[bytes, int] = {}
        coded = [tuple(numbers.setdefault(w, len(numbers) + 1) for w in p) for p in passages]
        machines, size = [], 0
        machine = ahocorasick.Automaton(ahocorasick.STORE_LENGTH, ahocorasick.KEY_SEQUENCE)
        for p in coded:
            for i in range(len(p) - WINDOW + 1):
                window = p[i:i + WINDOW]
                if machine.add_word(window):
                    size += 1
                if size >= BLOCK:
                    machines.append(machine)
                    machine = ahocorasick.Automaton(ahocorasick.STORE_LENGTH,
                                                    ahocorasick.KEY_SEQUENCE)
                    size = 0
        if size:
            machines.append(machine)
        for m in machines:
            m.make_automaton()
        return machines, numbers

    def run(batches):
        key, passages, machines, numbers, out, held = None, [], None, {}, [], 0
        names = ["doc_id", "fp", "i", "j", "digests"]
        types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.binary())]

        def batch_of(rows):
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

        for batch in (part for b in batches for part in _parts(b, "text")):
            for first, salt, kind, doc, fp, at, text in zip(
                    *(batch.column(c).to_pylist() for c in cols)):
                if (first, salt) != key:
                    key, passages, machines = (first, salt), [], None
                words = text.encode().split()
                if not kind:
                    passages.append(words)
                    continue
                if machines is None:
                    machines, numbers = compile_(passages)
                    passages = []
                coded = tuple([numbers.get(w, 0) for w in words])
                hit = np.zeros(len(words) - WINDOW + 1, bool)
                for m in machines:
                    ends = [e for e, _ in m.iter(coded)]
                    hit[np.array(ends, np.int64) - (WINDOW - 1)] = True
                out += [(doc, fp, at + i, at + j, None) for i, j in _runs(np.flatnonzero(hit))]
                lost = np.flatnonzero(~hit)
                for part in np.split(lost, np.flatnonzero(np.diff(lost) > 1) + 1):
                    if len(part):
                        digests = [hashlib.blake2b(b" ".join(words[i:i + WINDOW]), digest_size=16)
                                   .digest() for i in part.tolist()]
                        out.append((doc, fp, at + int(part[0]), at + int(part[-1]) + WINDOW, digests))
                held += len(lost)
                if held >= DIGESTS:
                    yield batch_of(out)
                    out, held = [], 0
            if out:
                yield batch_of(out)
                out, held = [], 0

    return (rows.repartition("first", "salt").sortWithinPartitions("first", "salt", "kind")
            .mapInArrow(run, "doc_id long, fp long, i long, j long, digests array<binary>"))


def _later(lost: DataFrame) -> DataFrame:
    """Spans of the windows among ``lost`` that a smaller document has too."""
    rows = lost.select("doc_id", "fp", "i", F.posexplode("digests").alias("k", "digest"))
    rows = rows.select("digest", "doc_id", "fp", (F.col("i") + F.col("k")).alias("i"))
    first = write_table(rows.groupBy("digest").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b"))
                        .where("a < b").select("digest", "a"), name="phrase-digests")
    return rows.join(first, "digest").where("doc_id > a").select(
        "doc_id", "fp", "i", (F.col("i") + WINDOW).alias("j"))


def _remove(docs: DataFrame, spans: DataFrame, repeats: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_removed, kept`` for every row."""
    none = F.lit(None).cast("long")
    rows = _pack(docs).select("doc_id", "fp", F.lit(1).alias("kind"), "z", none.alias("i"),
                              none.alias("j"))
    empty = F.lit(None).cast("binary")
    rows = rows.unionAll(spans.select("doc_id", "fp", F.lit(0).alias("kind"), empty, "i", "j"))
    rows = rows.unionAll(repeats.select("doc_id", "fp", F.lit(0).alias("kind"), empty,
                                        F.lit(0).cast("long"), F.lit(-1).cast("long")))

    def run(batches):
        code = zstandard.ZstdDecompressor()
        key, spans = None, []
        def batch_of(out):
            types = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            arrays = [pa.array(c, t) for c, t in zip(zip(*out), types)]
            arrays[3] = arrays[3].cast(pa.string())
            return pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_words", "n_removed", "kept"])

        for batch in (part for b in batches for part in _parts(b, "z")):
            out, size = [], 0
            for doc, fp, kind, z, i, j in zip(
                    *(batch.column(c).to_pylist() for c in ("doc_id", "fp", "kind", "z", "i", "j"))):
                if (doc, fp) != key:
                    key, spans = (doc, fp), []
                if not kind:
                    spans.append((i, j))
                    continue
                words = code.decompress(z).split()
                n = len(words)
                if spans and doc is not None:
                    stay = np.ones(n, bool)
                    for i, j in spans:
                        if j >= 0:
                            stay[i:j] = False
                        elif n >= WINDOW:
                            stay[:] = False
                    words = [words[i] for i in np.flatnonzero(stay).tolist()]
                out.append((doc, n, n - len(words), b" ".join(words)))
                size += len(out[-1][3])
                if size >= SLICE:
                    yield batch_of(out)
                    out, size = [], 0
            if out:
                yield batch_of(out)

    return (rows.repartition("doc_id", "fp").sortWithinPartitions("doc_id", "fp", "kind")
            .mapInArrow(run, "doc_id long, n_words long, n_removed long, kept string"))


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_removed, kept`` (the words that stay, joined by one
    space) for every row of ``docs``."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce("text", F.lit("")).alias("text"))
    docs = docs.withColumn("fp", F.xxhash64("text"))
    known = docs.where("doc_id IS NOT NULL")
    # Documents whose whole text occurs in a smaller document.
    sums = known.select("doc_id", "fp", F.sha2("text", 256).alias("sum"))
    least = sums.groupBy("sum").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b"))
    repeats = write_table(sums.join(least.where("a < b"), "sum").where("doc_id > a")
                          .select("doc_id", "fp").distinct(), name="phrase-copies")
    stretches = write_table(_stretches(known, _shared_anchors(known), repeats),
                            name="phrase-stretches")
    found = write_table(_found(stretches), name="phrase-spans")
    spans = (found.where("digests IS NULL").select("doc_id", "fp", "i", "j")
             .unionAll(_later(found.where("digests IS NOT NULL"))))
    return _remove(docs, spans, repeats)
