"""Encoding whole texts with a ``tokenizers`` file, word by word.

Both public vocabularies used here split a text into words by a pattern
before any merge, and no word goes on beyond the white space behind it or from
an ASCII letter to a stop.  So a text may be cut before each run of spaces and
newlines and between such a letter and a stop, every distinct piece is encoded by
the library once per worker, and the ids of a text are the ids of its pieces
in order: the same ids as for the text as a whole (tested).  Texts in which
another white space meets a cut are encoded as a whole.

Texts are cut, and their pieces numbered, in the bytes of an Arrow column, so
that Python looks up the distinct pieces of a batch only.

Where the tokenizer itself drops white space or folds ASCII letters to lower
case, pieces come without it and ASCII texts in lower case, so that fewer
pieces are distinct.
"""

from __future__ import annotations

import os
import re
import string
import struct

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from clickfold.llm.common import hold_only

#: Pieces longer than this are encoded but not remembered.
LONG_PIECE = 48
#: Remembered pieces per generation (about 200 bytes each); a worker keeps two
#: generations and moves a piece that is used again to the newer one.
MEMO_SIZE = 300_000

_OTHER_WHITE = re.compile(r"[^\S \n]")
#: Begins the names of special tokens, whose case matters.
_MARK = "<|"
#: Words that are encoded together.
GROUP = 256
_memos: dict[str, "Memo"] = {}

# Kinds of bytes.  Punctuation behind a letter ends a word in both vocabularies
# (an apostrophe may go on with it).  Not cut are the signs in the names of
# special tokens, and behind other letters, which may fold to letter and accent.
_OTHER, _CUT_WHITE, _LETTER, _CUT_SIGN, _ODD = range(5)
_KINDS = np.full(256, _OTHER, np.uint8)
_KINDS[128:] = _ODD                              # may be white space
_KINDS[[*b"\t\x0b\x0c\r\x1c\x1d\x1e\x1f"]] = _ODD
_KINDS[[*b" \n"]] = _CUT_WHITE
_KINDS[[*string.ascii_letters.encode()]] = _LETTER
_KINDS[[*b".,;:!?#*$%&"]] = _CUT_SIGN


def _bytes_of(texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts and where each begins, with the end."""
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int32, len(texts) + 1, 4 * texts.offset)
    if at[0] == at[-1]:
        return np.zeros(0, np.uint8), np.zeros(len(at), np.int32)
    return np.frombuffer(data, np.uint8, at[-1] - at[0], at[0]), at - at[0]


class Memo:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.seen: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        one, two = (self._encode([t])[0] for t in ("ab", " \n ab \n"))
        self.drops_white = one == two
        fold = self.tokenizer.normalizer
        self.folds_case = fold is not None and (
            fold.normalize_str(string.ascii_uppercase) == string.ascii_lowercase)

    def _uncuttable(self, texts: pa.StringArray) -> list[int]:
        """The texts in which another white space may meet a cut."""
        if self.drops_white:
            return []
        data, starts = _bytes_of(texts)
        odd = np.flatnonzero(_KINDS[data] == _ODD)
        rows = np.unique(np.searchsorted(starts, odd, side="right") - 1).tolist()
        return [i for i in rows if _OTHER_WHITE.search(texts[i].as_py())]

    def _cut(self, texts: pa.StringArray) -> tuple[list[str], np.ndarray, np.ndarray]:
        """The distinct pieces, the pieces of all texts in order as their
        numbers, and where each text begins among these, with the end."""
        if self.drops_white and self.folds_case:
            plain = pc.and_not(pc.string_is_ascii(texts), pc.match_substring(texts, _MARK))
            texts = pc.if_else(plain, pc.ascii_lower(texts), texts)
        data, starts = _bytes_of(texts)
        if not len(data):
            return [], np.zeros(0, np.int64), np.zeros(len(starts), np.int64)
        kinds = _KINDS[data]
        white = kinds == _CUT_WHITE
        cut = white.copy()                       # the first of a run of white space
        cut[1:] &= ~white[:-1]
        cut[1:] |= (kinds[1:] == _CUT_SIGN) & (kinds[:-1] == _LETTER)
        cut[starts[:-1][starts[:-1] < starts[1:]]] = True
        at = np.flatnonzero(cut)
        first = np.searchsorted(at, starts)
        if self.drops_white:
            keep = ~white
            before = np.cumsum(keep, dtype=np.int32)
            at, data = before[at] - keep[at], data[keep]
        ends = np.append(at, len(data)).astype(np.int32)
        pieces = pa.StringArray.from_buffers(len(at), pa.py_buffer(ends), pa.py_buffer(data))
        coded = pieces.dictionary_encode()
        return coded.dictionary.to_pylist(), coded.indices.to_numpy(), first

    def _encode(self, texts: list[str]) -> list[bytes]:
        batch = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [struct.pack(f"<{len(x)}I", *x.ids) for x in batch]

    def _encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of pieces that are one word each, many to a call of the library."""
        groups = [words[i:i + GROUP] for i in range(0, len(words), GROUP)]
        glue = " " if self.drops_white else ""
        # Unlike encode_batch_fast, this call numbers the words.
        batch = self.tokenizer.encode_batch([glue.join(g) for g in groups],
                                            add_special_tokens=False)
        out = []
        for group, x in zip(groups, batch):
            at = np.array(x.word_ids, np.float64)      # None: not a number
            ends = np.append(np.flatnonzero(np.diff(at)) + 1, len(at))
            if len(ends) != len(group) or not np.isfinite(at).all():
                out += self._encode(group)             # some piece is several words
                continue
            ids, start = struct.pack(f"<{len(at)}I", *x.ids), 0
            for end in (4 * ends).tolist():
                out.append(ids[start:end])
                start = end
        return out

    def _learn(self, pieces: list[str]) -> None:
        """Put the ids of pieces that ``seen`` does not have there."""
        seen, older, skip = self.seen, self.older, 0 if self.drops_white else 1
        words, others = [], []
        for x in pieces:
            ids = older.get(x)
            if ids is not None:
                seen[x] = ids
            elif x[skip:].isalpha() and (not skip or x[0] == " "):
                words.append(x)
            else:
                others.append(x)
        seen.update(zip(words, self._encode_words(words)))
        seen.update(zip(others, self._encode(others)))

    def _ids(self, pieces: list[str]) -> list[bytes]:
        """The ids of distinct pieces."""
        if len(self.seen) > MEMO_SIZE:
            self.seen, self.older = {}, self.seen
        seen = self.seen
        out = list(map(seen.get, pieces))
        new = [k for k, ids in enumerate(out) if ids is None]
        self._learn([pieces[k] for k in new])
        for k in new:
            out[k] = seen[pieces[k]]
        for k in new:
            if len(pieces[k]) > LONG_PIECE:
                seen.pop(pieces[k], None)
        return out

    def encode(self, texts: pa.StringArray | list[str | None]) -> list[bytes]:
        """Per text its ids as little-endian unsigned 32-bit integers."""
        if not isinstance(texts, pa.Array):
            texts = pa.array(texts, pa.string())
        texts = pc.fill_null(texts.cast(pa.string()), "")
        if not len(texts):
            return []
        whole = self._uncuttable(texts)
        full = self._encode([texts[i].as_py() for i in whole])
        if whole:
            mask = np.zeros(len(texts), bool)
            mask[whole] = True
            texts = pc.if_else(pa.array(mask), "", texts)
        pieces, codes, first = self._cut(texts)
        ids = self._ids(pieces)
        # The ids of the pieces in order, each copied from those of the distinct ones.
        known = np.frombuffer(b"".join(ids), "<u4")
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        places, sizes = (np.cumsum(sizes) - sizes)[codes], sizes[codes]
        ends = np.append(0, np.cumsum(sizes))
        flat = known[np.repeat(places - ends[:-1], sizes) + np.arange(ends[-1])].tobytes()
        bounds = (4 * ends[first]).tolist()
        out = [flat[a:b] for a, b in zip(bounds, bounds[1:])]
        for i, x in zip(whole, full):
            out[i] = x
        return out


def memo(path: str) -> Memo:
    """The worker's memo for a tokenizer file; it outlives a task, until
    another operator remembers something."""
    hold_only(_memos)
    if path not in _memos:
        _memos[path] = Memo(path)
    return _memos[path]


def text_batches(batches, limit: int = 4_000_000):
    """Cut Arrow batches with a ``text`` column into parts of about ``limit``
    bytes of text, and unpack the texts of one part at a time."""
    for part in text_slices(batches, limit):
        yield part, part.column("text").to_pylist()


def text_slices(batches, limit: int = 8_000_000):
    """Cut Arrow batches with a ``text`` column into slices of about ``limit``
    bytes of text, without unpacking it."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0)
        ends, start, done = np.cumsum(sizes.to_numpy(zero_copy_only=False), dtype=np.int64), 0, 0
        while start < len(ends):
            stop = min(int(np.searchsorted(ends, done + limit)) + 1, len(ends))
            yield batch.slice(start, stop - start)
            start, done = stop, int(ends[stop - 1])
