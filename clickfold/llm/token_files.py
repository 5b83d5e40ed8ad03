"""Token-id files of independent zstandard frames with a trailing seek table.

Documents are sorted by ``doc_id`` over all files.  A file is a row of
zstandard frames that can be decompressed one by one; every frame holds some
documents:

    u32 count | count x i64 doc_id | count x u8 doc_id is NULL
    | count x u32 number of ids | all ids as u32          (little endian)

Behind them stand two skippable frames: an index (per frame: documents, ids,
smallest doc_id, whether it is NULL) and the seek table of the zstandard
seekable format, with a checksum (low half of XXH64) per frame.  A reader
finds the frames of a document in the index, their places in the seek table,
and decompresses those frames only.

Tasks write their files straight into the shared folder under a name that no
other attempt uses and report them in a manifest table.  Readers trust the
manifest alone, so files left by lost or repeated attempts are never seen.

Cases: NULL text is empty, so the document has the end id only; NULL doc_id
sorts first; repeated doc_ids are kept and found together; an empty table
gives an empty manifest; only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import bisect
import io
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clickfold.llm.token_memo import memo, text_slices
from clickfold.session import table_path, write_table

#: Raw bytes after which a frame is closed (a document is never cut).
FRAME_BYTES = 1 << 18
# Fixed values of the zstandard seekable format.
SKIPPABLE_INDEX, SKIPPABLE_SEEK, SEEKABLE_MAGIC = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1

_MANIFEST = "shard long, path string, docs long, ids long, bytes long"


def open_fs(path: str) -> tuple[fs.FileSystem, str]:
    """The file system and inner path of a URI (``file:/x``, ``hdfs://...``)."""
    if path.startswith("file:") and not path.startswith("file://"):
        path = "file://" + path[len("file:"):]
    return fs.FileSystem.from_uri(path)


def _checksum(raw: bytes) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF


class ShardWriter:
    """Writes one file to a binary stream."""

    def __init__(self, out, frame_bytes: int = FRAME_BYTES, level: int = 3):
        import zstandard

        self._zstd = zstandard.ZstdCompressor(level=level, write_content_size=True)
        self._out, self._frame_bytes = out, frame_bytes
        self._docs: list[int | None] = []
        self._ids: list[bytes] = []
        self._size = 0
        self._seek: list[tuple[int, int, int]] = []
        self._index: list[tuple[int, int, int, int]] = []
        self.docs = self.ids = self.bytes = 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self._docs.append(doc_id)
        self._ids.append(ids)
        self._size += len(ids) + 13
        if self._size >= self._frame_bytes:
            self._close_frame()

    def _put(self, data: bytes) -> None:
        self._out.write(data)
        self.bytes += len(data)

    def _close_frame(self) -> None:
        if not self._docs:
            return
        n = len(self._docs)
        sizes = np.fromiter((len(x) // 4 for x in self._ids), "<u4", n)
        raw = b"".join([
            struct.pack("<I", n),
            np.fromiter((d or 0 for d in self._docs), "<i8", n).tobytes(),
            bytes(d is None for d in self._docs), sizes.tobytes(), *self._ids])
        packed = self._zstd.compress(raw)
        self._put(packed)
        total, first = int(sizes.sum(dtype="u8")), self._docs[0]
        self._seek.append((len(packed), len(raw), _checksum(raw)))
        self._index.append((n, total, first or 0, first is None))
        self.docs += n
        self.ids += total
        self._docs, self._ids, self._size = [], [], 0

    def close(self) -> None:
        self._close_frame()
        index = b"".join(struct.pack("<IQqB", *x) for x in self._index)
        self._put(struct.pack("<II", SKIPPABLE_INDEX, len(index)) + index)
        table = b"".join(struct.pack("<III", *x) for x in self._seek)
        table += struct.pack("<IBI", len(self._seek), 0x80, SEEKABLE_MAGIC)
        self._put(struct.pack("<II", SKIPPABLE_SEEK, len(table)) + table)


@dataclass
class Frame:
    offset: int
    packed: int
    raw: int
    checksum: int
    docs: int
    ids: int
    first: int | None


class ShardReader:
    """Reads frames of one file from a seekable binary stream."""

    def __init__(self, source):
        self._in = source
        end = source.seek(0, io.SEEK_END)
        source.seek(end - 9)
        count, flags, magic = struct.unpack("<IBI", source.read(9))
        if magic != SEEKABLE_MAGIC or flags != 0x80:
            raise ValueError("not a token file: no seek table with checksums at its end")
        at = end - 9 - 12 * count - 8
        source.seek(at)
        if struct.unpack("<II", source.read(8)) != (SKIPPABLE_SEEK, 12 * count + 9):
            raise ValueError("damaged seek table")
        seek = list(struct.iter_unpack("<III", source.read(12 * count)))
        entry = struct.calcsize("<IQqB")
        source.seek(at - 8 - entry * count)
        if struct.unpack("<II", source.read(8)) != (SKIPPABLE_INDEX, entry * count):
            raise ValueError("damaged index")
        index = struct.iter_unpack("<IQqB", source.read(entry * count))
        self.frames: list[Frame] = []
        offset = 0
        for (packed, raw, check), (docs, ids, first, null) in zip(seek, index):
            self.frames.append(Frame(offset, packed, raw, check, docs, ids,
                                     None if null else first))
            offset += packed

    def frame(self, k: int) -> Iterator[tuple[int | None, bytes]]:
        """The documents of one frame: ``(doc_id, ids as bytes)``."""
        import zstandard

        f = self.frames[k]
        self._in.seek(f.offset)
        raw = zstandard.ZstdDecompressor().decompress(self._in.read(f.packed), f.raw)
        if len(raw) != f.raw or _checksum(raw) != f.checksum:
            raise ValueError(f"checksum of frame {k} is wrong")
        n = struct.unpack_from("<I", raw)[0]
        docs = np.frombuffer(raw, "<i8", n, 4).tolist()
        null = raw[4 + 8 * n:4 + 9 * n]
        sizes = np.frombuffer(raw, "<u4", n, 4 + 9 * n).tolist()
        at = 4 + 13 * n
        for d, missing, size in zip(docs, null, sizes):
            yield (None if missing else d), raw[at:at + 4 * size]
            at += 4 * size

    def documents(self, doc_id: int) -> list[bytes]:
        """The ids of every document with this doc_id; only the frames that
        may hold it are decompressed."""
        firsts = [(f.first is not None, f.first or 0) for f in self.frames]
        k = max(bisect.bisect_left(firsts, (True, doc_id)) - 1, 0)
        found = []
        while k < len(firsts) and firsts[k] <= (True, doc_id):
            found += [ids for d, ids in self.frame(k) if d == doc_id]
            k += 1
        return found


def write_files(docs: DataFrame, tokenizer: str, folder: str | None = None,
                end_id: int = 0, frame_bytes: int = FRAME_BYTES) -> DataFrame:
    """Encode all documents and write the files; returns the manifest (one
    row per file, ordered by ``shard``).  The range partitions of ``doc_id``
    are the files, so their number follows the session's partition settings."""
    spark = docs.sparkSession
    folder = folder or table_path(spark, "tokens")
    end = struct.pack("<I", end_id)

    def write(batches):
        from pyspark import TaskContext

        shard, writer, out = TaskContext.get().partitionId(), None, None
        code = memo(tokenizer)
        path = f"{folder.rstrip('/')}/shard-{shard:06d}-{uuid.uuid4().hex}.zst"
        for batch in text_slices(batches):
            if writer is None:
                where, inner = open_fs(path)
                where.create_dir(inner.rsplit("/", 1)[0], recursive=True)
                out = where.open_output_stream(inner, compression=None)
                writer = ShardWriter(out, frame_bytes)
            for d, ids in zip(batch.column("doc_id").to_pylist(),
                              code.encode(batch.column("text"))):
                writer.add(d, ids + end)
        if writer is not None:
            writer.close()
            out.close()
            yield pa.RecordBatch.from_pylist([dict(
                shard=shard, path=path, docs=writer.docs, ids=writer.ids, bytes=writer.bytes)])

    tie = F.xxhash64("text").alias("_tie")
    ordered = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", tie)
               .repartitionByRange("doc_id", "_tie")
               .sortWithinPartitions("doc_id", "_tie").select("doc_id", "text"))
    return write_table(ordered.mapInArrow(write, _MANIFEST), name="manifest")


def read_files(manifest: DataFrame) -> DataFrame:
    """Per document, from the files: ``doc_id, start`` (ids of all documents
    before it), ``n_tokens`` and ``ids_crc32`` (of its ids as bytes)."""
    def read(batches):
        for batch in batches:
            for row in batch.to_pylist():
                where, inner = open_fs(row["path"])
                start = row["before"]
                with where.open_input_file(inner) as source:
                    reader = ShardReader(source)
                    for k in range(len(reader.frames)):
                        found = list(reader.frame(k))
                        sizes = [len(ids) // 4 for _, ids in found]
                        starts = (start + np.cumsum([0] + sizes)).tolist()
                        start = starts.pop()
                        yield pa.RecordBatch.from_arrays([
                            pa.array([d for d, _ in found], pa.int64()),
                            pa.array(starts, pa.int64()), pa.array(sizes, pa.int64()),
                            pa.array([zlib.crc32(ids) for _, ids in found], pa.int64())],
                            ["doc_id", "start", "n_tokens", "ids_crc32"])

    # One narrow row per file: the running sum over files is small.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.select("path", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("before"))
    return files.repartition("path").mapInArrow(
        read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def fetch(manifest: DataFrame, doc_ids: list[int]) -> dict[int, list[list[int]]]:
    """The ids of a few documents, by the seek tables of the files; meant for
    looking things up, on the driver."""
    found: dict[int, list[list[int]]] = {d: [] for d in doc_ids}
    for row in manifest.orderBy("shard").toLocalIterator():
        where, inner = open_fs(row["path"])
        with where.open_input_file(inner) as source:
            reader = ShardReader(source)
            for d in doc_ids:
                found[d] += [np.frombuffer(x, "<u4").tolist() for x in reader.documents(d)]
    return found
