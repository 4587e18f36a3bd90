"""Token ids as binary shards that readers can open in the middle.

A shard is a file of independent zstandard frames, each with the library's own content checksum,
followed by two skippable frames: the document table (ids and token counts) and the seek table of
the public seekable format (compressed size, size and checksum of each frame; number of frames and
its magic number at the very end). A reader takes the tail first, then only the frames that hold
the documents asked for; each is checked before use.

Documents are range-partitioned by id, one shard per partition, so shards in order hold ids in
ascending order (documents without id first). A task writes a file of its own name and reports it
as a row of the manifest; what a lost or repeated task left behind is in no manifest and is ignored.
Null texts count as empty: they hold the end id alone. Repeated ids are kept, each in its place.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corridor.llm.text import text_groups
from corridor.llm.tokenize import WordIds
from corridor.session import new_path, settle

FRAME_BYTES = 256 << 10
LEVEL = 3
#: Fixed values of the seekable format.
SKIPPABLE_TABLE = 0x184D2A5E
SKIPPABLE_DOCUMENTS = 0x184D2A5D
SEEKABLE_MAGIC = 0x8F92EAB1
HAS_CHECKSUMS = 0x80

MANIFEST = "shard int, file string, n_docs bigint, n_tokens bigint, n_bytes bigint"


def _checksum(data: bytes) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(data) & 0xFFFFFFFF


class ShardWriter:
    """Writes one shard; holds one frame and the document table."""

    def __init__(self, out, frame_bytes: int = FRAME_BYTES):
        import zstandard

        self.out, self.most, self.codec = out, frame_bytes, zstandard.ZstdCompressor(level=LEVEL, write_checksum=True)
        self.parts, self.size, self.frames = [], 0, []
        self.ids, self.counts, self.written = [], [], 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        if self.size and self.size + len(ids) > self.most:
            self._frame()
        self.parts.append(ids)
        self.size += len(ids)
        self.ids.append(doc_id)
        self.counts.append(len(ids) // 4)

    def _write(self, data: bytes) -> None:
        self.out.write(data)
        self.written += len(data)

    def _frame(self) -> None:
        data = b"".join(self.parts)
        packed = self.codec.compress(data)
        self._write(packed)
        self.frames.append((len(packed), len(data), _checksum(data)))
        self.parts, self.size = [], 0

    def _skippable(self, magic: int, data: bytes) -> tuple[int, int, int]:
        self._write(struct.pack("<II", magic, len(data)) + data)
        return len(data) + 8, 0, 0

    def close(self) -> None:
        if self.size:
            self._frame()
        ids = np.array([x or 0 for x in self.ids], "<i8").tobytes() + np.array([x is not None for x in self.ids], "u1").tobytes()
        table = self.codec.compress(ids + np.array(self.counts, "<u8").tobytes())
        self.frames.append(self._skippable(SKIPPABLE_DOCUMENTS, struct.pack("<Q", len(self.ids)) + table))
        seek = b"".join(struct.pack("<III", *x) for x in self.frames)
        self._skippable(SKIPPABLE_TABLE, seek + struct.pack("<IBI", len(self.frames), HAS_CHECKSUMS, SEEKABLE_MAGIC))


class ShardReader:
    """Opens a shard by its tail; decompresses one frame at a time."""

    def __init__(self, file):
        import zstandard

        self.file, self.codec = file, zstandard.ZstdDecompressor()
        size = file.size()
        n, flags, magic = struct.unpack("<IBI", file.read_at(9, size - 9))
        if magic != SEEKABLE_MAGIC or not flags & HAS_CHECKSUMS:
            raise ValueError("not a shard with checksums")
        seek = np.frombuffer(file.read_at(12 * n, size - 9 - 12 * n), "<u4").reshape(n, 3).astype(np.int64)
        self.frames = seek[:-1]
        self.offsets = np.r_[0, np.cumsum(seek[:, 0])]
        head = file.read_at(int(seek[-1, 0]), int(self.offsets[n - 1]))
        (docs,) = struct.unpack("<Q", head[8:16])
        table = self.codec.decompress(head[16:])
        self.has_id = np.frombuffer(table, "u1", docs, 8 * docs).astype(bool)
        self.ids = np.frombuffer(table, "<i8", docs)
        self.counts = np.frombuffer(table[9 * docs :], "<u8").astype(np.int64)
        self.begins = np.r_[0, np.cumsum(self.counts)]
        self.frame_begins = np.r_[0, np.cumsum(self.frames[:, 1])] // 4
        self._held: tuple[int, bytes] = (-1, b"")

    def frame(self, k: int) -> bytes:
        if self._held[0] != k:
            packed, size, checksum = (int(x) for x in self.frames[k])
            data = self.codec.decompress(self.file.read_at(packed, int(self.offsets[k])))
            if len(data) != size or _checksum(data) != checksum:
                raise ValueError(f"frame {k} is damaged")
            self._held = (k, data)
        return self._held[1]

    def document(self, k: int) -> bytes:
        """The ids of the shard's k-th document; a document lies in one frame."""
        if not self.counts[k]:
            return b""
        frame = int(np.searchsorted(self.frame_begins, self.begins[k], side="right")) - 1
        at = 4 * int(self.begins[k] - self.frame_begins[frame])
        return self.frame(frame)[at : at + 4 * int(self.counts[k])]


def write_shards(docs: DataFrame, folder: str, tokenizer: str, end_id: int, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Write all documents under ``folder``, which all executors reach; return the stored manifest."""
    end = struct.pack("<I", end_id)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, shard, writer, out = None, TaskContext.get().partitionId(), None, None
        store, base = pa.fs.FileSystem.from_uri(folder)
        name = f"shard-{shard:06d}-{uuid.uuid4().hex}.zst"
        for part, texts in text_groups(batches, text_column):
            if writer is None:
                encode = WordIds(tokenizer)
                store.create_dir(base, recursive=True)
                out = store.open_output_stream(f"{base}/{name}", compression=None)
                writer = ShardWriter(out)
            for doc_id, ids in zip(part.column(id_column).to_pylist(), encode([x.decode() for x in texts]), strict=True):
                writer.add(doc_id, ids + end)
        if writer is not None:
            writer.close()
            out.close()
            row = (shard, name, len(writer.ids), sum(writer.counts), writer.written)
            yield pa.RecordBatch.from_arrays(
                [pa.array([x], t) for x, t in zip(row, (pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64()), strict=True)],
                names=["shard", "file", "n_docs", "n_tokens", "n_bytes"],
            )

    rows = docs.select(F.col(id_column).cast("long").alias(id_column), text_column)
    # The length shares out rows that have one id; the id alone decides where they may stand.
    key = [F.col(id_column).asc_nulls_first(), F.length(text_column).asc_nulls_first(), F.xxhash64(text_column)]
    ordered = rows.repartitionByRange(*key).sortWithinPartitions(*key)
    return settle(ordered.mapInArrow(write, MANIFEST), "manifest")


def placed(manifest: DataFrame) -> DataFrame:
    """The manifest (one row per shard) with the tokens of all shards before each."""
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def read_shards(manifest: DataFrame, folder: str, wanted: set[int] | None = None, with_ids: bool = True) -> DataFrame:
    """Documents from the files: doc_id, start, n_tokens, ids_crc32 and, unless left out, ids.

    With ``wanted`` ids only the frames that hold them are fetched and decompressed.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = pa.fs.FileSystem.from_uri(folder)
        for batch in batches:
            for row in batch.to_pylist():
                with store.open_input_file(f"{base}/{row['file']}") as file:
                    shard = ShardReader(file)
                    places = range(len(shard.ids))
                    if wanted is not None:
                        places = [k for k in places if shard.has_id[k] and int(shard.ids[k]) in wanted]
                    for at in range(0, len(places), 512):
                        some = places[at : at + 512]
                        ids = [shard.document(k) for k in some]
                        columns = [
                            pa.array([int(shard.ids[k]) if shard.has_id[k] else None for k in some], pa.int64()),
                            pa.array([row["base"] + int(shard.begins[k]) for k in some], pa.int64()),
                            pa.array([int(shard.counts[k]) for k in some], pa.int64()),
                            pa.array([zlib.crc32(x) for x in ids], pa.int64()),
                        ]
                        names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                        if with_ids:
                            columns.append(pa.array([np.frombuffer(x, "<u4").astype(np.int64) for x in ids], pa.list_(pa.int64())))
                            names.append("ids")
                        yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + ", ids array<bigint>" * with_ids
    shards = settle(placed(manifest), "placed_manifest")
    return shards.repartitionByRange(max(1, shards.count()), "shard").mapInArrow(read, schema)


def shard_folder(spark: SparkSession) -> str:
    """A new folder for shards under the shared one."""
    return new_path(spark, "shards")
