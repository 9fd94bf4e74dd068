"""Token files with directly addressable codes.

Every id is cut into chunks of eight bits, lowest first. Level 0 holds the first
chunk of every token, level k the next chunk of those tokens whose id goes on.
A bitmap per level marks the tokens that go on, and a rank directory holds the
number of marked tokens before every block of 512, so the place of a token's
next chunk is one directory entry plus a count inside one block. Any token can
be read with a few small reads and no block is ever decoded for it.

File, little-endian::

    segment*  doc_ids i64[D]  doc_null u8[D]  doc_starts u64[D+1]  segments u64[S]  trailer
    segment:  levels u32, items u32[levels], then per level
              chunks u8[n]  bitmap u8[ceil(n/512)*64]  ranks u32[ceil(n/512)]
    trailer:  D u64, S u64, tokens u64, offset of doc_ids u64, magic 8 bytes

Documents are in ascending order of their id, over all files in the order of
their names; documents with a NULL id come first. Every document ends with the
end id, and NULL texts are empty. Rows that repeat an id are documents of their
own, ordered by text. No rows give no files.

A file belongs to one range of ids. It is written under a scratch name and moved
in place when complete, so a repeated task replaces the file of the lost one.
"""

from __future__ import annotations

import struct
import uuid
import zlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerstrata.llm.common import new_folder, stored
from ledgerstrata.llm.encoding import WordEncoder, encode_batches

SEGMENT = 1 << 20
BLOCK = 512
MAGIC = b"DACTOK01"
TRAILER = "<QQQQ8s"
TRAILER_BYTES = struct.calcsize(TRAILER)
# Words kept per worker: these tasks hold little else, and every new word costs the library's merging.
KEPT_WORDS = 800_000
MANIFEST = "part int, file string, docs long, tokens long"


# --- the codes ------------------------------------------------------------------------


def pack_segment(ids: np.ndarray) -> bytes:
    """Up to ``SEGMENT`` unsigned 32-bit ids as directly addressable codes."""
    levels, items, rest = [], [], ids.astype("<u4")
    while True:
        more = rest > 0xFF
        blocks = -(-len(rest) // BLOCK)
        bits = np.zeros(blocks * BLOCK, np.uint8)
        bits[: len(rest)] = more
        per_block = bits.reshape(-1, BLOCK).sum(1, dtype=np.uint32)
        ranks = (np.cumsum(per_block) - per_block).astype("<u4")
        bitmap = np.packbits(bits, bitorder="little")
        levels.append(rest.astype(np.uint8).tobytes() + bitmap.tobytes() + ranks.tobytes())
        items.append(len(rest))
        rest = rest[more] >> 8
        if not len(rest):
            return struct.pack(f"<I{len(items)}I", len(items), *items) + b"".join(levels)


def _level_offsets(items: tuple[int, ...]):
    """(offset of chunks, of bitmap, of ranks) per level, from the segment's start."""
    at = 4 + 4 * len(items)
    for n in items:
        blocks = -(-n // BLOCK)
        yield at, at + n, at + n + blocks * 64
        at += n + blocks * 68


def unpack_segment(data: bytes) -> np.ndarray:
    (count,) = struct.unpack_from("<I", data)
    items = struct.unpack_from(f"<{count}I", data, 4)
    ids = np.zeros(items[0], "<u4")
    place = np.arange(items[0])
    for level, (n, (chunks, bitmap, ranks)) in enumerate(zip(items, _level_offsets(items))):
        chunk = np.frombuffer(data, np.uint8, n, chunks)
        ids[place] |= chunk.astype("<u4") << (8 * level)
        bits = np.frombuffer(data, np.uint8, ranks - bitmap, bitmap)
        place = place[np.unpackbits(bits, count=n, bitorder="little").view(bool)]
    return ids


class TokenFile:
    """Random access to one file through ``read(offset, length) -> bytes``."""

    def __init__(self, read, size: int):
        self._read = read
        docs, segments, self.tokens, at, magic = struct.unpack(
            TRAILER, read(size - TRAILER_BYTES, TRAILER_BYTES)
        )
        if magic != MAGIC:
            raise ValueError("not a token file")
        table = read(at, size - TRAILER_BYTES - at)
        self.doc_ids = np.frombuffer(table, "<i8", docs)
        self.doc_null = np.frombuffer(table, np.uint8, docs, 8 * docs).view(bool)
        self.starts = np.frombuffer(table, "<u8", docs + 1, 9 * docs).astype(np.int64)
        offsets = np.frombuffer(table, "<u8", segments, 9 * docs + 8 * (docs + 1))
        self.segments = [*offsets.tolist(), at]

    def token(self, i: int) -> int:
        """One id, by a few reads of at most 64 bytes."""
        if not 0 <= i < self.tokens:
            raise IndexError(i)
        base, place = self.segments[i // SEGMENT], i % SEGMENT
        (count,) = struct.unpack("<I", self._read(base, 4))
        items = struct.unpack(f"<{count}I", self._read(base + 4, 4 * count))
        value = 0
        for level, (chunks, bitmap, ranks) in enumerate(_level_offsets(items)):
            value |= self._read(base + chunks + place, 1)[0] << (8 * level)
            block, bit = divmod(place, BLOCK)
            bits = int.from_bytes(self._read(base + bitmap + 64 * block, 64), "little")
            if not bits >> bit & 1:
                return value
            (before,) = struct.unpack("<I", self._read(base + ranks + 4 * block, 4))
            place = before + (bits & ((1 << bit) - 1)).bit_count()
        return value

    def segment(self, k: int) -> np.ndarray:
        return unpack_segment(self._read(self.segments[k], self.segments[k + 1] - self.segments[k]))

    def documents(self):
        """``(doc_id or None, start, ids in parts)`` in order, a segment in memory at a time."""
        held, loaded = None, -1
        for doc, (start, end) in enumerate(zip(self.starts[:-1], self.starts[1:])):
            parts = []
            while start < end:
                k, place = divmod(int(start), SEGMENT)
                if k != loaded:
                    held, loaded = self.segment(k), k
                parts.append(held[place : place + int(end - start)])
                start += len(parts[-1])
            doc_id = None if self.doc_null[doc] else int(self.doc_ids[doc])
            yield doc_id, int(self.starts[doc]), parts


def open_tokens(path: str) -> TokenFile:
    """A token file by its address, on any file system that Arrow knows."""
    from pyarrow import fs

    filesystem, name = fs.FileSystem.from_uri(path)
    handle = filesystem.open_input_file(name)

    def read(offset: int, length: int) -> bytes:
        return handle.read_at(length, offset)

    return TokenFile(read, handle.size())


class _Writer:
    """Appends documents to one file; holds one segment and the document table."""

    def __init__(self, out):
        self.out, self.at, self.held, self.size = out, 0, [], 0
        self.ids, self.null, self.starts, self.segments = [], [], [0], []

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.ids.append(doc_id or 0)
        self.null.append(doc_id is None)
        self.starts.append(self.starts[-1] + len(ids) // 4)
        self.held.append(ids)
        self.size += len(ids)
        if self.size >= 4 * SEGMENT:
            self._flush(False)

    def _flush(self, last: bool) -> None:
        data = b"".join(self.held)
        whole = len(data) if last else len(data) - len(data) % (4 * SEGMENT)
        for at in range(0, whole, 4 * SEGMENT):
            part = pack_segment(np.frombuffer(data[at : at + 4 * SEGMENT], "<u4"))
            self.segments.append(self.at)
            self.out.write(part)
            self.at += len(part)
        self.held, self.size = [data[whole:]], len(data) - whole

    def close(self) -> None:
        self._flush(True)
        for values, kind in (
            (self.ids, "<i8"), (self.null, np.uint8), (self.starts, "<u8"), (self.segments, "<u8")
        ):
            self.out.write(np.array(values, kind).tobytes())
        counts = len(self.ids), len(self.segments), self.starts[-1]
        self.out.write(struct.pack(TRAILER, *counts, self.at, MAGIC))


# --- Spark jobs -------------------------------------------------------------------------


def write_tokens(
    docs: DataFrame,
    tokenizer: str,
    folder: str,
    end_id: int = 0,
    words: str = "spaced",
    id_col: str = "doc_id",
    text_col: str = "text",
    kept_words: int = KEPT_WORDS,
) -> DataFrame:
    """Encode ``docs`` and write one token file per range of ids; returns the manifest.

    ``folder`` must be reachable by every executor through Arrow (a mounted
    folder, HDFS, S3 or GCS address).
    """
    end = struct.pack("<I", end_id)

    def run(batches):
        import pyarrow as pa
        from pyarrow import fs
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        encoded = encode_batches(batches, WordEncoder.of_worker(tokenizer, words, kept_words))
        first = next(encoded, None)
        if first is None:
            return
        filesystem, root = fs.FileSystem.from_uri(folder)
        filesystem.create_dir(root, recursive=True)
        name = f"part-{part:06d}.dac"
        scratch = f"{root}/.{uuid.uuid4().hex}"
        with filesystem.open_output_stream(scratch) as out:
            writer = _Writer(out)
            writer.add(first[0], first[1] + end)
            for doc_id, ids in encoded:
                writer.add(doc_id, ids + end)
            writer.close()
        filesystem.move(scratch, f"{root}/{name}")
        row = [[part], [f"{folder}/{name}"], [len(writer.ids)], [writer.starts[-1]]]
        kinds = [pa.int32(), pa.string(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(v, k) for v, k in zip(row, kinds)], names=["part", "file", "docs", "tokens"]
        )

    source = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")
    )
    ordered = source.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return stored(ordered.mapInArrow(run, MANIFEST), "token-manifest")


def read_tokens(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """Per document of the files: doc_id, start, n_tokens, ids_crc32.

    ``start`` counts the ids of all documents before it, over all files.
    """

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for file, before in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows = []
                for doc_id, start, parts in open_tokens(file).documents():
                    crc = 0
                    for part in parts:
                        crc = zlib.crc32(part.astype("<u4").tobytes(), crc)
                    rows.append((doc_id, before + start, sum(map(len, parts)), crc))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(column, pa.int64()) for column in zip(*rows)],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    # One row per file, so this window is as small as the list of files.
    before = F.sum("tokens").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    files = manifest.select("file", F.coalesce(before, F.lit(0)).cast("long").alias("before"))
    tasks = max(1, manifest.count())
    return files.repartition(tasks).mapInArrow(
        run, "doc_id long, start long, n_tokens long, ids_crc32 long"
    )


def token_round_trip(docs: DataFrame, tokenizer: str, end_id: int = 0, words: str = "spaced") -> DataFrame:
    """Write the documents as token files in a fresh shared folder and read them back."""
    spark = docs.sparkSession
    folder = new_folder(spark, "tokens")
    return read_tokens(spark, write_tokens(docs, tokenizer, folder, end_id, words))
