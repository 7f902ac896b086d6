"""Token ids in seekable zstandard files: one independent frame per document, then a seek table.

Layout of a file (little-endian): the frames; a skippable frame (magic 0x184D2A50) with the document index
``count u64, width u8, nulls u64`` and the ids as int64 in file order (documents without an id come first);
a skippable frame (magic 0x184D2A5E) with the seek table of the public zstandard seekable format, per frame
``compressed size u32, decompressed size u32, checksum u32`` (low half of the XXH64 of the decompressed
bytes), and its footer ``frames u32, descriptor u8, magic u32 0x8F92EAB1``. A reader fetches footer, table and
index, and then decompresses the frames of the requested documents only; every checksum is verified.

Documents are range-partitioned by id, so that files and frames are in ascending id order; a file holds one
partition. Writing is repeatable: a rerun task writes the same bytes and puts the file in place at the end.

Defined results: a null or empty text is its end token alone; null ids come first, ids that repeat keep their
rows side by side in the order of their texts; an empty table writes no file and reads back as no rows; one
document may have up to 2**30 ids.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskframe.llm.bpe import encoder
from riskframe.llm.common import new_folder, rows_of, saved

END, LEVEL, FILE_ROWS = 2, 1, 8192
INDEX_MAGIC, TABLE_MAGIC, SEEK_MAGIC = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
_ENTRY, _FOOTER, _HEAD = struct.Struct("<III"), struct.Struct("<IBI"), struct.Struct("<II")
_COUNTS = struct.Struct("<QBQ")


def place(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder named by a URI or an absolute path."""
    return pafs.FileSystem.from_uri(uri)


class Writer:
    """Appends documents to an open binary stream and closes it with index and seek table."""

    def __init__(self, stream, width: int):
        self.stream, self.kind, self.entries, self.ids, self.nulls = stream, {2: "<u2", 4: "<u4"}[width], [], [], 0
        self.packer = zstandard.ZstdCompressor(level=LEVEL, write_content_size=True)

    def add(self, doc: int | None, ids: np.ndarray) -> None:
        raw = ids.astype(self.kind).tobytes()
        frame = self.packer.compress(raw)
        self.stream.write(frame)
        self.entries.append(_ENTRY.pack(len(frame), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
        self.nulls += doc is None
        self.ids.append(0 if doc is None else doc)

    def close(self) -> None:
        index = _COUNTS.pack(len(self.ids), int(self.kind[2]), self.nulls) + np.array(self.ids, "<i8").tobytes()
        self.stream.write(_HEAD.pack(INDEX_MAGIC, len(index)) + index)
        table = b"".join(self.entries) + _FOOTER.pack(len(self.entries), 0x80, SEEK_MAGIC)
        self.stream.write(_HEAD.pack(TABLE_MAGIC, len(table)) + table)


class Reader:
    """Random access to one file: ``ids`` lists its documents, ``read`` decompresses chosen frames."""

    def __init__(self, stream):
        self.stream = stream
        size = stream.size()
        stream.seek(size - _FOOTER.size)
        frames, descriptor, magic = _FOOTER.unpack(stream.read(_FOOTER.size))
        if magic != SEEK_MAGIC or descriptor != 0x80:
            raise ValueError("no seek table with checksums at the end of the file")
        table_at = size - _FOOTER.size - frames * _ENTRY.size
        index_size = _COUNTS.size + 8 * frames
        stream.seek(table_at - _HEAD.size - index_size)
        index = stream.read(index_size)
        count, self.width, nulls = _COUNTS.unpack_from(index)
        if count != frames:
            raise ValueError("index and seek table differ")
        self.ids = [None] * nulls + np.frombuffer(index, "<i8", offset=_COUNTS.size)[nulls:].tolist()
        stream.seek(table_at)
        self.table = np.frombuffer(stream.read(frames * _ENTRY.size), "<u4").reshape(-1, 3)
        self.starts = np.concatenate(([0], np.cumsum(self.table[:, 0], dtype=np.int64)))

    def lengths(self) -> np.ndarray:
        """Number of ids of each document, from the seek table alone."""
        return self.table[:, 1].astype(np.int64) // self.width

    def read(self, frames: Iterable[int]) -> Iterator[np.ndarray]:
        """The ids of the documents at the given places, as unsigned 32-bit numbers."""
        unpack = zstandard.ZstdDecompressor()
        for frame in frames:
            self.stream.seek(int(self.starts[frame]))
            raw = unpack.decompress(self.stream.read(int(self.table[frame, 0])))
            if len(raw) != self.table[frame, 1] or xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != self.table[frame, 2]:
                raise ValueError(f"checksum of frame {frame} is wrong")
            yield np.frombuffer(raw, f"<u{self.width}").astype("<u4")


def write(df: DataFrame, folder: str, vocabulary: str, key: str = "doc_id", text: str = "text", level: str = "byte",
          end: int = END, file_rows: int = FILE_ROWS) -> DataFrame:
    """Encode every whole text and write the files into ``folder``; gives the saved manifest
    (file, first document, documents, ids), one row per file in ascending document order."""
    files = max(1, -(-df.count() // file_rows))
    rows = df.select(F.col(key).cast("long").alias("doc"), F.col(text).cast("string").alias("_text"))
    ordered = rows.repartitionByRange(files, F.col("doc").asc_nulls_first(), F.xxhash64("_text")).sortWithinPartitions(
        F.col("doc").asc_nulls_first(), "_text"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        own, (system, path) = encoder(vocabulary, level), place(folder)
        system.create_dir(path, recursive=True)
        name = f"part-{TaskContext.get().partitionId():06d}.tokens"
        draft = f"{path}/.{name}.{uuid.uuid4().hex}"
        writer, total = None, 0
        with system.open_output_stream(draft) as stream:
            for batch in batches:
                docs, bodies = (list(x) for x in zip(*rows_of(batch, "doc", "_text"), strict=True)) if len(batch) else ([], [])
                for doc, found in zip(docs, own.encode_all(bodies), strict=True):
                    writer = writer or Writer(stream, 2 if own.code == "H" else 4)
                    ids = np.append(found, np.uint32(end))
                    writer.add(doc, ids)
                    total += len(ids)
            if writer:
                writer.close()
        own.forget()
        if not writer:
            system.delete_file(draft)
            return
        system.move(draft, f"{path}/{name}")
        yield pa.RecordBatch.from_pylist([{"file": name, "first": writer.ids[0], "documents": len(writer.ids), "ids": total}],
                                         schema=pa.schema([("file", pa.string()), ("first", pa.int64()), ("documents", pa.int64()), ("ids", pa.int64())]))

    return saved(ordered.mapInArrow(run, "file string, first bigint, documents bigint, ids bigint"), "manifest")


def digests(manifest: DataFrame, folder: str) -> DataFrame:
    """(doc, start, n_tokens, ids_crc32) of every document, read back from the files.

    ``start`` counts the ids of all earlier files (the manifest has one short row per file) and frames.
    """
    number = F.regexp_extract("file", r"(\d+)", 1).cast("long")  # names of different length do not sort as text
    before = F.coalesce(F.sum("ids").over(Window.orderBy(number).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = manifest.select("file", before.alias("before"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = place(folder)
        for batch in batches:
            for file, at in rows_of(batch, "file", "before"):
                with system.open_input_file(f"{path}/{file}") as stream:
                    reader = Reader(stream)
                    lengths = reader.lengths()
                    starts = at + np.concatenate(([0], np.cumsum(lengths)[:-1]))
                    crcs = [zlib.crc32(ids.tobytes()) for ids in reader.read(range(len(lengths)))]
                columns = [pa.array(reader.ids, pa.int64()), pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()), pa.array(crcs, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc", "start", "n_tokens", "ids_crc32"])

    files = manifest.count()
    spread = offsets.repartition(max(1, files), "file")
    return spread.mapInArrow(run, "doc bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def fetch(manifest: DataFrame, folder: str, wanted: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, ids) of the wanted documents: each file's index is read, and only their frames are decompressed.

    The files that may hold an id are found by binary search in the sorted first ids, one number per file.
    """
    listed = manifest.filter(F.col("first").isNotNull()).select("first", "file").orderBy(F.regexp_extract("file", r"(\d+)", 1).cast("long")).collect()
    firsts, files = np.array([r["first"] for r in listed], np.int64), [r["file"] for r in listed]
    nulls = {r["file"] for r in manifest.filter(F.col("first").isNull()).select("file").collect()}  # files that begin without an id
    sent = manifest.sparkSession.sparkContext.broadcast((firsts, files, sorted(nulls, key=lambda n: int("".join(filter(str.isdigit, n))))))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, names, unnamed = sent.value
        for batch in batches:
            docs = [d for (d,) in rows_of(batch, "doc")]
            low = np.maximum(np.searchsorted(first, docs, "left") - 1, 0)
            high = np.searchsorted(first, docs, "right")
            rows = [(n, d) for d, a, b in zip(docs, low, high, strict=True) for n in [*names[a:b], *(unnamed[-1:] if a == 0 else [])]]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.int64()))], names=["file", "doc"])

    asked = wanted.select(F.col(key).cast("long").alias("doc")).filter(F.col("doc").isNotNull()).distinct()
    grouped = asked.mapInArrow(route, "file string, doc bigint").groupBy("file").agg(F.collect_set("doc").alias("docs"))  # documents of one file

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = place(folder)
        for batch in batches:
            for file, docs in rows_of(batch, "file", "docs"):
                with system.open_input_file(f"{path}/{file}") as stream:
                    reader, want = Reader(stream), set(docs)
                    for frame in [i for i, doc in enumerate(reader.ids) if doc in want]:
                        ids = next(reader.read([frame])).tolist()
                        yield pa.RecordBatch.from_arrays([pa.array([reader.ids[frame]], pa.int64()), pa.array([ids], pa.list_(pa.int64()))], names=[key, "ids"])

    return grouped.mapInArrow(run, f"`{key}` bigint, ids array<bigint>")


def round_trip(spark: SparkSession, df: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Write ``df`` in the format to the shared folder and read every document's digest back."""
    folder = new_folder(spark, "tokens")
    return digests(write(df, folder, vocabulary, key, text), folder)
