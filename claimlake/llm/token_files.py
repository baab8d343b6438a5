"""Token ids in files of independent zstandard frames with a seek table.

Format of a file (readable by any zstandard tool, as skippable frames are passed over):

* one zstandard frame a document: its ids, 32-bit little-endian unsigned, the end id last;
* a skippable frame (magic 0x184D2A51) with the doc_ids, 64-bit little-endian signed, one a document;
* a skippable frame (magic 0x184D2A5E), the seek table: for each document compressed size, size and
  the low 32 bits of the XXH64 of the ids; then the number of frames, a flag byte and 0x8F92EAB1. The
  frames stand first in the file, so a reader of that format finds each by adding up sizes.

A reader takes the table from the end of the file and then fetches and expands only the frames it
wants. Files hold documents in ascending doc_id order, and so does the list of files.

Documents are dealt by quantiles of doc_id, so a file's size is bounded and no task sees more than its
ranges. Tasks write under names of their own attempt; only files named in the manifest, a table that
Spark commits, are ever read, so a lost executor leaves at most an unused file.

Defined results: a null text counts as empty (its ids are the end id alone); equal doc_ids are
ordered by text; a null doc_id comes before all others; further columns are ignored; no documents,
no files.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .store import materialise, new_path, read_documents, small_batches
from .tokens import default_tokenizer, encoder

IDS_MAGIC, SEEK_MAGIC, SEEK_END = 0x184D2A51, 0x184D2A5E, 0x8F92EAB1
DOCS_PER_FILE = 1000
#: Files a writing or reading task has, about, once there are more than the session's shuffle partitions.
FILES_PER_TASK = 50
#: Ranges of ids at most; a file then holds more documents.
MAX_RANGES = 1 << 16


def id_ranges(docs: DataFrame, per_range: int, n: int | None = None) -> Column:
    """Number of the quantile range of each doc_id, ascending; ranges hold about ``per_range`` rows."""
    n = docs.count() if n is None else n
    k = min(MAX_RANGES, max(1, n // per_range))
    bounds: list[int] = []
    if k > 1:
        shares = [i / k for i in range(1, k)]
        bounds = sorted(set(docs.agg(F.percentile_approx("doc_id", shares, max(10_000, 4 * k))).first()[0] or []))

    @F.pandas_udf("long")
    def range_of(doc_id):
        import pandas as pd

        return pd.Series(np.searchsorted(np.array(bounds, dtype=np.int64), doc_id.to_numpy(), side="left"))

    return range_of(F.coalesce("doc_id", F.lit(-(2**63))))


def task_count(spark: SparkSession, units: int, per_task: int) -> int:
    """Partitions for a shuffle of ``units``: those of the session, or more where the data are larger."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")), -(-units // per_task))


def frame_file(doc_ids: np.ndarray, frames: list[bytes], sizes: list[int], sums: list[int]) -> bytes:
    head = doc_ids.astype("<i8").tobytes()
    table = np.column_stack([[len(f) for f in frames], sizes, sums]).astype("<u4").tobytes() + struct.pack("<IBI", len(frames), 0x80, SEEK_END)
    return b"".join([*frames, struct.pack("<II", IDS_MAGIC, len(head)), head, struct.pack("<II", SEEK_MAGIC, len(table)), table])


class FrameFile:
    """Random access to one file of frames."""

    def __init__(self, source: pa.NativeFile) -> None:
        self.source, end = source, source.size()
        source.seek(end - 9)
        n, _, magic = struct.unpack("<IBI", source.read(9))
        if magic != SEEK_END:
            raise ValueError("not a seekable file")
        source.seek(end - 9 - 12 * n)
        self.table = np.frombuffer(source.read(12 * n), "<u4").reshape(n, 3)
        self.at = np.concatenate(([0], np.cumsum(self.table[:, 0].astype(np.int64))))
        source.seek(int(self.at[-1]))
        magic, size = struct.unpack("<II", source.read(8))
        if magic != IDS_MAGIC:
            raise ValueError("doc_ids are missing")
        self.doc_ids = np.frombuffer(source.read(size), "<i8")
        self.reader = zstandard.ZstdDecompressor()

    def __len__(self) -> int:
        return len(self.table)

    def raw(self, i: int) -> bytes:
        """The ids of document i as bytes; ValueError if they aren't what was written."""
        self.source.seek(int(self.at[i]))
        out = self.reader.decompress(self.source.read(int(self.table[i, 0])), max_output_size=int(self.table[i, 1]))
        if len(out) != self.table[i, 1] or xxhash.xxh64_intdigest(out) & 0xFFFFFFFF != self.table[i, 2]:
            raise ValueError(f"frame {i} is damaged")
        return out


_MANIFEST = "range_no long, part long, file string, n_docs long, n_tokens long"


def write_files(docs: DataFrame, folder: str, tokenizer: str, per_file: int = DOCS_PER_FILE) -> DataFrame:
    """Write all documents under ``folder`` (a URI that every executor reaches) and return the manifest."""
    small_batches(docs.sparkSession)
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    n = slim.count()
    ranges = id_ranges(slim.select("doc_id"), per_file, n)
    tasks = task_count(docs.sparkSession, -(-n // per_file), FILES_PER_TASK)
    dealt = slim.withColumn("range_no", ranges).repartition(tasks, "range_no").sortWithinPartitions("range_no", F.col("doc_id").asc_nulls_first(), "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = pa.fs.FileSystem.from_uri(folder)
        fs.create_dir(base, recursive=True)
        ids_of, squeeze = encoder(tokenizer), zstandard.ZstdCompressor(level=1, write_checksum=False)
        now, part, held, held_bytes = None, 0, [[], [], [], []], 0

        def close() -> pa.RecordBatch:
            name = f"{base}/{now:08d}-{part:04d}-{uuid.uuid4().hex}.zst"
            with fs.open_output_stream(name, compression=None) as out:
                out.write(frame_file(np.array(held[0], np.int64), *held[1:]))
            row = [[now], [part], [name], [len(held[0])], [sum(held[2]) // 4]]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in row], ["range_no", "part", "file", "n_docs", "n_tokens"])

        for batch in batches:
            numbers = batch.column("range_no").to_numpy()
            doc_ids = batch.column("doc_id").fill_null(-(2**63)).to_numpy()
            for i, j, ids, counts in ids_of.encode(batch.column("text")):
                raw, ends = ids.astype("<u4", copy=False), np.cumsum(counts)
                for k in range(i, j):
                    if held[0] and (numbers[k] != now or len(held[0]) >= 4 * per_file or held_bytes > 1 << 26):
                        yield close()
                        part = part + 1 if numbers[k] == now else 0
                        held, held_bytes = [[], [], [], []], 0
                    now = int(numbers[k])
                    one = raw[ends[k - i] - counts[k - i] : ends[k - i]].tobytes()
                    held[0].append(int(doc_ids[k]))
                    held[1].append(squeeze.compress(one))
                    held_bytes += len(held[1][-1])
                    held[2].append(len(one))
                    held[3].append(xxhash.xxh64_intdigest(one) & 0xFFFFFFFF)
        if held[0]:
            yield close()

    return materialise(dealt.mapInArrow(write, _MANIFEST), "manifest")


_READ = "doc_id long, start long, n_tokens long, ids_crc32 long, file string, frame int"


def read_files(manifest: DataFrame, folder: str) -> DataFrame:
    """One row a document, read back from the files: place of its ids among all, count and CRC-32."""
    before = F.coalesce(F.sum("n_tokens").over(Window.orderBy("range_no", "part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    files = manifest.select("file", before.cast("long").alias("start"))  # a row a file: few enough for one task
    tasks = task_count(manifest.sparkSession, manifest.count(), FILES_PER_TASK)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = pa.fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name, start in zip(batch.column("file").to_pylist(), batch.column("start").to_pylist(), strict=True):
                with fs.open_input_file(name) as source:
                    f = FrameFile(source)
                    counts = f.table[:, 1].astype(np.int64) // 4
                    at = start + np.concatenate(([0], np.cumsum(counts)[:-1]))
                    sums = [zlib.crc32(f.raw(i)) for i in range(len(f))]
                    none = pa.array(f.doc_ids == -(2**63)) if len(f) else None
                    doc_ids = pa.array(np.array(f.doc_ids), mask=none.to_numpy(zero_copy_only=False) if none is not None else None)
                    yield pa.RecordBatch.from_arrays([doc_ids, pa.array(at), pa.array(counts), pa.array(sums, pa.int64()), pa.array([name] * len(f)), pa.array(np.arange(len(f), dtype=np.int32))], ["doc_id", "start", "n_tokens", "ids_crc32", "file", "frame"])

    return files.repartition(tasks, "file").mapInArrow(read, _READ)


def fetch(manifest: DataFrame, folder: str, wanted: DataFrame) -> DataFrame:
    """doc_id and ids (bytes) of the documents in ``wanted`` (columns file, frame); no other frame is expanded."""
    tasks = task_count(manifest.sparkSession, manifest.count(), FILES_PER_TASK)

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = pa.fs.FileSystem.from_uri(folder)
        name, f = None, None
        for batch in batches:
            for file, frame in zip(batch.column("file").to_pylist(), batch.column("frame").to_pylist(), strict=True):
                if file != name:
                    name, f = file, FrameFile(fs.open_input_file(file))
                yield pa.RecordBatch.from_arrays([pa.array([int(f.doc_ids[frame])]), pa.array([f.raw(frame)], pa.binary())], ["doc_id", "ids"])

    rows = wanted.join(manifest.select("file"), "file", "left_semi").select("file", "frame")
    return rows.repartition(tasks, "file").sortWithinPartitions("file", "frame").mapInArrow(pick, "doc_id long, ids binary")


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_path(spark, "tokens")
    manifest = write_files(read_documents(spark, sf_dir), folder, default_tokenizer())
    return read_files(manifest, folder).select("doc_id", "start", "n_tokens", "ids_crc32", "frame")
