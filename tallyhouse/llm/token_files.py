"""Token ids in fixed-width bit-packed files, with random access.

A file holds the documents of one range of doc_id, ascending: 8 bytes of magic, then blocks of 32 ids, each id in
`bits` bits (the fewest the vocabulary needs), so block b begins at byte 8 + 4 * bits * b and any id is found without
reading what stands before it; then one (doc_id, ids) pair per document, then the number of documents and of ids and
the bits, as 64-bit integers.

Missing text is an empty text: its document holds the end id only. Rows that share a doc_id each stand for themselves,
downwards by the text's hash; a missing id sorts first. Many rows of one id, or of none, are cut into files by that hash.
No documents: no files. A very long text is one row of one task. Columns other than doc_id and text are not looked at.
"""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.llm.common import NO_ID, bucket_of, id_cuts, shuffle_width, stored
from tallyhouse.llm.tokens import encoder
from tallyhouse.session import new_folder

MAGIC = b"idblocks"
LANES = 32
#: Ids unpacked or packed at once.
CHUNK = 1 << 18


def bits_for(vocabulary: int) -> int:
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Blocks of 32 ids, each in `bits` 32-bit words; the last block is filled up with zeros."""
    lanes = np.zeros((-(-len(ids) // LANES), LANES), np.uint64)
    lanes.reshape(-1)[: len(ids)] = ids
    words = np.zeros((len(lanes), bits + 1), np.uint64)
    for lane in range(LANES):
        word, shift = divmod(lane * bits, 32)
        moved = lanes[:, lane] << np.uint64(shift)
        words[:, word] |= moved & np.uint64(0xFFFFFFFF)
        words[:, word + 1] |= moved >> np.uint64(32)
    return words[:, :bits].astype("<u4").tobytes()


def unpack(raw: bytes, bits: int) -> np.ndarray:
    """The ids of whole blocks."""
    words = np.frombuffer(raw, "<u4").reshape(-1, bits).astype(np.uint64)
    words = np.concatenate([words, np.zeros((len(words), 1), np.uint64)], axis=1)
    out = np.empty((len(words), LANES), np.uint32)
    mask = np.uint64((1 << bits) - 1)
    for lane in range(LANES):
        word, shift = divmod(lane * bits, 32)
        out[:, lane] = ((words[:, word] | words[:, word + 1] << np.uint64(32)) >> np.uint64(shift)) & mask
    return out.reshape(-1)


class Writer:
    """One file; the name is new for each attempt, so that a repeated task disturbs no other."""

    def __init__(self, folder: str, bucket: int, bits: int):
        self.bits, self.bucket = bits, bucket
        self.path = f"{folder}/{bucket:08d}-{uuid.uuid4().hex}.ids"
        store, place = fs.FileSystem.from_uri(self.path)
        self.out = store.open_output_stream(place)
        self.out.write(MAGIC)
        self.docs, self.waiting, self.held, self.total = [], [], 0, 0

    def add(self, doc_id: int, ids: np.ndarray) -> None:
        self.docs.append((doc_id, len(ids)))
        self.waiting.append(ids)
        self.held += len(ids)
        self.total += len(ids)
        if self.held >= CHUNK:
            self._flush(self.held // LANES * LANES)

    def _flush(self, n: int) -> None:
        ids = np.concatenate(self.waiting) if self.waiting else np.empty(0, np.uint32)
        self.out.write(pack(ids[:n], self.bits))
        self.waiting, self.held = [ids[n:]], len(ids) - n

    def close(self) -> tuple[int, str, int, int]:
        self._flush(self.held)
        self.out.write(np.array(self.docs, "<i8").tobytes())
        self.out.write(np.array([len(self.docs), self.total, self.bits], "<i8").tobytes())
        self.out.close()
        return self.bucket, self.path, len(self.docs), self.total


class Reader:
    """Random access to one file."""

    def __init__(self, path: str):
        store, place = fs.FileSystem.from_uri(path)
        self.file = store.open_input_file(place)
        size = self.file.size()
        docs, self.total, self.bits = np.frombuffer(self.file.read_at(24, size - 24), "<i8").tolist()
        self.docs = np.frombuffer(self.file.read_at(16 * docs, size - 24 - 16 * docs), "<i8").reshape(-1, 2)
        self.starts = np.concatenate(([0], np.cumsum(self.docs[:, 1])))

    def ids(self, start: int, n: int) -> np.ndarray:
        """n ids from position start of the file."""
        first, last = start // LANES, -(-(start + n) // LANES)
        raw = self.file.read_at(4 * self.bits * (last - first), 8 + 4 * self.bits * first)
        return unpack(raw, self.bits)[start - first * LANES :][:n]


def write_files(docs: DataFrame, tokenizer: str, end_id: int, vocabulary: int) -> DataFrame:
    """Encode every text, write the files, return the manifest: bucket, path, n_docs, n_tokens, start.

    Only files the manifest names count; an attempt that was lost leaves a file nobody reads.
    """
    spark = docs.sparkSession
    folder, bits, parts = new_folder(spark, "ids"), bits_for(vocabulary), 2 * shuffle_width(spark)
    cuts = id_cuts(docs, parts)
    store, place = fs.FileSystem.from_uri(folder)
    store.create_dir(place, recursive=True)

    def write(batches):
        encode, file = encoder(tokenizer).encode, None
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(3)]
            for bucket, doc_id, text in zip(*columns, strict=True):
                if file is None or file.bucket != bucket:
                    if file is not None:
                        yield done(file)
                    file = Writer(folder, bucket, bits)
                file.add(doc_id, np.append(encode(text), np.uint32(end_id)))
        if file is not None:
            yield done(file)

    def done(file):
        bucket, path, n_docs, n_tokens = file.close()
        return pa.RecordBatch.from_pydict(
            {"bucket": pa.array([bucket], pa.int64()), "path": [path], "n_docs": pa.array([n_docs], pa.int64()), "n_tokens": pa.array([n_tokens], pa.int64())}
        )

    placed = (
        docs.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("doc_id"), "text")
        .withColumn("spot", bucket_of(cuts, F.col("doc_id"), F.col("text")))
        .select(F.shiftright("spot", 1).alias("bucket"), "doc_id", "text")
        .repartition(parts, "bucket")
        .sortWithinPartitions("bucket", "doc_id", F.desc(F.xxhash64("text")))
    )
    files = stored(placed.mapInArrow(write, "bucket long, path string, n_docs long, n_tokens long"), "manifest")
    # One row per file; the running sum orders files, not documents.
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def read_files(manifest: DataFrame) -> DataFrame:
    """One row per document of the files: doc_id, start, n_tokens, ids_crc32."""

    def read(batches):
        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                file = Reader(path)
                at, loaded, base = 0, np.empty(0, np.uint32), 0
                sums = []
                for n in file.docs[:, 1].tolist():
                    crc, left = 0, n
                    while left:
                        if at - base >= len(loaded):
                            base = at
                            loaded = file.ids(at, min(CHUNK, file.total - at))
                        piece = loaded[at - base : at - base + left]
                        crc = zlib.crc32(piece.astype("<u4", copy=False), crc)
                        at += len(piece)
                        left -= len(piece)
                    sums.append(crc)
                yield pa.RecordBatch.from_pydict(
                    {"doc_id": file.docs[:, 0], "start": start + file.starts[:-1], "n_tokens": file.docs[:, 1], "ids_crc32": pa.array(sums, pa.int64())}
                )

    n = max(1, shuffle_width(manifest.sparkSession))
    return (
        manifest.repartition(n, "bucket")
        .select("path", "start")
        .mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")
        .withColumn("doc_id", F.nullif("doc_id", F.lit(NO_ID)))
    )
