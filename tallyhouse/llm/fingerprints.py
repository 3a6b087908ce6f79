"""Document fingerprints by winnowing.

Every run of K characters is hashed; of each W neighbouring hashes the least is kept, the rightmost among equals, with
its position. Two texts that share a run of at least K + W - 1 characters share a kept hash.

Missing text is an empty text; its fingerprint is empty, and two empty fingerprints are alike (1.0). A text shorter
than K characters is one gram. Rows that share a doc_id follow each other by their text's hash; a missing doc_id is
last in descending order. Many rows of one id, or of none, are cut into ranges by that hash; only copies of one text
under one id stay in one range. A single document is its own next document. A very long text is one row of one task,
and takes some 40 bytes a character there. Columns other than doc_id and text are not looked at, whatever their names.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import NO_ID, bucket_of, id_cuts, mix, shuffle_width

K, W = 16, 32
GUARANTEE = K + W - 1
_BASE = 0x9E3779B97F4A7C15
FIELDS = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string,"
    " near_edited double, near_next double, positions array<int>"
)


def gram_hashes(codes: np.ndarray, k: int = K) -> np.ndarray:
    """32-bit hashes of all runs of k code points; doubling the length reuses the shorter runs' hashes."""
    if not len(codes):
        return np.empty(0, np.uint32)
    hashes, length, base = codes.astype(np.uint64) + np.uint64(1), 1, _BASE
    k = min(k, len(codes))
    result, done = None, 0
    while True:
        if k & length:  # append this run to what is joined so far
            if result is None:
                result = hashes
            else:
                n = len(codes) - done - length + 1
                result = result[:n] * np.uint64(base) + hashes[done : done + n]
            done += length
        length *= 2
        if length > k:
            break
        n, half = len(codes) - length + 1, length // 2
        hashes = hashes[:n] * np.uint64(base) + hashes[half : half + n]
        base = base * base % 2**64
    return (mix(result + np.uint64(k)) >> np.uint64(32)).astype(np.uint32)


def winnow(hashes: np.ndarray, w: int = W) -> np.ndarray:
    """Positions of each window's least hash, the rightmost among equals; ascending, each once."""
    n = len(hashes)
    if not n:
        return np.empty(0, np.int64)
    w = min(w, n)
    # The position counts down in the low half, so that the least of equals is the rightmost.
    best = hashes.astype(np.uint64) << np.uint64(32) | np.arange(2**32 - 1, 2**32 - 1 - n, -1, dtype=np.int64).astype(np.uint64)
    length = 1
    while 2 * length <= w:
        best = np.minimum(best[:-length], best[length:])
        length *= 2
    if length < w:
        best = np.minimum(best[: n - w + 1], best[w - length :][: n - w + 1])
    spots = np.int64(2**32 - 1) - (best & np.uint64(0xFFFFFFFF)).astype(np.int64)
    return spots[np.concatenate(([True], spots[1:] != spots[:-1]))]


def fingerprint(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes kept of a text."""
    hashes = gram_hashes(codes_of(text))
    spots = winnow(hashes)
    return spots, hashes[spots]


def codes_of(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), "<u4")


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two sorted sets of hashes."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def _as_text(hashes: np.ndarray) -> str:
    return hashes.astype(">u4").tobytes().hex()


class _Row:
    def __init__(self, doc_id: int | None, text: str | None):
        self.doc_id, self.text = doc_id, text or ""
        self.spots, self.hashes = fingerprint(self.text)
        self.set = np.unique(self.hashes)


def _compare(row: _Row, after: _Row) -> tuple:
    half = len(row.text) // 2
    edited = row.text[: len(row.text) - half] + after.text[:half]
    hashes = fingerprint(edited)[1]
    return (
        None if row.doc_id == NO_ID else row.doc_id,
        len(row.text),
        hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
        _as_text(row.hashes),
        _as_text(hashes),
        likeness(row.set, np.unique(hashes)),
        likeness(row.set, after.set),
        row.spots.astype(np.int32),
    )


def compare_with_next(docs: DataFrame) -> DataFrame:
    """Each document's fingerprint, that of its edited text, and their likeness to it and to the next document.

    `positions` are the code points at which the fingerprint's hashes begin, one for each eight of its digits: of any
    GUARANTEE code points in a row, one hash lies in them whole.

    The edited text ends with the beginning of the next document, in descending order of doc_id; the first follows the
    last. Documents go to ranges of ids; the first document of a range goes to the range before it as well, so that
    each range is worked through by itself. One shuffle of the texts.
    """
    spark = docs.sparkSession
    parts = 4 * shuffle_width(spark)
    cuts = id_cuts(docs, parts)
    n = len(cuts)

    def work(batches):
        bucket, held, out = None, None, []

        def flush():
            kinds = [None] * (len(names) - 1) + [pa.list_(pa.int32())]
            batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)
            out.clear()
            return batch

        for batch in batches:
            for here, guest, doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if here != bucket:
                    bucket, held = here, None
                row = _Row(doc_id, text) if held is not None or not guest else None
                if held is not None:
                    out.append(_compare(held, row))
                    if len(out) >= 256:
                        yield flush()
                # Rows with the guest's id come after; only the first of them is next to the range's last document.
                held = None if guest else row
        if out:
            yield flush()

    names = [f.split()[0] for f in FIELDS.split(",")]
    # Range b is worked through downwards; after it comes the upper end of range b - 1, after range 0 the largest id.
    spot = F.shiftright("spot", 1)
    dealt = (
        docs.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("doc_id"), "text")
        .withColumn("spot", bucket_of(cuts, F.col("doc_id"), F.col("text")))
        .select(
            F.explode(
                F.when(
                    F.col("spot") % 2 == 1,
                    F.array(F.struct(spot.alias("bucket"), F.lit(0).alias("guest")), F.struct(F.pmod(spot + 1, F.lit(n)).alias("bucket"), F.lit(1).alias("guest"))),
                ).otherwise(F.array(F.struct(spot.alias("bucket"), F.lit(0).alias("guest"))))
            ).alias("to"),
            "doc_id",
            "text",
        )
        .select("to.bucket", "to.guest", "doc_id", "text")
        .repartition(parts, "bucket")
        .sortWithinPartitions("bucket", "guest", F.desc("doc_id"), F.xxhash64("text"))
    )
    return dealt.mapInArrow(work, FIELDS)
