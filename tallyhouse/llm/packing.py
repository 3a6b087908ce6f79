"""Packing by lexical retrieval: each window is a seed document and its nearest unused neighbours.

Documents are put in the order of their content, by weighted min-hashes, and cut into shards of bounded size: the more
of their weight two documents share, the likelier they stand together, however many others there are. A shard's BM25
index, with the weights of the whole corpus, answers for each seed which unused documents are nearest; they fill the
seed's window, the last one cut to fit, its rest left for later. What remains of a shard, less than one window, is cut
into powers of two, which need no padding. A neighbour in another shard is not found; the README has figures.

Missing text is an empty text, whose document is the separator alone. Rows that share a doc_id are packed each for
itself. No documents: no pieces.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import mix, stored
from tallyhouse.llm.tokens import encoder

WINDOW = 1024
SHARD_DOCS = 2048
#: Min-hashes that order the documents.
PLACES = 4
#: Terms of a seed that are looked up: its rarest.
QUERY_TERMS = 24
K1, B = 1.2, 0.75
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def idf_of(df: np.ndarray, n: int) -> np.ndarray:
    return np.log1p((n - df + 0.5) / (df + 0.5)).astype(np.float32)


class Index:
    """BM25 over the ids of a shard's documents, as postings in arrays."""

    def __init__(self, docs: list[np.ndarray], corpus: tuple[np.ndarray, float] | None = None):
        """corpus: idf by term and mean length; those of these documents if not given."""
        terms, counts = zip(*(np.unique(d, return_counts=True) for d in docs), strict=True)
        lengths = np.array([len(d) for d in docs], np.float32)
        owner = np.repeat(np.arange(len(docs), dtype=np.int32), [len(t) for t in terms])
        term, tf = np.concatenate(terms).astype(np.int32), np.concatenate(counts).astype(np.float32)
        order = np.argsort(term, kind="stable")
        self.terms, begin, df = np.unique(term[order], return_index=True, return_counts=True)
        self.ends = np.append(begin, len(term))
        idf = idf_of(df, len(docs)) if corpus is None else corpus[0][self.terms]
        mean = float(lengths.mean()) if corpus is None else corpus[1]
        own, tf = owner[order], tf[order]
        norm = K1 * (1 - B + B * lengths[own] / max(1.0, mean))
        self.owner, self.weight = own, np.repeat(idf, df) * tf * (K1 + 1) / (tf + norm)
        self.df, self.own_terms, self.n = df, terms, len(docs)

    def scores(self, seed: int) -> np.ndarray:
        rows = np.searchsorted(self.terms, self.own_terms[seed])
        rows = rows[self.df[rows] > 1]
        if len(rows) > QUERY_TERMS:
            rows = rows[np.argpartition(self.df[rows], QUERY_TERMS)[:QUERY_TERMS]]
        spans = [slice(self.ends[r], self.ends[r + 1]) for r in rows]
        if not spans:
            return np.zeros(self.n, np.float32)
        return np.bincount(
            np.concatenate([self.owner[s] for s in spans]), np.concatenate([self.weight[s] for s in spans]), self.n
        )


def draws(idf: np.ndarray) -> np.ndarray:
    """PLACES draws for each term, the smaller the more weight the term has; terms without weight are out of reach."""
    seeds = mix(np.arange(1, PLACES + 1, dtype=np.uint64))[:, None]
    u = ((mix(np.arange(len(idf), dtype=np.uint64) + seeds) >> np.uint64(11)).astype(np.float64) + 1) / 2.0**53
    with np.errstate(divide="ignore"):
        return -np.log(u) / idf


def place(tail: np.ndarray, draws: np.ndarray) -> list[int]:
    """PLACES min-hashes: two documents have one in common as likely as the share of weight their terms have in common.

    Terms of one document alone have no weight; without any other the document has no neighbours.
    """
    if not len(tail):
        return [-1] * PLACES
    drawn = draws[:, tail]
    least = drawn.argmin(axis=1)
    if not np.isfinite(drawn[0, least[0]]):
        return [-1] * PLACES
    return tail[least].tolist()


def pack_shard(
    lengths: np.ndarray, tails: list[np.ndarray], window: int = WINDOW, corpus: tuple[np.ndarray, float] | None = None
) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset) of one shard.

    lengths: ids of each document; tails: the ids each has beyond its whole windows, which its index entry is made of.
    """
    pieces, sequence = [], 0
    begin = lengths - np.array([len(t) for t in tails], np.int64)
    for doc, whole in enumerate(begin.tolist()):
        for start in range(0, whole, window):
            pieces.append((doc, start, window, sequence, 0))
            sequence += 1
    live = [i for i, t in enumerate(tails) if len(t)]
    if not live:
        return pieces
    index = Index([tails[i] for i in live], corpus)
    at, left = begin[live], np.array([len(tails[i]) for i in live], np.int64)
    unused = int(left.sum())
    seeds = np.argsort(-left, kind="stable")
    turn = 0
    while unused >= window:
        while not left[seeds[turn]]:
            turn += 1
        seed = int(seeds[turn])
        score = index.scores(seed)
        score[left == 0] = -1.0
        score[seed] = np.inf
        room, offset, taken = window, 0, 0
        want = min(64, index.n)
        while room:
            if taken == 0:
                near = np.argpartition(-score, want - 1)[:want] if want < index.n else np.arange(index.n)
                near = near[np.argsort(-score[near], kind="stable")]
            if taken >= len(near):  # more neighbours than asked for at first
                want, taken = index.n, 0
                continue
            doc = int(near[taken])
            taken += 1
            if not left[doc]:
                continue
            n = int(min(room, left[doc]))
            pieces.append((live[doc], int(at[doc]), n, sequence, offset))
            at[doc] += n
            left[doc] -= n
            room -= n
            offset += n
        unused -= window
        sequence += 1
    # Fewer ids than a window: powers of two, the largest first.
    rest = [i for i in seeds.tolist() if left[i]]
    for size in (1 << b for b in reversed(range(unused.bit_length())) if unused >> b & 1):
        offset = 0
        while offset < size:
            doc = rest[0]
            n = int(min(size - offset, left[doc]))
            pieces.append((live[doc], int(at[doc]), n, sequence, offset))
            at[doc] += n
            left[doc] -= n
            offset += n
            if not left[doc]:
                rest.pop(0)
        sequence += 1
    return pieces


def encoded(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """row, doc_id, n and ids of every row: ids in 16 bits where they fit, in 32 otherwise. row: a number of its own."""

    def encode(batches):
        of = encoder(tokenizer).encode
        for batch in batches:
            ids = [np.append(of(text), np.uint32(end_id)) for text in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([len(x) for x in ids], pa.int64()),
                    pa.array([x.astype("<u2" if x.max() < 1 << 16 else "<u4").tobytes() for x in ids], pa.binary()),
                ],
                ["row", "doc_id", "n", "ids"],
            )

    numbered = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    return stored(numbered.mapInArrow(encode, "row long, doc_id long, n long, ids binary"), "encoded")


def _ids(raw: bytes, n: int) -> np.ndarray:
    return np.frombuffer(raw, f"<u{len(raw) // n}").astype(np.uint32)


def _tail(ids: np.ndarray) -> np.ndarray:
    return ids[len(ids) // WINDOW * WINDOW :]


def corpus_weights(rows: DataFrame) -> tuple[np.ndarray, np.ndarray, float]:
    """idf by term, the same without terms of a single document, and mean length, of all tails.

    The driver gets one row per id of the tokenizer's vocabulary.
    """

    def count(batches):
        df, docs, total = np.zeros(1 << 16, np.int64), 0, 0
        for batch in batches:
            for n, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                tail = _tail(_ids(raw, n))
                if len(tail):
                    terms = np.unique(tail)
                    if terms[-1] >= len(df):
                        df = np.append(df, np.zeros(int(terms[-1]) + 1, np.int64))
                    df[terms] += 1
                    docs, total = docs + 1, total + len(tail)
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_pydict({"term": np.append(at, [-1, -2]), "df": np.append(df[at], [docs, total])})

    found = {r["term"]: r["df"] for r in rows.select("n", "ids").mapInArrow(count, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).collect()}
    docs, total = found.pop(-1, 0), found.pop(-2, 0)
    idf, shared = np.zeros(max(found, default=0) + 1, np.float32), np.zeros(max(found, default=0) + 1, np.float32)
    for term, df in found.items():
        idf[term] = idf_of(df, docs)
        shared[term] = idf[term] if df > 1 else 0
    return idf, shared, total / max(1, docs)


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = 0) -> DataFrame:
    """All pieces: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    rows = encoded(docs, tokenizer, end_id)
    idf, shared, mean = corpus_weights(rows)

    def locate(batches):
        drawn = draws(shared)
        for batch in batches:
            at = [place(_tail(_ids(raw, n)), drawn) for n, raw in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at, pa.list_(pa.int32()))], [*batch.schema.names, "place"])

    def pack(batches):
        # The partition's number, then that of the sequence in it.
        sequence, held = TaskContext.get().partitionId() << 40, []

        def shard():
            nonlocal sequence
            ids = [_ids(raw, n) for _, n, raw in held]
            lengths = np.array([len(x) for x in ids], np.int64)
            out = pack_shard(lengths, [_tail(x) for x in ids], WINDOW, (idf, mean))
            doc = np.array([p[0] for p in out], np.int64)
            batch = pa.RecordBatch.from_pydict(
                {
                    "doc_id": pa.array([held[d][0] for d in doc], pa.int64()),
                    "start": pa.array([p[1] for p in out], pa.int64()),
                    "length": pa.array([p[2] for p in out], pa.int64()),
                    "ids_crc32": pa.array([zlib.crc32(ids[p[0]][p[1] : p[1] + p[2]].astype("<u4", copy=False)) for p in out], pa.int64()),
                    "doc_tokens": pa.array(lengths[doc], pa.int64()),
                    "sequence_id": pa.array([sequence + p[3] for p in out], pa.int64()),
                    "offset": pa.array([p[4] for p in out], pa.int64()),
                }
            )
            sequence += max(p[3] for p in out) + 1
            held.clear()
            return batch

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                held.append(row)
                if len(held) == SHARD_DOCS:
                    yield shard()
        if held:
            yield shard()

    located = rows.mapInArrow(locate, "row long, doc_id long, n long, ids binary, place array<int>")
    # The row's number is stored, so documents of one place are split between tasks, and a repeated task packs alike.
    # The places are found twice, for the ranges and for the rows: that is less work than to store all ids again.
    parts = max(1, math.ceil(rows.count() / (4 * SHARD_DOCS)))
    return located.repartitionByRange(parts, "place", "row").sortWithinPartitions("place", "row").select("doc_id", "n", "ids").mapInArrow(pack, PIECES)
