"""Cross-tokenizer alignment: which tokens of vocabulary A cover the same bytes as which tokens of vocabulary B.

1. Each task encodes its documents with both tokenizers, in blocks of bounded size. The ends of A's and of B's tokens
   are two ascending lists of byte offsets; a block's documents stand one after another in them, so that one very long
   text and many short ones are the same work. Merging them is divided by merge path: on every PIECE-th diagonal a
   binary search finds how many ends of either list come before it, which gives pieces of equal work that do not need
   each other. A piece emits the offsets where tokens of both lists end; a group that crosses diagonals is stitched
   from the pieces at whose boundary it is open.
2. Links are counted per block and pair of ids before anything is shuffled: one row per block and pair. The sums over
   all blocks come back to the blocks by a join on the pair and a cogroup on the block, and each document adds up its own.

Missing and empty texts, and texts that the tokens' bytes do not give back, have no tokens: zeros and an empty string.
Rows are documents: rows that share a doc_id, or have none, stand each for itself and count each for itself. Long
groups without a common end are paired by distinct ids, not token by token. No documents: no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.llm.common import stored
from tallyhouse.llm.tokens import Encoder, byte_alphabet

#: Steps of the merge in one piece.
PIECE = 1 << 17
#: A block ends with so many documents or tokens of A.
BLOCK_DOCS, BLOCK_TOKENS = 4096, 6_000_000
#: Groups with more links than this are paired by distinct ids.
WIDE = 256


# -- merge path ---------------------------------------------------------------------------------------------------


def diagonals(a: np.ndarray, b: np.ndarray, piece: int) -> tuple[np.ndarray, np.ndarray]:
    """For every piece-th step of the merge of two ascending lists, and its end: elements of a, and of b, before it.

    Of equal elements a's comes first. All diagonals are searched at once, each by halving.
    """
    steps = np.append(np.arange(0, len(a) + len(b), piece), len(a) + len(b))
    low, high = np.maximum(0, steps - len(b)), np.minimum(steps, len(a))
    while (open_ := low < high).any():
        mid = (low + high) // 2
        here, there = mid[open_], steps[open_] - 1 - mid[open_]
        first = a[here] <= b[there]
        low[open_] = np.where(first, here + 1, low[open_])
        high[open_] = np.where(first, high[open_], here)
    return low, steps - low


def overlaps(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where a piece of a and a piece of b have equal elements: counts of elements up to and with them."""
    if not len(a) or not len(b):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    at = np.searchsorted(b, a)
    found = np.flatnonzero(b[np.minimum(at, len(b) - 1)] == a)
    return found + 1, at[found] + 1


def groups(a: np.ndarray, b: np.ndarray, piece: int = PIECE) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The groups piece by piece: edges in a and in b, the first being where the first group begins.

    a, b: ascending ends; both end with the same offset.
    """
    in_a, in_b = diagonals(a, b, piece)
    begin_a = begin_b = 0  # of the group that is open at the boundary
    for i0, i1, j0, j1 in zip(in_a[:-1].tolist(), in_a[1:].tolist(), in_b[:-1].tolist(), in_b[1:].tolist(), strict=True):
        at_a, at_b = overlaps(a[i0:i1], b[j0:j1])
        at_a, at_b = at_a + i0, at_b + j0
        if i1 > i0 and j1 < len(b) and a[i1 - 1] == b[j1]:  # the diagonal parts two equal ends
            at_a, at_b = np.append(at_a, i1), np.append(at_b, j1 + 1)
        if len(at_a):
            yield np.append(begin_a, at_a), np.append(begin_b, at_b)
            begin_a, begin_b = int(at_a[-1]), int(at_b[-1])


# -- tokens -------------------------------------------------------------------------------------------------------


class Pair:
    """Both tokenizers, with the bytes of their tokens."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece

        self.a = Encoder(a_path, specials=False)
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        letters = byte_alphabet()
        self.a_bytes = [b""] * (max(self.a.library.get_vocab().values()) + 1)
        for token, i in self.a.library.get_vocab().items():
            self.a_bytes[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        self.b_bytes = [
            bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()
            for i, piece in enumerate(map(self.b.id_to_piece, range(self.b.get_piece_size())))
        ]
        self.a_size = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_size = np.array([len(x) for x in self.b_bytes], np.int64)

    def tokens(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Ids by A and by B; none where the tokens' bytes are not the text's."""
        if text:
            a, b = self.a.encode(" " + text).tolist(), self.b.encode(text)
            want = (" " + text).encode()
            if b"".join(map(self.a_bytes.__getitem__, a)) == want == b"".join(map(self.b_bytes.__getitem__, b)):
                return np.array(a, np.int64), np.array(b, np.int64)
        return np.empty(0, np.int64), np.empty(0, np.int64)


_open: dict[tuple, Pair] = {}


def pair_of(a_path: str, b_path: str) -> Pair:
    """One per worker process."""
    if (a_path, b_path) not in _open:
        _open[a_path, b_path] = Pair(a_path, b_path)
    return _open[a_path, b_path]


# -- one block ----------------------------------------------------------------------------------------------------


def _summed(keys: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, and the sum of their times."""
    order = np.argsort(keys, kind="stable")
    keys, times = keys[order], times[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))[: len(keys)])
    return keys[first], np.add.reduceat(times, first) if len(first) else times


def _links(a: np.ndarray, b: np.ndarray, doc: np.ndarray, edge_a: np.ndarray, edge_b: np.ndarray, width: tuple[int, int]):
    """Distinct (document, A id, B id) of the groups between the edges, as one number each, and how often."""
    p, q = np.diff(edge_a), np.diff(edge_b)
    wide = p * q > WIDE
    p, q, at_a, at_b = p[~wide], q[~wide], edge_a[:-1][~wide], edge_b[:-1][~wide]
    size = p * q
    group = np.repeat(np.arange(len(p)), size)
    step = np.arange(len(group)) - np.repeat(np.cumsum(size) - size, size)
    i, j = at_a[group] + step // q[group], at_b[group] + step % q[group]
    keys = np.sort((doc[i] * width[0] + a[i]) * width[1] + b[j])
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))[: len(keys)])
    found, times = [keys[first]], [np.diff(np.append(first, len(keys)))]
    for g in np.flatnonzero(wide).tolist():
        in_a, n_a = np.unique(a[edge_a[g] : edge_a[g + 1]], return_counts=True)
        in_b, n_b = np.unique(b[edge_b[g] : edge_b[g + 1]], return_counts=True)
        found.append(((doc[edge_a[g]] * width[0] + in_a)[:, None] * width[1] + in_b[None, :]).ravel())
        times.append((n_a[:, None] * n_b[None, :]).ravel())
    if len(found) == 1:
        return found[0], times[0]
    return _summed(np.concatenate(found), np.concatenate(times))


def _digits(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Decimal digits of 0 to size - 1, zero bytes after them, one column more than the longest; and how many."""
    names = [str(i).encode() for i in range(size)]
    width = len(names[-1]) + 1
    return np.frombuffer(b"".join(n.ljust(width, b"\0") for n in names), np.uint8).reshape(size, width), np.array([len(n) for n in names])


_written: dict[int, tuple] = {}


def _spelled(a: np.ndarray, b: np.ndarray, edge_a: np.ndarray, edge_b: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The groups as a1,a2|b1;a3|b2; and where each group's bytes end."""
    if size not in _written:
        _written[size] = _digits(size)
    digits, length = _written[size]
    n_a, n_b = len(a), len(b)
    of_a = np.repeat(np.arange(len(edge_a) - 1), np.diff(edge_a))
    of_b = np.repeat(np.arange(len(edge_b) - 1), np.diff(edge_b))
    place_a, place_b = np.arange(n_a) + (edge_b[:-1] - edge_b[0])[of_a], np.arange(n_b) + (edge_a[1:] - edge_a[0])[of_b]
    ids, after = np.empty(n_a + n_b, np.int64), np.full(n_a + n_b, 44, np.uint8)
    ids[place_a], ids[place_b] = a, b
    after[place_a[edge_a[1:] - edge_a[0] - 1]] = 124
    last = place_b[edge_b[1:] - edge_b[0] - 1]
    after[last] = 59
    out = digits[ids]
    out[np.arange(len(ids)), length[ids]] = after
    return out[out != 0], np.cumsum(length[ids] + 1)[last]


def block_of(docs: list[tuple[int | None, np.ndarray, np.ndarray]], pair: Pair, piece: int = PIECE) -> dict:
    """What a block has: per document ids, counts and hash, its links by place in the block's list of pairs."""
    n_a, n_b = (np.array([len(d[k]) for d in docs], np.int64) for k in (1, 2))
    a, b = (np.concatenate([d[k] for d in docs]) for k in (1, 2))
    doc = np.repeat(np.arange(len(docs)), n_a)
    width = (len(pair.a_bytes), len(pair.b_bytes))
    n_groups, n_links = np.zeros(len(docs), np.int64), np.zeros(len(docs), np.int64)
    sums = [hashlib.sha256() if n else None for n in n_a.tolist()]
    ends, found, times = np.cumsum(n_a), [], []
    for edge_a, edge_b in groups(np.cumsum(pair.a_size[a]), np.cumsum(pair.b_size[b]), piece):
        key, n = _links(a, b, doc, edge_a, edge_b, width)
        found.append(key)
        times.append(n)
        text, text_end = _spelled(a[edge_a[0] : edge_a[-1]], b[edge_b[0] : edge_b[-1]], edge_a, edge_b, max(width))
        owner = doc[edge_a[:-1]]
        n_groups += np.bincount(owner, minlength=len(docs))
        n_links += np.bincount(owner, np.diff(edge_a) * np.diff(edge_b), len(docs)).astype(np.int64)
        # The groups of one document stand together; without a mark after the document's last one.
        stop = np.flatnonzero(np.append(owner[1:] != owner[:-1], True))
        raw, begin = text.tobytes(), 0
        for g in stop.tolist():
            done = edge_a[g + 1] == ends[owner[g]]
            sums[owner[g]].update(raw[begin : int(text_end[g]) - int(done)])
            begin = int(text_end[g])
    key, n = _summed(np.concatenate(found), np.concatenate(times)) if found else (np.empty(0, np.int64), np.empty(0, np.int64))
    pairs, place, held = np.unique(key % (width[0] * width[1]), return_inverse=True, return_counts=True)
    return {
        "doc_id": [d[0] for d in docs], "n_a": n_a, "n_b": n_b, "n_groups": n_groups, "n_links": n_links,
        "sha": [s.hexdigest() if s else "" for s in sums],
        "bounds": np.searchsorted(key, np.arange(len(docs) + 1) * (width[0] * width[1])),
        "place": place, "times": n, "a": pairs // width[1], "b": pairs % width[1], "held": held,
    }


def _narrow(x: np.ndarray) -> bytes:
    return x.astype("<u2" if not len(x) or x.max() < 1 << 16 else "<u4").tobytes()


def _wide(raw: bytes, n: int) -> np.ndarray:
    return np.frombuffer(raw, f"<u{len(raw) // n}" if n else "<u2").astype(np.int64)


DOC_LISTS = ("doc_id", "n_a", "n_b", "n_groups", "n_links")
PAYLOAD = ", ".join(f"{c} array<long>" for c in DOC_LISTS) + ", sha array<string>, bounds array<long>, place binary, times binary"
BLOCKS = f"block long, a int, b int, held long, spot int, {PAYLOAD}"
RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _block_rows(block: int, x: dict) -> pa.RecordBatch:
    """One row per pair of ids, and one that holds the documents."""
    n = len(x["a"])
    lists = {c: x[c] for c in DOC_LISTS}
    columns = {
        "block": pa.array([block] * (n + 1), pa.int64()),
        "a": pa.array([*x["a"].tolist(), None], pa.int32()),
        "b": pa.array([*x["b"].tolist(), None], pa.int32()),
        "held": pa.array([*x["held"].tolist(), None], pa.int64()),
        "spot": pa.array([*range(n), None], pa.int32()),
        **{c: pa.array([None] * n + [list(v)], pa.list_(pa.int64())) for c, v in lists.items()},
        "sha": pa.array([None] * n + [x["sha"]], pa.list_(pa.string())),
        "bounds": pa.array([None] * n + [x["bounds"].tolist()], pa.list_(pa.int64())),
        "place": pa.array([None] * n + [_narrow(x["place"])], pa.binary()),
        "times": pa.array([None] * n + [_narrow(x["times"])], pa.binary()),
    }
    return pa.RecordBatch.from_pydict(columns)


def _added_up(docs: pa.Table, pairs: pa.Table) -> pa.Table:
    """One row per document of the block; pairs: spot, count and best of each pair of the block."""
    row = {c: docs.column(c)[0].as_py() for c in docs.column_names} if docs.num_rows else None
    spot, counts, top = (pairs.column(c).to_numpy() for c in ("spot", "count", "best"))
    count, best = np.zeros(len(spot), np.int64), np.zeros(len(spot), np.int64)
    count[spot], best[spot] = counts, counts == top
    bounds = np.array(row["bounds"], np.int64)
    place, times = _wide(row["place"], int(bounds[-1])), _wide(row["times"], int(bounds[-1]))

    def total(values: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate(([0], np.cumsum(values * times)))[bounds])

    return pa.table(
        {
            **{c: pa.array(row[c], pa.int64()) for c in DOC_LISTS},
            "n_best": pa.array(total(best[place]), pa.int64()),
            "count_sum": pa.array(total(count[place]), pa.int64()),
            "groups_sha256": pa.array(row["sha"], pa.string()),
        }
    )


# -- the job ------------------------------------------------------------------------------------------------------


def blocks(docs: DataFrame, a_path: str, b_path: str, block_docs: int = BLOCK_DOCS, piece: int = PIECE) -> DataFrame:
    """The stored blocks of all documents: rows of pairs (a, b, held) and one row per block without a pair."""

    def encode(batches):
        pair, first, number = pair_of(a_path, b_path), TaskContext.get().partitionId() << 32, 0
        held, tokens = [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                held.append((doc_id, *pair.tokens(text)))
                tokens += len(held[-1][1])
                if len(held) >= block_docs or tokens >= BLOCK_TOKENS:
                    yield _block_rows(first + number, block_of(held, pair, piece))
                    held, tokens, number = [], 0, number + 1
        if held:
            yield _block_rows(first + number, block_of(held, pair, piece))

    return stored(docs.select("doc_id", "text").mapInArrow(encode, BLOCKS), "aligned")


def pair_counts(rows: DataFrame) -> DataFrame:
    """a, b, count (documents that hold the pair linked) and best (the highest count of a)."""
    counts = rows.filter("a is not null").groupBy("a", "b").agg(F.sum("held").alias("count"))
    # A window holds the pairs of one id of A: no more than B has ids.
    return counts.withColumn("best", F.max("count").over(Window.partitionBy("a")))


def align(docs: DataFrame, a_path: str, b_path: str, block_docs: int = BLOCK_DOCS, piece: int = PIECE) -> DataFrame:
    """Per document n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256."""
    rows = blocks(docs, a_path, b_path, block_docs, piece)
    counts = stored(pair_counts(rows), "pair-counts")
    pairs = rows.filter("a is not null").select(F.col("block").alias("own_block"), "spot", "a", "b").join(counts, ["a", "b"]).select("own_block", "spot", "count", "best")
    held = rows.filter("a is null").select("block", *DOC_LISTS, "sha", "bounds", "place", "times")
    return held.groupBy("block").cogroup(pairs.groupBy("own_block")).applyInArrow(_added_up, RESULT)
