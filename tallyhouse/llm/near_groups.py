"""What near-duplicate joins share: sets, a table of how frequent their numbers are, candidate groups, classes.

A set is what `common.shingle_set` makes of a text. The frequency table has SLOTS counters whatever the input is:
tasks count into one each, Spark adds them up, the driver gets one byte per counter. All numbers have one order by
it, the rarest first, equal ones by hash; what the counters cannot tell apart changes that order, never a result.

Rows that share a doc_id are one document with several texts. A row without doc_id has a set size and no links.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import shingle_set, shuffle_width, stored
from tallyhouse.llm.graph import components

#: Counters of the frequency table, in pieces that are added up apart.
SLOTS, PIECE = 1 << 22, 1 << 16
#: Shingles that one block of a large candidate group holds.
BLOCK = 1_000_000
#: Keys that sets which link share at least, if they have as many; sets on a list of up to LONG are paired.
SHARED, LONG = 16, 32

#: What of a set is counted.
Part = Callable[[np.ndarray], np.ndarray]
#: Keys of a set, given the table.
Keys = Callable[[np.ndarray, np.ndarray], np.ndarray]


def order_keys(shingles: np.ndarray, levels: np.ndarray) -> np.ndarray:
    """A number for each shingle that sorts the rarest first; equal shingles have equal numbers everywhere."""
    return (levels[shingles & np.uint64(SLOTS - 1)].astype(np.uint64) << np.uint64(56)) | (shingles >> np.uint64(8))


def rarest(shingles: np.ndarray, levels: np.ndarray, n: int) -> np.ndarray:
    """The n rarest shingles."""
    if n >= len(shingles):
        return shingles
    return shingles[np.argpartition(order_keys(shingles, levels), n - 1)[:n]]


def _digest(shingles: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(shingles.tobytes())


def _node(shingles: np.ndarray) -> int:
    """64 bits of the set's hash, which name it while candidates are searched."""
    return int.from_bytes(_digest(shingles)[:8], "little", signed=True)


class _Counts:
    """Counters of one task; written out as pieces that hold anything."""

    def __init__(self):
        self.total = np.zeros(SLOTS, np.uint32)

    def add(self, numbers: np.ndarray) -> None:
        np.add.at(self.total, numbers & np.uint64(SLOTS - 1), np.uint32(1))

    def pieces(self) -> list[tuple[int, bytes]]:
        """In 8 bits each; a number that one task meets more often is frequent anyway."""
        small = np.minimum(self.total, 255).astype(np.uint8).reshape(-1, PIECE)
        return [(i, x.tobytes()) for i, x in enumerate(small) if x.any()]


def measured(docs: DataFrame, size: int, part: Part) -> DataFrame:
    """Stored, one row per row: doc_id, n_shingles, a 128-bit hash of the set and its node (missing where empty).

    More rows hold the pieces of each task's counters.
    """

    def measure(batches):
        counts = _Counts()
        for batch in batches:
            n, lengths, hashes = batch.num_rows, [], []
            for text in batch.column(1).to_pylist():
                s = shingle_set(text, size)
                counts.add(part(s))
                lengths.append(len(s))
                hashes.append(_digest(s) if len(s) else None)
            nodes = [None if h is None else int.from_bytes(h[:8], "little", signed=True) for h in hashes]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(lengths, pa.int64()),
                    pa.array(hashes, pa.binary()),
                    pa.array(nodes, pa.int64()),
                    pa.nulls(n, pa.int32()),
                    pa.nulls(n, pa.binary()),
                ],
                names,
            )
        for i, raw in counts.pieces():
            nothing = [pa.nulls(1, kind) for kind in (pa.int64(), pa.int64(), pa.binary(), pa.int64())]
            yield pa.RecordBatch.from_arrays([*nothing, pa.array([i], pa.int32()), pa.array([raw], pa.binary())], names)

    names = ["doc_id", "n_shingles", "set_hash", "node", "piece", "counts"]
    schema = "doc_id long, n_shingles long, set_hash binary, node long, piece int, counts binary"
    return stored(docs.select("doc_id", "text").mapInArrow(measure, schema), "sets")


def frequency(found: DataFrame) -> np.ndarray:
    """One byte per slot, the logarithm of its count; found: from `measured`."""

    def add(batches):
        totals = {}
        for batch in batches:
            for i, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                totals[i] = totals.get(i, 0) + np.frombuffer(raw, np.uint8).astype(np.uint64)
        for i, x in totals.items():
            level = np.minimum(255, np.round(8 * np.log2(1.0 + x))).astype(np.uint8)
            yield pa.RecordBatch.from_pydict({"piece": pa.array([i], pa.int32()), "levels": [level.tobytes()]})

    width = min(SLOTS // PIECE, shuffle_width(found.sparkSession))
    pieces = found.filter("piece is not null").select("piece", "counts").repartition(width, "piece")
    levels = np.zeros(SLOTS, np.uint8)
    for row in pieces.mapInArrow(add, "piece int, levels binary").collect():  # 4 MB in all
        levels[row["piece"] * PIECE :][:PIECE] = np.frombuffer(row["levels"], np.uint8)
    return levels


class _Lists:
    """Pairs of the lists of one partition, sorted by key, size and node, as they stream by.

    A list of at most `long` nodes gives the pairs whose sizes allow a link. A longer one ties each node to the first:
    anew wherever the next size is too large to link with any before.
    """

    def __init__(self, percent: int, long: int):
        self.percent, self.long = percent, long
        self.rows = [np.empty(0, np.int64)] * 3
        self.tied = None  # key, last size and first node of a long list that goes on

    def add(self, key: np.ndarray, n: np.ndarray, node: np.ndarray, last: bool = False) -> tuple[np.ndarray, ...]:
        """a, b, size of a, size of b, and whether the two are tied without a count."""
        key, n, node = (np.concatenate(x) for x in zip(self.rows, (key, n, node), strict=True))
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (node[1:] != node[:-1])  # equal sets from several tasks
        key, n, node = key[new], n[new], node[new]
        if not len(key):
            self.rows = [key, n, node]
            return (*[np.empty(0, np.int64)] * 4, np.empty(0, bool))
        starts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        sizes = np.diff(np.append(starts, len(key)))
        goes_on = self.tied is not None and self.tied[0] == key[0]
        is_long = sizes > self.long
        is_long[0] |= goes_on
        # The last list may go on with the next rows: a short one waits, a long one is tied as far as it is known.
        wait = int(starts[-1]) if not last and not is_long[-1] else len(key)
        row_long = np.repeat(is_long, sizes)
        out = []
        cold = np.flatnonzero(~row_long[:wait])
        k, m, x = key[cold], n[cold], node[cold]
        for step in range(1, self.long):
            same = k[step:] == k[:-step]
            if not same.any():
                break
            at = np.flatnonzero(same & (100 * m[:-step] >= self.percent * m[step:]))
            out.append((x[at], x[at + step], m[at], m[at + step], np.zeros(len(at), bool)))
        hot = np.flatnonzero(row_long[:wait])
        k, m, x = key[hot], n[hot], node[hot]
        if len(hot):
            begins = np.concatenate(([True], (k[1:] != k[:-1]) | (100 * m[:-1] < self.percent * m[1:])))
            if goes_on and 100 * self.tied[1] >= self.percent * m[0]:
                begins[0], leader = False, self.tied[2]
            else:
                leader = x[0]
            first = np.concatenate(([leader], x[begins]))[np.cumsum(begins)]
            at = np.flatnonzero(x != first)
            out.append((x[at], first[at], m[at], m[at], np.ones(len(at), bool)))
        self.tied = (key[-1], n[-1], first[-1]) if wait == len(key) and is_long[-1] else None
        self.rows = [key[wait:], n[wait:], node[wait:]]
        return tuple(np.concatenate(c) for c in zip(*out, strict=True)) if out else (*[np.empty(0, np.int64)] * 4, np.empty(0, bool))


def candidate_edges(docs: DataFrame, sizes: DataFrame, levels: np.ndarray, size: int, keys: Keys, need, percent: int, long: int = LONG) -> DataFrame:
    """(a, b): documents that share as many keys as sets that link must, or a key that is on a long list.

    keys(set, levels): the numbers a set is listed under; need(n): how many of them sets of at least n numbers share if
    they link. Pairs are counted for short lists only; what is on a long list is tied to its first, so nothing that
    links is lost and no list makes pairs beyond a bound per row. Equal sets are listed once.
    """
    table = docs.sparkSession.sparkContext.broadcast(levels)

    def emit(batches):
        for batch in batches:
            found, ns, nodes, seen = [], [], [], set()
            for text in batch.column(0).to_pylist():
                s = shingle_set(text, size)
                if not len(s) or (node := _node(s)) in seen:
                    continue
                seen.add(node)
                own = keys(s, table.value)
                found.append(own)
                ns.append(np.full(len(own), len(s), np.int64))
                nodes.append(np.full(len(own), node, np.int64))
            if found:
                columns = [np.concatenate(found).view(np.int64), np.concatenate(ns), np.concatenate(nodes)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["key", "n", "node"])

    def pair(batches):
        lists = _Lists(percent, long)

        def out(a, b, n_a, n_b, tied):
            least = [0 if t else need(min(x, y)) for x, y, t in zip(n_a.tolist(), n_b.tolist(), tied.tolist(), strict=True)]
            return pa.RecordBatch.from_pydict({"a": a, "b": b, "need": pa.array(least, pa.int32())})

        for batch in batches:
            yield out(*lists.add(*(batch.column(i).to_numpy() for i in range(3))))
        none = np.empty(0, np.int64)
        yield out(*lists.add(none, none, none, last=True))

    listed = docs.filter("doc_id is not null").select("text").mapInArrow(emit, "key long, n long, node long")
    width = shuffle_width(docs.sparkSession)
    pairs = listed.repartition(width, "key").sortWithinPartitions("key", "n", "node").mapInArrow(pair, "a long, b long, need int")
    enough = pairs.groupBy("a", "b").agg(F.count("*").alias("shared"), F.min("need").alias("need")).filter("shared >= need")
    enough = stored(enough.select("a", "b"), "candidate-sets")
    firsts = sizes.filter("doc_id is not null and node is not null").groupBy("node").agg(F.min("doc_id").alias("first"))
    for end in ("a", "b"):
        enough = enough.join(firsts.select(F.col("node").alias(end), F.col("first").alias(f"doc_{end}")), end)
    return enough.select(F.col("doc_a").alias("a"), F.col("doc_b").alias("b"))


def exact_links(docs: DataFrame, members: DataFrame, size: int, join, levels: np.ndarray, block: int = BLOCK) -> DataFrame:
    """(a, b): links among the members (doc_id, component, n_shingles) of each candidate component.

    join(sets, levels) gives links between sets that make the same classes as all links. A component of more than
    `block` shingles is cut into blocks, every two blocks in a task of their own.
    """
    total = members.groupBy("component").agg(F.sum("n_shingles").alias("total"))
    blocks = F.ceil(F.col("total") / block).cast("int")
    mine = F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int")
    cells = F.when(F.col("blocks") == 1, F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("j")))).otherwise(
        F.expr("transform(filter(sequence(0, blocks - 1), x -> x <> mine), x -> struct(least(x, mine) as i, greatest(x, mine) as j))")
    )
    dealt = (
        members.join(total, "component")
        .select("doc_id", "component", blocks.alias("blocks"))
        .withColumn("mine", mine)
        .select("doc_id", "component", F.explode(cells).alias("cell"))
        .select("doc_id", "component", "cell.i", "cell.j")
    )
    key, table = ["component", "i", "j"], docs.sparkSession.sparkContext.broadcast(levels)

    def run(batches):
        here, ids, sets = None, [], []

        def links():
            got = join(sets, table.value)
            return pa.RecordBatch.from_pydict(
                {"a": pa.array([ids[x] for x, _ in got], pa.int64()), "b": pa.array([ids[y] for _, y in got], pa.int64())}
            )

        for batch in batches:
            for component, i, j, doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (component, i, j) != here:
                    if len(ids) > 1:
                        yield links()
                    here, ids, sets = (component, i, j), [], []
                ids.append(doc_id)
                sets.append(shingle_set(text, size))
        if len(ids) > 1:
            yield links()

    # The members are a share of all documents, so they are no side to send to every task, however few they are here.
    return (
        docs.select("doc_id", "text")
        .join(dealt.hint("merge"), "doc_id")
        .select(*key, "doc_id", "text")
        .repartition(shuffle_width(docs.sparkSession), *key)
        .sortWithinPartitions(*key, "doc_id")
        .mapInArrow(run, "a long, b long")
        .filter("a <> b")
    )


def near_classes(docs: DataFrame, size: int, part: Part, candidates, join, block: int = BLOCK) -> DataFrame:
    """doc_id, n_shingles and component_id of every row: the least doc_id reachable by links.

    candidates(docs, sizes, levels) gives edges (a, b) that tie together, directly or not, all documents that link.
    """
    found = measured(docs, size, part)
    levels = frequency(found)
    sizes = found.filter("piece is null").drop("piece", "counts")
    # Equal sets first: one representative each. Grouped by hash, combined before the shuffle.
    equal = (
        sizes.filter("doc_id is not null and set_hash is not null")
        .groupBy("set_hash")
        .agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    )
    # Both sides of the join come from tables, so that a set a third of all documents have is split between tasks.
    equal = stored(equal.filter("first <> last").select("set_hash", "first"), "equal-sets")
    copies = sizes.filter("doc_id is not null").select("doc_id", "set_hash").join(equal, "set_hash").filter("doc_id <> first")
    ties = stored(stored(copies.select("doc_id", "first"), "copies").distinct(), "ties")
    texts = sizes.filter("doc_id is not null").groupBy("doc_id").agg(F.max("n_shingles").alias("n_shingles"))
    edges = candidates(docs, sizes, levels)
    maybe = components(stored(edges.filter("a <> b").distinct(), "candidates"))
    members = stored(
        maybe.join(texts, maybe["node"] == texts["doc_id"]).select("doc_id", "component", "n_shingles"), "members"
    )
    links = exact_links(docs, members, size, join, levels, block)
    linked = components(stored(links.unionByName(ties.select(F.col("doc_id").alias("a"), F.col("first").alias("b"))), "links"))
    return (
        sizes.select("doc_id", "n_shingles")
        .join(linked.withColumnRenamed("node", "doc_id"), "doc_id", "left")
        .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
    )


def oracle(size: int, percent: int, columns: str) -> str:
    """SQL for what `near_classes` gives on the table `documents` whose ids are unique: all pairs that share a shingle."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    gram = " || ' ' || ".join(f"w[i + {k}]" for k in range(size))
    return f"""
WITH RECURSIVE words AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS MATERIALIZED (
  SELECT DISTINCT doc_id, s FROM (
    SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {size} THEN [array_to_string(w, ' ')]
      ELSE list_transform(range(1, len(w) - {size} + 2), lambda i: {gram}) END) AS s FROM words)),
sizes AS MATERIALIZED (SELECT doc_id, count(s) AS n FROM documents LEFT JOIN shingles USING (doc_id) GROUP BY doc_id),
links AS MATERIALIZED (
  SELECT a, b FROM (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL)
  JOIN sizes m ON m.doc_id = a JOIN sizes n ON n.doc_id = b WHERE 100 * common >= {percent} * (m.n + n.n - common)),
reached AS (SELECT doc_id AS a, doc_id AS b FROM sizes UNION SELECT reached.a, links.b FROM reached JOIN links ON reached.b = links.a),
classes AS (SELECT a AS doc_id, min(b) AS component_id FROM reached GROUP BY a)
SELECT {columns} FROM sizes JOIN classes USING (doc_id)
"""
