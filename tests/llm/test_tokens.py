import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallyhouse.llm import packing, token_files
from tallyhouse.llm.tokens import Encoder, tokenizer_path
from tests.llm import cases

FILES = ["byte_bpe_50k.json", "word_bpe_49k.json"]


@pytest.mark.parametrize("name", FILES)
def test_table_equals_library(name):
    whole, ours = Tokenizer.from_file(tokenizer_path(name)), Encoder(tokenizer_path(name))
    more = ["", "'s's 're''s x's don'tll 'Ve it'd1'm 22'll", "l'été d'œuvre ¿qué? «é»…’s ŐŰ ÀÖ×÷ İı ŉ ſ µª²", "x" * 300 + "é" * 300, "a  b", "it's. Don't!!s", "x\x1cy\x85z", " lead", "trail \n", "\n\n", "A.,B", "ΑΣ.Σ", "ﬁ ﷺ é ́x", "<|startoftext|>"]
    for text in [t or "" for t in cases.texts()] + more:
        assert ours.encode(text).tolist() == whole.encode(text, add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=" \n\tab.,'sAΣé!́<|>1　dvlrÉ¿–ß", max_size=40))
def test_any_text(text):
    for name in FILES:
        if name not in _OPEN:
            _OPEN[name] = (Tokenizer.from_file(tokenizer_path(name)), Encoder(tokenizer_path(name)))
        whole, ours = _OPEN[name]
        assert ours.encode(text).tolist() == whole.encode(text, add_special_tokens=False).ids


_OPEN: dict = {}


@pytest.mark.parametrize("bits", [1, 7, 15, 16, 17, 32])
def test_packed_bits_come_back(bits):
    ids = np.random.default_rng(bits).integers(0, 2**bits, 1000, dtype=np.uint32)
    raw = token_files.pack(ids, bits)
    assert len(raw) == 4 * bits * 32
    assert token_files.unpack(raw, bits)[:1000].tolist() == ids.tolist()


def test_files_give_back_all_ids(spark):
    docs = cases.documents(spark, extra=True).filter("doc_id is null or doc_id not in (10, 990)").repartition(4)
    manifest = token_files.write_files(docs, tokenizer_path("word_bpe_49k.json"), 1, 49_408)
    found = sorted(token_files.read_files(manifest).collect(), key=lambda r: r.start)
    whole = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    rows = sorted(docs.select("doc_id", "text").collect(), key=lambda r: (r.doc_id is not None, r.doc_id))
    start = 0
    for row, got in zip(rows, found, strict=True):
        ids = np.array(whole.encode(row.text or "", add_special_tokens=False).ids + [1], "<u4")
        assert (got.doc_id, got.start, got.n_tokens, got.ids_crc32) == (row.doc_id, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    one = manifest.orderBy("bucket").first()
    reader = token_files.Reader(one.path)
    if reader.total > 3:
        assert reader.ids(2, 1).tolist() == reader.ids(0, reader.total)[2:3].tolist()


def test_files_of_repeated_and_no_rows(spark):
    write = lambda df: token_files.read_files(token_files.write_files(df, tokenizer_path("word_bpe_49k.json"), 1, 49_408))
    assert write(cases.documents(spark)).count() == len(cases.texts()) + 4
    assert write(cases.empty(spark)).count() == 0


def test_many_rows_without_an_id_go_to_several_files(spark):
    rows = [(None, f"{i} {cases.prose(i, 10)}") for i in range(300)] + [(i, cases.prose(i, 5)) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    files = token_files.write_files(docs, tokenizer_path("word_bpe_49k.json"), 1, 49_408)
    whole = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    given = docs.select("doc_id", "text", F.xxhash64("text").alias("h")).collect()
    given.sort(key=lambda r: (r.doc_id is not None, r.doc_id or 0, -r.h))
    expect, start = [], 0
    for r in given:
        ids = np.array([*whole.encode(r.text, add_special_tokens=False).ids, 1], "<u4")
        expect.append((start, str(r.doc_id), len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    found = token_files.read_files(files).collect()
    assert sorted((r.start, str(r.doc_id), r.n_tokens, r.ids_crc32) for r in found) == expect
    assert max(r.n_docs for r in files.collect()) < 120


def check_packing(pieces, ids_of, window):
    by_doc, by_sequence = {}, {}
    for doc, start, length, sequence, offset in pieces:
        by_doc.setdefault(doc, []).append((start, length))
        by_sequence.setdefault(sequence, []).append((offset, length))
    for doc, n in ids_of.items():
        at = 0
        for start, length in sorted(by_doc[doc]):
            assert start == at
            at += length
        assert at == n
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at == window or at & (at - 1) == 0


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(1, 90), min_size=1, max_size=40))
def test_shard_uses_every_id_once(sizes):
    window = 32
    draw = np.random.default_rng(len(sizes))
    ids = [draw.integers(0, 20, n, dtype=np.uint32) for n in sizes]
    tails = [x[len(x) // window * window :] for x in ids]
    pieces = packing.pack_shard(np.array(sizes, np.int64), tails, window)
    check_packing(pieces, dict(enumerate(sizes)), window)


def test_neighbours_share_words():
    """Two topics in equal parts: a window holds one topic for as long as there is enough of it."""
    draw = np.random.default_rng(0)
    topics = [draw.integers(base, base + 50, 100, dtype=np.uint32) for i in range(40) for base in ((0, 1000)[i % 2],)]
    pieces = packing.pack_shard(np.full(40, 100, np.int64), topics, 400)
    by_sequence = {}
    for doc, _, length, sequence, _ in pieces:
        by_sequence.setdefault(sequence, set()).add(doc % 2)
    assert sum(len(s) == 1 for s in by_sequence.values()) >= 0.7 * len(by_sequence)


def test_neighbours_meet_among_many_shards(spark, monkeypatch):
    """Pairs of near copies, far more of them than a shard holds: nearly all are packed into one window."""
    monkeypatch.setattr(packing, "SHARD_DOCS", 16)
    rows = [(2 * i + k, cases.prose(i, 300, 20_000) + f" end{k}") for i in range(120) for k in (0, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    shards = {}
    for r in packing.pack_documents(docs, tokenizer_path("byte_bpe_50k.json")).collect():
        shards.setdefault(r.doc_id // 2, {}).setdefault(r.doc_id % 2, set()).add(r.sequence_id)
    assert len(shards) == 120 and sum(bool(s[0] & s[1]) for s in shards.values()) >= 0.8 * 120


def test_rows_without_id_and_equal_rows_are_split(spark, monkeypatch):
    monkeypatch.setattr(packing, "SHARD_DOCS", 16)
    docs = spark.createDataFrame([(None if i % 2 else 5, "the same text " * 20) for i in range(400)], "doc_id long, text string").repartition(4)
    found = packing.pack_documents(docs, tokenizer_path("byte_bpe_50k.json"))
    assert found.select(F.shiftright("sequence_id", 40)).distinct().count() > 3
    total = {r.doc_id: r.n for r in found.groupBy("doc_id").agg(F.sum("length").alias("n")).collect()}
    assert total[5] == total[None] == 200 * found.first().doc_tokens


def test_packed_documents(spark):
    docs = cases.documents(spark, extra=True).filter("doc_id is null or doc_id not in (10, 990)")
    found = packing.pack_documents(docs, tokenizer_path("byte_bpe_50k.json")).collect()
    whole = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    ids = {r.doc_id: np.array(whole.encode(r.text or "", add_special_tokens=False).ids + [0], "<u4") for r in docs.collect()}
    check_packing([(r.doc_id, r.start, r.length, r.sequence_id, r.offset) for r in found], {k: len(v) for k, v in ids.items()}, packing.WINDOW)
    for r in found:
        assert r.doc_tokens == len(ids[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes())
    assert packing.pack_documents(cases.empty(spark), tokenizer_path("byte_bpe_50k.json")).count() == 0
    assert packing.pack_documents(cases.documents(spark), tokenizer_path("byte_bpe_50k.json")).select("doc_id").distinct().count() == len(ids) + 2
