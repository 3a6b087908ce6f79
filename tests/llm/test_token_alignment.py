import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tallyhouse.llm import token_alignment as ta
from tallyhouse.llm.tokens import byte_alphabet, tokenizer_path
from tests.llm import cases

A, B = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")


def plain_tokens(text):
    """(id, bytes) by either tokenizer, straight from the libraries."""
    if not text:
        return [], []
    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    letters = byte_alphabet()
    one = [(i, bytes(letters[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
    two = [(i, bytes([i - 3]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()) for i in b.encode(text)]
    same = b"".join(x for _, x in one) == b"".join(x for _, x in two) == (" " + text).encode()
    return (one, two) if same else ([], [])


def plain_alignment(rows):
    """Group by group, link by link."""
    per_doc, counts = [], Counter()
    for doc_id, text in rows:
        one, two = plain_tokens(text)
        groups, end_a, end_b, j = [], 0, 0, 0
        now = ([], [])
        for i, raw in one:
            now[0].append(i)
            end_a += len(raw)
            while j < len(two) and end_b < end_a:
                now[1].append(two[j][0])
                end_b += len(two[j][1])
                j += 1
            if end_a == end_b:
                groups.append(now)
                now = ([], [])
        links = [(x, y) for g in groups for x in g[0] for y in g[1]]
        counts.update(set(links))
        text = ";".join(",".join(map(str, g[0])) + "|" + ",".join(map(str, g[1])) for g in groups)
        per_doc.append((doc_id, len(one), len(two), len(groups), links, hashlib.sha256(text.encode()).hexdigest() if one else ""))
    best = {}
    for (x, _), n in counts.items():
        best[x] = max(best.get(x, 0), n)
    return sorted(
        ((d, a, b, g, len(k), sum(counts[p] == best[p[0]] for p in k), sum(counts[p] for p in k), h) for d, a, b, g, k, h in per_doc), key=repr
    )


def found(df):
    return sorted((tuple(r[c] for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")) for r in df.collect()), key=repr)


@pytest.mark.parametrize("piece", [1, 2, 3, 7, 1000])
def test_pieces_give_the_common_ends(piece):
    draw = np.random.default_rng(piece)
    for n, m in [(1, 1), (5, 1), (1, 9), (40, 60), (300, 200)]:
        a, b = (np.unique(np.append(draw.integers(1, 400, k), 400)) for k in (n, m))
        low, other = ta.diagonals(a, b, piece)
        merged = sorted([(x, 0) for x in a.tolist()] + [(x, 1) for x in b.tolist()])
        steps = [*range(0, len(merged), piece), len(merged)]
        assert low.tolist() == [sum(1 for _, k in merged[:s] if k == 0) for s in steps]
        assert (low + other).tolist() == steps
        cuts, begin = [], (0, 0)
        for edge_a, edge_b in ta.groups(a, b, piece):
            assert (edge_a[0], edge_b[0]) == begin
            cuts += zip(edge_a[1:].tolist(), edge_b[1:].tolist(), strict=True)
            begin = cuts[-1]
        want = [(int(np.flatnonzero(a == x)[0]) + 1, int(np.flatnonzero(b == x)[0]) + 1) for x in np.intersect1d(a, b)]
        assert cuts == want


TEXTS = [
    "▁ is not given back", "<s> </s> <unk> <0x41>", "  two  blanks ", "\n\nlines\n", "a" * 700, "é" * 50 + "ab" * 400, "東京都 に 住む 🙂🙂 नमस्ते", "１２３ 456789012345",
    "Don't <|endoftext|> stop", "x\x00y z",
]


@pytest.mark.parametrize("how", [{}, {"block_docs": 3, "piece": 5}, {"block_docs": 1, "piece": 64}])
def test_equals_plain(spark, how):
    draw = random.Random(2)
    rows = [(i, t) for i, t in enumerate([*TEXTS, *[t for t in cases.texts() if t is None or len(t) < 5000]])]
    rows += [(100 + i, " ".join("".join(draw.choice("aeinrst") for _ in range(draw.randrange(1, 12))) for _ in range(30))) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert found(ta.align(docs, A, B, **how)) == plain_alignment(rows)


def test_wide_groups_are_paired_by_distinct_ids(monkeypatch):
    pair = ta.pair_of(A, B)
    docs = [(i, *pair.tokens(t)) for i, t in enumerate([*TEXTS, "a" * 3000])]
    want = ta.block_of(docs, pair)
    monkeypatch.setattr(ta, "WIDE", 1)
    got = ta.block_of(docs, pair)
    assert all(np.array_equal(got[k], want[k]) for k in want)


def test_nulls_repeated_rows_long_texts_and_empty_tables(spark):
    docs = cases.documents(spark, extra=True)
    assert found(ta.align(docs, A, B)) == plain_alignment([(r.doc_id, r.text) for r in docs.collect()])
    assert ta.align(cases.empty(spark), A, B).count() == 0
