"""Packing: exact ids, every id in one piece, gapless offsets, no padding but at full length."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from skylens.llm.packing import assign, encode_batch, pack_documents

TEXTS = ["", "a", "a  b c", " x", "x \n", "é à", "à b ", "<|endoftext|> hi", "don't  we're\n\n ok ", "日本 語 テ", "a\tb\r\nc  d", "  x", "x  y", "Straße " * 50]


def exact():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_ids_are_the_tokenizers_own():
    rng = random.Random(5)
    texts = TEXTS + ["".join(rng.choices(["a", "b ", " ", "\n", "é", "à", "ß ", "1", "!", " don't", " ", "日", "\t"], k=60)) for _ in range(300)]
    want = [x.ids for x in exact().encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in encode_batch([t.encode() for t in texts])] == want
    assert [x.tolist() for x in encode_batch([t.encode() for t in texts])] == want  # from the cache


@pytest.mark.parametrize("seed", range(6))
def test_assign_fills_sequences(seed):
    rng = random.Random(seed)
    lengths = [rng.randint(1, 64) for _ in range(rng.choice([0, 1, 7, 200]))]
    got = assign(lengths, 64)
    covered = defaultdict(list)
    for sequence in got:
        for piece, a, b in sequence:
            assert a < b
            covered[piece].append((a, b))
    for piece, n in enumerate(lengths):
        parts = sorted(covered[piece])
        assert parts[0][0] == 0 and parts[-1][1] == n and all(x[1] == y[0] for x, y in zip(parts, parts[1:]))
    sizes = [sum(b - a for _, a, b in s) for s in got]
    assert all(n == 64 or n & (n - 1) == 0 for n in sizes) and sum(n < 64 for n in sizes) <= 6


def test_costs_are_balanced():
    rng = random.Random(1)
    got = assign([rng.randint(1, 512) for _ in range(2000)], 1024)
    cost = [sum((b - a) + (b - a) ** 2 / 2048 for _, a, b in s) for s in got if sum(b - a for _, a, b in s) == 1024]
    assert np.std(cost) / np.mean(cost) < 0.05


def test_pieces_cover_documents(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "no id"), (3, "again"), (3, "again"), (50, None), (51, "long words in a text " * 900)]
    df = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, length int, offset int")
    got = pack_documents(df.coalesce(1), group_tokens=1500).collect()
    tokenizer, want = exact(), []
    for i, t in rows:
        want.append((i, tokenizer.encode(t or "", add_special_tokens=False).ids + [0]))
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
        options = [ids for i, ids in want if i == r.doc_id and len(ids) == r.doc_tokens]
        assert any(zlib.crc32(np.array(ids[r.start:r.start + r.length], "<u4").tobytes()) == r.ids_crc32 for ids in options)
    assert sum(r.length for r in got) == sum(len(ids) for _, ids in want)
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024 and at & (at - 1) == 0
    assert pack_documents(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        pack_documents(df, capacity=1000)
