"""SentencePiece: best segmentation by brute force, exact round trips, byte fallback, markers."""

import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from skylens.llm.sentencepiece import Pieces, decode_documents, double_array, encode_documents, load

ODD = ["", "a", " ", "  a  b ", "▁x", "日本語 テスト 😀", "x" * 300 + " y\x00\n\t", "é" * 80, "a b", "ab abc abcd " * 5]


@pytest.fixture(scope="module")
def pieces():
    return load(public_tokenizers.path("piece_bpe_32k.model"))


def small():
    words = ["▁", "a", "b", "c", "é", "ab", "bc", "▁a", "▁ab", "abc", "▁▁", "ca", "éa", "▁abcab"]
    byte_ids = {b: 100 + b for b in range(256)}
    return Pieces.of({i + 1: (w, -1.0 - 0.37 * ((i * 7) % 11)) for i, w in enumerate(words)}, byte_ids, 400), {w: -1.0 - 0.37 * ((i * 7) % 11) for i, w in enumerate(words)}


def best_score(text, scores, unk):
    """All segmentations by recursion over characters."""
    text = "▁" + text.replace("▁", "\0").replace(" ", "▁") if text else ""
    memo = {len(text): 0.0}
    for i in reversed(range(len(text))):
        options = [scores[text[i:j]] + memo[j] for j in range(i + 1, len(text) + 1) if text[i:j] in scores]
        if text[i] not in scores:
            options.append(unk + memo[i + 1])
        memo[i] = max(options)
    return memo[0]


def test_viterbi_finds_the_best_segmentation():
    own, scores = small()
    rng = random.Random(2)
    texts = ["".join(rng.choices(["a", "b", "c", "é", " ", "x", "▁", "日"], k=rng.randint(0, 90))) for _ in range(300)] + ["abc" * 40]
    ids, got = own.encode([t.encode() for t in texts])
    for t, i, s in zip(texts, ids, got):
        assert own.decode(i) == t.encode()
        assert s == pytest.approx(best_score(t, scores, own.unk), abs=1e-9)


def test_double_array_finds_exactly_its_keys():
    rng = random.Random(4)
    keys = sorted({bytes(rng.choices(range(256), k=rng.randint(1, 5))) for _ in range(3000)})
    base, check, value = double_array(keys)

    def find(key):
        state = 0
        for c in key:
            to = base[state] + c
            if check[to] != state:
                return -1
            state = to
        return value[state]

    assert [find(k) for k in keys] == list(range(len(keys)))
    assert all(find(k + b"\x01") == (keys.index(k + b"\x01") if k + b"\x01" in keys else -1) for k in keys[:200])


def test_documents_come_back(spark, pieces):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(None, None), (1, "a"), (1, "a")]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, ids string")
    got = decode_documents(encode_documents(df, pieces), pieces).orderBy("_row")
    want = df.select(F.coalesce("text", F.lit("")).alias("text")).collect()
    result = got.collect()
    assert [r.decoded for r in result] == [r.text for r in want] and all(r.restored for r in result)
    assert all((r.n_tokens == 0) == (t == "") for r, (_, t) in zip(result, [(i, t or "") for i, t in rows]))
    assert result[4].n_bytes == 3  # the marker character itself is spelt in bytes
    assert encode_documents(df.limit(0), pieces).count() == 0


def test_long_units_take_the_same_path(pieces):
    word = b"abcdefgh" * 7
    one = pieces.encode([word])
    two = pieces._long(np.frombuffer(b"\xff" + word, np.uint8))
    assert one[0][0].tolist() == two[0].tolist() and one[1][0] == pytest.approx(two[2][0])


def test_markers_inside_pieces_are_refused():
    with pytest.raises(ValueError):
        Pieces.of({1: ("a▁b", -1.0)}, {b: 2 + b for b in range(256)}, 300)
