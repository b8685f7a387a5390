import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from stratamart.llm import byte_bpe as B

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def ranks():
    return B.read_ranks(PATH)


@pytest.fixture(scope="module")
def known(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts():
    dice = random.Random(5)
    syllables = ["the", "ing", "é", "ß", "ñ", "aa", "a", " ", "  ", "\n", "1", "!!", "ou", "日本", "🙂", "\u0000", "'s", "xy"]
    out = ["", None, " ", "a" * 5000, "ab" * 3000, "aab" * 2000, "🙂" * 700, "\r\n\t" * 50, "é" * 999, "0123456789" * 400]
    out += ["".join(dice.choice(syllables) for _ in range(dice.randint(1, 300))) for _ in range(400)]
    out += ["".join(dice.choice("abc") for _ in range(dice.randint(1, 4000))) for _ in range(30)]
    return out


def test_ids_equal_the_library(ranks, known):
    encoder = B.Encoder(ranks, B.MergeTable(ranks), public_tokenizers.PATTERN)
    for _ in range(2):  # the second time from memory
        for text, ids in zip(texts(), encoder.encode(texts())):
            assert ids.tolist() == known.encode_ordinary(text or "")


def test_lower_rank_made_by_a_merge_goes_first():
    """After X+Y (rank 260) the pair XY+X has rank 259: it must be merged before the second X+Y."""
    ranks = {bytes([b]): b for b in range(256)} | {b"xyx": 259, b"xy": 260, b"aa": 261, b"aaa": 262}
    merges = B.MergeTable(ranks)
    for piece in (b"xyxy", b"xyxyxyxy", b"zxyxyxz", b"aaaa", b"aaaaaaa", b"xyxyaaxy"):
        want = [piece[i:i + 1] for i in range(len(piece))]
        while True:
            found = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(want, want[1:])) if a + b in ranks]
            if not found:
                break
            i = min(found)[1]
            want[i:i + 2] = [want[i] + want[i + 1]]
        ids, counts = B.merge_pieces(merges, [b"q", piece, b"", b"xy"])
        assert ids[1:counts[1] + 1].tolist() == [ranks[x] for x in want] and counts.tolist() == [1, len(want), 0, 1]


def test_queue_pops_lowest_rank():
    queue = B.RankQueue(300_000)
    for rank in (299_999, 5, 70_000, 5, 64):
        queue.push(rank, np.array([rank]))
    got = []
    while (entry := queue.pop()) is not None:
        got.append((entry[0], len(entry[1])))
    assert got == [(5, 2), (64, 1), (70_000, 1), (299_999, 1)]


def test_frames(spark, known, monkeypatch):
    monkeypatch.setattr(B, "REMEMBERED", 10)
    rows = [(i, t, "x") for i, t in enumerate(texts())] + [(None, "a b", None)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string").drop("ids").repartition(3)
    encoded = B.encode_texts(docs, PATH, public_tokenizers.PATTERN)
    out = B.decode_ids(encoded, PATH).collect()
    assert len(out) == len(rows)
    text = {i: t or "" for i, t, _ in rows}
    for r in out:
        assert np.frombuffer(r.ids, "<u4").tolist() == known.encode_ordinary(text[r.doc_id])
        assert bytes(r.decoded) == text[r.doc_id].encode()
    empty = B.decode_ids(B.encode_texts(docs.limit(0), PATH, public_tokenizers.PATTERN), PATH)
    assert empty.columns == ["doc_id", "ids", "decoded"] and empty.count() == 0


def test_query(spark, known):
    folder = "/root/testdata/sf0.001"
    text = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    got = B.op9_byte_bpe(spark, folder).collect()
    assert len(got) == len(text)
    for r in got:
        ids = known.encode_ordinary(text[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text[r.doc_id].encode()).hexdigest()
