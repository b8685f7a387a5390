"""Alignment against a plain version: whole-text tokenization by both libraries and dictionaries of pairs."""

import hashlib
import random
from collections import Counter
from functools import reduce

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from stratamart.llm import token_alignment as T

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = [None, "", " ", "  ", "a", "a ", " a  b ", "x\n y\n  z\t\n", "▁", "a▁b c", "<|endoftext|> <s> <0x0A> </s>", "ﬁ①é", "日本語のテキスト", "🙂🙂 🙂",
       "    　x", "\u0000\u0001 \u001c y", "A" * 3000, "ab " * 2000, "é" * 500 + " " + "ñ" * 500, "0123456789" * 300, "\r\n \r\n", "don't I'll  we've"]


def plain_tokens(text):
    """Token ids and byte strings of both libraries on the whole text; None where a join differs."""
    a, b = plain_tokens.a, plain_tokens.b
    if not text:
        return None
    byte = {v: k for k, v in T.byte_characters().items()}
    back = {k: v for v, k in byte.items()}
    whole = (" " + text).encode()
    e = a.encode(" " + text, add_special_tokens=False)
    left = [(i, bytes(back[c] for c in a.id_to_token(i))) for i in e.ids]
    right = []
    for i in b.encode(text):
        piece = b.id_to_piece(i)
        right.append((i, bytes([int(piece[3:-1], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()))
    return (left, right) if b"".join(x for _, x in left) == whole == b"".join(x for _, x in right) else None


plain_tokens.a = Tokenizer.from_file(A)
plain_tokens.a.encode_special_tokens = True
plain_tokens.b = sentencepiece.SentencePieceProcessor(model_file=B)


def plain_groups(text):
    tokens = plain_tokens(text)
    if tokens is None:
        return []
    ends = []
    for side in tokens:
        at, out = 0, []
        for i, raw in side:
            at += len(raw)
            out.append((at, i))
        ends.append(out)
    cuts = sorted({e for e, _ in ends[0]} & {e for e, _ in ends[1]})
    groups, low = [], 0
    for cut in cuts:
        groups.append(tuple([i for e, i in side if low < e <= cut] for side in ends))
        low = cut
    return groups


def plain(texts):
    found = [plain_groups(t) for t in texts]
    links = [Counter((a, b) for x, y in groups for a in x for b in y) for groups in found]
    count = Counter(pair for one in links for pair in one)
    top = {}
    for (a, _), n in count.items():
        top[a] = max(top.get(a, 0), n)
    out = []
    for groups, one in zip(found, links):
        text = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
        out.append((
            sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), sum(one.values()),
            sum(n for p, n in one.items() if count[p] == top[p[0]]), sum(n * count[p] for p, n in one.items()),
            hashlib.sha256(text.encode()).hexdigest() if text else ""))
    return out


def texts():
    dice = random.Random(3)
    parts = ["the", "ing", "é", "ß", "aa", " ", "  ", "\n", "1", "!!", "日本", "🙂", "'s", "xy", "Ab", "▁", "\t", "--", "http://x.y/z?q=1"]
    made = ["".join(dice.choice(parts[:-4] if i % 9 else parts) for _ in range(dice.randint(1, 120))) for i in range(120)]
    return ODD + made + made[:20]


def run(spark, rows, size):
    docs = spark.createDataFrame([(i, t, "c", 1, 2) for i, t in enumerate(rows)], "doc_id long, text string, codes string, k int, row int").repartition(3)
    got = T.counted_alignment(docs, A, B, digest=True, size=size).orderBy("k").collect()
    return [(r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups) for r in got]


@pytest.mark.parametrize("size", [T.RANGE, 40])
def test_equals_the_plain_version(spark, size):
    """With ranges of 40 bytes most texts are cut inside pieces and characters and composed by a tree."""
    rows = texts()
    assert run(spark, rows, size) == plain(rows)


def test_composition_is_associative():
    dice, aligner = random.Random(1), T.Aligner(*T._models(A, B))
    for text in [t for t in texts() if t and "▁" not in t][:60]:
        tokens, ok = aligner.tokens(" " + text)
        size = len((" " + text).encode())
        cuts = sorted({0, size, *(dice.randint(0, size) for _ in range(6))})
        parts = [T.fragment(tokens.between(i, j)) for i, j in zip(cuts, cuts[1:])]
        left = reduce(T.compose, parts)
        right = reduce(lambda x, y: T.compose(y, x), reversed(parts))
        for x in (left, right):
            whole = T.compose(T.compose(T.START, x), T.START)
            assert ok and ";".join(whole.texts) == ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in plain_groups(text))
        assert (left.prefix[0].tolist(), left.suffix[1].tolist(), left.codes.tolist()) == (right.prefix[0].tolist(), right.suffix[1].tolist(), right.codes.tolist())


def test_ranges_cover_each_text_once():
    for text in [t for t in texts() if t]:
        aligner_ends = 0
        for pieces, low, high in T.byte_ranges(text, 16):
            assert 0 <= low < high <= len(pieces.encode())
            aligner_ends += high - low
        assert aligner_ends == len((" " + text).encode())


def test_packing():
    for x in (np.zeros(0, np.int64), np.array([0, 1, 255, 256, 2**31 - 1, 2**32 - 1])):
        assert T.unpack(T.pack(x)).tolist() == x.tolist()


def test_blocks_do_not_change_the_counts(spark, monkeypatch):
    rows = texts()
    monkeypatch.setattr(T, "BLOCK_PAIRS", 50)
    assert run(spark, rows, T.RANGE) == plain(rows)


def test_empty_table_and_groups_text(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert T.with_pair_counts(T.align(docs, A, B)).count() == 0 and T.counted_alignment(docs, A, B).count() == 0
    docs = spark.createDataFrame([(None, "ab cd"), (1, "ab cd"), (1, None)], "doc_id long, text string")
    sums = T.with_pair_counts(T.align(docs, A, B)).groupBy("n_links", "n_best", "count_sum").count().collect()
    assert sorted(map(tuple, sums)) == [(0, 0, 0, 1), (2, 2, 4, 2)]
    got = T.align(docs, A, B).select("k", "groups", F.length("codes")).collect()
    text = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in plain_groups("ab cd"))
    assert sorted((str(r[0]), r[1]) for r in got) == [("1", ""), ("1", text), ("None", text)]


def test_a_task_holds_one_python_worker_for_blocks(spark, monkeypatch):
    """The tree of long texts is written before the blocks are made, whose task has one Python function only."""
    plans, written = {}, T.stored

    def stored(df, label, *more):
        plans[label] = df._jdf.queryExecution().optimizedPlan().toString()
        return written(df, label, *more)

    monkeypatch.setattr(T, "stored", stored)
    rows = texts()[15:30]
    assert run(spark, rows, 40) == plain(rows)
    assert plans["align-blocks"].count("InArrow") == 2  # one of short texts, one of long ones
