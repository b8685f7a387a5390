import hashlib
import random

import numpy as np
import pytest

from stratamart.llm import fingerprints as P


def prose(dice, n):
    return "".join(dice.choice(["the ", "of ", "ab", "cd", "é", "ß", "\n", "日", "🙂", "xy ", "q", "ing "]) for _ in range(n))


def test_independent_of_the_batch():
    dice = random.Random(1)
    texts = ["", "a", "aa", "ab", "aaaaaaaaaaaaaaaa", "abababab" * 50, *[prose(dice, dice.randint(1, 400)) for _ in range(40)]]
    together = P.sketches(texts)
    for text, sketch in zip(texts, together):
        assert (P.sketches([text])[0] == sketch).all()
    assert [len(s) > 0 for s in together] == [bool(t) for t in texts]


def test_shared_substring_shares_names_at_any_offset():
    dice = random.Random(2)
    shared = prose(dice, 400)
    for shift in range(12):
        a, b = P.sketches([shared + "-end", "z" * shift + prose(dice, shift) + shared])
        assert P.likeness(a, b) > 0.8


def test_likeness():
    a, b = np.array([1, 2, 3], np.uint32), np.array([2, 3, 4], np.uint32)
    none = a[:0]
    assert P.likeness(a, b) == 0.5 and P.likeness(a, a) == 1.0 and P.likeness(none, none) == 1.0 and P.likeness(a, none) == 0.0
    assert (P.from_text(P.as_text(a)) == a).all()


def test_phrases_are_short():
    dice = np.random.default_rng(5)
    symbols = P.mix64(dice.integers(0, 50, 5000).astype(np.uint64))
    symbols, heads = P._collapse_runs(symbols, np.arange(5000) == 0)
    gaps = np.diff(np.append(np.flatnonzero(P.phrase_starts(symbols, heads)), len(symbols)))
    assert gaps.min() >= 2 and gaps.max() <= 16


MASK = 2**64 - 1


def mix(x):
    x &= MASK
    x ^= x >> 30
    x = x * 0xBF58476D1CE4E5B9 & MASK
    x ^= x >> 27
    x = x * 0x94D049BB133111EB & MASK
    return x ^ x >> 31


def plain_sketch(text):
    """The fingerprint by its definition, one text and one symbol at a time, in Python integers."""
    odd, kept = 0x9E3779B97F4A7C15, set()
    symbols, level = [mix(ord(c) + odd) for c in text], 0
    while symbols:
        runs = []
        for x in symbols:
            if runs and runs[-1][0] == x:
                runs[-1][1] += 1
            else:
                runs.append([x, 1])
        symbols = [x if n == 1 else mix(x ^ n * 0xD6E8FEB86659FD93 & MASK) for x, n in runs]
        labels = symbols
        for _ in range(4):  # coin tossing: the lowest bit that differs from the left neighbour, and that bit
            tossed = []
            for i, x in enumerate(labels):
                left = labels[i - 1] if i else x ^ 1
                bit = ((x ^ left or 1) & -(x ^ left or 1)).bit_length() - 1
                tossed.append(bit << 1 | x >> bit & 1)
            labels = tossed
        n = len(labels)
        begins = [i for i in range(n) if i == 0 or 1 < i < n - 1 and labels[i - 1] < labels[i] >= labels[i + 1]]
        phrases = [symbols[a:b] for a, b in zip(begins, begins[1:] + [n])]
        place = lambda j: mix(j % 4096 + 1) | 1
        symbols = [mix(sum(mix((x * place(j) & MASK) + j // 4096) for j, x in enumerate(p)) & MASK ^ len(p) * odd & MASK) for p in phrases]
        level += 1
        if level >= P.FIRST_LEVEL or len(symbols) == 1:
            kept |= {mix(x ^ level * odd & MASK) >> 32 for x in symbols}
        if len(symbols) == 1:
            break
    return sorted(kept)[:P.KEPT]


def plain_likeness(a, b):
    if not a or not b:
        return float(not a and not b)
    both = sorted({*a, *b})
    if max(len(a), len(b)) >= P.KEPT:
        both = both[:P.KEPT]
    return sum(x in a and x in b for x in both) / len(both)


def hexadecimal(sketch):
    return "".join(f"{x:08x}" for x in sketch)


def test_sketches_equal_the_definition():
    dice = random.Random(9)
    texts = ["", "a", "ab", "aa", "aaa" * 300, "abab" * 90, "é🙂" * 30, "x" * 9000 + "y" * 5000, *[prose(dice, dice.randint(1, 900)) for _ in range(60)]]
    texts += ["".join(chr(dice.randint(32, 0x2FFF)) for _ in range(dice.randint(1, 500))) for _ in range(20)]
    for text, got in zip(texts, P.sketches(texts)):
        assert got.tolist() == plain_sketch(text)


@pytest.mark.parametrize("part_rows", [4, 1000])
def test_next_document(spark, monkeypatch, part_rows):
    monkeypatch.setattr(P, "PART_ROWS", part_rows)
    dice = random.Random(3)
    rows = [(i * 7 % 101, prose(dice, dice.choice([0, 1, 3, 50, 300]))) for i in range(60)]
    rows += [(700, "long " * 40_000), (500, None), (501, ""), (502, "🙂" * 9), (600, "same"), (600, "same"), (600, "other"), (None, "null key")]
    docs = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, range string").repartition(3)
    got = P.compare_with_next(docs).collect()
    order = sorted(((d, t or "") for d, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode()))
    want = []
    for (d, t), (_, after) in zip(order, order[1:] + order[:1]):
        e = P.edited(t, after)
        assert e == t[:len(t) - len(t) // 4] + after[:len(t) // 4]
        a, b, c = map(plain_sketch, (t, e, after))
        want.append((d, len(t), hashlib.sha256(e.encode()).hexdigest(), hexadecimal(a), hexadecimal(b), plain_likeness(a, b), plain_likeness(a, c)))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_single_and_empty(spark):
    schema = "doc_id long, text string"
    one = P.compare_with_next(spark.createDataFrame([(1, "abcdefgh")], schema)).collect()
    assert len(one) == 1 and one[0].edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest() and one[0].near_next == 1.0
    assert P.compare_with_next(spark.createDataFrame([], schema)).count() == 0


def test_with_fingerprint_keeps_columns(spark):
    docs = spark.createDataFrame([("a b c", 1, "old"), (None, 2, "old")], "text string, id int, fingerprint string")
    out = P.with_fingerprint(docs)
    assert out.columns == ["text", "id", "fingerprint"]
    got = {r.id: r.fingerprint for r in out.collect()}
    assert got == {1: P.as_text(P.sketches(["a b c"])[0]), 2: ""}
