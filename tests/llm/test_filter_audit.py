"""The audit against applying every order filter by filter to the documents themselves."""

import random
import re
from collections import Counter
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from stratamart.llm import filter_audit as A

DOCS = "doc_id long, text string, lang string, k int, part string, mask string"
LABELS = "doc_id long, quality int, toxic int, digest string"


def documents():
    dice = random.Random(2)
    words = ["alpha", "Beta", "γάμμα", "DELTA", "#", "é|", "x", " y", "🙂"]
    out = [(i, None if i == 3 else " ".join(dice.choice(words) + (str(dice.randint(0, 400)) if i % 2 else "") for _ in range(dice.choice([0, 3, 99, 100, 130]))),
            dice.choice(["de", "en", None, ""]), 7, "p", "m") for i in range(150)]
    out += [(200 + i, out[i][1], dice.choice(["de", "en"]), 7, "p", "m") for i in range(40)]
    out += [out[5], out[5], (out[5][0], "other text", "de", 7, "p", "m"), (None, out[5][1], "de", 7, "p", "m"), (None, "lone", "en", 7, "p", "m")]
    out += [(900, "long" + " word" * 60_000, "xx", 7, "p", "m"), (901, "B" * 100_000, "xx", 7, "p", "m")]
    return out


def labels():
    dice = random.Random(4)
    return [(i, dice.choice([0, 1, None]), dice.choice([0, 1]), "d") for i in range(0, 240, 2)] + [(4, 1, 0, "d"), (4, 0, 1, "d"), (None, 1, 1, "d"), (777, 1, 1, "d")]


def plain(docs, labels):
    good, toxic = ({k for k, *row in labels if k is not None and row[i] == 1} for i in (0, 1))
    first = {}
    for k, text, *_ in docs:
        if k is not None:
            first[text or ""] = min(first.get(text or "", k), k)
    rows = []
    for k, text, lang, *_ in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = "".join(c for c, failed in zip("ABCDE", (
            len(words) < 100, 100 * len(set(words)) < 80 * len(words), 100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
            re.search("[#$%&*|]", text), k is not None and k > first[text])) if failed)
        rows.append((lang or "", fails, k in good, k in toxic))
    out, shapley = {}, Counter()
    for part in {r[0] for r in rows}:
        for order in map("".join, permutations("ABCDE")):
            left = [r for r in rows if r[0] == part]
            for step, letter in enumerate(order, 1):
                gone = [r for r in left if letter in r[1]]
                left = [r for r in left if letter not in r[1]]
                failing = [r for r in rows if r[0] == part and letter in r[1]]
                out[part, order, step] = [len(left), len(gone), len(failing) - len(gone), sum(r[1] == letter for r in failing),
                                          sum(r[2] for r in gone), sum(r[3] for r in gone)]
                shapley[part, letter] += len(gone)
    return {(*k, *v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def test_equals_applying_every_order(spark):
    docs, marks = documents(), labels()
    got = A.audit_documents(spark.createDataFrame(docs, DOCS).repartition(5), spark.createDataFrame(marks, LABELS)).collect()
    want = plain(docs, marks)
    assert len(got) == len(want) == 600 * 4
    assert {(r.part, r.filter_order, r.step, r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in got} == want


def test_ranks_follow_lexicographic_order():
    orders = list(permutations(range(5)))
    assert [A.lehmer_rank(p, 5) for p in orders] == list(range(120))
    for size in (1, 2, 3):
        for p in permutations(range(5), size):
            assert A.lehmer_rank(p, 5) == min(i for i, o in enumerate(orders) if o[:size] == p)


def test_intervals_of_removal_cover_every_order_once():
    for mask in range(1, 32):
        covered = Counter(r for m, measure, _, start, end in A.intervals(5) if (m, measure) == (mask, 0) for r in range(start, end))
        assert covered == {r: 1 for r in range(120)}


def test_empty_tables(spark):
    assert A.audit_documents(spark.createDataFrame([], DOCS), spark.createDataFrame([], LABELS)).count() == 0
    got = A.audit_documents(spark.createDataFrame(documents()[:9], DOCS), spark.createDataFrame([], LABELS))
    assert got.agg(F.sum(F.col("good_lost") + F.col("toxic_lost"))).first()[0] == 0


@pytest.mark.parametrize("text, want", [("", 1), ("w" * 9, 1), (" ".join(map(str, range(100))), 0), ("A" * 11 + "b" * 89, 5), ("A" * 10 + "b" * 90, 1), ("a|b", 9)])
def test_mask_bounds(text, want):
    assert A.text_mask(text.encode(), len(text)) == want
