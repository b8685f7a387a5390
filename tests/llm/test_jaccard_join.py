import random
import re
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

from stratamart.llm import common
from stratamart.llm import components as components_module
from stratamart.llm import jaccard_join as J
from stratamart.llm.components import components

SCHEMA = "doc_id long, text string, mark string"


def brute(rows, words, percent):
    """{row number: (n, component)} straight from the definition."""
    sets = []
    for doc_id, text in rows:
        w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().translate(bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))))
        sets.append({tuple(w)} if 0 < len(w) < words else {tuple(w[i:i + words]) for i in range(len(w) - words + 1)} if w else set())
    up = list(range(len(rows)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        x, y = sets[i], sets[j]
        if x and y and rows[i][0] is not None and rows[j][0] is not None and 100 * len(x & y) >= percent * len(x | y):
            up[top(i)] = top(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[top(i)] = min(least.get(top(i), doc_id), doc_id)
    return sorted(((d, len(s), least.get(top(i)) if d is not None else None) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=repr)


def corpus(seed):
    dice = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)] + ["É", "ß", "Wort", "WORT"]
    text = lambda n: [dice.choice(vocabulary) for _ in range(n)]
    rows, passage = [], text(60)
    for _ in range(25):
        base = text(dice.choice([1, 2, 3, 4, 6, 20, 60, 150]))
        for _ in range(dice.choice([1, 2, 5])):
            copy = list(base)
            for _ in range(dice.choice([0, 0, 1, 1, 2])):
                copy[dice.randrange(len(copy))] = dice.choice(vocabulary)
            rows.append(" ".join(copy))
    rows += [" ".join(passage + text(dice.choice([0, 2, 5, 40]))) for _ in range(20)]
    hub = text(200)
    for i in range(40):  # near copies of one text, many of them linked only through others
        copy = list(hub)
        for _ in range(dice.randint(0, 5)):
            copy[dice.randrange(200)] = dice.choice(vocabulary)
        rows.append("\n".join(copy))
    rows += ["", " \t\n", None, None, "one two three", "One  Two THREE", "x" * 30000, " ".join(text(3000))]
    rows = [(i * 3 + 1, t) for i, t in enumerate(rows)]
    rows += [rows[3], rows[3], (None, rows[3][1]), (None, None)]  # repeated rows and null keys
    dice.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed, words, percent, chunk", [(1, 4, 85, 4096), (2, 5, 80, 7), (3, 4, 85, 3)])
def test_equals_brute_force(spark, monkeypatch, seed, words, percent, chunk):
    monkeypatch.setattr(J, "CHUNK_DOCS", chunk)
    rows = corpus(seed)
    docs = spark.createDataFrame([(d, t, "x") for d, t in rows], SCHEMA).repartition(4)
    out = J.similarity_components(docs, words=words, percent=percent)
    assert out.columns == ["doc_id", "n_shingles", "component_id"]
    assert sorted((tuple(r) for r in out.collect()), key=repr) == brute(rows, words, percent)


def test_empty_table(spark):
    out = J.similarity_components(spark.createDataFrame([], SCHEMA))
    assert out.count() == 0


def test_keep_one(spark):
    rows = corpus(4)
    docs = spark.createDataFrame([(t, d, "x") for d, t in rows], "text string, doc_id long, mark string")
    kept = J.keep_one(docs)
    assert kept.columns == docs.columns
    want = {c for d, _, c in brute(rows, 5, 80) if d is not None}
    got = [r.doc_id for r in kept.collect()]
    assert sorted(x for x in got if x is not None) == sorted(want)
    assert got.count(None) == 2


def test_keep_one_with_an_id_of_two_texts(spark):
    dice = random.Random(9)
    one, two, three = (" ".join(f"{c}{dice.randrange(10**6)}" for _ in range(40)) for c in "abc")
    rows = [(5, one), (5, two), (5, two), (1, one + " more"), (7, two + " more"), (9, three), (9, three.upper()), (9, three + " x"),
            (11, ""), (11, None), (11, three + " y"), (3, None), (2, "alone"), (2, "another")]
    docs = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, mark string").repartition(3)
    kept = J.keep_one(docs)
    assert kept.columns == docs.columns
    # ``one`` links to id 1, ``two`` to no smaller id than its own; of 9 the smallest text stays.
    assert sorted((r.doc_id, r.text or "") for r in kept.collect()) == sorted(
        [(1, one + " more"), (5, two), (9, three.upper()), (11, ""), (3, ""), (2, "alone"), (2, "another")])


def test_packed_numbers():
    values = np.unique(np.random.default_rng(3).integers(0, 2**63, 1000, np.uint64))
    assert (J.unpack_sorted(J.pack_sorted(values)) == values).all()
    assert len(J.unpack_sorted(J.pack_sorted(values[:0]))) == 0


def test_words_do_not_cross_texts():
    sets = J.shingle_sets(pa.array(["a b c", "d e f", None, "a b c d"]), 4)
    assert [len(s) for s in sets] == [1, 1, 0, 1] and sets[0][0] != sets[3][0]


@pytest.mark.parametrize("texts", [["a b"], ["a"], [""], [None, None], ["a", "b"]])
def test_batches_with_fewer_words_than_a_shingle(texts):
    assert [len(x) for x in J.shingle_sets(pa.array(texts, pa.string()), 5)] == [int(bool(t)) for t in texts]


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, x) for x in range(101, 130)] + [(129, 200), (7, 7)]
    out = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert out == {**{i: 0 for i in range(41)}, **{i: 100 for i in [*range(100, 130), 200]}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_no_plan_holds_several_steps(spark, monkeypatch):
    """The driver plans a step again after each of its stages, so what a plan costs grows with the square of its joins."""
    joins, written = [], common.stored

    def stored(df, *more):
        joins.append(df._jdf.queryExecution().optimizedPlan().toString().count("Join "))
        return written(df, *more)

    for module in (common, J, components_module):
        monkeypatch.setattr(module, "stored", stored)
    rows = corpus(1)[:60]
    out = J.similarity_components(spark.createDataFrame([(d, t, "x") for d, t in rows], SCHEMA), words=4, percent=85)
    assert sorted((tuple(r) for r in out.collect()), key=repr) == brute(rows, 4, 85)
    assert max(joins) <= 6
