"""Filter interaction audit: what each filter removes in every order of application.

Every document fails a set of filters, its mask. For one mask, the orders in which it is
removed at step k share a prefix of k filters, and orders with a common prefix stand next to
each other in lexicographic order: their Lehmer ranks form one interval. Each mask's counts are
added at the start and taken off behind the end of its intervals, one difference array for each
step and measure, and a prefix sum over the ranks gives the totals of every order at once.

The texts are read once and leave the first pass as (id, part, digest, mask). Equal texts are
combined by (digest, part, labels) on the map side before they meet, so a text that a third of
all rows repeat reaches a task as one row from each other task. A part then holds at most 32
masks, whatever the size of the table.

Null texts count as empty, null parts as the empty part. A key with several labels counts as
good (toxic) if one of them says so; labels without a document count nowhere. A row with a null
key has no label and never counts as a later copy. Rows repeated with one key are no copies of
each other (no key is smaller) and each counts. Long texts are taken whole. An empty table gives
no rows. Other columns of the inputs, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratamart.llm.common import table
from stratamart.llm.registry import query

LETTERS = "ABCDE"
MIN_WORDS = 100
MIN_DISTINCT_PERCENT = 80
MAX_UPPER_PERCENT = 10
UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
MARKS = b"#$%&*|"
#: Bit of the filter that compares texts; the others look at one text.
COPY_BIT = 1 << LETTERS.index("E")
MEASURES = ("removed", "good_lost", "toxic_lost", "redundant", "unique_fails")


def text_mask(data: bytes, chars: int) -> int:
    """Filters A to D that a text fails, as bits. ``bytes.split`` cuts at exactly 0x20 and 0x09 to 0x0D."""
    words = data.split()
    fails = (
        len(words) < MIN_WORDS,
        100 * len(set(words)) < MIN_DISTINCT_PERCENT * len(words),
        100 * (len(data) - len(data.translate(None, UPPER))) > MAX_UPPER_PERCENT * chars,
        len(data) != len(data.translate(None, MARKS)),
    )
    return sum(1 << i for i, failed in enumerate(fails) if failed)


def text_masks(docs: DataFrame, key: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """(k, part, mask, digest) of every row; digest is the SHA-256 of the whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2)
            chars = pc.utf8_length(texts).to_pylist()
            raw = texts.cast(pa.large_binary())
            masks = np.empty(batch.num_rows, np.int32)
            digests = []
            for i in range(batch.num_rows):
                data = raw[i].as_py()
                masks[i] = text_mask(data, chars[i])
                digests.append(hashlib.sha256(data).digest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(masks), pa.array(digests, pa.binary())], ["k", "part", "mask", "digest"])

    rows = docs.select(
        F.col(f"`{key}`").alias("k"), F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("t"))
    schema = rows.select("k", "part", F.lit(0).alias("mask"), F.lit(b"").alias("digest")).schema
    return rows.mapInArrow(run, schema)


def with_labels(rows: DataFrame, labels: DataFrame, key: str, good: str, toxic: str) -> DataFrame:
    """``rows`` with the flags good and toxic of their key."""
    known = labels.where(F.col(f"`{key}`").isNotNull()).groupBy(F.col(f"`{key}`").alias("k")).agg(
        F.max(F.coalesce(F.col(f"`{good}`") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col(f"`{toxic}`") == 1, F.lit(False))).alias("toxic"))
    no = F.lit(False)
    return rows.join(known, "k", "left").withColumns({"good": F.coalesce("good", no), "toxic": F.coalesce("toxic", no)})


def mask_counts(rows: DataFrame) -> DataFrame:
    """(part, mask, n, n_good, n_toxic) from labelled (k, part, mask, digest, good, toxic) rows, filter E included."""
    same = ("digest", "part", "good", "toxic", "mask")
    # Rows of one key and text first: the number of rows at the smallest key of a text is then one row's count.
    by_key = rows.groupBy("k", *same).agg(F.count("*").alias("c"))
    has_key = F.col("k").isNotNull()
    by_text = by_key.groupBy(*same).agg(
        F.sum("c").alias("n"), F.sum(F.when(~has_key, F.col("c"))).alias("keyless"), F.min(F.when(has_key, F.struct("k", "c"))).alias("least"))
    first = F.min("least.k").over(Window.partitionBy("digest"))
    stays = F.coalesce("keyless", F.lit(0)) + F.when(F.col("least.k") == F.col("first"), F.col("least.c")).otherwise(0)
    split = by_text.withColumn("first", first).withColumn("stays", stays)
    each = split.select("part", "good", "toxic", F.explode(F.array(
        F.struct("mask", F.col("stays").alias("n")),
        F.struct(F.col("mask").bitwiseOR(F.lit(COPY_BIT)).alias("mask"), (F.col("n") - F.col("stays")).alias("n")),
    )).alias("x")).select("part", "good", "toxic", "x.*").where("n > 0")
    return each.groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("n_good"),
        F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("n_toxic"))


def lehmer_rank(prefix: tuple[int, ...], size: int) -> int:
    """Lexicographic rank of the first permutation of ``range(size)`` that begins with ``prefix``."""
    left, rank = list(range(size)), 0
    for item in prefix:
        at = left.index(item)
        rank += at * factorial(len(left) - 1)
        del left[at]
    return rank


def intervals(size: int) -> list[tuple[int, int, int, int, int]]:
    """(mask, measure, step, start, end) of all rank intervals of all masks.

    ``measure`` is the place in ``MEASURES``; good_lost and toxic_lost share the intervals of removed.
    """
    found = []
    for step in range(1, size + 1):
        for prefix in permutations(range(size), step):
            start = lehmer_rank(prefix, size)
            end, last = start + factorial(size - step), 1 << prefix[-1]
            earlier = sum(1 << i for i in prefix[:-1])
            for mask in range(1, 1 << size):
                if not mask & last:
                    continue
                if mask & earlier:
                    found.append((mask, 3, step - 1, start, end))
                else:
                    found += [(mask, measure, step - 1, start, end) for measure in (0, 1, 2)]
                if mask == last:
                    found.append((mask, 4, step - 1, start, end))
    return found


def audit(counts: DataFrame, letters: str = LETTERS) -> DataFrame:
    """One row for each part, order of ``letters`` and step, from (part, mask, n, n_good, n_toxic).

    The difference arrays of a part hold size! * size numbers for each measure and its group at most 2**size rows.
    """
    size = len(letters)
    mask, measure, step, start, end = np.array(intervals(size)).T
    orders = ["".join(letters[i] for i in p) for p in permutations(range(size))]
    letter = np.array([[letters.index(c) for c in order] for order in orders]).T

    def totals(group: pd.DataFrame) -> pd.DataFrame:
        weights = np.zeros((5, 1 << size), np.int64)
        for name, into in (("n", (0, 3, 4)), ("n_good", (1,)), ("n_toxic", (2,))):
            for i in into:
                np.add.at(weights[i], group["mask"].to_numpy(), group[name].to_numpy(np.int64))
        change = np.zeros((5, size, len(orders) + 1), np.int64)
        amount = weights[measure, mask]
        np.add.at(change, (measure, step, start), amount)
        np.add.at(change, (measure, step, end), -amount)
        sums = np.cumsum(change, axis=2)[:, :, :-1]
        removed = sums[0]
        shapley = np.zeros(size, np.int64)
        np.add.at(shapley, letter, removed)
        kept = int(group["n"].sum()) - np.cumsum(removed, axis=0)
        out = {"part": group["part"].iloc[0], "filter_order": np.tile(orders, size), "step": np.repeat(np.arange(1, size + 1, dtype=np.int32), len(orders)),
               "kept": kept.ravel(), "shapley": shapley[letter].ravel()}
        return pd.DataFrame(out | {name: sums[i].ravel() for i, name in enumerate(MEASURES)})

    schema = "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long"
    return counts.groupBy("part").applyInPandas(totals, schema)


def audit_documents(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "lang",
                    good: str = "quality", toxic: str = "toxic") -> DataFrame:
    """The audit of the five filters over whole texts."""
    return audit(mask_counts(with_labels(text_masks(docs, key, text, part), labels, key, good, toxic)))


SQL = r"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
firsts AS (SELECT t, min(doc_id) AS first_id FROM d GROUP BY t),
w AS (
  SELECT doc_id, part, t, first_id, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words
  FROM d JOIN firsts USING (t)
),
m AS (
  SELECT doc_id, part,
    (CASE WHEN len(words) < 100 THEN 1 ELSE 0 END)
    + (CASE WHEN 100 * len(list_distinct(words)) < 80 * len(words) THEN 2 ELSE 0 END)
    + (CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) THEN 4 ELSE 0 END)
    + (CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END)
    + (CASE WHEN doc_id > first_id THEN 16 ELSE 0 END) AS mask
  FROM w
),
l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
c AS (
  SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS n_good, count(*) FILTER (toxic) AS n_toxic
  FROM m LEFT JOIN l USING (doc_id) GROUP BY part, mask
),
f(letter, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
o AS (
  SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order
  FROM f a JOIN f b ON b.bit <> a.bit JOIN f c ON c.bit NOT IN (a.bit, b.bit)
  JOIN f d ON d.bit NOT IN (a.bit, b.bit, c.bit) JOIN f e ON a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND e.bit NOT IN (a.bit, b.bit, c.bit, d.bit)
),
s AS (
  SELECT filter_order, CAST(step AS INTEGER) AS step, letter, bit,
    (SELECT coalesce(sum(g.bit), 0) FROM f g WHERE strpos(filter_order, g.letter) < step) AS earlier
  FROM o, range(1, 6) r(step) JOIN f ON letter = substr(filter_order, step, 1)
),
x AS (
  SELECT part, filter_order, step, letter,
    sum(CASE WHEN mask & (earlier + bit)::BIGINT = 0 THEN n ELSE 0 END)::BIGINT AS kept,
    sum(CASE WHEN mask & bit > 0 AND mask & earlier::BIGINT = 0 THEN n ELSE 0 END)::BIGINT AS removed,
    sum(CASE WHEN mask & bit > 0 AND mask & earlier::BIGINT > 0 THEN n ELSE 0 END)::BIGINT AS redundant,
    sum(CASE WHEN mask = bit THEN n ELSE 0 END)::BIGINT AS unique_fails,
    sum(CASE WHEN mask & bit > 0 AND mask & earlier::BIGINT = 0 THEN n_good ELSE 0 END)::BIGINT AS good_lost,
    sum(CASE WHEN mask & bit > 0 AND mask & earlier::BIGINT = 0 THEN n_toxic ELSE 0 END)::BIGINT AS toxic_lost
  FROM c, s GROUP BY part, filter_order, step, letter
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
FROM x
"""


@query(SQL)
def op13_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    """Kept, removed and redundant counts of five filters in all 120 orders, for every language."""
    return audit_documents(table(spark, folder, "documents"), table(spark, folder, "labels"))
