"""Document fingerprints by locally consistent parsing.

A text is a sequence of code points. Each level replaces runs of one symbol by a name for
(symbol, length), so that neighbours differ, then shrinks the symbols by deterministic coin
tossing (position of the lowest bit in which a symbol differs from its left neighbour, and
that bit) until few values are left, and begins a phrase at every local maximum. A
phrase's name is a hash of its symbols; the names are the next level's sequence. Where
phrases begin depends on a few neighbours only, so equal substrings get equal names inside
wherever they stand.

The fingerprint holds the ``KEPT`` smallest hashed names from level ``FIRST_LEVEL`` on
(phrases of some nine characters and longer), or of the last level of a text that does
not reach it, as hexadecimal text. The likeness of two fingerprints estimates the
share of common names (Jaccard) from the smallest ones of both; it is exact for texts
with at most ``KEPT`` names. Equal texts have equal fingerprints.

Null texts are empty; an empty text has an empty fingerprint, like another empty one and
unlike all others. The next document is the one with the next key (nulls first, ties by
text); after the last comes the first, and a single document follows itself. Rows of one key stay
in one range, whole texts included, however many they are. Very long texts are taken whole. An
empty table gives no rows. Other columns are not read (``with_fingerprint`` passes them through
and replaces its own).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratamart.llm.common import mix64, parts_for, table
from stratamart.llm.registry import query

KEPT = 96
FIRST_LEVEL = 2
#: Rows and bytes of text of a range partition, about.
PART_ROWS = 20_000
PART_BYTES = 1 << 25
_ODD = np.uint64(0x9E3779B97F4A7C15)
_PLACE = mix64(np.arange(1, 4097, dtype=np.uint64)) | np.uint64(1)
_RUN = np.uint64(0xD6E8FEB86659FD93)


def _lowest_bit(x: np.ndarray) -> np.ndarray:
    """Number of the lowest set bit (x > 0)."""
    low = x & (~x + np.uint64(1))
    # The exponent of a power of two is exact in a double.
    return ((low.astype(np.float64).view(np.uint64) >> np.uint64(52)) - np.uint64(1023)).astype(np.uint64)


def _collapse_runs(symbols: np.ndarray, heads: np.ndarray):
    """One symbol for each maximal run of one symbol inside a text; ``heads`` marks the first symbol of texts."""
    fresh = np.ones(len(symbols), bool)
    fresh[1:] = (symbols[1:] != symbols[:-1]) | heads[1:]
    at = np.flatnonzero(fresh)
    sizes = np.diff(np.append(at, len(symbols)))
    out = symbols[at]
    long = sizes > 1
    out[long] = mix64(out[long] ^ (sizes[long].astype(np.uint64) * _RUN))
    return out, heads[at]


def phrase_starts(symbols: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """Marks where phrases begin; neighbours inside a text differ."""
    label = symbols
    for _ in range(4):  # 64-bit symbols, then below 128, 14, 8 and 6 values
        left = np.empty_like(label)
        left[1:] = label[:-1]
        # A text's first symbol is compared with its own complement of the lowest bit.
        left[heads] = label[heads] ^ np.uint64(1)
        differ = label ^ left
        # Hash collisions could leave equal neighbours at the first round only.
        differ[differ == 0] = 1
        bit = _lowest_bit(differ)
        label = (bit << np.uint64(1)) | ((label >> bit) & np.uint64(1))
    before = np.zeros(len(label), label.dtype)
    before[1:] = label[:-1]
    behind = np.zeros(len(label), label.dtype)
    behind[:-1] = label[1:]
    last = np.zeros(len(label), bool)
    last[:-1] = heads[1:]
    last[-1:] = True
    # The first and the last symbol of a text never begin an inner phrase, so each has at least two symbols.
    second = np.zeros(len(label), bool)
    second[1:] = heads[:-1]
    peak = (label > before) & (label >= behind) & ~last & ~second
    return peak | heads


def names(symbols: np.ndarray, starts: np.ndarray) -> np.ndarray:
    at = np.flatnonzero(starts)
    sizes = np.diff(np.append(at, len(symbols)))
    place = np.arange(len(symbols)) - np.repeat(at, sizes)
    # A phrase is short: labels between two local maxima fall and rise among few values.
    mixed = mix64(symbols * _PLACE[place % len(_PLACE)] + (place // len(_PLACE)).astype(np.uint64))
    return mix64(np.add.reduceat(mixed, at) ^ (sizes.astype(np.uint64) * _ODD))


def sketches(texts: list[str]) -> list[np.ndarray]:
    """The smallest hashed names of each text, ascending, 32 bits each."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    owner = np.flatnonzero(sizes)
    if not len(owner):
        return [np.zeros(0, np.uint32)] * len(texts)
    joined = "".join(texts).encode("utf-32-le", "surrogatepass")
    symbols = mix64(np.frombuffer(joined, np.uint32).astype(np.uint64) + _ODD)
    heads = np.zeros(len(symbols), bool)
    ends = np.cumsum(sizes[owner])
    heads[np.append(0, ends[:-1])] = True
    found_names, found_owner = [], []
    level = 0
    while len(symbols):
        symbols, heads = _collapse_runs(symbols, heads)
        starts = phrase_starts(symbols, heads)
        at = np.flatnonzero(starts)
        symbols, heads = names(symbols, starts), heads[at]
        of = np.cumsum(heads) - 1
        level += 1
        salt = np.uint64(level * 0x9E3779B97F4A7C15 % 2**64)
        single = np.bincount(of) == 1  # a text that is one phrase ends here
        if level >= FIRST_LEVEL:
            found_names.append(symbols ^ salt)
            found_owner.append(owner[of])
        else:
            ended = single[of]
            found_names.append(symbols[ended] ^ salt)
            found_owner.append(owner[of[ended]])
        going = ~single[of]
        symbols, heads, owner = symbols[going], heads[going], owner[~single]
    hashed = (mix64(np.concatenate(found_names)) >> np.uint64(32)).astype(np.uint64)
    tagged = np.unique(np.concatenate(found_owner).astype(np.uint64) << np.uint64(32) | hashed)
    of = (tagged >> np.uint64(32)).astype(np.int64)
    begin = np.searchsorted(of, np.arange(len(texts)))
    end = np.append(begin[1:], len(tagged))
    values = (tagged & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    return [values[a:min(b, a + KEPT)] for a, b in zip(begin.tolist(), end.tolist())]


def as_text(sketch: np.ndarray) -> str:
    return sketch.astype(">u4").tobytes().hex()


def from_text(fingerprint: str | None) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(fingerprint or ""), ">u4").astype(np.uint32)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of common names among the smallest ones of both together."""
    if not len(a) or not len(b):
        return 1.0 if len(a) == len(b) else 0.0
    both = np.union1d(a, b)
    if max(len(a), len(b)) >= KEPT:
        both = both[:KEPT]
    return float(np.isin(both, a, assume_unique=True)[np.isin(both, b, assume_unique=True)].sum() / len(both))


def with_fingerprint(docs: DataFrame, text: str = "text", fingerprint: str = "fingerprint") -> DataFrame:
    """``docs`` with the fingerprint of the whole text."""
    keep = [c for c in docs.columns if c != fingerprint]
    at = keep.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 256):
                batch = whole.slice(start, 256)
                marks = [as_text(s) for s in sketches([t or "" for t in batch.column(at).to_pylist()])]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(marks, pa.string())], [*keep, fingerprint])

    kept = docs.select(*[F.col(f"`{c}`") for c in keep])
    return kept.mapInArrow(run, kept.withColumn(fingerprint, F.lit("")).schema)


def edited(text: str, following: str) -> str:
    """The last quarter of the code points replaced by the first ones of the following text."""
    n = len(text) // 4
    return text[:len(text) - n] + following[:n]


def compare_with_next(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: its fingerprint, that of its edited text, and the likeness to that and to the next document's.

    Documents are range-split by key once, whole texts included. The first document of each
    range is also sent, marked, to the end of the range before it (and the very first to
    the end of the last), so that every document finds its next one in its own task.
    """
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    spark, size = docs.sparkSession, rows.agg(F.count(F.lit(1)), F.sum(F.octet_length("text"))).first()
    parts = max(parts_for(size[0], PART_ROWS), parts_for(size[1] or 0, PART_BYTES))
    # Boundaries are keys; equal keys stay together. One number for each PART_ROWS documents.
    cuts = sorted(set(rows.approxQuantile("key", [i / parts for i in range(1, parts)], 0.1 / parts))) if parts > 1 else []
    cuts = [int(c) for c in cuts]
    kind = dict(rows.dtypes)["key"]
    bounds = np.array([int(c) for c in cuts], np.int64)

    @F.pandas_udf("int")
    def range_of(keys: pd.Series) -> pd.Series:
        some = keys.notna().to_numpy()
        out = np.zeros(len(keys), np.int32)
        out[some] = np.searchsorted(bounds, keys[some].to_numpy(np.int64), side="right")
        return pd.Series(out)

    rows = rows.withColumn("range", range_of("key"))
    # One row for each range: its smallest key (null first).
    firsts = rows.select("key", "range").groupBy("range").agg(F.min("key").alias("key"), F.max(F.col("key").isNull()).alias("none")).orderBy("range").collect()
    # A range's head closes the range before it, the first one's the last.
    moves = [(None if r["none"] else r["key"], firsts[i - 1]["range"]) for i, r in enumerate(firsts)]
    moves = spark.createDataFrame(moves, f"head {kind}, goes int")
    ghosts = (
        rows.join(F.broadcast(moves), F.col("key").eqNullSafe(F.col("head"))).groupBy("goes", "key").agg(F.min("text").alias("text"))
        .select("key", "text", F.col("goes").alias("range"), F.lit(1).alias("ghost"))
    )
    # One task for each range: its place among the ranges that hold documents is the task's number.
    place = F.array_position(F.lit([r["range"] for r in firsts] or [0]), F.col("range")).cast("int") - 1
    dealt = rows.withColumn("ghost", F.lit(0)).unionByName(ghosts).withColumn("place", place).repartitionById(max(1, len(firsts)), "place").drop("place").sortWithinPartitions(
        "range", "ghost", F.col("key").asc_nulls_first(), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting = None  # (key, text, sketch, range)
        for whole in batches:
            for start in range(0, whole.num_rows, 128):
                batch = whole.slice(start, 128)
                keys, texts, ranges, ghost = (c.to_pylist() for c in batch.columns)
                own = sketches(texts)
                chain = list(zip(keys, texts, own, ranges, ghost))
                pairs = []
                for row in chain:
                    if waiting is not None and waiting[3] == row[3]:
                        pairs.append((waiting, row))
                    waiting = None if row[4] else row
                changed = [edited(a[1], b[1]) for a, b in pairs]
                after = sketches(changed)
                yield pa.RecordBatch.from_pydict({
                    "key": pa.array([a[0] for a, _ in pairs], batch.schema.field(0).type),
                    "n_chars": pa.array([len(a[1]) for a, _ in pairs], pa.int64()),
                    "edited_sha256": pa.array([hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in changed], pa.string()),
                    "fingerprint": pa.array([as_text(a[2]) for a, _ in pairs], pa.string()),
                    "edited_fingerprint": pa.array(list(map(as_text, after)), pa.string()),
                    "near_edited": pa.array([likeness(a[2], s) for (a, _), s in zip(pairs, after)], pa.float64()),
                    "near_next": pa.array([likeness(a[2], b[2]) for a, b in pairs], pa.float64()),
                })

    schema = f"key {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return dealt.mapInArrow(run, schema).withColumnRenamed("key", key)


@query()
def op7_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with its fingerprint, its edited text's, and its likeness to both that and the next document."""
    return compare_with_next(table(spark, folder, "documents"))
