"""Shared helpers: table access, written intermediates, text batches and 64-bit hashing."""

from __future__ import annotations

import gc
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from stratamart.session import delete_scratch, scratch_path


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame, label: str, codec: str = "snappy") -> DataFrame:
    """Write once to the shared folder and read back: cuts the lineage, survives lost executors.

    The files stay until ``drop_stored`` or the session's ``release_pinned``.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", codec).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.scratch = path
    return out


def stored_with(df: DataFrame, label: str, **metrics: Column) -> tuple[DataFrame, dict]:
    """``stored``, and aggregates over its rows that are observed while it is written."""
    watch = Observation()
    out = stored(df.observe(watch, *[m.alias(name) for name, m in metrics.items()]), label)
    return out, watch.get


def drop_stored(df: DataFrame) -> None:
    """Delete the files of a ``stored`` frame that nothing reads any more."""
    release(df.sparkSession, [df.scratch])


def settle(spark: SparkSession) -> None:
    """Let go of the plans of finished jobs, and of the shuffles and broadcasts behind them.

    Spark's cleaner drops those once the driver's JVM has collected the plans that refer to them, which it
    does of itself only when its heap is full: a row of many small jobs would hold all of them.
    """
    gc.collect()
    spark._jvm.System.gc()


def release(spark: SparkSession, paths: list[str]) -> None:
    """Delete written intermediates that nothing reads any more, and ``settle``."""
    delete_scratch(spark, paths)
    settle(spark)


def own_names(df: DataFrame, *names: str) -> list[str]:
    """Column names that ``df`` does not have yet, made of the given ones."""
    mark, taken = "__", {c.lower() for c in df.columns}
    while any((mark + n).lower() in taken for n in names):
        mark += "_"
    return [mark + n for n in names]


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z; every other character stays."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def crc_mod(key: Column, divisor: int) -> Column:
    """crc32 of the key's text modulo ``divisor``; a null key counts as empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % divisor


def labelled_sample(labels: DataFrame, key: str, label: str, learn: Column | None, per_class: int) -> tuple[DataFrame, dict]:
    """At most ``per_class`` keys of each label 0 and 1, as (key, __y), and the number of all labelled keys by class.

    The keys with the smallest hashes are taken. Null keys and labels are left out; a key
    with several labels counts by the largest.
    """
    known = labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull())
    known = (known if learn is None else known.where(learn)).groupBy(key).agg(F.max(label).cast("int").alias("__y"))
    totals = {r["__y"]: r["count"] for r in known.groupBy("__y").count().collect()}
    picks = [known.where(F.col("__y") == y).orderBy(F.xxhash64(key), key).limit(per_class) for y in (0, 1)]
    return picks[0].unionByName(picks[1]), totals


# --- 64-bit hashing in numpy -------------------------------------------------

def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finalizer (splitmix64), elementwise."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def distinct(x: np.ndarray) -> np.ndarray:
    """Sorted distinct values; sorting is several times faster here than numpy's hashing."""
    x = np.sort(x)
    fresh = np.ones(len(x), bool)
    fresh[1:] = x[1:] != x[:-1]
    return x[fresh]


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and its n+1 offsets; nulls count as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column
    if column.null_count:
        column = column.fill_null(b"")
    n, at = len(column), column.offset
    offsets = np.frombuffer(column.buffers()[1], np.int64, n + 1, at * 8) if n else np.zeros(1, np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def word_spans(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray):
    """Starts, ends and document numbers of maximal runs of word bytes; a run never crosses documents.

    ``is_word`` is a table of 256 booleans.
    """
    inside = np.zeros(len(data) + 1, bool)
    inside[:-1] = is_word[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    ends = ~inside
    ends[1:] &= inside[:-1]
    ends[0] = False
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    cuts = cuts[inside[cuts] & inside[cuts - 1]]
    starts = np.flatnonzero(begins)
    stops = np.flatnonzero(ends)
    if len(cuts):
        cuts = distinct(cuts)  # empty documents repeat an offset
        starts, stops = np.sort(np.concatenate([starts, cuts])), np.sort(np.concatenate([stops, cuts]))
    return starts, stops, np.searchsorted(offsets, starts, side="right") - 1


def word_hashes(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span, from its 8-byte little-endian pieces and its length."""
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[:len(data)] = data
    lengths = stops - starts
    out = mix64(lengths.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    pieces = (lengths + 7) >> 3
    shift = np.arange(8, dtype=np.int64)
    todo, at = np.arange(len(starts)), 0
    while True:
        todo = todo[pieces[todo] > at]
        if not len(todo):
            return out
        piece = padded[(starts[todo] + 8 * at)[:, None] + shift].view(np.uint64)[:, 0]
        left = np.minimum(lengths[todo] - 8 * at, 8).astype(np.uint64)
        keep = np.where(left == 8, np.uint64(0xFFFFFFFFFFFFFFFF), (np.uint64(1) << (left * np.uint64(8))) - np.uint64(1))
        out[todo] = mix64((out[todo] ^ (piece & keep)) * np.uint64(0x9E3779B97F4A7C15))
        at += 1


def parts_for(rows: int, per_part: int) -> int:
    """Number of parts so that each holds about ``per_part`` rows."""
    return max(1, math.ceil(rows / per_part))
