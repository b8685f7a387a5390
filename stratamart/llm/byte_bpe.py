"""Byte-level BPE encoding and decoding with a rank queue.

Each batch of texts is cut into pre-tokens; those not seen before are laid end to end
as one linked list of byte positions, and the queue merges them together. The queue is
a hierarchical bitmap over merge ranks with one bucket of list positions per rank:
find-first-set walks down to the lowest rank that has entries, the whole bucket is
taken at once as arrays, entries whose pair has changed meanwhile are stale and are
skipped, and the pairs that a merge makes are filed under their own ranks. A pre-token
of any length costs one list node per byte, never a rescan.

Nulls and empty texts have no ids; extra columns pass through, a column ``ids`` (``decoded``) of the
input is replaced. Repeated rows are encoded each. Ties: of equal ranks the leftmost pair merges
first. An empty table gives no rows.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratamart.llm.common import table
from stratamart.llm.registry import query

#: A worker forgets its pre-tokens beyond so many (memory only; ids do not depend on it).
REMEMBERED = 400_000
NONE = np.int32(2**31 - 1)


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


class MergeTable:
    """Pairs of token ids to the rank of their concatenation, in an open-addressed table."""

    def __init__(self, ranks: dict[bytes, int]):
        self.size = max(ranks.values()) + 1
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        pairs = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = rank
        keys = np.fromiter(pairs.keys(), np.int64, len(pairs))
        values = np.fromiter(pairs.values(), np.int32, len(pairs))
        self.bits = max(4, int(len(keys) * 3).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.full(1 << self.bits, NONE, np.int32)
        slots = self._slot(keys)
        while len(keys):
            free = self.keys[slots] == -1
            _, first = np.unique(slots, return_index=True)
            take = first[free[first]]
            self.keys[slots[take]], self.values[slots[take]] = keys[take], values[take]
            rest = np.ones(len(keys), bool)
            rest[take] = False
            keys, values, slots = keys[rest], values[rest], (slots[rest] + 1) & (len(self.keys) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair's merge, NONE where there is none."""
        keys = left.astype(np.int64) << 32 | right
        slots = self._slot(keys)
        found = self.keys[slots]
        out = np.where(found == keys, self.values[slots], NONE)
        todo = np.flatnonzero((found != keys) & (found != -1))
        while len(todo):
            slots[todo] = (slots[todo] + 1) & (len(self.keys) - 1)
            found = self.keys[slots[todo]]
            hit = found == keys[todo]
            out[todo[hit]] = self.values[slots[todo[hit]]]
            todo = todo[~hit & (found != -1)]
        return out


class RankQueue:
    """Buckets of positions by rank under a bitmap of 64-bit words, itself under a bitmap, up to one word."""

    def __init__(self, ranks: int):
        self.buckets: dict[int, list[np.ndarray]] = {}
        self.levels = []
        while True:
            ranks = (ranks + 63) >> 6
            self.levels.append([0] * ranks)
            if ranks == 1:
                break

    def push(self, rank: int, positions: np.ndarray) -> None:
        bucket = self.buckets.get(rank)
        if bucket is not None:
            bucket.append(positions)
            return
        self.buckets[rank] = [positions]
        for words in self.levels:
            at, was = rank >> 6, words[rank >> 6]
            words[at] = was | 1 << (rank & 63)
            if was:
                return
            rank = at

    def push_all(self, ranks: np.ndarray, positions: np.ndarray) -> None:
        if not len(ranks):
            return
        order = np.argsort(ranks, kind="stable")
        ranks, positions = ranks[order], positions[order]
        cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
        begins = [0, *cuts.tolist()]
        for rank, begin, end in zip(ranks[begins].tolist(), begins, [*begins[1:], len(ranks)]):
            self.push(rank, positions[begin:end])

    def pop(self) -> tuple[int, np.ndarray] | None:
        """Lowest rank with entries, and all of them."""
        rank = 0
        for words in reversed(self.levels):
            word = words[rank]
            if not word:
                return None
            rank = rank << 6 | ((word & -word).bit_length() - 1)
        at = rank
        for words in self.levels:
            words[at >> 6] &= ~(1 << (at & 63))
            if words[at >> 6]:
                break
            at >>= 6
        entries = self.buckets.pop(rank)
        return rank, entries[0] if len(entries) == 1 else np.concatenate(entries)


def merge_pieces(merges: MergeTable, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of all pieces, end to end, and the number of ids of each.

    Always the lowest rank first and the leftmost of its places within a piece. Places of
    one rank are merged together unless a merge makes a pair of lower rank: what lies
    behind such a place in its piece waits for the next turn.
    """
    lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
    data = np.frombuffer(b"".join(pieces), np.uint8)
    n = len(data)
    if not n:
        return np.zeros(0, np.int32), lengths
    owner = np.repeat(np.arange(len(pieces)), lengths)
    ids = np.append(merges.single[data], np.int32(0))
    after, before = np.arange(1, n + 2), np.arange(-1, n)
    last = np.cumsum(lengths) - 1
    first = last - lengths + 1
    after[last[lengths > 0]], before[first[lengths > 0]] = -1, -1
    pair_rank = np.full(n, NONE, np.int32)
    starts = np.flatnonzero(after[:n] >= 0)
    pair_rank[starts] = merges.rank(ids[starts], ids[starts + 1])
    alive = np.ones(n, bool)
    queue = RankQueue(merges.size)
    starts = starts[pair_rank[starts] != NONE]
    queue.push_all(pair_rank[starts], starts)
    while (entry := queue.pop()) is not None:
        rank, at = entry
        at = np.unique(at[pair_rank[at] == rank])  # the others are stale
        if not len(at):
            continue
        if len(at) > 1:
            # Places that overlap (a run of one symbol): every second one, from the left.
            place = np.arange(len(at))
            chained = np.zeros(len(at), bool)
            chained[1:] = after[at[:-1]] == at[1:]
            if chained.any():
                run = np.maximum.accumulate(np.where(chained, 0, place))
                at = at[(place - run) % 2 == 0]
            at, waiting = _until_lower(merges, rank, at, owner, ids, after, before)
            if len(waiting):
                queue.push(rank, waiting)
        gone = after[at]
        beyond = after[gone]
        ids[at] = rank
        alive[gone] = False
        pair_rank[gone] = NONE
        after[at] = beyond
        inner = beyond >= 0
        before[beyond[inner]] = at[inner]
        left = before[at]
        touched = np.concatenate([at[inner], left[left >= 0]])
        pair_rank[at[~inner]] = NONE
        if len(touched):
            touched = np.unique(touched)
            ranks = merges.rank(ids[touched], ids[after[touched]])
            pair_rank[touched] = ranks
            some = ranks != NONE
            queue.push_all(ranks[some], touched[some])
    return ids[:n][alive], np.bincount(owner[alive], minlength=len(pieces))


def _until_lower(merges, rank, at, owner, ids, after, before):
    """Split places into those to merge now and those behind a merge that makes a lower rank."""
    of = owner[at]
    again = np.zeros(len(at), bool)
    again[1:] = of[1:] == of[:-1]
    if not again.any():
        return at, at[:0]
    joined = np.zeros(len(at), bool)
    joined[1:] = after[after[at[:-1]]] == at[1:]
    left, right = before[at], after[after[at]]
    own = np.full(len(at), rank, np.int32)
    lower = np.zeros(len(at), bool)
    has = left >= 0
    lower[has] = merges.rank(np.where(joined, rank, ids[left])[has], own[has]) < rank
    has = right >= 0
    lower[has] |= merges.rank(own[has], ids[right][has]) < rank
    if joined.any() and merges.rank(own[:1], own[:1])[0] < rank:
        lower[:-1] |= joined[1:]
    if not lower.any():
        return at, at[:0]
    seen = np.cumsum(lower) - lower
    begins = np.maximum.accumulate(np.where(again, 0, np.arange(len(at))))
    late = seen > seen[begins]
    return at[~late], at[late]


class _Numbers(dict):
    def __missing__(self, key):
        number = self[key] = len(self)
        return number


class Encoder:
    """Texts to ids; remembers the ids of pre-tokens between batches."""

    def __init__(self, ranks: dict[bytes, int], merges: MergeTable, pattern: str):
        import regex

        self.ranks, self.merges, self.find = ranks, merges, regex.compile(pattern).findall
        self._forget()

    def _forget(self) -> None:
        self.numbers = _Numbers()
        self.begin, self.flat = np.zeros(1, np.int64), np.zeros(0, np.int32)

    def _learn(self) -> None:
        """Encode the pre-tokens numbered since the last call."""
        known = len(self.begin) - 1
        fresh = [word.encode("utf-8") for word in list(self.numbers)[known:]]
        whole = np.fromiter((self.ranks.get(w, -1) for w in fresh), np.int64, len(fresh))
        pieces = [w for w, rank in zip(fresh, whole.tolist()) if rank < 0]
        ids, counts = merge_pieces(self.merges, pieces)
        sizes = np.ones(len(fresh), np.int64)
        sizes[whole < 0] = counts
        flat = np.empty(int(sizes.sum()), np.int32)
        merged = np.repeat(whole < 0, sizes)
        flat[merged], flat[~merged] = ids, whole[whole >= 0]
        self.flat = np.concatenate([self.flat, flat])
        self.begin = np.concatenate([self.begin, self.begin[-1] + np.cumsum(sizes)])

    def encode(self, texts: list[str | None]) -> Iterator[np.ndarray]:
        if len(self.numbers) > REMEMBERED:
            self._forget()
        number, rows = self.numbers.__getitem__, []
        for text in texts:
            words = self.find(text) if text else ()
            rows.append(np.fromiter(map(number, words), np.int32, len(words)))
        self._learn()
        for row in rows:
            sizes = self.begin[row + 1] - self.begin[row]
            ends = np.cumsum(sizes)
            total = int(ends[-1]) if len(ends) else 0
            yield self.flat[np.repeat(self.begin[row] - ends + sizes, sizes) + np.arange(total)]


def encode_texts(docs: DataFrame, ranks_path: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with the text column replaced by ``ids``: little-endian unsigned 32-bit ids, one after the other.

    The vocabulary is read on the driver and shipped with the function; its size does not depend on the data.
    """
    ranks = read_ranks(ranks_path)
    merges = MergeTable(ranks)
    rest = [c for c in docs.columns if c != text and c != ids]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(ranks, merges, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                packed = [x.astype("<u4").tobytes() for x in encoder.encode(part.column(len(rest)).to_pylist())]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(packed, pa.binary())], [*rest, ids])

    kept = docs.select(*[F.col(f"`{c}`") for c in rest], F.col(f"`{text}`").cast("string"))
    schema = docs.select(*[F.col(f"`{c}`") for c in rest], F.lit(b"").alias(ids)).schema
    return kept.mapInArrow(run, schema)


def decode_ids(encoded: DataFrame, ranks_path: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``encoded`` with ``decoded``: the bytes of the ids (empty for null)."""
    ranks = read_ranks(ranks_path)
    tokens = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        tokens[rank] = token
    shared = encoded.sparkSession.sparkContext.broadcast(tokens)
    at = encoded.columns.index(ids)
    keep = [i for i, c in enumerate(encoded.columns) if c != decoded]
    names = [encoded.columns[i] for i in keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = shared.value.__getitem__
        for batch in batches:
            texts = [b"".join(map(token, np.frombuffer(x or b"", "<u4").tolist())) for x in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in keep), pa.array(texts, pa.binary())], [*names, decoded],
            )

    schema = encoded.select(*[F.col(f"`{c}`") for c in names], F.lit(b"").alias(decoded)).schema
    return encoded.mapInArrow(run, schema)


@query()
def op9_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Every text encoded with the multilingual vocabulary and decoded again."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    docs = table(spark, folder, "documents").select("doc_id", "text")
    decoded = decode_ids(encode_texts(docs, path, public_tokenizers.PATTERN), path)
    return decoded.select(
        "doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )
