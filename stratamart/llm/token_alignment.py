"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes.

Both token sequences of a text are cut into groups at the byte offsets where a token ends in
both. A byte range of a text yields a fragment: an open prefix (tokens up to the first common
end), closed groups, and an open suffix (tokens behind the last one). Fragments compose
associatively - the suffix of one and the prefix of the next close into one group - so a long
text is cut into byte ranges that different tasks tokenize and a tree of ``FAN`` fragments each
puts together again. A short text is one range.

Neither tokenizer joins a character that is no white space with a space behind it (checked for
the pieces when the model is loaded), so tokens are found for such pieces of text on their own.
A range that starts or ends inside a piece tokenizes the whole piece and keeps the tokens that
end in the range. A task remembers the closed fragment of every piece it has seen.

How many documents hold an id pair linked: each block of documents counts its distinct pairs
once, the blocks' counts are summed by pair, and the sums go back to the blocks, which hold
their documents' pairs as places in the block's list. A pair that all documents hold is one
row from each block.

Null and empty texts, and texts that a tokenizer does not give back byte by byte (a B piece with
U+2581, say), have no tokens: zeros and no groups. Repeated rows each count as a document. Ties
for the highest count all count as best. An unbroken run of characters longer than a range stays
in one range. An empty table gives no rows. Other columns of the input are not read.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache, reduce
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratamart.llm.common import drop_stored, stored, table, text_buffer
from stratamart.llm.registry import query

#: Bytes of one range; longer texts are cut.
RANGE = 1 << 15
#: Fragments composed by one node of the tree.
FAN = 16
#: A worker forgets its pieces beyond so many (memory only).
REMEMBERED = 100_000
#: Pairs held by the documents of one block, about.
BLOCK_PAIRS = 1 << 20
#: Bytes of text a task aligns at once, about.
BATCH_BYTES = 1 << 19
#: Pieces handed to the tokenizers at once.
ENCODED = 4096
#: Pairs are numbered a * B_IDS + b; both vocabularies are smaller than this allows.
B_IDS = 32_000
MOST_IDS = 65_536

#: Fixed value: the pattern of byte-level pre-tokens that the vocabulary's own pre-tokenizer uses.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
CUT = re.compile(r"(?<=\S)(?= )")


def byte_characters() -> dict[str, int]:
    """The characters that stand for bytes in byte-level vocabularies: printable ones for themselves, the rest from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(rest)}


class Tokens:
    """Two sequences of ids with the byte offsets where they end."""

    def __init__(self, a, a_ends, b, b_ends):
        self.a, self.a_ends, self.b, self.b_ends = a, a_ends, b, b_ends

    def between(self, low: int, high: int) -> "Tokens":
        """Tokens that end in (low, high]."""
        i, j = np.searchsorted(self.a_ends, (low, high), "right")
        k, m = np.searchsorted(self.b_ends, (low, high), "right")
        return Tokens(self.a[i:j], self.a_ends[i:j], self.b[k:m], self.b_ends[k:m])

    def cuts(self) -> np.ndarray:
        return np.intersect1d(self.a_ends, self.b_ends, assume_unique=True)


NO_IDS = np.zeros(0, np.int64)


@dataclass
class Groups:
    """Closed groups: counts, their text with a ``;`` behind each and where each ends, and pairs as (group, code, number of occurrence pairs)."""

    n_a: np.ndarray
    n_b: np.ndarray
    text: str
    ends: np.ndarray
    owner: np.ndarray
    codes: np.ndarray
    times: np.ndarray

    def between(self, i: int, j: int) -> str:
        """Text of groups i to j - 1, without the last separator."""
        return self.text[self.ends[i - 1] if i else 0:self.ends[j - 1] - 1] if j > i else ""


@lru_cache(1)
def _written() -> tuple[list[str], np.ndarray]:
    """Every id in decimal with each separator behind it: id + MOST_IDS * place in ``,|;``."""
    texts = [f"{i}{separator}" for separator in ",|;" for i in range(MOST_IDS)]
    return texts, np.array([len(t) for t in texts], np.int64)


def _texts(tokens: Tokens, a_group: np.ndarray, b_group: np.ndarray) -> tuple[str, np.ndarray]:
    written, lengths = _written()
    group = np.concatenate([a_group, b_group])
    last_a, last_b = (np.append(g[1:] != g[:-1], True)[:len(g)] for g in (a_group, b_group))
    entry = np.concatenate([tokens.a + MOST_IDS * last_a, tokens.b + 2 * MOST_IDS * last_b])
    order = np.argsort(group, kind="stable")  # A comes before B in each group
    entry, group = entry[order], group[order]
    ends = np.cumsum(lengths[entry])[np.append(group[1:] != group[:-1], True)[:len(group)]]
    return "".join(map(written.__getitem__, entry.tolist())), ends


def _by_group(groups: np.ndarray, ids: np.ndarray):
    """Distinct (group, id) in order, with counts."""
    keys, counts = np.unique(groups << 32 | ids, return_counts=True)
    return keys >> 32, keys & 0xFFFFFFFF, counts


def close(tokens: Tokens, cuts: np.ndarray) -> Groups:
    """Groups of tokens of which the last ends at ``cuts[-1]``. Pairs come from distinct ids: a group never emits its square."""
    size = len(cuts)
    a_group, b_group = np.searchsorted(cuts, tokens.a_ends), np.searchsorted(cuts, tokens.b_ends)
    n_a, n_b = np.bincount(a_group, minlength=size), np.bincount(b_group, minlength=size)
    text, text_ends = _texts(tokens, a_group, b_group)
    group, a_ids, a_times = _by_group(a_group, tokens.a)
    of_b, b_ids, b_times = _by_group(b_group, tokens.b)
    begins = np.searchsorted(of_b, np.arange(size + 1))
    width = (begins[1:] - begins[:-1])[group]
    ends = np.cumsum(width)
    at = np.repeat(begins[group] - ends + width, width) + np.arange(int(ends[-1]) if len(ends) else 0)
    return Groups(n_a, n_b, text, text_ends, np.repeat(group, width), np.repeat(a_ids, width) * B_IDS + b_ids[at], np.repeat(a_times, width) * b_times[at])


def summed(codes: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes in order and the sums of their times."""
    if not len(codes):
        return NO_IDS, NO_IDS
    order = np.argsort(codes, kind="stable")
    codes, times = codes[order], times[order]
    begins = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
    return codes[begins], np.add.reduceat(times, begins)


@dataclass
class Fragment:
    """What a byte range of a text contributes. Without a common end (``cut`` false) all its tokens are in the prefix."""

    ok: bool = True
    cut: bool = False
    n_a: int = 0
    n_b: int = 0
    n_groups: int = 0
    n_links: int = 0
    texts: list[str] = field(default_factory=list)
    codes: np.ndarray = field(default_factory=lambda: NO_IDS)
    times: np.ndarray = field(default_factory=lambda: NO_IDS)
    prefix: tuple[np.ndarray, np.ndarray] = (NO_IDS, NO_IDS)
    suffix: tuple[np.ndarray, np.ndarray] = (NO_IDS, NO_IDS)


#: The start of a text is a common end, and so is its end.
START = Fragment(cut=True)


def fragment(tokens: Tokens, ok: bool = True) -> Fragment:
    cuts = tokens.cuts()
    if not len(cuts):
        return Fragment(ok, prefix=(tokens.a, tokens.b))
    last = int(max(tokens.a_ends[-1], tokens.b_ends[-1]))
    head, tail = tokens.between(-1, int(cuts[0])), tokens.between(int(cuts[-1]), last)
    out = Fragment(ok, True, prefix=(head.a, head.b), suffix=(tail.a, tail.b))
    return _with(out, close(tokens.between(int(cuts[0]), int(cuts[-1])), cuts[1:])) if len(cuts) > 1 else out


def _with(out: Fragment, groups: Groups) -> Fragment:
    out.n_a += int(groups.n_a.sum())
    out.n_b += int(groups.n_b.sum())
    out.n_groups += len(groups.ends)
    out.n_links += int((groups.n_a * groups.n_b).sum())
    out.texts = out.texts + [groups.text[:-1]]
    out.codes, out.times = summed(np.concatenate([out.codes, groups.codes]), np.concatenate([out.times, groups.times]))
    return out


def _both(x, y):
    return np.concatenate([x[0], y[0]]), np.concatenate([x[1], y[1]])


def compose(x: Fragment, y: Fragment) -> Fragment:
    """The fragment of two ranges next to each other; associative."""
    ok = x.ok and y.ok
    if not x.cut:
        return Fragment(ok, y.cut, y.n_a, y.n_b, y.n_groups, y.n_links, y.texts, y.codes, y.times, _both(x.prefix, y.prefix), y.suffix)
    if not y.cut:
        return Fragment(ok, True, x.n_a, x.n_b, x.n_groups, x.n_links, x.texts, x.codes, x.times, x.prefix, _both(x.suffix, y.prefix))
    out = Fragment(ok, True, x.n_a, x.n_b, x.n_groups, x.n_links, x.texts, x.codes, x.times, x.prefix, y.suffix)
    a, b = _both(x.suffix, y.prefix)
    if len(a) or len(b):
        one = np.array([1])
        out = _with(out, close(Tokens(a, np.ones(len(a), np.int64), b, np.ones(len(b), np.int64)), one))
    out.n_a, out.n_b, out.n_groups, out.n_links = out.n_a + y.n_a, out.n_b + y.n_b, out.n_groups + y.n_groups, out.n_links + y.n_links
    out.texts = out.texts + y.texts
    out.codes, out.times = summed(np.concatenate([out.codes, y.codes]), np.concatenate([out.times, y.times]))
    return out


class Spelling:
    """The bytes of each id."""

    def __init__(self, entries: list[bytes]):
        self.sizes = np.array([len(x) for x in entries], np.int64)
        self.begin = np.cumsum(self.sizes) - self.sizes
        self.data = np.frombuffer(b"".join(entries), np.uint8)

    def give_back(self, ids: np.ndarray, counts: np.ndarray, data: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Which pieces (of ``counts`` ids, and of ``sizes`` bytes in ``data``) their ids spell exactly."""
        owner = np.repeat(np.arange(len(sizes)), counts)
        ok = np.bincount(owner, weights=self.sizes[ids], minlength=len(sizes)).astype(np.int64) == sizes
        ids = ids[ok[owner]]
        width = self.sizes[ids]
        ends = np.cumsum(width)
        at = np.repeat(self.begin[ids] - ends + width, width) + np.arange(int(ends[-1]) if len(ends) else 0)
        of_byte = np.repeat(np.arange(len(sizes)), sizes)
        right = ok[of_byte]
        ok[of_byte[right][self.data[at] != data[right]]] = False
        return ok


def _a_encoder(a_json: str, ranks: dict[bytes, int]):
    """Encoder of one piece by the byte-level vocabulary: ids are ranks of merges where its merges are in the order of their ids."""
    model = json.loads(a_json)
    byte = byte_characters()
    merged = [m if isinstance(m, str) else " ".join(m) for m in model["model"]["merges"]]
    numbers = [ranks.get(bytes(byte[c] for c in m if c != " "), -1) for m in merged]
    if numbers == sorted(numbers) and len(set(numbers)) == len(numbers) and numbers[:1] > [255] and model["pre_tokenizer"]["use_regex"]:
        import tiktoken

        return tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    own = Tokenizer.from_str(a_json)
    own.encode_special_tokens = True
    return lambda piece: own.encode(piece, add_special_tokens=False).ids


class _Numbers(dict):
    def __missing__(self, key):
        number = self[key] = len(self)
        return number


class Aligner:
    """Tokenizes pieces of text with both tokenizers and remembers their closed fragments."""

    def __init__(self, a_json: str, b_model: bytes):
        import sentencepiece

        byte = byte_characters()
        entries = {bytes(map(byte.__getitem__, entry)): number for entry, number in json.loads(a_json)["model"]["vocab"].items() if all(c in byte for c in entry)}
        a_bytes = [b""] * (max(entries.values()) + 1)
        for entry, number in entries.items():
            a_bytes[number] = entry
        self.a = _a_encoder(a_json, entries)
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        b_bytes = []
        for number in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(number)
            if re.search("[^▁]▁", piece):
                raise ValueError(f"piece {piece!r} goes on behind a space")
            b_bytes.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(number) else piece.replace("▁", " ").encode())
        if len(b_bytes) > B_IDS or len(a_bytes) * B_IDS >= 1 << 31:
            raise ValueError("vocabularies too large for 31-bit pairs")
        self.a_bytes, self.b_bytes = Spelling(a_bytes), Spelling(b_bytes)
        self.a_sizes, self.b_sizes = self.a_bytes.sizes, self.b_bytes.sizes
        self.space = [self.b.piece_to_id("▁")]
        self._forget()

    def _forget(self) -> None:
        self.numbers = _Numbers()
        self.counts = np.zeros((4, 0), np.int64)
        self.ok, self.texts = np.zeros(0, bool), []
        self.begin, self.codes, self.times = np.zeros(1, np.int64), NO_IDS, NO_IDS

    def encode(self, pieces: list[str]):
        """Ids of the pieces (each begins with a space) by A and B end to end, numbers of ids, whether both give a piece's bytes back, and its size."""
        a, b = list(map(self.a, pieces)), []
        for at in range(0, len(pieces), ENCODED):
            b += [ids or self.space for ids in self.b.encode([p[1:] for p in pieces[at:at + ENCODED]], num_threads=1)]
        raw = [p.encode() for p in pieces]
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        data = np.frombuffer(b"".join(raw), np.uint8)
        sides = []
        for ids in (a, b):
            counts = np.fromiter(map(len, ids), np.int64, len(ids))
            sides.append((np.fromiter(chain.from_iterable(ids), np.int64, int(counts.sum())), counts))
        ok = self.a_bytes.give_back(*sides[0], data, sizes) & self.b_bytes.give_back(*sides[1], data, sizes)
        return *sides, ok, sizes

    def tokens(self, text: str) -> tuple[Tokens, bool]:
        """All tokens of a text that begins with a space."""
        (a, _), (b, _), ok, _ = self.encode(CUT.split(text))
        return Tokens(a, np.cumsum(self.a_sizes[a]), b, np.cumsum(self.b_sizes[b])), bool(ok.all())

    def _learn(self) -> None:
        fresh = list(self.numbers)[len(self.ok):]
        if not fresh:
            return
        (a, n_a), (b, n_b), ok, sizes = self.encode(fresh)
        a, b, good = a[np.repeat(ok, n_a)], b[np.repeat(ok, n_b)], np.flatnonzero(ok)
        # The good pieces end to end are one text whose pieces all end at common ends.
        tokens = Tokens(a, np.cumsum(self.a_sizes[a]), b, np.cumsum(self.b_sizes[b]))
        cuts = tokens.cuts()
        groups = close(tokens, cuts)
        ends = np.searchsorted(cuts, np.cumsum(sizes[good]), "right")
        starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
        counts, texts = np.zeros((4, len(fresh)), np.int64), [""] * len(fresh)
        for i, values in enumerate((groups.n_a, groups.n_b, np.ones(len(cuts), np.int64), groups.n_a * groups.n_b)):
            total = np.concatenate([[0], np.cumsum(values)])
            counts[i, good] = total[ends] - total[starts]
        group_ends = np.concatenate([[0], groups.ends])
        for n, i, j in zip(good.tolist(), group_ends[starts].tolist(), group_ends[ends].tolist()):
            texts[n] = groups.text[i:j - 1]
        pairs = np.zeros(len(fresh), np.int64)
        pairs[good] = np.searchsorted(groups.owner, ends) - np.searchsorted(groups.owner, starts)
        self.begin = np.concatenate([self.begin, self.begin[-1] + np.cumsum(pairs)])
        self.codes, self.times = np.concatenate([self.codes, groups.codes]), np.concatenate([self.times, groups.times])
        self.counts = np.concatenate([self.counts, counts], axis=1)
        self.ok = np.concatenate([self.ok, ok])
        self.texts += texts

    def runs(self, texts: list[list[str]]) -> Iterator[Fragment]:
        """The closed fragment of each list of whole pieces: it begins and ends at common ends."""
        if len(self.numbers) > REMEMBERED:
            self._forget()
        number = self.numbers.__getitem__
        rows = [np.array([number(p) for p in pieces], np.int64) for pieces in texts]
        self._learn()
        for row in rows:
            if not len(row) or not self.ok[row].all():
                yield Fragment(not len(row), True)
                continue
            sizes = self.begin[row + 1] - self.begin[row]
            ends = np.cumsum(sizes)
            at = np.repeat(self.begin[row] - ends + sizes, sizes) + np.arange(int(ends[-1]))
            text = ";".join(map(self.texts.__getitem__, row.tolist()))
            yield Fragment(True, True, *self.counts[:, row].sum(axis=1).tolist(), [text], *summed(self.codes[at], self.times[at]))

    def part(self, piece: str, low: int, high: int) -> Fragment:
        """The fragment of a byte range inside one piece."""
        tokens, ok = self.tokens(piece)
        return fragment(tokens.between(low, high), ok) if ok else Fragment(False)

    def range(self, text: str, low: int, high: int) -> Fragment:
        """The fragment of bytes ``low`` to ``high`` of some whole pieces, of which it touches all."""
        pieces = CUT.split(text)
        sizes = [len(p.encode()) for p in pieces]
        last = sum(sizes[:-1])
        if len(pieces) == 1:
            return self.part(text, low, high)
        first = [self.part(pieces[0], low, sizes[0])] if low else []
        tail = [self.part(pieces[-1], 0, high - last)] if high < last + sizes[-1] else []
        whole = pieces[1 if first else 0:len(pieces) - len(tail)]
        return reduce(compose, [*first, *self.runs([whole]), *tail])


# --- packed numbers ----------------------------------------------------------

def pack(values: np.ndarray) -> bytes:
    """Unsigned 32-bit numbers as four planes of bytes; the upper ones are mostly zero and compress well."""
    return values.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def unpack(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<u4")[:, 0].astype(np.int64)


FRAGMENT = ("row long, no int, ok boolean, cut boolean, n_a long, n_b long, n_groups long, n_links long, groups string, "
            "codes binary, times binary, prefix_a binary, prefix_b binary, suffix_a binary, suffix_b binary")
FRAGMENT_NAMES = [f.split()[0] for f in FRAGMENT.split(", ")]


def _fragment_row(x: Fragment) -> tuple:
    return (x.ok, x.cut, x.n_a, x.n_b, x.n_groups, x.n_links, ";".join(x.texts), pack(x.codes), pack(x.times),
            pack(x.prefix[0]), pack(x.prefix[1]), pack(x.suffix[0]), pack(x.suffix[1]))


def _row_fragment(r: dict) -> Fragment:
    return Fragment(r["ok"], r["cut"], r["n_a"], r["n_b"], r["n_groups"], r["n_links"], [r["groups"]] if r["groups"] else [],
                    unpack(r["codes"]), unpack(r["times"]), (unpack(r["prefix_a"]), unpack(r["prefix_b"])), (unpack(r["suffix_a"]), unpack(r["suffix_b"])))


def byte_ranges(text: str, size: int = RANGE) -> list[tuple[str, int, int]]:
    """(pieces, low, high) of each byte range of " " + text: offsets count from the first of the whole pieces that it touches.

    Ranges end at multiples of ``size``, inside a piece too; where a piece is longer than ``size``, at its end.
    """
    pieces = CUT.split(" " + text)
    ends = np.cumsum([len(p.encode()) for p in pieces])
    starts = np.concatenate([[0], ends[:-1]])
    bounds = [0]
    while bounds[-1] < ends[-1]:
        bound = min(bounds[-1] + size, int(ends[-1]))
        at = int(np.searchsorted(ends, bound))
        bounds.append(int(ends[at]) if ends[at] - starts[at] > size else bound)
    out = []
    for low, high in zip(bounds, bounds[1:]):
        i, j = int(np.searchsorted(ends, low, "right")), int(np.searchsorted(ends, high))
        out.append(("".join(pieces[i:j + 1]), low - int(starts[i]), high - int(starts[i])))
    return out


def _models(a_path: str, b_path: str) -> tuple[str, bytes]:
    """Both vocabularies, read on the driver and shipped with the functions; their size does not depend on the data."""
    with open(a_path, encoding="utf-8") as a, open(b_path, "rb") as b:
        return json.dumps(json.load(a)), b.read()


def _long_texts(docs: DataFrame, models: tuple[str, bytes], size: int) -> DataFrame:
    """(k, fragment) of texts longer than one range: ranges in tasks of their own, composed by a tree.

    Each step is a job of its own, so that no task holds the Python workers of several steps.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, text in zip(batch.column(0), batch.column(1)):  # one text at a time
                row, found = row.as_py(), byte_ranges(text.as_py(), size)
                for at in range(0, len(found), 64):
                    part = found[at:at + 64]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([row] * len(part), pa.int64()), pa.array(range(at, at + len(part)), pa.int32()), pa.array([p[0] for p in part], pa.string()),
                        pa.array([p[1] for p in part], pa.int64()), pa.array([p[2] for p in part], pa.int64())], ["row", "no", "pieces", "low", "high"])

    def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = None
        for batch in batches:
            for r in _each(batch):
                aligner = aligner or Aligner(*models)
                yield _record(FRAGMENT, [(r["row"], r["no"], *_fragment_row(aligner.range(r["pieces"], r["low"], r["high"])))])

    def node(group: pa.Table) -> pa.Table:
        found = sorted(group.to_pylist(), key=lambda r: r["no"])
        whole = reduce(compose, map(_row_fragment, found))
        return pa.Table.from_batches([_record(FRAGMENT, [(found[0]["row"], found[0]["no"] // FAN, *_fragment_row(whole))])])

    numbered = stored(docs.withColumn("row", F.monotonically_increasing_id()), "align-long")
    ranges = numbered.select("row", "t").mapInArrow(cut, "row long, no int, pieces string, low long, high long")
    leaf = stored(ranges.repartition("row", "no").mapInArrow(leaves, FRAGMENT), "align-ranges")
    fragments, most = leaf, leaf.agg(F.max("no")).first()[0]
    while most:
        fragments = fragments.groupBy("row", F.floor(F.col("no") / FAN)).applyInArrow(node, FRAGMENT)
        most //= FAN
    if fragments is not leaf:
        fragments = stored(fragments, "align-whole")
        drop_stored(leaf)
    return numbered.select("row", "k").join(fragments, "row")


ALIGNED = "n_a long, n_b long, n_groups long, n_links long, groups string, codes binary, times binary"
_ARROW = {"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "string": pa.string(), "binary": pa.binary()}


def aligned_row(x: Fragment) -> tuple:
    """A whole text's fields; zeros where a tokenizer does not give it back."""
    return (x.n_a, x.n_b, x.n_groups, x.n_links, ";".join(x.texts), pack(x.codes), pack(x.times)) if x.ok else (0, 0, 0, 0, "", b"", b"")


def _record(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    names, types = zip(*(f.split() for f in schema.split(", ")))
    return pa.RecordBatch.from_arrays([pa.array(c, _ARROW[t]) for c, t in zip(zip(*rows), types)], list(names))


def _each(batch: pa.RecordBatch) -> Iterator[dict]:
    """The rows of a batch, one at a time."""
    for at in range(batch.num_rows):
        yield from batch.slice(at, 1).to_pylist()


def _slices(batch: pa.RecordBatch, column: int) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Parts of a batch of about ``BATCH_BYTES`` of text."""
    begin, ends = 0, text_buffer(batch.column(column))[1]
    while begin < batch.num_rows:
        end = max(begin + 1, int(np.searchsorted(ends, ends[begin] + BATCH_BYTES, "right")) - 1)
        part = batch.slice(begin, end - begin)
        yield part, part.column(column).to_pylist()
        begin = end


def _aligning(models: tuple[str, bytes], digest: bool):
    """The function that aligns batches of (k, text) of texts of one range."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = None
        for batch in batches:
            for part, texts in _slices(batch, 1):
                aligner = aligner or Aligner(*models)
                rows = [aligned_row(x) for x in aligner.runs([CUT.split(" " + t) if t else [] for t in texts])]
                record = _record(ALIGNED, [_digested(r) for r in rows] if digest else rows)
                yield pa.RecordBatch.from_arrays([part.column(0), *record.columns], ["k", *record.schema.names])

    return run


def _digested(row: tuple) -> tuple:
    """An aligned row with the SHA-256 of its groups."""
    return (*row[:4], hashlib.sha256(row[4].encode()).hexdigest() if row[4] else "", *row[5:])


def _finishing(digest: bool):
    """The function that makes aligned rows of batches of (k, fragment of a whole text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, r in enumerate(_each(batch.select(FRAGMENT_NAMES))):
                row = aligned_row(compose(compose(START, _row_fragment(r)), START))
                record = _record(ALIGNED, [_digested(row) if digest else row])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, 1), *record.columns], ["k", *record.schema.names])

    return run


def _split(docs: DataFrame, models: tuple[str, bytes], key: str, text: str, size: int) -> tuple[DataFrame, DataFrame]:
    """(k, text) of texts of one range, and the (k, fragment) of longer ones."""
    rows = docs.select(F.col(f"`{key}`").alias("k"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("t"))
    long = F.octet_length("t") >= size
    return rows.where(~long), _long_texts(rows.where(long), models, size).select("k", *FRAGMENT_NAMES)


def align(docs: DataFrame, a_path: str, b_path: str, key: str = "doc_id", text: str = "text", digest: bool = False, size: int = RANGE) -> DataFrame:
    """(k, n_a, n_b, n_groups, n_links, groups, codes, times) of every row.

    ``groups`` is ``a1,a2|b1;a3|b2,b3`` (with ``digest`` its SHA-256 in hex, empty without tokens);
    ``codes`` and ``times`` are the packed distinct pairs and their links.
    """
    models = _models(a_path, b_path)
    short, far = _split(docs, models, key, text, size)
    schema = f"k {short.schema['k'].dataType.simpleString()}, {ALIGNED}"
    return short.mapInArrow(_aligning(models, digest), schema).unionByName(far.mapInArrow(_finishing(digest), schema))


COLUMNS = ["k", "n_a", "n_b", "n_groups", "n_links", "groups", "codes", "times"]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Aligned documents block by block, each followed by a row of the block's distinct pairs and their documents."""
    task, number, held, size = TaskContext.get().partitionId(), 0, [], 0

    def flush():
        codes = [unpack(c) for part in held for c in part.column(6).to_pylist()]
        distinct, documents = np.unique(np.concatenate([*codes, NO_IDS]), return_counts=True)
        block = task << 32 | number
        at = iter(codes)
        for part in held:
            places = [pack(np.diff(np.searchsorted(distinct, next(at)), prepend=0)) for _ in range(part.num_rows)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([block] * part.num_rows, pa.int64()), pa.array([False] * part.num_rows), *part.columns[:6],
                 pa.array(places, pa.binary()), part.column(7)], ["block", "is_block", *COLUMNS])
        if len(distinct):
            empty = [pa.nulls(1, held[0].column(i).type) for i in range(6)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([block], pa.int64()), pa.array([True]), *empty, pa.array([pack(distinct)], pa.binary()), pa.array([pack(documents)], pa.binary())],
                ["block", "is_block", *COLUMNS])

    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            held.append(part)
            size += sum(map(len, part.column(6).to_pylist())) // 4
            if size >= BLOCK_PAIRS:
                yield from flush()
                number, held, size = number + 1, [], 0
    if held:
        yield from flush()


def _block_schema(rows: DataFrame) -> str:
    return f"block long, is_block boolean, k {rows.schema['k'].dataType.simpleString()}, {ALIGNED}"


def with_pair_counts(aligned: DataFrame) -> DataFrame:
    """``aligned`` with n_best and count_sum in place of the pairs: how many documents hold each linked pair, corpus-wide."""
    return _counted(stored(aligned.select(*COLUMNS).mapInArrow(_blocks, _block_schema(aligned)), "align-blocks"))


def counted_alignment(docs: DataFrame, a_path: str, b_path: str, key: str = "doc_id", text: str = "text", digest: bool = False, size: int = RANGE) -> DataFrame:
    """``with_pair_counts`` of ``align``; aligning and blocking are one Python worker's work."""
    models = _models(a_path, b_path)
    short, far = _split(docs, models, key, text, size)
    aligning, finishing, schema = _aligning(models, digest), _finishing(digest), _block_schema(far)
    blocks = short.mapInArrow(lambda batches: _blocks(aligning(batches)), schema)
    blocks = blocks.unionByName(far.mapInArrow(lambda batches: _blocks(finishing(batches)), schema))
    return _counted(stored(blocks, "align-blocks"))


def _counted(written: DataFrame) -> DataFrame:
    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, codes, documents in zip(*(c.to_pylist() for c in batch.columns)):
                codes, documents = unpack(codes), unpack(documents)
                for at in range(0, len(codes), 1 << 17):
                    some = codes[at:at + (1 << 17)]
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.full(len(some), block)), pa.array(np.arange(at, at + len(some), dtype=np.int32)),
                        pa.array(some.astype(np.int32)), pa.array(documents[at:at + len(some)])], ["block", "place", "pair", "docs"])

    held = written.where("is_block").select("block", "codes", "times").mapInArrow(pairs, "block long, place int, pair int, docs long")
    counts = held.groupBy("pair").agg(F.sum("docs").alias("docs")).withColumn("a", F.floor(F.col("pair") / B_IDS).cast("int"))
    # One row for each A id: at most the size of its vocabulary.
    top = counts.groupBy("a").agg(F.max("docs").alias("top"))
    marked = counts.join(F.broadcast(top), "a").select("pair", "docs", (F.col("docs") == F.col("top")).alias("best"))
    back = held.select("block", "place", "pair").join(marked, "pair").select("block", "place", "docs", "best")

    def answer(documents: pa.Table, found: pa.Table) -> pa.Table:
        docs, best = np.zeros(found.num_rows, np.int64), np.zeros(found.num_rows, np.int64)
        place = found.column("place").to_numpy()
        docs[place], best[place] = found.column("docs").to_numpy(), found.column("best").to_numpy(zero_copy_only=False)
        n_best, sums = [], []
        for places, times in zip(documents.column("codes").to_pylist(), documents.column("times").to_pylist()):
            at, times = np.cumsum(unpack(places)), unpack(times)
            n_best.append(int((times * best[at]).sum()))
            sums.append(int((times * docs[at]).sum()))
            kept = documents.select(COLUMNS[:6])
        return kept.append_column("n_best", pa.array(n_best, pa.int64())).append_column("count_sum", pa.array(sums, pa.int64()))

    key_type = written.schema["k"].dataType.simpleString()
    out = f"k {key_type}, n_a long, n_b long, n_groups long, n_links long, groups string, n_best long, count_sum long"
    return written.where("not is_block").drop("is_block").groupBy("block").cogroup(back.groupBy("block")).applyInArrow(answer, out)


@query()
def op12_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    """Groups and links of the two public tokenizers over every whole text."""
    import public_tokenizers

    a, b = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    counted = counted_alignment(table(spark, folder, "documents"), a, b, digest=True)
    return counted.select(
        F.col("k").cast("long").alias("doc_id"), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", F.col("groups").alias("groups_sha256"))
