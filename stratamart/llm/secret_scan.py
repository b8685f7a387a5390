"""Secret scans: a linear-chain conditional random field over the tokens of whole texts.

Three fixed patterns find base spans; a span is its whole match. The field learns from them what a
secret looks like: every token gets the tag begin, inside or outside, from its shape, its
first characters, the words and separators around it and features of the whole text. It is
fitted on windows around the values of the patterns and on windows of other texts, with copies
whose value is drawn from other alphabets and whose keyword is replaced, so that it also tags
secrets that no pattern describes. Tagged spans that overlap no base span are added as ``crf``.

Training maximises the likelihood of at most ``MAX_DOCS`` texts of each class, those with the
smallest hash, equal texts once, ``WINDOWS`` windows each. Decoding is Viterbi over every token
of every whole text: the tokens are cut into chunks whose 3 by 3 max-plus products are found for
all chunks together, joined text by text, and traced back inside the chunks, so a very long
text costs a few numpy steps per chunk, not per token.

Null texts count as empty and have no spans. Equal rows get equal results. Base spans of one
start are ordered by kind as listed. Without a text that holds a base span the field tags
nothing. An empty table gives no rows. Other columns of the input pass through; own columns
of the names that the scan adds are replaced.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratamart.llm.common import stored, table, text_buffer, word_hashes, word_spans
from stratamart.llm.registry import query

#: The base patterns; letters of the first in either case. Matches whose group is shorter than given do not count.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
LEAST_ASSIGN, LEAST_ACCESS = 6, 20
KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")

#: Bound of the training sample: texts with a base span, and texts without.
MAX_DOCS = 400
WINDOWS = 3
WINDOW = 32
#: Copies with other values, one window each, that all texts with base spans add together, about; and one of them at most.
VARIANTS = 1500
MOST_VARIANTS = 100
STEPS = 80
#: Added to the score of begin: a missed secret weighs more than a wrongly tagged token.
LEAN = 5.0
#: Bytes of text a task tags at once, about.
BATCH_BYTES = 1 << 21
CHUNK = 64
OUTSIDE, BEGIN, INSIDE = range(3)
NEVER = -1e9

# --- features ----------------------------------------------------------------

_BYTES = np.arange(256)


def _among(*ranges: tuple[str, str]) -> np.ndarray:
    out = np.zeros(256, bool)
    for low, high in ranges:
        out[ord(low):ord(high) + 1] = True
    return out


LOWER, UPPER, DIGIT = _among(("a", "z")), _among(("A", "Z")), _among(("0", "9"))
SYMBOL = np.isin(_BYTES, np.frombuffer(b"+/_.-", np.uint8))
OTHER = _BYTES >= 0x80
TOKEN = LOWER | UPPER | DIGIT | SYMBOL | OTHER
HEX_BYTE = DIGIT | _among(("a", "f"))
CLASS = np.select([LOWER, UPPER, DIGIT, SYMBOL, OTHER], range(5), 5).astype(np.int8)
TO_LOWER = np.where(UPPER, _BYTES + 32, _BYTES).astype(np.uint8)
LENGTHS = np.array([3, 6, 10, 16, 24, 32, 48])
#: Numbers of values of each feature field; a token has one value in each.
FIELDS = {
    "shape": 256, "mix": 64, "shape_before": 257, "shape_after": 257, "word_before": 4097, "word_before_that": 4097,
    "word_after": 4097, "first_bytes": 4096, "gaps": 256, "shape_and_gap": 512, "file": 128,
}
STARTS = np.concatenate([[0], np.cumsum(list(FIELDS.values()))])


def _running(flags: np.ndarray) -> np.ndarray:
    return np.concatenate([np.zeros(1, np.int32), np.cumsum(flags, dtype=np.int32)])


def _neighbour(values: np.ndarray, doc: np.ndarray, by: int, nothing: int) -> np.ndarray:
    """``values`` of the token ``by`` places on in the same text, ``nothing`` where there is none."""
    out = np.full(len(values), nothing, np.int64)
    if by < 0 and len(values) > -by:
        same = doc[-by:] == doc[:by]
        out[-by:][same] = values[:by][same]
    elif by > 0 and len(values) > by:
        same = doc[by:] == doc[:-by]
        out[:-by][same] = values[by:][same]
    return out


def features(data: np.ndarray, offsets: np.ndarray, file: np.ndarray | None = None):
    """Starts, stops, text numbers and feature ids (fields, tokens) of all tokens; ``file`` replaces the texts' own file features."""
    starts, stops, doc = word_spans(data, offsets, TOKEN)
    length = stops - starts
    kinds = CLASS[data]
    counts = []
    digits_before = None
    for kind in range(5):
        running = _running(kinds == kind)
        counts.append(running[stops] - running[starts])
        if kind == 2:
            digits_before = running
    bucket = np.searchsorted(LENGTHS, length, "right")
    held = sum((c > 0).astype(np.int64) << i for i, c in enumerate(counts))
    shape = held << 3 | bucket
    change = np.zeros(len(data), bool)
    change[1:] = kinds[1:] != kinds[:-1]
    running = _running(change)
    changes = np.minimum(running[stops] - running[np.minimum(starts + 1, stops)], 15)
    hex_run = _running(HEX_BYTE[data])
    only_hex = hex_run[stops] - hex_run[starts] == length
    first_digit = kinds[starts] == 2 if len(starts) else np.zeros(0, bool)
    mix = changes << 2 | only_hex.astype(np.int64) << 1 | first_digit
    begin, end = offsets[doc], offsets[doc + 1]
    before = np.maximum(begin, _neighbour(stops, doc, -1, 0))
    after = np.where((following := _neighbour(starts, doc, 1, -1)) >= 0, following, end)
    gap_before, gap_after = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
    assigns = None
    for bit, among in enumerate((b"=", b":", b"\"'", b"\n")):
        running = _running(np.isin(_BYTES, np.frombuffer(among, np.uint8))[data])
        gap_before |= (running[starts] > running[before]).astype(np.int64) << bit
        gap_after |= (running[after] > running[stops]).astype(np.int64) << bit
        assigns = running if assigns is None else assigns + running if bit == 1 else assigns
    words = word_hashes(TO_LOWER[data], starts, stops)
    word = (words >> np.uint64(52)).astype(np.int64)
    padded = np.concatenate([data, np.zeros(4, np.uint8)])
    four = sum(np.where(length > i, padded[starts + i], 0).astype(np.uint64) << np.uint64(8 * i) for i in range(4)) if len(starts) else np.zeros(0, np.uint64)
    first = ((four * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(52)).astype(np.int64)
    if file is None:
        size = np.diff(offsets)
        digit_share = (digits_before[offsets[1:]] - digits_before[offsets[:-1]]) / np.maximum(size, 1)
        assign_share = (assigns[offsets[1:]] - assigns[offsets[:-1]]) / np.maximum(size, 1)
        file = (np.minimum(np.log2(np.maximum(size, 1)).astype(np.int64) // 2, 7) << 4
                | np.searchsorted([0.005, 0.02, 0.1], digit_share) << 2 | np.searchsorted([0.0005, 0.002, 0.01], assign_share))
    ids = np.empty((len(FIELDS), len(starts)), np.int32)
    for row, start, values in zip(ids, STARTS.tolist(), (
        shape, mix, _neighbour(shape, doc, -1, 256), _neighbour(shape, doc, 1, 256), _neighbour(word, doc, -1, 4096), _neighbour(word, doc, -2, 4096),
        _neighbour(word, doc, 1, 4096), first, gap_before << 4 | gap_after, shape << 1 | ((gap_before & 3) > 0), file[doc],
    )):
        np.add(values, start, out=row, casting="unsafe")
    return starts, stops, doc, ids


# --- base spans --------------------------------------------------------------

def base_spans(text: str) -> list[tuple[int, int, int, int]]:
    """(start, kind, end, start of the value) in code points, by start and kind."""
    found = [(m.start(), 0, m.end(), m.start(2)) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST_ASSIGN]
    found += [(m.start(), 1, m.end(), m.start()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    found += [(m.start(), 2, m.end(), m.start()) for m in HEX.finditer(text)]
    return sorted(found)


def may_hold_base(data: bytes) -> bool:
    """False only where no base pattern matches; much faster than the patterns."""
    low = data.lower()
    return any(k in low for k in KEYWORDS) or b"AKIA" in data or HEX_BYTES.search(data) is not None


HEX_BYTES = re.compile(rb"[0-9a-f]{24}")


def with_base(text: Column) -> Column:
    low = F.lower(text)
    any_keyword = low.contains(KEYWORDS[0].decode())
    for k in KEYWORDS[1:]:
        any_keyword |= low.contains(k.decode())
    return (any_keyword & text.rlike(r"""(?i)(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{6}""")) \
        | text.rlike("AKIA[A-Z0-9]{16}") | text.rlike("[0-9a-f]{24}")


# --- the field ---------------------------------------------------------------

@dataclass
class Model:
    """Weights of begin and inside for each feature, outside being zero, and scores of tag pairs."""

    weights: np.ndarray
    steps: np.ndarray

    def emissions(self, ids: np.ndarray) -> np.ndarray:
        """Scores of begin and inside at each token of (fields, tokens)."""
        out = np.zeros((ids.shape[1], 2), np.float32)
        for field in ids:
            out += self.weights[field]
        return out

    def tags(self, ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Viterbi tags of all tokens of texts with ``sizes`` tokens.

        The path outside throughout scores 0. A run of other tags gains at most its emissions and one step more than
        it has tokens, so where no token's emission makes up for two of the best step, that path is the best one.
        """
        scores = self.emissions(ids)
        bar = -2 * max(0.0, float(self.steps.max()))
        texts = np.repeat(np.arange(len(sizes)), sizes)
        open_ = np.zeros(len(sizes), bool)
        open_[texts[scores.max(axis=1, initial=NEVER) >= bar]] = True
        some = open_[texts]
        out = np.zeros(len(texts), np.int8)
        held = np.zeros((int(some.sum()), 3))
        held[:, 1:] = scores[some]
        out[some] = decode(held, sizes[open_], self.steps)
        return out


def no_model() -> Model:
    return Model(np.full((STARTS[-1], 2), -1.0, np.float32), forbidden(np.zeros((3, 3))))


def forbidden(steps: np.ndarray) -> np.ndarray:
    steps = steps.copy()
    steps[OUTSIDE, INSIDE] = NEVER
    return steps


def likelihood(emissions: np.ndarray, steps: np.ndarray, tags: np.ndarray, inside: np.ndarray):
    """Sum of the windows' log likelihoods, and its gradients by emission and step.

    Arrays are (window place, window, ...); before each window the tag is outside.
    """
    length, windows = tags.shape
    forward = np.empty((length + 1, windows, 3))
    forward[0] = NEVER
    forward[0, :, OUTSIDE] = 0
    for t in range(length):
        reach = forward[t][:, :, None] + steps
        top = reach.max(axis=1)
        forward[t + 1] = np.where(inside[t][:, None], top + np.log(np.exp(reach - top[:, None]).sum(axis=1)) + emissions[t], forward[t])
    top = forward[-1].max(axis=1)
    total = top + np.log(np.exp(forward[-1] - top[:, None]).sum(axis=1))
    backward = np.zeros((windows, 3))
    by_emission, by_step, own = np.zeros_like(emissions), np.zeros((3, 3)), 0.0
    rows = np.arange(windows)
    for t in range(length - 1, -1, -1):
        live = inside[t][:, None]
        joint = np.exp(forward[t][:, :, None] + steps + (emissions[t] + backward)[:, None, :] - total[:, None, None]) * live[:, :, None]
        before = tags[t - 1] if t else np.zeros(windows, np.int64)
        by_emission[t] = -joint.sum(axis=1)
        by_emission[t, rows, tags[t]] += inside[t]
        by_step -= joint.sum(axis=0)
        np.add.at(by_step, (before[inside[t]], tags[t][inside[t]]), 1)
        own += ((emissions[t, rows, tags[t]] + steps[before, tags[t]]) * inside[t]).sum()
        onward = steps + (emissions[t] + backward)[:, None, :]
        top = onward.max(axis=2)
        backward = np.where(live, top + np.log(np.exp(onward - top[:, :, None]).sum(axis=2)), backward)
    return own - total.sum(), by_emission, by_step


def train(ids: np.ndarray, tags: np.ndarray, inside: np.ndarray, steps: int = STEPS, ridge: float = 0.3) -> Model:
    """Adam, full batch. ``ids`` is (window, place, field), ``tags`` and ``inside`` (window, place)."""
    windows = len(ids)
    at_place, at_window = np.nonzero(inside.T)
    flat = ids.transpose(1, 0, 2)[at_place, at_window]
    weights, pairs = np.zeros((STARTS[-1], 2)), np.zeros((3, 3))
    values = [weights, pairs]
    first, second = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values]
    places = tags.T.copy()
    for step in range(1, steps + 1):
        emissions = np.zeros((ids.shape[1], windows, 3))
        held = np.zeros((len(flat), 2))
        for column in flat.T:
            held += weights[column]
        emissions[at_place, at_window, 1:] = held
        _, by_emission, by_step = likelihood(emissions, forbidden(pairs), places, inside.T)
        wrong = by_emission[at_place, at_window, 1:]
        grad = np.stack([sum(np.bincount(c, weights=wrong[:, k], minlength=STARTS[-1]) for c in flat.T) for k in (0, 1)], axis=1)
        by_step[OUTSIDE, INSIDE] = 0
        for i, (value, g) in enumerate(zip(values, (grad - ridge * weights, by_step))):
            g = g / windows
            first[i], second[i] = 0.9 * first[i] + 0.1 * g, 0.999 * second[i] + 0.001 * g * g
            value += 0.2 * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-6)
    weights[:STARTS[1], 0] += LEAN  # on the first field, of which every token has one value
    # The path that is outside throughout scores zero.
    return Model(weights.astype(np.float32), forbidden(pairs - pairs[OUTSIDE, OUTSIDE]))


def decode(emissions: np.ndarray, sizes: np.ndarray, steps: np.ndarray, chunk: int = CHUNK) -> np.ndarray:
    """Viterbi tags of consecutive sequences of ``sizes`` tokens, each with outside before it. Ties prefer outside, then begin."""
    tags = np.zeros(len(emissions), np.int8)
    chunks = -(-sizes // chunk)
    if not chunks.sum():
        return tags
    of = np.repeat(np.arange(len(sizes)), chunks)
    level = np.arange(len(of)) - np.repeat(np.cumsum(chunks) - chunks, chunks)
    begin = (np.cumsum(sizes) - sizes)[of] + level * chunk
    length = np.minimum(chunk, sizes[of] - level * chunk)
    order = np.argsort(-length, kind="stable")
    begin, length, of, level = begin[order], length[order], of[order], level[order]
    live = [int(np.searchsorted(-length, -t)) for t in range(chunk)]  # chunks longer than t come first
    # Max-plus product of each chunk, from the tag before it to its last tag.
    product = np.full((len(begin), 3, 3), NEVER)
    product[:, range(3), range(3)] = 0
    for t in range(chunk):
        k = live[t]
        if not k:
            break
        now = product[:k]
        product[:k] = np.max(now[:, :, :, None] + steps, axis=2) + emissions[begin[:k] + t][:, None, :]
    # Sequences: from chunk to chunk, all sequences with a chunk of that level together.
    best = np.full((len(sizes), 3), NEVER)
    best[:, OUTSIDE] = 0
    came = np.zeros((len(begin), 3), np.int8)
    by_level = np.argsort(level, kind="stable")
    cuts = np.searchsorted(level[by_level], np.arange(int(level.max()) + 2))
    groups = [by_level[i:j] for i, j in zip(cuts, cuts[1:])]
    for group in groups:
        reach = best[of[group]][:, :, None] + product[group]
        came[group] = reach.argmax(axis=1)
        best[of[group]] = reach.max(axis=1)
    last, entry, leave = best.argmax(axis=1), np.zeros(len(begin), np.int64), np.zeros(len(begin), np.int64)
    for group in reversed(groups):
        leave[group] = last[of[group]]
        entry[group] = came[group, leave[group]]
        last[of[group]] = entry[group]
    # Inside the chunks: from the tag before each to its last tag.
    score = np.full((len(begin), 3), NEVER)
    score[np.arange(len(begin)), entry] = 0
    back = np.zeros((chunk, len(begin), 3), np.int8)
    for t in range(chunk):
        k = live[t]
        if not k:
            break
        reach = score[:k, :, None] + steps
        back[t, :k] = reach.argmax(axis=1)
        score[:k] = reach.max(axis=1) + emissions[begin[:k] + t]
    state = leave
    for t in range(chunk - 1, -1, -1):
        k = live[t]
        tags[begin[:k] + t] = state[:k]
        state[:k] = back[t, np.arange(k), state[:k]]
    return tags


# --- training windows --------------------------------------------------------

ALPHABETS = ("0123456789ABCDEF", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789",
             "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", "abcdefghijklmnopqrstuvwxyz0123456789_-", "0123456789abcdef")


def variants(text: str, spans: list, dice: np.random.Generator, number: int) -> list[tuple[str, list]]:
    """Surroundings of some base spans with a value of another alphabet, after the keyword, another one or none."""
    out = []
    words = re.findall(r"[^\W\d_]{3,12}", text[:4000]) or ["key"]
    for at in dice.integers(0, len(spans), number) if spans else ():
        start, kind, end, value = spans[at]
        new = "".join(dice.choice(list(ALPHABETS[dice.integers(len(ALPHABETS))]), int(dice.integers(16, 56))))
        low = max(0, start - 150)
        head, word, way = text[low:start], str(dice.choice(words)), dice.integers(3)
        if way == 0:  # nothing but another word before the value
            head += word + " "
        elif way == 1 and kind == 0:  # another word as keyword
            head += word + text[start + len(ASSIGN.match(text, start)[1]):value]
        else:
            head += text[start:value]
        out.append((head + new + text[end:end + 150], [(len(head), 0, len(head) + len(new), len(head))]))
    return out


def token_tags(text: str, spans: list, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """Tags of one text's tokens (byte offsets from its start): begin and inside where they overlap a value."""
    tags = np.zeros(len(starts), np.int8)
    done = 0
    for start, _, end, value in sorted(spans, key=lambda s: s[3]):
        low, high = len(text[:value].encode()), len(text[:end].encode())
        i, j = max(done, int(np.searchsorted(stops, low, "right"))), int(np.searchsorted(starts, high))
        if i < j:
            tags[i:j], tags[i] = INSIDE, BEGIN
            done = j
    return tags


def _windows(text: str, spans: list, dice: np.random.Generator, file: np.ndarray | None, number: int) -> list[tuple[bytes, bytes]]:
    data, offsets = text_buffer(pa.array([text]))
    starts, stops, _, ids = features(data, offsets, file)
    tags = token_tags(text, spans, starts, stops)
    marked = np.flatnonzero(tags == BEGIN)
    centres = dice.permutation(marked)[:number]
    if len(centres) < number and len(starts):
        centres = np.concatenate([centres, dice.integers(0, len(starts), number - len(centres))])
    out = []
    for centre in centres.tolist():
        low = max(0, min(centre - int(dice.integers(5, WINDOW - 5)), len(starts) - WINDOW))
        while low < len(tags) and tags[low] == INSIDE:
            low += 1
        size = min(WINDOW, len(starts) - low)
        one, mark = np.zeros((WINDOW, len(FIELDS)), np.int32), np.full(WINDOW, -1, np.int8)
        one[:size], mark[:size] = ids[:, low:low + size].T, tags[low:low + size]
        out.append((one.tobytes(), mark.tobytes()))
    return out


#: Surroundings say nothing about the whole text that they could stand in; ``fit`` draws one of the sample's.
UNKNOWN_FILE = -1


def training_windows(texts: list[str], copies: int) -> list[tuple[bytes, bytes]]:
    out = []
    for text in texts:
        dice = np.random.default_rng(int.from_bytes(hashlib.sha256(text.encode()).digest()[:8], "little"))
        spans = base_spans(text)
        out += _windows(text, spans, dice, None, WINDOWS)
        for other, marks in variants(text, spans, dice, copies):
            out += _windows(other, marks, dice, np.array([UNKNOWN_FILE]), 1)
    return out


def learned(windows: list[tuple[bytes, bytes]]) -> Model:
    ids = np.frombuffer(b"".join(w[0] for w in windows), np.int32).reshape(-1, WINDOW, len(FIELDS)).copy()
    tags = np.frombuffer(b"".join(w[1] for w in windows), np.int8).reshape(-1, WINDOW).astype(np.int64)
    if not (tags == BEGIN).any():
        return no_model()
    files = ids[:, 0, -1]
    drawn, unknown = files[files >= STARTS[-2]], np.flatnonzero(files < STARTS[-2])
    ids[unknown, :, -1] = np.random.default_rng(len(windows)).choice(drawn, len(unknown))[:, None]
    inside = tags >= 0
    return train(ids, np.where(inside, tags, 0), inside)


def fit(docs: DataFrame, text: str = "text") -> Model:
    """The field, from a bounded sample of whole texts; only their windows reach the driver."""
    rows = docs.select(F.col(f"`{text}`").cast("string").alias("t")).where("t <> ''").select("t", F.xxhash64("t").alias("h"))
    kinds = rows.select("h", with_base(F.col("t")).alias("positive")).groupBy("h").agg(F.max("positive").alias("positive"))
    # At most 2 * MAX_DOCS keys, so this broadcast is bounded.
    chosen = stored(kinds, "secret-kinds")
    keys = chosen.where("positive").orderBy("h").limit(MAX_DOCS).unionByName(chosen.where("not positive").orderBy("h").limit(MAX_DOCS))
    copies = min(MOST_VARIANTS, VARIANTS // max(1, min(MAX_DOCS, chosen.where("positive").count())))
    sample = rows.join(F.broadcast(keys.select("h")), "h").groupBy("h").agg(F.max("t").alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = training_windows(batch.column(0).to_pylist(), copies)
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*found)], ["ids", "tags"])

    windows = sample.select("t").mapInArrow(run, "ids binary, tags binary").toPandas().sort_values(["ids", "tags"])
    if not len(windows):
        return no_model()
    return learned(list(zip(windows.ids, windows.tags)))


# --- scanning ----------------------------------------------------------------

def tagged_spans(model: Model, data: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, int]]:
    """(text number, start, stop) of the spans that the field tags, in bytes of the buffer."""
    starts, stops, doc, ids = features(data, offsets)
    sizes = np.bincount(doc, minlength=len(offsets) - 1)
    tags = model.tags(ids, sizes)
    begins = np.flatnonzero(tags == BEGIN)
    if not len(begins):
        return []
    ends = np.flatnonzero((tags != OUTSIDE) & np.append((tags[1:] != INSIDE) | (doc[1:] != doc[:-1]), True))
    return list(zip(doc[begins].tolist(), starts[begins].tolist(), stops[ends].tolist()))


def scan_texts(model: Model, column: pa.Array) -> list[tuple[int, int, int, str, str, int]]:
    """(n_assign, n_access, n_hex, base, spans, n_crf) of each text; spans as kind:start:end in code points."""
    data, offsets = text_buffer(column)
    raw = data.tobytes()
    added: dict[int, list] = {}
    for number, start, stop in tagged_spans(model, data, offsets):
        added.setdefault(number, []).append((start, stop))
    out = []
    for number, (begin, end) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
        piece = raw[begin:end]
        base = base_spans(piece.decode()) if may_hold_base(piece) else []
        tagged = []
        for start, stop in added.get(number, ()):
            while stop > start + 1 and raw[stop - 1] == 0x2E:  # a full stop behind the last token
                stop -= 1
            low = len(raw[begin:start].decode())
            high = low + len(raw[start:stop].decode())
            if not any(s < high and low < e for s, _, e, _ in base):
                tagged.append((low, len(KINDS), high))
        every = sorted([s[:3] for s in base] + tagged)
        names = (*KINDS, "crf")
        kinds = [s[1] for s in base]
        out.append((*(kinds.count(k) for k in range(3)), ",".join(f"{names[k]}:{s}:{e}" for s, k, e, _ in base),
                    ",".join(f"{names[k]}:{s}:{e}" for s, k, e in every), len(tagged)))
    return out


ADDED = {"n_assign": "long", "n_access": "long", "n_hex": "long", "base": "string", "spans": "string", "n_crf": "long"}


def scan(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` without the text, with the counts and spans of every whole text."""
    kept = [c for c in docs.columns if c != text and c not in ADDED]
    rows = docs.select(*[F.col(f"`{c}`") for c in kept], F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(len(kept))
            begin, ends = 0, text_buffer(texts)[1]
            while begin < batch.num_rows:
                end = max(begin + 1, int(np.searchsorted(ends, ends[begin] + BATCH_BYTES, "right")) - 1)
                part = batch.slice(begin, end - begin)
                found = scan_texts(model, part.column(len(kept)))
                new = [pa.array(c, pa.int64() if t == "long" else pa.string()) for c, t in zip(zip(*found), ADDED.values())]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *new], [*kept, *ADDED])
                begin = end

    schema = rows.select(*[F.col(f"`{c}`") for c in kept], *[F.lit(None).cast(t).alias(n) for n, t in ADDED.items()]).schema
    return rows.mapInArrow(run, schema)


@query()
def op11_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Base and added spans of every whole text."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return scan(docs, fit(docs)).select("doc_id", "n_assign", "n_access", "n_hex", F.sha2("base", 256).alias("base_sha256"), "spans", "n_crf")
