"""Language identification: a bidirectional gated recurrent network over bytes.

Two GRUs read the UTF-8 bytes from the left and from the right; a softmax over both
states labels every position, and the mean over a text's positions gives its
probabilities. The network is trained in numpy by backpropagation through time on
windows of at most ``DOCS_PER_LANGUAGE`` documents of each language (those with the
smallest hash of key and text, ``WINDOWS_PER_DOC`` windows spread over the whole text).

Texts of any length are labelled whole, in windows of ``CORE`` positions; each
direction starts ``CONTEXT`` positions outside the window, so that its state is warm.
The gates use a piecewise linear sigmoid.

Null texts and texts without a letter are ``und`` with score 0. Null languages are not
learned from. Without any training row every text with a letter is ``und``, too. Repeated rows of
a key and text are learned from once and labelled each. Ties: the first language by name. An
empty table gives no rows. Columns lang_pred, score and lang_spans of the input are replaced,
other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratamart.llm.common import crc_mod, table, text_buffer
from stratamart.llm.registry import query

DOCS_PER_LANGUAGE = 600
WINDOWS_PER_DOC = 4
HIDDEN = 8
TRAIN_LENGTH = 64
BATCH = 128
STEPS = 350
CORE = 112
CONTEXT = 12
#: Windows that go through the network together.
TOGETHER = 2048
#: Symbol for positions outside a text.
OUTSIDE = 256


class Gru:
    """One direction. The input projection of a byte is a row of a table, biases included."""

    def __init__(self, dice: np.random.Generator):
        self.x = (dice.standard_normal((257, 3 * HIDDEN)) * 0.3).astype(np.float32)
        self.u = (dice.standard_normal((HIDDEN, 3 * HIDDEN)) / np.sqrt(HIDDEN)).astype(np.float32)

    def step(self, symbols: np.ndarray, h: np.ndarray):
        a, g = self.x[symbols], h @ self.u
        gates = a[:, :2 * HIDDEN] + g[:, :2 * HIDDEN]
        gates *= 0.25
        gates += 0.5
        np.clip(gates, 0, 1, out=gates)
        z, r = gates[:, :HIDDEN], gates[:, HIDDEN:]
        c = r * g[:, 2 * HIDDEN:]
        c += a[:, 2 * HIDDEN:]
        np.tanh(c, out=c)
        new = h - c
        new *= z
        new += c
        return new, (z, r, c, g[:, 2 * HIDDEN:])

    def states(self, symbols: np.ndarray, out: np.ndarray, skip: int) -> None:
        """Run over (time, window) symbols; states after the first ``skip`` steps go to ``out``."""
        h = np.zeros((symbols.shape[1], HIDDEN), np.float32)
        for t in range(len(symbols)):
            h = self.step(symbols[t], h)[0]
            if t >= skip:
                out[t - skip] = h

    def forward(self, symbols: np.ndarray):
        h = np.zeros((symbols.shape[1], HIDDEN), np.float32)
        states, kept = [h], []
        for row in symbols:
            h, parts = self.step(row, h)
            states.append(h)
            kept.append(parts)
        return states, kept

    def backward(self, symbols: np.ndarray, states, kept, d_out: np.ndarray):
        """Gradients of the table and the recurrent matrix, by backpropagation through time."""
        gx, gu = np.zeros_like(self.x), np.zeros_like(self.u)
        dh = np.zeros_like(states[0])
        for t in range(len(symbols) - 1, -1, -1):
            dh = dh + d_out[t]
            h, (z, r, c, gc) = states[t], kept[t]
            dc = dh * (1 - z) * (1 - c * c)
            dz = dh * (h - c) * 0.25 * ((z > 0) & (z < 1))
            dr = dc * gc * 0.25 * ((r > 0) & (r < 1))
            da = np.concatenate([dz, dr, dc], 1)
            dg = np.concatenate([dz, dr, dc * r], 1)
            gu += h.T @ dg
            # Rows of the table that occur several times in a step add up.
            order = np.argsort(symbols[t], kind="stable")
            rows = symbols[t][order]
            cuts = np.flatnonzero(np.append(True, rows[1:] != rows[:-1]))
            gx[rows[cuts]] += np.add.reduceat(da[order], cuts, axis=0)
            dh = dh * z + dg @ self.u.T
        return gx, gu


class Network:
    def __init__(self, languages: list[str], seed: int = 7):
        dice = np.random.default_rng(seed)
        self.languages = languages
        self.left, self.right = Gru(dice), Gru(dice)
        self.out = (dice.standard_normal((2 * HIDDEN, max(1, len(languages)))) * 0.3).astype(np.float32)
        self.bias = np.zeros(max(1, len(languages)), np.float32)

    def parameters(self) -> list[np.ndarray]:
        return [self.left.x, self.left.u, self.right.x, self.right.u, self.out, self.bias]

    def gradients(self, symbols: np.ndarray, target: np.ndarray):
        """Mean loss over all positions inside texts, and the gradient of each parameter.

        ``symbols`` is (time, window); ``target`` the language of each window.
        """
        ls, lk = self.left.forward(symbols)
        rs, rk = self.right.forward(symbols[::-1])
        both = np.concatenate([np.stack(ls[1:]), np.stack(rs[1:])[::-1]], 2)
        logits = both @ self.out + self.bias
        logits -= logits.max(2, keepdims=True)
        p = np.exp(logits)
        p /= p.sum(2, keepdims=True)
        inside = (symbols != OUTSIDE).astype(np.float32)
        total = max(1.0, float(inside.sum()))
        hit = np.take_along_axis(p, np.broadcast_to(target[None, :, None], (*symbols.shape, 1)), 2)[:, :, 0]
        loss = float(-(np.log(hit + 1e-9) * inside).sum() / total)
        d = p
        d[:, np.arange(symbols.shape[1]), target] -= 1
        d *= (inside / total)[:, :, None]
        g_out = np.tensordot(both, d, ((0, 1), (0, 1)))
        d_both = d @ self.out.T
        glx, glu = self.left.backward(symbols, ls, lk, d_both[:, :, :HIDDEN])
        grx, gru = self.right.backward(symbols[::-1], rs, rk, d_both[::-1, :, HIDDEN:])
        return loss, [glx, glu, grx, gru, g_out, d.sum((0, 1))]

    def train(self, windows: np.ndarray, target: np.ndarray, steps: int = STEPS, seed: int = 11) -> list[float]:
        """Adam over batches that hold every language equally often; returns the losses."""
        dice = np.random.default_rng(seed)
        by_language = [np.flatnonzero(target == k) for k in range(len(self.languages))]
        m = [np.zeros_like(p) for p in self.parameters()]
        v = [np.zeros_like(p) for p in self.parameters()]
        losses = []
        for step in range(1, steps + 1):
            picks = np.concatenate([dice.choice(rows, -(-BATCH // len(by_language))) for rows in by_language])
            loss, grads = self.gradients(np.ascontiguousarray(windows[picks].T), target[picks])
            losses.append(loss)
            rate = 0.03 * min(1, step / 20) * (1 if step < 0.6 * steps else 0.3)
            scale = min(1.0, 1.0 / (1e-9 + np.sqrt(sum(float((g**2).sum()) for g in grads))))
            for p, g, a, b in zip(self.parameters(), grads, m, v):
                g = g * scale
                a += 0.1 * (g - a)
                b += 0.01 * (g * g - b)
                p -= rate * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.99**step)) + 1e-6)
        return losses

    def positions(self, data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(text number of each window, lengths, probabilities (time, window, language)), window by window of whole texts."""
        sizes = np.diff(offsets)
        counts = -(-sizes // CORE)
        of = np.repeat(np.arange(len(sizes)), counts)
        nth = np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts)
        begin, end = offsets[of] + nth * CORE, np.minimum(offsets[of] + (nth + 1) * CORE, offsets[of + 1])
        padded = np.append(data, np.uint8(0)).astype(np.int16)
        steps = np.arange(-CONTEXT, CORE + CONTEXT)[:, None]
        for at in range(0, len(of), TOGETHER):
            part = slice(at, at + TOGETHER)
            place = begin[part] + steps
            inside = (place >= offsets[of[part]]) & (place < offsets[of[part] + 1])
            symbols = np.where(inside, padded[np.where(inside, place, -1)], np.int16(OUTSIDE))
            n = symbols.shape[1]
            both = np.empty((2, CORE, n, HIDDEN), np.float32)
            self.left.states(symbols[:CONTEXT + CORE], both[0], CONTEXT)
            self.right.states(symbols[:CONTEXT - 1:-1], both[1], CONTEXT)
            p = both[0].reshape(-1, HIDDEN) @ self.out[:HIDDEN]
            p += both[1, ::-1].reshape(-1, HIDDEN) @ self.out[HIDDEN:]
            p += self.bias
            np.clip(p, -30, 30, out=p)
            np.exp(p, out=p)
            p /= p.sum(1, keepdims=True)
            yield of[part], (end - begin)[part], p.reshape(CORE, n, -1)

    def pooled(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Mean probability of each language over all positions of each text."""
        n, k = len(offsets) - 1, len(self.bias)
        total = np.zeros((n, k))
        steps = np.arange(CORE)[:, None]
        for of, sizes, p in self.positions(data, offsets):
            p *= (steps < sizes)[:, :, None]
            sums = p.sum(0, dtype=np.float64)
            for j in range(k):
                total[:, j] += np.bincount(of, weights=sums[:, j], minlength=n)
        return total / np.maximum(np.diff(offsets), 1)[:, None]

    def spans(self, data: np.ndarray, offsets: np.ndarray) -> list[list[tuple[int, int, str]]]:
        """Runs of equally labelled bytes of each text: (begin, end, language)."""
        labels = [[] for _ in range(len(offsets) - 1)]
        for of, sizes, p in self.positions(data, offsets):
            best = p.argmax(2)
            for j, (doc, size) in enumerate(zip(of.tolist(), sizes.tolist())):
                labels[doc].append(best[:size, j])
        out = []
        for parts in labels:
            row = np.concatenate([*parts, np.zeros(0, np.int64)])
            cuts = [0, *(np.flatnonzero(row[1:] != row[:-1]) + 1).tolist(), len(row)]
            out.append([(a, b, self.languages[row[a]]) for a, b in zip(cuts, cuts[1:]) if b > a])
        return out


def sample_windows(docs: DataFrame, key: str, text: str, lang: str, learn: Column | None):
    """Training windows (one row of symbols each) and their languages; bounded, see the module's text."""
    # Texts are ranked, not keys: rows of one key and text are one text, and other texts of that key are their own.
    known = (docs if learn is None else docs.where(learn)).select(
        F.col(f"`{lang}`").cast("string").alias("y"), F.col(f"`{text}`").cast("string").alias("t"), F.col(f"`{key}`").alias("k"))
    known = known.where("k is not null and y is not null").select("y", "t", F.xxhash64("k", "t").alias("h"))
    rows = known.select("y", "h").distinct()
    # The texts of a frequent language are thinned by hash first, so that no task ranks many of them.
    counts = {r["y"]: r["count"] for r in rows.groupBy("y").count().collect()}
    shares = F.create_map(*[F.lit(x) for y, n in counts.items() for x in (y, min(1.0, 4 * DOCS_PER_LANGUAGE / n))]) if counts else F.create_map(F.lit(""), F.lit(0.0))
    thinned = rows.where(F.pmod(F.xxhash64("h"), F.lit(1 << 20)) < F.try_element_at(shares, F.col("y")) * (1 << 20))
    rank = F.row_number().over(Window.partitionBy("y").orderBy("h"))
    # At most DOCS_PER_LANGUAGE texts of each language: the broadcast grows with the languages, not with the documents.
    keys = thinned.withColumn("n", rank).where(F.col("n") <= DOCS_PER_LANGUAGE).select("y", "h")
    chosen = known.join(F.broadcast(keys), ["y", "h"]).groupBy("y", "h").agg(F.max("t").alias("t"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, windows = [], []
            data, offsets = text_buffer(batch.column(1))
            for y, a, b in zip(batch.column(0).to_pylist(), offsets[:-1].tolist(), offsets[1:].tolist()):
                for w in range(WINDOWS_PER_DOC):
                    # From before the first byte to behind the last one.
                    at = a - TRAIN_LENGTH // 4 + (b - a + TRAIN_LENGTH // 2 - TRAIN_LENGTH) * w // max(1, WINDOWS_PER_DOC - 1)
                    place = np.arange(at, at + TRAIN_LENGTH)
                    inside = (place >= a) & (place < b)
                    if inside.any():
                        langs.append(y)
                        windows.append(np.where(inside, data[np.clip(place, 0, len(data) - 1)].astype(np.uint16), np.uint16(OUTSIDE)).astype("<u2").tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(windows, pa.binary())], ["y", "w"])

    got = chosen.select("y", "t").mapInArrow(cut, "y string, w binary").orderBy("y", "w").toPandas()
    languages = sorted(got.y.unique())
    if not languages:
        return np.zeros((0, TRAIN_LENGTH), np.int64), np.zeros(0, np.int64), []
    windows = np.frombuffer(b"".join(got.w), "<u2").reshape(-1, TRAIN_LENGTH).astype(np.int64)
    return windows, got.y.map({y: i for i, y in enumerate(languages)}).to_numpy(), languages


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", learn: Column | None = None) -> Network:
    windows, target, languages = sample_windows(docs, key, text, lang, learn)
    network = Network(languages)
    if languages:
        network.train(windows, target)
    return network


def with_language(docs: DataFrame, network: Network, text: str = "text", spans: bool = False) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and, if asked for, ``lang_spans`` (byte runs of equal labels)."""
    names = [c for c in docs.columns if c not in ("lang_pred", "score", "lang_spans")]
    at = names.index(text)
    kind = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32()), ("lang", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = network
        for whole in batches:
            for start in range(0, whole.num_rows, 1000):
                batch = whole.slice(start, 1000)
                column = batch.column(at)
                data, offsets = text_buffer(column)
                p = model.pooled(data, offsets)
                best = p.argmax(1)
                some = np.array([bool(model.languages) and t is not None and any(map(str.isalpha, t)) for t in column.to_pylist()], bool)
                langs = [model.languages[b] if s else "und" for b, s in zip(best.tolist(), some.tolist())]
                scores = np.where(some, np.clip(p[np.arange(len(p)), best], 0, 1), 0.0)
                more = [pa.array(model.spans(data, offsets) if model.languages else [[]] * len(langs), kind)] if spans else []
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(langs, pa.string()), pa.array(scores), *more],
                    [*names, "lang_pred", "score", *["lang_spans"] * spans])

    kept = docs.select(*[F.col(f"`{c}`") for c in names])
    typed = kept.withColumn("lang_pred", F.lit("")).withColumn("score", F.lit(0.0))
    if spans:
        typed = typed.withColumn("lang_spans", F.lit(None).cast("array<struct<begin:int,end:int,lang:string>>"))
    return kept.mapInArrow(run, typed.schema)


@query()
def op3_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """The predicted language of every document; rows of remainder 0 are never learned from."""
    docs = table(spark, folder, "documents")
    network = fit(docs, learn=crc_mod(F.col("doc_id"), 5) != 0)
    tagged = with_language(docs.select("doc_id", "text"), network)
    return tagged.select("doc_id", (crc_mod(F.col("doc_id"), 5) == 0).alias("held_out"), "lang_pred", "score")
