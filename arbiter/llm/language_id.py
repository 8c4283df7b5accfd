"""Language identification by a byte convolutional network.

Text is lower-cased, encoded as UTF-8 and cut into windows of a fixed length
that overlap by the widest filter, so every n-gram of the whole text is seen.
Byte embeddings pass through filters of several widths, each is max-pooled
over the window, and a softmax layer gives the languages.  A document's
distribution is the mean over its windows, weighted by their letters.

The network is trained in numpy on the driver from at most about
``sample_rows`` windows, drawn by a hash of the id with one share per
language (so rare languages are seen); everything else covers all rows.
For prediction an embedding and a filter tap fold into one table per byte
(byte pair for neighbouring taps), so a window costs a few table look-ups per
byte and no multiplication.

Defined results: ``und`` with score 0 for a null text, one without a letter,
or when there is nothing to learn from (a letter is a code point of Unicode's
category L); a text shorter than a window is padded; repeated rows are
predicted one by one; a null ``doc_id`` has a null ``held_out`` and is not
learned from; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arbiter.llm.common import lean, prepare

LETTER = regex.compile(r"\p{L}")
PAD = 0
UNDETERMINED = "und"
# The filter takes a text of so many letters for none of the languages if no
# language has this score; a shorter one gives too little to judge by.
LEAST_SCORE, ENOUGH_LETTERS = 0.4, 20


def encode(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode(), np.uint8)


@dataclass
class ByteCnn:
    """Weights of the network; ``filters[w]`` has shape (w, dim, count)."""

    languages: list[str]
    embedding: np.ndarray
    filters: dict[int, np.ndarray]
    bias: np.ndarray
    dense: np.ndarray
    dense_bias: np.ndarray
    window: int

    @property
    def overlap(self) -> int:
        return max(self.filters) - 1

    def windows(self, raw: np.ndarray) -> np.ndarray:
        """(n, window + overlap) bytes: window i starts at i * window."""
        n = max(1, -(-max(1, len(raw) - self.overlap) // self.window))
        padded = np.full(n * self.window + self.overlap, PAD, np.uint8)
        padded[:len(raw)] = raw[:len(padded)]
        return np.lib.stride_tricks.sliding_window_view(padded, self.window + self.overlap)[::self.window]

    def probabilities(self, pooled: np.ndarray) -> np.ndarray:
        z = np.maximum(pooled + self.bias, 0) @ self.dense + self.dense_bias
        e = np.exp(z - z.max(1, keepdims=True))
        return e / e.sum(1, keepdims=True)


def train(texts: list[str], labels: list[str], window: int = 256, dim: int = 8, widths=(2, 3, 4), count: int = 16,
          steps: int = 750, batch: int = 64, rate: float = 4e-3, seed: int = 11) -> ByteCnn:
    """Adam on the cross-entropy; the gradient of a max-pool goes to the
    patch that was largest.  Windows are cut to a random length now and then,
    since short documents are mostly padding."""
    rng = np.random.default_rng(seed)
    languages = sorted(set(labels))
    y = np.array([languages.index(v) for v in labels])
    params = {"E": rng.normal(0, .5, (256, dim)), "b": np.zeros(len(widths) * count),
              "D": rng.normal(0, .1, (len(widths) * count, len(languages))), "c": np.zeros(len(languages))}
    for w in widths:
        params[f"W{w}"] = rng.normal(0, 1 / np.sqrt(w * dim), (w, dim, count))
    length = window + max(widths) - 1
    x = np.full((len(texts), length), PAD, np.uint8)
    for i, text in enumerate(texts):
        raw = encode(text)[:length]
        x[i, :len(raw)] = raw
    share = np.bincount(y, minlength=len(languages))
    weight = (len(y) / (len(languages) * share))[y]
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in params.items()}
    step = 0
    while step < steps:
        order = rng.permutation(len(y))
        for a in range(0, len(order), batch):
            pick = order[a:a + batch]
            xb = x[pick].copy()
            cut = np.where(rng.random(len(pick)) < .4, rng.integers(12, length, len(pick)), length)
            xb[np.arange(length)[None, :] >= cut[:, None]] = PAD
            emb = params["E"][xb]
            pooled, best = [], {}
            for w in widths:
                conv = sum(emb[:, k:k + window] @ params[f"W{w}"][k] for k in range(w))
                best[w] = conv.argmax(1)
                pooled.append(np.take_along_axis(conv, best[w][:, None], 1)[:, 0])
            act = np.maximum(np.concatenate(pooled, 1) + params["b"], 0)
            z = act @ params["D"] + params["c"]
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(pick)), y[pick]] -= 1
            dz = p * weight[pick][:, None] / len(pick)
            grad = {"D": act.T @ dz, "c": dz.sum(0), "E": np.zeros_like(params["E"])}
            da = dz @ params["D"].T * (act > 0)
            grad["b"] = da.sum(0)
            row = np.arange(len(pick))[:, None]
            for n, w in enumerate(widths):
                d = da[:, n * count:(n + 1) * count]
                grad[f"W{w}"] = np.zeros_like(params[f"W{w}"])
                for k in range(w):
                    seen = xb[row, best[w] + k]                        # batch x count
                    patch = params["E"][seen]                          # batch x count x dim
                    grad[f"W{w}"][k] = np.einsum("bcd,bc->dc", patch, d)
                    np.add.at(grad["E"], seen, d[:, :, None] * params[f"W{w}"][k].T[None])
            step += 1
            for name, g in grad.items():
                m, v = moments[name]
                m += .1 * (g - m)
                v += .001 * (g * g - v)
                params[name] -= rate * (m / (1 - .9 ** step)) / (np.sqrt(v / (1 - .999 ** step)) + 1e-8)
    return ByteCnn(languages, params["E"], {w: params[f"W{w}"] for w in widths}, params["b"], params["D"],
                   params["c"], window)


class Predictor:
    """Folded tables of a network: a pair table for every two taps."""

    def __init__(self, net: ByteCnn):
        self.net = net
        self.tables: list[tuple[int, list[tuple[int, bool, np.ndarray]]]] = []
        for w, filters in net.filters.items():
            taps = [(net.embedding @ f).astype(np.float32) for f in filters]
            parts = []
            for k in range(0, w - 1, 2):  # the first byte is the low one
                pair = (taps[k + 1][:, None, :] + taps[k][None, :, :]).reshape(65536, -1)
                parts.append((k, True, np.ascontiguousarray(pair)))
            if w % 2:
                parts.append((w - 1, False, taps[-1]))
            self.tables.append((w, parts))

    def pooled(self, x: np.ndarray) -> np.ndarray:
        """Max-pooled filter outputs of windows (n, window + overlap)."""
        n, size = len(x), self.net.window
        pairs = x[:, :-1].astype(np.uint16) | (x[:, 1:].astype(np.uint16) << 8)
        out = []
        for _, parts in self.tables:
            total = None
            for k, paired, values in parts:
                at = (pairs if paired else x)[:, k:k + size]
                got = values.take(at.ravel(), axis=0)
                total = got if total is None else np.add(total, got, out=total)
            out.append(total.reshape(n, size, -1).max(1))
        return np.concatenate(out, 1)

    def predict(self, texts: list[str | None], chunk: int = 64) -> list[tuple[str, float]]:
        """(language, score) of each text.  Windows of all texts go through
        the network together, ``chunk`` at a time."""
        total = np.zeros((len(texts), max(1, len(self.net.languages))))
        held: list[np.ndarray] = []
        of: list[int] = []

        def score(windows: np.ndarray, text: np.ndarray) -> None:
            letters = ((windows >= 0x61) & (windows <= 0x7A) | (windows >= 0x80)).sum(1)
            np.add.at(total, text, (letters + 1e-6)[:, None] * self.net.probabilities(self.pooled(windows)))

        known = [i for i, t in enumerate(texts) if t and self.net.languages and LETTER.search(t)]
        for i in known:
            windows = self.net.windows(encode(texts[i]))
            for a in range(0, len(windows), chunk):
                held.append(windows[a:a + chunk])
                of += [i] * len(held[-1])
                if len(of) >= chunk:
                    score(np.concatenate(held), np.array(of))
                    held, of = [], []
        if of:
            score(np.concatenate(held), np.array(of))
        found = [(UNDETERMINED, 0.0)] * len(texts)
        for i in known:
            share = total[i] / total[i].sum()
            best = int(share.argmax())
            found[i] = (self.net.languages[best], min(1.0, float(share[best])))
        return found


def held_out(doc_id: Column) -> Column:
    """The fold that is never learned from: crc32 of the id as text, mod 3, is 1."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1


def training_windows(docs: DataFrame, sample_rows: int = 8000, chars: int = 280) -> list[tuple]:
    """At most about ``sample_rows`` (doc_id, lang, window) of labelled rows
    outside the held-out fold, the same number for every language; a window
    starts at a hashed place of its text."""
    usable = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id"))).where(
        F.col("text").rlike(r"\p{L}"))
    sizes = {r["lang"]: r["n"] for r in usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return []
    each = sample_rows / len(sizes)
    draw = F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(1 << 30))
    limit = F.create_map(*[F.lit(v) for lang, n in sizes.items() for v in (lang, int(min(1.0, each / n) * (1 << 30)))])
    place = F.pmod(F.xxhash64("doc_id", F.lit(9)), F.greatest(F.length("text") - chars + 1, F.lit(1))).cast("int") + 1
    rows = usable.where(draw < limit[F.col("lang")]).select(
        "doc_id", "lang", F.substring("text", place, F.lit(chars)).alias("window"))
    return sorted(map(tuple, rows.collect()))


def identify(docs: DataFrame, sample_rows: int = 8000) -> DataFrame:
    """doc_id, held_out, lang_pred, score.  Learns from ``lang`` outside the
    held-out fold; predictions read the text alone."""
    prepare(docs.sparkSession)
    rows = training_windows(docs, sample_rows)
    net = train([r[2] for r in rows], [r[1] for r in rows]) if rows else None
    return predict(docs, net)


def keep_identified(docs: DataFrame, sample_rows: int = 8000, least_score: float = LEAST_SCORE) -> DataFrame:
    """The rows of ``docs`` whose text has a language, all columns as they are:
    it has a letter, and a score of at least ``least_score`` unless it is
    shorter than ``ENOUGH_LETTERS``.  Without a labelled row to learn from
    these are the texts with a letter."""
    prepare(docs.sparkSession)
    rows = training_windows(docs, sample_rows)
    model = docs.sparkSession.sparkContext.broadcast(train([r[2] for r in rows], [r[1] for r in rows]) if rows else None)

    @F.pandas_udf("boolean")
    def identified(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        predictor = Predictor(model.value) if model.value else None
        for texts in parts:
            if predictor:
                yield pd.Series([lang != UNDETERMINED and (score >= least_score or len(LETTER.findall(t)) < ENOUGH_LETTERS)
                                 for t, (lang, score) in zip(texts, predictor.predict(texts.tolist()))], dtype=bool)
            else:
                yield pd.Series([bool(t and LETTER.search(t)) for t in texts], dtype=bool)

    return docs.where(identified("text"))


def predict(docs: DataFrame, net: ByteCnn | None) -> DataFrame:
    model = docs.sparkSession.sparkContext.broadcast(net)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predictor = Predictor(model.value) if model.value else None
        for batch in batches:
            texts = batch.column(2).to_pylist()
            found = predictor.predict(texts) if predictor else [(UNDETERMINED, 0.0)] * len(texts)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([f[0] for f in found], pa.string()),
                 pa.array([f[1] for f in found], pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"),
                       "text").mapInArrow(lean(apply), "doc_id long, held_out boolean, lang_pred string, score double")
