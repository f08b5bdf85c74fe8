"""Quality classifier: random Fourier features, ridge, isotonic calibration.

A text becomes ``STATS`` statistics of its characters, words and lines.
Standardised, they are projected to ``WIDTH`` random cosines, whose inner products
approximate a Gaussian kernel, so ridge regression on them is a kernel machine of
fixed size.  Means, normal equations and the calibration table are sums that
tasks add up over a bounded sample of labelled training texts (``FIT_TEXTS`` with
the least hash).  The raw score is calibrated by isotonic regression (pool
adjacent violators over ``BINS`` bins of raw scores), interpolated between the
pooled blocks, so it keeps the order of raw scores.

Scoring is a pass over the texts without a shuffle; the model sent to the tasks
has a fixed size.  Labels, language, source and id never enter a score.

Defined results: null and empty texts have zero statistics and score as such;
without labels of both kinds every text scores the smoothed rate; labels that
are null or neither 0 nor 1 are left out, an id labelled twice takes the greater;
repeated rows are scored each; other columns are ignored; an empty table gives
an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .labelled import held_out, sample
from .tables import bounded_batches, stored, tidied
from .words import Words, chunks, combine, text_bytes

FIT_TEXTS = 20_000
WIDTH = 256
BINS = 1_000
RIDGE = 1e-3  # a text
THRESHOLD = 0.7

STATS = ["log_words", "word_size", "word_size_sd", "symbols", "pipes", "shouts", "upper", "digits",
         "marks", "wide", "distinct", "commonest", "doubled", "trigrams", "log_line", "dup_lines"]


def _class(chars) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[[ord(c) for c in chars]] = True
    return table


_UPPER = _class("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_LETTER = _UPPER | _class("abcdefghijklmnopqrstuvwxyz")
_DIGIT = _class("0123456789")
_SYMBOL = _class("#*$%&<>")
_PIPE = _class("|")
_SHOUT = _class("!?")
_MARK = _class(".,;:'\"()-")
_WIDE = np.arange(256) >= 0xC0  # first byte of a longer character


def statistics(texts: list[bytes]) -> np.ndarray:
    """One row of STATS for each text."""
    w = Words(texts)
    buf = np.frombuffer(w.raw, dtype=np.uint8)
    n = np.diff(w.first)
    per_word = np.maximum(n, 1)

    def share(table: np.ndarray, of: np.ndarray) -> np.ndarray:
        run = np.concatenate(([0], np.cumsum(table[buf])))
        return (run[w.text_at[1:]] - run[w.text_at[:-1]]) / of

    def total(values: np.ndarray) -> np.ndarray:
        run = np.concatenate(([0], np.cumsum(values)))
        return run[w.first[1:]] - run[w.first[:-1]]

    one = np.ones(len(texts))
    letters = np.maximum(share(_LETTER | _WIDE, one), 1)
    size = (w.end - w.start).astype(float)
    mean = total(size) / per_word
    sd = np.sqrt(np.maximum(total(size ** 2) / per_word - mean ** 2, 0))
    doc, h = w.doc_of(), w.hashes()
    order = np.lexsort((h, doc))
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[order][1:] != h[order][:-1]) | (doc[order][1:] != doc[order][:-1])
    starts = np.flatnonzero(new)
    run = np.diff(np.append(starts, len(h)))
    commonest = np.zeros(len(texts))
    np.maximum.at(commonest, doc[order][starts], run)
    same = np.zeros(len(h))
    same[1:] = (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])
    grams = combine(h, 3)
    inside = doc[:len(grams)] == doc[2:] if len(grams) else np.zeros(0, bool)
    g, d = grams[inside], doc[:len(grams)][inside]
    o = np.lexsort((g, d))
    fresh = np.ones(len(g), dtype=bool)
    fresh[1:] = (g[o][1:] != g[o][:-1]) | (d[o][1:] != d[o][:-1])
    trigrams = np.bincount(d[o][fresh], minlength=len(texts))
    lines = [[x for x in t.split(b"\n") if x.strip()] for t in texts]
    count = np.maximum([len(x) for x in lines], 1)
    return np.column_stack([
        np.log1p(n), np.minimum(mean, 30), np.minimum(sd, 30),
        np.minimum(share(_SYMBOL, per_word), 5), np.minimum(share(_PIPE, per_word), 2),
        np.minimum(share(_SHOUT, per_word), 5), share(_UPPER, letters),
        np.minimum(share(_DIGIT, per_word), 10), np.minimum(share(_MARK, per_word), 5),
        np.minimum(share(_WIDE, letters), 1), np.bincount(doc[order][starts], minlength=len(texts)) / per_word,
        commonest / per_word, total(same) / per_word, trigrams / np.maximum(n - 2, 1),
        np.log1p(n / count), 1 - np.array([len(set(x)) for x in lines]) / count * (n > 0) - (n == 0)])


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, held_out and stats (array, as STATS) of every document."""
    slim = docs.select("doc_id", held_out().alias("held_out"), F.col(text).cast("string").alias("t"))
    kind = slim.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            texts = text_bytes(batch.column(2))
            for lo, hi in chunks(texts):
                got = statistics(texts[lo:hi])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo),
                     pa.array(got.tolist(), pa.list_(pa.float64()))], ["doc_id", "held_out", "stats"])

    return slim.mapInArrow(tidied(run), f"doc_id {kind}, held_out boolean, stats array<double>")


def _summed(rows: DataFrame, size: int, add) -> np.ndarray:
    """Sum over tasks of the vector that ``add`` (stats, label) returns."""
    def run(batches):
        total = np.zeros(size)
        for batch in batches:
            if batch.num_rows:
                total += add(_matrix(batch.column(0)), batch.column(1).to_numpy().astype(float))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size)), pa.array(total)], ["i", "v"])

    parts = rows.select("stats", F.col("label").cast("double")).mapInArrow(tidied(run), "i long, v double")
    got = parts.groupBy("i").agg(F.sum("v").alias("v")).toArrow()
    out = np.zeros(size)
    out[got["i"].to_numpy()] = got["v"].to_numpy()
    return out


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten(), dtype=float).reshape(-1, len(STATS))


class Machine:
    """Standardisation, cosines and weights; ``raw`` scores rows of STATS."""

    def __init__(self, mean: np.ndarray, sd: np.ndarray, seed: int = 3):
        rng = np.random.default_rng(seed)
        self.mean, self.sd = mean, sd
        self.turn = rng.standard_normal((len(STATS), WIDTH)) / np.sqrt(len(STATS))
        self.phase = rng.uniform(0, 2 * np.pi, WIDTH)
        self.beta = np.zeros(WIDTH + 1)

    def features(self, stats: np.ndarray) -> np.ndarray:
        x = np.clip((stats - self.mean) / self.sd, -8, 8)
        z = np.sqrt(2 / WIDTH) * np.cos(x @ self.turn + self.phase)
        return np.column_stack([z, np.ones(len(z))])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.beta


def pooled(at: np.ndarray, weight: np.ndarray, good: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Isotonic regression by pooling adjacent violators: (place, value) of the
    blocks; values never fall."""
    blocks: list[list[float]] = []
    for x, n, y in zip(at, weight, good):
        blocks.append([x * n, n, y])
        while len(blocks) > 1 and blocks[-2][2] * blocks[-1][1] >= blocks[-1][2] * blocks[-2][1]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    return np.array([b[0] / b[1] for b in blocks]), np.array([b[2] / b[1] for b in blocks])


def fitted(training: DataFrame) -> tuple[Machine, np.ndarray, np.ndarray]:
    """The machine and its calibration, from rows with stats and label."""
    k = len(STATS)
    sums = _summed(training, 2 * k + 2, lambda s, y: np.concatenate(
        [s.sum(axis=0), (s ** 2).sum(axis=0), [len(s), y.sum()]]))
    n, good = sums[-2], sums[-1]
    mean = sums[:k] / max(n, 1)
    sd = np.sqrt(np.maximum(sums[k:2 * k] / max(n, 1) - mean ** 2, 0))
    machine = Machine(mean, np.where(sd > 1e-9, sd, 1.0))
    if not 0 < good < n:
        return machine, np.zeros(1), np.array([(good + 0.5) / (n + 1)])
    size = WIDTH + 1

    def normal(stats, y):
        z = machine.features(stats)
        return np.concatenate([(z.T @ z).ravel(), z.T @ y])

    eq = _summed(training, size * size + size, normal)
    gram, side = eq[:size * size].reshape(size, size), eq[size * size:]
    machine.beta = np.linalg.solve(gram + RIDGE * n * np.eye(size) / size, side)

    def table(stats, y):
        bins = np.clip(((machine.raw(stats) + 0.5) / 2 * BINS).astype(int), 0, BINS - 1)
        return np.concatenate([np.bincount(bins, minlength=BINS), np.bincount(bins, weights=y, minlength=BINS)])

    counts = _summed(training, 2 * BINS, table)
    used = np.flatnonzero(counts[:BINS])
    at = (used + 0.5) / BINS * 2 - 0.5
    place, value = pooled(at, counts[used], counts[BINS + used])
    return machine, place, np.clip(value, 0.5 / n, 1 - 0.5 / n)


def scores(docs: DataFrame, labels: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    # 2 * FIT_TEXTS rows at most, so the broadcast is bounded.
    chosen = F.broadcast(sample(labels, "quality", FIT_TEXTS))
    rows = stored(measured(bounded_batches(docs), text), "quality-stats")
    training = stored(rows.join(chosen, "doc_id").select("stats", "label"), "quality-fit")
    machine, place, value = fitted(training)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            raw = machine.raw(_matrix(batch.column(2))) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(np.interp(raw, place, value))],
                ["doc_id", "held_out", "score"])

    out = rows.select("doc_id", "held_out", "stats").mapInArrow(
        tidied(run), f"doc_id {kind}, held_out boolean, score double")
    return out.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
