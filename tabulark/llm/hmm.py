"""A hidden Markov language model, trained by Baum-Welch over Spark partitions.

The ``OWN`` most frequent training words and the end of a text are symbols of
their own; every other word belongs to one of ``CLASSES`` classes by its last
bytes.  A state emits a symbol, and a class emits its word with probability
(c + 0.5) / (tokens of the class + 0.5 * (its words + 1)), so unseen words have a
place and all probabilities sum to one.

Word counts are summed in the tasks and then shuffled.  The ``KNOWN`` most
frequent words with their counts go to the tasks (4 MB at most); occurrences of
rarer words are joined with the counts.  Texts are coded once, two bytes a
token, and stored.  In a Baum-Welch round a task adds up expected transitions and
emissions of its texts, Spark sums them per symbol, and only the model itself
(states x symbols) reaches the driver.  The first ``SWEEPS`` passes are cut into
``FOLDS`` folds of the training texts: after each fold the model is fitted again to
its counts and the fading counts of the folds before.  ``ROUNDS`` rounds over all
training texts follow.  Every pass reads every training text, at every size.
Texts are trained in stretches of ``STRETCH`` tokens; a stretch begins with the last
token of the one before, so each transition is counted once.

A text's score is the exact likelihood of its whole token sequence: the forward
recursion, scaled at every token, over all texts of a batch side by side.

Defined results: null text is empty and has the end token alone; a null id is
trained on (fold 0); repeated rows are scored, and trained on, each; without
training texts all counts are 0 and the model stays flat; other columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import bounded_batches, fold, stored, tidied
from .words import Words, chunks, hash_ranges, text_bytes

STATES = 8
OWN = 16_384
CLASSES = 256
KNOWN = 1 << 18
STRETCH = 64
SWEEPS, FOLDS = 2, 8
FADING = 0.5  # what the counts of the folds before weigh, a fold
ROUNDS = 2
PRIOR = 10.0  # tokens of the overall distribution added to each state's emissions

SYMBOLS = OWN + CLASSES + 2  # own words, classes, the end, and padding
END, PAD = OWN + CLASSES, OWN + CLASSES + 1


def word_classes(w: Words) -> np.ndarray:
    """Class of each word: its last two bytes, hashed."""
    tail = np.maximum(w.start, w.end - 2)
    return (hash_ranges(w.raw, tail, w.end) % np.uint64(CLASSES)).astype(np.int64)


def count_words(texts: DataFrame) -> DataFrame:
    """(word, class, c) over the column t; word is a 64-bit hash."""
    def run(batches):
        for batch in batches:
            texts_ = text_bytes(batch.column(0))
            words, classes, counts = [], [], []
            for lo, hi in chunks(texts_):
                w = Words(texts_[lo:hi], lower=True)
                word, first, n = np.unique(w.hashes().view(np.int64), return_index=True, return_counts=True)
                words.append(word)
                classes.append(word_classes(w)[first])
                counts.append(n)
            if words:
                word, at = np.unique(np.concatenate(words), return_inverse=True)
                n = np.bincount(at, weights=np.concatenate(counts), minlength=len(word)).astype(np.int64)
                kind = np.zeros(len(word), dtype=np.int64)
                kind[at] = np.concatenate(classes)
                yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(kind), pa.array(n)],
                                                 ["word", "class", "c"])

    rows = texts.select("t").mapInArrow(tidied(run), "word long, class long, c long")
    return rows.groupBy("word").agg(F.min("class").alias("class"), F.sum("c").alias("c"))


class Lexicon:
    """What tasks know of the vocabulary; sizes are bounded by OWN, KNOWN, CLASSES."""

    def __init__(self, counts: DataFrame, texts: int):
        total = counts.agg(F.count(F.lit(1)).alias("v"), F.coalesce(F.sum("c"), F.lit(0)).alias("n")).collect()[0]
        self.texts = texts
        self.tokens = total["n"] + texts
        self.distinct = total["v"] + (texts > 0)
        # Steps of the counts, so that the KNOWN most frequent words, or a little
        # fewer, are a filter and no task sorts them all.
        steps = counts.withColumn("step", F.floor(16 * F.log2("c")).cast("int"))
        least, held = 16 * 64, 0
        for r in sorted(steps.groupBy("step").agg(F.count(F.lit(1)).alias("n")).collect(),
                        key=lambda r: -r["step"]):
            if held + r["n"] > KNOWN:
                break
            least, held = r["step"], held + r["n"]
        top = steps.filter(F.col("step") >= least).select("word", "class", "c").toArrow()
        top = top.sort_by([("c", "descending"), ("word", "ascending")])
        word, c = top["word"].to_numpy(), top["c"].to_numpy()
        symbol = np.where(np.arange(len(word)) < OWN, np.arange(len(word)), OWN + top["class"].to_numpy())
        own = word[:OWN]
        by_class = {r["class"]: (r["n"], r["v"]) for r in counts.groupBy("class").agg(
            F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).collect()}
        n = np.array([by_class.get(k, (0, 0))[0] for k in range(CLASSES)], dtype=float)
        v = np.array([by_class.get(k, (0, 0))[1] for k in range(CLASSES)], dtype=float)
        kinds = top["class"].to_numpy()[:OWN]
        n -= np.bincount(kinds, weights=c[:OWN], minlength=CLASSES)[:CLASSES]
        v -= np.bincount(kinds, minlength=CLASSES)[:CLASSES]
        self.class_tokens, self.class_total = n, n + 0.5 * (v + 1)
        self.total = self.tokens + 0.5 * (self.distinct + 1)
        order = np.argsort(word)
        self.word, self.c, self.symbol = word[order], c[order], symbol[order].astype(np.uint16)
        # Overall distribution of the symbols.
        share = np.full(SYMBOLS, 0.0)
        share[:len(own)] = c[:OWN]
        share[OWN:OWN + CLASSES] = n + 0.5
        share[END] = texts + 0.5
        self.share = share / share.sum()

    def code(self, w: Words) -> dict[str, np.ndarray]:
        """Of each word: symbol, count (where known), whether it is known."""
        h = w.hashes().view(np.int64)
        kind = word_classes(w)
        symbol = (OWN + kind).astype(np.uint16)
        c = np.zeros(len(h))
        known = np.zeros(len(h), dtype=bool)
        if len(self.word):
            at = np.searchsorted(self.word, h)
            at[at == len(self.word)] = 0
            known = self.word[at] == h
            symbol = np.where(known, self.symbol[at], symbol)
            c = np.where(known, self.c[at], 0)
        return {"word": h, "symbol": symbol, "c": c, "known": known, "class": kind}


def coded(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """Every document coded once: key, doc_id, held_out, n_tokens, symbols
    (uint16 values), rare (words whose count the tasks do not hold), and the
    sums of log10 over the words whose count they hold."""
    doc_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            texts = text_bytes(batch.column(2))
            for lo, hi in chunks(texts):
                w = Words(texts[lo:hi], lower=True)
                got = lexicon.code(w)
                known = got["known"]
                log_c = np.where(known, np.log10(got["c"] + 0.5), 0.0)
                base = log_c - math.log10(lexicon.total)
                in_class = got["symbol"] >= OWN
                inner = np.where(in_class, log_c - np.log10(lexicon.class_total[got["class"]]), 0.0)
                sums = {"base": base, "inner": inner, "n_known": known}
                first = w.first
                run_sums = {k: np.concatenate(([0], np.cumsum(x))) for k, x in sums.items()}
                rows = {k: x[first[1:]] - x[first[:-1]] for k, x in run_sums.items()}
                end = np.uint16(END).tobytes()
                raw = got["symbol"].astype("<u2").tobytes()
                symbols = [raw[2 * a:2 * b] + end for a, b in zip(first[:-1], first[1:])]
                rare = ~known
                rare_first = np.concatenate(([0], np.cumsum(rare)))[first]
                end_log = math.log10((lexicon.texts + 0.5) / lexicon.total)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo),
                     pa.array(w.counts() + 1), pa.array(symbols, pa.binary()),
                     pa.ListArray.from_arrays(pa.array(rare_first, pa.int32()), pa.array(got["word"][rare])),
                     pa.array(rows["base"] + end_log), pa.array(rows["inner"].astype(float)),
                     pa.array(rows["n_known"].astype(np.int64) + (lexicon.texts > 0))],
                    ["doc_id", "held_out", "n_tokens", "symbols", "rare", "base", "inner", "n_known"])

    out = docs.mapInArrow(tidied(run), f"doc_id {doc_type}, held_out boolean, n_tokens long, symbols binary, "
                               "rare array<long>, base double, inner double, n_known long")
    return stored(out.withColumn("key", F.monotonically_increasing_id()), "lm-coded")


class Model:
    """first, later: distribution of the state a text, or a stretch, starts in;
    move: transitions; emit: (symbols, states)."""

    def __init__(self, first, later, move, emit):
        self.first, self.later, self.move, self.emit = first, later, move, emit

    @staticmethod
    def start(share: np.ndarray, seed: int = 5) -> Model:
        rng = np.random.default_rng(seed)
        emit = share[:, None] * np.exp(0.5 * rng.standard_normal((SYMBOLS, STATES)))
        flat = np.full(STATES, 1 / STATES)
        move = 0.9 * np.eye(STATES) + 0.1 / STATES
        return Model(flat, flat, move, Model._padded(emit / emit.sum(axis=0)))

    @staticmethod
    def _padded(emit: np.ndarray) -> np.ndarray:
        emit[PAD] = 1.0  # padding changes no likelihood
        return emit

    @staticmethod
    def from_counts(counts: np.ndarray, share: np.ndarray) -> Model:
        """counts: rows as ``expected`` gives them."""
        emit, rest = counts[:SYMBOLS].copy(), counts[SYMBOLS:] + 1e-3
        emit[PAD] = 0
        emit = (emit + PRIOR * share[:, None]) / (emit.sum(axis=0) + PRIOR)
        first, later, move = rest[0], rest[1], rest[2:]
        return Model(first / first.sum(), later / later.sum(), move / move.sum(axis=1, keepdims=True),
                     Model._padded(emit))


COUNTS = SYMBOLS + 2 + STATES  # emissions, first, later, moves


def stretches(sequences: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The sequences cut into rows of STRETCH symbols, padded, each beginning with the
    last symbol of the row before; which rows are first."""
    size = np.array([len(s) for s in sequences])
    many = 1 + np.maximum(0, -(-(size - STRETCH) // (STRETCH - 1)))
    at = np.cumsum(many) - many
    offset = (np.arange(int(many.sum())) - np.repeat(at, many)) * (STRETCH - 1)
    place = offset[:, None] + np.arange(STRETCH)
    flat = np.concatenate(sequences).astype(np.int64)
    inside = np.minimum(np.repeat(np.cumsum(size) - size, many)[:, None] + place, len(flat) - 1)
    rows = np.where(place < np.repeat(size, many)[:, None], flat[inside], PAD)
    return rows, offset == 0


def expected(rows: np.ndarray, first: np.ndarray, model: Model) -> np.ndarray:
    """Expected counts (COUNTS, STATES) of one forward-backward pass."""
    n = len(rows)
    alpha = np.empty((STRETCH, n, STATES))
    scale = np.empty((STRETCH, n, 1))
    emit = model.emit
    now = np.where(first[:, None], model.first, model.later)
    for t in range(STRETCH):
        now = (now if t == 0 else now @ model.move) * emit[rows[:, t]]
        scale[t] = now.sum(axis=1, keepdims=True)
        now = now / scale[t]
        alpha[t] = now
    beta = np.ones((n, STATES))
    gamma = np.empty((STRETCH, n, STATES))
    gamma[-1] = alpha[-1]
    moves = np.zeros((STATES, STATES))
    back = model.move.T.copy()
    for t in range(STRETCH - 1, 0, -1):
        ahead = emit[rows[:, t]] * beta / scale[t]
        real = ahead * (rows[:, t] != PAD)[:, None]
        moves += alpha[t - 1].T @ real
        beta = ahead @ back
        gamma[t - 1] = alpha[t - 1] * beta
    out = np.zeros((COUNTS, STATES))
    own = rows.copy()
    own[~first, 0] = PAD  # emitted, and counted, in the stretch before
    symbols = own.T.reshape(-1)
    for k in range(STATES):
        out[:SYMBOLS, k] = np.bincount(symbols, weights=gamma[:, :, k].reshape(-1), minlength=SYMBOLS)
    out[SYMBOLS] = gamma[0][first].sum(axis=0)
    out[SYMBOLS + 1] = gamma[0][~first].sum(axis=0)
    out[SYMBOLS + 2:] = moves * model.move
    return out


def _sequences(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(v, dtype="<u2") for v in column.to_pylist()]


def _pass(sequences: list[np.ndarray], model: Model) -> np.ndarray:
    """Expected counts of many sequences, a bounded number of rows at a time."""
    total = np.zeros((COUNTS, STATES))
    lo, size = 0, 0
    for hi in range(1, len(sequences) + 1):
        size += len(sequences[hi - 1])
        if size >= 100_000 or hi == len(sequences):
            total += expected(*stretches(sequences[lo:hi]), model)
            lo, size = hi, 0
    return total


def summed(train: DataFrame, model: Model) -> np.ndarray:
    """Expected counts of all texts of ``train``."""
    def run(batches):
        total = np.zeros((COUNTS, STATES))
        for batch in batches:
            total += _pass(_sequences(batch.column(0)), model)
        used = np.flatnonzero(total.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(used), *[pa.array(total[used, k]) for k in range(STATES)]],
                                         ["row", *[f"s{k}" for k in range(STATES)]])

    rows = train.select("symbols").mapInArrow(
        tidied(run), "row long, " + ", ".join(f"s{k} double" for k in range(STATES)))
    got = rows.groupBy("row").agg(*[F.sum(f"s{k}").alias(f"s{k}") for k in range(STATES)]).toArrow()
    counts = np.zeros((COUNTS, STATES))
    counts[got["row"].to_numpy()] = np.column_stack([got[f"s{k}"].to_numpy() for k in range(STATES)])
    return counts


def baum_welch(train: DataFrame, share: np.ndarray, sweeps: int = SWEEPS, rounds: int = ROUNDS) -> Model:
    """A model of the coded training texts: ``sweeps`` passes fold by fold, then
    ``rounds`` passes over all of them at once.  A fold without texts changes nothing."""
    model, held = Model.start(share), np.zeros((COUNTS, STATES))
    dealt = train.withColumn("fold", F.pmod(F.xxhash64("doc_id", "n_tokens"), F.lit(FOLDS)))
    for step in range(sweeps * FOLDS):
        counts = summed(dealt.filter(F.col("fold") == step % FOLDS), model)
        if counts.any():
            held = FADING * held + counts
            model = Model.from_counts(held, share)
    for _ in range(rounds):
        counts = summed(train, model)
        if counts.any():
            model = Model.from_counts(counts, share)
    return model


def log_likelihood(sequences: list[np.ndarray], model: Model) -> np.ndarray:
    """log10 probability of each whole sequence, by the scaled forward recursion."""
    size = np.array([len(s) for s in sequences])
    order = np.argsort(-size, kind="stable")
    flat = np.concatenate([sequences[i] for i in order])
    at = np.cumsum(size[order]) - size[order]
    live = np.searchsorted(-size[order], -np.arange(int(size.max())), "left")  # longer than t
    logs = np.zeros(len(sequences))
    now = None
    for t, n in enumerate(live.tolist()):
        emit = model.emit[flat[at[:n] + t]]
        now = model.first * emit if t == 0 else (now[:n] @ model.move) * emit
        scale = now.sum(axis=1)
        logs[:n] += np.log10(scale)
        now /= scale[:, None]
    out = np.empty(len(sequences))
    out[order] = logs
    return out


def scores(docs: DataFrame, text: str = "text", sweeps: int = SWEEPS, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score."""
    slim = bounded_batches(docs).select("doc_id", (fold(5) == 1).alias("held_out"), F.col(text).cast("string").alias("t"))
    train = slim.filter(~F.col("held_out"))
    counts = stored(count_words(train), "lm-counts")
    lexicon = Lexicon(counts, train.count())
    rows = coded(slim, lexicon)
    training = rows.filter(~F.col("held_out")).select("key", "doc_id", "n_tokens", "symbols")
    model = baum_welch(training, lexicon.share, sweeps, rounds)

    def run(batches):
        for batch in batches:
            done = log_likelihood(_sequences(batch.column(1)), model) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(done)], ["key", "outer"])

    outer = rows.select("key", "symbols").mapInArrow(tidied(run), "key long, outer double")
    rare = rows.select("key", F.explode("rare").alias("word")).join(counts, "word", "left")
    rare = rare.groupBy("key").agg(F.sum(F.log10(F.coalesce("c", F.lit(0)) + 0.5)).alias("rare_log"),
                                   F.count("c").alias("rare_known"))
    out = (rows.drop("symbols", "rare").join(outer, "key").join(rare, "key", "left")
           .na.fill({"rare_log": 0.0, "rare_known": 0}))
    return out.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.col("rare_known")).alias("n_known"),
        F.lit(lexicon.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.col("rare_log")).alias("base_score"),
        (F.col("outer") + F.col("inner") + F.col("rare_log")).alias("score"))
