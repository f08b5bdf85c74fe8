"""Toxicity by a lexicon met through misspellings, and by its context.

The lexicon is learned from a bounded sample of labelled training texts
(``FIT_TEXTS`` with the least hash): words, and stems of words, that stand in many
more toxic than clean texts; a term is left out only where a better stem holds
all its hits.  Terms have 4 letters or more.  One automaton (see ``automaton``) finds them with
an edit or without (a stem: at the beginning of a word), in whole words and in the
letter runs of words that hold other signs; misspellings by two edits or more are
not found, nor those that split a word by spaces.  Forms an edit away that clean texts use as words of their
own are learned too and left out.  Every hit is weighed by its context window:
inside quotation marks on its line it counts less (it may be cited), and among
other hits within ``WINDOW`` words more.  The sums over a text enter a logistic
regression fitted on the same sample by sums over partitions.

Scoring is one pass over the texts without a shuffle, and the model sent to the
tasks is bounded by the sample: every term that passes the two tests is an entry,
and every form that clean texts use is left out.  Labels, language, source and id
never enter a score.

Defined results: null or empty text has no hits and scores like any text without
hits; without labels of both kinds every text scores the smoothed rate; labels
that are null or neither 0 nor 1 are left out, an id labelled twice takes the
greater; repeated rows are scored each; other columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import logistic
from .automaton import Automaton, Entry
from .labelled import held_out, sample
from .tables import bounded_batches, stored, tidied
from .words import chunks, text_bytes

FIT_TEXTS = 20_000
LEAST_Z = 6.0
LEAST_RATIO = 3.0
STEM_SIZES = range(4, 9)
EDIT_FROM = 4  # characters of the shortest entry that may be misspelled
WINDOW = 20
QUOTED = 0.3  # what a quoted hit counts
THRESHOLD = 0.3

FEATURES = ["f_any", "f_exact", "f_near", "f_stem", "f_near_stem", "f_word_rate", "f_near_rate", "f_stem_rate",
            "f_abuse", "f_quoted", "f_window"]

LETTERS = re.compile(r"[^\W\d_]+")
#: Characters that open or close a quotation.
QUOTES = '"“”„«»‹›'


def terms_of(text: str) -> tuple[set[str], set[str]]:
    """(words, stems) of a text, lower case."""
    words = set(LETTERS.findall(text.lower()))
    stems = {w[:n] for w in words for n in STEM_SIZES if len(w) > n}
    return words, stems | {w for w in words if len(w) in STEM_SIZES}


def _counted(rows: DataFrame, wanted: set[tuple[bool, str]] | None) -> DataFrame:
    """(stem, term, docs) over the column t: terms, or the wanted ones alone."""
    def run(batches):
        for batch in batches:
            texts = text_bytes(batch.column(0))
            for lo, hi in chunks(texts):
                count: Counter = Counter()
                for raw in texts[lo:hi]:
                    words, stems = terms_of(raw.decode("utf-8", "replace"))
                    pairs = {(False, w) for w in words} | {(True, s) for s in stems}
                    count.update(pairs if wanted is None else pairs & wanted)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([s for s, _ in count], pa.bool_()), pa.array([t for _, t in count], pa.string()),
                     pa.array(list(count.values()), pa.int64())], ["stem", "term", "docs"])

    return (rows.select("t").mapInArrow(tidied(run), "stem boolean, term string, docs long")
            .groupBy("stem", "term").agg(F.sum("docs").alias("docs")))


def learn_lexicon(fit: DataFrame) -> tuple[list[Entry], list[float]]:
    """Entries and their weights (log odds) from texts t with label."""
    size = {r["label"]: r["n"] for r in fit.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, clean = size.get(1, 0), size.get(0, 0)
    if not toxic or not clean:
        return [], []
    # Fewer texts than these cannot reach LEAST_Z, even if no clean text has the term.
    reach = LEAST_Z ** 2 * toxic
    least = max(3, math.floor(reach / (clean + reach / (toxic + clean))))
    # All of them: their number is bounded by the labelled texts, which FIT_TEXTS bounds.
    rows = _counted(fit.filter("label = 1"), None).filter((F.col("docs") >= least) & (F.length("term") >= 4)).collect()
    found = {(r["stem"], r["term"]): r["docs"] for r in rows}
    other = {(r["stem"], r["term"]): r["docs"] for r in
             _counted(fit.filter("label = 0"), set(found)).collect()}
    return selected(found, other, toxic, clean)


def selected(found: dict, other: dict, toxic: int, clean: int) -> tuple[list[Entry], list[float]]:
    """Entries and weights of the terms that pass; found and other hold the
    number of toxic and of clean texts with each (stem, term)."""
    scored = []
    for (stem, term), a in found.items():
        b = other.get((stem, term), 0)
        pa_, pb = (a + 0.5) / (toxic + 1), (b + 0.5) / (clean + 1)
        p = (a + b) / (toxic + clean)
        z = (a / toxic - b / clean) / math.sqrt(max(p * (1 - p), 1e-9) * (1 / toxic + 1 / clean))
        if z >= LEAST_Z and pa_ >= LEAST_RATIO * pb and len(term) >= 4:
            scored.append((-z, stem, -len(term), term, math.log(pa_ / pb)))
    entries: list[Entry] = []
    weights: list[float] = []
    for _, stem, _, term, weight in sorted(scored):
        if any(e.stem and term.startswith(e.text) for e in entries):
            continue  # that stem's hits hold all of this term's
        edits = int(len(term) >= EDIT_FROM)
        entries.append(Entry(term, stem, edits))
        weights.append(min(weight, 6.0))
    return entries, weights


#: Kinds of characters, filled as they are met: -1 unknown, 0 neither, 1 digits and other signs in words, 2 letters.
_KIND = np.full(0x110000, -1, dtype=np.int8)


def kinds(points: np.ndarray) -> np.ndarray:
    kind = _KIND[points]
    new = np.unique(points[kind < 0])
    if len(new):
        _KIND[new] = [2 if LETTERS.fullmatch(chr(p)) else int(chr(p).isalnum()) for p in new]
        kind = _KIND[points]
    return kind


class Words32:
    """Words of several texts as code point ranges, without signs other than
    letters and digits at their ends; lower case.  ``part``, ``part_start`` and
    ``part_end`` are the runs of letters inside words that hold more than letters
    (the learner's words), each with the number of its word."""

    def __init__(self, texts: list[bytes]):
        lowered = [t.decode("utf-8", "replace").lower() for t in texts]
        joined = "\n".join(lowered) + "\n"
        self.points = np.frombuffer(joined.encode("utf-32-le"), dtype="<u4")
        low = np.minimum(self.points, 127)
        solid = np.concatenate(([0], (~_BLANK[low]).view(np.int8)))
        step = np.diff(solid)
        self.start, self.end = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
        at = np.concatenate(([0], np.cumsum([len(t) + 1 for t in lowered])))
        self.first = np.searchsorted(self.start, at)
        kind = kinds(self.points)
        live = np.arange(len(self.start))
        while len(live):
            live = live[(self.start[live] < self.end[live]) & (kind[self.start[live]] == 0)]
            self.start[live] += 1
        live = np.arange(len(self.start))
        while len(live):
            live = live[(self.start[live] < self.end[live]) & (kind[self.end[live] - 1] == 0)]
            self.end[live] -= 1
        step = np.diff(np.concatenate(([0], (kind == 2).view(np.int8))))
        start, end = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
        word = np.searchsorted(self.start, start, "right") - 1
        inner = (start > self.start[word]) | (end < self.end[word]) if len(word) else np.zeros(0, bool)
        self.part, self.part_start, self.part_end = word[inner], start[inner], end[inner]


_BLANK = np.zeros(128, dtype=bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


class Detector:
    """What tasks need to measure texts."""

    def __init__(self, entries: list[Entry], weights: list[float], innocent: frozenset[str] = frozenset()):
        self.entries, self.weights = entries, np.array(weights + [0.0])
        self.stem = np.array([e.stem for e in entries] + [False])
        self.automaton = Automaton(entries)
        self.innocent = innocent

    def hits(self, w: Words32):
        """(word, entry, edits, form) of every hit, innocent forms left out; one
        hit a word: that of fewest edits, the whole word before its parts.  form
        is empty for hits without an edit."""
        whole, entry, edits = self.automaton.match(w.points, w.start, w.end)
        inner, entry2, edits2 = self.automaton.match(w.points, w.part_start, w.part_end)
        word = np.concatenate((whole, w.part[inner]))
        start = np.concatenate((w.start[whole], w.part_start[inner]))
        end = np.concatenate((w.end[whole], w.part_end[inner]))
        entry, edits = np.concatenate((entry, entry2)), np.concatenate((edits, edits2))
        form = np.array([w.points[s:e].tobytes().decode("utf-32-le") if d else ""
                         for s, e, d in zip(start.tolist(), end.tolist(), edits.tolist())], dtype=object)
        kept = np.flatnonzero([f not in self.innocent for f in form])
        kept = kept[np.lexsort((kept, edits[kept], word[kept]))]
        kept = kept[np.concatenate(([True], np.diff(word[kept]) > 0))] if len(kept) else kept
        return word[kept], entry[kept], edits[kept], form[kept]

    def measure(self, texts: list[bytes]) -> dict[str, np.ndarray]:
        w = Words32(texts)
        word, entry, edits, _ = self.hits(w)
        n = len(texts)
        doc = np.searchsorted(w.first, word, "right") - 1
        # Quoted: an odd number of marks before it on its line, and one after.
        marks = np.concatenate(([0], np.cumsum(np.isin(w.points, _QUOTE_POINTS))))
        lines = np.flatnonzero(w.points == 10)
        place = w.start[word]
        k = np.searchsorted(lines, place)
        begin = np.where(k > 0, lines[np.maximum(k - 1, 0)], 0) if len(lines) else np.zeros(len(k), int)
        finish = lines[np.minimum(k, len(lines) - 1)] if len(lines) else np.zeros(len(k), int)
        quoted = ((marks[place] - marks[begin]) % 2 == 1) & (marks[finish] > marks[place])
        stem, near = self.stem[entry], edits > 0
        weight = self.weights[entry] * np.where(quoted, QUOTED, 1.0) * np.where(near, 0.7, 1.0)

        def per(values) -> np.ndarray:
            return np.bincount(doc, weights=values, minlength=n)

        # Hits within the window that starts at each hit, in the same text.
        upto = np.searchsorted(word, np.minimum(word + WINDOW, w.first[doc + 1]) if len(word) else word)
        crowd = np.concatenate(([0.0], np.cumsum(weight)))
        window = np.zeros(n)
        np.maximum.at(window, doc, crowd[upto] - crowd[np.arange(len(word))])
        hundred = np.maximum(np.diff(w.first), 1) / 100
        exact = per((~near & ~stem).astype(float))
        nearly, stems = per((near & ~stem).astype(float)), per((~near & stem).astype(float))
        return {"f_any": (exact + nearly + stems > 0).astype(float), "f_exact": np.log1p(exact),
                "f_near": np.log1p(nearly), "f_stem": np.log1p(stems), "f_near_stem": np.log1p(per((near & stem).astype(float))),
                "f_word_rate": np.minimum(exact / hundred, 20.0), "f_near_rate": np.minimum(nearly / hundred, 20.0),
                "f_stem_rate": np.minimum(stems / hundred, 20.0), "f_abuse": np.log1p(per(weight)),
                "f_quoted": np.log1p(per(quoted.astype(float))), "f_window": np.log1p(window)}


_QUOTE_POINTS = np.array([ord(c) for c in QUOTES], dtype=np.uint32)


def learn_innocent(fit: DataFrame, detector: Detector) -> frozenset[str]:
    """Forms an edit away from an entry that clean texts use as often."""
    def run(batches):
        for batch in batches:
            texts, label = text_bytes(batch.column(0)), batch.column(1).to_pylist()
            for lo, hi in chunks(texts):
                w = Words32(texts[lo:hi])
                word, _, edits, forms = detector.hits(w)
                doc = np.searchsorted(w.first, word[edits > 0], "right") - 1
                count = Counter((form, label[lo + d]) for form, d in set(zip(forms[edits > 0], doc.tolist())))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([f for f, _ in count], pa.string()), pa.array([x for _, x in count], pa.int64()),
                     pa.array(list(count.values()), pa.int64())], ["form", "label", "docs"])

    rows = fit.select("t", "label").mapInArrow(tidied(run), "form string, label long, docs long")
    size = {r["label"]: r["n"] for r in fit.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = max(size.get(0, 0), 1) / max(size.get(1, 0), 1)
    counts = rows.groupBy("form").agg(
        F.coalesce(F.sum(F.when(F.col("label") == 1, F.col("docs"))), F.lit(0)).alias("toxic"),
        F.coalesce(F.sum(F.when(F.col("label") == 0, F.col("docs"))), F.lit(0)).alias("clean"))
    own = counts.filter((F.col("clean") > 0) & (F.col("toxic") * share < LEAST_RATIO * F.col("clean")))
    return frozenset(r["form"] for r in own.select("form").collect())


def measured(docs: DataFrame, detector: Detector, text: str = "text") -> DataFrame:
    """doc_id, held_out and the features of every document."""
    slim = docs.select("doc_id", held_out().alias("held_out"), F.col(text).cast("string").alias("t"))
    kind = slim.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            texts = text_bytes(batch.column(2))
            for lo, hi in chunks(texts):
                got = detector.measure(texts[lo:hi])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo),
                     *[pa.array(got[f]) for f in FEATURES]], ["doc_id", "held_out", *FEATURES])

    return slim.mapInArrow(tidied(run), f"doc_id {kind}, held_out boolean, "
                                + ", ".join(f"{f} double" for f in FEATURES))


def scores(docs: DataFrame, labels: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    # 2 * FIT_TEXTS rows at most, so the broadcast is bounded.
    chosen = F.broadcast(sample(labels, "toxic", FIT_TEXTS))
    fit = stored(bounded_batches(docs).select("doc_id", F.col(text).cast("string").alias("t")).join(chosen, "doc_id")
                 .select("t", "label"), "toxic-fit")
    entries, weights = learn_lexicon(fit)
    detector = Detector(entries, weights)
    detector = Detector(entries, weights, learn_innocent(fit, detector))
    rows = stored(measured(docs, detector, text), "toxic-features")
    training = stored(rows.join(chosen, "doc_id").select(*FEATURES, "label"), "toxic-train")
    beta = logistic.fit(training, FEATURES, "label")
    score = logistic.probability(FEATURES, beta)
    return rows.select("doc_id", "held_out", score.alias("score"),
                       (score >= THRESHOLD).cast("int").alias("predicted"))
