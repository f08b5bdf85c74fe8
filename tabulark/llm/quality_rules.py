"""Quality rules on suffix-array repetition.

Every text becomes a sequence of words.  A suffix array over those words is
built by prefix doubling, for all texts of a chunk at once: each round sorts
only the suffixes that still share their group with another, so clean text
costs little more than the first sort.  Neighbouring suffixes give the
longest-common-prefix array; the deepest LCP interval a suffix stands in is
the longest repeat that starts there.  Maximal repeats of ``min_repeat`` words
or more are united into spans, and a text is rejected where the spans cover
more than ``max_covered`` of its words or one repeat is longer than
``max_longest`` words.

Work is one pass without a shuffle: ``mapInArrow`` keeps Spark's partitions,
lost tasks are simply rerun, and memory is bounded by the longest text.

Defined results: null or empty text has no words, zero counts, and fails the
base rule (fewer than ``min_words`` words).  Rows are independent: repeated
rows and null ids are passed through, other columns are kept or ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import bounded_batches, tidied
from .words import Words, chunks, mix, text_bytes

SYMBOLS = b"#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"
_Q = np.uint64(0xD6E8FEB86659FD93)


@dataclass(frozen=True)
class Rules:
    """Limits of the rules.

    min_words, max_repeat_percent: the base rule (words; percent of words in
    8-word windows found twice).  min_repeat: shortest repeat that counts, in
    words.  max_covered: greatest fraction of words in such repeats.
    max_longest: longest single repeat, in words.
    """

    min_words: int = 20
    max_repeat_percent: int = 30
    window: int = 8
    min_repeat: int = 5
    max_covered: float = 0.50
    max_longest: int = 100


def suffix_array(h: np.ndarray, doc: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array of several word sequences laid end to end.

    h: word hashes; doc: sequence number of each word; end: position after the
    last word of that sequence.  Returns (sa, key): sa orders all suffixes so
    that suffixes of one sequence sharing a prefix are neighbours; key marks
    each position's (sequence, first word).
    """
    n = len(h)
    key = mix(h ^ (doc.astype(np.uint64) * _Q))
    sa = np.argsort(key, kind="stable")
    ordered = key[sa]
    new = np.ones(n, dtype=bool)
    new[1:] = ordered[1:] != ordered[:-1]
    at = np.arange(n)
    group = np.maximum.accumulate(np.where(new, at, 0))  # first place of each group
    rank = np.empty(n, dtype=np.int64)
    rank[sa] = group
    step = 1
    alone = new & np.append(new[1:], True)
    place = np.flatnonzero(~alone)  # places in sa whose suffix is not yet alone
    while len(place):
        pos = sa[place]
        nxt = pos + step
        inside = nxt < end[pos]
        second = np.where(inside, rank[np.minimum(nxt, n - 1)], -1)
        first = rank[pos]
        both = first * (n + 1) + second + 1
        order = np.argsort(both, kind="stable")
        pos, both, first = pos[order], both[order], first[order]
        sa[place] = pos  # groups keep their places, so sorted order fits place order
        m = len(pos)
        old = np.ones(m, dtype=bool)
        old[1:] = first[1:] != first[:-1]
        new = np.ones(m, dtype=bool)
        new[1:] = both[1:] != both[:-1]
        idx = np.arange(m)
        start_old = np.maximum.accumulate(np.where(old, idx, 0))
        start_new = np.maximum.accumulate(np.where(new, idx, 0))
        rank[pos] = first + (start_new - start_old)
        alone = new & np.append(new[1:], True)
        place = place[~alone]
        step *= 2
    return sa, key


def longest_repeats(h: np.ndarray, doc: np.ndarray, end: np.ndarray, least: int) -> np.ndarray:
    """For each position, the length of the longest repeat of its own sequence
    that starts there (occurrences may overlap); 0 where shorter than ``least``."""
    n = len(h)
    rep = np.zeros(n, dtype=np.int64)
    if n < 2:
        return rep
    sa, key = suffix_array(h, doc, end)
    power = np.full(n + 1, _Q, dtype=np.uint64)
    power[0] = 1
    power = np.cumprod(power, dtype=np.uint64)
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(h * power[:n], out=total[1:])

    def same(i: np.ndarray, j: np.ndarray, size: np.ndarray | int) -> np.ndarray:
        lo, hi = np.minimum(i, j), np.maximum(i, j)
        return (total[lo + size] - total[lo]) * power[hi - lo] == total[hi + size] - total[hi]

    a, b = sa[:-1], sa[1:]
    ok = (key[a] == key[b]) & (a + least <= end[a]) & (b + least <= end[b])
    a, b = a[ok], b[ok]
    ok = same(a, b, least)
    a, b = a[ok], b[ok]
    if not len(a):
        return rep
    lcp = np.full(len(a), least, dtype=np.int64)
    room = end[a] - np.maximum(a, b)
    step = 1 << int(room.max()).bit_length()
    while step:
        fits = np.flatnonzero(lcp + step <= room)
        if len(fits):
            more = fits[same(a[fits] + lcp[fits], b[fits] + lcp[fits], step)]
            lcp[more] += step
        step >>= 1
    np.maximum.at(rep, a, lcp)
    np.maximum.at(rep, b, lcp)
    return rep


def covered(start: np.ndarray, size: np.ndarray | int, n: int) -> np.ndarray:
    """Which of ``n`` positions the ranges [start, start + size) cover."""
    edge = np.bincount(start, minlength=n + 1)[:n + 1].astype(np.int64)
    edge -= np.bincount(start + size, minlength=n + 1)[:n + 1]
    return np.cumsum(edge)[:n] > 0


def _spans(mask: np.ndarray, lo: int, hi: int) -> list[dict]:
    step = np.diff(np.concatenate(([0], mask[lo:hi].view(np.int8), [0])))
    return [{"start": int(s), "end": int(e)}
            for s, e in zip(np.flatnonzero(step == 1), np.flatnonzero(step == -1))]


def measure(texts: list[bytes], rules: Rules, spans: bool = False) -> dict[str, list]:
    """The measures of each text (see ``quality_measures``)."""
    out: dict[str, list] = {name: [] for name in
                            ("n_words", "word_chars", "n_symbols", "n_dup_lines",
                             "n_repeat_words", "covered_words", "longest_repeat")}
    if spans:
        out["repeats"] = []
    for lo, hi in chunks(texts):
        part = texts[lo:hi]
        w = Words(part)
        n, first = len(w), w.first
        doc = w.doc_of()
        end = first[1:][doc] if n else np.zeros(0, dtype=np.int64)
        rep = longest_repeats(w.hashes(), doc, end, min(rules.min_repeat, rules.window))
        at = np.flatnonzero(rep >= rules.window)
        windows = covered(at, rules.window, n)
        at = np.flatnonzero(rep >= rules.min_repeat)
        mask = covered(at, rep[at], n)
        repeat_words = np.concatenate(([0], np.cumsum(windows)))
        covered_words = np.concatenate(([0], np.cumsum(mask)))
        out["n_words"] += w.counts().tolist()
        out["n_repeat_words"] += (repeat_words[first[1:]] - repeat_words[first[:-1]]).tolist()
        out["covered_words"] += (covered_words[first[1:]] - covered_words[first[:-1]]).tolist()
        for k, raw in enumerate(part):
            a, b = first[k], first[k + 1]
            text = raw.decode("utf-8", "replace")
            out["longest_repeat"].append(int(rep[a:b].max()) if b > a else 0)
            out["word_chars"].append(len(text) - sum(map(text.count, BLANKS)))
            out["n_symbols"].append(len(raw) - len(raw.translate(None, SYMBOLS)))
            lines = [x for x in raw.split(b"\n") if x.strip()] if b > a else []
            out["n_dup_lines"].append(len(lines) - len(set(lines)))
            if spans:
                out["repeats"].append(_spans(mask, a, b))
    return out


def quality_measures(docs: DataFrame, text: str = "text", keep: list[str] | None = None,
                     rules: Rules = Rules(), spans: bool = False) -> DataFrame:
    """Measures of every row's whole text, beside the columns in ``keep``.

    n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (base measures),
    covered_words and longest_repeat (suffix array), and, with ``spans``,
    repeats: the united spans of repeated words (start, end exclusive).
    """
    keep = ["doc_id"] if keep is None else keep
    docs = bounded_batches(docs)
    measures = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, "
                "n_repeat_words long, covered_words long, longest_repeat long"
                + (", repeats array<struct<start:long,end:long>>" if spans else ""))
    slim = docs.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)],
                       F.col(text).cast("string").alias("t"))
    schema = ", ".join([f"k{i} {slim.schema[f'k{i}'].dataType.simpleString()}"
                        for i in range(len(keep))] + [measures])

    def run(batches):
        for batch in batches:
            got = measure(text_bytes(batch.column(len(keep))), rules, spans)
            arrays = [batch.column(i) for i in range(len(keep))]
            for name, values in got.items():
                kind = (pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
                        if name == "repeats" else pa.int64())
                arrays.append(pa.array(values, type=kind))
            yield pa.RecordBatch.from_arrays(arrays, [f"k{i}" for i in range(len(keep))] + [*got])

    out = slim.mapInArrow(tidied(run), schema)
    return out.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)],
                      *[c for c in out.columns if c not in {f"k{i}" for i in range(len(keep))}])


def with_verdict(measures: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Add base_failed and kept to the measures."""
    n = F.col("n_words")
    base = (n < rules.min_words) | (100 * F.col("n_repeat_words") > rules.max_repeat_percent * n)
    fine = ((F.col("covered_words") <= rules.max_covered * n)
            & (F.col("longest_repeat") <= rules.max_longest))
    return measures.withColumns({"base_failed": base, "kept": ~base & fine})


def keep_good(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The rows of ``docs`` that pass, with their own columns and no others.

    The verdict is computed beside the row's columns in one pass, so ids may
    be null or repeated and other columns may have any name.
    """
    names = docs.columns
    judged = with_verdict(quality_measures(docs, keep=names, rules=rules).toDF(
        *[f"c{i}" for i in range(len(names))],
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "covered_words", "longest_repeat"), rules)
    return judged.filter("kept").select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)])
