"""Personal data, and the terms that give it away.

Direct identifiers (email, ip, card, phone) are found by their forms.  Beyond
those, a term may reveal an identifier by keeping its company.  With p counted
over all documents, an identifier c holds IC(c) = -log2 p(c) bits, and a term t
discloses PMI(c; t) = log2 p(c, t) / (p(c) p(t)) of them, where p(c, t) counts the
texts that hold both, at any distance.  A term that
discloses ``generalise`` of IC(c) or more is generalised, and one that
discloses ``remove`` or more (it hardly occurs without c) is removed, provided
that ``support`` witnesses show the two together.  A witness is a class of near
copies among the identifier's texts, so a letter that was sent twice with a word
changed tells nothing about its other words.  A disclosing term is treated at
every place of every text.

The corpus passes hold texts apart by their digest, so what a text's spans are
depends on its words and the corpus, not on ids.  Terms are paired with the
identifiers of their text where ``support`` texts show the identifier; documents holding a term are
counted in one more pass over all texts, with a bounded bitmap of the candidate
terms keeping others out of the shuffle, and summed within tasks first.

Defined results: null or empty text has no spans; equal texts have equal spans;
repeated rows and null ids are passed through; other columns are ignored (or
kept, by ``sanitised``); an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bitmap import Bitmap
from .tables import bounded_batches, stored, tidied
from .words import Words, chunks, combine, hash_ranges, mix, text_bytes

KINDS = ("email", "ip", "card", "phone")
SUPPORT = 2
GENERALISE = 0.8
REMOVE = 0.95
LETTERS = 3  # bytes of the shortest term
SHINGLE, BANDS, WIDTH = 3, 10, 4  # a text's sketch: bands of least hashes of its 3-word shingles
HOPS = 3  # rounds that join classes of near copies

# The stated forms, written so that no text makes them scan twice.
LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
NO_DIGIT = re.compile(r"[^0-9]")
_LOCAL = np.zeros(256, dtype=bool)
_LOCAL[[b for b in range(128) if LOCAL.match(chr(b))]] = True
_TRIM = np.zeros(256, dtype=bool)
_TRIM[[b for b in range(33, 127) if not chr(b).isalnum()]] = True


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Every '@' takes the longest run of local characters before it."""
    out, last = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > last and LOCAL.match(text[start - 1]):
            start -= 1
        m = DOMAIN.match(text, at) if start < at else None
        if m:
            out.append((start, m.end()))
            last = m.end()
        else:
            last = max(last, at + 1)  # nothing before this '@' can end at a later one
        at = text.find("@", max(last, at + 1))
    return out


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Direct identifiers of a text, by kind as listed, then start."""
    out = [("email", s, e) for s, e in emails(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text)
            if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in m[0].split("."))]
    for m in CARD.finditer(text):
        digits = NO_DIGIT.sub("", m[0])
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in PHONE.finditer(text)
            if 9 <= len(NO_DIGIT.sub("", m[0])) <= 15]
    return out


def digest(raw: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(raw, digest_size=8).digest(), "little", signed=True)


def trimmed(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """Byte ranges of the words without ASCII punctuation at their ends; words
    of nothing else become empty."""
    buf = np.frombuffer(w.raw, dtype=np.uint8)
    start, end = w.start.copy(), w.end.copy()
    live = np.arange(len(start))
    while len(live):
        live = live[(start[live] < end[live]) & _TRIM[buf[start[live]]]]
        start[live] += 1
    live = np.arange(len(start))
    while len(live):
        live = live[(start[live] < end[live]) & _TRIM[buf[end[live] - 1]]]
        end[live] -= 1
    return start, end


def occurrences(raw: bytes, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(term hashes, place, end in code points) of a text's terms, in order, but
    those that are part of an identifier."""
    w = Words([raw], lower=True)
    start, end = trimmed(w)
    long = np.flatnonzero(end - start >= LETTERS)
    start, end = start[long], end[long]
    term = hash_ranges(w.raw, start, end).view(np.int64)
    buf = np.frombuffer(w.raw, dtype=np.uint8)
    points = np.concatenate(([0], np.cumsum((buf & 0xC0) != 0x80)))
    a, b = points[start], points[end]
    own = np.zeros(len(a), dtype=bool)  # words that are part of an identifier
    for _, s, e in base_spans(text):
        own[np.searchsorted(b, s, "right"):np.searchsorted(a, e, "left")] = True
    return term[~own], a[~own], b[~own]


def sketch(raw: bytes) -> list[int]:
    """Bands of least hashes of a text's shingles: texts that share four fifths of
    them have an equal band (with 0.995), texts that share a third seldom (0.11)."""
    h = Words([raw], lower=True).hashes()
    runs = combine(h, min(SHINGLE, len(h)))
    orders = mix(np.arange(1, BANDS * WIDTH + 1, dtype=np.uint64))
    least = np.array([mix(runs ^ order).min() for order in orders], dtype=np.uint64)
    return [int(combine(band, WIDTH)[0].view(np.int64)) for band in least.reshape(BANDS, WIDTH)]


def findings(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, digest, base (spans), entities and sketch (of texts with any) of
    every document."""
    slim = bounded_batches(docs).select("doc_id", F.col(text).cast("string").alias("t"))
    kind = slim.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            texts = text_bytes(batch.column(1))
            for lo, hi in chunks(texts):
                rows = {"digest": [], "base": [], "entities": [], "sketch": []}
                for raw in texts[lo:hi]:
                    t = raw.decode("utf-8", "replace")
                    spans = base_spans(t)
                    rows["digest"].append(digest(raw))
                    rows["base"].append([f"{k}:{s}:{e}" for k, s, e in spans])
                    rows["entities"].append(list({digest(f"{k}:{t[s:e].lower()}".encode())
                                                  for k, s, e in spans}))
                    rows["sketch"].append(sketch(raw) if spans else None)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(rows["digest"], pa.int64()),
                     pa.array(rows["base"], pa.list_(pa.string())),
                     pa.array(rows["entities"], pa.list_(pa.int64())), pa.array(rows["sketch"], pa.list_(pa.int64()))],
                    ["doc_id", *rows])

    return stored(slim.mapInArrow(
        tidied(run), f"doc_id {kind}, digest long, base array<string>, entities array<long>, sketch array<long>"),
        "pii-findings")


def documents_with(docs: DataFrame, text: str, wanted: Bitmap) -> DataFrame:
    """(term, docs): documents that hold each term the bitmap lets through."""
    def run(batches):
        for batch in batches:
            texts = text_bytes(batch.column(0))
            found = []
            for lo, hi in chunks(texts):
                w = Words(texts[lo:hi], lower=True)
                start, end = trimmed(w)
                term = hash_ranges(w.raw, start, end).view(np.int64)
                keep = wanted.may_hold(term)
                doc, term = w.doc_of()[keep], term[keep]
                order = np.lexsort((doc, term))
                doc, term = doc[order], term[order]
                new = np.ones(len(term), dtype=bool)
                new[1:] = (term[1:] != term[:-1]) | (doc[1:] != doc[:-1])
                found.append(term[new])
            term, n = np.unique(np.concatenate(found) if found else np.zeros(0, np.int64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(term), pa.array(n.astype(np.int64))], ["term", "docs"])

    rows = docs.select(F.col(text).cast("string")).mapInArrow(tidied(run), "term long, docs long")
    return rows.groupBy("term").agg(F.sum("docs").alias("docs"))


def words_of(docs: DataFrame, text: str, wanted: Bitmap) -> DataFrame:
    """(digest, term): distinct terms of the texts the bitmap lets through."""
    def run(batches):
        seen = set()
        for batch in batches:
            for raw in text_bytes(batch.column(0)):
                name = digest(raw)
                if name not in seen and wanted.may_hold(np.array([name]))[0]:
                    seen.add(name)
                    term = np.unique(occurrences(raw, raw.decode("utf-8", "replace"))[0])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(term), name, dtype=np.int64)), pa.array(term)], ["digest", "term"])

    return docs.select(F.col(text).cast("string")).mapInArrow(tidied(run), "digest long, term long").distinct()


def places_of(docs: DataFrame, text: str, wanted: Bitmap) -> DataFrame:
    """(digest, term, place, end): every place of the terms the bitmap lets through."""
    def run(batches):
        seen = set()
        for batch in batches:
            texts = text_bytes(batch.column(0))
            for lo, hi in chunks(texts):
                w = Words(texts[lo:hi], lower=True)
                hold = wanted.may_hold(hash_ranges(w.raw, *trimmed(w)).view(np.int64))
                for d in np.unique(w.doc_of()[hold]):
                    raw = texts[lo + d]
                    name = digest(raw)
                    if name not in seen:
                        seen.add(name)
                        term, a, b = occurrences(raw, raw.decode("utf-8", "replace"))
                        keep = wanted.may_hold(term)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(int(keep.sum()), name, dtype=np.int64)), pa.array(term[keep]),
                             pa.array(a[keep]), pa.array(b[keep])], ["digest", "term", "place", "end"])

    return docs.select(F.col(text).cast("string")).mapInArrow(
        tidied(run), "digest long, term long, place long, end long")


def witnesses(shown: DataFrame) -> DataFrame:
    """``shown`` (entity, digest, rows, sketch) with witness in place of sketch: one
    name for texts of an identifier that share a band, directly or by others."""
    named = shown.withColumn("witness", F.col("digest"))
    for _ in range(HOPS):
        places = named.select("entity", "digest", "rows", "sketch", "witness", F.posexplode("sketch").alias("k", "least"))
        lowest = places.groupBy("entity", "k", "least").agg(F.min("witness").alias("lowest"))
        named = stored(places.join(lowest, ["entity", "k", "least"]).groupBy("entity", "digest").agg(
            F.first("rows").alias("rows"), F.first("sketch").alias("sketch"), F.min("lowest").alias("witness")),
            "pii-witnesses")
    return named.drop("sketch")


def disclosing(docs: DataFrame, found: DataFrame, text: str = "text", support: int = SUPPORT,
               generalise: float = GENERALISE) -> DataFrame:
    """(entity, term, ratio): terms that disclose ``generalise`` of an identifier."""
    n = found.count()
    # Equal texts are one row; documents are counted as they are.
    rows = (found.filter(F.size("entities") > 0).select("digest", "sketch", F.explode("entities").alias("entity"))
            .groupBy("entity", "digest").agg(F.count(F.lit(1)).alias("rows"), F.first("sketch").alias("sketch")))
    # An identifier of fewer witnesses has no term with enough of them, so the texts
    # of most identifiers never meet their terms.
    often = rows.groupBy("entity").agg(F.count(F.lit(1)).alias("texts")).filter(F.col("texts") >= support)
    named = witnesses(stored(rows.join(often.select("entity"), "entity"), "pii-shown"))
    seen = (named.groupBy("entity", "witness").agg(F.count(F.lit(1)).alias("texts"))
            .groupBy("entity").agg(F.count(F.lit(1)).alias("seen")).filter(F.col("seen") >= support))
    shown = stored(named.join(seen.select("entity"), "entity"), "pii-shown")
    words = words_of(docs, text, Bitmap(shown.select("digest").distinct(), "digest"))
    pairs = (shown.join(words, "digest").groupBy("entity", "term", "witness").agg(F.sum("rows").alias("both"))
             .groupBy("entity", "term").agg(F.count(F.lit(1)).alias("seen"), F.sum("both").alias("both"))
             .filter(F.col("seen") >= support))
    pairs = stored(pairs, "pii-pairs")
    terms = stored(documents_with(docs, text, Bitmap(pairs.select("term").distinct(), "term")), "pii-terms")
    held = (found.filter(F.size("entities") > 0).select(F.explode("entities").alias("entity"))
            .groupBy("entity").agg(F.count(F.lit(1)).alias("holders")))
    ic = F.log2(F.lit(float(n)) / F.col("holders"))
    pmi = F.log2(F.col("both") * float(n) / (F.col("holders") * F.col("docs").cast("double")))
    return (pairs.join(terms, "term").join(held, "entity")
            .withColumn("ratio", F.when(ic > 0, pmi / ic).otherwise(0.0))
            .filter(F.col("ratio") >= generalise).select("entity", "term", "ratio"))


def term_spans(docs: DataFrame, found: DataFrame, text: str = "text", remove: float = REMOVE) -> DataFrame:
    """(digest, added): spans of all disclosing terms of each text that has any,
    wherever they stand and whether or not it shows the identifier: array of struct(place, end, removed), by place."""
    told = stored(disclosing(docs, found, text).groupBy("term").agg(F.max("ratio").alias("ratio")), "pii-told")
    seen = places_of(docs, text, Bitmap(told.select("term"), "term"))
    return stored(seen.join(told, "term").groupBy("digest", "place", "end")
                  .agg((F.max("ratio") >= remove).alias("removed"))
                  .groupBy("digest").agg(F.array_sort(F.collect_list(
                      F.struct("place", "end", "removed"))).alias("added")), "pii-added")


def report(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, counts of the direct identifiers, and all spans of every document."""
    found = findings(docs, text)
    added = term_spans(docs, found, text)
    rows = found.select("doc_id", "digest", "base").join(added, "digest", "left")
    def of(kind: str):  # a lambda of two parameters would get the place in the array as its second
        return lambda span: span.startswith(f"{kind}:")

    counts = [F.size(F.filter("base", of(k))).cast("long").alias(f"n_{k}") for k in KINDS]
    terms = F.transform(F.coalesce("added", F.array().cast("array<struct<place:long,end:long,removed:boolean>>")),
                        lambda a: F.concat_ws(":", F.lit("term"), a["place"].cast("string"),
                                              a["end"].cast("string")))
    base = F.array_join("base", ",")
    return rows.select("doc_id", *counts, F.sha2(base.cast("binary"), 256).alias("base_sha256"),
                       F.array_join(F.concat("base", terms), ",").alias("spans"))


def masked(text: str, spans: list[tuple[str, int, int]], terms: list[dict]) -> str:
    """The text with identifiers replaced by their kind, disclosing terms by
    [TERM], and removed terms left out; overlapping spans become one.  What a
    replacement sets free (a number next to another) is replaced in turn."""
    while True:
        text = _masked_once(text, spans, terms)
        spans, terms = base_spans(text), []
        if not spans:
            return text


def _masked_once(text: str, spans: list[tuple[str, int, int]], terms: list[dict]) -> str:
    marks = [(s, e, f"[{k.upper()}]") for k, s, e in spans]
    marks += [(t["place"], t["end"], "" if t["removed"] else "[TERM]") for t in terms]
    out, at = [], 0
    for s, e, label in sorted(marks, key=lambda m: (m[0], -m[1])):
        if s >= at:
            out += [text[at:s], label]
        elif e <= at:
            continue
        at = max(at, e)
    return "".join(out) + text[at:]


def sanitised(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with personal data and disclosing terms masked in the text.

    Only texts that may hold a disclosing term meet the table of added spans;
    the others are masked where they are read.
    """
    added = term_spans(docs, findings(docs, text), text)
    some = Bitmap(added.select("digest"), "digest")
    names = docs.columns
    at = names.index(text)
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))]).withColumn(
        f"c{at}", F.col(f"c{at}").cast("string"))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in plain.schema.fields)

    def untouched(batches):
        for batch in batches:
            values = batch.column(at)
            raw = text_bytes(values)
            far = ~some.may_hold(np.array([digest(r) for r in raw], dtype=np.int64))
            new = []
            for r, known, keep in zip(raw, values.is_valid().to_pylist(), far):
                t = r.decode("utf-8", "replace") if keep else ""
                new.append((masked(t, base_spans(t), []) if keep else "") if known else None)
            arrays = [pa.array(new, pa.string()) if i == at else c for i, c in enumerate(batch.columns)]
            yield pa.RecordBatch.from_arrays(arrays, batch.schema.names).filter(pa.array(far))

    def near(batches):
        for batch in batches:
            names_ = np.array([digest(r) for r in text_bytes(batch.column(at))], dtype=np.int64)
            keep = pa.array(some.may_hold(names_))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(names_)],
                                             [*batch.schema.names, "digest"]).filter(keep)

    def treated(batches):
        for batch in batches:
            values = batch.column(at)
            new = []
            for r, known, terms in zip(text_bytes(values), values.is_valid().to_pylist(),
                                       batch.column(len(names)).to_pylist()):
                t = r.decode("utf-8", "replace")
                new.append(masked(t, base_spans(t), terms or []) if known else None)
            arrays = [pa.array(new, pa.string()) if i == at else c
                      for i, c in enumerate(batch.columns[:len(names)])]
            yield pa.RecordBatch.from_arrays(arrays, batch.schema.names[:len(names)])

    met = plain.mapInArrow(tidied(near), schema + ", digest long").join(added, "digest", "left")
    done = met.select(*plain.columns, "added").mapInArrow(tidied(treated), schema)
    return plain.mapInArrow(tidied(untouched), schema).unionByName(done).toDF(*names)
