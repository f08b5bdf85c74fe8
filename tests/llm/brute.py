"""Plain versions of the operators, for small tables."""

from __future__ import annotations

import collections
import hashlib
import math
import re
import zlib

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def words(text):
    return WORD.findall((text or "").encode())


def lower_words(text):
    return WORD.findall((text or "").encode().lower())


def grams(text, n):
    w = lower_words(text)
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def links(rows, n, percent):
    """rows: (key, text); sorted pairs of keys whose texts are similar."""
    sets = [(k, grams(t, n)) for k, t in rows]
    return sorted((min(a, b), max(a, b)) for i, (a, x) in enumerate(sets) for b, y in sets[:i]
                  if x and y and 100 * len(x & y) >= percent * len(x | y))


def components(rows, n, percent):
    """rows: (key, text); least key of each key's component."""
    sets = [(k, grams(t, n)) for k, t in rows]
    up = {k: k for k, _ in rows}

    def top(k):
        while up[k] != k:
            k = up[k]
        return k

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                p, q = top(a), top(b)
                up[max(p, q)] = min(p, q)
    return {k: (len(x), top(k)) for k, x in sets}


def repeats(w, least):
    """Positions covered by runs of ``least`` words found twice, and the longest run found twice."""
    seen = collections.Counter(tuple(w[i:i + least]) for i in range(len(w) - least + 1))
    cover = set()
    for i in range(len(w) - least + 1):
        if seen[tuple(w[i:i + least])] > 1:
            cover.update(range(i, i + least))
    longest = 0
    size = least
    while cover:
        c = collections.Counter(tuple(w[i:i + size]) for i in range(len(w) - size + 1))
        if not c or max(c.values()) < 2:
            break
        longest, size = size, size + 1
    return len(cover), longest


def quality(text, least=5, covered=0.5, longest=100):
    raw = (text or "").encode()
    w = words(text)
    lines = [x for x in raw.split(b"\n") if x.strip(b" \t\n\x0b\x0c\r")]
    in_windows = repeats(w, 8)[0]
    cover, long_ = repeats(w, least)
    base = len(w) < 20 or 100 * in_windows > 30 * len(w)
    return {"n_words": len(w), "word_chars": sum(len(x.decode()) for x in w),
            "n_symbols": sum(c in "#*$%&|<>" for c in text or ""),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": in_windows, "base_failed": base,
            "kept": not base and cover <= covered * len(w) and long_ <= longest}


def luhn(digits):
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def identifiers(text):
    text = text or ""
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in CARD.finditer(text):
        d = re.sub("[^0-9]", "", m[0])
        if 13 <= len(d) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    return out + [("phone", *m.span()) for m in PHONE.finditer(text)
                  if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]


def terms(text):
    """(term, start, end) of words of three bytes or more, without punctuation at their ends."""
    marks = "".join(chr(i) for i in range(33, 127) if not chr(i).isalnum())
    out = []
    for m in re.finditer(r"[^\x20\x09-\x0D]+", text or ""):
        word = m[0].lstrip(marks)
        start = m.end() - len(word)
        word = word.rstrip(marks)
        if len(word.encode()) >= 3:
            out.append((word.encode().lower(), start, start + len(word)))
    return out


def with_terms(text):
    """(identifier, term, start, end) for every identifier and every term of a text
    that is no part of one."""
    text, found = text or "", identifiers(text)
    listed = [(t, a, b) for t, a, b in terms(text) if not any(b > s and a < e for _, s, e in found)]
    return [((kind, text[s:e].lower()), *t) for kind, s, e in found for t in listed]


def witnesses(texts, n=3, percent=60):
    """text -> name of its class of near copies."""
    return {texts[k]: top for k, (_, top) in components(list(enumerate(texts)), n, percent).items()}


def disclosing(texts, support=2, generalise=0.8):
    """{(identifier, term): ratio} over all texts."""
    both, shown = collections.Counter(), collections.defaultdict(set)
    holders, docs = collections.Counter(), collections.Counter()
    for t in texts:
        for pair in {(e, w) for e, w, _, _ in with_terms(t)}:
            both[pair] += 1
            shown[pair].add(t)
        holders.update({(k, (t or "")[s:e].lower()) for k, s, e in identifiers(t)})
        docs.update({w for w, _, _ in terms(t)})
    texts_of = collections.defaultdict(set)
    for (e, _), listed in shown.items():
        texts_of[e] |= listed
    classes = {e: witnesses(sorted(listed)) for e, listed in texts_of.items()}
    out = {}
    for (e, w), n in both.items():
        ic = math.log2(len(texts) / holders[e])
        ratio = math.log2(n * len(texts) / (holders[e] * docs[w])) / ic if ic > 0 else 0.0
        if len({classes[e][t] for t in shown[e, w]}) >= support and ratio >= generalise:
            out[e, w] = ratio
    return out


def added(text, told):
    best = collections.defaultdict(float)
    strongest = collections.defaultdict(float)
    for (_, w), r in told.items():
        strongest[w] = max(strongest[w], r)
    found = identifiers(text or "")
    for w, a, b in terms(text):
        if w in strongest and not any(b > s and a < e for _, s, e in found):
            best[a, b] = strongest[w]
    return sorted((a, b, r) for (a, b), r in best.items())


def masked(text, told, remove=0.95):
    marks = [(s, e, f"[{k.upper()}]") for k, s, e in identifiers(text)]
    marks += [(a, b, "" if r >= remove else "[TERM]") for a, b, r in added(text, told)]
    while marks:
        out, at = "", 0
        for s, e, label in sorted(marks, key=lambda m: (m[0], -m[1])):
            if s >= at:
                out += text[at:s] + label
            at = max(at, e)
        text = out + text[at:]
        marks = [(s, e, f"[{k.upper()}]") for k, s, e in identifiers(text)]
    return text


def mix(rows, seed=1, block=16):
    """rows: (doc_id, source, text); {index: (passes, part)} by enumerated seats."""
    size = [len(words(t)) for _, _, t in rows]
    sources = sorted({s for _, s, _ in rows}, key=lambda s: (s is None, (s or "").encode()))
    total = sum(size)
    held = {s: sum(n for n, r in zip(size, rows) if r[1] == s) for s in sources}
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sources)}
    capped = set()
    while True:
        rest = total - sum(3 * held[s] for s in capped)
        share = sum(weight[s] for s in sources if s not in capped)
        target = {s: 3.0 * held[s] if s in capped else weight[s] * rest / share for s in sources}
        over = {s for s in sources if s not in capped and target[s] > 3 * held[s]}
        if not over:
            break
        capped |= over
    seats = collections.Counter()
    for _ in range(int(total / block + 0.5)):
        best = max(sources, key=lambda s: (target[s] / (2 * seats[s] + 1), -sources.index(s)))
        seats[best] += 1
    out = {}
    for s in sources:
        mine = sorted((i for i, r in enumerate(rows) if r[1] == s),
                      key=lambda i: hashlib.md5(f"{seed}:{rows[i][0]}".encode()).hexdigest())
        want = min(seats[s] * block, 3 * held[s])
        passes = want // held[s] if held[s] else 0
        more = int((want - passes * held[s]) / block + 0.5) * block if passes < 3 else 0
        for i in mine:
            part = max(0, min(size[i], more))
            more -= part if part == size[i] else more
            out[i] = (passes, part)
    return out


def first_words(text, n):
    text = text.lstrip(" \t\n\x0b\x0c\r")
    ends = [m.end() for m in re.finditer(r"[^\x20\x09-\x0D]+", text)]
    return text[:ends[n - 1]]


# --- spelling variants --------------------------------------------------------------

LETTERS = [chr(i) for i in range(97, 123)] + [chr(i) for i in range(0xC0, 0x100)]


def lower(text):
    """A-Z alone."""
    return (text or "").encode().lower().decode()


def vocabulary(rows, drop=97, letters=5, count=3):
    c = collections.Counter()
    for key, text in rows:
        for run in re.findall("[a-z\u00C0-\u00FF]+", lower(text)):
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if drop and h % drop == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            c[run] += 1
    return {w: n for w, n in c.items() if len(w) >= letters and n >= count}


def one_edit(word):
    out = set()
    for i in range(len(word) + 1):
        out |= {word[:i] + a + word[i + k:] for a in LETTERS for k in (0, 1)}
        out.add(word[:i] + word[i + 1:])
    return out - {word}


def apart_by_one(x, y):
    """Whether one inserted, deleted or replaced code point makes x into y."""
    same = next((k for k, (a, b) in enumerate(zip(x, y)) if a != b), min(len(x), len(y)))
    cut = [w[same + 1:] if len(w) >= max(len(x), len(y)) else w[same:] for w in (x, y)]
    return x != y and abs(len(x) - len(y)) <= 1 and cut[0] == cut[1]


def variants(words):
    """word -> (form, root, n, n_near, form_n)"""
    form, near = {}, {}
    for w, n in words.items():
        found = [x for x in (one_edit(w) if len(w) < 100 else words) if x in words and apart_by_one(x, w)]
        near[w] = len(found)
        best = min(found, key=lambda x: (-words[x], x), default=None)
        if best is not None and words[best] >= 2 * n:
            form[w] = best
    out = {}
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out[w] = (form.get(w), root, n, near[w], words.get(form.get(w)))
    return out


# --- collocations --------------------------------------------------------------------

def collocations(rows, least=30, top=2000):
    """rows: (lang, text); {(lang, rank, phrase, a, l, r, n, score)}"""
    f, total = collections.Counter(), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", lower(text)):
            w = [x for x in re.split("[ \t]+", piece) if x]
            total[lang] += len(w)
            f.update((lang, tuple(w[i:i + k])) for k in range(1, 5) for i in range(len(w) - k + 1))
    wanted = {p: a for p, a in f.items() if len(p[1]) > 1 and a >= least}
    longest = collections.Counter()
    for (lang, w), a in wanted.items():
        for k in range(2, len(w)):
            for i in range(len(w) - k + 1):
                longest[lang, w[i:i + k]] = max(longest[lang, w[i:i + k]], a)
    out = collections.defaultdict(list)
    for (lang, w), a in wanted.items():
        score, _, left, right = min((2000000 * a // (f[lang, w[:k]] + f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]])
                                    for k in range(1, len(w)))
        if 100 * longest[lang, w] < 80 * a:
            out[lang].append((-score, -a, " ".join(w).encode(), left, right))
    return {(lang, rank, p.decode(), -a, x, y, total[lang], -score) for lang, listed in out.items()
            for rank, (score, a, p, x, y) in enumerate(sorted(listed)[:top], 1)}
