"""Spelling variants: words of a corpus that are one edit apart.

The near pairs are what A o T o A accepts: A is the minimised acyclic acceptor of
the vocabulary, T the transducer of one inserted, deleted or replaced code point.
T remembers a deleted symbol for one step and may not match it next, so that one
pair has one accepting path.  The composition is cut at its initial states:

* While T has not spent its edit, both tapes stand at the same state of A, so the
  states after the first code points (a *cell*: a prefix just long enough that at
  most ``CELL`` words share it) split the composition into parts that share no
  path.  Each part is one Spark group: its acceptor is built and minimised from
  the cell's words, the composite states are walked breadth first as arrays, and
  the accepted pairs come out as word numbers of the acceptor (each arc holds the
  number of words before it).
* Where T spends its edit inside the first code points, the rest of T is the
  identity, and composing with the identity is equality of what follows: words
  are joined on the word without the edited code point.  Such a group has one
  member a letter at most.

A cell's depth follows from the number of words under each prefix, so no group
grows with the vocabulary, whatever letters are frequent; a word all of whose
prefixes are crowded is a cell of its own, and all its edits are early.

Defined results: null or empty texts have no words; a null id counts as the empty
text in the rule that drops a code point; repeated rows count as often as they
stand; equal counts are told apart by code-point order; other columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import bounded_batches, stored, tidied
from .words import text_bytes

RUN = re.compile("[a-zÀ-ÿ]+")
DROP = 97
LETTERS, COUNT = 5, 3
CELL = 4_096  # words of a cell
LOTS = 32  # parts in which the words of a crowded prefix are dealt
HELD = 200_000  # words counted in a task before they are passed on
_LONG = 1 << 22  # texts beyond are not cut into a list of runs
_SIGNS = 0x110000


def vocabulary(docs: DataFrame, key: str = "doc_id", text: str = "text", drop: int | None = DROP,
               letters: int = LETTERS, count: int = COUNT) -> DataFrame:
    """(word, n): lower-cased runs of letters with their number in all texts.

    With ``drop``, a run loses code point h % length where ``drop`` divides h, the
    crc32 of ``<key>:<run>``.  Words of ``letters`` code points and ``count``
    occurrences or more stay."""
    def passed(held):
        out = pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())],
                                         ["word", "n"])
        held.clear()
        return out

    def run(batches):
        held: Counter = Counter()
        for batch in batches:
            for name, raw in zip(batch.column(0).to_pylist(), text_bytes(batch.column(1))):
                low = raw.lower().decode("utf-8", "replace")  # bytes.lower() changes A-Z alone
                runs = RUN.findall(low) if len(raw) < _LONG else (m[0] for m in RUN.finditer(low))
                seed = zlib.crc32(f"{'' if name is None else name}:".encode())
                for word, n in Counter(runs).items():
                    if drop:
                        h = zlib.crc32(word.encode(), seed)
                        if not h % drop:
                            at = h % len(word)
                            word = word[:at] + word[at + 1:]
                    if len(word) >= letters:
                        held[word] += n
                if len(held) > HELD:
                    yield passed(held)
        yield passed(held)

    slim = bounded_batches(docs).select(F.col(key).cast("string"), F.col(text).cast("string"))
    found = slim.mapInArrow(tidied(run), "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= count)


# --- acceptor and composition ---------------------------------------------------

class Acceptor:
    """Minimal acyclic acceptor of sorted distinct words, in arrays.

    The arcs of state s are ``first[s] : first[s + 1]``, by label; ``skip`` is the
    number of words that come before those through the arc."""

    def __init__(self, words: list[str]):
        same: dict[tuple, int] = {}
        size, first, label, to, skip, final = [], [0], [], [], [], []

        def closed(node: list) -> int:
            state = same.setdefault(tuple(node), len(size))
            if state == len(size):
                n = node[0]
                for sign, child in zip(node[1::2], node[2::2]):
                    label.append(sign)
                    to.append(child)
                    skip.append(n)
                    n += size[child]
                size.append(n)
                final.append(node[0] == 1)
                first.append(len(label))
            return state

        path, last = [[0]], ""  # open states: [final, label, child, label, child ...]
        for word in words:
            shared = next((k for k, (a, b) in enumerate(zip(word, last)) if a != b), min(len(word), len(last)))
            while len(path) > shared + 1:
                done = closed(path.pop())
                path[-1].append(done)
            for sign in word[shared:]:
                path[-1].append(ord(sign))
                path.append([0])
            path[-1][0] = 1
            last = word
        while len(path) > 1:
            done = closed(path.pop())
            path[-1].append(done)
        self.start = closed(path[0])
        self.first, self.final = np.array(first), np.array(final)
        self.label, self.to, self.skip = (np.array(x, dtype=np.int64) for x in (label, to, skip))
        self.key = np.repeat(np.arange(len(size)), np.diff(self.first)) * _SIGNS + self.label

    def leaving(self, states: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in ``states``, arc) of every arc that leaves them."""
        return spread(self.first[states], self.first[states + 1] - self.first[states])

    def on(self, states: np.ndarray, label: np.ndarray) -> np.ndarray:
        """Arc of each state on a label; -1 where there is none."""
        key = states * _SIGNS + label
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        return np.where(self.key[at] == key, at, -1) if len(self.key) else np.full(len(key), -1)


def spread(low: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, value) of the numbers low, low + 1 ... of every range."""
    row = np.repeat(np.arange(len(low)), count)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count) + low[row]


def composed(a: Acceptor) -> tuple[np.ndarray, np.ndarray]:
    """Numbers (i, j) of the words that A o T o A pairs, each pair once; of words
    of unlike length i is the longer one."""
    out = []
    state, number = np.array([a.start]), np.array([0])  # edit not spent: one state for both tapes
    none = np.zeros(0, dtype=np.int64)
    p, q, i, j, banned = none, none, none, none, none  # edit spent
    while len(state) or len(p):
        done = a.final[p] & a.final[q]
        out.append((i[done], j[done]))
        row, arc = a.leaving(p)
        far = a.on(q[row], a.label[arc])
        go = (far >= 0) & (a.label[arc] != banned[row])
        row, arc, far = row[go], arc[go], far[go]
        further = (a.to[arc], a.to[far], i[row] + a.skip[arc], j[row] + a.skip[far], np.full(len(row), -1))
        row, arc = a.leaving(state)
        here = number[row] + a.skip[arc]
        deleted = (a.to[arc], state[row], here, number[row], a.label[arc])
        one, other = spread(arc + 1, a.first[state[row] + 1] - arc - 1)
        replaced = (a.to[arc[one]], a.to[other], here[one], number[row[one]] + a.skip[other], np.full(len(one), -1))
        p, q, i, j, banned = (np.concatenate(x) for x in zip(further, deleted, replaced))
        state, number = a.to[arc], here
    return tuple(np.concatenate(x) for x in zip(*out))


def cell_partners(table: pa.Table) -> pa.Table:
    """(word, near, form_n, form) of the words of one cell that have partners in it:
    their number, and the one of largest n, then least in code-point order."""
    order = np.argsort(np.array(table["word"].to_pylist(), dtype=object), kind="stable")
    words = [table["word"][int(k)].as_py() for k in order]
    n = table["n"].to_numpy()[order]
    depth = int(table["depth"][0].as_py())
    i, j = composed(Acceptor([w[depth:] for w in words]))  # one prefix, so the order is that of the rests
    own, partner = np.concatenate([i, j]), np.concatenate([j, i])
    best = np.lexsort((partner, -n[partner], own))
    own, partner = own[best], partner[best]
    at = np.flatnonzero(np.diff(own, prepend=-1))
    return pa.table({"word": pa.array([words[k] for k in own[at]], pa.string()),
                     "near": pa.array(np.diff(at, append=len(own)), pa.int64()),
                     "form_n": pa.array(n[partner[at]], pa.int64()),
                     "form": pa.array([words[k] for k in partner[at]], pa.string())})


# --- cells and early edits --------------------------------------------------------

def with_cells(words: DataFrame, longest: int, cell: int = CELL) -> DataFrame:
    """``words`` with size (code points) and depth: the least prefix length, of a
    widening series, that at most ``cell`` words share; size + 1 where there is none."""
    series = [1, 2, 3, 4]
    while series[-1] <= longest:
        series += [series[-1] * 3 // 2, series[-1] * 2]
    steps = F.array(*[F.lit(k) for k in series])
    sized = words.withColumn("size", F.length("word"))
    prefixes = sized.select("word", F.explode(F.filter(steps, lambda k: k <= F.col("size"))).alias("k")).select(
        "word", "k", F.expr("xxhash64(k, substring(word, 1, k))").alias("prefix"))
    crowded = prefixes.groupBy("prefix").agg(F.count(F.lit(1)).alias("words")).filter(F.col("words") > cell)
    # A first letter may hold a third of all words: they are dealt over lots, and a
    # crowded prefix (one in ``cell`` words a step at most) stands in every lot.
    lots = crowded.select("prefix", F.explode(F.sequence(F.lit(0), F.lit(LOTS - 1))).alias("lot"))
    dealt = prefixes.withColumn("lot", F.pmod(F.xxhash64("word"), F.lit(LOTS)).cast("int"))
    deep = dealt.join(lots, ["prefix", "lot"], "left_semi").groupBy("word").agg(F.max("k").alias("k"))
    after = F.array_min(F.filter(steps, lambda k: k > F.coalesce("k", F.lit(0))))
    return sized.join(deep, "word", "left").select("word", "n", "size", F.least(after, F.col("size") + 1).alias("depth"))


def early_partners(words: DataFrame) -> DataFrame:
    """(word, near, form_n, form) for the pairs whose edit stands before the cell's depth."""
    cut = words.select("word", "n", F.explode(F.sequence(F.lit(1), F.least("depth", "size"))).alias("at")).select(
        "word", "n", "at", F.expr("concat(substring(word, 1, at - 1), substring(word, at + 1))").alias("rest"))
    # Replaced: words equal but for this place, one a letter at most; best and next best.
    member = F.struct((-F.col("n")).alias("less"), F.col("word"))
    group = (cut.groupBy("rest", "at").agg(F.sort_array(F.collect_list(member)).alias("all"))
             .filter(F.size("all") > 1)
             .select("all", F.posexplode("all").alias("place", "own")))
    best = F.when(F.col("place") == 0, F.col("all")[1]).otherwise(F.col("all")[0])
    replaced = group.select(F.col("own.word").alias("word"), (F.size("all") - 1).cast("long").alias("near"),
                            (-best["less"]).alias("form_n"), best["word"].alias("form"))
    # Deleted: the last of a run of equal code points, so that a pair meets once.
    met = (cut.filter(F.expr("substring(word, at, 1) <> substring(word, at + 1, 1)"))
           .join(words.select(F.col("word").alias("rest"), F.col("n").alias("rest_n")), "rest"))
    one = F.lit(1).cast("long").alias("near")
    return (replaced.unionByName(met.select("word", one, F.col("rest_n").alias("form_n"), F.col("rest").alias("form")))
            .unionByName(met.select(F.col("rest").alias("word"), one, F.col("n").alias("form_n"),
                                    F.col("word").alias("form"))))


def variants(words: DataFrame, cell: int = CELL) -> DataFrame:
    """word, form, root, n, n_near, form_n of a vocabulary (word, n) of distinct words.

    ``form`` is the near word of largest n where that is at least twice the word's;
    ``root`` the end of the chain of forms."""
    words = stored(words, "spelling-words")
    longest = words.agg(F.max(F.length("word"))).collect()[0][0] or 0
    placed = stored(with_cells(words, longest, cell), "spelling-cells")
    inside = (placed.filter(F.col("depth") <= F.col("size"))
              .select(F.expr("substring(word, 1, depth)").alias("cell"), "word", "n", "depth"))
    late = inside.groupBy("cell").applyInArrow(cell_partners, "word string, near long, form_n long, form string")
    found = (late.unionByName(early_partners(placed)).groupBy("word")
             .agg(F.sum("near").alias("n_near"),
                  F.min(F.struct((-F.col("form_n")).alias("less"), F.col("form").alias("best"))).alias("top")))
    clear = -F.col("top.less") >= 2 * F.col("n")
    told = stored(words.join(found, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(clear, F.col("top.best")).alias("form"), F.when(clear, -F.col("top.less")).alias("form_n")),
        "spelling-forms")
    return told.join(roots(told.filter(F.col("form").isNotNull()).select("word", F.col("form").alias("root"))),
                     "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def roots(links: DataFrame) -> DataFrame:
    """(word, root): the end of each chain of links, which double in length a round;
    n doubles at least at every link, so chains are short and end."""
    links = stored(links, "spelling-roots")
    while True:
        ahead = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        longer = stored(links.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"),
                                                                 F.col("next").isNotNull().alias("moved")),
                        "spelling-roots")
        links = longer.drop("moved")
        if longer.filter("moved").isEmpty():
            return links
