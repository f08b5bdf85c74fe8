"""A Levenshtein automaton intersected with a lexicon trie, as one DFA.

States are sets of (trie node, edits so far).  A word entry accepts a word at
most ``edits`` insertions, deletions or substitutions away; a stem entry accepts
every word with a beginning at most ``edits`` away.  A word is told the entry of
fewest edits, a stem before a word where these are equal.  The DFA is built once from a bounded lexicon
and run over many words side by side: one table look-up a character, and a word
leaves as soon as no entry can match any more, mostly after a few characters.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

DEAD = 0


@dataclass(frozen=True)
class Entry:
    text: str
    stem: bool
    edits: int


class Automaton:
    def __init__(self, entries: list[Entry]):
        self.entries = entries
        letters = sorted({c for e in entries for c in e.text})
        self.letter = np.zeros(0x110000, dtype=np.uint8)  # 0: a character of no entry
        for i, c in enumerate(letters):
            self.letter[ord(c)] = i + 1
        child: list[dict[int, int]] = [{}]
        ends: list[list[int]] = [[]]
        for n, e in enumerate(entries):
            node = 0
            for c in e.text:
                sym = int(self.letter[ord(c)])
                if sym not in child[node]:
                    child[node][sym] = len(child)
                    child.append({})
                    ends.append([])
                node = child[node][sym]
            ends[node].append(n)
        # Most edits that some entry below a node allows.
        most = [0] * len(child)
        for node in range(len(child) - 1, -1, -1):
            most[node] = max([entries[n].edits for n in ends[node]] + [most[c] for c in child[node].values()],
                             default=0)

        def closed(states: set) -> frozenset:
            """With the skips of entries' characters; (-1 - n, edits) says that stem
            n was met with edits, and only what can do better goes on beside it."""
            todo = list(states)
            while todo:
                node, edits = todo.pop()
                for c in child[node].values() if node >= 0 else ():
                    if edits < most[c] and (c, edits + 1) not in states:
                        states.add((c, edits + 1))
                        todo.append((c, edits + 1))
            met = [(edits, -1 - node) for node, edits in states if node < 0]
            met += [(edits, n) for node, edits in states if node >= 0 and edits for n in ends[node]
                    if entries[n].stem and edits <= entries[n].edits]
            if met:
                edits, n = min(met)
                states = {s for s in states if s[0] >= 0 and s[1] < edits} | {(-1 - n, edits)}
            return frozenset(states)

        def step(states: frozenset, sym: int) -> frozenset:
            out = set()
            for node, edits in states:
                if node < 0:
                    out.add((node, edits))
                    continue
                if sym in child[node]:
                    out.add((child[node][sym], edits))
                for s, c in child[node].items():
                    if s != sym and edits < most[c]:
                        out.add((c, edits + 1))
                if edits < most[node]:
                    out.add((node, edits + 1))
            return closed(out)

        def found(states: frozenset) -> tuple[int, int] | None:
            """(entry, edits) of a word that ends here."""
            best = None
            for node, edits in states:
                if node < 0 and (best is None or edits < best[0]):
                    best = (edits, -1 - node)
                for n in ends[node] if node >= 0 else ():
                    if edits <= entries[n].edits and (best is None or (edits, n) < best):
                        best = (edits, n)
            return (best[1], best[0]) if best else None

        names: dict = {frozenset(): DEAD}
        rows: list = [[0] * (len(letters) + 1)]
        accept: list = [(-1, 0)]
        final: list = [True]  # the rest of the word does not matter

        def number(states: frozenset) -> int:
            if states not in names:
                names[states] = len(rows)
                stems = [n for node, edits in states if edits == 0 for n in ends[node] if entries[n].stem]
                alone = len(states) == 1 and min(states)[0] < 0  # a stem met, and nothing better ahead
                rows.append(None)
                accept.append((min(stems), 0) if stems else (found(states) or (-1, 0)))
                final.append(bool(stems) or alone)
                todo.append(states)
            return names[states]

        todo: list = []
        self.start = number(closed({(0, 0)}))
        while todo:
            states = todo.pop()
            at = names[states]
            if final[at]:
                rows[at] = [at] * (len(letters) + 1)
                continue
            rows[at] = [number(step(states, 0))] * (len(letters) + 1)  # as any character that leads nowhere
            for s in {s for node, _ in states if node >= 0 for s in child[node]}:
                rows[at][s] = number(step(states, s))
        self.table = np.array(rows, dtype=np.int32)
        self.accept = np.array([a for a, _ in accept], dtype=np.int32)
        self.edits = np.array([d for _, d in accept], dtype=np.int32)
        self.final = np.array(final)

    def __len__(self) -> int:
        return len(self.table)

    def match(self, points: np.ndarray, start: np.ndarray, end: np.ndarray):
        """(words that match, their entry, their edits); words are code point
        ranges of ``points``."""
        letters = self.letter[points]
        state = np.full(len(start), self.start, dtype=np.int32)
        live = np.flatnonzero(start < end)
        at = 0
        while len(live):
            state[live] = self.table[state[live], letters[start[live] + at]]
            at += 1
            live = live[~self.final[state[live]] & (start[live] + at < end[live])]
        hit = np.flatnonzero((self.accept[state] >= 0) & (start < end))
        return hit, self.accept[state[hit]], self.edits[state[hit]]
