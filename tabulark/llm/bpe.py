"""Byte-level BPE encoding and decoding with contiguous rank arrays.

A pre-token of up to ``SHORT`` bytes is held as two dense rows: the ids of its
parts and the merge ranks of neighbouring parts.  Each round scans the ranks
for the least (leftmost) one, replaces that part by the merged id, deletes the
boundary by shifting the row, and refreshes the two ranks beside it.  Rows of
many pre-tokens of like length are stacked, so one round advances all of them.
Longer pre-tokens take a linked list with a heap, where rescanning would be
quadratic; both give the same ids.

Pre-tokens repeat, so a task keeps two bounded generations of pre-token -> ids
and drops them at its end; the cache changes speed alone.  No shuffle takes place: lost
tasks are rerun, memory is bounded by chunk, cache and the longest text.

Defined results: null or empty text has no ids and decodes to the empty text;
added tokens standing in a text become their own ids, as the vocabulary file
asks; rows are independent, so ids may be null or repeated.
"""

from __future__ import annotations

import heapq
import json
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import bounded_batches, tidied
from .words import chunks, text_bytes

SHORT = 64
CACHE = 120_000  # pre-tokens a generation
ROWS = 8_192  # stacked words
NONE = np.int32(2**31 - 1)

#: Fixed value: how the byte-level vocabulary cuts text into pre-tokens.
PRE_TOKEN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
             r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")


def byte_letters() -> dict[str, int]:
    """The vocabulary's letter for each byte: printable Latin-1 bytes stand for
    themselves, the others follow from U+0100 on, in order."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Bpe:
    """One vocabulary: encodes and decodes texts."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec["pre_tokenizer"]
        if (model["type"] != "BPE" or spec["normalizer"] or pre["type"] != "ByteLevel"
                or pre["add_prefix_space"] or model.get("byte_fallback")
                or model.get("ignore_merges")):
            raise ValueError(f"{path}: only byte-level BPE without a normaliser is handled")
        letters = byte_letters()
        vocab = model["vocab"]
        size = max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])]) + 1
        self.bytes_of: list[bytes] = [b""] * size
        for token, i in vocab.items():
            self.bytes_of[i] = bytes(letters[c] for c in token)
        self.size = size
        self.byte_id = np.zeros(256, dtype=np.int32)
        for letter, b in letters.items():
            self.byte_id[b] = vocab[letter]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        key = np.array([vocab[a] * size + vocab[b] for a, b in pairs], dtype=np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
        order = np.argsort(key, kind="stable")
        self.pair_key, self.pair_rank = key[order], order.astype(np.int32)
        self.made = made.astype(np.int32)
        self.rank_of = dict(zip(key.tolist(), range(len(key))))
        self.added: dict[str, int] = {}
        for t in spec["added_tokens"]:
            if t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"]:
                raise ValueError(f"{path}: added token {t['content']!r} has unhandled flags")
            self.added[t["content"]] = t["id"]
            self.bytes_of[t["id"]] = t["content"].encode()
        self.pre = regex.compile(PRE_TOKEN)
        self.cut = (regex.compile("|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))))
                    if self.added else None)
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    # --- ranks ---------------------------------------------------------------

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merge rank of each pair of ids; NONE where the pair never merges."""
        key = left.astype(np.int64) * self.size + right  # part -1 stands for nothing
        at = np.searchsorted(self.pair_key, key)
        at[at == len(self.pair_key)] = 0
        return np.where((self.pair_key[at] == key) & (left >= 0) & (right >= 0),
                        self.pair_rank[at], NONE)

    def merge_rows(self, words: list[bytes]) -> list[bytes]:
        """Ids (little-endian uint32) of short words, by stacked rank arrays."""
        width = max(map(len, words))
        size = np.array([len(w) for w in words])
        flat = np.frombuffer(b"".join([w.ljust(width, b"\0") for w in words]), dtype=np.uint8)
        parts = self.byte_id[flat].reshape(len(words), width)
        parts[np.arange(width) >= size[:, None]] = -1
        ranks = np.full((len(words), width), NONE, dtype=np.int32)
        if width > 1 and len(self.pair_key):
            ranks[:, :-1] = self.ranks(parts[:, :-1], parts[:, 1:])
        out: list[bytes] = [b""] * len(words)
        live, left = np.arange(len(words)), size
        while True:
            rows = np.arange(len(live))
            least = ranks.argmin(axis=1)
            best = ranks[rows, least]
            over = best == NONE
            if over.any():
                blob, row = parts[over].astype("<u4").tobytes(), 4 * parts.shape[1]
                for k, (i, n) in enumerate(zip(live[over].tolist(), left[over].tolist())):
                    out[i] = blob[k * row:k * row + 4 * n]
                stay = np.flatnonzero(~over)
                if not len(stay):
                    return out
                live, left, least, best = live[stay], left[stay], least[stay], best[stay]
                used = int(left.max())
                parts, ranks = parts[stay, :used], ranks[stay, :used]
                rows = np.arange(len(live))
            width = parts.shape[1]
            # Merge into ``least`` and delete the boundary after it.
            columns = np.arange(width - 1)
            parts = np.where(columns <= least[:, None], parts[:, :-1], parts[:, 1:])
            ranks = np.where(columns < least[:, None], ranks[:, :-1], ranks[:, 1:])
            left = left - 1
            here = self.made[best]
            parts[rows, least] = here
            last = least + 1 >= left
            after = np.where(last, -1, parts[rows, np.where(last, 0, least + 1)])
            ranks[rows, least] = self.ranks(here, after)
            inner = np.flatnonzero(least > 0)
            ranks[inner, least[inner] - 1] = self.ranks(parts[inner, least[inner] - 1], here[inner])

    def merge_long(self, word: bytes) -> bytes:
        """Ids of a long word: linked parts and a heap of ranked pairs."""
        ids = self.byte_id[np.frombuffer(word, dtype=np.uint8)].tolist()
        n = len(ids)
        nxt, prev = list(range(1, n + 1)), list(range(-1, n - 1))
        rank = self.rank_of.get

        def push(i: int) -> None:
            j = nxt[i]
            if j < n:
                r = rank(ids[i] * self.size + ids[j])
                if r is not None:
                    heapq.heappush(heap, (r, i, ids[i], ids[j]))

        heap: list = []
        for i in range(n - 1):
            push(i)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = nxt[i] if ids[i] == a else n
            if j >= n or ids[j] != b:
                continue  # one of the two parts has merged meanwhile
            ids[i], ids[j] = int(self.made[r]), -1
            nxt[i] = nxt[j]
            if nxt[j] < n:
                prev[nxt[j]] = i
            push(i)
            if prev[i] >= 0:
                push(prev[i])
        return np.array([x for x in ids if x >= 0], dtype="<u4").tobytes()

    def learn(self, tokens: set[str]) -> None:
        """Bring every pre-token into the young generation."""
        if len(self.young) > CACHE:
            self.old, self.young = self.young, {}
        new = []
        for t in tokens - self.young.keys():
            known = self.old.get(t)
            if known is not None:
                self.young[t] = known
            else:
                new.append((t.encode(), t))
        new.sort(key=lambda x: len(x[0]))  # words of like length are stacked
        short = next((i for i, x in enumerate(new) if len(x[0]) > SHORT), len(new))
        for raw, t in new[short:]:
            self.young[t] = self.merge_long(raw)
        for k in range(0, short, ROWS):
            raws, names = zip(*new[k:min(k + ROWS, short)])
            self.young.update(zip(names, self.merge_rows(raws)))

    def forget(self) -> None:
        """Drop the cache: workers outlive tasks, and their memory is shared."""
        self.young, self.old = {}, {}
        pa.default_memory_pool().release_unused()

    # --- texts ---------------------------------------------------------------

    def pieces(self, text: str) -> list:
        """Pre-tokens of a text, with the ids of added tokens between them."""
        if self.cut is None or not any(t in text for t in self.added):
            return self.pre.findall(text)
        out, at = [], 0
        for m in self.cut.finditer(text):
            out += self.pre.findall(text[at:m.start()])
            out.append(self.added[m[0]])
            at = m.end()
        return out + self.pre.findall(text[at:])

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each text as little-endian uint32 values."""
        cut = [self.pieces(t.decode("utf-8", "replace")) for t in texts]
        tokens: set = set()
        for c in cut:
            tokens.update(c)
        special = {i: i.to_bytes(4, "little") for i in self.added.values()}
        self.learn(tokens - special.keys())
        table = self.young
        return [b"".join([table[t] if t.__class__ is str else special[t] for t in c])
                if special.keys() & set(c) else b"".join(map(table.__getitem__, c)) for c in cut]

    def decode(self, ids: bytes) -> str:
        """Text of little-endian uint32 ids; broken UTF-8 becomes U+FFFD."""
        table = self.bytes_of
        return b"".join(map(table.__getitem__, np.frombuffer(ids, dtype="<u4").tolist())).decode(
            "utf-8", "replace")


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Bpe:
    """The vocabulary of a file, read once in each Python worker."""
    return Bpe(path)


def _plain(docs: DataFrame, keep: list[str], column: str, kind: str) -> DataFrame:
    return bounded_batches(docs).select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)],
                                        F.col(column).cast(kind).alias("t"))


def _schema(slim: DataFrame, keep: list[str], more: str) -> str:
    return ", ".join([f"k{i} {slim.schema[f'k{i}'].dataType.simpleString()}"
                      for i in range(len(keep))] + [more])


def encode(docs: DataFrame, path: str, text: str = "text", keep: list[str] | None = None,
           decoded: bool = False) -> DataFrame:
    """Ids of every row's whole text: the ``keep`` columns, ids (binary, the ids
    as little-endian uint32 values) and n_tokens; with ``decoded`` also the text
    that ``decode`` gives for the ids, made by the same Python worker."""
    keep = ["doc_id"] if keep is None else keep
    slim = _plain(docs, keep, text, "string")
    more = ["ids", "n_tokens"] + ["decoded"] * decoded

    def run(batches):
        bpe = vocabulary(path)
        try:
            for batch in batches:
                texts = text_bytes(batch.column(len(keep)))
                for lo, hi in chunks(texts):
                    ids = bpe.encode(texts[lo:hi])
                    made = [pa.array(ids, type=pa.binary()),
                            pa.array([len(x) // 4 for x in ids], type=pa.int64())]
                    if decoded:
                        made.append(pa.array([bpe.decode(x) for x in ids], type=pa.string()))
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(i).slice(lo, hi - lo) for i in range(len(keep))] + made,
                        [f"k{i}" for i in range(len(keep))] + more)
        finally:
            bpe.forget()

    out = slim.mapInArrow(tidied(run), _schema(slim, keep, "ids binary, n_tokens long" + ", decoded string" * decoded))
    return out.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], *more)


def decode(rows: DataFrame, path: str, ids: str = "ids", keep: list[str] | None = None) -> DataFrame:
    """Text of every row's ids: the ``keep`` columns and decoded."""
    keep = ["doc_id"] if keep is None else keep
    slim = _plain(rows, keep, ids, "binary")

    def run(batches):
        bpe = vocabulary(path)
        for batch in batches:
            values = [b"" if v is None else v for v in batch.column(len(keep)).to_pylist()]
            for lo, hi in chunks(values):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(i).slice(lo, hi - lo) for i in range(len(keep))]
                    + [pa.array([bpe.decode(v) for v in values[lo:hi]], type=pa.string())],
                    [f"k{i}" for i in range(len(keep))] + ["decoded"])

    out = slim.mapInArrow(tidied(run), _schema(slim, keep, "decoded string"))
    return out.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], "decoded")


def digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens and the SHA-256 of the ids and of the text they decode to."""
    both = encode(docs, path, decoded=True)
    return both.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
