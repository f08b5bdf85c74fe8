"""Spelling variants, token files and collocations against plain versions."""

import collections
import os
import random
import re
import sys
import zlib

import duckdb
import numpy as np
import pyarrow.parquet as pq
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import brute  # noqa: E402

from tabulark.llm import hat_trie, phrases, rans, spelling, token_files  # noqa: E402
from tabulark.llm.bitmap import Bitmap  # noqa: E402
from tabulark.llm.catalog import ORACLE, QUERIES, byte_bpe_path  # noqa: E402
from tabulark.session import scratch_path  # noqa: E402

SMALL, MIDDLE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"

ODD = [(None, None), (1, ""), (2, " \t\n"), (3, "Straße STRASSE Ünder ünder under, under; under. Under"), (None, "null keyed words words words"),
       (4, "x" * 50_000 + " " + "x" * 50_000 + " " + "x" * 50_000 + " " + "x" * 49_999), (5, "aaaaa aaaaa aaaaa aaaaaa aaaaaa aaaaaa aaaa"),
       (6, "a b c d e f g. " * 40), (6, "a b c d e f g. " * 40), (7, "tab\tand  two   spaces\x0bpiece\x0cpiece " * 35),
       (8, "\u6f22\u5b57 \U0001f600 \u00e9t\u00e9 \u00e9t\u00e9s\u00d7 \u00e9t\u00e9s\u00d7\u00f7 " * 31), (9, "<|endoftext|> word" * 3)]
KINDS = "doc_id long, text string, lang string, word string, n long, file int, prefix string, k string"


def _odd(spark):
    rows = [(k, t, None if i % 3 == 0 else ("und" if i % 3 == 1 else "en"), "w", 1, 2, "p", "k") for i, (k, t) in enumerate(ODD)]
    return spark.createDataFrame(rows, KINDS), rows


# --- spelling variants --------------------------------------------------------------

def _variants(df):
    rows = df.collect()
    out = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(out) == len(rows)
    return out


def test_spelling_variants(spark):
    t = pq.read_table(f"{SMALL}/documents.parquet")
    want = brute.variants(brute.vocabulary(zip(t["doc_id"].to_pylist(), t["text"].to_pylist())))
    assert _variants(QUERIES["op11_spelling"](spark, SMALL)) == want and len(want) > 1000


@pytest.mark.parametrize("cell", [1, 3, 40, 4096])
def test_spelling_cells_change_nothing(spark, cell):
    """Few letters, so that all edits of all places meet, however small the cells."""
    draw = random.Random(cell)
    words = {"".join(draw.choice("ab\u00e9") for _ in range(draw.randint(5, 9))): draw.randint(3, 90) for _ in range(900)}
    words |= {"a" * k: 3 * 2 ** (k % 7) for k in range(5, 60)}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    assert _variants(spelling.variants(df, cell)) == brute.variants(words)


def test_spelling_chain_and_ties(spark):
    words = {"abcde": 3, "abcdx": 6, "abcyx": 12, "abzyx": 24, "qwert": 5, "qwerz": 10, "qwera": 10, "alone": 9}
    got = _variants(spelling.variants(spark.createDataFrame(list(words.items()), "word string, n long")))
    assert got == brute.variants(words)
    assert got["abcde"][1] == "abzyx" and got["qwert"][0] == "qwera" and got["alone"] == (None, "alone", 9, 0, None)


def test_spelling_of_odd_texts(spark):
    docs, rows = _odd(spark)
    assert _variants(spelling.variants(spelling.vocabulary(docs))) == brute.variants(brute.vocabulary(r[:2] for r in rows))
    words = {r.word: r.n for r in spelling.vocabulary(docs, drop=None, letters=1, count=1).collect()}
    assert words == brute.vocabulary([r[:2] for r in rows], drop=None, letters=1, count=1)


def test_acceptor_is_minimal():
    a = spelling.Acceptor(sorted(["walked", "talked", "walking", "talking", "walks", "talks"]))
    assert len(a.final) == 9  # after w and t all is one, and the endings share their last state
    i, j = spelling.composed(a)
    assert sorted(zip(i.tolist(), j.tolist())) == [(0, 3), (1, 4), (2, 5)]


# --- token files ----------------------------------------------------------------------

def _files_of(rows):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(byte_bpe_path())
    return [(k, np.array(t.encode(x or "", add_special_tokens=False).ids + [2], dtype="<u4").tobytes()) for k, x in rows]


def test_token_files(spark):
    t = pq.read_table(f"{SMALL}/documents.parquet")
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in QUERIES["op12_token_files"](spark, SMALL).collect()}
    want, start = {}, 0
    for k, ids in sorted(_files_of(zip(t["doc_id"].to_pylist(), t["text"].to_pylist()))):
        want[k] = (start, len(ids) // 4, zlib.crc32(ids))
        start += len(ids) // 4
    assert got == want


@pytest.mark.parametrize("block", [1, 300, 65_536])
def test_token_files_of_odd_texts(spark, block):
    docs, rows = _odd(spark)
    folder = scratch_path(spark, "t-tokens")
    token_files.write(docs, folder, byte_bpe_path(), block=block)
    got = token_files.read(spark, folder).orderBy("start").collect()
    key = lambda k: (k is not None, k or 0)  # noqa: E731  null keys first
    assert [r.doc_id for r in got] == sorted((r[0] for r in rows), key=key)
    assert collections.Counter((r.doc_id, bytes(r.ids)) for r in got) == collections.Counter(_files_of(r[:2] for r in rows))
    at = 0
    for r in got:
        assert (r.start, r.n_tokens) == (at, len(r.ids) // 4)
        at += r.n_tokens


def test_token_files_tell_damage(spark):
    docs, _ = _odd(spark)
    folder = scratch_path(spark, "t-damage")
    token_files.write(docs, folder, byte_bpe_path())
    from pyspark.sql import functions as F
    blocks = spark.read.parquet(f"{folder}/blocks").withColumn("words", F.expr("overlay(words placing X'00112233' from 5)"))
    for part in ("table", "files"):
        spark.read.parquet(f"{folder}/{part}").write.parquet(f"{folder}-bad/{part}")
    blocks.write.partitionBy("file").parquet(f"{folder}-bad/blocks")
    with pytest.raises(Exception, match="damaged"):
        token_files.read(spark, f"{folder}-bad").collect()


def test_long_texts_are_cut_where_nothing_changes():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(byte_bpe_path())
    draw = random.Random(3)
    text = "".join(draw.choice(["a", "bc", " ", "  ", "\n", "'s", "12", " \u00e9", "!", " don't"]) for _ in range(4000))
    cut = token_files.pieces(text, 50)
    assert "".join(cut) == text and len(cut) > 20
    assert [i for p in cut for i in t.encode(p).ids] == t.encode(text).ids
    assert token_files.pieces("y" * 500, 50) == ["y" * 500]


@pytest.mark.parametrize("seed", range(8))
def test_rans_round_trip(seed):
    draw = np.random.default_rng(seed)
    ids = np.sort(draw.choice(60_000, draw.integers(1, 2_000), replace=False)).astype(np.uint32)
    weight = draw.dirichlet(np.full(len(ids), 0.05))
    blocks = [ids[draw.choice(len(ids), n, p=weight)] for n in (1, 31, 32, 33, 16_384, 16_385, 40_000)]
    counts = np.bincount(np.searchsorted(ids, np.concatenate(blocks)), minlength=len(ids))
    share, bits = rans.frequencies(counts[counts > 0])
    assert share.sum() == 1 << bits and share.min() >= 1
    coder = rans.Coder(ids[counts > 0], share, bits)
    made = coder.encode(blocks)
    assert all(np.array_equal(a, b) for a, b in zip(coder.decode(made), blocks))
    p = counts[counts > 0] / counts.sum()
    best = -(p * np.log2(p)).sum() * len(blocks[-1]) / 8
    assert len(made[-1].words) < 1.1 * best + 400
    assert len(made[-1].offsets) == -(-len(blocks[-1]) // (rans.LANES * rans.CHECK))


# --- collocations ----------------------------------------------------------------------

def test_collocations_match_their_sql(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{MIDDLE}/documents.parquet')")
    got = QUERIES["op13_collocations"](spark, MIDDLE)
    want = con.sql(ORACLE["op13_collocations"])
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())


@pytest.mark.parametrize("least, top", [(1, 2000), (2, 7), (30, 2000)])
def test_collocations_of_odd_texts(spark, least, top):
    docs, rows = _odd(spark)
    got = [tuple(r) for r in phrases.collocations(docs, least=least, top=top).collect()]
    assert len(got) == len(set(got)) and set(got) == brute.collocations([(r[2], r[1]) for r in rows], least, top)


def test_sequences_with_small_tries(spark):
    """Spills in the middle of a task change no count, nor does another hash."""
    docs, rows = _odd(spark)
    want = collections.Counter()
    for r in rows:
        for piece in re.split(b"[.,;:!?\n-\r]", brute.lower(r[1]).encode()):
            w = piece.split()
            want.update((r[2] or "und", b" ".join(w[i:i + 2]).decode()) for i in range(len(w) - 1))
    for held, seed in ((1, 0), (5, 1), (10 ** 6, 2)):
        counts = phrases.word_counts(docs, seed=seed)
        words = Bitmap(counts.select("id"), "id")
        found = phrases.sequences(docs.coalesce(1), words, None, seed=seed, held=held)
        got = {(r.lang, r.phrase): r.n for r in phrases.spelt(found, counts).collect()}
        assert got == dict(want)


@pytest.mark.parametrize("width", [2, 4])
def test_hat_trie_bursts_and_spills(width):
    draw = np.random.default_rng(1)
    trie, want, spilt = hat_trie.HatTrie(width, burst=8), collections.Counter(), collections.Counter()
    for _ in range(200):
        keys = draw.integers(1, 7, (20, width))
        keys[:, 2:] *= draw.integers(0, 2, (20, max(width - 2, 0)))
        keys, n = phrases.counted_rows(list(keys.T))
        assert n.sum() == 20
        trie.add(keys, n)
        want.update({tuple(k): c for k, c in zip(keys.tolist(), n.tolist())})
        if trie.size > 300:
            for run, counts in trie.spill(150, run=40):
                assert not set(run[:, 0].tolist()) & set(trie.root)  # whole subtrees, sorted
                assert run.tolist() == sorted(run.tolist())
                spilt.update({tuple(k): c for k, c in zip(run.tolist(), counts.tolist())})
            assert trie.size <= 150
    assert width == 2 or any(c.__class__ is hat_trie.Branch for c in trie.root.values())
    for run, counts in trie.spill(0):
        spilt.update({tuple(k): c for k, c in zip(run.tolist(), counts.tolist())})
    assert spilt == want and trie.size == 0


def test_repeated_parts_are_encoded_once():
    """Short parts that stand in other surroundings are one part: what stands before them is no part of them."""
    import public_tokenizers
    from tabulark.llm import token_files
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        made = token_files.Encoder(f.read())
    asked, parts = [], made.parts
    made.parts = lambda some: asked.append(len(some)) or parts(some)
    texts = [" ".join(w + t for w in ("ab", "", "cd", "elephants") for t in ("x", "y", "zz")).encode() for _ in range(50)]
    texts += [b"", b" ", "  é   x\t\n y".encode(), b"x" * 30]
    got = made.encode(texts)
    want = [e.ids for e in made.library.encode_batch_fast([t.decode() for t in texts], add_special_tokens=False)]
    assert [x.tolist() for x in got] == want
    assert asked == [len(set(asked_parts(texts)))]


def test_parts_are_encoded_in_runs_and_fall_apart_by_their_bytes(monkeypatch):
    import public_tokenizers
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        spec = f.read()
    made = token_files.Encoder(spec)
    draw, bits = random.Random(5), ["a", "bc", " ", "  ", "\n", "'s", "12", " \u00e9", "\u00e9", "!", " don't", "\u00a0", "\u3000",
                                    "\u6f22", " \U0001f600", "<|endoftext|>", " <|endoftext|>", "\t", "\0", " '", " \u2009x", "\u0301"]
    texts = ["".join(draw.choice(bits) for _ in range(draw.randrange(60))) for _ in range(3000)] + ["", " "]
    want = [made.library.encode(t, add_special_tokens=False).ids for t in texts]
    raw, asked, ids = [t.encode() for t in texts], [], made.ids
    made.ids = lambda some: asked.append(len(some)) or ids(some)
    assert [x.tolist() for x in made.encode(raw)] == want
    words = [f" w{k}".encode() for k in range(10_000)]
    del asked[:]
    flat, low, count = made.parts(words)
    assert asked[0] < 30 and flat[low[7]:low[7] + count[7]].tolist() == made.library.encode(" w7").ids
    other = token_files.Encoder(spec)
    other.bytes_of = np.ones_like(made.bytes_of)  # bytes that do not meet the parts: each is encoded alone
    assert [x.tolist() for x in other.encode(raw)] == want
    made.parts = lambda some: pytest.fail("asked again") if some else (np.empty(0, "<u4"), *np.empty((2, 0), np.int64))
    short = [t for t in raw if len(t) <= token_files.SHORT]
    assert [x.tolist() for x in made.encode(short)] == [made.library.encode(t.decode()).ids for t in short]
    for run, known in ((1, 0), (40, 10), (40, 5_000)):
        monkeypatch.setattr(token_files, "RUN", run)
        monkeypatch.setattr(token_files, "KNOWN", known)
        made = token_files.Encoder(spec)
        for lo in range(0, len(raw), 500):
            assert [x.tolist() for x in made.encode(raw[lo:lo + 500])] == want[lo:lo + 500]
        assert len(made.known[0]) <= known and (np.diff(made.known[0].astype(object)) > 0).all()


def asked_parts(texts):
    from tabulark.llm import token_files
    for t in texts:
        at = [0, *token_files.cuts(t).tolist(), len(t)]
        yield from (t[a:b] for a, b in zip(at, at[1:]))
