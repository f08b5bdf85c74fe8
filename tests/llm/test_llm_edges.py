"""Nulls, empty and long texts, ties, repeated rows, empty tables, other columns."""

import collections
import os
import sys

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import brute  # noqa: E402

import corpus_pipeline  # noqa: E402
from tabulark.llm.catalog import QUERIES  # noqa: E402

MORE = "size long, label string, node long, row_key string, t int, token string, held_out string, score string"
DOCUMENTS = f"doc_id long, text string, lang string, source string, n_chars long, {MORE}"
LABELS = "doc_id long, quality int, toxic int, text string"
VECTORS = "vec_id long, embedding array<float>, label int, v string, leaf string"

LONG = " ".join(f"w{i % 7919}x{i % 13}" for i in range(60_000))
PROSE = " ".join(f"word{i}" for i in range(40))


def _documents():
    texts = [None, "", " \t\n", "one", "One", "two words", LONG, PROSE, PROSE, PROSE + " more", "a b c d e f g " * 30,
             "mail me at some.one@mail.example.com or +1 (555) 123-4567", "x" * 100_000, "é 漢字 \U0001f600 ñ"]
    rows = [(i, t, None if i % 3 else "en", None if i % 4 == 0 else f"s{i % 4}", None) for i, t in enumerate(texts)]
    rows += [(7, PROSE, "en", "s3", 1), (7, PROSE, "en", "s3", 1), (None, PROSE, None, None, None),
             (None, None, None, None, None), (3, "another text under a known id", None, "s1", 5)]
    return [r + (9, "L", 8, "k", 7, "tok", "h", "s") for r in rows]


def _vectors():
    ok = [(i, [float(i % 5), 1.0, float(i)], 0) for i in range(1, 30)]
    odd = [(100, None, 0), (200, [0.0, 0.0, 0.0], 0), (300, [1.0, None, 2.0], 0), (400, [1.0, float("nan"), 0.0], 0),
           (500, [float("inf"), 1.0, 1.0], 0), (600, [1.0, 2.0], 0), (None, [1.0, 1.0, 1.0], 0), (0, [2.0, 1.0, 7.0], 0),
           (0, [2.0, 1.0, 7.0], 0), (31, [2.0, 1.0, 7.0], 0), (700, [2.0, 1.0, 7.0], None)]
    return [r + ("v", "leaf") for r in ok + odd]


@pytest.fixture(scope="module")
def odd_dir(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("odd"))
    spark.createDataFrame(_documents(), DOCUMENTS).write.parquet(f"{d}/documents.parquet")
    labels = [(i, i % 2, (i + 1) % 2, "x") for i in range(10)] + [(3, None, 1, "x"), (None, 1, 1, "x"), (5, 7, 0, "x"),
                                                                 (4, 1, None, "x")]
    spark.createDataFrame(labels, LABELS).write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame(_vectors(), VECTORS).write.parquet(f"{d}/embeddings.parquet")
    return d


@pytest.fixture(scope="module")
def empty_dir(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("empty"))
    for name, kind in (("documents", DOCUMENTS), ("labels", LABELS), ("embeddings", VECTORS)):
        spark.createDataFrame([], kind).write.parquet(f"{d}/{name}.parquet")
    return d


NOT_BY_DOCUMENT = {"op2_neighbours", "op11_spelling", "op13_collocations"}


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_empty_tables(spark, empty_dir, key):
    assert QUERIES[key](spark, empty_dir).collect() == []


def test_pipeline_on_an_empty_table(spark, empty_dir):
    assert corpus_pipeline.run(spark, empty_dir).collect() == []


@pytest.mark.parametrize("key", [k for k in sorted(QUERIES) if k not in NOT_BY_DOCUMENT])
def test_one_row_a_document(spark, odd_dir, key):
    rows = QUERIES[key](spark, odd_dir).collect()
    assert collections.Counter(r.doc_id for r in rows) == collections.Counter(r[0] for r in _documents())


def test_join_of_odd_documents(spark, odd_dir):
    got = collections.defaultdict(set)
    for r in QUERIES["op1_ngram_join"](spark, odd_dir).collect():
        got[r.doc_id].add((r.n_shingles, r.component_id))
    assert got[0] == {(0, 0)} and got[2] == {(0, 2)} and got[4] == {(1, 3)} and got[5] == {(1, 5)}
    assert got[7] == got[8] == {(37, 7)} and got[9] == {(38, 7)}
    assert got[None] == {(37, 7), (0, None)}  # the prose without an id joins its copies


def test_quality_of_odd_documents(spark, odd_dir):
    by = {t: brute.quality(t) for t in {r[1] for r in _documents()} if t != LONG}
    docs = collections.defaultdict(list)
    for r in _documents():
        docs[r[0]].append(r[1])
    for r in QUERIES["op4_quality_rules"](spark, odd_dir).collect():
        if r.doc_id != 6:
            assert any(all(r[k] == v for k, v in by[t].items()) for t in docs[r.doc_id])


def test_neighbours_of_odd_vectors(spark, odd_dir):
    rows = QUERIES["op2_neighbours"](spark, odd_dir).collect()
    good = {r[0]: np.array(r[1], dtype=float) for r in _vectors()
            if r[0] is not None and r[1] and None not in r[1] and np.isfinite(r[1]).all() and any(r[1]) and len(r[1]) == 3}
    for q in (0, 700):
        want = sorted((float(np.sqrt(((v - good[q]) ** 2).sum())), i) for i, v in good.items() if i != q)[:10]
        mine = sorted((r["rank"], r.vec_id, r.score) for r in rows if r.query_id == q)
        assert [(d, i) for _, i, d in mine] == want  # ties by the smaller id
    assert {r.query_id for r in rows} == {0, 700}


def test_repeated_rows_mix_their_own_shares(spark, odd_dir):
    rows = QUERIES["op8_mixing"](spark, odd_dir).collect()
    assert all(0 <= r.taken <= 3 * r["size"] for r in rows)
    assert all(abs(sum(r.taken for r in rows if r.source == s) - next(r.target for r in rows if r.source == s)) <= 24
               for s in {r.source for r in rows})


def test_mixed_rows_hold_the_planned_words(spark, odd_dir):
    from tabulark.llm import mixing
    docs = spark.read.parquet(f"{odd_dir}/documents.parquet")
    out = mixing.mixed(docs)
    assert out.columns == docs.columns
    got = collections.Counter()
    for r in out.collect():
        assert r.n_chars == len(r.text)
        got[r.doc_id] += len(brute.words(r.text))
    want = collections.Counter()
    for r in mixing.plan(docs).collect():
        want[r.doc_id] += r.taken
    assert +got == +want


def test_deduplicated_keeps_one_of_each_group(spark, odd_dir):
    from tabulark.llm import ngram_join
    docs = spark.read.parquet(f"{odd_dir}/documents.parquet")
    out = ngram_join.deduplicated(docs)
    assert out.columns == docs.columns
    kept = collections.Counter((r.doc_id, r.text) for r in out.collect())
    assert kept[7, PROSE] == 1 and (8, PROSE) not in kept and (9, PROSE + " more") not in kept
    assert (None, PROSE) not in kept and kept[None, None] == 1 and kept[0, None] == 1 and kept[3, "one"] == 1
    assert (4, "One") not in kept and kept[3, "another text under a known id"] == 1


def test_sanitised_keeps_rows_and_columns(spark, odd_dir):
    from tabulark.llm import pii
    docs = spark.read.parquet(f"{odd_dir}/documents.parquet")
    out = pii.sanitised(docs)
    assert out.columns == docs.columns
    told = brute.disclosing([r[1] for r in _documents()])
    want = collections.Counter((r[0], r[1] if r[1] is None else brute.masked(r[1], told)) for r in _documents())
    assert collections.Counter((r.doc_id, r.text) for r in out.collect()) == want


def test_components_of_chains_and_stars(spark):
    from tabulark.llm.components import components
    links = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (101, 100)]
    got = {r.node: r.label for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 160)}


def test_hashes_do_not_depend_on_the_buffer():
    from tabulark.llm.words import Words
    texts = [b"alpha beta " + b"y" * 300, b"", b"\x0b", b"gamma alpha " + b"y" * 300 + b" abcdefgh abcdefghi"]
    whole = {}
    for part in ([t] for t in texts):
        w = Words(part)
        for i, h in enumerate(w.hashes().tolist()):
            whole[w.word(i)] = h
    w = Words(texts)
    assert [whole[w.word(i)] for i in range(len(w))] == w.hashes().tolist()
    assert len(set(whole.values())) == len(whole)


def test_encode_and_decode_are_a_round_trip(spark, odd_dir):
    from tabulark.llm import bpe
    from tabulark.llm.catalog import byte_bpe_path
    docs = spark.read.parquet(f"{odd_dir}/documents.parquet").select("doc_id", "text", "label")
    coded = bpe.encode(docs, byte_bpe_path(), keep=["doc_id", "text"])
    back = bpe.decode(coded, byte_bpe_path(), keep=["doc_id", "text", "n_tokens", "ids"]).collect()
    assert len(back) == len(_documents())
    assert all(r.decoded == (r.text or "") and len(r.ids) == 4 * r.n_tokens for r in back)


def test_batches_are_bounded_and_a_smaller_setting_stays(spark):
    from tabulark.llm.tables import BATCH_BYTES, bounded_batches
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    try:
        for given, want in (("64m", str(BATCH_BYTES)), ("67108864b", str(BATCH_BYTES)), ("1m", "1m")):
            spark.conf.set(name, given)
            bounded_batches(spark.range(1))
            assert spark.conf.get(name) == want
    finally:
        spark.conf.set(name, before)
