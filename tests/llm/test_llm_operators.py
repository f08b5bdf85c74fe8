"""Every operator against a plain version, an exact round trip or held-out labels."""

import collections
import hashlib
import math
import os
import sys
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import brute  # noqa: E402

from tabulark.llm.catalog import QUERIES, byte_bpe_path  # noqa: E402

SMALL, MIDDLE, LARGE = (f"/root/testdata/{s}" for s in ("sf0.001", "sf0.01", "sf0.1"))


@pytest.fixture(scope="module")
def texts():
    t = pq.read_table(f"{SMALL}/documents.parquet")
    return dict(zip(t["doc_id"].to_pylist(), t["text"].to_pylist()))


def test_ngram_join(spark, texts):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in QUERIES["op1_ngram_join"](spark, SMALL).collect()}
    assert got == brute.components(list(texts.items()), 4, 85)


@pytest.mark.parametrize("percent", [50, 80, 85, 90])
def test_ngram_join_of_small_sets(spark, percent):
    """Sets of 1 to 12 shingles beside those of a word more at the start."""
    from tabulark.llm import ngram_join
    rows = []
    for size in range(1, 13):
        words = " ".join(f"w{size}x{i}" for i in range(size + 3))
        rows += [(10 * size, words), (10 * size + 1, f"more {words}"), (10 * size + 2, f"yet more {words}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id)
           for r in ngram_join.join_components(docs, percent=percent).collect()}
    assert got == brute.components(rows, 4, percent)


@pytest.mark.parametrize("percent", [50, 85, 90])
def test_ngram_join_links_are_whole(spark, percent, monkeypatch):
    """Every pair of similar documents, inside a component as between groups, and their number."""
    from tabulark.llm import ngram_join
    monkeypatch.setattr(ngram_join, "GROUP", 8)
    monkeypatch.setattr(ngram_join, "QUERIES", 4)
    prose = [[f"{kind}{i}" for i in range(200)] for kind in "ab"]
    rows = []
    for k in range(40):  # near copies of two texts: one to three words changed, some the same twice
        words = list(prose[k % 2])
        for at in range(k % 3 + 1):
            words[(7 * k + 67 * at) % 200] = f"new{k // 3}"
        rows.append((k, " ".join(words)))
    rows += [(100 + k, rows[k][1]) for k in (0, 3, 8)] + [(200, "alone in this"), (201, ""), (202, None)]
    want = brute.links(rows, 4, percent)
    assert len(want) > 40
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found, _, links = ngram_join.joined(docs, "text", 4, percent)
    nodes = collections.defaultdict(list)
    for r in found.filter("node IS NOT NULL").collect():
        nodes[r.node].append(r.doc_id)
    pairs = [(x, y) for r in links.collect() for x in nodes[r.a] for y in nodes[r.b]]
    pairs += [(x, y) for ids in nodes.values() for x in ids for y in ids if x < y]
    assert sorted((min(p), max(p)) for p in pairs) == want  # each once
    got = {r.doc_id: r for r in ngram_join.join_components(docs, percent=percent, counted=True).collect()}
    number = collections.Counter(k for pair in want for k in pair)
    assert {k: r.n_links for k, r in got.items()} == {k: number[k] for k, _ in rows}
    assert {k: (r.n_shingles, r.component_id) for k, r in got.items()} == brute.components(rows, 4, percent)


def test_neighbours_recall(spark):
    t = pq.read_table(f"{LARGE}/embeddings.parquet")
    ids, v = t["vec_id"].to_numpy(), np.array(t["embedding"].to_pylist(), dtype=float)
    got = collections.defaultdict(list)
    for r in QUERIES["op2_neighbours"](spark, LARGE).collect():
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    queries = np.flatnonzero(ids % 100 == 0)
    assert sorted(got) == sorted(ids[queries])
    found = 0
    for i in queries:
        d = np.sqrt(((v - v[i]) ** 2).sum(axis=1))
        best = [j for j in np.lexsort((ids, d)) if j != i][:10]
        mine = sorted(got[ids[i]])
        assert [m[0] for m in mine] == list(range(1, 11))
        assert mine == sorted(mine, key=lambda m: (m[2], m[1]))
        at = dict(zip(ids.tolist(), d.tolist()))
        assert all(abs(at[m[1]] - m[2]) < 1e-12 for m in mine)
        found += len({m[1] for m in mine} & set(ids[best].tolist()))
    assert found >= 0.95 * 10 * len(queries)


def test_hmm_base_and_gain(spark):
    t = pq.read_table(f"{MIDDLE}/documents.parquet")
    words = {i: [*brute.lower_words(x), None] for i, x in zip(t["doc_id"].to_pylist(), t["text"].to_pylist())}
    held = {i for i in words if zlib.crc32(str(i).encode()) % 5 == 1}
    c = collections.Counter(w for i, ws in words.items() if i not in held for w in ws)
    total = sum(c.values())
    d = total + 0.5 * (len(c) + 1)
    rows = QUERIES["op3_hmm"](spark, MIDDLE).collect()
    gain = 0
    for r in rows:
        ws = words[r.doc_id]
        assert (r.held_out, r.n_tokens, r.train_tokens) == (r.doc_id in held, len(ws), total)
        assert r.n_known == sum(c[w] > 0 for w in ws)
        assert r.base_score == pytest.approx(sum(math.log10((c[w] + 0.5) / d) for w in ws))
        gain += (r.score - r.base_score) * r.held_out
    assert len(rows) == len(words) and gain > 0.2 * sum(len(words[i]) for i in held)


def test_hmm_forward_is_exact():
    """The scaled recursion against the sum over all state paths, and the counts
    of one training step against posterior sums over those paths."""
    from itertools import product

    from tabulark.llm import hmm
    rng = np.random.default_rng(0)
    model = hmm.Model.start(rng.dirichlet(np.ones(hmm.SYMBOLS)))
    for k in range(hmm.STATES):
        model.move[k] = rng.dirichlet(np.ones(hmm.STATES))
    seq = np.array([5, 900, 5, hmm.END])
    weight = {}
    for path in product(range(hmm.STATES), repeat=len(seq)):
        p = model.first[path[0]] * model.emit[seq[0], path[0]]
        for t in range(1, len(seq)):
            p *= model.move[path[t - 1], path[t]] * model.emit[seq[t], path[t]]
        weight[path] = p
    total = sum(weight.values())
    both = hmm.log_likelihood([seq, seq[:1]], model)
    assert both[0] == pytest.approx(math.log10(total))
    counts = hmm.expected(*hmm.stretches([seq]), model)
    moved = sum(p * sum(path[t - 1:t + 1] == (1, 2) for t in range(1, 4)) for path, p in weight.items()) / total
    assert counts[hmm.SYMBOLS + 2 + 1, 2] == pytest.approx(moved)
    assert counts[5, 3] == pytest.approx(sum(p * ((path[0] == 3) + (path[2] == 3)) for path, p in weight.items()) / total)


def test_hmm_stretches_count_every_token_and_transition_once():
    from tabulark.llm import hmm
    rng = np.random.default_rng(1)
    model = hmm.Model.start(rng.dirichlet(np.ones(hmm.SYMBOLS)))
    for size in (1, 2, hmm.STRETCH - 1, hmm.STRETCH, hmm.STRETCH + 1, 2 * hmm.STRETCH - 1, 2 * hmm.STRETCH, 1000):
        seqs = [rng.integers(0, hmm.OWN, size), rng.integers(0, hmm.OWN, 3), rng.integers(0, hmm.OWN, size)]
        rows, first = hmm.stretches(seqs)
        assert first.sum() == 3
        back, k = [], -1
        for row, is_first in zip(rows, first):
            row = row[row != hmm.PAD]
            if is_first:
                back.append(list(row))
            else:
                assert back[-1][-1] == row[0]
                back[-1] += list(row[1:])
        assert all(list(a) == b for a, b in zip(seqs, back))
        counts = hmm.expected(rows, first, model)
        plain = np.bincount(np.concatenate(seqs), minlength=hmm.SYMBOLS)
        assert counts[:hmm.PAD].sum(axis=1) == pytest.approx(plain[:hmm.PAD])
        assert counts[hmm.SYMBOLS].sum() == pytest.approx(3)
        assert counts[hmm.SYMBOLS + 2:].sum() == pytest.approx(2 * (size - 1) + 2)


def test_hmm_training_raises_the_likelihood(spark):
    """Against plain Baum-Welch rounds in this process, fold by fold."""
    from pyspark.sql import functions as F

    from tabulark.llm import hmm
    rng = np.random.default_rng(2)
    seqs = [(100 * (np.arange(n) // 7 % 2) + rng.integers(0, 20, n)).astype("<u2") for n in rng.integers(1, 200, 60)]
    train = spark.createDataFrame([(i, i, len(s), s.tobytes()) for i, s in enumerate(seqs)],
                                  "key long, doc_id long, n_tokens long, symbols binary")
    share = np.full(hmm.SYMBOLS, 1 / hmm.SYMBOLS)
    made = hmm.baum_welch(train, share, sweeps=1, rounds=1)
    fold = {r.key: r.f for r in train.select("key", F.pmod(F.xxhash64("doc_id", "n_tokens"), F.lit(hmm.FOLDS))
                                             .alias("f")).collect()}
    model, held = hmm.Model.start(share), np.zeros((hmm.COUNTS, hmm.STATES))
    start = hmm.log_likelihood(seqs, model).sum()
    for k in range(hmm.FOLDS):
        some = [s for i, s in enumerate(seqs) if fold[i] == k]
        if some:
            held = hmm.FADING * held + hmm.expected(*hmm.stretches(some), model)
            model = hmm.Model.from_counts(held, share)
    model = hmm.Model.from_counts(hmm.expected(*hmm.stretches(seqs), model), share)
    assert made.move == pytest.approx(model.move) and made.emit == pytest.approx(model.emit)
    assert hmm.log_likelihood(seqs, made).sum() > start


def test_quality_rules(spark, texts):
    for r in QUERIES["op4_quality_rules"](spark, SMALL).collect():
        want = brute.quality(texts[r.doc_id])
        assert {k: r[k] for k in want} == want, r.doc_id


def test_suffix_repeats_of_crafted_texts():
    from tabulark.llm.quality_rules import Rules, measure
    many = ["a " * 500, "a b " * 100 + "c", " ".join(map(str, range(50))) * 2, "x y z x y z x y z",
            "p q r s t u p q r s t", ""]
    got = measure([t.encode() for t in many], Rules(), spans=True)
    for i, t in enumerate(many):
        cover, longest = brute.repeats(brute.words(t), 5)
        assert (got["covered_words"][i], got["longest_repeat"][i]) == (cover, longest)
        assert sum(s["end"] - s["start"] for s in got["repeats"][i]) == cover


def test_bpe_equals_the_library(spark, texts):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(byte_bpe_path())
    for r in QUERIES["op5_bpe"](spark, SMALL).collect():
        ids = tokenizer.encode(texts[r.doc_id], add_special_tokens=False).ids
        back = tokenizer.decode(ids, skip_special_tokens=False)
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (
            len(ids), hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest(),
            hashlib.sha256(back.encode()).hexdigest())


def test_bpe_odd_texts():
    from hypothesis import given, settings
    from hypothesis import strategies as st
    from tokenizers import Tokenizer

    from tabulark.llm.bpe import vocabulary
    tokenizer, mine = Tokenizer.from_file(byte_bpe_path()), vocabulary(byte_bpe_path())

    @settings(max_examples=300, deadline=None)
    @given(st.one_of(st.text(), st.text(alphabet=" \t\n\r\x0b\x1c\x85　'sdtrevml1²é漢!<|endoftext|>")))
    def check(text):
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        coded = mine.encode([text.encode()])[0]
        assert np.frombuffer(coded, dtype="<u4").tolist() == ids
        assert mine.decode(coded) == tokenizer.decode(ids, skip_special_tokens=False)

    check()
    for text in ("a" * 3000, "<|endoftext|>" * 3 + "x<|endoftext|>", "ab" * 700 + "!" * 900):
        assert np.frombuffer(mine.encode([text.encode()])[0], dtype="<u4").tolist() == tokenizer.encode(
            text, add_special_tokens=False).ids


def test_sharding_law_and_groups(spark, texts):
    rows = QUERIES["op6_sharding"](spark, SMALL).collect()
    by = collections.defaultdict(list)
    groups = collections.defaultdict(set)
    for r in rows:
        raw = texts[r.doc_id].encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(raw) + 8, zlib.crc32(raw), "rows", None)
        by[r["shard"]].append(r.slot)
        groups[texts[r.doc_id]].add(r["shard"])
    assert sorted(by) == list(range(24)) and max(map(len, by.values())) - min(map(len, by.values())) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    assert all(len(s) == 1 for s in groups.values())


def test_sharding_fills_shards_with_a_large_group(spark):
    from tabulark.llm.sharding import shard
    docs = spark.createDataFrame([(i, "same" if i < 300 else f"t{i}") for i in range(600)], "doc_id long, text string")
    rows = shard(docs, shards=6).collect()
    counts = collections.Counter(r["shard"] for r in rows)
    assert set(counts.values()) == {100}
    hot = collections.Counter(r["shard"] for r in rows if r.doc_id < 300)
    assert hot.most_common(2)[1][1] >= 80  # not scattered evenly (50 each)


def test_sharding_goes_on_until_nothing_moves(spark):
    """A group that needs more than a dozen shards fills them one a round."""
    from tabulark.llm.sharding import shard
    docs = spark.createDataFrame([(i, "same" if i < 1200 else f"t{i}") for i in range(1500)], "doc_id long, text string")
    rows = shard(docs, shards=30).collect()
    assert set(collections.Counter(r["shard"] for r in rows).values()) == {50}
    hot = collections.Counter(r["shard"] for r in rows if r.doc_id < 1200)
    assert len(hot) < 30 and sum(sorted(hot.values())[-24:]) >= 0.9 * 1200  # 24 shards would hold them


def test_pii(spark, texts):
    told = brute.disclosing(list(texts.values()))
    for r in QUERIES["op7_pii"](spark, SMALL).collect():
        base = [f"{k}:{s}:{e}" for k, s, e in brute.identifiers(texts[r.doc_id])]
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        more = [f"term:{a}:{b}" for a, b, _ in brute.added(texts[r.doc_id], told)]
        assert r.spans == ",".join(base + more)
        kinds = collections.Counter(s.split(":")[0] for s in base)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(kinds[k] for k in ("email", "ip", "card", "phone"))


def test_pii_near_copies_are_one_witness(spark):
    """Two letters that differ by a word share an address: it goes, their words stay."""
    from tabulark.llm import pii
    letter = " ".join(f"usual{i} phrase{i}" for i in range(20))
    rows = [(0, f"{letter} first quill@mail.example.com"), (1, f"{letter} second quill@mail.example.com")]
    rows += [(10 + i, f"plain text number {i} with usual7 words") for i in range(200)]
    # The same in two letters that have nothing else in common.
    rows += [(300, "Brandt asks about the harvest of apples, brandt@mail.example.com"),
             (301, "yesterday came a long reply by Brandt on other matters: brandt@mail.example.com")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    told = brute.disclosing([t for _, t in rows])
    assert {w for _, w in told} == {b"brandt"}
    clean = {r.doc_id: r.text for r in pii.sanitised(docs).collect()}
    assert clean == {i: brute.masked(t, told) for i, t in rows}
    assert clean[0] == f"{letter} first [EMAIL]" and clean[10] == rows[2][1] and "Brandt" not in clean[300]
    rows = pii.report(docs).collect()
    assert {r.doc_id: r.n_email for r in rows if r.n_email} == {0: 1, 1: 1, 300: 1, 301: 1}


def test_pii_terms_that_disclose(spark):
    from tabulark.llm import pii
    rows = [(i, f"Word{i} Quillon writes from quill@mail.example.com about item {i} and more") for i in range(4)]
    rows += [(10 + i, f"some plain text about item {i} and more words number {i}") for i in range(60)]
    rows += [(90, "x@y"), (91, "+1 (2) 3456789 12.34.56.78 4111 1111 1111 1111 a@b.c"), (92, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    told = brute.disclosing([t for _, t in rows])
    out = {r.doc_id: r for r in pii.report(docs).collect()}
    for i, t in rows:
        more = [f"term:{a}:{b}" for a, b, _ in brute.added(t, told)]
        base = [f"{k}:{s}:{e}" for k, s, e in brute.identifiers(t)]
        assert out[i].spans == ",".join(base + more)
    assert "term" in out[0].spans and "term" not in out[10].spans
    clean = {r.doc_id: r.text for r in pii.sanitised(docs).collect()}
    assert clean == {i: t if t is None else brute.masked(t, told) for i, t in rows}
    assert "Quillon" not in clean[0] and clean[10] == rows[4][1]


def test_pii_terms_far_from_the_identifier(spark):
    from tabulark.llm import pii
    # Every letter has words of its own: near copies would be one witness.
    far = [" ".join(f"{w}{i}" for w in "one two three four five six seven eight nine ten".split()) for i in range(4)]
    rows = [(i, f"Quillon {far[i]} number {i} {far[i]} quill@mail.example.com {far[i]} Quillon") for i in range(4)]
    rows += [(10 + i, f"{far[i % 4]} number {i}") for i in range(60)] + [(90, f"Quillon {far[0]}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    clean = {r.doc_id: r.text for r in pii.sanitised(docs).collect()}
    assert not any("Quillon" in t for t in clean.values()) and clean[10] == rows[4][1]
    assert all(far[i] in clean[i] and "[EMAIL]" in clean[i] for i in range(4))


def test_pii_forms_at_random():
    import random

    from tabulark.llm.pii import base_spans
    rnd = random.Random(3)
    for letters in ("a1.@-", "12.9 ", "0+( )-.1", "é@a.b%"):
        for _ in range(5000):
            t = "".join(rnd.choice(letters) for _ in range(rnd.randint(0, 24)))
            assert base_spans(t) == brute.identifiers(t), t
    assert base_spans("9" * 200_000 + "a" * 200_000 + "@" * 50_000 + "+1" * 20_000) is not None  # in linear time


def test_mixing_follows_enumerated_seats(spark):
    t = pq.read_table(f"{SMALL}/documents.parquet")
    rows = list(zip(t["doc_id"].to_pylist(), t["source"].to_pylist(), t["text"].to_pylist()))
    want = brute.mix(rows)
    got = {r.doc_id: (r.passes, r.part) for r in QUERIES["op8_mixing"](spark, SMALL).collect()}
    assert got == {rows[i][0]: v for i, v in want.items()}


def test_mixing_quotas_are_house_monotone(spark):
    from tabulark.llm.mixing import quotas, streams, sized, targets
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    with_targets = targets(streams(sized(docs, 1))[1])
    by = collections.defaultdict(int)
    for r in quotas(with_targets, 16, 5).collect():
        assert r.blocks >= 0
        by[r["shard"]] += r.blocks
    total = with_targets.first().total
    assert sum(by.values()) == int(total / 16 + 0.5) and max(by.values()) - min(by.values()) <= 1


def _accuracy(spark, key, label):
    labels = {r.doc_id: r[label] for r in spark.read.parquet(f"{LARGE}/labels.parquet").collect()}
    rows = [r for r in QUERIES[key](spark, LARGE).collect() if r.held_out and r.doc_id in labels]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    pairs = [(r.predicted, labels[r.doc_id]) for r in rows]
    both = sum(p and y for p, y in pairs)
    return both / max(1, sum(p for p, _ in pairs)), both / sum(y for _, y in pairs)


def test_toxicity_on_held_out_labels(spark):
    precision, recall = _accuracy(spark, "op9_toxicity", "toxic")
    assert precision > 0.93 and recall > 0.82


def test_quality_on_held_out_labels(spark):
    precision, recall = _accuracy(spark, "op10_quality", "quality")
    assert precision > 0.97 and recall > 0.97


def test_toxic_lexicon_keeps_every_term_that_passes():
    from tabulark.llm.toxicity import selected
    names = [f"{a}{b}{c}word" for a in "bcdfg" for b in "aeiou" for c in "lmnr"]
    entries, weights = selected({(False, t): 60 + i for i, t in enumerate(names)}, {}, 450, 2500)
    assert sorted(e.text for e in entries) == sorted(names) and len(weights) == 100


def test_automaton_accepts_one_edit_and_stems():
    from tabulark.llm.automaton import Automaton, Entry
    from tabulark.llm.toxicity import Words32

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(new[-1] + 1, row[j] + 1, row[j - 1] + (x != y)))
            row = new
        return row[-1]

    entries = [Entry("trash", False, 1), Entry("scum", False, 0), Entry("réeu", True, 0)]
    a = Automaton(entries)
    rng = np.random.default_rng(1)
    some = ["trash", "trassh", "tr4sh", "rash", "trahs", "scum", "scums", "réeuxment", "réeu", "réx", "", "trashes"]
    for base in ("trash", "scum", "réeu"):
        for _ in range(300):
            w = list(base)
            for _ in range(rng.integers(0, 3)):
                w.insert(rng.integers(0, len(w) + 1), "abrtshé"[rng.integers(0, 7)])
                if rng.random() < 0.5:
                    del w[rng.integers(0, len(w))]
            some.append("".join(w))
    w = Words32([" ".join(some).encode()])
    names = [w.points[s:e].tobytes().decode("utf-32-le") for s, e in zip(w.start, w.end)]
    hit = {names[i]: (n, d) for i, n, d in zip(*(x.tolist() for x in a.match(w.points, w.start, w.end)))}
    for x in names:
        if x.startswith("réeu"):
            want = (2, 0)
        elif distance(x, "trash") <= 1:
            want = (0, distance(x, "trash"))
        else:
            want = (1, 0) if x == "scum" else None
        assert hit.get(x) == want, x


def test_toxic_families_and_misspelt_stems():
    from tabulark.llm.automaton import Automaton
    from tabulark.llm.toxicity import Detector, Words32, selected
    told = {(False, "idiot"): 200, (True, "idiot"): 200, (False, "idiotic"): 90, (False, "scum"): 90,
            (False, "worth"): 80, (False, "worthless"): 100}
    entries, weights = selected(told, {}, 450, 2500)
    assert {(e.text, e.stem) for e in entries} == {("idiot", False), ("idiot", True), ("scum", False),
                                                   ("worth", False), ("worthless", False)}
    texts = ["idiotic", "idoitic", "idxotic", "scvm", "idiot's", "¡idiotas!", "you—scum", "wortless", "some", "scu idi"]
    w = Words32([t.encode() for t in texts])
    word, entry, edits, form = Detector(entries, weights).hits(w)
    doc = (w.first.searchsorted(word, "right") - 1).tolist()
    assert {texts[d]: (entries[n].text, k) for d, n, k in zip(doc, entry.tolist(), edits.tolist())} == {
        "idiotic": ("idiot", 0), "idxotic": ("idiot", 1), "scvm": ("scum", 1), "idiot's": ("idiot", 0),
        "¡idiotas!": ("idiot", 0), "you—scum": ("scum", 0), "wortless": ("worthless", 1), "scu idi": ("scum", 1)}
    assert form[edits > 0].tolist() == ["idxotic", "scvm", "wortless", "scu"]
    # A beginning of the word is at most one edit away: against all of them.
    a = Automaton([e for e in entries if e.stem])

    def away(x, y):
        if x == y:
            return 0
        i = next((i for i, (p, q) in enumerate(zip(x, y)) if p != q), min(len(x), len(y)))
        return 1 if x[i + 1:] in (y[i + 1:], y[i:]) or x[i:] == y[i + 1:] else 2

    rng = np.random.default_rng(4)
    some = ["".join(rng.choice(list("idotx"), rng.integers(1, 9))) for _ in range(3000)]
    some += ["idiot"[:i] + c + "idiot"[j:] + "ix" for i in range(6) for j in range(6) for c in ("", "i", "x", "to")]
    w = Words32([" ".join(some).encode()])
    hit, _, edits = a.match(w.points, w.start, w.end)
    got = dict(zip(hit.tolist(), edits.tolist()))
    for i, x in enumerate(some):
        best = min(away(x[:n], "idiot") for n in range(len(x) + 1))
        assert got.get(i) == (best if best < 2 else None), x


def test_quoted_hits_count_less():
    from tabulark.llm.automaton import Entry
    from tabulark.llm.toxicity import Detector
    d = Detector([Entry("moron", False, 1)], [3.0], frozenset({"oron"}))
    got = d.measure([b'you moron, you mor0n', b'he wrote "you moron" there', b"an oron here", b""])
    assert got["f_exact"][0] > 0 and got["f_near"][0] > 0 and got["f_quoted"].tolist()[1] > 0
    assert got["f_abuse"][1] < got["f_abuse"][0] and got["f_any"].tolist() == [1, 1, 0, 0]


def test_isotonic_pooling():
    from tabulark.llm.quality_classifier import pooled
    at, value = pooled(np.arange(5.0), np.ones(5), np.array([0, 1, 0, 1, 1.0]))
    assert value.tolist() == [0, 0.5, 1] and at.tolist() == [0, 1.5, 3.5]
