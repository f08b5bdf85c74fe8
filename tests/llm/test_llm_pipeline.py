"""The pipeline against a plain version of all its stages."""

import collections
import hashlib
import os
import sys

import numpy as np
import pyarrow.parquet as pq

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import brute  # noqa: E402

import corpus_pipeline  # noqa: E402
from tabulark.llm.catalog import byte_bpe_path  # noqa: E402

SMALL = "/root/testdata/sf0.001"


def test_pipeline(spark):
    from tokenizers import Tokenizer
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "ngram_join", "pii", "mixing", "bpe"]
    t = pq.read_table(f"{SMALL}/documents.parquet")
    docs = list(zip(t["doc_id"].to_pylist(), t["source"].to_pylist(), t["text"].to_pylist()))
    docs = [d for d in docs if brute.quality(d[2])["kept"]]
    group = brute.components([(i, x) for i, _, x in docs], 5, 80)
    docs = [d for d in docs if group[d[0]][1] == d[0]]
    told = brute.disclosing([x for _, _, x in docs])
    docs = [(i, s, brute.masked(x, told)) for i, s, x in docs]
    out = []
    for k, (passes, part) in brute.mix(docs).items():
        i, s, x = docs[k]
        out += [(i, s, x)] * passes
        if part:
            out.append((i, s, x if part == len(brute.words(x)) else brute.first_words(x, part)))
    tokenizer = Tokenizer.from_file(byte_bpe_path())
    want = collections.Counter()
    for i, s, x in out:
        ids = np.array(tokenizer.encode(x, add_special_tokens=False).ids, dtype="<u4").tobytes()
        want[i, s, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(x.encode()).hexdigest()] += 1
    rows = corpus_pipeline.run(spark, SMALL).collect()
    assert collections.Counter((r.doc_id, r.source, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows) == want
    assert all(hashlib.sha256(bytes(r.ids)).hexdigest() == r.ids_sha256 for r in rows)
