"""Registered queries of the training-data operators.

One query ``opN_<name>`` each applies the operator with production parameters
to its whole table and derives the digest columns from its results.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (bpe, hmm, mixing, neighbours, ngram_join, phrases, pii, quality_classifier, quality_rules,
               sharding, spelling, token_files, toxicity)
from .mixing_sql import mix_sql
from .phrases_sql import collocations_sql
from .tables import read

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    def add(fn: Query) -> Query:
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql
        return fn
    return add


def byte_bpe_path() -> str:
    """Place of the public byte-level vocabulary on this machine."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


@register("op4_quality_rules")
def op4(spark, sf_dir):
    return quality_rules.with_verdict(quality_rules.quality_measures(read(spark, sf_dir, "documents")))


@register("op5_bpe")
def op5(spark, sf_dir):
    return bpe.digests(read(spark, sf_dir, "documents"), byte_bpe_path())


@register("op8_mixing", mix_sql())
def op8(spark, sf_dir):
    return mixing.plan(read(spark, sf_dir, "documents")).drop("row_key")


@register("op6_sharding")
def op6(spark, sf_dir):
    return sharding.shard(read(spark, sf_dir, "documents"))


@register("op1_ngram_join")
def op1(spark, sf_dir):
    return ngram_join.join_components(read(spark, sf_dir, "documents"))


@register("op2_neighbours")
def op2(spark, sf_dir):
    return neighbours.nearest(read(spark, sf_dir, "embeddings"), lambda key: key % 100 == 0)


@register("op7_pii")
def op7(spark, sf_dir):
    return pii.report(read(spark, sf_dir, "documents"))


@register("op3_hmm")
def op3(spark, sf_dir):
    return hmm.scores(read(spark, sf_dir, "documents"))


@register("op9_toxicity")
def op9(spark, sf_dir):
    return toxicity.scores(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@register("op10_quality")
def op10(spark, sf_dir):
    return quality_classifier.scores(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@register("op11_spelling")
def op11(spark, sf_dir):
    return spelling.variants(spelling.vocabulary(read(spark, sf_dir, "documents")))


@register("op12_token_files")
def op12(spark, sf_dir):
    return token_files.digests(read(spark, sf_dir, "documents"), byte_bpe_path())


@register("op13_collocations", collocations_sql())
def op13(spark, sf_dir):
    return phrases.collocations(read(spark, sf_dir, "documents"))
