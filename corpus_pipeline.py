"""The corpus pipeline: raw documents to token ids.

Every stage takes the documents that the one before kept, and its decisions take
effect: rejected documents go, one document of each near-duplicate group stays,
personal data is masked in the texts, sources are repeated or cut to their
targets, and the texts that remain become token ids.  Each result is written as
Parquet under the shared checkpoint folder and read back.

Defined results: a null or empty text has no words, so the quality rules reject it;
of a near-duplicate group the row with the least id stays (an id before none, ties
by the text's hash), and rows equal in id and text count as one; a null source is a
source; very long texts are read whole; further columns pass through all stages
but the last; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulark.llm import bpe, mixing, ngram_join, pii, quality_rules
from tabulark.llm.catalog import byte_bpe_path
from tabulark.llm.tables import read, stored

#: The pipeline's near-duplicates: five words and a similarity of 0.8.
WORDS, PERCENT = 5, 80


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return quality_rules.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return ngram_join.deduplicated(docs, n=WORDS, percent=PERCENT)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data masked; n_chars follows the text."""
    done = pii.sanitised(docs)
    if "n_chars" in done.columns:
        done = done.withColumn("n_chars", F.length("text").cast("long"))
    return done


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target weight asks."""
    return mixing.mixed(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text (little-endian uint32 values), and their digests."""
    both = bpe.encode(docs, byte_bpe_path(), keep=["doc_id", "source"], decoded=True)
    return both.select("doc_id", "source", "n_tokens", "ids", F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


STAGES = [("quality_rules", quality), ("ngram_join", near_duplicates), ("pii", personal_data),
          ("mixing", mix), ("bpe", tokens)]

#: Suffix arrays, linked components and BPE are beyond one SQL statement.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
