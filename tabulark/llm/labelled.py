"""A bounded sample of labelled documents, for fitting classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import fold, hashed_sample, stored

FOLDS, HELD = 4, 2


def held_out() -> Column:
    return fold(FOLDS) == HELD


def sample(labels: DataFrame, label: str, rows: int) -> DataFrame:
    """(doc_id, label): about ``rows`` labelled ids outside the held-out fold
    (twice as many at most), those with the least hash; ids labelled twice take
    the greater label."""
    known = labels.select("doc_id", F.col(label).cast("int").alias("label")).filter(
        F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & ~held_out())
    known = stored(known.groupBy("doc_id").agg(F.max("label").alias("label")), "fit-known")
    return stored(hashed_sample(known, rows, "doc_id"), "fit-labels")
