"""Permissive parse with quarantine.

A changed or broken source format must not stop a load: rows whose body
does not parse (bad JSON, or a value of the wrong type such as a price
``"abc"``), or that lack a required field, go to a quarantine DataFrame
with a reason; the rest continue.  One parse feeds both outputs: the
parser keeps the raw text of a malformed record in a corrupt-record field.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"


def tag_parsed(df: DataFrame, text_col: str, schema: T.StructType,
               required: list[str], parsed_col: str = "body",
               options: dict | None = None) -> DataFrame:
    """Every row with ``parsed_col`` and ``_reason``, which is null where nothing is wrong."""
    with_corrupt = T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType())])
    opts = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, **(options or {})}
    # The parse sits in a one-element generator: later filters on its fields
    # cannot be pushed beneath it, so each document is parsed exactly once
    # (a plain projection gets the parse copied into every pushed predicate).
    parsed = F.from_json(F.col(text_col), with_corrupt, opts)
    with_body = df.select("*", F.explode(F.array(parsed)).alias(parsed_col))
    reason = F.when(F.col(text_col).isNull(), F.lit("null body"))
    reason = reason.when(F.col(f"{parsed_col}.{CORRUPT}").isNotNull(), F.lit("not json"))
    for name in required:
        reason = reason.when(F.col(f"{parsed_col}.{name}").isNull(), F.lit(f"missing {name}"))
    return with_body.withColumn("_reason", reason)


def split_parsed(df: DataFrame, text_col: str, schema: T.StructType,
                 required: list[str], parsed_col: str = "body",
                 options: dict | None = None) -> tuple[DataFrame, DataFrame]:
    """Return ``(good, bad)``; ``good`` has ``parsed_col``, ``bad`` has ``reason``."""
    tagged = tag_parsed(df, text_col, schema, required, parsed_col, options)
    good = tagged.filter(F.col("_reason").isNull()).drop("_reason")
    good = good.withColumn(parsed_col, F.col(parsed_col).dropFields(CORRUPT))
    bad = tagged.filter(F.col("_reason").isNotNull()).select(
        *df.columns, F.col("_reason").alias("reason"))
    return good, bad
