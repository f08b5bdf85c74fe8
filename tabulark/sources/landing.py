"""Landed pages of the courier-service API (S7, S8) and a JDBC cursor read.

The API is paged; each fetched page is landed unchanged as JSON lines under
``<landing>/<feed>/`` and never rewritten (history kept, R1).  Loads read
the landed files with an explicit schema (no inference pass); a line that
does not match the schema is kept aside with its raw text instead of
failing the load (R3).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import DATETIME_FORMAT
from ..operators.quarantine import split_parsed

# Fixed value: text format of times in landed pages.
PAGE_TIME_FORMAT = DATETIME_FORMAT


def land_pages(pages: DataFrame, path: str) -> None:
    """Append fetched pages as JSON lines (one object per line), gzipped at a fast level:
    a line names every field, so the text is many times the packed size at any level."""
    (pages.write.mode("append")
     .option("compression", "gzip")
     .option("zlib.compress.level", "THREE")
     .option("timestampNTZFormat", PAGE_TIME_FORMAT)
     .option("timestampFormat", PAGE_TIME_FORMAT)
     .json(path))


def read_pages(spark: SparkSession, path: str, schema: T.StructType,
               required: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Landed pages as typed rows, plus the lines that did not parse.

    Lines are read as text and parsed once with the schema, so a malformed
    line keeps its raw text in the rejected set with a reason.
    """
    lines = spark.read.text(path)
    opts = {"timestampNTZFormat": PAGE_TIME_FORMAT, "timestampFormat": PAGE_TIME_FORMAT}
    good, bad = split_parsed(lines, "value", schema, required or [], options=opts)
    rows = good.select(*[F.col(f"body.{f.name}").alias(f.name) for f in schema.fields])
    return rows, bad.select(F.col("value").alias("raw_line"), "reason")


def read_jdbc_by_id(spark: SparkSession, url: str, table: str, id_col: str, after_id: int,
                    upper_id: int, num_partitions: int, properties: dict | None = None) -> DataFrame:
    """Id-cursor scan of a relational source (S4-S6) read in parallel ranges.

    The cursor predicate goes into the source query, and ``numPartitions``
    ranges of ``id_col`` are read by as many tasks.  (No database runs in this
    environment, so this reader is not exercised by the tests.)
    """
    query = f"(SELECT * FROM {table} WHERE {id_col} > {int(after_id)}) AS batch"
    return spark.read.jdbc(url, query, column=id_col, lowerBound=int(after_id) + 1,
                           upperBound=int(upper_id) + 1, numPartitions=num_partitions,
                           properties=properties or {})
