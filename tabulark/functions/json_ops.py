"""JSON operators: field access, array explode, canonical text.

Document bodies arrive as JSON text.  ``from_json`` with an explicit
schema parses them on the executors (no inference pass over the data);
malformed text yields null fields, which the quarantine operator routes
aside instead of failing the batch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .dates import DATETIME_FORMAT, col_

# Permissive parsing: bad records give nulls, never an exception.
PARSE_OPTIONS = {"mode": "PERMISSIVE"}
# Canonical text: timestamps to the second, as the source system writes them.
CANONICAL_OPTIONS = {"timestampFormat": DATETIME_FORMAT, "timestampNTZFormat": DATETIME_FORMAT,
                     "ignoreNullFields": "false"}


def parse(c: str | Column, schema: T.DataType) -> Column:
    """JSON text -> typed value (struct / array)."""
    return F.from_json(col_(c), schema, PARSE_OPTIONS)


def field(c: str | Column, path: str) -> Column:
    """One field by JSON path (``$.a.b``) without declaring a schema."""
    return F.get_json_object(col_(c), path)


def explode_array(df: DataFrame, array_col: str, alias: str = "item",
                  position: str | None = "position") -> DataFrame:
    """Array -> one row per element; an empty or null array gives no row."""
    if position:
        return df.select("*", F.posexplode(F.col(array_col)).alias(position, alias)).drop(array_col)
    return df.select("*", F.explode(F.col(array_col)).alias(alias)).drop(array_col)


def _sorted_struct(dt: T.DataType, c: Column) -> Column:
    """Rebuild a value with object keys in sorted order, recursively."""
    if isinstance(dt, T.StructType):
        names = sorted(f.name for f in dt.fields)
        types = {f.name: f.dataType for f in dt.fields}
        return F.struct(*[_sorted_struct(types[n], c.getField(n)).alias(n) for n in names])
    if isinstance(dt, T.ArrayType) and isinstance(dt.elementType, (T.StructType, T.ArrayType)):
        return F.transform(c, lambda e: _sorted_struct(dt.elementType, e))
    return c


def canonical_json(df: DataFrame, columns: list[str] | None = None) -> Column:
    """Canonical JSON text of a row: keys sorted at every level, datetimes
    as ``yyyy-MM-dd HH:mm:ss``, non-ASCII text kept as is."""
    fields = [f for f in df.schema.fields if columns is None or f.name in columns]
    st = T.StructType(fields)
    value = _sorted_struct(st, F.struct(*[F.col(f.name) for f in fields]))
    return F.to_json(value, CANONICAL_OPTIONS)
