"""Column expressions shared by the flattening operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flatweave.schemas import has_path

SPREAD_BITS = 60


def field_or_null(schema: T.StructType, path: str, dtype: T.DataType) -> str:
    """SQL text of a nested field, or of a typed NULL when the export predates it."""
    return path if has_path(schema, path) else f"CAST(NULL AS {dtype.simpleString()})"


def quoted(text: str) -> str:
    """A string literal of SQL."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def param_text(array: str, key: str, field: str = "int_value") -> str:
    """SQL text of :func:`param_value`, without its check."""
    # array_position is 1-based and 0 when missing; get() gives NULL at index -1.
    return f"get({array}.value.{field}, CAST(array_position({array}.key, {quoted(key)}) - 1 AS INT))"


def param_value(array: str, key: str, field: str = "int_value", strict: bool = False) -> Column:
    """One typed value out of a key/value array; NULL if the key is absent.

    Reads only ``key`` and the one value field, so the scan prunes the others.
    The first entry wins when a key repeats; ``strict`` raises instead.
    """
    keys = F.col(f"{array}.key")
    found = F.expr(param_text(array, key, field))
    if not strict:
        return found
    repeats = F.size(F.filter(keys, lambda k: k == key))
    return F.when(repeats > 1, F.raise_error(F.lit(f"{array}: more than one value for {key}"))).otherwise(found)


# The fields of a parameter's typed value, in the order in which they count.
VALUE_FIELDS = ("string_value", "int_value", "float_value", "double_value")


def text_value(value: str, schema: T.StructType | None = None) -> str:
    """SQL text of a parameter value's typed union as text: the first field that is set.

    With the ``schema`` of the row, fields that it lacks are left out.
    """
    fields = [field for field in VALUE_FIELDS if schema is None or has_path(schema, f"{value}.{field}")]
    texts = [f"CAST({value}.{field} AS STRING)" for field in fields]
    return f"coalesce({', '.join(texts or ['CAST(NULL AS STRING)'])})"


def shard_date(shard: str | Column) -> Column:
    """``YYYYMMDD`` text as a date; bad text is an error."""
    return F.to_date(shard, "yyyyMMdd")


def spread(position: str | Column) -> Column:
    """An evenly spread, repeatable 60-bit number for a source row's position."""
    text = position.cast("string") if isinstance(position, Column) else F.col(position).cast("string")
    return F.conv(F.substring(F.md5(text), 1, SPREAD_BITS // 4), 16, 10).cast("long")


def spread_text(position: str) -> str:
    """SQL text of :func:`spread`."""
    return f"CAST(conv(substring(md5(CAST({position} AS STRING)), 1, {SPREAD_BITS // 4}), 16, 10) AS BIGINT)"


def id_text(*parts: str | Column) -> Column:
    """A UUID-shaped id derived from its parts; the same parts give the same id."""
    digest = F.md5(F.concat_ws("|", *parts))
    cuts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return F.concat_ws("-", *[F.substring(digest, start, length) for start, length in cuts])
