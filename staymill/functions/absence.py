"""What counts as an absent value."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from staymill.functions.text import strip
from staymill.schema import ABSENT_WORDS


def is_absent(c: Column, dtype: T.DataType) -> Column:
    """Null, NaN or one of the absent words."""
    if isinstance(dtype, T.StringType):
        return c.isNull() | F.lower(strip(c)).isin(ABSENT_WORDS)
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def id_key(c: Column, dtype: T.DataType) -> Column:
    """Clean category key of an identifier: 9.0 -> "9", text trimmed, absent -> null."""
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        text = F.when(c == F.floor(c), c.cast("bigint").cast("string")).otherwise(c.cast("string"))
    elif isinstance(dtype, T.StringType):
        text = strip(c)
    else:
        text = c.cast("string")
    return F.when(~is_absent(c, dtype), text)
