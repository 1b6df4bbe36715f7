"""Numbers, flags and typed defaults."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, functions as F, types as T

from tierloom.functions.strings import norm_str, strip_ws

__all__ = ["coalesce_false", "leading_number", "parse_bool", "to_number", "typed_default"]

# Words of a flag column, in lower case.
TRUE_WORDS = ("true", "1", "yes", "y")
FALSE_WORDS = ("false", "0", "no", "n")

NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
INFINITE = r"(?i)^[+-]?inf(inity)?$"


def coalesce_false(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def parse_bool(c: Column, default: bool = False) -> Column:
    """Flag words to boolean; anything else, null included, gives the default."""
    word = norm_str(c)
    return F.when(word.isin(*TRUE_WORDS), True).when(word.isin(*FALSE_WORDS), False).otherwise(default)


def to_number(c: Column) -> Column:
    """Text to double, null where it is no number.

    The pattern guard keeps out Java spellings such as ``10d`` or ``0x1p3`` that a cast accepts.
    """
    text = strip_ws(c.cast("string"))
    return F.when(text.rlike(NUMBER) | text.rlike(INFINITE), text.try_cast("double"))


def leading_number(c: Column) -> Column:
    """Number at the start of a text such as ``10 days``; null if there is none."""
    return to_number(F.regexp_extract(strip_ws(c.cast("string")), r"^[+-]?(\d+\.?\d*|\.\d+)", 0))


def typed_default(dtype: T.DataType, text: str = "") -> Column | None:
    """Value that stands in for null in a column of this type; None if the type has none."""
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.timestamp_seconds(F.lit(0)).cast(dtype)
    if isinstance(dtype, T.DateType):
        return F.lit(date(1970, 1, 1))
    if isinstance(dtype, T.BooleanType):
        return F.lit(False)
    if isinstance(dtype, T.NumericType):
        return F.lit(0).cast(dtype)
    if isinstance(dtype, T.StringType):
        return F.lit(text)
    return None
