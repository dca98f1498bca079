"""Type checks and casts for text fields.

An empty field is null and valid for every type.  ``try_cast`` follows ANSI
rules whatever the session says, so ``7.5``, ``1e3`` or an overflow is no int.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# How load messages name each type.
EXPECTED = {
    T.BooleanType(): "a boolean",
    T.IntegerType(): "an integer",
    T.DoubleType(): "a double",
    T.StringType(): "a string",
}


def cast_field(text: Column, to: T.DataType) -> Column:
    """The typed value, or null where the text does not hold one."""
    if isinstance(to, T.BooleanType):
        word = F.lower(F.trim(text))
        return F.when(word == "true", F.lit(True)).when(word == "false", F.lit(False))
    if isinstance(to, T.StringType):
        return text
    return text.try_cast(to)


def is_wrong(text: Column, to: T.DataType) -> Column | None:
    """True where a non-empty text does not fit; None when any text fits."""
    if isinstance(to, T.StringType):
        return None
    return (text != "") & cast_field(text, to).isNull()
