"""Text-to-type conversions that never fail a job.

Spark 4 runs with ANSI mode on, where a malformed ``cast`` raises.  Source
feeds are dirty, so conforming uses ``try_cast`` (NULL on bad text) and
counts what it could not convert.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def present(text: Column) -> Column:
    """Text that carries a value: not NULL and not blank."""
    return text.isNotNull() & (F.trim(text) != F.lit(""))


def try_convert(text: Column, dtype: T.DataType) -> Column:
    """Convert text to ``dtype``; blank or malformed text becomes NULL."""
    if isinstance(dtype, T.StringType):
        return text
    return F.when(present(text), F.trim(text).try_cast(dtype))


# What a text must look like for a cast to its type to succeed; more may match.  Blanks
# and control characters around a value do not matter to a cast.
_ROUND = r"[\x00-\x20\x7F]*"
_SHAPES = {kind: rf"\A{_ROUND}(?:{shape}){_ROUND}\z" for kind, shape in {
    "int": r"[+-]?0*[0-9]{1,10}",
    "bigint": r"[+-]?0*[0-9]{1,19}",
    "double": r"(?i)[+-]?(?:nan|inf|infinity|0x[0-9a-f.]+p[+-]?[0-9]+[df]?|[0-9.]+(?:e[+-]?[0-9]+)?[df]?)",
    "boolean": r"(?i)t|true|y|yes|1|f|false|n|no|0",
    "date": r"[+-]?[0-9]{4,7}(?:-[0-9]{1,2}(?:-[0-9]{1,2}(?:[ T](?s:.*))?)?)?",
    "timestamp_ntz": r"[+-]?[0-9]{4,6}(?:-(?s:.*))?|T?[+-]?[0-9]{1,2}:(?s:.*)",
}.items()}


def converted(trimmed: Column, kind: str) -> Column:
    """Text without spaces around it, converted to ``kind`` as ``try_convert`` does.

    A cast that fails builds an exception, which takes tens of microseconds.  So texts
    that cannot convert by their shape are not cast: where texts are tried for types that
    are not theirs, that is nearly all.
    """
    return F.when(trimmed.rlike(_SHAPES[kind]), trimmed.try_cast(kind))


def rejected(text: Column, dtype: T.DataType) -> Column:
    """True where the text held a value that did not convert."""
    if isinstance(dtype, T.StringType):
        return F.lit(False)
    return present(text) & F.trim(text).try_cast(dtype).isNull()
