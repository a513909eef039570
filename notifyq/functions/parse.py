"""Parsing functions (P3, P5, P6, P9, P17, P18). Built-ins only, ANSI-safe (``try_*``)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from notifyq import schema as S


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_bool(c: str | Column) -> Column:
    """P3: 'true'/'1' -> true, 'false'/'0' -> false (any case), anything else -> null."""
    low = F.lower(_col(c))
    return F.when(low.isin(*S.BOOL_TRUE), F.lit(True)).when(
        low.isin(*S.BOOL_FALSE), F.lit(False)
    )


def to_timestamp_fixed(c: str | Column) -> Column:
    """P5: parse ``YYYY-MM-DD HH:MM:SS`` text to timestamp_ntz; anything else -> null.

    The regex guard keeps out text the cast would accept but the format does not
    (ISO 'T' separators, fractions, zones, date only); the cast then rejects
    impossible dates and times such as month 13 or second 60.
    """
    col = _col(c)
    return F.when(col.rlike(S.TIMESTAMP_PATTERN), col.try_cast("timestamp_ntz"))


def to_number(c: str | Column) -> Column:
    """Decimal text -> double; anything else (incl. 'inf', 'nan', '5d') -> null."""
    col = _col(c)
    return F.when(col.rlike(S.NUMBER_PATTERN), col.try_cast("double"))


def to_int_truncated(c: str | Column) -> Column:
    """Number -> int, truncating toward zero; out of range -> null."""
    return _col(c).try_cast("double").try_cast("int")


def major_version(c: str | Column) -> Column:
    """Text before the first dot as int; null when it is not an integer."""
    return F.split_part(_col(c), F.lit("."), F.lit(1)).try_cast("int")


def hour_of(c: str | Column) -> Column:
    """Hour of day of a timestamp."""
    return F.hour(_col(c))
