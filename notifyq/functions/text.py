"""Text column functions (P1, P2, P7, P8, P10, P13, P19). All built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from notifyq import schema as S


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c: str | Column) -> Column:
    """Remove leading and trailing whitespace -- tabs, newlines and the Unicode
    spaces too, like Python's ``str.strip()``. Plain ``trim`` removes spaces only; the
    character-set trim ``btrim`` stays a codegen'd scan, unlike a regex."""
    return F.btrim(_col(c), F.lit(S.STRIP_CHARS))


def text_or_empty(c: str | Column) -> Column:
    """Trimmed text, or '' for null."""
    return F.coalesce(strip_ws(c), F.lit(""))


def is_blank(c: str | Column) -> Column:
    """Null, or only whitespace. Never null itself."""
    return text_or_empty(c) == F.lit("")


def blank_to_null(c: str | Column) -> Column:
    """P10: trimmed text, blank -> null."""
    return F.nullif(strip_ws(c), F.lit(""))


def is_feature_blank(c: str | Column) -> Column:
    """The model's blank test: null, '', 'NAN' or 'NONE' (any case)."""
    return F.coalesce(
        F.upper(strip_ws(c)).isin(*S.FEATURE_BLANKS), F.lit(True)
    )


def mask_id(c: str | Column) -> Column:
    """Keep the first character and hide the rest; blank -> '***'."""
    col = _col(c)
    return F.concat(F.coalesce(F.substring(col, 1, 1), F.lit("")), F.lit("***"))
