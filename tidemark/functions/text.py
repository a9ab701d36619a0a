"""Text expressions: Unicode trim, cut by code points, merge of fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The 25 characters with the Unicode property White_Space.
WHITE_SPACE = (
    "\u0009\u000a\u000b\u000c\u000d\u0020\u0085\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def trim_unicode(column: Column) -> Column:
    """Strip Unicode white space at both ends; ``trim`` alone strips only U+0020."""
    return F.btrim(column, F.lit(WHITE_SPACE))


def truncate_chars(column: Column, limit: int) -> Column:
    """First ``limit`` code points. The result is not trimmed again."""
    return F.substring(column, 1, limit)


def merge_text(*columns: Column, separator: str = " ") -> Column:
    """Trim each field and join those that are not blank; null counts as blank.

    With a blank as separator this equals a trim of the whole, without trimming a third time.
    """
    fields = [F.nullif(trim_unicode(c), F.lit("")) for c in columns]
    return F.concat_ws(separator, *fields)


def is_blank(column: Column) -> Column:
    return F.coalesce(trim_unicode(column), F.lit("")) == ""
