"""String functions: name cleaning (F1), lower-casing (F2), digit test."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._col import ColumnOrName, as_col

# Fixed value: everything that is not an ASCII letter or digit is removed.
NOT_ASCII_ALNUM = "[^A-Za-z0-9]"
# The ASCII characters that rule removes (control characters and punctuation).
ASCII_REMOVED = "".join(chr(i) for i in range(128) if not chr(i).isalnum())


def _only_ascii(raw: Column) -> Column:
    return (F.length(raw) == F.octet_length(raw)) & F.is_valid_utf8(raw)


def clean_string(c: ColumnOrName) -> Column:
    """Keep ASCII letters and digits, then lower-case (removal happens first).

    Fast path: in valid UTF-8 whose byte length equals its character length all
    is ASCII, and ``translate`` deletes the characters the rule removes.  Only
    other values pay for the regular expression (about ten times slower per
    value).  The test reads the raw value, so that the deletion is written once:
    in a filter (Spark derives some from join keys) every mention is computed.
    """
    raw = as_col(c).cast("string")
    return F.lower(F.when(_only_ascii(raw), F.translate(raw, ASCII_REMOVED, ""))
                   .otherwise(F.regexp_replace(raw, NOT_ASCII_ALNUM, "")))


def lower(c: ColumnOrName) -> Column:
    return F.lower(as_col(c))


def clean_lowered(c: ColumnOrName) -> Column:
    """SQL ``lower`` first, then :func:`clean_string` (the wide song-table variant).

    The order matters for characters whose lower case is ASCII plus a mark,
    e.g. ``'İ'`` lowers to ``'i̇'`` and keeps its ``i``.
    """
    return clean_string(F.lower(as_col(c)))


def clean_lowered_from(c: ColumnOrName, cleaned: ColumnOrName) -> Column:
    """:func:`clean_lowered` of ``c`` where ``cleaned``, its :func:`clean_string`, is at hand:
    of ASCII both are the same, so that only other values are cleaned again."""
    raw = as_col(c).cast("string")
    return F.when(_only_ascii(raw), as_col(cleaned)).otherwise(clean_lowered(raw))


def is_all_digits(c: ColumnOrName) -> Column:
    """True when every character is a decimal digit (any script); true for ``''``."""
    return as_col(c).rlike(r"^\p{Nd}*\z")
