"""Numeric parsing and derived measures.

Inputs arrive as text (or already typed); they are typed exactly once with
``try_cast`` so a bad value becomes NULL instead of failing an ANSI cast.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._col import ColumnOrName, as_col

INT_MAX = (1 << 31) - 1
# The only spellings of infinity a JVM double parser accepts.
JVM_INFINITY_SPELLINGS = ["Infinity", "+Infinity", "-Infinity"]


def to_double(c: ColumnOrName) -> Column:
    """Parse as double; NULL when not a number.

    NaN counts as missing (it would poison every average), and infinities are
    accepted only in the JVM spelling (Spark alone would also take ``inf``).
    """
    col = as_col(c)
    parsed = col.try_cast("double")
    odd_infinity = F.isnan(parsed) | (
        (F.abs(parsed) == F.lit(float("inf")))
        & ~F.trim(col.cast("string")).isin(JVM_INFINITY_SPELLINGS)
    )
    return F.when(odd_infinity, F.lit(None).cast("double")).otherwise(parsed)


def is_numeric(c: ColumnOrName) -> Column:
    """the value parses as a (non-NaN) double."""
    return to_double(c).isNotNull()


def na_to_zero(c: ColumnOrName) -> Column:
    """the parsed double, or 0.0 for anything that is not a number."""
    return F.coalesce(to_double(c), F.lit(0.0))


def to_int(c: ColumnOrName) -> Column:
    return as_col(c).try_cast("int")


def weight_times_freq(weight: ColumnOrName, freq: ColumnOrName) -> Column:
    """one term's contribution to ``weight_dot_freq``."""
    return to_double(weight) * to_double(freq)


def popularity(familiarity: ColumnOrName, song_count: ColumnOrName,
               similar_count: ColumnOrName) -> Column:
    """log10(max(0, familiarity * songs * similar artists) + 1)."""
    x = as_col(familiarity).cast("double") * as_col(song_count) * as_col(similar_count)
    return F.log10(F.greatest(x, F.lit(0.0)) + F.lit(1.0))


def popularity_ln(familiarity: ColumnOrName, song_count: ColumnOrName,
                  similar_count: ColumnOrName) -> Column:
    """natural-log popularity without the clamp; NULL where the log is undefined."""
    x = as_col(similar_count) * as_col(familiarity).cast("double") * as_col(song_count) + F.lit(1.0)
    return F.when(x > 0, F.ln(x))


def truncate_to_int(c: ColumnOrName) -> Column:
    """drop the fraction toward zero (1.7 -> 1, -1.7 -> -1).

    Saturates at the ends of the int range and takes NaN as 0, as the JVM's
    double-to-int conversion does.
    """
    x = as_col(c).cast("double")
    return (F.when(F.isnan(x), F.lit(0)).when(x >= F.lit(float(INT_MAX)), F.lit(INT_MAX))
            .when(x <= F.lit(float(-INT_MAX - 1)), F.lit(-INT_MAX - 1)).otherwise(x.cast("int")))


def squared_error(label: ColumnOrName, prediction: ColumnOrName) -> Column:
    """F14."""
    return F.pow(as_col(label) - as_col(prediction), 2)


def stable_round(c: ColumnOrName, digits: int) -> Column:
    """Round half-up on the decimal value after snapping to 9 decimals.

    Used only on reported numbers, so last-bit float noise from a different
    summation order cannot flip a rounding tie.  Values from 1e28 on have no
    digits to round and stay as they are.
    """
    x = as_col(c).cast("double")
    return F.when(F.abs(x) < 1e28, F.round(x.try_cast("decimal(38,9)"), digits).cast("double")).otherwise(x)
