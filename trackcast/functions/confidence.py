"""F8: rating word -> confidence level."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._col import ColumnOrName, as_col

# The rating words (exact, case-sensitive) and their levels.
CONFIDENCE_LEVELS = {
    "terrible": 0,
    "poor": 1,
    "average": 2,
    "good": 3,
    "very good": 4,
    "excellent": 5,
}
UNKNOWN_CONFIDENCE = -1
# The level reported for an averaged (multi-row) match and for the global fallback.
AVERAGED_CONFIDENCE = 3
NUM_CONFIDENCE_LEVELS = len(CONFIDENCE_LEVELS)


def translate_confidence(c: ColumnOrName) -> Column:
    """Map a rating word to 0..5; anything else (other case, unknown, NULL) is -1."""
    col = as_col(c)
    expr = None
    for word, level in CONFIDENCE_LEVELS.items():
        expr = (F.when(col == word, F.lit(level)) if expr is None
                else expr.when(col == word, F.lit(level)))
    return expr.otherwise(F.lit(UNKNOWN_CONFIDENCE))
