"""Scalar ``Column`` builders; all run JVM-side inside whole-stage codegen."""

from .confidence import (AVERAGED_CONFIDENCE, CONFIDENCE_LEVELS, NUM_CONFIDENCE_LEVELS,
                         UNKNOWN_CONFIDENCE, translate_confidence)
from .numeric import (is_numeric, na_to_zero, popularity, popularity_ln, squared_error,
                      stable_round, to_double, to_int, truncate_to_int, weight_times_freq)
from .text import clean_lowered, clean_lowered_from, clean_string, is_all_digits, lower

__all__ = [
    "AVERAGED_CONFIDENCE", "CONFIDENCE_LEVELS", "NUM_CONFIDENCE_LEVELS", "UNKNOWN_CONFIDENCE",
    "translate_confidence", "is_numeric", "na_to_zero", "popularity", "popularity_ln",
    "squared_error", "stable_round", "to_double", "to_int", "truncate_to_int",
    "weight_times_freq", "clean_lowered", "clean_lowered_from", "clean_string", "is_all_digits", "lower",
]
