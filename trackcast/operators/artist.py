"""Per-artist aggregates (A1, A5).

All are plain ``groupBy().agg()``: Spark combines map-side first, so a hot
artist reaches the reducer as one partial row per map task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import to_double


def song_count(songs: DataFrame) -> DataFrame:
    """A1: non-null song ids per artist."""
    return songs.groupBy("artist_id").agg(F.count("song_id").alias("song_count"))


def similar_artist_count(pairs: DataFrame) -> DataFrame:
    """A1: non-null similar artists per artist, from the pair table."""
    return (pairs.groupBy(F.col("artist_id").cast("string").alias("artist_id"))
            .agg(F.count("similar_artist").alias("similar_artist_count")))


def weight_dot_freq(terms: DataFrame) -> DataFrame:
    """Sum of weight * frequency per artist over rows where both parse."""
    w, f = to_double("weight"), to_double("freq")
    return (terms.filter(w.isNotNull() & f.isNotNull())
            .groupBy(F.col("artist_id").cast("string").alias("artist_id"))
            .agg(F.sum(w * f).alias("weight_dot_freq")))
