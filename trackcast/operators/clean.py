"""Row cleaning: typed song tables (F6, F7), downloads (L7), projections."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import (clean_lowered, clean_lowered_from, clean_string, is_numeric, na_to_zero,
                         to_double, to_int, translate_confidence)

# The six numeric song columns the wide cleaning zero-fills (``year`` is kept as is).
WIDE_NUMERIC_COLUMNS = ("artist_hotttnesss", "artist_familiarity", "loudness", "tempo",
                        "duration", "song_hotttnesss")


def project_song_info(raw: DataFrame) -> DataFrame:
    """The eight columns of the lookup-feature build, renamed."""
    return raw.select("artist_name", "title",
                      F.col("song_hotttnesss").alias("song_hotness"),
                      F.col("artist_hotttnesss").alias("artist_hotness"),
                      "tempo", "artist_id", "song_id", "track_id")


def clean_song_info(raw: DataFrame) -> DataFrame:
    """names cleaned, three measures parsed with non-numbers as 0."""
    p = project_song_info(raw)
    return p.select(
        clean_string("artist_name").alias("artist_name"),
        clean_string("title").alias("title"),
        na_to_zero("song_hotness").alias("song_hotness"),
        na_to_zero("artist_hotness").alias("artist_hotness"),
        na_to_zero("tempo").alias("tempo"),
        F.col("artist_id").cast("string").alias("artist_id"),
        F.col("song_id").cast("string").alias("song_id"),
        F.col("track_id").cast("string").alias("track_id"),
    )


def clean_song_info_wide(raw: DataFrame) -> DataFrame:
    """the twelve-column song table; names lower-cased then cleaned, six
    measures parsed with non-numbers as 0, ``year`` parsed (NULL when not a number)."""
    return raw.select(
        F.col("song_id").cast("string").alias("song_id"),
        F.col("track_id").cast("string").alias("track_id"),
        F.col("artist_id").cast("string").alias("artist_id"),
        clean_lowered("artist_name").alias("artist_name"),
        clean_lowered("title").alias("title"),
        *[na_to_zero(c).alias(c) for c in WIDE_NUMERIC_COLUMNS],
        to_int("year").alias("year"),
    )


def clean_song_info_both(raw: DataFrame, measures: Sequence[str] = (*WIDE_NUMERIC_COLUMNS, "year"),
                         keep: Sequence[str] = ()) -> DataFrame:
    """F6 and F7 in one table, for runs of both builds: the ids, the names as F7 cleans them and,
    as ``lookup_artist_name`` and ``lookup_title``, as F6 does, and the given measures, which
    both parse alike.  A name is cleaned once unless it holds other characters than ASCII.
    ``keep`` names columns that are taken as they are."""
    ids = [F.col(c).cast("string").alias(c) for c in ("song_id", "track_id", "artist_id")]
    parsed = [(to_int(c) if c == "year" else na_to_zero(c)).alias(c) for c in measures]
    once = raw.select(*ids, "artist_name", "title", clean_string("artist_name").alias("lookup_artist_name"),
                      clean_string("title").alias("lookup_title"), *parsed, *keep)
    both = {c: clean_lowered_from(c, f"lookup_{c}") for c in ("artist_name", "title")}
    return once.withColumns(both)


def lookup_names(songs: DataFrame) -> DataFrame:
    """The columns of F6 out of :func:`clean_song_info_both`, as far as its measures reach."""
    names = {"lookup_artist_name": "artist_name", "lookup_title": "title",
             "song_hotttnesss": "song_hotness", "artist_hotttnesss": "artist_hotness"}
    return songs.drop("artist_name", "title").withColumnsRenamed(names)


def keep_numeric(df: DataFrame, *columns: str) -> DataFrame:
    """Rows whose given fields all parse as numbers."""
    cond = None
    for c in columns:
        cond = is_numeric(c) if cond is None else cond & is_numeric(c)
    return df.filter(cond) if cond is not None else df


def clean_downloads(raw: DataFrame, require: str = "td_meanPrice") -> DataFrame:
    """The training rows (artist, title, mean price, downloads, rating).

    Rows without a number in ``require`` go: the price for the lookup table, the
    label ``td_downloads`` for the training matrix; the other one may be missing.
    Names are cleaned and the rating becomes a level.
    """
    typed = raw.select(
        clean_string("artist").alias("td_artist"),
        clean_string("title").alias("td_title"),
        to_double("mean_price").alias("td_meanPrice"),
        to_double("downloads").alias("td_downloads"),
        translate_confidence("confidence").alias("td_confidence"),
    )
    return typed.filter(F.col(require).isNotNull())
