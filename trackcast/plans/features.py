"""Feature tables: the lookup table (L2), the training matrix (L3), averages (A3).

Plan shape.  The original builds each feature by joining the whole song table
once more (play counts, song counts, term sums, similar counts, likes, genre
overlap).  Here every per-artist feature comes from two aggregates (songs by
artist; terms by artist and term), joined among themselves into one row per
artist, and the song rows meet that table in a single join on ``artist_id``.
The inner joins run before the left joins, the most selective first:

    L3:  (songs ⋈ training) ⟕ plays ⟕ likes ⋈ artists
    L2:  (songs ⋈ artists) ⟕ plays ⟕ training

(runs of both builds: played = songs ⟕ plays; (played ⟕ likes) ⋈ training ⋈ artists and
(played ⋈ artists) ⟕ training)
which equals the original left-to-right chains: the left joins are keyed on
song columns only, and every artist table has one row per artist.

Runs of both builds (scoring) join songs and plays once and clean the names once
(:func:`shared_tables`); either build then starts from the written (songs ⟕ plays).

Hot artists.  The per-artist table is written once (it is small) before the
song rows meet it.  The planner then sees its true size: under the broadcast
threshold it is broadcast, above it the join is a shuffle join of two plain
shuffle stages, the shape in which AQE splits a skewed partition (an artist
holding a third of all songs) over many tasks.  Joined straight from the
aggregate (already partitioned by artist), the hot partition would stay one
task.  Tables joined on another key than they were aggregated on get a fresh
shuffle anyway and need no such step.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import AVERAGED_CONFIDENCE, na_to_zero, popularity, to_double
from ..operators.clean import (WIDE_NUMERIC_COLUMNS, clean_downloads, clean_song_info,
                               clean_song_info_both, clean_song_info_wide, lookup_names)
from ..operators.joins import join_artist_feature, join_likes, join_play_count, join_training
from ..operators.terms import (DEFAULT_TOP_K, artist_song_stats, genre_overlap, term_counts,
                               term_features, term_hotness, term_pairs, top_terms)
from ..sinks import materialize
from ..sources.fixtures import MusicInputs

# Column order of the training matrix (position = feature index, 16 = label).
TRAINING_COLUMNS = (
    "td_confidence", "artist_hotttnesss", "artist_familiarity", "loudness", "tempo",
    "duration", "song_hotttnesss", "year", "play_count", "song_count", "weight_dot_freq",
    "similar_artist_count", "likes", "td_meanPrice", "top_50_count", "popularity",
    "td_downloads",
)
LABEL_COLUMN = "td_downloads"
LOOKUP_COLUMNS = ("artist_name", "title", "td_confidence", "artist_hotness", "song_hotness",
                  "td_meanPrice")


# ---------------------------------------------------------------- runs of both builds

SONG_MEASURES = (*WIDE_NUMERIC_COLUMNS, "year")
# The measures that the lookup table and the term averages read.
LOOKUP_MEASURES = ("artist_hotttnesss", "song_hotttnesss")


@dataclass
class SharedTables:
    """What both builds read, each table written once: raw songs (the columns that are read) and
    downloads (in ``inputs``), the cleaned songs with their play counts, and one row per artist
    with terms for the lookup table and one per artist with songs and terms for the matrix."""

    inputs: MusicInputs
    songs: DataFrame
    lookup_artists: DataFrame
    explore_artists: DataFrame


def stored_played_songs(inputs: MusicInputs, measures: Sequence[str]) -> DataFrame:
    """J1 of both builds, written once: every song with its play count, its names cleaned for
    either build, and the given measures.  The names are cleaned after the join, which thus
    carries them once, and filters that the later joins derive read written columns."""
    played = join_play_count(inputs.song_info, inputs.play_count)
    return materialize(clean_song_info_both(played, measures, keep=["play_count"]), "played_songs")


def shared_tables(raw: MusicInputs, measures: Sequence[str] = SONG_MEASURES,
                  top_k: int = DEFAULT_TOP_K) -> SharedTables:
    """``measures``: those of the song columns that the training rows are asked for; with those
    of the lookup table, the ids and the names they are all that is written of the songs."""
    measures = [c for c in SONG_MEASURES if c in measures or c in LOOKUP_MEASURES]
    songs = raw.song_info.select(
        *[F.col(c).cast("string").alias(c) for c in ("song_id", "track_id", "artist_id")],
        "artist_name", "title", *measures)
    inputs = replace(raw, song_info=materialize(songs, "song_info"),
                     downloads=materialize(raw.downloads, "downloads"))
    return SharedTables(inputs, stored_played_songs(inputs, measures), *stored_artist_tables(inputs, top_k))


def stored_artist_tables(inputs: MusicInputs, top_k: int = DEFAULT_TOP_K) -> tuple[DataFrame, DataFrame]:
    """The artist tables of both builds (:func:`stored_lookup_artist_table`,
    :func:`stored_explore_artist_table`): both readings of the hotness in one pass over the songs
    and one over the term pairs, the overlaps with both top tables in another."""
    pairs = stored_term_pairs(inputs)
    stats = materialize(artist_song_stats(inputs.song_info, to_double("artist_hotttnesss"),
                                          na_to_zero("artist_hotttnesss")), "song_stats")
    hotness = materialize(term_hotness(pairs, stats), "term_hotness")
    top = top_terms(hotness.select("artist_term", "artist_hotness"), top_k)
    lookup_top = top_terms(hotness.select("artist_term", F.col("other_hotness").alias("artist_hotness")), top_k)
    terms = materialize(term_features(pairs, top, top_k, "top_50_count", lookup_top, "top_1000_count"), "term_features")
    return (terms.select("artist_id", "top_1000_count"),
            materialize(_explore_artists(stats, terms, inputs.similar_counts), "explore_artists"))


# ---------------------------------------------------------------- lookup build (L2)

def lookup_songs_with_plays(inputs: MusicInputs) -> DataFrame:
    """J1 stage: cleaned songs with their play count (0 when none)."""
    songs = clean_song_info(inputs.song_info)
    return join_play_count(songs, inputs.play_count).select(
        "artist_id", "artist_name", "title", "song_hotness", "artist_hotness", "tempo",
        "play_count", "song_id")


def stored_term_pairs(inputs: MusicInputs) -> DataFrame:
    """The term rows by artist and term, written once: two branches of either
    build read them, and both builds may share them."""
    return materialize(term_pairs(inputs.artist_terms), "term_pairs")


def stored_song_stats(inputs: MusicInputs, hotness) -> DataFrame:
    """The songs by artist, written once.  With both sides of the term average
    stored, its join has two plain shuffle stages and an artist holding a third of
    the term pairs is split."""
    return materialize(artist_song_stats(inputs.song_info, hotness), "song_stats")


def lookup_genre_overlap(inputs: MusicInputs, top_k: int = DEFAULT_TOP_K,
                         pairs: DataFrame | None = None) -> DataFrame:
    """L4, first variant: top terms over the cleaned songs (missing hotness = 0).
    Pairs written for this build alone carry no term sums, which it does not read."""
    if pairs is None:
        pairs = materialize(term_counts(inputs.artist_terms), "term_pairs")
    stats = stored_song_stats(inputs, na_to_zero("artist_hotttnesss"))
    top = top_terms(term_hotness(pairs, stats), top_k)
    return genre_overlap(pairs, top, top_k, "top_1000_count")


def stored_lookup_artist_table(inputs: MusicInputs, top_k: int = DEFAULT_TOP_K,
                               pairs: DataFrame | None = None) -> DataFrame:
    """Term overlap of the artists that have terms (the overlap join is an inner
    join), written once.  The similar-artist count of the join stages is not a
    column of the lookup table."""
    return materialize(lookup_genre_overlap(inputs, top_k, pairs), "lookup_artists")


def lookup_song_features(inputs: MusicInputs, top_k: int = DEFAULT_TOP_K,
                         pairs: DataFrame | None = None, shared: SharedTables | None = None) -> DataFrame:
    """The song-level intermediate (J1, J6) before the training join.

    The inner artist join runs first (it can only remove songs), then plays, unless
    the ``shared`` songs have them.
    """
    if shared is not None:
        return join_artist_feature(lookup_names(shared.songs), shared.lookup_artists, "inner", store=False)
    songs = join_artist_feature(clean_song_info(inputs.song_info),
                                stored_lookup_artist_table(inputs, top_k, pairs), "inner", store=False)
    return join_play_count(songs, inputs.play_count)


def lookup_features(inputs: MusicInputs, top_k: int = DEFAULT_TOP_K,
                    pairs: DataFrame | None = None, shared: SharedTables | None = None) -> DataFrame:
    """L2: (artist_name, title, td_confidence, artist_hotness, song_hotness, td_meanPrice)
    per song row, with the training row's rating and price (0 when none, J8 + P8).
    ``pairs``: the stored term pairs, if another build has written them; ``shared``: what a
    run of both builds has written."""
    joined = join_training(lookup_song_features(inputs, top_k, pairs, shared),
                           clean_downloads(inputs.downloads), "left", by_hash=shared is not None)
    return joined.select(
        "artist_name", "title",
        F.coalesce("td_confidence", F.lit(0)).alias("td_confidence"),
        "artist_hotness", "song_hotness",
        F.coalesce("td_meanPrice", F.lit(0.0)).alias("td_meanPrice"))


def global_averages(features: DataFrame) -> DataFrame:
    """A3: one row; the rating is the fixed averaged level, the rest are means."""
    return features.agg(
        F.lit(AVERAGED_CONFIDENCE).alias("mean_confidence"),
        F.avg("artist_hotness").alias("mean_artist_hotness"),
        F.avg("song_hotness").alias("mean_song_hotness"),
        F.avg("td_meanPrice").alias("mean_mean_price"))


# ---------------------------------------------------------------- training matrix (L3)

def explore_artist_table(inputs: MusicInputs, top_k: int = DEFAULT_TOP_K,
                         pairs: DataFrame | None = None, stats: DataFrame | None = None) -> DataFrame:
    """J3 + J6 (inner) and J4 + J2 (left, 0 when none) as one per-artist table.

    One aggregate over the songs gives the song count and the raw hotness sums
    (missing hotness skipped: L4 second variant); one over (artist, term)
    gives overlap and term sums.
    """
    stats = stats if stats is not None else artist_song_stats(inputs.song_info,
                                                              to_double("artist_hotttnesss"))
    pairs = pairs if pairs is not None else term_pairs(inputs.artist_terms)
    top = top_terms(term_hotness(pairs, stats), top_k)
    return _explore_artists(stats, term_features(pairs, top, top_k, "top_50_count"), inputs.similar_counts)


def _explore_artists(stats: DataFrame, terms: DataFrame, similar_counts: DataFrame) -> DataFrame:
    return (stats.select("artist_id", "song_count")
            .join(terms, "artist_id")
            .join(similar_counts, "artist_id", "left")
            .select("artist_id", "song_count", "top_50_count",
                    F.coalesce("weight_dot_freq", F.lit(0.0)).alias("weight_dot_freq"),
                    F.coalesce("similar_artist_count", F.lit(0)).alias("similar_artist_count")))


def stored_explore_artist_table(inputs: MusicInputs, top_k: int = DEFAULT_TOP_K,
                                pairs: DataFrame | None = None) -> DataFrame:
    """:func:`explore_artist_table` written once, songs and term pairs each
    aggregated and written once (two branches of the plan read them)."""
    pairs = pairs if pairs is not None else stored_term_pairs(inputs)
    stats = stored_song_stats(inputs, to_double("artist_hotttnesss"))
    return materialize(explore_artist_table(inputs, top_k, pairs, stats), "explore_artists")


def explore_song_table(inputs: MusicInputs, top_k: int = DEFAULT_TOP_K) -> DataFrame:
    """Every song with all song- and artist-level features (before the training join)."""
    songs = clean_song_info_wide(inputs.song_info)
    with_song_level = join_likes(join_play_count(songs, inputs.play_count), inputs.track_likes)
    return join_artist_feature(with_song_level, stored_explore_artist_table(inputs, top_k), "inner",
                               store=False)


def _matched_rows(inputs: MusicInputs, top_k: int, pairs: DataFrame | None = None,
                  shared: SharedTables | None = None) -> DataFrame:
    """The joined rows of the training matrix, its popularity not yet computed.

    The inner training join (J9) runs first: it is the most selective step,
    so plays, likes and artist features are joined to matched songs only
    (equivalent, as those joins are keyed on song columns).  Rows whose
    cleaned artist is empty are dropped (P9).  The ``shared`` songs have their plays; their
    likes come before the training join, whose shuffle then carries no track ids.
    """
    training = clean_downloads(inputs.downloads, LABEL_COLUMN).filter(F.col("td_artist") != "")
    if shared is not None:
        matched = join_training(join_likes(shared.songs, inputs.track_likes), training, "inner", by_hash=True)
        return join_artist_feature(matched, shared.explore_artists, "inner", store=False)
    matched = join_training(clean_song_info_wide(inputs.song_info), training, "inner")
    matched = join_likes(join_play_count(matched, inputs.play_count), inputs.track_likes)
    return join_artist_feature(matched, stored_explore_artist_table(inputs, top_k, pairs), "inner",
                               store=False)


def _matrix_columns(columns: Sequence[str] = TRAINING_COLUMNS) -> list:
    """The 17 columns of :func:`_matched_rows`, or some; popularity (F9) sits before the label."""
    pop = popularity("artist_familiarity", "song_count", "similar_artist_count")
    return [pop.alias(c) if c == "popularity" else F.col(c) for c in columns]


def training_rows(inputs: MusicInputs, top_k: int = DEFAULT_TOP_K,
                  pairs: DataFrame | None = None, shared: SharedTables | None = None,
                  columns: Sequence[str] = TRAINING_COLUMNS) -> DataFrame:
    """The 17 matrix columns (or those of ``columns``) plus ``td_artist`` (needed for the artist
    split).  ``pairs``: the stored term pairs, if another build has written them; ``shared``:
    what a run of both builds has written."""
    return (_matched_rows(inputs, top_k, pairs, shared)
            .select(*_matrix_columns(columns), "td_artist", "song_id", "track_id"))


def training_matrix(inputs: MusicInputs, top_k: int = DEFAULT_TOP_K,
                    sort_by_artist: bool = True) -> DataFrame:
    """L3: the 17-column training matrix, rows grouped by artist.

    The sort carries song and track ids as secondary keys so the range
    partitioner can split one very large artist over several tasks.  Popularity
    follows from other columns and is computed after the sort has moved the rows.
    """
    rows = _matched_rows(inputs, top_k)
    if sort_by_artist:
        rows = rows.orderBy("td_artist", "song_id", "track_id")
    return rows.select(*_matrix_columns())
