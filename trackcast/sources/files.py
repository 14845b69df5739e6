"""The application's own inputs, read from their delimited files.

Delimiters and header handling follow the original files: ';' for songs,
similar artists, terms and downloads, ',' for play counts and likes.  Only the
columns the jobs use are kept (selected by header name; the two numeric
term columns are unnamed in the original code and taken by position).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.artist import similar_artist_count
from .delimited import (DOWNLOADS_COLUMNS, PLAY_COUNT_COLUMNS, SONG_INFO_COLUMNS,
                        TRACK_LIKES_COLUMNS, fields_to_columns, keep_field_count, read_delimited,
                        read_split_lines)
from .fixtures import MusicInputs


@dataclass
class InputPaths:
    song_info: str
    play_count: str
    similar_artists: str
    artist_terms: str
    track_likes: str
    downloads: str


def read_song_info(spark: SparkSession, path: str) -> DataFrame:
    return read_delimited(spark, path, None, ";", header=True).select(*SONG_INFO_COLUMNS)


def read_play_count(spark: SparkSession, path: str) -> DataFrame:
    return read_delimited(spark, path, None, ",", header=True).select(*PLAY_COUNT_COLUMNS)


def read_similar_artists(spark: SparkSession, path: str) -> DataFrame:
    return read_delimited(spark, path, None, ";", header=True).select("artist_id", "similar_artist")


def read_artist_terms(spark: SparkSession, path: str) -> DataFrame:
    raw = read_delimited(spark, path, None, ";", header=True)
    c = raw.columns
    return raw.select(F.col(c[0]).alias("artist_id"), F.col(c[1]).alias("artist_term"),
                      F.col(c[2]).alias("weight"), F.col(c[3]).alias("freq"))


def read_track_likes(spark: SparkSession, path: str) -> DataFrame:
    return read_delimited(spark, path, None, ",", header=True).select(*TRACK_LIKES_COLUMNS)


def read_downloads(spark: SparkSession, path: str) -> DataFrame:
    """';' lines, header line removed, exactly five fields."""
    lines = keep_field_count(read_split_lines(spark, path, ";", header=True), 5)
    return fields_to_columns(lines, DOWNLOADS_COLUMNS)


def read_music_inputs(spark: SparkSession, paths: InputPaths) -> MusicInputs:
    return MusicInputs(
        song_info=read_song_info(spark, paths.song_info),
        play_count=read_play_count(spark, paths.play_count),
        similar_counts=similar_artist_count(read_similar_artists(spark, paths.similar_artists)),
        artist_terms=read_artist_terms(spark, paths.artist_terms),
        track_likes=read_track_likes(spark, paths.track_likes),
        downloads=read_downloads(spark, paths.downloads),
    )
