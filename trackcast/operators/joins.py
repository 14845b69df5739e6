"""Feature joins.

No side is hinted: Spark broadcasts a side only when its measured size is
below the threshold (AQE re-checks with run-time sizes) and otherwise
shuffles both; skewed artist partitions are split by AQE's skew-join handling
(per-artist tables are stored first so that it applies, see
:func:`join_artist_feature`).
"""

from __future__ import annotations

from typing import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sinks import materialize


def left_join_fill(left: DataFrame, right: DataFrame, on, fill: Mapping[str, object]) -> DataFrame:
    """Left join, then replace the NULLs of unmatched rows (P8) with typed zeros."""
    return left.join(right, on, "left").na.fill(dict(fill))


def join_play_count(songs: DataFrame, plays: DataFrame) -> DataFrame:
    """Songs ⟕ play counts on (song id, track id); no plays -> 0.

    The track, the more selective id, is the first join key: a merge join leaves the rows
    in its order.
    """
    plays = plays.select(F.col("play_song_id").cast("string").alias("song_id"),
                         F.col("play_track_id").cast("string").alias("track_id"),
                         F.col("play_count").try_cast("long").alias("play_count"))
    joined = left_join_fill(songs, plays, ["track_id", "song_id"], {"play_count": 0})
    return joined.select("song_id", "track_id", *[c for c in joined.columns if c not in ("song_id", "track_id")])


def join_likes(songs: DataFrame, likes: DataFrame) -> DataFrame:
    """Songs ⟕ likes on the track id; no likes -> 0.

    The likes (one narrow row per liked track, far fewer than songs) are written first:
    the planner then knows their size before the songs are shuffled for this join, and
    leaves that shuffle out while they are under the broadcast threshold.
    """
    likes = materialize(likes.select(F.col("track").cast("string").alias("track_id"),
                                     F.col("likes").try_cast("long").alias("likes")), "likes")
    return left_join_fill(songs, likes, ["track_id"], {"likes": 0})


def join_artist_feature(df: DataFrame, feature: DataFrame, how: str = "left",
                        fill: Mapping[str, object] | None = None, store: bool = True) -> DataFrame:
    """Attach one per-artist table on ``artist_id``.

    The per-artist table (one row per artist, small) is written first
    (``store=False`` for a table already read from storage).  Joined straight from its aggregate it would
    arrive partitioned by artist, and AQE only splits a skewed partition (an
    artist holding a third of the songs) when both join inputs are plain
    shuffle stages; the written table also gives the planner its true size,
    so it is broadcast when under the threshold.
    """
    if store:
        feature = materialize(feature, "artist_feature")
    out = df.join(feature, "artist_id", how)
    return out.na.fill(dict(fill)) if fill else out


def join_training(songs: DataFrame, training: DataFrame, how: str, by_hash: bool = False) -> DataFrame:
    """J8 (left) / J9 (inner): songs with training rows on (artist, title).  The artist is the
    first key: a merge join leaves the songs of an artist, with its measures, side by side,
    so that the next shuffle of these rows compresses better.  ``by_hash``: a hash of both comes
    first, for rows that are not shuffled again; a merge join sorts by that number faster than
    by names, which often begin alike."""
    cond = (songs["artist_name"] == training["td_artist"]) & (songs["title"] == training["td_title"])
    if by_hash:
        cond = (F.xxhash64(songs["artist_name"], songs["title"]) == F.xxhash64(training["td_artist"], training["td_title"])) & cond
    return songs.join(training, cond, how)
