"""A hot artist (a third of all songs) is split over several tasks."""

import pytest
from pyspark.sql import functions as F

from trackcast.plans import features as feat
from trackcast.sources.fixtures import MusicInputs

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


def skewed_inputs(spark, n=120_000):
    ids = spark.range(n)
    artist = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 400)
    songs = ids.select(
        F.col("id").cast("string").alias("song_id"),
        F.concat(artist.cast("string"), F.lit("-"), F.col("id").cast("string")).alias("track_id"),
        artist.cast("string").alias("artist_id"),
        F.concat(F.lit("Artist "), artist.cast("string")).alias("artist_name"),
        F.concat(F.lit("Song "), (F.col("id") % 50).cast("string")).alias("title"),
        (artist * 1.5).alias("artist_hotttnesss"), F.lit(0.5).alias("artist_familiarity"),
        F.lit(-3.0).alias("loudness"), F.lit(120.0).alias("tempo"), F.lit(200.0).alias("duration"),
        F.lit("0.4").alias("song_hotttnesss"), F.lit(2000).alias("year"))
    empty_plays = spark.createDataFrame([], "play_song_id string, play_track_id string, play_count long")
    similar = spark.range(400).select(F.col("id").cast("string").alias("artist_id"),
                                      F.lit(3).cast("long").alias("similar_artist_count"))
    terms = spark.range(400).select(F.col("id").cast("string").alias("artist_id"),
                                    F.concat(F.lit("term"), (F.col("id") % 7).cast("string")).alias("artist_term"),
                                    F.lit(0.5).alias("weight"), F.lit(2.0).alias("freq"))
    likes = spark.createDataFrame([], "track string, likes long")
    downloads = spark.range(400 * 50).select(
            F.concat(F.lit("Artist "), (F.col("id") % 400).cast("string")).alias("artist"),
            F.concat(F.lit("Song "), F.floor(F.col("id") / 400).cast("string")).alias("title"),
            F.lit(10.0).alias("mean_price"), F.lit(7.0).alias("downloads"), F.lit("good").alias("confidence"))
    return MusicInputs(songs, empty_plays, similar, terms, likes, downloads)


def test_hot_artist_join_is_split(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    try:
        df = feat.lookup_features(skewed_inputs(spark), top_k=3)
        n = len(df.collect())
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    assert n == 120_000
    assert "skew=true" in plan


def test_hot_artist_split_in_training_rows(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    try:
        df = feat.training_rows(skewed_inputs(spark), top_k=3)
        n = len(df.collect())
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    assert n == 120_000
    assert "skew=true" in plan


def test_hot_artist_split_in_term_average(spark):
    """An artist with a third of the term pairs; equal to the average over the exploded join."""
    from trackcast.operators.terms import term_hotness

    hot = F.col("id") % 3 == 0
    inputs = skewed_inputs(spark, 6_000)
    inputs.artist_terms = spark.range(150_000).select(
        F.when(hot, F.lit(0)).otherwise(F.col("id") % 400).cast("string").alias("artist_id"),
        F.concat(F.lit("term"), F.floor(F.col("id") / 3).cast("string")).alias("artist_term"),
        F.lit(0.5).alias("weight"), F.lit(2.0).alias("freq"))
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    try:
        df = term_hotness(feat.stored_term_pairs(inputs), feat.stored_song_stats(inputs, F.col("artist_hotttnesss")))
        got = df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    assert "skew=true" in plan
    want = (inputs.artist_terms.join(inputs.song_info, "artist_id").groupBy("artist_term")
            .agg(F.avg("artist_hotttnesss").alias("h")).collect())
    assert {r[0]: round(r[1], 9) for r in got} == {r[0]: round(r[1], 9) for r in want}


@pytest.mark.parametrize("level", ["exact", "artist", "title"])
def test_hot_key_in_requests_is_split(spark, level):
    from trackcast.operators.lookup import resolve_features

    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    try:
        feats = spark.range(20_000).select(
            (F.col("id") % 400).cast("string").alias("artist_name"),
            (F.col("id") % 50).cast("string").alias("title"),
            F.lit(3).alias("td_confidence"), (F.col("id") * 0.5).alias("artist_hotness"),
            F.lit(1.0).alias("song_hotness"), F.lit(2.0).alias("td_meanPrice"))
        hot, spread = F.col("id") % 3 == 0, (F.col("id") % 400).cast("string")
        own = F.concat(F.lit("t"), F.col("id").cast("string"))
        artist, title = {
            "artist": (F.when(hot, F.lit("7")).otherwise(spread), own),
            "title": (own, F.when(hot, F.lit("7")).otherwise((F.col("id") % 50).cast("string"))),
            "exact": (F.when(hot, F.lit("7")).otherwise(spread), F.when(hot, F.lit("7")).otherwise((F.col("id") % 50).cast("string"))),
        }[level]
        reqs = spark.range(150_000).select(F.col("id").alias("request_id"), artist.alias("artist"), title.alias("title"))
        df = resolve_features(reqs, feats)
        rows = df.groupBy("match_level").count().collect()
        out = df.select("request_id", "match_level")
        n = len(out.collect())
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    assert n == 150_000
    assert dict(map(tuple, rows)) == {level: 150_000}
    assert "skew=true" in plan
