"""Tests of the findings of round 4: a scoring run derives what both builds read once."""

from collections import Counter

import pytest

from conftest import SF_SMALL
from test_findings_r03 import kept_tables

from trackcast import catalog, sinks
from trackcast.operators import clean as cl
from trackcast.plans import features as feat
from trackcast.sources.fixtures import MusicInputs

SONGS = [  # names that F6 and F7 clean alike or not, repeated and missing keys, marks for missing numbers
    ("s1", "t1", "a1", "AC/DC", "Back in Black", 3.0, 0.5, "0.5"),
    ("s2", "t2", "a1", "AC/DC", "İstanbul", 3.0, 0.5, "NA"),
    ("s2", "t2", "a1", "AC/DC", "İstanbul", 3.0, 0.5, "NA"),
    ("s3", "t3", "a2", "Kiss", "Beth", None, 0.2, "0.7"),
    ("s4", "t4", "a2", "Kiss", None, None, 0.2, "x"),
    (None, "t5", "a1", "???", "Beth", 1.0, 0.1, "1"),
    ("s6", None, None, "Kiss", "Beth", 2.0, 0.3, "2"),
]


@pytest.fixture()
def raw(spark):
    songs = spark.createDataFrame(
        [(*r[:5], r[5], r[6], -1.0, 120.0, 200.0, r[7], 1999) for r in SONGS],
        "song_id string, track_id string, artist_id string, artist_name string, title string, artist_hotttnesss double, "
        "artist_familiarity double, loudness double, tempo double, duration double, song_hotttnesss string, year int")
    plays = spark.createDataFrame([("s1", "t1", 4), ("s1", "t1", 5), ("s2", "t2", 6), ("s3", "t9", 7), (None, "t5", 8)],
                                  "play_song_id string, play_track_id string, play_count long")
    similar = spark.createDataFrame([("a1", 2), ("a2", 3)], "artist_id string, similar_artist_count long")
    terms = spark.createDataFrame([("a1", "rock", 0.5, 2.0), ("a2", "pop", 0.5, 1.0)],
                                  "artist_id string, artist_term string, weight double, freq double")
    likes = spark.createDataFrame([("t1", 9), ("t1", 10)], "track string, likes long")
    downloads = spark.createDataFrame(
        [("acdc", "back in black", "1.5", "10", "good"), ("acdc", "Back In Black", None, "20", "poor"),
         ("ACDC", "stanbul", "2.5", "30", "good"), ("ACDC", "istanbul", "3.5", "40", "good"), ("kiss", "beth", "4.5", None, "good"),
         ("iss", "beth", "5.5", "50", "unknown"), ("kiss", "Beth", "6.5", "60", "good"), ("!", "beth", "7.5", "70", "good")],
        "artist string, title string, mean_price string, downloads string, confidence string")
    return MusicInputs(songs, plays, similar, terms, likes, downloads)


def rows(df):
    return Counter(map(tuple, df.collect()))


def test_builds_from_shared_tables_equal_builds_alone(spark, raw):
    shared = feat.shared_tables(raw)
    got = feat.lookup_features(shared.inputs, shared=shared)
    assert got.columns == feat.lookup_features(raw).columns and rows(got) == rows(feat.lookup_features(raw))
    got = feat.training_rows(shared.inputs, shared=shared)
    want = feat.training_rows(raw)
    assert got.dtypes == want.dtypes and rows(got) == rows(want) and len(rows(want)) > 4
    few = ["td_confidence", "artist_hotttnesss", "song_hotttnesss", feat.LABEL_COLUMN]
    shared = feat.shared_tables(raw, few[1:3])
    got = feat.training_rows(shared.inputs, shared=shared, columns=few)
    assert rows(got) == rows(want.select(*few, "td_artist", "song_id", "track_id"))


def test_names_are_cleaned_for_both_builds_at_once(spark, raw):
    both = cl.clean_song_info_both(raw.song_info)
    want = cl.clean_song_info_wide(raw.song_info)
    assert rows(both.select(*want.columns)) == rows(want)
    want = cl.clean_song_info(raw.song_info)
    assert rows(cl.lookup_names(both).select(*want.columns)) == rows(want)
    assert both.where("artist_name != lookup_artist_name or title != lookup_title").count() == 4


@pytest.mark.parametrize("name", ["predict_requests", "score_requests"])
def test_a_scoring_run_writes_each_shared_table_once(spark, monkeypatch, name):
    """Before, predict_requests derived both builds' inputs twice, and both queries joined songs and plays twice."""
    written = kept_tables(monkeypatch)
    monkeypatch.setattr(catalog.fx, "materialize", sinks.materialize)
    catalog.QUERIES[name](spark, SF_SMALL)
    count = Counter(n for n, _ in written)
    assert {n: count[n] for n in ("song_info", "played_songs", "downloads", "term_pairs")} == dict.fromkeys(
        ("song_info", "played_songs", "downloads", "term_pairs"), 1)
    assert count["pairs"] == 0


def test_requests_of_written_songs_equal_those_of_the_lines(spark, scratch):
    base = scratch("tables")
    spark.sql("""SELECT * FROM VALUES (1L, 7L, TIMESTAMP '1997-01-01 00:00:00'), (1L, 7L, NULL), (2L, 7L, NULL), (NULL, 7L, NULL),
              (3L, 9L, NULL), (4L, 7L, NULL), (2L, 8L, NULL), (9L, 8L, NULL) AS t(l_partkey, l_suppkey, l_shipdate)""").write.parquet(f"{base}/lineitem.parquet")
    spark.sql("""SELECT * FROM VALUES (1L, 'a ring', 7, 1.0D), (1L, 'a bolt', 8, 1.0D), (2L, NULL, NULL, NULL), (3L, 'c', 1, 1.0D), (4L, 'a ring', 1, 2.0D)
              AS t(p_partkey, p_name, p_size, p_retailprice)""").write.parquet(f"{base}/part.parquet")
    spark.sql("SELECT * FROM VALUES (7L, 'S 7', 1.0D), (7L, 'S 7', 1.0D), (8L, NULL, 2.0D) AS t(s_suppkey, s_name, s_acctbal)").write.parquet(f"{base}/supplier.parquet")
    t = catalog.fx.SourceTables(spark, base)
    songs = sinks.materialize(catalog.fx.song_info(t), "song_info")
    want, got = catalog.fx.requests(t), catalog.fx.requests(t, songs)
    assert got.dtypes == want.dtypes and rows(got) == rows(want) and sum(rows(want).values()) == 9
    assert "Join" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_both_readings_of_the_hotness_pick_their_own_top_terms(spark, raw):
    """An artist without hotness counts as 0 for the lookup table and not at all for the matrix."""
    raw.song_info = raw.song_info.where("song_id is not null and track_id is not null")
    raw.artist_terms = spark.createDataFrame(
        [("a1", "rock", 0.5, 2.0), ("a2", "pop", 0.5, 1.0), ("a2", "rock", 0.5, 1.0), ("a3", "folk", 0.5, 1.0)],
        "artist_id string, artist_term string, weight double, freq double")
    for k in (1, 2, 3):
        shared = feat.shared_tables(raw, top_k=k)
        assert rows(shared.lookup_artists) == rows(feat.lookup_genre_overlap(raw, k))
        assert rows(shared.explore_artists) == rows(feat.explore_artist_table(raw, k))
        assert shared.explore_artists.columns == feat.explore_artist_table(raw, k).columns


def test_the_songs_of_a_scoring_run_hold_the_columns_it_reads(spark, monkeypatch):
    written = kept_tables(monkeypatch)
    catalog._fit_and_features(spark, SF_SMALL)
    songs = dict(written)["song_info"]
    assert set(songs.columns) == {"song_id", "track_id", "artist_id", "artist_name", "title", "artist_hotttnesss", "song_hotttnesss"}
    names = [n for n, _ in written]
    assert [names.count(n) for n in ("song_stats", "term_hotness", "term_features")] == [1, 1, 1]


def test_hot_artist_is_split_in_the_shared_builds(spark):
    from test_skew import SKEW_CONF, skewed_inputs

    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    try:
        shared = feat.shared_tables(skewed_inputs(spark), top_k=3)
        tables = [feat.lookup_features(shared.inputs, shared=shared), feat.training_rows(shared.inputs, shared=shared)]
        counts = [len(df.collect()) for df in tables]
        plans = [df._jdf.queryExecution().executedPlan().toString() for df in tables]
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert counts == [120_000, 120_000] and all("skew=true" in p for p in plans)
