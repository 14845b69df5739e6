"""Re-planned operators against brute force on small data, plus properties."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from trackcast.functions import na_to_zero
from trackcast.operators import artist as art
from trackcast.operators import lookup as lk
from trackcast.operators import metrics as mt
from trackcast.operators import profile as pf
from trackcast.operators import split as sp
from trackcast.operators import terms as tm
from trackcast.sources import fixtures as fx


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_similar_artist_count_counts_non_null_pairs(spark):
    pairs = spark.createDataFrame([("1", "2"), ("1", "2"), ("1", None), ("2", None)], "artist_id string, similar_artist string")
    assert rows(art.similar_artist_count(pairs)) == [("1", 2), ("2", 0)]


def test_term_hotness_equals_exploded_join(tables):
    terms, songs = fx.artist_terms(tables), fx.song_info(tables)
    h = na_to_zero("artist_hotttnesss")
    got = tm.term_hotness(tm.term_pairs(terms), tm.artist_song_stats(songs, h))
    brute = (terms.join(songs.select("artist_id", h.alias("h")), "artist_id")
             .groupBy("artist_term").agg(F.avg("h").alias("artist_hotness")))
    a = {r[0]: r[1] for r in got.collect()}
    b = {r[0]: r[1] for r in brute.collect()}
    assert a.keys() == b.keys()
    for k in a:
        assert a[k] == pytest.approx(b[k], rel=1e-12)


def test_term_hotness_skips_missing(spark):
    terms = spark.createDataFrame([("1", "rock"), ("1", "rock"), ("2", "rock"), ("3", "jazz")],
                                  "artist_id string, artist_term string")
    songs = spark.createDataFrame([("1", "s1", 1.0), ("1", "s2", None), ("2", "s3", 4.0), ("3", "s4", None)],
                                  "artist_id string, song_id string, h double")
    got = dict(map(tuple, tm.term_hotness(tm.term_pairs(terms.withColumn("weight", F.lit(None))
                                                        .withColumn("freq", F.lit(None))),
                                          tm.artist_song_stats(songs, "h")).collect()))
    # rock: rows (1,rock)x2 * song(1.0) and (2,rock) * song(4.0) -> (1+1+4)/3
    assert got["rock"] == pytest.approx(2.0)
    assert got["jazz"] is None


def test_top_terms_ties_broken_by_term(spark):
    hot = spark.createDataFrame([("b", 1.0), ("a", 1.0), ("c", 2.0), ("d", None)],
                                "artist_term string, artist_hotness double")
    assert [r[0] for r in tm.top_terms(hot, 3).collect()] == ["c", "a", "b"]


def test_top_terms_order_by_the_exact_average(spark):
    hot = spark.createDataFrame([("a", 0.5), ("b", 0.50000004), ("c", 0.1), ("d", 1e30), ("e", float("inf"))],
                                "artist_term string, artist_hotness double")
    assert [r[0] for r in tm.top_terms(hot, 3).collect()] == ["e", "d", "b"]


def test_genre_overlap_bounded_and_brute_force(tables):
    terms, songs = fx.artist_terms(tables), fx.song_info(tables)
    pairs = tm.term_pairs(terms)
    k = 7
    top = tm.top_terms(tm.term_hotness(pairs, tm.artist_song_stats(songs, na_to_zero("artist_hotttnesss"))), k)
    got = dict(map(tuple, tm.genre_overlap(pairs, top, k, "n").collect()))
    top_set = {r[0] for r in top.collect()}
    per_artist = {}
    for r in terms.select("artist_id", "artist_term").collect():
        per_artist.setdefault(r[0], set()).add(r[1])
    assert got == {a: len(s & top_set) for a, s in per_artist.items()}
    assert max(got.values()) <= k


def test_weight_dot_freq_skips_non_numbers(spark):
    terms = spark.createDataFrame([("1", "x", "0.5", "4"), ("1", "y", "NA", "3"), ("2", "x", "bad", "1")],
                                  "artist_id string, artist_term string, weight string, freq string")
    assert rows(art.weight_dot_freq(terms)) == [("1", 2.0)]


# ---------------------------------------------------------------- lookups

def features_df(spark, data):
    return spark.createDataFrame(
        data, "artist_name string, title string, td_confidence int, artist_hotness double, "
              "song_hotness double, td_meanPrice double")


def test_resolve_levels_and_single_row_branch(spark):
    feats = features_df(spark, [
        ("abba", "waterloo", 5, 10.0, 1.0, 2.0),            # one exact row: kept as is
        ("abba", "sos", 2, 20.0, 3.0, 4.0),
        ("abba", "sos", 4, 40.0, 5.0, 6.0),                  # two exact rows: averaged, rating 3
        ("queen", "song", 1, 7.0, 7.0, 7.0),
    ])
    reqs = spark.createDataFrame([(1, "ABBA", "Waterloo!"), (2, "abba", "SOS"), (3, "Abba", "unknown"),
                                  (4, "nobody", "song"), (5, "nobody", "nothing"), (6, None, None)],
                                 "request_id long, artist string, title string")
    got = {r["request_id"]: r for r in lk.resolve_features(reqs, feats).collect()}
    assert got[1]["match_level"] == "exact" and got[1]["td_confidence"] == 5
    assert (got[1]["artist_hotness"], got[1]["song_hotness"], got[1]["td_meanPrice"]) == (10.0, 1.0, 2.0)
    assert got[2]["match_level"] == "exact" and got[2]["td_confidence"] == 3
    assert got[2]["artist_hotness"] == 30.0
    assert got[3]["match_level"] == "artist" and got[3]["td_confidence"] == 3
    assert got[3]["artist_hotness"] == pytest.approx(70.0 / 3)
    assert got[4]["match_level"] == "title" and got[4]["td_confidence"] == 1
    for rid in (5, 6):
        assert got[rid]["match_level"] == "global" and got[rid]["td_confidence"] == 3
        assert got[rid]["artist_hotness"] == pytest.approx(77.0 / 4)


def test_resolve_uses_given_averages(spark):
    feats = features_df(spark, [("a", "b", 1, 1.0, 1.0, 1.0)])
    avg = spark.createDataFrame([(3, 9.0, 8.0, 7.0)], "mean_confidence int, mean_artist_hotness double, "
                                "mean_song_hotness double, mean_mean_price double")
    reqs = spark.createDataFrame([(1, "x", "y")], "request_id long, artist string, title string")
    r = lk.resolve_features(reqs, feats, avg).first()
    assert (r["match_level"], r["artist_hotness"], r["td_meanPrice"]) == ("global", 9.0, 7.0)


def test_lookup_level_counts(spark):
    feats = features_df(spark, [("a", "x", 1, 1.0, 1.0, 1.0), ("a", "y", 2, 3.0, 1.0, 1.0)])
    reqs = spark.createDataFrame([(1, "A", "x"), (2, "b", "x")], "request_id long, artist string, title string")
    assert rows(lk.lookup_level(reqs, feats, "artist").select("request_id", "n_matches")) == [(1, 2)]
    assert rows(lk.lookup_level(reqs, feats, "title").select("request_id", "n_matches")) == [(1, 1), (2, 1)]


# ---------------------------------------------------------------- profile

def test_exact_median_matches_numpy(spark):
    rnd = random.Random(5)
    data = []
    for i in range(3001):
        data.append((rnd.gauss(0, 1e6), float(rnd.randint(0, 3)), 7.0,
                     None if i % 3 == 0 else rnd.random() * 1e-3, None))
    data.append((1e300, 1.0, 7.0, -5.0, None))
    df = spark.createDataFrame(data, "a double, b double, c double, d double, e double")
    got = {r[0]: (r[1], r[2]) for r in pf.column_profile(df, ["a", "b", "c", "d", "e"]).collect()}
    for j, c in enumerate("abcd"):
        vals = np.array([row[j] for row in data if row[j] is not None])
        assert got[c][1] == pytest.approx(float(np.median(vals)), rel=1e-12)
        assert got[c][0] == pytest.approx(float(np.mean(vals)), rel=1e-9)
    assert got["e"] == (None, None)


def test_exact_median_of_wide_ranges_and_ties(spark, monkeypatch):
    rnd = random.Random(9)
    wide = [10 ** rnd.uniform(-300, 300) for _ in range(4000)]
    ends = [-1.7e308, 1.7e308] * 2000
    half = [0.0] * 2000 + [1.0] * 2000
    ties = [rnd.choice([1.0, 2.0, 2.0, 2.0, 3.0]) for _ in range(4000)]
    near = [1 + i * 1e-15 for i in range(4000)]
    data = list(zip(wide, ends, half, ties, near))
    df = spark.createDataFrame(data, "a double, b double, c double, d double, e double")
    for most, accuracy in ((10_000, 10_000), (5, 40)):  # the second one takes many rounds
        monkeypatch.setattr(pf, "ACCURACY", accuracy)
        n = {c: 4000 for c in "abcde"}
        got = pf.exact_ranks(df, {c: [0, 1999, 2000, 3999] for c in "abcde"}, n, most)
        for j, c in enumerate("abcde"):
            order = sorted(row[j] for row in data)
            assert [got[c, r] for r in (0, 1999, 2000, 3999)] == [order[r] for r in (0, 1999, 2000, 3999)]
    got = {r[0]: r[2] for r in pf.column_profile(df, list("bc")).collect()}
    assert got == {"b": 0.0, "c": 0.5}


def test_profile_reads_the_rows_three_times_at_most(spark, monkeypatch):
    df = spark.range(60_000).select(F.col("id").cast("double").alias("a"), (F.col("id") % 7).cast("double").alias("b"),
                                    F.lit(None).cast("double").alias("c"))
    reads, first = [], type(df).first
    monkeypatch.setattr(type(df), "first", lambda self: (reads.append(1), first(self))[1])
    got = {r[0]: (r[1], r[2]) for r in pf.column_profile(df, list("abc")).collect()}
    assert len(reads) <= 3
    assert got["a"] == (29999.5, 29999.5) and got["b"][1] == 3.0 and got["c"] == (None, None)


def test_wrong_first_bracket_costs_a_round_only(spark):
    df = spark.range(5000).select(F.col("id").cast("double").alias("a"))
    got = pf.exact_ranks(df, {"a": [2499, 2500]}, {"a": 5000}, 100, {"a": [10.0, 20.0]})
    assert got == {("a", 2499): 2499.0, ("a", 2500): 2500.0}


def test_correlation_constant_is_null(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, 4.1, 5.0), (3.0, 5.9, 5.0), (4.0, None, 5.0)],
                               "y double, x double, k double")
    got = dict(map(tuple, pf.correlations(df, "y", ["x", "k"]).collect()))
    assert got["k"] is None
    assert got["x"] == pytest.approx(np.corrcoef([1, 2, 3], [2.0, 4.1, 5.9])[0, 1])


def test_density_counts_cover_all_rows(spark):
    df = spark.range(1000).select((F.col("id") % 37).cast("double").alias("x"),
                                  (F.col("id") * 1.5).alias("y"), F.lit(2.0).alias("z"))
    out = pf.density_2d(df, "y", ["x", "z"], bins=10)
    per = {r[0]: r[1] for r in out.groupBy("column_name").agg(F.sum("n_rows")).collect()}
    assert per == {"x": 1000, "z": 1000}
    b = out.agg(F.min("x_bin"), F.max("x_bin"), F.min("y_bin"), F.max("y_bin")).first()
    assert tuple(b) == (0, 9, 0, 9)
    assert out.filter((F.col("column_name") == "z") & (F.col("x_bin") != 0)).count() == 0


# ---------------------------------------------------------------- metrics / split

def test_regression_metrics_match_formulas(spark):
    y = [3.0, 5.0, 2.5, 7.0]
    p = [2.5, 5.0, 4.0, 8.0]
    df = spark.createDataFrame([("s", a, b) for a, b in zip(y, p)], "set_name string, label double, prediction double")
    got = {r["metric"]: r["value"] for r in mt.regression_metrics(df).collect()}
    ya, pa = np.array(y), np.array(p)
    mse = float(np.mean((ya - pa) ** 2))
    assert got["mse"] == pytest.approx(mse) and got["test_mean_squared_error"] == got["mse"]
    assert got["rmse"] == pytest.approx(math.sqrt(mse))
    assert got["mae"] == pytest.approx(float(np.mean(np.abs(ya - pa))))
    assert got["r2"] == pytest.approx(1 - np.sum((ya - pa) ** 2) / np.sum((ya - ya.mean()) ** 2))
    assert got["explained_variance"] == pytest.approx(float(np.mean((pa - ya.mean()) ** 2)))


def test_actual_vs_predicted_truncates(spark):
    df = spark.createDataFrame([(1.7, -1.7)], "label double, prediction double")
    assert tuple(mt.actual_vs_predicted(df).first()) == (1, -1, 2)


def test_int_predictions_saturate(spark):
    big = spark.createDataFrame([(3e9, -3e9), (float("nan"), None), (float("inf"), 2147483646.9)], "label double, prediction double")
    assert [tuple(r) for r in mt.actual_vs_predicted(big).collect()] == [
        (2147483647, -2147483648, 4294967295), (0, None, None), (2147483647, 2147483646, 1)]


def test_stable_round_keeps_what_it_cannot_round(spark):
    from trackcast.functions import stable_round

    df = spark.createDataFrame([(1.23456789,), (1e29,), (-1e300,), (float("inf"),), (None,)], "x double")
    assert [r[0] for r in df.select(stable_round("x", 4)).collect()] == [1.2346, 1e29, -1e300, float("inf"), None]


def test_downloads_need_a_price_or_a_label_by_use(spark):
    from trackcast.operators.clean import clean_downloads

    raw = spark.createDataFrame([("a", "x", "1.5", "7", "good"), ("b", "x", "NA", "7", "good"), ("c", "x", "1.5", "NA", "good")],
                                "artist string, title string, mean_price string, downloads string, confidence string")
    assert {r["td_artist"] for r in clean_downloads(raw).collect()} == {"a", "c"}
    assert {r["td_artist"] for r in clean_downloads(raw, "td_downloads").collect()} == {"a", "b"}


def test_artist_split_is_disjoint_and_stable(spark):
    df = spark.range(5000).select(F.concat(F.lit("artist"), (F.col("id") % 300).cast("string")).alias("td_artist"))
    out = sp.artist_split(df)
    sides = out.groupBy("td_artist").agg(F.countDistinct("split").alias("n"))
    assert sides.filter(F.col("n") > 1).count() == 0
    frac = out.filter(F.col("split") == sp.TRAIN).count() / 5000
    assert 0.6 < frac < 0.95
    assert rows(out) == rows(sp.artist_split(df))


def test_exact_median_with_infinities_matches_numpy(spark):
    inf = float("inf")
    cols = {
        "a": [-inf, 1.0, 2.0, inf, inf],
        "b": [1.0, inf],
        "c": [-inf, -inf, 3.0, 4.0],
        "d": [inf, inf, -inf],
    }
    width = max(len(v) for v in cols.values())
    data = [tuple(cols[c][i] if i < len(cols[c]) else None for c in cols) for i in range(width)]
    df = spark.createDataFrame(data, ", ".join(f"{c} double" for c in cols))
    got = {r[0]: r[2] for r in pf.column_profile(df, list(cols)).collect()}
    for c, vals in cols.items():
        assert got[c] == float(np.median(np.array(vals))), c


def test_density_ignores_non_finite_points(spark):
    inf = float("inf")
    df = spark.createDataFrame([(0.0, 0.0), (inf, 1.0), (4.0, 4.0), (float("nan"), 2.0), (2.0, -inf)],
                               "x double, y double")
    got = sorted(tuple(r)[1:] for r in pf.density_2d(df, "y", ["x"], bins=4).collect())
    assert got == [(0, 0, 1), (3, 3, 1)]


def test_density_matches_a_loop_over_all_rows(spark):
    rnd, nan, inf = random.Random(3), float("nan"), float("inf")
    odd = [None, nan, inf, -inf]
    pick = lambda low, high: rnd.choice(odd) if rnd.random() < 0.1 else rnd.uniform(low, high)
    data = [(pick(-5, 5), pick(0, 1e-300), 4.0, None, pick(-1e300, 1e300), pick(0, 9)) for _ in range(2000)]
    df = spark.createDataFrame(data, "a double, b double, c double, d double, e double, y double")
    want = {}
    for j, c in enumerate("abcde"):
        points = [(r[j], r[5]) for r in data if r[j] is not None and r[5] is not None
                  and math.isfinite(r[j]) and math.isfinite(r[5])]
        for p in points:
            spot = []
            for axis in (0, 1):
                low, high = min(q[axis] for q in points), max(q[axis] for q in points)
                spot.append(0 if low == high else min(6, math.floor((p[axis] - low) / (high - low) * 7)))
            want[(c, *spot)] = want.get((c, *spot), 0) + 1
    got = {tuple(r)[:3]: r[3] for r in pf.density_2d(df, "y", list("abcde"), bins=7).collect()}
    assert got == want
    assert pf.density_2d(df.filter("a > 99 and a < 100"), "y", ["a", "d"]).collect() == []


def test_small_likes_leave_the_songs_unshuffled(spark):
    from trackcast.operators.joins import join_likes

    songs = spark.range(5000).select(F.concat(F.lit("t"), F.col("id") % 4000).alias("track_id"), F.col("id").cast("string").alias("song_id"))
    likes = (spark.range(600).groupBy((F.col("id") % 300).alias("track")).agg(F.count(F.lit(1)).alias("likes"))
             .select(F.concat(F.lit("t"), "track").alias("track"), "likes"))
    out = join_likes(songs, likes)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "BroadcastHashJoin" in plan
    got = {r["song_id"]: r["likes"] for r in out.collect()}
    assert len(got) == 5000 and all(n == (2 if int(s) % 4000 < 300 else 0) for s, n in got.items())


def test_joined_ids_come_first_and_repeated_plays_fan_out(spark):
    from trackcast.operators.joins import join_play_count

    songs = spark.createDataFrame([("a", "s1", "t1"), ("b", "s1", "t2"), ("c", None, "t1")], "title string, song_id string, track_id string")
    plays = spark.createDataFrame([("s1", "t1", 4), ("s1", "t1", 5), ("s2", "t1", 6), (None, "t1", 7)], "play_song_id string, play_track_id string, play_count int")
    out = join_play_count(songs, plays)
    assert out.columns == ["song_id", "track_id", "title", "play_count"]
    assert sorted((r["title"], r["play_count"]) for r in out.collect()) == [("a", 4), ("a", 5), ("b", 0), ("c", 0)]


def test_popularity_is_computed_after_the_sort(spark, tables):
    from trackcast.plans import features as feat
    from trackcast.sources import fixtures as fx

    plan = feat.training_matrix(fx.music_inputs(tables))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("LOG10") < plan.index("Sort [")


def test_split_rows_are_stored_with_the_columns_that_are_read(spark):
    from conftest import SF_SMALL

    from trackcast import catalog
    from trackcast.plans import features as feat

    stored = catalog._split_rows(spark, SF_SMALL, stored=("td_confidence", feat.LABEL_COLUMN))
    assert stored.columns == ["td_confidence", feat.LABEL_COLUMN, "split"]
    whole = catalog._split_rows(spark, SF_SMALL).select(*stored.columns)
    assert stored.exceptAll(whole).isEmpty() and whole.exceptAll(stored).isEmpty()


def test_stage_counts_derive_the_downloads_once(spark, monkeypatch):
    from conftest import SF_SMALL

    from trackcast import catalog, sinks

    written = {}
    keep = sinks.materialize
    monkeypatch.setattr(sinks, "materialize", lambda df, name: written.setdefault(name, keep(df, name)))
    counts = dict(map(tuple, catalog.stage_row_counts(spark, SF_SMALL).collect()))
    assert written["downloads"].count() == counts["downloads"]
    assert written["matrix"].columns == ["td_artist"] and written["lookup_features"].columns == ["artist_name", "title"]
    assert counts["training_matrix"] == catalog.training_matrix(spark, SF_SMALL).count()
    assert counts["lookup_features"] == catalog.lookup_features(spark, SF_SMALL).count()
