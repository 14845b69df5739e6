"""Tests of the findings of round 3 on the feature queries."""

from conftest import SF_SMALL

from trackcast import catalog, sinks


def kept_tables(monkeypatch):
    written, keep = [], sinks.materialize

    def write(df, name):
        written.append((name, keep(df, name)))
        return written[-1][1]

    for module in (sinks, catalog.feat, catalog.jn):
        monkeypatch.setattr(module, "materialize", write)
    return written


def test_report_queries_store_the_rows_of_the_report_only(spark, monkeypatch):
    written = kept_tables(monkeypatch)
    whole = catalog._matrix(spark, SF_SMALL)
    for query in (catalog.density_2d, catalog.column_profile):
        written.clear()
        query(spark, SF_SMALL)
        stored = dict(written)["matrix"]
        assert stored.count() == whole.where("td_confidence > 1").count() < whole.count()


def test_both_builds_of_a_scoring_run_share_songs_downloads_and_terms(spark, monkeypatch):
    written = kept_tables(monkeypatch)
    _, features = catalog._fit_and_features(spark, SF_SMALL)
    names = [name for name, _ in written]
    assert [names.count(n) for n in ("song_info", "downloads", "term_pairs")] == [1, 1, 1]
    alone = catalog.lookup_features(spark, SF_SMALL)
    features = catalog.rounded(features, td_meanPrice=4)
    assert features.exceptAll(alone).isEmpty() and alone.exceptAll(features).isEmpty()


def test_pairs_of_lines_are_written_once_for_songs_and_requests(spark, monkeypatch):
    written = kept_tables(monkeypatch)
    monkeypatch.setattr(catalog.fx, "materialize", sinks.materialize)
    t = catalog.fx.SourceTables(spark, SF_SMALL)
    alone = catalog.fx.song_info(t), catalog.fx.requests(t)
    catalog.fx.music_inputs(t)
    catalog.fx.music_inputs(t)
    assert [name for name, _ in written].count("pairs") == 1
    for before, after in zip(alone, (catalog.fx.song_info(t), catalog.fx.requests(t))):
        assert before.exceptAll(after).isEmpty() and after.exceptAll(before).isEmpty()
        plan = after._jdf.queryExecution().optimizedPlan().toString()
        assert "Aggregate" not in plan and "l_shipdate" not in plan


def test_year_of_pairs_is_that_of_the_first_shipment(spark, scratch):
    base = scratch("lines")
    spark.sql("""SELECT * FROM VALUES (1L, 7L, TIMESTAMP '1997-01-01 00:00:00'), (1L, 7L, TIMESTAMP '1996-12-31 23:59:59'),
              (1L, 7L, NULL), (2L, 7L, NULL), (NULL, 7L, TIMESTAMP '1999-05-05 00:00:00')
              AS t(l_partkey, l_suppkey, l_shipdate)""").write.parquet(f"{base}/lineitem.parquet")
    t = catalog.fx.SourceTables(spark, base)
    want = [(None, 7, 1999), (1, 7, 1996), (2, 7, None)]
    assert sorted(map(tuple, t.pairs().collect()), key=str) == sorted(want, key=str)
    assert sorted(map(tuple, t.pairs(store=True).collect()), key=str) == sorted(want, key=str)


def test_lookup_build_alone_writes_no_term_sums(spark, monkeypatch):
    written = kept_tables(monkeypatch)
    catalog.lookup_features(spark, SF_SMALL)
    assert dict(written)["term_pairs"].columns == ["artist_id", "artist_term", "n_at"]


def test_clean_string_deletes_once_and_holds_for_invalid_utf8(spark):
    column = catalog.clean_string("v")
    assert str(column).count("translate") == 1
    df = spark.sql("SELECT CAST(b AS STRING) AS v FROM VALUES (X'41FF2062'), (X'412062'), (X'C3A941') AS t(b)")
    assert [r[0] for r in df.select(column).collect()] == ["ab", "ab", "a"]


def test_requests_join_by_a_hash_first_and_keep_duplicates_and_nulls(spark):
    features = spark.createDataFrame([("a", "x", 1, 1.0, 1.0, 1.0), ("a", None, 2, 3.0, 3.0, 3.0), (None, "x", 2, 5.0, 5.0, 5.0)],
                                     "artist_name string, title string, td_confidence int, artist_hotness double, "
                                     "song_hotness double, td_meanPrice double")
    requests = spark.createDataFrame([(1, "A", "X"), (1, "A", "X"), (2, "A", None), (3, None, "x"), (4, None, None), (5, "b", "y")],
                                     "request_id int, artist string, title string")
    out = catalog.lk.resolve_features(requests, features)
    assert "xxhash64" in out._jdf.queryExecution().optimizedPlan().toString()
    got = sorted((r.request_id, r.match_level, r.artist_hotness) for r in out.collect())
    assert got == [(1, "exact", 1.0), (1, "exact", 1.0), (2, "artist", 2.0), (3, "title", 3.0), (4, "global", 3.0), (5, "global", 3.0)]
