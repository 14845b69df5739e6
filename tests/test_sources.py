"""Readers and writers on small dirty files."""

import os

from pyspark.sql import functions as F

from trackcast import sinks
from trackcast.sources import delimited as dl


def write_text(path: str, lines: list[str]) -> str:
    local = path[len("file:"):] if path.startswith("file:") else path
    os.makedirs(os.path.dirname(local), exist_ok=True)
    with open(local, "w", encoding="utf-8") as fh:
        fh.write("\n".join(lines) + "\n")
    return path


def test_drop_malformed_for_every_projection(spark, scratch):
    """Q6: wrong-width rows vanish for full reads, count() and one-column reads."""
    path = write_text(scratch("malformed") + "/part.csv",
                      ["a;b;c", "1;2;3", "1;2", "1;2;3;4", '"x;y";NA;'])
    df = dl.read_delimited(spark, path, dl.text_schema("a", "b", "c"), ";", header=True)
    assert sorted(tuple(r) for r in df.collect()) == [("1", "2", "3"), ("x;y", "NA", None)]
    assert df.count() == 2
    assert df.select("a").count() == 2
    assert sorted(r[0] for r in df.select("b").collect()) == ["2", "NA"]


def test_split_drops_trailing_empty_fields(spark, scratch):
    """Q5: a JVM split ignores trailing empty fields."""
    path = write_text(scratch("fields") + "/part.txt",
                      ["h1;h2;h3;h4;h5", "a;b;1;2;good", "a;b;1;2", "a;b;1;2;good;", "a;b;1;2;;"])
    lines = dl.read_split_lines(spark, path, ";", header=True)
    sizes = sorted(r[0] for r in lines.select(F.size("fields")).collect())
    assert sizes == [4, 4, 5, 5]
    kept = dl.keep_field_count(lines, 5).collect()
    assert len(kept) == 2


def test_header_is_the_first_file_s_whatever_the_sizes(spark, scratch):
    base = scratch("hdr_folder")
    write_text(base + "/a.txt", ["x;y", "0;0"])
    write_text(base + "/b.txt", [f"{i};{i}" for i in range(5000)])
    lines = dl.read_split_lines(spark, base, ";", header=True)
    assert lines.count() == 5001 and lines.where(F.col("fields")[0] == "x").count() == 0


def test_header_given_as_text(spark, scratch):
    path = write_text(scratch("hdr") + "/part.txt", ["x;y", "1;2", "x;y", "3;4"])
    lines = dl.read_split_lines(spark, path, ";", header="x;y")
    assert lines.count() == 2


def test_parse_requests_drops_bad_lines(spark, scratch):
    """Q12: bad request lines are dropped, the rest kept."""
    path = write_text(scratch("req") + "/part.txt", ["artist", "a;b;c", "a;b", "Beyoncé;Halo"])
    got = sorted(tuple(r) for r in dl.read_requests(spark, path).collect())
    assert got == [("Beyoncé", "Halo"), ("a", "b")]


def test_feature_file_roundtrip_gzip(spark, scratch):
    df = spark.createDataFrame(
        [("artistone", "songa", 3, 1.5, 0.0, 10.25), ("artisttwo", "songb", -1, 2.0, 1.0, 0.0)],
        "artist_name string, title string, td_confidence int, artist_hotness double, "
        "song_hotness double, td_meanPrice double")
    path = sinks.write_delimited(df, scratch("features"), ",", header=True, compression="gzip")
    back = dl.read_feature_file(spark, path, header=True)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    assert dict(back.dtypes)["td_confidence"] == "int"
    shuffled = sinks.write_delimited(df.select(*sorted(df.columns, reverse=True)), scratch("features"), ",", header=True)
    back = dl.read_feature_file(spark, shuffled, header=True)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_feature_index_file(spark, scratch):
    path = write_text(scratch("index") + "/features.txt", ["13,0,6,1"])
    assert dl.read_feature_index(spark, path) == [0, 1, 6, 13]


def test_materialize_cuts_lineage(spark):
    df = spark.range(100).withColumn("x", F.col("id") * 2)
    out = sinks.materialize(df, "unit")
    assert out.count() == 100
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Relation" in plan and "Range" not in plan


def test_metrics_and_averages_files(spark, scratch):
    metrics = spark.createDataFrame([("testing data", "mse", 1.5)], "set_name string, metric string, value double")
    path = sinks.write_metrics(metrics, scratch("metrics"))
    text = spark.read.text(path).collect()
    assert [r[0] for r in text] == ["testing data;mse;1.5"]
    avg = spark.createDataFrame([(3, 1.0, 2.0, 3.0)], "mean_confidence int, mean_artist_hotness double, "
                                "mean_song_hotness double, mean_mean_price double")
    apath = sinks.write_averages(avg, scratch("averages"))
    lines = [r[0] for r in spark.read.text(apath).collect()]
    assert lines[0] == "mean_confidence,mean_artist_hotness,mean_song_hotness,mean_mean_price"
    assert lines[1] == "3,1.0,2.0,3.0"


def test_real_input_readers_on_dirty_files(spark, scratch):
    from trackcast.sources import files

    base = scratch("dirty_inputs")
    songs = write_text(base + "/song_info.csv", [
        "song_id;track_id;artist_id;artist_name;title;extra;artist_hotttnesss;artist_familiarity;"
        "loudness;tempo;duration;song_hotttnesss;year",
        "s1;t1;a1;Abba;SOS;x;0.5;0.6;-3;120;200;NA;1975",
        "s2;t2;a1;Abba;Waterloo;x;0.5;0.6;-3;120;200;0.7;1974",
        "s3;t3;a2;broken row",
    ])
    got = files.read_song_info(spark, songs)
    assert got.columns[:3] == ["song_id", "track_id", "artist_id"]
    assert sorted(r.song_id for r in got.collect()) == ["s1", "s2"]
    assert got.count() == 2

    terms = write_text(base + "/artist_terms.csv", ["id;term;w;f", "a1;pop;0.5;4", "a2;rock;NA;1"])
    t = files.read_artist_terms(spark, terms)
    assert t.columns == ["artist_id", "artist_term", "weight", "freq"]
    assert t.count() == 2

    downloads = write_text(base + "/downloads.csv", [
        "artist;title;mean_price;downloads;confidence",
        "Abba;SOS;1.5;100;good", "Abba;SOS;bad line", "Queen;Song;2.0;50;very good;"])
    d = files.read_downloads(spark, downloads)
    assert sorted(tuple(r) for r in d.collect()) == [
        ("Abba", "SOS", "1.5", "100", "good"), ("Queen", "Song", "2.0", "50", "very good")]
