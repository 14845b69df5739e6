"""The file-based jobs end to end: inputs written as the application's
delimited files, then features -> matrix -> split -> train -> score -> report."""

import pytest
from pyspark.sql import functions as F

from trackcast import jobs, sinks
from trackcast.operators.split import TEST, TRAIN
from trackcast.plans import features as feat
from trackcast.sources import fixtures as fx
from trackcast.sources.files import InputPaths


@pytest.fixture(scope="module")
def input_files(spark, tables):
    from trackcast.session import scratch_path

    base = scratch_path(spark, "inputs")
    w = sinks.write_delimited
    w(fx.song_info(tables), f"{base}/song_info", ";", header=True)
    w(fx.play_count(tables), f"{base}/play_count", ",", header=True)
    w(fx.similar_artists(tables), f"{base}/similar_artists", ";", header=True)
    w(fx.artist_terms(tables), f"{base}/artist_terms", ";", header=True)
    w(fx.track_likes(tables), f"{base}/track_likes", ",", header=True)
    w(fx.downloads(tables), f"{base}/downloads", ";", header=True)
    w(fx.requests(tables).select("artist", "title"), f"{base}/requests", ";")
    paths = InputPaths(*(f"{base}/{n}" for n in ("song_info", "play_count", "similar_artists",
                                                  "artist_terms", "track_likes", "downloads")))
    return base, paths


def rounded_rows(df, digits=6):
    cols = [F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes]
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_pipeline_from_files(spark, tables, input_files, scratch):
    base, paths = input_files
    expected_inputs = fx.music_inputs(tables)

    out = jobs.build_features(spark, paths, scratch("features_job"))
    from trackcast.sources.delimited import read_feature_file
    got = read_feature_file(spark, out["features"], header=True)
    assert rounded_rows(got) == rounded_rows(feat.lookup_features(expected_inputs))

    matrix_path = jobs.build_training_matrix(spark, paths, scratch("matrix_job"))
    matrix = sinks.read_table(spark, matrix_path)
    assert rounded_rows(matrix.select(*feat.TRAINING_COLUMNS)) == rounded_rows(
        feat.training_matrix(expected_inputs, sort_by_artist=False))

    split = jobs.split_matrix(spark, matrix_path, scratch("split_job"))
    train, test = sinks.read_table(spark, split[TRAIN]), sinks.read_table(spark, split[TEST])
    assert train.count() + test.count() == matrix.count()
    overlap = train.select("td_artist").distinct().join(test.select("td_artist").distinct(), "td_artist")
    assert overlap.count() == 0

    model_dir = scratch("train_job")
    trained = jobs.train_and_evaluate(spark, split[TRAIN], split[TEST], model_dir, num_trees=3, max_depth=3)
    metrics = spark.read.option("sep", ";").csv(trained["metrics"])
    assert metrics.count() == 12

    scored_path = jobs.score_requests_file(spark, f"{base}/requests", out["statistics"], trained["model"],
                                           scratch("scores"), out["averages"])
    scored = sinks.read_table(spark, scored_path)
    assert scored.count() == fx.requests(tables).count()
    assert scored.filter(F.col("predicted_downloads").isNull()).count() == 0

    stream_out = scratch("scores_stream")
    q = jobs.start_request_stream(spark, f"{base}/requests", out["statistics"], trained["model"],
                                  stream_out, scratch("stream_checkpoint"), averages_path=out["averages"], once=True)
    q.awaitTermination(120)
    cols = ["artist", "title", "match_level", "predicted_downloads"]
    streamed = spark.read.parquet(stream_out).select(*cols)
    assert sorted(map(tuple, streamed.collect())) == sorted(map(tuple, scored.select(*cols).collect()))

    report = jobs.column_report(spark, matrix_path, scratch("report"))
    assert sinks.read_table(spark, report["profile"]).count() == 16
    assert sinks.read_table(spark, report["correlations"]).count() == 16


def test_cli_report_and_split(spark, tables, scratch, capsys):
    import json

    from trackcast.__main__ import main

    matrix = scratch("cli_matrix")
    rows = feat.training_rows(fx.music_inputs(tables))
    sinks.write_table(rows.select(*feat.TRAINING_COLUMNS, "td_artist"), matrix)
    main(["split", "--matrix", matrix, "--out", scratch("cli_split")])
    split = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert set(split) == {TRAIN, TEST}
    main(["report", "--matrix", matrix, "--out", scratch("cli_report")])
    report = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert sinks.read_table(spark, report["kmeans"]).count() == 8
