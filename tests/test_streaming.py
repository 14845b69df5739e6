"""Streaming scorer equals the batch scorer on the same requests."""

import os

import pytest

from trackcast import sinks
from trackcast.operators import lookup as lk
from trackcast.plans import features as feat
from trackcast.plans import scoring as sc
from trackcast.plans import training as tr
from trackcast.sources import fixtures as fx
from trackcast.streaming import start_scoring


def test_stream_scores_like_batch(spark, tables, scratch):
    inputs = fx.music_inputs(tables)
    features = sinks.materialize(feat.lookup_features(inputs), "features")
    model = tr.train_forest(tr.training_set(feat.training_matrix(inputs, sort_by_artist=False)),
                            num_trees=3, max_depth=3)
    reqs = fx.requests(tables).select("artist", "title")

    folder = scratch("requests_in")
    local = folder[len("file:"):] if folder.startswith("file:") else folder
    os.makedirs(local, exist_ok=True)
    lines = [f"{r.artist};{r.title}" for r in reqs.collect()]
    half = len(lines) // 2
    for i, chunk in enumerate((lines[:half], lines[half:] + ["not a request", "a;b;c"])):
        with open(os.path.join(local, f"batch{i}.txt"), "w", encoding="utf-8") as fh:
            fh.write("\n".join(chunk) + "\n")

    out = scratch("scored_stream")
    stats = lk.read_match_statistics(spark, lk.write_match_statistics(features, scratch("statistics")))
    checkpoint = scratch("checkpoint")
    start_scoring(spark, folder, stats, model, out, checkpoint, available_now=True).awaitTermination(120)
    assert spark.read.parquet(out).count() == len(lines)
    with open(os.path.join(local, "later.txt"), "w", encoding="utf-8") as fh:  # a restart scores what came since
        fh.write("Somebody;Else\n")
    start_scoring(spark, folder, stats, model, out, checkpoint, available_now=True).awaitTermination(120)
    got = spark.read.parquet(out).select("artist", "title", "match_level", "predicted_downloads")
    reqs = reqs.union(spark.createDataFrame([("Somebody", "Else")], "artist string, title string"))
    want = sc.score_requests(reqs, features, model).select("artist", "title", "match_level",
                                                           "predicted_downloads")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    empty = lk.read_match_statistics(spark, lk.write_match_statistics(features.limit(0), scratch("statistics")))
    with pytest.raises(ValueError):
        start_scoring(spark, folder, empty, model, scratch("none"), scratch("checkpoint"), available_now=True)
