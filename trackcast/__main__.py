"""Command line: ``python -m trackcast <job> [options]`` (or via spark-submit)."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from . import jobs
from .session import RECOMMENDED_CONF, ensure_checkpoint_dir, remove_scratch, scratch_mark
from .sources.delimited import read_feature_index
from .sources.files import InputPaths


def _inputs(a) -> InputPaths:
    return InputPaths(a.song_info, a.play_count, a.similar_artists, a.artist_terms, a.track_likes,
                      a.downloads)


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="trackcast")
    sub = ap.add_subparsers(dest="job", required=True)

    def with_inputs(p):
        for name in ("song_info", "play_count", "similar_artists", "artist_terms", "track_likes",
                     "downloads"):
            p.add_argument(f"--{name.replace('_', '-')}", dest=name, required=True)
        p.add_argument("--top-k", type=int, default=1000)

    p = sub.add_parser("features"); with_inputs(p); p.add_argument("--out", required=True)
    p = sub.add_parser("matrix"); with_inputs(p); p.add_argument("--out", required=True)
    p = sub.add_parser("split")
    p.add_argument("--matrix", required=True); p.add_argument("--out", required=True)
    p.add_argument("--train-percent", type=int, default=80)
    p = sub.add_parser("train")
    p.add_argument("--train", required=True); p.add_argument("--test", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--features", default="0,1,6,13", help="feature positions, comma separated")
    p.add_argument("--feature-index", help="a file with that list; goes before --features")
    p.add_argument("--trees", type=int, default=30); p.add_argument("--depth", type=int, default=5)
    p.add_argument("--seed", type=int, default=42)
    p = sub.add_parser("score")
    p.add_argument("--requests", required=True)
    p.add_argument("--statistics", required=True, help="the match statistics of the features job")
    p.add_argument("--model", required=True); p.add_argument("--out", required=True)
    p.add_argument("--averages")
    p = sub.add_parser("report")
    p.add_argument("--matrix", required=True); p.add_argument("--out", required=True)
    p = sub.add_parser("stream", help="score request files as they arrive in a folder")
    p.add_argument("--requests-dir", required=True); p.add_argument("--statistics", required=True)
    p.add_argument("--model", required=True); p.add_argument("--out", required=True)
    p.add_argument("--checkpoint", required=True, help="the query's checkpoint folder, the same on every start")
    p.add_argument("--averages")
    p.add_argument("--once", action="store_true", help="process what is there, then stop")
    p.add_argument("--trigger", default="10 seconds")
    p.add_argument("--max-files-per-trigger", type=int, help="bound on one micro-batch")
    a = ap.parse_args(argv)

    builder = SparkSession.builder.appName(f"trackcast-{a.job}")
    for key, value in RECOMMENDED_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    started = scratch_mark()

    if a.job == "features":
        result = jobs.build_features(spark, _inputs(a), a.out, a.top_k)
    elif a.job == "matrix":
        result = jobs.build_training_matrix(spark, _inputs(a), a.out, a.top_k)
    elif a.job == "split":
        result = jobs.split_matrix(spark, a.matrix, a.out, a.train_percent)
    elif a.job == "train":
        idx = (read_feature_index(spark, a.feature_index) if a.feature_index
               else [int(x) for x in a.features.split(",") if x.strip()])
        result = jobs.train_and_evaluate(spark, a.train, a.test, a.out, idx, a.trees, a.depth, a.seed)
    elif a.job == "score":
        result = jobs.score_requests_file(spark, a.requests, a.statistics, a.model, a.out, a.averages)
    elif a.job == "report":
        result = jobs.column_report(spark, a.matrix, a.out)
    else:
        query = jobs.start_request_stream(spark, a.requests_dir, a.statistics, a.model, a.out,
                                          a.checkpoint, a.averages, a.once, a.trigger,
                                          a.max_files_per_trigger)
        query.awaitTermination()
        result = {"scores": a.out}
    remove_scratch(spark, started)
    print(json.dumps(result))


if __name__ == "__main__":
    main()
