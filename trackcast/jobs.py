"""End-to-end jobs over the application's files (what ``spark-submit`` runs).

    features   songs, plays, similar artists, terms, downloads -> lookup table
               (gzip CSV with header), averages file, and the match statistics
               of each level that scoring reads                [L2, A3, A4, K2, K3]
    matrix     all six inputs -> training matrix (Parquet, with the artist
               key for splitting)                               [L3, K1]
    split      matrix -> train / test folders, artist-disjoint  [M6]
    train      train + test -> forest, metrics file, actual-vs-predicted
                                                                [M1-M5, K4, K5, F13]
    score      requests file -> predicted downloads per request [L1, L5, S9, S7]
    report     matrix -> mean/median, correlations, density, k-means [L6]
    stream     request files arriving in a folder -> scores (Structured Streaming)

Every job reads and writes through Spark only; intermediate results are
written tables, so a lost executor never forces a recompute from raw input.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession

from . import sinks
from .operators.lookup import read_match_statistics, resolve_stored, write_match_statistics
from .operators.metrics import actual_vs_predicted
from .operators.split import TEST, TRAIN, artist_split
from .plans import features as feat
from .plans import report as rp
from .plans import scoring as sc
from .plans import training as tr
from .sources.delimited import read_averages, read_requests
from .sources.files import InputPaths, read_music_inputs

MATRIX_KEY_COLUMNS = ("td_artist",)


def build_features(spark: SparkSession, paths: InputPaths, out_dir: str,
                   top_k: int = feat.DEFAULT_TOP_K) -> dict[str, str]:
    inputs = read_music_inputs(spark, paths)
    features = sinks.materialize(feat.lookup_features(inputs, top_k), "lookup_features")
    out = out_dir.rstrip("/")
    feature_path = sinks.write_delimited(features, f"{out}/features", ",", header=True,
                                         compression="gzip")
    averages_path = sinks.write_averages(feat.global_averages(features), f"{out}/averages")
    statistics_path = write_match_statistics(features, f"{out}/match_statistics")
    return {"features": feature_path, "averages": averages_path, "statistics": statistics_path}


def build_training_matrix(spark: SparkSession, paths: InputPaths, out_path: str,
                          top_k: int = feat.DEFAULT_TOP_K) -> str:
    rows = feat.training_rows(read_music_inputs(spark, paths), top_k)
    ordered = rows.orderBy("td_artist", "song_id", "track_id")
    return sinks.write_table(ordered.select(*feat.TRAINING_COLUMNS, *MATRIX_KEY_COLUMNS), out_path)


def split_matrix(spark: SparkSession, matrix_path: str, out_dir: str, train_percent: int = 80) -> dict:
    rows = artist_split(sinks.read_table(spark, matrix_path), "td_artist", train_percent)
    out = out_dir.rstrip("/")
    rows.write.mode("overwrite").partitionBy("split").parquet(out)
    return {TRAIN: f"{out}/split={TRAIN}", TEST: f"{out}/split={TEST}"}


def train_and_evaluate(spark: SparkSession, train_path: str, test_path: str, out_dir: str,
                       feature_index: Sequence[int] = tr.SCORING_FEATURES,
                       num_trees: int = tr.NUM_TREES, max_depth: int = tr.MAX_DEPTH,
                       seed: int = tr.SEED) -> dict:
    """Fit on every training row, evaluate on every row of both sets (read from the written split)."""
    out = out_dir.rstrip("/")
    train = tr.training_set(sinks.read_table(spark, train_path), feature_index)
    test = tr.training_set(sinks.read_table(spark, test_path), feature_index)
    model = tr.train_forest(train, num_trees, max_depth, seed)
    model_path = tr.save_model(model, f"{out}/model")
    metrics = tr.evaluate(model, {tr.TEST_SET_NAME: test, tr.TRAIN_SET_NAME: train})
    metrics_path = sinks.write_metrics(metrics.select("set_name", "metric", "value"), f"{out}/metrics")
    for name, df in ((TEST, test), (TRAIN, train)):
        pairs = actual_vs_predicted(model.transform(df))
        sinks.write_delimited(pairs, f"{out}/actual_predicted/{name}", ",")
    return {"model": model_path, "metrics": metrics_path}


def score_requests_file(spark: SparkSession, requests_path: str, statistics_path: str,
                        model_path: str, out_path: str, averages_path: str | None = None) -> str:
    """Score from the statistics that the ``features`` job has written."""
    averages = read_averages(spark, averages_path) if averages_path else None
    resolved = resolve_stored(read_requests(spark, requests_path), read_match_statistics(spark, statistics_path), averages)
    return sinks.write_table(sc.score_resolved(resolved, tr.load_model(model_path)), out_path)


def column_report(spark: SparkSession, matrix_path: str, out_dir: str) -> dict[str, str]:
    matrix = sinks.read_table(spark, matrix_path)
    out = out_dir.rstrip("/")
    parts: dict[str, DataFrame] = {
        "profile": rp.profile_report(matrix),
        "correlations": rp.correlation_report(matrix),
        "density": rp.density_report(matrix),
        "kmeans": rp.downloads_kmeans(matrix),
    }
    return {name: sinks.write_table(df, f"{out}/{name}") for name, df in parts.items()}


def start_request_stream(spark: SparkSession, requests_dir: str, statistics_path: str,
                         model_path: str, out_path: str, checkpoint: str,
                         averages_path: str | None = None, once: bool = False,
                         trigger: str = "10 seconds", max_files_per_trigger: int | None = None):
    from .streaming import start_scoring

    averages = read_averages(spark, averages_path) if averages_path else None
    return start_scoring(spark, requests_dir, read_match_statistics(spark, statistics_path),
                         tr.load_model(model_path), out_path, checkpoint, averages, available_now=once,
                         processing_time=trigger, max_files_per_trigger=max_files_per_trigger)
