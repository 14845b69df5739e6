"""Writers (K1-K4) and the read-back of written tables.

Nothing is funnelled into one task unless asked: ``single_file=True`` is an
explicit opt-in for small outputs (it serialises the final write).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .session import scratch_path


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """K1: an intermediate table as Parquet."""
    df.write.mode(mode).parquet(path)
    return path


def read_table(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """Read back a written intermediate (a known schema skips inference)."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and continue from the
    files: cuts the lineage so lost executors never recompute the upstream,
    and the planner sees the table's true size."""
    path = write_table(df, scratch_path(df.sparkSession, name))
    return read_table(df.sparkSession, path, df.schema)


def write_delimited(df: DataFrame, path: str, sep: str = ",", header: bool = False,
                    compression: str | None = None, single_file: bool = False,
                    mode: str = "overwrite") -> str:
    """K2: delimited text (e.g. the feature file, gzip for the scorer's copy)."""
    out = df.coalesce(1) if single_file else df
    w = out.write.mode(mode).option("sep", sep).option("header", header)
    if compression:
        w = w.option("compression", compression)
    w.csv(path)
    return path


def write_averages(averages: DataFrame, path: str) -> str:
    """K3: the one-row averages file with its header."""
    return write_delimited(averages, path, ",", header=True, single_file=True)


def write_metrics(metrics: DataFrame, path: str) -> str:
    """K4: ``set;metric;value`` lines without header."""
    return write_delimited(metrics, path, ";", header=False, single_file=True)
