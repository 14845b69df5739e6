"""Small DataFrame helpers of the operators: scratch tables, free names, text maps."""

from __future__ import annotations

from collections.abc import Callable, Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared checkpoint folder and read back: cuts the
    lineage and fixes non-deterministic row order for all later uses."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bounded(df: DataFrame, rows: int = 100_000) -> DataFrame:
    """A stored table to join with: broadcast if it has that many narrow rows at
    most, else left to a shuffle join."""
    return F.broadcast(df) if df.count() <= rows else df


def free_names(taken: Iterable[str], wanted: Iterable[str]) -> list[str]:
    """``wanted``, each with underscores appended until no column in ``taken`` has that name."""
    used, out = {x.lower() for x in taken}, []
    for name in wanted:
        while name.lower() in used:
            name += "_"
        used.add(name.lower())
        out.append(name)
    return out


def append_columns(docs: DataFrame, text: str, fields: list[tuple[str, T.DataType]],
                   factory: Callable[[], Callable[[pa.Array], list[pa.Array]]],
                   keep: list[str] | None = None) -> tuple[DataFrame, list[str]]:
    """``docs`` (or its columns ``keep``) with columns computed from the whole
    texts, one Arrow batch at a time and without a shuffle; also the names they
    got (see ``free_names``)."""
    keep = docs.columns if keep is None else keep
    names = free_names(keep, [n for n, _ in fields])
    schema = T.StructType([*(docs.schema[c] for c in keep), *(T.StructField(n, t) for n, (_, t) in zip(names, fields))])
    at, kept, header = docs.columns.index(text), [docs.columns.index(c) for c in keep], [*keep, *names]

    def run(batches):
        work = factory()
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in kept), *work(batch.column(at))], names=header)

    return docs.mapInArrow(run, schema), names


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def row_key(df: DataFrame, *columns: str) -> Column:
    """64-bit hash of a row's columns: equal rows get equal keys, on every run."""
    return F.xxhash64(*[F.col(c) for c in columns])
