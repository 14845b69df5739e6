"""Readers for the application's delimited files.

Every column is read as text against an explicit schema and typed afterwards
by the cleaning operators, so a stray ``NA`` never fails a read.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def text_schema(*names: str) -> StructType:
    return StructType([StructField(n, StringType(), True) for n in names])


# Column layouts of the inputs (the names the original headers use).
SONG_INFO_COLUMNS = ("song_id", "track_id", "artist_id", "artist_name", "title",
                     "artist_hotttnesss", "artist_familiarity", "loudness", "tempo",
                     "duration", "song_hotttnesss", "year")
PLAY_COUNT_COLUMNS = ("play_song_id", "play_track_id", "play_count")
SIMILAR_ARTISTS_COLUMNS = ("artist_id", "similar_artist")
ARTIST_TERMS_COLUMNS = ("artist_id", "artist_term", "weight", "freq")
TRACK_LIKES_COLUMNS = ("track", "likes")
DOWNLOADS_COLUMNS = ("artist", "title", "mean_price", "downloads", "confidence")
REQUEST_COLUMNS = ("artist", "title")
FEATURE_COLUMNS = ("artist_name", "title", "td_confidence", "artist_hotness",
                   "song_hotness", "td_meanPrice")


def read_delimited(spark: SparkSession, path, schema: StructType | None = None, sep: str = ",",
                   header: bool = True) -> DataFrame:
    """CSV with a fixed column count; rows of another width are dropped.

    Without ``schema`` the header names the (text) columns and fixes the
    width.  ``columnPruning`` is switched off so the drop happens for every
    projection, including ``count()`` (with pruning, short rows survive
    narrow reads).
    """
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return (reader
            .option("header", header)
            .option("sep", sep)
            .option("mode", "DROPMALFORMED")
            .option("columnPruning", False)
            .csv(path))


def split_fields(line: Column | str, sep: str) -> Column:
    """Split like the JVM's ``String.split``: ``sep`` is a regex and trailing
    empty fields are dropped (``'a;b;;;'`` has two fields)."""
    line = F.col(line) if isinstance(line, str) else line
    return F.split(F.regexp_replace(line, f"(?:{sep})+$", ""), sep)


def first_line(lines: DataFrame) -> str | None:
    """The first line of the first non-empty file in name order, of a text read:
    the least start of a block of that file, read alone."""
    at = lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    least = at.agg(F.min(F.struct("file", "start")).alias("least")).first()["least"]
    if least is None:
        return None
    row = lines.where((F.col("_metadata.file_path") == least["file"])
                      & (F.col("_metadata.file_block_start") == least["start"])).first()
    return row["value"]


def read_split_lines(spark: SparkSession, path: str, sep: str,
                     header: bool | str = False, fields: str = "fields") -> DataFrame:
    """One array of text fields per line.

    ``header=True`` takes the first line of the first file (by name) that is not
    empty for the header and removes every line equal to it (it is repeated once
    per part file of a written directory); pass the header text itself to avoid
    the look-up.
    """
    lines = spark.read.text(path)
    if header is True:
        header = first_line(lines)
    if isinstance(header, str):
        lines = lines.filter(F.col("value") != F.lit(header))
    return lines.select(split_fields("value", sep).alias(fields))


def keep_field_count(df: DataFrame, n: int, fields: str = "fields") -> DataFrame:
    """Rows with exactly ``n`` fields."""
    return df.filter(F.size(fields) == n)


def fields_to_columns(df: DataFrame, names: Sequence[str], fields: str = "fields") -> DataFrame:
    return df.select(*[F.col(fields).getItem(i).alias(n) for i, n in enumerate(names)])


def parse_requests(lines: DataFrame, sep: str = ";", value: str = "value") -> DataFrame:
    """``artist;title`` lines; any line without exactly two fields is dropped."""
    parts = lines.select(split_fields(value, sep).alias("fields"))
    return fields_to_columns(keep_field_count(parts, 2), REQUEST_COLUMNS)


def read_requests(spark: SparkSession, path: str, sep: str = ";") -> DataFrame:
    return parse_requests(spark.read.text(path), sep)


def read_feature_file(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """The lookup-feature CSV (gzip or plain; Spark decompresses by extension).

    With a header the columns are found by its names, in any order; without one
    they are taken by position.  Types are restored here.
    """
    raw = read_delimited(spark, path, None if header else text_schema(*FEATURE_COLUMNS), ",", header)
    return raw.select(
        "artist_name", "title",
        F.col("td_confidence").try_cast("int").alias("td_confidence"),
        *[F.col(c).try_cast("double").alias(c) for c in ("artist_hotness", "song_hotness", "td_meanPrice")],
    )


AVERAGE_COLUMNS = ("mean_confidence", "mean_artist_hotness", "mean_song_hotness", "mean_mean_price")


def read_averages(spark: SparkSession, path: str) -> DataFrame:
    """The one-row averages file (K3), its columns found by the header's names."""
    raw = read_delimited(spark, path, None, ",", header=True)
    return raw.select(F.col(AVERAGE_COLUMNS[0]).try_cast("double").cast("int").alias(AVERAGE_COLUMNS[0]),
                      *[F.col(c).try_cast("double").alias(c) for c in AVERAGE_COLUMNS[1:]])


def read_feature_index(spark: SparkSession, path: str) -> list[int]:
    """The one-line list of feature positions (a tiny config file)."""
    row = spark.read.text(path).first()
    if row is None:
        return []
    return sorted({int(float(x)) for x in row["value"].split(",") if x.strip()})
