"""The music inputs derived from the driver's star-schema tables.

Artist = supplier, song = one (supplier, part) pair, title = part name.  Each
function returns the *raw* table as the application would read it from its
delimited file (names as in the original headers, some values still text),
so the cleaning operators run on it unchanged.

Every input takes all lines of its table but for one condition that leaves keys
missing for the left joins.  Similar artists are the suppliers of neighbouring
lines of an order, so the pair table is linear in the lines.
"""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.artist import similar_artist_count
from ..sinks import materialize


class SourceTables:
    """Parquet readers for the base tables of one scale-factor folder.

    Each table is resolved once and the same relation is handed to every
    view, so identical scans and exchanges in one plan are recognised and
    reused.  Inferred schemas are remembered per file version (path, size,
    modification time), as a catalog would supply them, so later reads skip
    the footer-reading job.
    """

    _schemas: dict[tuple, object] = {}

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._tables: dict[str, DataFrame] = {}
        self._pairs: DataFrame | None = None

    def _version(self, path: str):
        try:
            st = os.stat(path)
            return (path, st.st_size, st.st_mtime_ns)
        except OSError:  # not a local path: no caching
            return None

    def __call__(self, name: str) -> DataFrame:
        if name not in self._tables:
            path = f"{self.root}/{name}.parquet"
            key = self._version(path)
            schema = self._schemas.get(key) if key else None
            reader = self.spark.read.schema(schema) if schema is not None else self.spark.read
            df = reader.parquet(path)
            if key and schema is None:
                self._schemas[key] = df.schema
            self._tables[name] = df
        return self._tables[name]


    def pairs(self, store: bool = False) -> DataFrame:
        """(l_partkey, l_suppkey, year): each pair of the lines once, with the year of its
        first shipment.  A feature build reads the songs twice and a scoring run the requests
        as well: with ``store`` the pairs are written once for all of these views, each file
        in order of the supplier, so that the rows derived from it compress better."""
        if store and self._pairs is None:
            self._pairs = materialize(self.pairs().sortWithinPartitions("l_suppkey", "l_partkey"), "pairs")
        if self._pairs is not None:
            return self._pairs
        return (self("lineitem").groupBy("l_partkey", "l_suppkey")
                .agg(F.min(F.year("l_shipdate")).cast("int").alias("year")))


def _key(c: str) -> F.Column:
    return F.col(c).cast("string")


def song_info(t: SourceTables) -> DataFrame:
    first_ship = t.pairs()
    part = t("part").select("p_partkey", "p_name", "p_size", "p_retailprice")
    supplier = t("supplier").select("s_suppkey", "s_name", "s_acctbal")
    joined = (first_ship.join(part, first_ship.l_partkey == part.p_partkey)
              .join(supplier, first_ship.l_suppkey == supplier.s_suppkey))
    size = F.col("p_size")
    return joined.select(
        _key("l_partkey").alias("song_id"),
        F.concat(_key("l_suppkey"), F.lit("-"), _key("l_partkey")).alias("track_id"),
        _key("l_suppkey").alias("artist_id"),
        F.col("s_name").alias("artist_name"),
        F.col("p_name").alias("title"),
        F.round(F.col("s_acctbal") * 100).alias("artist_hotttnesss"),  # whole: its sums are exact in any order
        (F.col("s_acctbal") / F.lit(10000)).alias("artist_familiarity"),
        (size * F.lit(-0.5)).alias("loudness"),
        (size * F.lit(3.0)).alias("tempo"),
        F.col("p_retailprice").alias("duration"),
        F.when(size % 7 == 0, F.lit("NA")).otherwise(size.cast("string")).alias("song_hotttnesss"),
        F.col("year"),
    )


def play_count(t: SourceTables) -> DataFrame:
    return (t("lineitem").filter(F.col("l_returnflag") == "R")
            .groupBy("l_partkey", "l_suppkey")
            .agg(F.count(F.lit(1)).alias("play_count"))
            .select(_key("l_partkey").alias("play_song_id"),
                    F.concat(_key("l_suppkey"), F.lit("-"), _key("l_partkey")).alias("play_track_id"),
                    "play_count"))


def similar_artists(t: SourceTables) -> DataFrame:
    """The pair table: the supplier of a line and that of the order's next line."""
    line = t("lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    first = line.filter(F.col("l_suppkey") % 7 != 0)
    after = line.select("l_orderkey", (F.col("l_linenumber") - 1).alias("l_linenumber"),
                        F.col("l_suppkey").alias("next_suppkey"))
    return first.join(after, ["l_orderkey", "l_linenumber"]).select(
        _key("l_suppkey").alias("artist_id"), _key("next_suppkey").alias("similar_artist"))


def artist_terms(t: SourceTables) -> DataFrame:
    part = t("part").select("p_partkey", "p_brand", "p_type", "p_size")
    lines = (t("lineitem").select("l_suppkey", "l_partkey", "l_discount", "l_quantity")
             .filter(F.col("l_suppkey") % 11 != 0))
    return (lines.join(part, F.col("l_partkey") == F.col("p_partkey"))
            .select(_key("l_suppkey").alias("artist_id"),
                    F.concat_ws(" ", "p_brand", "p_type", _key("p_size")).alias("artist_term"),
                    F.col("l_discount").alias("weight"),
                    F.col("l_quantity").alias("freq")))


def track_likes(t: SourceTables) -> DataFrame:
    return (t("events").filter(F.col("event_type") == "click")
            .groupBy("user_id").agg(F.count(F.lit(1)).alias("likes"))
            .select(F.concat((F.col("user_id") % 10).cast("string"), F.lit("-"),
                             _key("user_id")).alias("track"),
                    "likes"))


def downloads(t: SourceTables) -> DataFrame:
    lines = (t("lineitem")
             .select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_returnflag")
             .filter(F.col("l_returnflag") == "A"))
    # The first character of the smallest priority is the smallest first
    # character; aggregating its code keeps this a hash aggregate (a string
    # min would need a sort-based one).  The orders, the largest side, come first:
    # the lines cross that shuffle before they carry names.
    joined = (t("orders").select("o_orderkey", F.ascii("o_orderpriority").alias("o_prio"))
              .join(lines, F.col("l_orderkey") == F.col("o_orderkey"))
              .join(t("supplier").select("s_suppkey", "s_name"), F.col("l_suppkey") == F.col("s_suppkey"))
              .join(t("part").select("p_partkey", "p_name"), F.col("l_partkey") == F.col("p_partkey")))
    grouped = joined.groupBy("s_name", "p_name").agg(
        F.avg("l_extendedprice").alias("mean_price"),
        F.sum("l_quantity").alias("downloads"),
        F.min("o_prio").alias("_prio"))
    prio = F.col("_prio")
    word = (F.when(prio == ord("1"), "excellent").when(prio == ord("2"), "very good")
            .when(prio == ord("3"), "good").when(prio == ord("4"), "average").otherwise("unrated"))
    return grouped.select(F.col("s_name").alias("artist"), F.col("p_name").alias("title"),
                          "mean_price", "downloads", word.alias("confidence"))


def requests(t: SourceTables, songs: DataFrame | None = None) -> DataFrame:
    """A request per (supplier, part) pair of the lines, over all artists; in turn for
    an artist and title that exist, one of the two, or neither.  ``songs``: the written
    :func:`song_info`, whose rows are these pairs with the same names already joined."""
    if songs is None:
        named = (t.pairs().select("l_partkey", "l_suppkey")
                 .join(t("part").select("p_partkey", "p_name"), F.col("l_partkey") == F.col("p_partkey"))
                 .join(t("supplier").select("s_suppkey", "s_name"), F.col("l_suppkey") == F.col("s_suppkey")))
    else:
        named = songs.select(F.col("song_id").cast("long").alias("l_partkey"), F.col("artist_id").cast("long").alias("l_suppkey"),
                             F.col("artist_name").alias("s_name"), F.col("title").alias("p_name"))
    kind = (F.col("l_partkey") + F.col("l_suppkey")) % 4
    name = F.concat(_key("l_suppkey"), F.lit("-"), _key("l_partkey"))
    return (named
            .select(name.alias("request_id"),
                    F.when(kind < 2, F.col("s_name")).otherwise(F.concat(F.lit("nobody "), name)).alias("artist"),
                    F.when(kind % 2 == 0, F.col("p_name")).otherwise(F.concat(F.lit("nothing "), name)).alias("title")))


@dataclass
class MusicInputs:
    """The six raw inputs of the feature jobs."""

    song_info: DataFrame
    play_count: DataFrame
    similar_counts: DataFrame  # (artist_id, similar_artist_count)
    artist_terms: DataFrame
    track_likes: DataFrame
    downloads: DataFrame


def music_inputs(t: SourceTables, store_pairs: bool = True) -> MusicInputs:
    """``store_pairs``: off where the songs themselves are written, the pairs' only reader then."""
    if store_pairs:
        t.pairs(store=True)
    return MusicInputs(
        song_info=song_info(t),
        play_count=play_count(t),
        similar_counts=similar_artist_count(similar_artists(t)),
        artist_terms=artist_terms(t),
        track_likes=track_likes(t),
        downloads=downloads(t),
    )
