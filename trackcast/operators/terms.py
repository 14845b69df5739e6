"""Genre terms: average hotness per term (J7, A2), top-k (T1), overlap (A6, O1),
term weight sums (A5).

The term average is defined over the join of term rows with song rows on the
artist.  That join is many-to-many per artist (terms x songs), so it is never
built: each side is first reduced to one row per key,

    per (artist, term):  n_at = term rows                      (term_pairs)
    per artist:          h_sum = sum(hotness), h_n = count(hotness)

and avg(term) = sum(n_at * h_sum) / sum(n_at * h_n), which is exactly the
average over the exploded join (NULL hotness skipped, as ``avg`` does).

The one ``(artist, term)`` aggregate also carries the weight x frequency sums,
so every term feature comes from a single scan and shuffle of the term table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import weight_times_freq

# The reference keeps this many terms.
DEFAULT_TOP_K = 1000


def term_pairs(terms: DataFrame) -> DataFrame:
    """(artist_id, artist_term, n_at, wf_sum, wf_n): one row per artist and term.

    ``wf_sum``/``wf_n`` are the sum and count of weight x frequency over the
    rows where both parse as numbers.  Map-side partial aggregation keeps a hot
    artist to one partial row per (term, map task).
    """
    wf = weight_times_freq("weight", "freq")
    return (terms.groupBy(F.col("artist_id").cast("string").alias("artist_id"), "artist_term")
            .agg(F.count(F.lit(1)).alias("n_at"), F.sum(wf).alias("wf_sum"),
                 F.count(wf).alias("wf_n")))


def term_counts(terms: DataFrame) -> DataFrame:
    """(artist_id, artist_term, n_at): :func:`term_pairs` for a build that reads no term sums."""
    return term_pairs(terms).select("artist_id", "artist_term", "n_at")


def artist_song_stats(songs: DataFrame, hotness: Column | str, other: Column | None = None) -> DataFrame:
    """(artist_id, song_count, h_sum, h_n) over the song rows of each artist; ``other``: a second
    reading of the hotness, as o_sum and o_n."""
    h = F.col(hotness) if isinstance(hotness, str) else hotness
    more = [] if other is None else [F.sum(other).alias("o_sum"), F.count(other).alias("o_n")]
    return (songs.groupBy(F.col("artist_id").cast("string").alias("artist_id"))
            .agg(F.count("song_id").alias("song_count"), F.sum(h).alias("h_sum"),
                 F.count(h).alias("h_n"), *more))


def term_hotness(pairs: DataFrame, song_stats: DataFrame) -> DataFrame:
    """(artist_term, artist_hotness): mean song-row hotness over the artists using
    a term, weighted as the term x song join would weight it (J7 is inner).
    Statistics with a second reading of the hotness give its mean as ``other_hotness``."""
    readings = {"artist_hotness": ("h_sum", "h_n"), "other_hotness": ("o_sum", "o_n")}
    if "o_sum" not in song_stats.columns:
        del readings["other_hotness"]
    joined = pairs.select("artist_id", "artist_term", "n_at").join(
        song_stats.select("artist_id", *[c for two in readings.values() for c in two]), "artist_id")
    return joined.groupBy("artist_term").agg(*[
        F.try_divide(F.sum(F.col("n_at") * F.col(total)),
                     F.sum(F.col("n_at") * F.col(n)).cast("double")).alias(name)
        for name, (total, n) in readings.items()])


def top_terms(hotness_by_term: DataFrame, k: int = DEFAULT_TOP_K) -> DataFrame:
    """The k hottest terms, hottest first.

    Ordered by the exact average; equal averages by the term, so the cut is
    stable.  ``orderBy().limit()`` plans as a bounded per-partition top-k.
    """
    return hotness_by_term.orderBy(F.desc_nulls_last("artist_hotness"), F.asc("artist_term")).limit(k)


def mark_top(pairs: DataFrame, top: DataFrame, flag: str = "_is_top") -> DataFrame:
    """Every pair, ``flag`` 1 for a top term's and null for another's."""
    flags = top.select("artist_term").withColumn(flag, F.lit(1))
    return pairs.join(flags, "artist_term", "left")


def term_features(pairs: DataFrame, top: DataFrame, k: int, overlap_col: str,
                  other_top: DataFrame | None = None, other_col: str | None = None) -> DataFrame:
    """Per artist having terms: the top-term overlap (A6/O1, 0 when none), the
    weight x frequency sum (A5, NULL when no row parses) and its row count.

    The planner knows that the top table has at most ``k`` rows (it is a limit)
    and broadcasts it while that is small; a single grouped pass does the rest.
    ``other_top``, ``other_col``: the overlap with a second top table in the same pass.
    """
    marked, more = mark_top(pairs, top), []
    if other_top is not None:
        marked = mark_top(marked, other_top, "_is_other_top")
        more = [F.count("_is_other_top").cast("int").alias(other_col)]
    return marked.groupBy("artist_id").agg(
        F.count("_is_top").cast("int").alias(overlap_col), *more,
        F.sum("wf_sum").alias("weight_dot_freq"),
        F.sum("wf_n").alias("wf_rows"))


def genre_overlap(pairs: DataFrame, top: DataFrame, k: int, out_col: str = "top_count") -> DataFrame:
    """Per artist, how many of its distinct terms are top terms."""
    return mark_top(pairs, top).groupBy("artist_id").agg(F.count("_is_top").cast("int").alias(out_col))

