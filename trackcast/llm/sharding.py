"""Sharding by sampled splitters.

Records are ordered by (key, hash of the row, position hash) and cut into
contiguous shards of nearly equal bytes:

1. a size-weighted sample of the order keys is drawn (every record with a
   probability in proportion to its bytes, plus an equal share for each record,
   so that neither bytes nor row counts can pile up in a range);
2. weighted quantiles of the sample are the splitters of ``ranges_per_shard``
   ranges per shard; exact range totals are counted, and overfull ranges are
   sampled again and subdivided until none is left;
3. the records are range-partitioned, ranked within their range, and written
   once; a range's offset plus the running bytes of a record give its exact
   place in the whole order, hence its shard and its slot.

The driver holds splitters and one total per range only (their number grows by
one per ``rows_per_range`` records).  A key that holds a third of all rows is
split by the row hash, and repeated rows by the position hash.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from .frames import free_names, stored

SHARDS = 16
RANGES_PER_SHARD = 64
ROWS_PER_RANGE = 1_000_000
SAMPLES_PER_RANGE = 32
OVERFULL = 2.0  # times the mean share of a range
SEED = 11


def _sortable(keys: np.ndarray) -> np.ndarray:
    """Rows of signed 64-bit keys as byte strings in the same order."""
    flipped = np.ascontiguousarray(keys, dtype=np.int64).view(np.uint64) ^ np.uint64(1 << 63)
    return np.ascontiguousarray(flipped.astype(">u8")).view(f"S{8 * keys.shape[1]}").ravel()


def _range_of(splitters: np.ndarray, *keys: str) -> Column:
    """Index of the range of a record: the number of splitters at or below its key."""
    held = _sortable(splitters) if len(splitters) else np.zeros(0, "S24")

    @F.pandas_udf(T.IntegerType())
    def index(a: pd.Series, b: pd.Series, c: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(held, _sortable(np.stack([a, b, c], axis=1)), side="right").astype(np.int32))

    return index(*keys)


def _quantiles(sample: np.ndarray, weight: np.ndarray, parts: int) -> np.ndarray:
    """Keys that cut the sorted weighted sample into ``parts`` equal parts."""
    if parts < 2 or not len(sample):
        return sample[:0]
    total = np.cumsum(weight)
    at = np.searchsorted(total, total[-1] * np.arange(1, parts) / parts)
    return sample[np.unique(at[at > 0])]


def _draw(rows: DataFrame, chance: Column) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(keys, weights, ranges) of the records drawn with the given chance, in key order.
    The draw is a hash of the record, so that a task that runs again draws the same."""
    u = F.shiftrightunsigned(F.xxhash64("k2", "k3", F.lit(SEED)), 11) / F.lit(float(1 << 53))
    got = rows.withColumn("chance", chance).where(u < F.col("chance")).select(
        "k1", "k2", "k3", F.greatest("chance", F.lit(1.0)).alias("w"), "range").toPandas()
    keys = got[["k1", "k2", "k3"]].to_numpy(np.int64).reshape(-1, 3)
    order = np.lexsort((keys[:, 2], keys[:, 1], keys[:, 0]))
    return keys[order], got["w"].to_numpy()[order], got["range"].to_numpy()[order]


def splitters(keyed: DataFrame, parts: int, total_bytes: int, total_rows: int) -> np.ndarray:
    """Splitters of about ``parts`` ranges of ``keyed`` (k1, k2, k3, size), none
    of them overfull unless a single record makes it so."""
    share = F.col("size") / F.lit(2.0 * total_bytes) + F.lit(0.5 / total_rows)  # sums to 1
    scale = float(parts * SAMPLES_PER_RANGE)
    sample, weight, _ = _draw(keyed.withColumn("range", F.lit(0)), share * scale)
    cuts = _quantiles(sample, weight, parts)
    while True:
        ranged = keyed.withColumn("range", _range_of(cuts, "k1", "k2", "k3")).withColumn("share", share)
        full = [r for r in ranged.groupBy("range").agg(F.sum("share").alias("s"), F.max("share").alias("m")).collect()
                if r["s"] - r["m"] > OVERFULL / parts]
        if not full:
            return cuts
        scale *= 8  # a denser draw, from the overfull ranges only
        sample, weight, at = _draw(ranged.where(F.col("range").isin([r["range"] for r in full])), F.col("share") * scale)
        more = [_quantiles(sample[at == r["range"]], weight[at == r["range"]], int(np.ceil(r["s"] * parts)) + 1) for r in full]
        grown = np.unique(np.concatenate([cuts, *more]), axis=0)
        if len(grown) == len(cuts):
            return cuts
        cuts = grown


def shard(docs: DataFrame, shards: int = SHARDS, key: str = "doc_id", size: Column | None = None,
          ranges_per_shard: int = RANGES_PER_SHARD, rows_per_range: int = ROWS_PER_RANGE) -> tuple[DataFrame, list[str]]:
    """``docs`` with a shard (0 to ``shards`` - 1) and a gapless slot in it, and the names these columns got.

    ``key`` is an integer column; null keys come first.  ``size`` is a record's
    bytes (default: those of ``text``, null: none, plus 1).  Shards are
    contiguous in the key's order, and the bytes of two shards differ by about
    the largest record at most.  Repeated rows are separate records; extra
    columns are kept; an empty table stays empty.
    """
    if size is None:
        size = F.coalesce(F.octet_length("text"), F.lit(0)) + 1
    names = free_names(docs.columns, ["shard", "slot", "k1", "k2", "k3", "size", "range", "rank", "upto"])
    out, (k1, k2, k3, sz, rng, rank, upto) = names[:2], names[2:]
    keyed = docs.withColumns({
        k1: F.coalesce(F.col(key).cast("long"), F.lit(-(1 << 63))),
        k2: F.xxhash64(*docs.columns),
        k3: F.xxhash64(F.monotonically_increasing_id()),
        sz: size.cast("long")})
    narrow = stored(keyed.select(F.col(k1).alias("k1"), F.col(k2).alias("k2"), F.col(k3).alias("k3"), F.col(sz).alias("size")), "shard-keys")
    all_bytes, all_rows = narrow.agg(F.sum("size"), F.count("*")).first()
    if not all_rows:
        return docs.withColumns({out[0]: F.lit(None).cast("int"), out[1]: F.lit(None).cast("long")}), out
    cuts = splitters(narrow, max(shards * ranges_per_shard, -(-all_rows // rows_per_range)), max(1, all_bytes), all_rows)

    place = W.partitionBy(rng).orderBy(k1, k2, k3)
    ranged = stored(keyed.withColumn(rng, _range_of(cuts, k1, k2, k3)).withColumns({
        rank: F.row_number().over(place).cast("long"),
        upto: F.sum(sz).over(place.rowsBetween(W.unboundedPreceding, 0))}), "shard-ranges")
    offsets, rows_before, bytes_before = [], 0, 0
    for r in sorted(ranged.groupBy(rng).agg(F.max(rank).alias("n"), F.max(upto).alias("b")).collect()):
        offsets.append((r[0], rows_before, bytes_before))
        rows_before, bytes_before = rows_before + r["n"], bytes_before + r["b"]
    ahead = docs.sparkSession.createDataFrame(offsets, f"`{rng}` int, rows_ahead long, bytes_ahead long")
    middle = (F.col("bytes_ahead") + F.col(upto)) * 2 - F.col(sz)  # of the record, in half bytes
    placed = ranged.join(F.broadcast(ahead), rng).withColumns({
        out[0]: F.least(F.lit(shards - 1), F.floor(middle * shards / F.lit(2.0 * max(1, bytes_before)))).cast("int"),
        out[1]: F.col("rows_ahead") + F.col(rank) - 1})
    first = placed.groupBy(out[0]).agg(F.min(out[1]).alias("first_row"))  # a row per shard
    return (placed.join(F.broadcast(first), out[0])
            .withColumn(out[1], F.col(out[1]) - F.col("first_row"))
            .select(*docs.columns, *out)), out


def write_shards(sharded: DataFrame, path: str, shard_column: str = "shard", slot: str = "slot") -> None:
    """One folder per shard, rows in slot order; a shard's files are written by several tasks."""
    (sharded.repartitionByRange(shard_column, slot).sortWithinPartitions(shard_column, slot)
     .write.partitionBy(shard_column).parquet(path))


def digest(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """One row per document: the columns of query ``op1_sharding`` (a null text has no bytes, crc32 0)."""
    raw = F.coalesce(F.col("text"), F.lit(""))
    small = stored(docs.select("doc_id", (F.octet_length(raw) + 1).cast("long").alias("size"),
                               F.crc32(raw.cast("binary")).alias("text_crc32")), "shard-sizes")
    out, (s, slot) = shard(small, shards, size=F.col("size"))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"),
                      F.col(s).alias("shard"), F.col(slot).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
