"""Mixing sources to target weights by systematic sampling, in DataFrame functions only.

Every source gets a target number of words; each of its documents then expects
``target / size`` copies.  The documents of a source stand in a line (by size
class, then by a hash), the expected copies are prefix-summed, one random
offset per source is added, and a document is emitted once per integer boundary
that its stretch crosses.  Standing by size makes the words taken come close to
the target: neighbours that stand in for each other have about equal sizes, and
whatever the offset is, a source's words miss its target by less than its largest
document.  For sources of few documents the offset matters too: of ``OFFSETS`` evenly
spaced ones from a random start, that whose words come nearest to the target is taken.

The prefix sum has two levels, so that a source with a third of all rows is not
one task: places inside a bucket (a range of the hash inside a size class of a
source), and running totals over the buckets.  Equal rows are one entry with a
count.  A bucket holds about ``max(BUCKET_ROWS, rows / MAX_BUCKETS)`` rows; the
result does not depend on that number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .frames import bounded, free_names, stored

WEIGHTS = (5, 2, 1)   # of the sources in code point order, null last, repeating
SHARE = 1.5           # of all words
MOST = 2.0            # times a source's words, and times a document
MAX_BUCKETS = 200_000
BUCKET_ROWS = 256     # least rows of a bucket
OFFSETS = 64
SEED = "mix-1"
_SLICE = 4096         # copies of one repeated row that are generated together

#: Sixteen classes from a power of two to the next, in the order of the sizes.
_CLASS = "case when size < 16 then size else (length(bin(size)) - 4) * 16 + shiftright(size, length(bin(size)) - 5) - 16 end"


def words_in(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _bits(hexadecimal: Column) -> Column:
    """The first 32 bits of an md5."""
    return F.conv(F.substring(hexadecimal, 1, 8), 16, 10).cast("long")


def _order_hash(doc_id: str, text: str) -> Column:
    return F.md5(F.concat(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.lit("|"), F.coalesce(F.col(text), F.lit(""))))


def _repeat(df: DataFrame, times: str, index: str = "i") -> DataFrame:
    """Each row ``times`` times, numbered from 0, in slices so that no array grows with ``times``."""
    return (df.where(F.col(times) > 0)
            .withColumn("slice", F.explode(F.sequence(F.lit(0), F.col(times) - 1, F.lit(_SLICE))))
            .withColumn(index, F.explode(F.sequence("slice", F.least(F.col("slice") + _SLICE, F.col(times)) - 1)))
            .drop("slice"))


def _running(df: DataFrame, order: list[str], sums: dict[str, str]) -> DataFrame:
    """``df``, stored, with the sums of columns (name: column) over the rows that stand before by
    ``order``, a unique key: running totals inside ranges of rows and over the ranges, of which
    there are as many as shuffle partitions, so that no task holds all rows."""
    ranged = stored(df.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "mix-ranged")
    earlier = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    inside = W.partitionBy("part").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    parts = (ranged.groupBy("part").agg(*[F.sum(c).alias(f"{name}_in") for name, c in sums.items()])
             .select("part", *[F.coalesce(F.sum(f"{name}_in").over(earlier), F.lit(0)).alias(f"{name}_ahead") for name in sums]))
    out = ranged.join(stored(parts, "mix-parts"), "part")
    return stored(out.select(*df.columns, *[(F.col(f"{name}_ahead") + F.coalesce(F.sum(c).over(inside), F.lit(0))).alias(name)
                                            for name, c in sums.items()]), "mix-running")


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """Targets of the sources in ``sizes`` (key, source_size; a row per source, sorted by key).

    The targets add up to ``share`` of all sizes by weight; one stops at
    ``most`` times its source's size and the excess is shared again by weight
    until none is above.  That makes ``least(cap, level * weight)`` for one
    level: with the sources by cap per weight, it is the level that the first
    source under its cap gets when all before it have their caps.
    """
    ranked = _running(sizes.withColumn("one", F.lit(1)), ["key"], {"place": "one"})
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    filled = _running(ranked.select("key", "source_size", weight.alias("weight"), (F.col("source_size") * F.lit(most)).alias("cap"))
                      .withColumn("fill", F.col("cap") / F.col("weight")), ["fill", "key"], {"capped": "cap", "passed": "weight"})
    words, weighing = filled.agg(F.sum("source_size"), F.sum("weight")).first()
    level = (F.lit((words or 0) * share) - F.col("capped")) / (F.lit(weighing or 0.0) - F.col("passed"))
    at = filled.where(level <= F.col("fill")).agg(F.max(level)).first()[0]
    return filled.select("key", "source_size", (F.col("cap") if at is None else F.least("cap", F.lit(at) * F.col("weight"))).alias("target"))


def entries(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """A row per different record: key (of the source), size, class, hash h, row hash k, and its number n."""
    return stored(
        docs.select(F.coalesce(F.concat(F.lit("="), F.col(source)), F.lit("~")).alias("key"),
                    F.col(doc_id).alias("id"), words_in(F.col(text)).alias("size"),
                    _order_hash(doc_id, text).alias("h"), F.xxhash64(*docs.columns).alias("k"))
        .groupBy("key", "id", "size", "h", "k").agg(F.count("*").alias("n"))
        .withColumn("class", F.expr(_CLASS)), "mix-entries")


def placed(found: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST, seed: str = SEED) -> DataFrame:
    """The entries with source_size, target, rate (expected copies of a row),
    offset (in 1024ths), and ahead (rows of the source that stand before)."""
    groups = found.groupBy("key", "class").agg(F.sum("n").alias("rows"), F.sum(F.col("n") * F.col("size")).alias("words"))
    all_rows = groups.agg(F.sum("rows")).first()[0] or 0
    per_bucket = max(BUCKET_ROWS, all_rows // MAX_BUCKETS)
    groups = stored(groups.withColumn("parts", F.ceil(F.col("rows") / per_bucket)), "mix-groups")
    targets = source_targets(groups.groupBy("key").agg(F.sum("words").alias("source_size")), weights, share, most)
    targets = targets.withColumn("rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))
    targets = targets.withColumn("start", _bits(F.md5(F.concat(F.lit(f"{seed}|"), F.col("key")))) % 1024)

    bucketed = found.join(bounded(groups.select("key", "class", "parts")), ["key", "class"]).withColumn(
        "bucket", F.floor(_bits(F.col("h")) * F.col("parts") / F.lit(float(1 << 32))))
    before = W.partitionBy("key").orderBy("class", "bucket").rowsBetween(W.unboundedPreceding, -1)
    buckets = (bucketed.groupBy("key", "class", "bucket").agg(F.sum("n").alias("in_bucket"))
               .withColumn("bucket_ahead", F.coalesce(F.sum("in_bucket").over(before), F.lit(0)))
               .join(targets, "key").drop("in_bucket"))
    inside = W.partitionBy("key", "class", "bucket").orderBy("h", "k").rowsBetween(W.unboundedPreceding, -1)
    lined = stored(bucketed.join(stored(buckets, "mix-buckets"), ["key", "class", "bucket"])
                   .withColumn("ahead", F.col("bucket_ahead") + F.coalesce(F.sum("n").over(inside), F.lit(0))), "mix-lined")
    offsets = [(F.col("start") + k * (1024 // OFFSETS)) % 1024 for k in range(OFFSETS)]
    tried = lined.groupBy("key").agg(F.first("target").alias("target"), *[
        F.sum(_copies(F.col("ahead"), F.col("n"), u, most) * F.col("size")).alias(f"w{k}") for k, u in enumerate(offsets)],
        F.first("start").alias("start"))
    nearest = F.array_min(F.array(*[F.struct(F.abs(F.col(f"w{k}") - F.col("target")).alias("off"), F.lit(k).alias("k"), u.alias("u"))
                                    for k, u in enumerate(offsets)]))
    return lined.join(bounded(stored(tried.select("key", nearest["u"].alias("offset")), "mix-offsets")), "key")


def _copies(first: Column, rows: Column, offset: Column, most: float = MOST) -> Column:
    """Integer boundaries crossed by the stretch of ``rows`` rows from place ``first``."""
    upto = F.floor((first + rows) * F.col("rate") + offset / 1024)
    return F.least(upto - F.floor(first * F.col("rate") + offset / 1024), rows * -int(-most // 1))


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST, seed: str = SEED,
        doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The documents, each as often as the mix takes it (0 to ``most`` times), with their columns.

    A null text has no words; documents without words follow their source's
    rate as others do.  A null source is a source of its own, the last one.
    Repeated rows are separate documents.  An empty table stays empty; sources
    without words are not taken.
    """
    h, k, row, n = free_names(docs.columns, ["h", "k", "row", "times"])
    wanted = (placed(entries(docs, doc_id, text, source), weights, share, most, seed)
              .withColumn(n, _copies(F.col("ahead"), F.col("n"), F.col("offset"), most)).where(F.col(n) > 0)
              .select(F.col("h").alias(h), F.col("k").alias(k), n))
    rows = (docs.select(_order_hash(doc_id, text).alias(h), F.xxhash64(*docs.columns).alias(k), F.struct(*docs.columns).alias(row))
            .groupBy(h, k).agg(F.first(row).alias(row)))
    i = free_names([*docs.columns, h, k, row, n, "slice"], ["i"])[0]
    return _repeat(rows.join(wanted, [h, k]), n, i).select(*[F.col(f"`{row}`.`{c}`") for c in docs.columns])


def digest(docs: DataFrame) -> DataFrame:
    """One row per document: the columns of query ``op6_mixing``."""
    rows = _repeat(placed(entries(docs.select("doc_id", "text", "source"))), "n")
    copies = _copies(F.col("ahead") + F.col("i"), F.lit(1), F.col("offset"))
    return rows.select(F.col("id").alias("doc_id"), "size", "source_size", "target", (copies * F.col("size")).alias("taken"))


SQL = r"""
with d as (select doc_id, coalesce('=' || source, '~') key,
    coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) size,
    md5(coalesce(cast(doc_id as varchar), '') || '|' || coalesce(text, '')) h from documents),
 s as (select key, cast(sum(size) as bigint) source_size, ([5.0, 2.0, 1.0]::double[])[(row_number() over (order by key) - 1) % 3 + 1] weight
    from d group by key),
 f as (select *, source_size * 2.0::double cap, source_size * 2.0::double / weight fill, sum(source_size) over () total from s),
 l as (select *, (total * 1.5::double - coalesce(sum(cap) over (order by fill, key rows between unbounded preceding and 1 preceding), 0))
    / sum(weight) over (order by fill, key rows between current row and unbounded following) level from f),
 t as (select key, source_size, least(cap, coalesce(max(case when level <= fill then level end) over () * weight, cap)) target,
    cast('0x' || substr(md5('mix-1|' || key), 1, 8) as bigint) % 1024 as start from l),
 r as (select key, doc_id, d.size, source_size, target, start, case when source_size > 0 then target / source_size else 0 end rate,
    row_number() over (partition by key order by case when size < 16 then size
        else (length(bin(size)) - 4) * 16 + (size >> (length(bin(size)) - 5)) - 16 end, h) i
    from d join t using (key)),
 o as (select key, k, (start + k * 16) % 1024 / 1024::double u, target from t, range(64) x(k)),
 w as (select key, k, u, o.target, sum(least(2, floor(i * rate + u) - floor((i - 1) * rate + u)) * size) words
    from r join o using (key) group by all),
 b as (select key, u, row_number() over (partition by key order by abs(words - target), k) n from w)
select doc_id, size, source_size, target,
    cast(least(2, floor(i * rate + u) - floor((i - 1) * rate + u)) * size as bigint) taken from r join b using (key) where n = 1
"""
