"""Line deduplication by distinct-site spread.

A line that stands on many sites is boilerplate, however often one site repeats
it.  Each line hash gets a HyperLogLog sketch of its sites; map tasks build
sketches, the shuffle carries one per line and task, and they merge by
aggregation.  Lines whose estimate is within the sketch's error of the threshold
get an exact distinct count; the others are clear on one side.  Boilerplate
lines are then removed from every document.

The sketch's size is fixed, so neither a line nor a site can grow a group; a hot
line reaches the merge as one sketch per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .frames import free_names, stored

MIN_SITES = 8
LG_K = 10      # 1024 registers: a standard error of 3.25 %
MARGIN = 0.13  # four standard errors: beyond, the estimate decides


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _explode(docs: DataFrame, text: str, *keep: Column) -> DataFrame:
    """A row per line with a word: the kept columns, its place and two hashes of the trimmed line."""
    kept = docs.select(*keep, _lines(F.col(text)).alias("lines"))  # computed once a text, not once a line
    return (kept.select(*kept.columns[:-1], F.posexplode("lines").alias("pos", "line"))
            .where(F.col("line").rlike(r"[^\x20\x09-\x0D]"))
            .withColumn("line", F.trim("line"))
            .select(*kept.columns[:-1], "pos",
                    F.xxhash64("line").alias("h1"), F.xxhash64(F.lit("+"), "line").alias("h2")))


def boilerplate(docs: DataFrame, text: str = "text", site: str = "source", min_sites: int = MIN_SITES,
                lg_k: int = LG_K, margin: float = MARGIN) -> DataFrame:
    """(h1, h2, sites): the lines on ``min_sites`` sites or more; sites is exact near
    the threshold and an estimate above.  Null and empty site names are one site."""
    lines = _explode(docs, text, F.coalesce(F.col(site), F.lit("")).alias("site"))
    low, high = min_sites * (1 - margin), min_sites * (1 + margin)
    spread = stored(lines.groupBy("h1", "h2").agg(F.hll_sketch_agg("site", F.lit(lg_k)).alias("sketch"))
                    .select("h1", "h2", F.hll_sketch_estimate("sketch").alias("sites")).where(F.col("sites") >= low), "line-spread")
    near = spread.where(F.col("sites") <= high).drop("sites")
    exact = (lines.join(near, ["h1", "h2"]).groupBy("h1", "h2", "site").agg(F.lit(1).alias("one"))
             .groupBy("h1", "h2").agg(F.count("*").alias("sites")).where(F.col("sites") >= min_sites))
    return stored(spread.where(F.col("sites") > high).unionByName(exact), "line-boilerplate")


def remove(docs: DataFrame, lines: DataFrame, text: str = "text") -> tuple[DataFrame, list[str]]:
    """``docs`` with those lines taken out of ``text``, and the columns n_lines (with
    a word) and n_removed, and the names these got."""
    k, at, n_lines, n_removed = free_names(docs.columns, ["k", "at", "n_lines", "n_removed"])
    key = F.xxhash64(F.col(text))
    check = F.xxhash64(F.lit("+"), F.col(text))
    hit = (_explode(docs, text, F.struct(key, check).alias("row")).join(lines, ["h1", "h2"])
           .groupBy("row").agg(F.collect_set("pos").alias("at")))  # at most the lines of one text
    hit = stored(hit.select(F.col("row").alias(k), F.col("at").alias(at)), "line-hits")
    out = docs.withColumn(k, F.struct(key.alias("col1"), check.alias("col2"))).join(hit, k, "left")
    # the places that stay by a hash set, then the lines there: in step with the lines of a text
    kept = F.get(F.transform(F.array(_lines(F.col(text))), lambda x: F.transform(
        F.array_except(F.transform(x, lambda _, i: i), F.col(at)), lambda i: F.get(x, i))), F.lit(0))
    out = out.withColumns({
        n_lines: F.coalesce(F.size(F.filter(_lines(F.col(text)), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))), F.lit(0)).cast("long"),
        n_removed: F.coalesce(F.size(at), F.lit(0)).cast("long")})
    out = out.withColumn(text, F.when(F.col(at).isNull(), F.col(text)).otherwise(F.array_join(kept, "\n")))
    return out.select(*docs.columns, n_lines, n_removed), [n_lines, n_removed]


def dedup_lines(docs: DataFrame, text: str = "text", site: str = "source", **options) -> tuple[DataFrame, list[str]]:
    """``docs`` without cross-site boilerplate lines (see ``remove``).

    Lines without a word are never removed; a null text stays null with 0 lines;
    a text all of whose lines go is left empty.  Repeated rows are treated
    alike.  An empty table stays empty.
    """
    return remove(docs, boilerplate(docs, text, site, **options), text)


def digest(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_lines, n_removed, kept_md5 (of the text that is left)."""
    out, (n_lines, n_removed) = dedup_lines(docs.select("doc_id", "text", "source"))
    return out.select("doc_id", F.col(n_lines).alias("n_lines"), F.col(n_removed).alias("n_removed"), F.md5("text").alias("kept_md5"))


SQL = r"""
with d as (select row_number() over () r, doc_id, coalesce(source, '') site, text, string_split(text, chr(10)) lines from documents),
 l as (select r, site, unnest(lines) line, unnest(range(1, len(lines) + 1)) i from d where text is not null),
 w as (select r, site, i, line, trim(line) t, regexp_matches(line, '[^\x20\x09-\x0D]') word from l),
 b as (select t from w where word group by t having count(distinct site) >= 8),
 m as (select r, count(*) filter (word) n_lines, count(*) filter (word and b.t is not null) n_removed,
    string_agg(line, chr(10) order by i) filter (not (word and b.t is not null)) kept from w left join b using (t) group by r)
select doc_id, coalesce(n_lines, 0) n_lines, coalesce(n_removed, 0) n_removed,
    case when text is not null then md5(coalesce(kept, '')) end kept_md5 from d left join m using (r)
"""
