"""Merkle dataset manifest: a hash tree over all records, and a climb that proves each of them.

Leaves of a group (a source) stand in a line by id; every ``FAN`` consecutive
nodes become the hash of their hashes until one is left, the group's subroot;
the subroots, in the groups' order, make a tree of the same kind up to the root.

Build: records are numbered by a range sort with offsets per range, so a group
that holds a third of all rows is spread over all tasks; then each level is one
grouping of ``FAN`` rows a key.  Every built level is kept as parent-linked node
rows (node, parent, pos, kids).

Verify: a recursive query climbs from the leaves to the root.  A row of the climb
holds the leaves of one run (they share all siblings above it, which are
appended once); the claimed hash of every leaf is folded on its own, first into
its run, then level by level.  A step meets the stored nodes in a shuffle join; nodes with more than
one in ``HEAVY`` of all leaves below them, at most ``HEAVY`` a level, are
broadcast instead, so that no key of the join is hot.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .frames import bounded, stored

FAN = 16
HEAVY = 4096
LEAF_FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TOP = "top"  # the tree over the subroots; the others are named by an md5 of their group


@dataclass
class Manifest:
    """``leaves`` (the kept columns, leaf, subroot, parent, pos), ``nodes`` (node, parent, pos,
    level, hash, kids, heavy, parent_heavy) and the root's hash (None for no rows).  Hashes are 32 bytes."""

    leaves: DataFrame
    nodes: DataFrame
    root: str | None


def _sha(data: Column) -> Column:
    return F.unhex(F.sha2(data, 256))


def _text(digest: Column | str) -> Column:
    return F.lower(F.hex(digest))


def leaf_hash(fields=LEAF_FIELDS, replaced: dict[str, Column] | None = None) -> Column:
    """SHA-256 of the fields, each as ``-`` (null) or byte count, colon, value."""
    parts = []
    for name in fields:
        value = (replaced or {}).get(name, F.col(name)).cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return _sha(F.concat(*parts))


def numbered(rows: DataFrame, group: str, order: list[str], name: str) -> DataFrame:
    """``rows`` with n (place in the group, from 0) and size (rows of the group).

    One range sort; a group may span any number of ranges.  ``rows`` must be a
    stored table, and rows that tie in ``order`` must be interchangeable: these
    are dealt by their place in it.
    """
    spread = rows.withColumn("deal", F.xxhash64(F.monotonically_increasing_id()))
    ranged = stored(spread.repartitionByRange(group, *order, "deal").sortWithinPartitions(group, *order, "deal")
                    .drop("deal").withColumn("at", F.monotonically_increasing_id())
                    .withColumn("part", F.shiftright("at", 33)), f"{name}-ranged")
    of_group = W.partitionBy(group)  # a row per range that the group meets
    starts = stored(ranged.groupBy(group, "part").agg(F.min("at").alias("first"), F.count("*").alias("held"))
                    .withColumn("ahead", F.coalesce(F.sum("held").over(
                        of_group.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
                    .withColumn("size", F.sum("held").over(of_group)), f"{name}-starts")
    return (ranged.join(bounded(starts.drop("held")), [group, "part"])
            .withColumn("n", F.col("ahead") + F.col("at") - F.col("first")).drop("at", "part", "first", "ahead"))


def _node(tree, level: int, num) -> Column:
    return F.concat_ws("/", F.col(tree), F.lit(level).cast("string"), num.cast("string"))


def _levels(bottom: DataFrame, most: int, fan: int) -> list[DataFrame]:
    """The levels over ``bottom`` (tree, n, size, hash, under), stored, with level and kids;
    trees of one node have none.  ``most`` is the largest tree's size."""
    out, now, level = [], bottom, 0
    while most > 1:
        level += 1
        up = F.floor(F.col("n") / fan).alias("n")
        runs = now.where("size > 1").groupBy("tree", up).agg(
            F.sort_array(F.collect_list(F.struct("n", "hash"))).alias("run"),  # of ``fan`` rows at most
            F.first("size").alias("size"), F.sum("under").alias("under"))
        kids = F.unhex(F.array_join(F.transform("run", lambda x: F.hex(x["hash"])), ""))
        now = stored(runs.withColumn("kids", kids).select(
            "tree", F.lit(level).alias("level"), "n", F.ceil(F.col("size") / fan).alias("size"), "under", "kids",
            _sha(_text("kids")).alias("hash")), f"merkle-level-{level}")
        out.append(now)
        most = -(-most // fan)
    return out


def build(docs: DataFrame, group: str = "source", order: str = "doc_id", fields=LEAF_FIELDS, claim: Column | None = None,
          keep: list[str] | None = None, fan: int = FAN) -> Manifest:
    """The manifest of ``docs``; its leaves keep ``keep`` (default: ``order``) and, if given, ``claim``.

    A null group is a group of its own, the first; null ids come first in
    theirs.  Rows of one id stand by their leaf hash, so equal rows are
    interchangeable, and each is a leaf.  Null and empty values differ
    (``-``, ``0:``).  Columns outside ``fields`` are not hashed.  An empty table
    gives no nodes, and None as root.
    """
    spark, keep = docs.sparkSession, keep or [order]
    name = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))
    extra = [] if claim is None else [claim.alias("claim")]
    kept = [f"keep_{i}" for i in range(len(keep))]  # names that cannot clash
    first = stored(docs.select(name.alias("group"), F.md5(name).alias("tree"), F.col(order).alias("id"),
                               leaf_hash(fields).alias("hash"), *[F.col(f"`{c}`").alias(k) for c, k in zip(keep, kept)], *extra), "merkle-leaves")
    lined = stored(numbered(first, "group", ["id", "hash"], "merkle"), "merkle-lined").withColumn("under", F.lit(1).cast("long"))
    total, most = lined.agg(F.count("*"), F.max("size")).first()
    bottom = lined.select("tree", F.lit(0).alias("level"), "n", "size", "under", F.lit(None).cast("binary").alias("kids"), "hash")
    levels = _levels(bottom, most or 0, fan)
    ends = bottom
    for level in levels:
        ends = ends.unionByName(level)
    groups = lined.where("n = 0").select("tree", "group")
    subroots = stored(ends.where("size = 1").select("tree", "hash", "under").join(groups, "tree")
                      .withColumn("all", F.lit(TOP)), "merkle-subroots")
    top = stored(numbered(subroots, "all", ["group"], "merkle-top").select(
        F.col("tree").alias("of"), F.lit(TOP).alias("tree"), "n", "size", "hash", "under"), "merkle-top")
    upper = _levels(top, total and top.count() or 0, fan)

    # a subroot's parent is in the tree over the subroots (none: it is the root)
    link = bounded(stored(top.select(
        F.col("of").alias("tree"), F.col("hash").alias("subroot"), F.when(F.col("size") > 1, _node("tree", 1, F.floor(F.col("n") / fan))).alias("top_parent"),
        (F.col("n") % fan).cast("int").alias("top_pos")), "merkle-links"))

    def linked(rows: DataFrame, level: int) -> DataFrame:
        inside = F.col("size") > 1
        return rows.join(link, "tree", "left").withColumns({
            "parent": F.when(inside, _node("tree", level + 1, F.floor(F.col("n") / fan))).otherwise(F.col("top_parent")),
            "pos": F.when(inside, (F.col("n") % fan).cast("int")).otherwise(F.col("top_pos"))})

    nodes = None
    for rows in (levels, upper):
        for i, level in enumerate(rows):
            one = linked(level, i + 1).select(_node("tree", i + 1, F.col("n")).alias("node"), "parent", "pos",
                                              (F.col("level") + (len(levels) if rows is upper else 0)).alias("level"), "hash", "kids",
                                              (F.col("under") * HEAVY >= total).alias("heavy"))
            nodes = one if nodes is None else nodes.unionByName(one)
    if nodes is None:
        nodes = spark.createDataFrame([], "node string, parent string, pos int, level int, hash binary, kids binary, heavy boolean")
    nodes = stored(nodes, "merkle-nodes")
    large = F.broadcast(nodes.where("heavy").select(F.col("node").alias("parent"), F.lit(True).alias("parent_heavy")))
    nodes = stored(nodes.join(large, "parent", "left").withColumn("parent_heavy", F.coalesce("parent_heavy", F.lit(False))), "merkle-linked")
    leaves = stored(linked(lined, 0).select(
        *[F.col(k).alias(c) for c, k in zip(keep, kept)], F.col("hash").alias("leaf"), "subroot", "parent", "pos",
        *(["claim"] if extra else [])), "merkle-leaf-rows")
    root = nodes.where("parent is null").union(nodes.limit(0)).select("hash") if levels or upper else leaves.select(F.col("leaf").alias("hash"))
    found = root.select(_text("hash")).first()
    return Manifest(leaves, nodes, found and found[0])


def _others(kids: str, pos: str) -> str:
    """The hashes of a run without the one at ``pos``."""
    return f"concat(substring({kids}, 1, 32 * {pos}), substring({kids}, 32 * {pos} + 33))"


def _folded(kids: str, pos: str, h: str) -> str:
    """The hash of a run in which ``h`` stands at ``pos``."""
    return f"unhex(sha2(lower(hex(concat(substring({kids}, 1, 32 * {pos}), {h}, substring({kids}, 32 * {pos} + 33)))), 256))"


#: One step of the climb: fold every hash of the row into the node above, append its siblings.
_CLIMB = f"""
with recursive climb max recursion level 1000 as (
  select run, at, heavy, pos, hashes, cast('' as binary) as siblings from {{anchor}}
  union all
  select run, parent, parent_heavy, node_pos, transform(hashes, h -> {_folded("kids", "pos", "h")}), concat(siblings, {_others("kids", "pos")})
  from (select c.*, coalesce(p.kids, q.kids) as kids, coalesce(p.parent, q.parent) as parent,
          coalesce(p.parent_heavy, q.parent_heavy) as parent_heavy, coalesce(p.pos, q.pos) as node_pos
        from climb c
        left join {{light}} p on case when c.heavy then concat('-', c.run) else c.at end = p.node
        left join {{large}} q on c.heavy and c.at = q.node
        where c.at is not null))
select run, hashes, siblings from (select * from climb limit all) where at is null
"""


def climb(manifest: Manifest, claims: DataFrame, keep: list[str]) -> DataFrame:
    """Every claim folded up to the root: the columns ``keep``, folded (32 bytes), siblings (their hashes
    in the order of the way up, each run's from left to right).

    ``claims`` has the leaf's parent and pos, and claim (32 bytes); a place may be
    claimed more than once, but its claims go into one row.
    """
    spark = claims.sparkSession
    kept = F.struct(*keep).alias("kept")
    whole = claims.where("parent is null").select(F.col("claim").alias("folded"), F.lit(b"").alias("siblings"), kept)
    grouped = claims.where("parent is not null").groupBy(F.col("parent").alias("run")).agg(
        F.sort_array(F.collect_list(F.struct("pos", "claim", kept))).alias("m"))
    at = manifest.nodes.select(F.col("node").alias("run"), F.col("parent").alias("at"), F.col("parent_heavy").alias("heavy"), "pos", "kids")
    runs = stored(grouped.join(at, "run"), "merkle-runs")
    anchor = runs.select("run", "at", "heavy", "pos", F.expr(f"transform(m, x -> {_folded('kids', 'x.pos', 'x.claim')})").alias("hashes"))
    columns = ["node", "parent", "pos", "kids", "parent_heavy"]
    above = manifest.nodes.where("level > 1")
    up = spark.sql(_CLIMB, anchor=anchor, light=above.where("not heavy").select(*columns),
                   large=F.broadcast(above.where("heavy").select(*columns)))
    each = up.join(runs.select("run", "kids", "m"), "run").select("kids", "siblings", F.explode(F.arrays_zip("m", "hashes")).alias("x"))
    beside = F.expr(f"concat({_others('kids', 'x.m.pos')}, siblings)")
    done = each.select(F.col("x.hashes").alias("folded"), beside.alias("siblings"), F.col("x.m.kept").alias("kept"))
    return done.unionByName(whole).select("kept.*", "folded", "siblings")


def tampered_text(doc_id: str = "doc_id", text: str = "text") -> Column:
    """The text as the query's tampering leaves it: A-Z lower-cased where 5 divides crc32(doc_id)."""
    hit = F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))
    return F.when(hit, F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).otherwise(F.col(text))


def digest(docs: DataFrame) -> DataFrame:
    """One row per document: the columns of query ``op11_merkle_manifest`` (an empty table gives none)."""
    made = build(docs.select(*LEAF_FIELDS), claim=leaf_hash(replaced={"text": tampered_text()}))
    done = climb(made, made.leaves, ["doc_id", "leaf", "subroot"])
    root = F.lit(made.root).cast("string")
    return done.select("doc_id", _text("leaf").alias("leaf"), _text("subroot").alias("subroot"), root.alias("root"),
                       F.sha2(_text("siblings"), 256).alias("proof_sha256"), _text("folded").alias("folded_root"),
                       (_text("folded") == root).alias("verified"))


SQL = r"""
with recursive d as (select *, row_number() over () as rid, cast(doc_id as varchar) as id,
    coalesce(strlen(cast(doc_id as varchar)) || ':' || cast(doc_id as varchar), '-') || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(cast(n_chars as varchar)) || ':' || cast(n_chars as varchar), '-') as head,
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as lowered from documents),
 c as (select rid, doc_id, coalesce('=' || source, '') as tree, sha256(head || coalesce(strlen(text) || ':' || text, '-')) as leaf,
    sha256(head || coalesce(strlen(lowered) || ':' || lowered, '-')) as tampered,
    xor(list_reduce(list_concat([4294967295::bigint], list_transform(string_split(id, ''), lambda x : ascii(x)::bigint)),
        lambda crc, b : list_reduce(list_concat([xor(crc, b)], [0, 0, 0, 0, 0, 0, 0, 0]::bigint[]),
            lambda a, z : xor(a >> 1, (a & 1) * 3988292384))), 4294967295) % 5 = 0 as hit from d),
 l as (select *, case when coalesce(hit, false) then tampered else leaf end as claim,
    row_number() over (partition by tree order by doc_id nulls first, leaf, rid) - 1 as num, count(*) over (partition by tree) as size from c),
 t(tree, num, size, level, hash) as (select tree, num, size, 0, leaf from l
    union all select tree, num // 16, (size + 15) // 16, level + 1, sha256(string_agg(hash, '' order by num)) from t where size > 1
    group by tree, num // 16, size, level),
 s as (select tree, hash, row_number() over (order by tree) - 1 as num, count(*) over () as size from t where size = 1),
 u(num, size, level, hash) as (select num, size, 0, hash from s
    union all select num // 16, (size + 15) // 16, level + 1, sha256(string_agg(hash, '' order by num)) from u where size > 1
    group by num // 16, size, level),
 tk as (select tree, level, num // 16 as run, list(hash order by num) as kids from t where size > 1 group by all),
 uk as (select level, num // 16 as run, list(hash order by num) as kids from u where size > 1 group by all),
 a(rid, tree, level, num, size, folded, proof) as (select rid, tree, 0, num, size, claim, '' from l
    union all select rid, a.tree, a.level + 1, num // 16, (size + 15) // 16,
      sha256(array_to_string(kids[1:num % 16], '') || folded || array_to_string(kids[num % 16 + 2:], '')),
      proof || array_to_string(kids[1:num % 16], '') || array_to_string(kids[num % 16 + 2:], '')
    from a join tk on a.tree = tk.tree and a.level = tk.level and a.num // 16 = tk.run where size > 1),
 b(rid, level, num, size, folded, proof) as (select rid, 0, s.num, s.size, folded, proof from a join s using (tree) where a.size = 1
    union all select rid, b.level + 1, num // 16, (size + 15) // 16,
      sha256(array_to_string(kids[1:num % 16], '') || folded || array_to_string(kids[num % 16 + 2:], '')),
      proof || array_to_string(kids[1:num % 16], '') || array_to_string(kids[num % 16 + 2:], '')
    from b join uk on b.level = uk.level and b.num // 16 = uk.run where size > 1)
select l.doc_id, leaf, s.hash as subroot, r.hash as root, sha256(proof) as proof_sha256, folded as folded_root, folded = r.hash as verified
from b join l using (rid) join s using (tree) cross join (select hash from u where size = 1) r where b.size = 1
"""
