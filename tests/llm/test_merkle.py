"""The Merkle manifest against a plain Python tree: odd rows, ties, one leaf, many groups, tampering."""

import hashlib
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from trackcast.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def field(value):
    value = None if value is None else str(value)
    return "-" if value is None else f"{len(value.encode())}:{value}"


def leaf(row, text):
    doc_id, _, lang, source, n_chars = row
    return sha("".join(field(v) for v in (doc_id, source, lang, n_chars, text)))


def lowered(text):
    return text and "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def grow(nodes, fan):
    """[levels], each a list of hashes, and for every bottom node its siblings and place, level by level."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        now = levels[-1]
        levels.append([sha("".join(now[i:i + fan])) for i in range(0, len(now), fan)])
    ways = []
    for i in range(len(nodes)):
        way = []
        for level in levels[:-1]:
            run = level[i // fan * fan:i // fan * fan + fan]
            way.append((run[:i % fan], run[i % fan + 1:]))
            i //= fan
        ways.append(way)
    return levels, ways


def plain(rows, fan=16):
    groups = defaultdict(list)
    for row in rows:
        groups[row[3]].append(row)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for source in order:
        mine = sorted(groups[source], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[1])))
        trees[source] = mine, *grow([leaf(r, r[1]) for r in mine], fan)
    subroots = [trees[s][1][-1][0] for s in order]
    top, over = grow(subroots, fan)
    root, out = top[-1][0], []
    for source, above, subroot in zip(order, over, subroots):
        mine, levels, ways = trees[source]
        for row, way in zip(mine, ways):
            hit = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0
            folded, beside = leaf(row, lowered(row[1]) if hit else row[1]), ""
            for left, right in way + above:
                folded = sha("".join(left) + folded + "".join(right))
                beside += "".join(left) + "".join(right)
            out.append((row[0], leaf(row, row[1]), subroot, root, sha(beside), folded, folded == root))
    return out


def rows_of(sizes):
    return [(i * 1000 + j, f"Text {i} {j}", "en", None if i == 0 else f"s{i}", j) for i, n in enumerate(sizes) for j in range(n)]


def check(spark, rows, **extra):
    df = spark.createDataFrame(rows, SCHEMA).withColumns({k: F.lit(v) for k, v in extra.items()})
    got = [tuple(r) for r in merkle.digest(df).collect()]
    assert sorted(got, key=repr) == sorted(plain(rows), key=repr)
    return got


@pytest.mark.parametrize("sizes", [[16], [0, 1], [257, 1, 0, 16, 33], [1] * 18])
def test_trees_of_all_shapes(spark, sizes):
    check(spark, rows_of(sizes))


def test_nulls_ties_repeated_rows_and_clashing_columns(spark):
    rows = [(None, None, None, None, None)] * 3 + [(None, "ÀB", "", "", 0), (5, "", "en", "é", 1), (5, "Z", "en", "é", 1)]
    rows += [(7, "The Same Row", "en", "hot", 12)] * 40 + [(i, "X" * 30_000, "de", "hot", None) for i in range(40)]
    got = check(spark, rows, tree="t", hash=1, parent="p", n=3, group="g", kids="k")
    assert {r[6] for r in got} == {True, False}


def test_one_leaf_is_its_own_root_and_nothing_gives_nothing(spark):
    (one,) = check(spark, [(1, "a", None, None, 1)])
    assert one[1] == one[2] == one[3] and one[4] == sha("")
    assert merkle.digest(spark.createDataFrame([], SCHEMA)).collect() == []


def test_a_fan_of_three_with_shuffled_and_broadcast_nodes(spark, monkeypatch):
    monkeypatch.setattr(merkle, "HEAVY", 4)  # most nodes are met in the shuffle join
    rows = rows_of([5, 120, 28])
    docs = spark.createDataFrame(rows, SCHEMA)
    made = merkle.build(docs, fan=3, claim=merkle.leaf_hash(), keep=["doc_id"])
    assert made.nodes.where("heavy").count() < made.nodes.where("not heavy").count()
    assert made.root == plain(rows, 3)[0][3]
    done = merkle.climb(made, made.leaves, ["doc_id"]).select(F.lower(F.hex("folded"))).distinct().collect()
    assert [r[0] for r in done] == [made.root]
    assert {r.doc_id: bytes(r.leaf).hex() for r in made.leaves.collect()} == {r[0]: r[1] for r in plain(rows, 3)}


def test_every_node_row_hangs_on_its_parent(spark):
    made = merkle.build(spark.createDataFrame(rows_of([40, 300]), SCHEMA))
    nodes = {r.node: r for r in made.nodes.collect()}
    assert [n.hash.hex() for n in nodes.values() if n.parent is None] == [made.root]
    for n in [*nodes.values(), *made.leaves.collect()]:
        if n.parent:
            value = n.hash if "hash" in n else n.leaf
            assert bytes(nodes[n.parent].kids)[32 * n.pos:32 * n.pos + 32] == bytes(value)
