"""The conversation trie against a plain Python one: shapes, hot prefixes, ties, nulls, long conversations."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from trackcast.llm import prefix_trie as pt
from trackcast.llm.frames import stored

SCHEMA = "conv_id long, turn long, role string, text string"


def tie(role, text):
    return hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()


def plain(rows):
    lines = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            lines[conv].append((turn is not None, turn or 0, tie(role or "", text or ""), role or "", text or ""))
    lines = {c: [t[3:] for t in sorted(v)] for c, v in lines.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c, own in lines.items():
        h = zlib.crc32(str(c).encode()) % 9
        seq = tuple(lines.get(c - c % 5, [])[:h] + own[h:])
        ends[seq].append(c)
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
    kids = defaultdict(list)
    for node in members:
        if node:
            kids[node[:-1]].append(node)
    leaves, saved, out = {}, {}, []
    for node in sorted(members, key=len, reverse=True):
        below = kids[node]
        leaves[node] = sum(leaves[k] for k in below) if below else 1
        saved[node] = sum(saved[k] for k in below) + (len(members[node]) - 1) * (len(node[-1][1].encode()) if node else 0)
        text = ",".join(map(str, sorted(ends[node])))
        out.append((min(members[node]), len(node), min(members[node[:-1]]) if node else None, len(members[node]), len(below),
                    leaves[node], saved[node], hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


def got(df):
    assert df.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted((tuple(r) for r in df.collect()), key=repr)


def talk(n, alphabet=3, seed=1, most=9):
    rng = random.Random(seed)
    return [(c, t, rng.choice(["user", "assistant"]) if alphabet > 3 else "user", f"é{rng.randrange(alphabet)}")
            for c in range(n) for t in range(rng.randrange(most))]


ODD = [(None, 1, "user", "nobody's"), (3, None, "user", "first"), (3, None, "user", "also first"), (3, 2, None, None), (3, 2, None, None),
       (4, 1, "us", "er1"), (9, 1, "user", "1"), (-7, 1, "user", ""), (-7, 0, "", "x"), (2**40, 5, "user", "far"), (2**40 + 1, 5, "user", "far")]


@pytest.mark.parametrize("rows", [talk(150) + ODD, talk(60, 1000, 2, 14)], ids=["few words", "many words"])
def test_nodes_match_a_plain_trie(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("mine") for c in ("path", "key", "shard", "up", "cut")})
    assert got(pt.digest(df)) == plain(rows)


@pytest.mark.parametrize("heavy, shard", [(30, 50), (400, 100)])
def test_hot_prefixes_are_spread_and_merged(spark, heavy, shard, monkeypatch):
    monkeypatch.setattr(pt, "HEAVY_SEQUENCES", 2)
    rng = random.Random(4)
    rows = [(c, t, "user", f"same {t}") for c in range(0, 900, 3) for t in range(6)]                # one very common beginning,
    rows += [(c, t, "user", f"{rng.randrange(4)}") for c in range(0, 600, 3) for t in range(6, 11)]  # ends that differ, and copies
    rows += talk(40, 4, 6)
    lines = pt.rebuilt(stored(pt.chains(spark.createDataFrame(rows, SCHEMA)), "trie-test"))
    dealt = pt.dealt(pt.sequences(lines), heavy, shard)
    assert dealt.select("cut").distinct().count() > 1 and dealt.select("shard").distinct().count() > 3
    assert got(pt.nodes(lines, heavy, shard)) == plain(rows)


def test_a_repeated_conversation_is_hashed_in_blocks(spark):
    lines = spark.range(0, 5000, 7).select(F.col("id").alias("conv_id"), F.unhex(F.md5(F.lit("t"))).alias("path"), F.array(F.lit(3).cast("long")).alias("sizes"))
    (one,) = pt.sequences(lines, block=100).collect()
    assert (one.n, one.conv_id, one.ends) == (715, 0, hashlib.sha256(",".join(map(str, range(0, 5000, 7))).encode()).hexdigest())


def test_a_long_conversation_and_empty_tables(spark):
    rows = [(5, t, "user", f"turn {t % 17}") for t in range(3000)] + [(6, t, "user", f"turn {t % 17}") for t in range(2999)]
    assert got(pt.digest(spark.createDataFrame(rows, SCHEMA))) == plain(rows)
    assert got(pt.digest(spark.createDataFrame([], SCHEMA))) == []
    # all of its turns are replaced by those of a conversation that is not there: it ends at the root
    alone = next(c for c in range(1, 99) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 0)
    assert got(pt.digest(spark.createDataFrame([(alone, 1, "user", "gone")], SCHEMA))) == [
        (alone, 0, None, 1, 0, 1, 0, hashlib.sha256(str(alone).encode()).hexdigest())]


@pytest.mark.parametrize("alphabet", [2, 40, 5000])
def test_double_array_holds_exactly_the_sequences(alphabet):
    rng = np.random.default_rng(alphabet)
    lists = [rng.integers(0, alphabet, rng.integers(0, 12)) for _ in range(400)]
    lists += [x[:4] for x in lists[::3]]
    first = np.concatenate([[0], np.cumsum([len(x) for x in lists])])
    trie = pt.pack(np.concatenate(lists), first)
    prefixes = {tuple(map(int, x[:d])) for x in lists for d in range(len(x) + 1)}
    assert int((trie.check >= 0).sum()) == len(prefixes) - 1
    state = {(): 0}
    for p in sorted(prefixes - {()}, key=len):
        state[p] = int(trie.step(np.array([state[p[:-1]]]), np.array([p[-1]]))[0])
    assert len(set(state.values())) == len(prefixes) and min(state.values()) == 0
    for p, s in list(state.items())[:200]:  # no other child is found
        for c in range(-2, min(alphabet, 50) + 2):
            assert (int(trie.step(np.array([s]), np.array([c]))[0]) >= 0) == (p + (c,) in prefixes)
