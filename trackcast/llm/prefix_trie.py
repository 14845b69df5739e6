"""Conversation prefix trie in double arrays, one per prefix shard.

A node is a different sequence of first turns; its members are the conversations
that start with it.

1. A turn is its 16-byte digest; a conversation is the chain of its turns'
   digests (16 bytes a turn), so texts are read once and not shuffled.
2. Equal conversations become one sequence with its number, least conv_id and the
   hash of its sorted conv_ids.  Ids are joined in blocks of ``BLOCK`` before the
   shuffle and hashed block by block as a stream, so that a conversation repeated
   very often needs bounded memory.
3. Sequences are dealt to shards by a prefix.  The prefix has one turn, or, where
   more than ``HEAVY`` turns stand under one (a common first turn), 2, 4, 8, ...
   so a hot prefix is spread over many shards.
4. A shard numbers its different turns densely, packs the sequences into a double
   array (the child of state s by turn c is ``t = BASE[s] + c`` if ``CHECK[t] == s``),
   and walks all of them through it for the nodes' aggregates.  Nodes at or below
   the shard's prefix are complete; the ones above are shared with other shards.
5. The shards' rows of the shared upper nodes are merged by the nodes' digests,
   and their subtree sums are made from the merged rows and what hangs below.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .frames import bounded, stored

SHARED = 5           # a conversation starts as the one with the next lower multiple of this id
BLOCK = 4096         # conv_ids that are joined to one piece of text
SHARD_TURNS = 20_000
HEAVY = 20_000      # turns under one prefix, from which on its shard prefix is longer
HEAVY_SEQUENCES = 16  # ... if it has more sequences than this
DIGEST = 16          # bytes of a turn
_EMPTY = hashlib.sha256(b"").hexdigest()


class DoubleArray:
    """BASE and CHECK over states and dense symbols; state 0 is the root."""

    WINDOW = 64

    def __init__(self, capacity: int = 1024):
        self.base = np.zeros(capacity, np.int64)
        self.check = np.full(capacity, -1, np.int64)  # -1: free
        self.check[0] = -2
        self.low = 1   # no state below is free
        self.top = 1   # all from here on are free

    def _reach(self, upto: int) -> None:
        if upto >= len(self.check):
            grown = max(upto + 1, 2 * len(self.check))
            self.base = np.concatenate([self.base, np.zeros(grown - len(self.base), np.int64)])
            self.check = np.concatenate([self.check, np.full(grown - len(self.check), -1, np.int64)])

    def add(self, state: int, symbols: np.ndarray) -> None:
        """Give ``state`` its children by ``symbols`` (ascending, all at once): the first place
        at which all of their states are free."""
        check = self.check
        while self.low < self.top and check[self.low] != -1:
            self.low += 1
        if len(symbols) == 1:
            first = self.low
            self._reach(first)
        else:
            span, first, at, window = symbols - symbols[0], None, self.low, self.WINDOW
            while first is None:
                self._reach(at + window + int(span[-1]))
                free = at + np.flatnonzero(self.check[at:at + window] == -1)
                fits = free[(self.check[free[:, None] + span] == -1).all(axis=1)]
                if len(fits):
                    first = int(fits[0])
                elif at >= self.top:
                    first = at
                at, window = at + window, min(2 * window, 4096)
        base = first - int(symbols[0])
        states = base + symbols
        self.base[state] = base
        self.check[states] = state
        self.top = max(self.top, int(states[-1]) + 1)

    def step(self, states: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """The children of ``states`` by ``symbols``; -1 where there is none."""
        to = self.base[states] + symbols
        inside = (to > 0) & (to < len(self.check))
        to = np.where(inside, to, 0)
        return np.where(inside & (self.check[to] == states), to, -1)


def pack(symbols: np.ndarray, first: np.ndarray) -> DoubleArray:
    """The trie of the sequences ``symbols[first[i]:first[i + 1]]``, level by level."""
    trie = DoubleArray(len(symbols) + 1024)
    length, state, depth = np.diff(first), np.zeros(len(first) - 1, np.int64), 0
    live = np.flatnonzero(length > 0)
    while len(live):
        symbol = symbols[first[live] + depth]
        order = np.lexsort((symbol, state[live]))
        s, c = state[live][order], symbol[order]
        new = np.ones(len(s), dtype=bool)
        new[1:] = (s[1:] != s[:-1]) | (c[1:] != c[:-1])
        s, c = s[new], c[new]
        begin = np.flatnonzero(np.append(True, s[1:] != s[:-1]))
        for a, b in zip(begin, np.append(begin[1:], len(s))):
            trie.add(int(s[a]), c[a:b])
        state[live] = trie.step(state[live], symbol)
        depth += 1
        live = live[length[live] > depth]
    return trie


def _chain(key: bytes, turn: bytes) -> bytes:
    return hashlib.md5(key + turn).digest()


#: (name, Arrow type) of a shard's rows.  ``key``: a shared node's digest, or that of the shared
#: parent of a complete node right below; ``below`` sums are over complete nodes only.
_ROWS = [("shared", pa.bool_()), ("key", pa.binary()), ("up", pa.list_(pa.binary())), ("conv_id", pa.int64()), ("depth", pa.int64()),
         ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()), ("bytes", pa.int64()), ("n_children", pa.int64()),
         ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("ends_sha256", pa.string())]
_DDL = ("shared boolean, key binary, up array<binary>, conv_id long, depth long, parent_conv_id long, n_convs long, "
        "bytes long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string")


def shard_nodes(rows: pa.Table) -> pa.Table:
    """The nodes of one shard's sequences (cut, path, sizes, n, conv_id, ends)."""
    path = rows["path"].combine_chunks().cast(pa.large_binary())
    raw = path.buffers()[2]
    raw = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    at = np.frombuffer(path.buffers()[1], np.int64)[path.offset:path.offset + len(path) + 1]
    raw, first = raw[at[0]:at[-1]], (at - at[0]) // DIGEST
    turns = pa.FixedSizeBinaryArray.from_buffers(pa.binary(DIGEST), len(raw) // DIGEST, [None, pa.py_buffer(raw.tobytes())])
    coded = turns.dictionary_encode()
    symbols = coded.indices.to_numpy().astype(np.int64)
    names = coded.dictionary.to_pylist()
    size = rows["sizes"].combine_chunks().flatten().to_numpy()
    length, n_seq = np.diff(first), len(first) - 1
    cut, n, conv, ends = (rows[c].to_numpy() for c in ("cut", "n", "conv_id", "ends"))

    trie = pack(symbols, first)
    high = trie.top
    n_convs, least = np.zeros(high, np.int64), np.full(high, np.iinfo(np.int64).max)
    depth_of, bytes_of, symbol_of = np.zeros(high, np.int64), np.zeros(high, np.int64), np.zeros(high, np.int64)
    cut_of, end_at = np.full(high, np.iinfo(np.int64).max), np.full(high, -1, np.int64)
    state, live, depth = np.zeros(n_seq, np.int64), np.arange(n_seq), 0
    while True:  # walk all sequences through the arrays
        s = state[live]
        np.add.at(n_convs, s, n[live])
        np.minimum.at(least, s, conv[live])
        np.minimum.at(cut_of, s, cut[live])
        depth_of[s] = depth
        stop = length[live] == depth
        end_at[s[stop]] = live[stop]
        live = live[~stop]
        if not len(live):
            break
        symbol, size_now = symbols[first[live] + depth], size[first[live] + depth]
        to = trie.step(state[live], symbol)
        bytes_of[to], symbol_of[to] = size_now, symbol
        state[live] = to
        depth += 1

    parent = trie.check[:high]
    nodes = np.append(0, np.flatnonzero(parent >= 0))
    shared = depth_of < cut_of  # the sequences of a shared node agree on that
    children, leaves = np.zeros(high, np.int64), np.zeros(high, np.int64)
    saved = np.where(shared, 0, (n_convs - 1) * bytes_of)
    for d in range(int(depth_of[nodes].max()), 0, -1):  # complete nodes hand their sums up
        s = nodes[(depth_of[nodes] == d) & ~shared[nodes]]
        leaves[s[children[s] == 0]] = 1
        np.add.at(children, parent[s], 1)
        np.add.at(leaves, parent[s], leaves[s])
        np.add.at(saved, parent[s], saved[s])

    keys, out = {0: (b"",)}, []  # the digests from the root to each shared node
    for s in nodes[np.argsort(depth_of[nodes], kind="stable")]:
        s = int(s)
        above = int(parent[s]) if s else -1
        if shared[s] and s:
            keys[s] = (*keys[above], _chain(keys[above][-1], names[symbol_of[s]]))
        at_top = not shared[s] and bool(shared[above])
        end = int(end_at[s])
        out.append((bool(shared[s]), keys[s][-1] if shared[s] else keys[above][-1] if at_top else None,
                    list(keys[s][:-1]) if shared[s] else None, int(least[s]), int(depth_of[s]),
                    None if shared[s] or at_top else int(least[above]), int(n_convs[s]), int(bytes_of[s]), int(children[s]),
                    int(leaves[s]), int(saved[s]), ends[end] if end >= 0 else None))
    return pa.table([pa.array(c, t) for c, (_, t) in zip(zip(*out), _ROWS)], names=[n for n, _ in _ROWS])


def chains(conversations: DataFrame) -> DataFrame:
    """(conv_id, path, sizes): every conversation's turns in order, as digests joined and UTF-8 bytes.

    Null turns come first; turns of one number stand by their digest.  Null roles
    and texts are empty; rows without a conv_id are no conversation's.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("at"),
        F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)).alias("turn"), F.octet_length(text).cast("long").alias("size"))
    lined = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("at", "turn", "size"))).alias("t"))
    return lined.select("conv_id", F.unhex(F.array_join("t.turn", "")).alias("path"), F.col("t.size").alias("sizes"))


def rebuilt(lines: DataFrame, shared: int = SHARED) -> DataFrame:
    """(conv_id, path, sizes) with the first h turns of conversation ``conv_id - conv_id % shared`` in
    place of the own first h; h is crc32(conv_id) % 9."""
    base = lines.where(F.col("conv_id") % shared == 0).select(
        F.col("conv_id").alias("base"), F.substring("path", 1, 8 * DIGEST).alias("base_path"), F.slice("sizes", 1, 8).alias("base_sizes"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9).cast("int")
    met = (lines.withColumn("base", F.col("conv_id") - F.col("conv_id") % shared).withColumn("h", h).join(base, "base", "left")
           .withColumn("base_path", F.coalesce("base_path", F.lit(b""))).withColumn("base_sizes", F.coalesce("base_sizes", F.array().cast("array<long>"))))
    return met.select(
        "conv_id", F.expr(f"concat(substring(base_path, 1, h * {DIGEST}), substring(path, h * {DIGEST} + 1))").alias("path"),
        F.expr("concat(slice(base_sizes, 1, h), slice(sizes, h + 1, size(sizes)))").alias("sizes"))


def sequences(lines: DataFrame, block: int = BLOCK) -> DataFrame:
    """The different sequences of ``lines`` (conv_id, path, sizes): path, sizes, n, conv_id (the
    least), ends (SHA-256 of the conv_ids in order, comma-joined)."""
    lines = stored(lines.withColumn("key", F.unhex(F.md5("path"))), "trie-lines")
    ids = F.sort_array(F.collect_list("conv_id"))
    blocks = (lines.select("key", "conv_id").groupBy("key", F.floor(F.col("conv_id") / block).alias("block"))
              .agg(ids.alias("ids")).select("key", "block", F.size("ids").cast("long").alias("n"), F.element_at("ids", 1).alias("least"),
                                            F.array_join(F.col("ids").cast("array<string>"), ",").alias("text")))

    def run(batches):
        key, total, least, state, done = None, 0, None, None, []
        for batch in batches:
            for k, n, first, text in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3, 4))):
                if k != key:
                    if key is not None:
                        done.append((key, total, least, state.hexdigest()))
                    key, total, least, state = k, 0, first, hashlib.sha256()
                else:
                    state.update(b",")
                total += n
                state.update(text.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], names=["key", "n", "conv_id", "ends"])
                done = []
        if key is not None:
            done.append((key, total, least, state.hexdigest()))
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], names=["key", "n", "conv_id", "ends"])

    found = blocks.repartition("key").sortWithinPartitions("key", "block").mapInArrow(run, "key binary, n long, conv_id long, ends string")
    return stored(found.join(lines.select("conv_id", "path", "sizes"), "conv_id"), "trie-sequences")


def _prefix(depth: Column) -> Column:
    return F.unhex(F.md5(F.substring("path", F.lit(1), (depth * DIGEST).cast("int"))))


def dealt(found: DataFrame, heavy: int = HEAVY, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """The sequences with cut (turns of the prefix that their shard goes by) and shard."""
    turns = F.size("sizes")
    total = found.agg(F.sum(turns)).first()[0] or 0
    # 1, 2, 4, ... up to the first power above the length, whose prefix no other sequence has
    depths = F.transform(F.sequence(F.lit(0), F.length(F.bin(turns))), lambda e: F.pow(F.lit(2.0), e).cast("long"))
    tried = found.select("key", turns.cast("long").alias("turns"), F.explode(F.when(turns == 0, F.array(F.lit(1).cast("long"))).otherwise(depths)).alias("d"), "path")
    tried = tried.select("key", "turns", "d", _prefix(F.col("d")).alias("prefix"))
    hot = stored(tried.where("d <= turns").groupBy("d", "prefix").agg(F.sum("turns").alias("w"), F.count("*").alias("m"))
                 .where((F.col("w") > heavy) & (F.col("m") > HEAVY_SEQUENCES)).select("d", "prefix"), "trie-hot")
    shards = max(1, -(-total // shard_turns))
    if hot.isEmpty():
        cut = found.withColumn("cut", F.lit(1).cast("long"))
    else:
        least = tried.join(bounded(hot), ["d", "prefix"], "left_anti").groupBy("key").agg(F.min("d").alias("cut"))
        cut = found.join(least, "key")
    return cut.withColumn("shard", F.pmod(F.xxhash64("cut", _prefix(F.col("cut"))), F.lit(shards)))


def nodes(lines: DataFrame, heavy: int = HEAVY, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """A row per node of the trie of ``lines`` (conv_id, path, sizes): conv_id (the least member),
    depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Conversations without turns are members of the root and end there.  No
    conversations give no nodes.  A conversation's digests (24 bytes a turn) are
    one row.
    """
    rows = dealt(sequences(lines), heavy, shard_turns)
    made = stored(rows.select("shard", "cut", "path", "sizes", "n", "conv_id", "ends").groupBy("shard").applyInArrow(shard_nodes, _DDL), "trie-nodes")
    upper = stored(made.where("shared").groupBy("key").agg(
        F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"), F.max("up").alias("up"), F.sum("n_convs").alias("n_convs"),
        F.max("bytes").alias("bytes"), F.sum("n_children").alias("n_children"), F.sum("n_leaves").alias("n_leaves"),
        F.sum("saved_tokens").alias("saved_tokens"), F.max("ends_sha256").alias("ends_sha256")), "trie-upper")
    parent = F.element_at("up", -1)  # null for the root, whose list is empty
    hanging = upper.where("depth > 0").groupBy(parent.alias("key")).agg(F.count("*").alias("more"))
    own = stored(upper.join(hanging, "key", "left").withColumn("n_children", F.col("n_children") + F.coalesce("more", F.lit(0)))
                 .withColumn("own_leaves", F.col("n_leaves") + F.when(F.col("n_children") == 0, 1).otherwise(0))
                 .withColumn("own_saved", F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("bytes"))
                 .drop("more", "n_leaves", "saved_tokens"), "trie-own")
    sums = own.select(F.explode(F.concat("up", F.array("key"))).alias("key"), "own_leaves", "own_saved").groupBy("key").agg(
        F.sum("own_leaves").alias("n_leaves"), F.sum("own_saved").alias("saved_tokens"))
    names = own.select(F.col("key").alias("parent"), F.col("conv_id").alias("named"))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    top = own.join(sums, "key").withColumn("parent", F.when(F.col("depth") > 0, parent)).join(names, "parent", "left")
    lower = made.where("not shared and key is not null").withColumn("parent", F.col("key")).join(bounded(names), "parent")
    return (top.unionByName(lower, allowMissingColumns=True).withColumn("parent_conv_id", F.col("named")).select(*columns)
            .unionByName(made.where("not shared and key is null").select(*columns))
            .withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(_EMPTY))))


def digest(conversations: DataFrame) -> DataFrame:
    """One row per node: the columns of query ``op12_prefix_trie``."""
    return nodes(rebuilt(stored(chains(conversations), "trie-chains")))


SQL = r"""
with t as (select conv_id, coalesce(role, '') as role, coalesce(text, '') as text, md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) as turn_md5,
    row_number() over (partition by conv_id order by turn nulls first,
        md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) as i from conversations where conv_id is not null),
 c as (select conv_id, conv_id - conv_id % 5 as base, xor(list_reduce(list_concat([4294967295::bigint],
        list_transform(string_split(cast(conv_id as varchar), ''), lambda x : ascii(x)::bigint)),
        lambda crc, b : list_reduce(list_concat([xor(crc, b)], [0, 0, 0, 0, 0, 0, 0, 0]::bigint[]),
            lambda a, z : xor(a >> 1, (a & 1) * 3988292384))), 4294967295) % 9 as h from (select distinct conv_id from t)),
 r as (select c.conv_id, t.i, 0 as own, turn_md5, strlen(text) as size from c join t on t.conv_id = c.base and t.i <= h
    union all select c.conv_id, t.i, 1, turn_md5, strlen(text) from c join t on t.conv_id = c.conv_id and t.i > h),
 o as (select conv_id, size, row_number() over w as depth, string_agg(turn_md5, '') over (partition by conv_id order by own, i rows between unbounded preceding and current row) as path
    from r window w as (partition by conv_id order by own, i)),
 m as (select conv_id, depth, path, size, count(*) over (partition by conv_id) as len from o
    union all select conv_id, 0, '', 0, coalesce(len, 0) from c left join (select conv_id, count(*) as len from r group by conv_id) using (conv_id)),
 n as (select depth, path, min(conv_id) as conv_id, count(*) as n_convs, max(size) as size,
    sha256(coalesce(string_agg(cast(conv_id as varchar), ',' order by conv_id) filter (len = depth), '')) as ends_sha256 from m group by depth, path),
 k as (select n.*, p.conv_id as parent_conv_id, (select count(*) from n x where x.depth = n.depth + 1 and substr(x.path, 1, 32 * n.depth) = n.path) as n_children
    from n left join n p on p.depth = n.depth - 1 and p.path = substr(n.path, 1, 32 * (n.depth - 1)))
select k.conv_id, k.depth, k.parent_conv_id, k.n_convs, k.n_children, cast(count(*) filter (x.n_children = 0) as bigint) as n_leaves,
    cast(sum((x.n_convs - 1) * x.size) as bigint) as saved_tokens, k.ends_sha256
from k join k x on x.depth >= k.depth and substr(x.path, 1, 32 * k.depth) = k.path
group by all
"""
