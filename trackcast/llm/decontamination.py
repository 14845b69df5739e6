"""Benchmark decontamination as a prefix-filtered set join.

A window of a benchmark item is ``window`` consecutive words (a shorter item is
one window).  A document contains it if the same words stand there in a row.
Each window is a set of word shingles; containing the window means containing
all of them, so one shingle, the window's rarest in the corpus, is a sufficient
join prefix:

1. *rarity*: one pass counts every item shingle over all documents (partial
   counts in the map tasks, summed by ``groupBy``);
2. *prefix join*: a second pass looks up the documents' shingles among the
   windows' rarest ones; each match gives a window start (positional bound) that
   must leave room for the whole window inside the text (length bound);
3. *verification*: the words of the window and of the text are compared.

The benchmark side is broadcast in blocks of at most ``block_words`` item words,
so that a broadcast and a task's memory have a fixed bound whatever the size of
the benchmark.  One block, the usual case, needs no shuffle of documents at all,
so a hot source or passage cannot skew a task; with more, every block is a pass
over the documents, and the passes' hits (narrow rows) are merged by text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .frames import append_columns, free_names, stored
from .text import ALNUM, LOWER, Words, groups, shingles, words_of

WINDOW = 13          # item words in a window
SHINGLE = 5          # words in a shingle (fewer for windows that are shorter)
BLOCK_WORDS = 1_000_000  # item words broadcast at once: about 80 MB
_BITS = 21           # size of the bit filter in front of the exact lookup


def _lower_words(data: np.ndarray, offsets: np.ndarray) -> Words:
    return words_of(LOWER[data], offsets, ALNUM)


class _Lookup:
    """Positions of hashes in a sorted array, behind a bit filter."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        self.filter = np.zeros(1 << _BITS, dtype=bool)
        self.filter[keys >> np.uint64(64 - _BITS)] = True

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Indices into ``hashes`` that are present, and where in the keys."""
        maybe = np.flatnonzero(self.filter[hashes >> np.uint64(64 - _BITS)])
        at = np.searchsorted(self.keys, hashes[maybe])
        at[at == len(self.keys)] = 0
        hit = self.keys[at] == hashes[maybe]
        return maybe[hit], at[hit]


class Block:
    """The windows of some items, with the shingles of each."""

    def __init__(self, items: list[tuple[str, bytes]], window: int, shingle: int):
        data, offsets = b"".join(t for _, t in items), np.zeros(len(items) + 1, np.int64)
        np.cumsum([len(t) for _, t in items], out=offsets[1:])
        words = _lower_words(np.frombuffer(data, np.uint8), offsets)
        self.hashes = words.hashes()
        self.words = [words.word(i) for i in range(len(self.hashes))]
        self.ids = [i for i, _ in items]
        n = words.counts
        starts, lengths, owner = [], [], []
        for i, count in enumerate(n):
            if count:
                length = min(window, int(count))
                here = np.arange(words.first[i], words.first[i + 1] - length + 1)
                starts.append(here)
                lengths.append(np.full(len(here), length))
                owner.append(np.full(len(here), i))
        join = (lambda x: np.concatenate(x).astype(np.int64)) if starts else (lambda x: np.zeros(0, np.int64))
        self.start, self.length, self.owner = join(starts), join(lengths), join(owner)
        #: by shingle length: the sorted shingles, and each window's shingles as (window, offset, key)
        self.by_k: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = {}
        ks = np.minimum(shingle, self.length)
        for k in np.unique(ks):
            value, at = shingles(self.hashes, words.first, int(k))
            where = np.full(len(self.hashes) + 1, -1)
            where[at] = np.arange(len(at))
            w = np.flatnonzero(ks == k)
            per = self.length[w] - k + 1
            win = np.repeat(w, per)
            off = np.arange(len(win)) - np.repeat(np.cumsum(per) - per, per)
            used = value[where[self.start[win] + off]]
            keys, key = np.unique(used, return_inverse=True)
            self.by_k[int(k)] = (keys, win, off, key)

    def __getstate__(self):
        """Tasks get the windows, not the shingles of each."""
        return {k: v for k, v in vars(self).items() if k != "by_k"}

    def prefixes(self, counts: dict[int, np.ndarray]) -> dict[int, tuple]:
        """By shingle length: sorted prefix shingles and, grouped by shingle, the
        (window, offset) pairs that they stand for.  Rarest first, then leftmost."""
        out = {}
        for k, (keys, win, off, key) in self.by_k.items():
            order = np.lexsort((off, counts[k][key], win))
            _, head = np.unique(win[order], return_index=True)
            pick = order[head]
            pick = pick[np.argsort(key[pick], kind="stable")]
            used, first = np.unique(key[pick], return_index=True)
            out[k] = (keys[used], np.append(first, len(pick)), win[pick], off[pick])
        return out


def blocks(items: DataFrame, item_id: str, text: str, window: int, shingle: int,
           block_words: int) -> Iterator[Block]:
    """The items in blocks of at most ``block_words`` words (one item at least)."""
    rows = items.select(F.coalesce(F.col(item_id).cast("string"), F.lit("null")).alias("i"),
                        F.col(text).cast("binary").alias("t")).dropna(subset=["t"]).distinct()
    held, size = [], 0
    for row in rows.toLocalIterator():
        n = len(row["t"]) // 2 + 1  # words, at most
        if held and size + n > block_words:
            yield Block(held, window, shingle)
            held, size = [], 0
        held.append((row["i"], bytes(row["t"])))
        size += n
    if held:
        yield Block(held, window, shingle)


def _count_shingles(docs: DataFrame, text: str, block: Block) -> dict[int, np.ndarray]:
    """Occurrences of every item shingle over all documents, by shingle length."""
    held = docs.sparkSession.sparkContext.broadcast({k: v[0] for k, v in block.by_k.items()})

    def run(batches):
        tables = [(k, _Lookup(keys)) for k, keys in held.value.items()]
        sums = [np.zeros(len(t.keys), np.int64) for _, t in tables]
        for batch in batches:
            for _, _, data, offsets in groups(batch.column(0)):
                words = _lower_words(data, offsets)
                hashes = words.hashes()
                for (k, lookup), total in zip(tables, sums):
                    _, at = lookup.find(shingles(hashes, words.first, k)[0])
                    total += np.bincount(at, minlength=len(total))
        for (k, _), total in zip(tables, sums):
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), k, np.int32)), pa.array(at), pa.array(total[at])],
                                             names=["k", "key", "n"])

    found = docs.select(text).mapInArrow(run, "k int, key long, n long")
    out = {k: np.zeros(len(keys), np.int64) for k, keys in held.value.items()}
    for r in found.groupBy("k", "key").agg(F.sum("n").alias("n")).toLocalIterator():
        out[r["k"]][r["key"]] = r["n"]
    held.unpersist()
    return out


def _matches(words: Words, hashes: np.ndarray, made: dict, block: Block, prefixes: dict):
    """(first word, window) of every verified occurrence in a group of texts."""
    for k, (lookup, first, win, off) in prefixes.items():
        if k not in made:
            made[k] = shingles(hashes, words.first, k)
        value, at = made[k]
        hit, key = lookup.find(value)
        if not len(hit):
            continue
        n = first[key + 1] - first[key]
        pos = np.repeat(at[hit], n)
        entry = np.repeat(first[key], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        window = win[entry]
        start = pos - off[entry]
        length = block.length[window]
        doc = words.text[pos]
        fits = (start >= words.first[doc]) & (start + length <= words.first[doc + 1])
        start, window, length = start[fits], window[fits], length[fits]
        for L in np.unique(length):  # compare all words, by hash and then as they stand
            some = np.flatnonzero(length == L)
            step = np.arange(L)
            same = (hashes[start[some, None] + step] == block.hashes[block.start[window[some], None] + step]).all(axis=1)
            for i in some[same]:
                s, w = int(start[i]), int(window[i])
                b = int(block.start[w])
                if all(words.word(s + j) == block.words[b + j] for j in range(L)):
                    yield s, w


def contamination(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id",
                  item_text: str = "text", window: int = WINDOW, shingle: int = SHINGLE,
                  block_words: int = BLOCK_WORDS, keep: list[str] | None = None) -> tuple[DataFrame, list[str]]:
    """``docs`` (or its columns ``keep``) with the columns n_words, n_hit (words inside any occurrence of an
    item window), items (ids of the items with occurring windows, sorted as
    strings), and the names these columns got.

    A null or wordless text has 0 words and no hits; a null or wordless item has
    no window; repeated items (equal id and text) count once, a null id is called
    ``null``.  An empty benchmark gives no hits.  Every document is kept.
    """
    keep = docs.columns if keep is None else keep
    found, last = [], None
    for block in blocks(items, item_id, item_text, window, shingle, block_words):
        if last is not None:  # more than one: the hits of each are a table
            rows, names = _with_hits(docs.select(text), text, last, [text])
            found.append(stored(rows.where(F.size(names[1]) > 0).select(
                _text_key(text).alias("k"), F.col(names[1]).alias("spans"), F.col(names[2]).alias("items")).distinct(), "item-hits"))
            last[0].unpersist()
            last[1].unpersist()
        last = _prepared(docs, text, block)
    out, (n_words, spans, ids) = _with_hits(docs, text, last, [*keep, text] if found and text not in keep else keep)
    if found:
        k, more, other = free_names(out.columns, ["k", "more", "other"])
        hits = found[0]
        for f in found[1:]:
            hits = hits.unionByName(f)
        hits = stored(hits.groupBy("k").agg(F.flatten(F.collect_list("spans")).alias("spans"), F.flatten(F.collect_list("items")).alias("items")), "item-hits")
        out = out.withColumn(k, _text_key(text)).join(
            hits.select(F.col("k").alias(k), F.col("spans").alias(more), F.col("items").alias(other)), k, "left")
        none = F.array().cast("array<int>"), F.array().cast("array<string>")
        out = out.withColumns({spans: F.concat(spans, F.coalesce(more, none[0])), ids: F.concat(ids, F.coalesce(other, none[1]))})
    n_hit, names = free_names([*keep, n_words, spans, ids], ["n_hit"])[0], free_names(keep, ["n_words", "n_hit", "items"])
    out = out.withColumn(n_hit, _covered(F.col(spans)))
    return out.select(*keep, F.col(n_words).alias(names[0]), F.col(n_hit).alias(names[1]),
                      F.array_sort(F.array_distinct(ids)).alias(names[2])), names


def _text_key(text: str):
    return F.struct(F.xxhash64(text).alias("a"), F.xxhash64(F.lit("+"), text).alias("b"))


def _covered(spans):
    """Words inside any of the spans [start, end, start, end, ...]: every span counts
    what lies behind the furthest end before it."""
    pairs = F.array_sort(F.transform(F.sequence(F.lit(0), F.floor(F.size(spans) / 2 - 1).cast("int")), lambda i: F.struct(
        spans[(i * 2).cast("int")].alias("s"), spans[(i * 2 + 1).cast("int")].alias("e"))))
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
    total = F.aggregate(pairs, start, lambda acc, p: F.struct(
        (acc["n"] + F.greatest(F.lit(0), p["e"] - F.greatest(p["s"], acc["end"]))).alias("n"),
        F.greatest(acc["end"], p["e"]).alias("end")), lambda acc: acc["n"])
    return F.when(F.size(spans) > 0, total).otherwise(0).cast("long")


def _prepared(docs: DataFrame, text: str, block: Block) -> tuple:
    """Broadcasts of a block's windows and of their prefixes."""
    sc = docs.sparkSession.sparkContext
    return sc.broadcast(block), sc.broadcast(block.prefixes(_count_shingles(docs, text, block)))


def _with_hits(docs: DataFrame, text: str, block: tuple | None, keep: list[str]) -> tuple[DataFrame, list[str]]:
    """``docs`` with n_words, spans (merged, flat) of the words hit by the block's windows, and their items."""
    def factory():
        held = None if block is None else block[0].value
        lookups = {} if block is None else {k: (_Lookup(p[0]), *p[1:]) for k, p in block[1].value.items()}

        def work(column):
            n_words = np.zeros(len(column), np.int64)
            spans: list[list[int]] = [[]] * len(column)
            found: list[list[str]] = [[]] * len(column)
            for at, end, data, offsets in groups(column):
                words = _lower_words(data, offsets)
                n_words[at:end] = words.counts
                if not lookups:
                    continue
                edge, items_of = None, {}
                for s, w in _matches(words, words.hashes(), {}, held, lookups):
                    if edge is None:
                        edge = np.zeros(len(words.starts) + 1, np.int64)
                    edge[s] += 1
                    edge[s + int(held.length[w])] -= 1
                    items_of.setdefault(int(words.text[s]), set()).add(held.ids[held.owner[w]])
                if edge is None:
                    continue
                inside = np.cumsum(edge[:-1]) > 0
                for i, ids in items_of.items():
                    mine = np.diff(np.concatenate([[0], inside[words.first[i]:words.first[i + 1]].astype(np.int8), [0]]))
                    spans[at + i] = np.flatnonzero(mine).astype(np.int32)  # start, end, start, end, ...
                    found[at + i] = sorted(ids)
            return [pa.array(n_words), pa.array(spans, pa.list_(pa.int32())), pa.array(found, pa.list_(pa.string()))]

        return work

    return append_columns(docs, text, [("n_words", T.LongType()), ("spans", T.ArrayType(T.IntegerType())),
                                       ("items", T.ArrayType(T.StringType()))], factory, keep)


def contaminated(n_hit, n_words):
    """The rule: some hit, and hits are a twentieth of the words or more."""
    return (n_hit > 0) & (n_hit * 20 >= n_words)


def decontaminate(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The documents that are not contaminated, with their own columns only."""
    out, (n_words, n_hit, _) = contamination(docs, items, **options)
    return out.where(~contaminated(F.col(n_hit), F.col(n_words))).select(*docs.columns)


def digest(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """One row per document: the columns of query ``op10_benchmark_decontamination``."""
    out, (n_words, n_hit, found) = contamination(docs.select("doc_id", "text"), items, keep=["doc_id"], **options)
    return out.select(
        "doc_id", F.col(n_words).alias("n_words"), F.col(n_hit).alias("n_hit"),
        F.size(found).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", found), 256).alias("items_sha256"),
        contaminated(F.col(n_hit), F.col(n_words)).alias("contaminated"))


SQL = r"""
with d as (select row_number() over () r, doc_id,
    coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) w from documents),
 b as (select coalesce(cast(item_id as varchar), 'null') item_id,
    coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) w from benchmark),
 bw as (select item_id, least(13, len(w)) k, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) p from b where len(w) > 0),
 win as (select distinct item_id, k, array_to_string(w[p:p + k - 1], ' ') g from bw),
 dw as (select r, k, w, unnest(range(1, len(w) - k + 2)) p from d, (select distinct k from win) where len(w) >= k),
 hit as (select r, p, dw.k, item_id from dw join win on dw.k = win.k and array_to_string(w[p:p + dw.k - 1], ' ') = g),
 words as (select r, count(distinct q) n_hit from (select r, unnest(range(p, p + k)) q from hit) group by r),
 ids as (select r, count(distinct item_id) n_items, string_agg(distinct item_id, ',' order by item_id) s from hit group by r)
select doc_id, cast(len(w) as bigint) n_words, cast(coalesce(n_hit, 0) as bigint) n_hit,
    cast(coalesce(n_items, 0) as bigint) n_items, sha256(coalesce(s, '')) items_sha256,
    coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) contaminated
from d left join words using (r) left join ids using (r)
"""
