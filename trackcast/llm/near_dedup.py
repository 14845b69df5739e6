"""Near-duplicates by Order MinHash, verified by banded alignment of words.

A text is a sequence of lower-cased words; its k-mers are runs of two words
(a lone word where there is only one), labelled with their occurrence
number.  Each of ``SKETCHES`` sketches takes the ``MINIMA`` least labelled k-mers
under its own hash and keeps them in text order, so that equal sketches point to
shared content in the same order (edit similarity), not just to a shared set.

1. Equal texts are one node (a digest); only narrow rows are shuffled for that.
2. Texts with an equal sketch meet in a bucket.  A bucket first pairs each member
   with one centre, so it makes as many candidate pairs as it has members.
3. Then all members of different components of a bucket are compared, in blocks
   of ``BLOCK``: lengths and bags of words rule out most pairs inside the task, the
   others are aligned there, each pair in the first of the buckets that it shares,
   and only links become rows.  Buckets of more than ``LARGE`` are split by the
   members' rare words, of which two similar texts share one; there what lengths
   and bags allow becomes a row.  No similar pair that meets in a bucket is lost
   by that.
4. A candidate pair is a link if the word edit similarity,
   ``1 - distance / words of the longer text``, is 0.8 or more; the alignment
   walks diagonals inside the band that this threshold leaves, for many pairs at
   once.
5. Classes are the connected components of the links.

Hot buckets and digests are aggregated before the shuffle, and joined from
stored tables, where Spark splits skewed partitions.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .frames import append_columns, bounded, free_names, stored
from .graph import components
from .text import LOWER, NOT_SPACE, groups, mix, shingles, words_of

KMER = 2
MINIMA = 3
SKETCHES = 48
SIMILARITY = 0.8
BLOCK = 512          # members of a bucket that are compared with as many others in one group
LARGE = 4096         # members from which on a bucket is split by rare words first
SLOTS = 64           # least size of a bag
ORDER_TEXTS = 4096   # about as many texts are counted for the order of the words
ORDER_SLOTS = 1 << 18
BLOCK_WORDS = 1 << 20  # words of a bucket that are one block
WIDE = 64            # edits from which on the alignment works on all diagonals at once
TOGETHER = 512       # edits up to which many pairs are aligned at once
CELLS = 1 << 19      # furthest points of the pairs that are aligned at once
SEED = 5


def _labelled_kmers(words, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Occurrence-labelled k-mers of a group of texts in text order: hash, first word, text."""
    hashes = words.hashes()
    found = [shingles(hashes, words.first, k)]
    for n in np.unique(words.counts[(words.counts > 0) & (words.counts < k)]):
        value, at = shingles(hashes, words.first, int(n))
        whole = words.counts[words.text[at]] == n
        found.append((value[whole], at[whole]))
    value, at = (np.concatenate(x) for x in zip(*found))
    order = np.argsort(at, kind="stable")
    value, at = value[order], at[order]
    text = words.text[at]
    order = np.lexsort((value, text))  # stable: equal k-mers stay in text order
    v, t = value[order], text[order]
    new = np.ones(len(v), dtype=bool)
    new[1:] = (v[1:] != v[:-1]) | (t[1:] != t[:-1])
    run = np.maximum.accumulate(np.where(new, np.arange(len(v)), 0))
    occurrence = np.empty(len(v), np.uint64)
    occurrence[order] = (np.arange(len(v)) - run).astype(np.uint64)
    return mix(value + occurrence * np.uint64(0xA24BAED4963EE407)), at, text


def order_sketches(words, k: int = KMER, sketches: int = SKETCHES, seed: int = SEED, minima: int = MINIMA) -> tuple[np.ndarray, np.ndarray]:
    """(texts that have words, their sketches): row i of the sketches is for text i of the list."""
    label, _, text = _labelled_kmers(words, k)
    texts, begin = np.unique(text, return_index=True)
    out = np.empty((len(texts), sketches), np.uint64)
    if not len(texts):
        return texts, out
    rank = np.repeat(np.arange(len(texts)), np.diff(np.append(begin, len(text))))
    draws = np.random.default_rng(seed).integers(1, 1 << 63, (sketches, 2), dtype=np.uint64)
    top = np.uint64(0xFFFFFFFFFFFFFFFF)
    found = np.empty((minima, len(texts)), np.int64)
    for j, (salt, factor) in enumerate(draws):
        key = (label ^ salt) * (factor * np.uint64(2) + np.uint64(1))
        for i in range(minima):
            at = np.flatnonzero(key == np.minimum.reduceat(key, begin)[rank])
            if len(at) > len(texts):  # a text with fewer k-mers than minima: its first stands again
                at = at[np.unique(rank[at], return_index=True)[1]]
            found[i] = at
            key[at] = top
        value = np.full(len(texts), j, np.uint64)
        for at in np.sort(found, axis=0):  # text order
            value = mix(value * np.uint64(3) + label[at])
        out[:, j] = value
    return texts, out


def _anchored(a: np.ndarray, b: np.ndarray, va, ca, ia, vb, cb, ib) -> int:
    """An upper bound of the distance: words that stand once in either text and in
    the same order are kept; stretches between them are compared word by word if
    equally long, else replaced."""
    once = (ca[ia] == 1) & (cb[ib] == 1)
    at_a, at_b = np.argsort(a, kind="stable"), np.argsort(b, kind="stable")
    x = at_a[(np.cumsum(ca) - ca)[ia[once]]]
    y = at_b[(np.cumsum(cb) - cb)[ib[once]]]
    order = np.argsort(x)
    x, y = x[order], y[order].tolist()
    tails, where, back = [], [], []  # longest increasing run of y
    for i, v in enumerate(y):
        k = bisect_left(tails, v)
        back.append(where[k - 1] if k else -1)
        if k == len(tails):
            tails.append(v)
            where.append(i)
        else:
            tails[k], where[k] = v, i
    chain, i = [], where[-1] if where else -1
    while i >= 0:
        chain.append(i)
        i = back[i]
    chain = np.array(chain[::-1], dtype=np.int64)
    px = np.concatenate([[-1], x[chain], [len(a)]])
    py = np.concatenate([[-1], np.array(y, dtype=np.int64)[chain], [len(b)]])
    gap_a, gap_b = np.diff(px) - 1, np.diff(py) - 1
    level = gap_a == gap_b
    n = gap_a[level]
    at = np.repeat(px[:-1][level] + 1, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    shift = np.repeat((py - px)[:-1][level], n)
    return int(np.maximum(gap_a, gap_b)[~level].sum()) + int((a[at] != b[at + shift]).sum())


def _wide(a: np.ndarray, b: np.ndarray, most: int) -> int | None:
    """Edit distance if it is ``most`` or less: one step per edit, for all diagonals of the band at once."""
    n, m = len(a), len(b)
    goal = m - n
    low, high = max(-n, goal - most, -most), min(m, goal + most, most)  # diagonals that can matter
    d = np.arange(low, high + 1)
    end = np.minimum(n, m - d)  # of each diagonal
    far = np.full(len(d) + 2, -(1 << 40))  # with a margin on either side
    far[1 - low] = 0
    for e in range(most + 1):
        if e:
            far[1:-1] = np.maximum(np.maximum(far[1:-1] + 1, far[:-2]), far[2:] + 1)
            lost = far[1:-1] < np.maximum(0, -d)
            far[1:-1] = np.where(lost, -(1 << 40), np.minimum(far[1:-1], end))
        lo, hi = max(low, -e, goal - (most - e)), min(high, e, goal + (most - e))
        at = np.arange(lo - low, hi - low + 1)
        at = at[far[at + 1] >= 0]
        width = 4
        while len(at):  # slide along equal words
            i = far[at + 1]
            steps = i[:, None] + np.arange(width)
            inside = steps < end[at][:, None]
            equal = inside & (a[np.minimum(steps, n - 1)] == b[np.clip(steps + d[at][:, None], 0, m - 1)])
            run = np.where(equal.all(axis=1), width, np.argmin(equal, axis=1))
            far[at + 1] = i + run
            at = at[run == width]
            width = min(2 * width, max(4, (1 << 20) // max(1, len(at))))
        if far[1 + goal - low] >= n:
            return e
    return None


def edit_distance(a: np.ndarray, b: np.ndarray, most: int, exact: bool = True) -> int | None:
    """Word edit distance if it is ``most`` or less, else None.

    Walks the furthest points per diagonal for 0, 1, 2, ... edits, only on the
    diagonals from which the end can still be reached.  Without ``exact`` the
    number may be too high (but not above ``most``): whether it is None stays right.
    """
    if len(a) > len(b):
        a, b = b, a
    n, m = len(a), len(b)
    if m - n > most:
        return None
    differ = np.flatnonzero(a != b[:n])
    head = int(differ[0]) if len(differ) else n
    a, b = a[head:], b[head:]
    differ = np.flatnonzero(a[::-1] != b[::-1][:len(a)])
    tail = int(differ[0]) if len(differ) else len(a)
    a, b = a[:len(a) - tail], b[:len(b) - tail]
    n, m = len(a), len(b)
    if n == 0:
        return m if m <= most else None
    va, ca = np.unique(a, return_counts=True)
    vb, cb = np.unique(b, return_counts=True)
    _, ia, ib = np.intersect1d(va, vb, assume_unique=True, return_indices=True)
    if m - int(np.minimum(ca[ia], cb[ib]).sum()) > most:
        return None
    if exact is False and _anchored(a, b, va, ca, ia, vb, cb, ib) <= most:
        return most
    if most > WIDE:
        return _wide(a, b, most)
    one, two, stops = a.tolist(), b.tolist(), {}

    def slide(d: int, i: int) -> int:
        """First i' >= i at which a[i'] and b[i' + d] differ, or an end is reached."""
        end = min(n, m - d)
        near = min(end, i + 8)
        while i < near:
            if one[i] != two[i + d]:
                return i
            i += 1
        if i == end:
            return i
        if d not in stops:  # a long match: look up where this diagonal breaks
            lo = max(0, -d)
            stops[d] = np.append(np.flatnonzero(a[lo:end] != b[lo + d:end + d]) + lo, end)
        return int(stops[d][np.searchsorted(stops[d], i)])

    far = {0: slide(0, 0)}
    goal = m - n
    for e in range(most + 1):
        if far.get(goal, -1) >= n:
            return e
        nxt = {}
        for d in range(max(-e - 1, goal - (most - e - 1)), min(e + 1, goal + most - e - 1) + 1):
            i = max(far.get(d, -2) + 1, far.get(d - 1, -1), far.get(d + 1, -2) + 1)
            if i < 0 or i < -d:
                continue
            i = min(i, n, m - d)
            if i >= max(0, -d):
                nxt[d] = slide(d, i)
        far = nxt
    return None


def similar(a: np.ndarray, b: np.ndarray, threshold: float = SIMILARITY) -> bool:
    longer = max(len(a), len(b))
    most = int((1 - threshold) * longer + 1e-9)
    return longer == 0 or edit_distance(a, b, most, exact=False) is not None


def _walk(words: np.ndarray, a0: np.ndarray, n: np.ndarray, b0: np.ndarray, m: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Of each pair of runs of ``words`` (from ``a0``, of ``n`` words; from ``b0``, of ``m``, not
    fewer) whether ``most`` edits or fewer lead from one to the other: the furthest points of
    0, 1, 2, ... edits on the diagonals of all pairs at once."""
    out, last, lost = np.zeros(len(n), bool), len(words) - 1, np.int32(-(1 << 30))
    pair = np.flatnonzero(m - n <= most)
    reach = int(most[pair].max()) if len(pair) else 0
    far = np.full((len(pair), 2 * reach + 3), lost, np.int32)  # with a margin on either side
    far[:, reach + 1] = 0
    for e in range(reach + 1):
        na, mb, left, goal = n[pair], m[pair], most[pair] - e, (m - n)[pair]
        c0, c1 = reach + 1 - e, reach + 2 + e
        d = np.arange(-e, e + 1)
        now = far[:, c0:c1]
        if e:
            now = np.maximum(np.maximum(now + 1, far[:, c0 - 1:c1 - 1]), far[:, c0 + 1:c1 + 1] + 1)
            now = np.minimum(now, np.minimum(na[:, None], mb[:, None] - d).astype(np.int32))
            now[now < np.maximum(0, -d)] = lost
        row, col = np.nonzero((now >= 0) & (np.abs(d - goal[:, None]) <= left[:, None]))  # from where the end can be reached
        i, k = now[row, col].astype(np.int64), d[col]
        end, one = np.minimum(na[row], mb[row] - k), a0[pair][row]
        two, width = b0[pair][row] + k, 1
        at = np.flatnonzero(i < end)
        while len(at):  # slide along equal words
            step = i[at][:, None] + np.arange(width)
            equal = (step < end[at][:, None]) & (words[np.minimum(one[at][:, None] + step, last)] == words[np.minimum(two[at][:, None] + step, last)])
            run = np.where(equal.all(axis=1), width, np.argmin(equal, axis=1))
            i[at] += run
            at = at[(run == width) & (i[at] < end[at])]
            width = min(4 * width, max(4, CELLS // max(1, len(at))))
        now[row, col] = i
        far[:, c0:c1] = now
        there = far[np.arange(len(pair)), reach + 1 + goal] >= na
        out[pair[there]] = True
        stay = ~there & (left > 0)
        if not stay.all():
            pair, far = pair[stay], far[stay]
        if not len(pair):
            break
    return out


def similar_pairs(words: np.ndarray, first: np.ndarray, one: np.ndarray, two: np.ndarray, threshold: float = SIMILARITY) -> np.ndarray:
    """``similar`` of many pairs (``one``, ``two``) of texts; text t is ``words[first[t]:first[t + 1]]``."""
    counts = np.diff(first)
    a, b = np.where(counts[one] > counts[two], (two, one), (one, two))
    most, out = _most(counts[b], threshold), np.zeros(len(a), bool)
    for p in np.flatnonzero(most > TOGETHER):
        out[p] = similar(words[first[a[p]]:first[a[p] + 1]], words[first[b[p]]:first[b[p] + 1]], threshold)
    order = np.flatnonzero(most <= TOGETHER)
    order = order[np.argsort(most[order], kind="stable")]  # bands of about one width side by side
    while len(order):
        n = max(1, int(np.searchsorted((2 * most[order] + 3) * np.arange(1, len(order) + 1), CELLS, side="right")))
        part, order = order[:n], order[n:]
        out[part] = _walk(words, first[a[part]], counts[a[part]], first[b[part]], counts[b[part]], most[part])
    return out


def _all_words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The word hashes of the texts, one text after the other, and where each text begins."""
    hashes, counts = [np.zeros(0, np.uint64)], [np.zeros(1, np.int64)]
    for _, _, data, offsets in groups(column):
        words = words_of(LOWER[data], offsets, NOT_SPACE)
        hashes.append(words.hashes())
        counts.append(words.counts)
    return np.concatenate(hashes), np.cumsum(np.concatenate(counts))


def _most(words: int | np.ndarray, threshold: float):
    """Edits that a pair may have whose longer text has so many words."""
    return np.floor((1 - threshold) * words + 1e-9).astype(np.int64)


def bags(words) -> list[bytes]:
    """Of each text the counts (to 255) of its words by hash, in a power of two of slots, two to four a word."""
    hashes, out = words.hashes(), []
    for i, j in zip(words.first[:-1], words.first[1:]):
        slots = max(SLOTS, 1 << int(2 * (j - i)).bit_length())
        out.append(np.minimum(np.bincount((hashes[i:j] & np.uint64(slots - 1)).astype(np.int64), minlength=slots), 255).astype(np.uint8).tobytes())
    return out


def _folded(rows: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Bags of one size as counts in ``width`` slots, and which of these are known: one that
    holds a count of 255 may be more."""
    x = np.frombuffer(b"".join(rows), np.uint8).reshape(len(rows), -1, width)
    return x.sum(axis=1, dtype=np.int64), (x != 255).all(axis=1)


def least_edits(a: list[bytes], b: list[bytes]) -> np.ndarray:
    """Lower bounds of the distances of pairs of texts, from their bags: folded to the smaller
    size, over the slots that are known in both."""
    out = np.zeros(len(a), np.int64)
    size = np.array([(len(x), len(y)) for x, y in zip(a, b)], dtype=np.int64).reshape(-1, 2)
    for la, lb in np.unique(size, axis=0):
        same, step = np.flatnonzero((size == (la, lb)).all(axis=1)), max(1, (1 << 22) // int(la + lb))
        for part in np.split(same, range(step, len(same), step)):
            (x, known), (y, too) = (_folded([side[i] for i in part], int(min(la, lb))) for side in (a, b))
            d = np.where(known & too, x - y, 0)
            out[part] = np.maximum(np.maximum(d, 0).sum(axis=1), np.maximum(-d, 0).sum(axis=1))
    return out


def possible(pairs: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) of ids without those that lengths and bags rule out: no similar pair is lost."""
    for end in ("b", "a"):
        pairs = pairs.join(nodes.select(F.col("id").alias(end), F.col("words").alias(f"words_{end}"), F.col("bag").alias(f"bag_{end}")), end)
    longer = F.greatest("words_a", "words_b")
    near = F.abs(F.col("words_a") - F.col("words_b")) <= F.floor((1 - threshold) * longer + 1e-9)
    both = pairs.where(near).select("a", "b", longer.alias("words"), "bag_a", "bag_b")

    def run(batches):
        for batch in batches:
            keep = least_edits(batch.column(3).to_pylist(), batch.column(4).to_pylist()) <= _most(batch.column(2).to_numpy(), threshold)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return stored(both.mapInArrow(run, "a long, b long"), "near-possible")


def _texts(chosen: DataFrame, nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """(id, text) of the chosen ids, one text a node."""
    first = stored(nodes.select("node", "id", F.col("doc").alias("first_doc")).join(chosen, "id", "left_semi"), "near-chosen")
    # the join goes by node alone, so that what follows needs no other shuffle
    return stored(docs.join(bounded(first), "node").where(F.coalesce(F.try_subtract("doc", "first_doc"), F.lit(0)) == 0)
                  .select("node", "id", "text").dropDuplicates(["node"]).drop("node"), "near-texts")


def verified(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, threshold: float) -> DataFrame:
    """Of the possible pairs (a, b) of ids those whose texts are similar."""
    texts = _texts(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct(), nodes, docs)
    both = (pairs.join(texts.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b")
            .join(texts.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a")
            .select("a", "b", "text_a", "text_b"))

    def run(batches):
        for batch in batches:
            for at in range(0, len(batch), 512):  # the words of few texts at a time
                part = batch.slice(at, 512)
                n = np.arange(len(part))
                words, first = _all_words(pa.concat_arrays([part.column(2), part.column(3)]))
                keep = pa.array(similar_pairs(words, first, n, n + len(part), threshold), pa.bool_())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1)], names=["a", "b"]).filter(keep)

    return stored(both.mapInArrow(run, "a long, b long"), "near-links")


def rare_words(texts: DataFrame, threshold: float) -> DataFrame:
    """(id, word): of each text the rarest of its labelled words, one more than the edits it may have.

    Two similar texts share one of these words, whatever the order of the words
    is, if it is one for all texts.  It goes by counts on a sample, then by hash.
    """
    n = texts.count()
    some = texts.where(F.pmod(F.xxhash64("id"), F.lit(max(1, n // ORDER_TEXTS))) == 0).select("text")

    def count(batches):
        total = np.zeros(ORDER_SLOTS, np.int64)
        for batch in batches:
            for _, _, data, offsets in groups(batch.column(0)):
                label, _, _ = _labelled_kmers(words_of(LOWER[data], offsets, NOT_SPACE), 1)
                total += np.bincount((label % np.uint64(ORDER_SLOTS)).astype(np.int64), minlength=ORDER_SLOTS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], names=["slot", "n"])

    counts = some.mapInArrow(count, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    order = np.zeros(ORDER_SLOTS, np.int32)
    order[counts["slot"].to_numpy()] = np.minimum(counts["n"].to_numpy(), 1 << 30)

    def run(batches):
        for batch in batches:
            for at, end, data, offsets in groups(batch.column(1)):
                words = words_of(LOWER[data], offsets, NOT_SPACE)
                label, _, text = _labelled_kmers(words, 1)
                by = np.lexsort((label, order[(label % np.uint64(ORDER_SLOTS)).astype(np.int64)], text))
                by = by[np.arange(len(text)) - words.first[text] <= _most(words.counts, threshold)[text]]
                for part in range(0, len(by), 1 << 16):
                    these = by[part:part + (1 << 16)]
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at + text[these])), pa.array(label[these].view(np.int64))], names=["id", "word"])

    return texts.select("id", "text").mapInArrow(run, "id long, word long")


def _allowed(group, one: np.ndarray, two: np.ndarray, threshold: float, mine=None) -> tuple[np.ndarray, np.ndarray]:
    """The pairs (rows of the group) between the rows ``one`` and ``two`` that are of different
    components and that lengths and bags allow; each pair once if they are the same rows.
    ``mine`` tells of pairs which belong to the group, should not all."""
    ids, root, words, bag = group
    table = np.empty((len(ids), SLOTS), np.int64)
    known = np.empty((len(ids), SLOTS), dtype=bool)
    for i, row in enumerate(bag):
        (table[i],), (known[i],) = _folded([row], SLOTS)
    found, step = [], max(1, (1 << 21) // (SLOTS * max(1, len(two))))
    for at in range(0, len(one), step):
        a = one[at:at + step]
        longer = np.maximum(words[a][:, None], words[two][None])
        most = _most(longer, threshold)
        ok = (root[a][:, None] != root[two][None]) & (np.abs(words[a][:, None] - words[two][None]) <= most)
        if one is two:
            ok &= two[None] > a[:, None]
        i, j = np.nonzero(ok)
        if not len(i):
            continue
        i, j, most = a[i], two[j], most[i, j]
        d = np.where(known[i] & known[j], table[i] - table[j], 0)
        near = np.maximum(np.maximum(d, 0).sum(axis=1), np.maximum(-d, 0).sum(axis=1)) <= most
        if mine is not None:
            near[near] = mine(i[near], j[near])
        i, j, most = i[near], j[near], most[near]
        near = least_edits([bag[x] for x in i], [bag[x] for x in j]) <= most
        found.append((i[near], j[near]))
    if not found:
        return one[:0], one[:0]
    return tuple(np.concatenate(x) for x in zip(*found))


def blocks(rows: DataFrame, own: DataFrame | None = None) -> DataFrame:
    """``rows`` (key, id, root, words, ...), stored, of the keys with several roots, dealt for the
    comparison of all with all: key, i, j, mine, then the other columns, and those of ``own`` (a
    row per id) if given.

    The rows of a key are dealt to blocks by a hash, of about ``BLOCK`` rows and ``BLOCK_WORDS``
    words at most, and every two blocks (and each with itself) are one group (key, i, j).
    """
    sizes = stored(rows.groupBy("key").agg(F.count("*").alias("n"), F.sum("words").alias("w"), F.min("root").alias("r"), F.max("root").alias("s"))
                   .where("r != s").select("key", F.ceil(F.greatest(F.col("n") / BLOCK, F.col("w") / BLOCK_WORDS)).alias("parts")), "near-sizes")
    mine = F.pmod(F.xxhash64("id"), F.col("parts"))
    held = rows.join(bounded(sizes), "key")
    held = held if own is None else held.join(own, "id")
    return (held.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
            .select("key", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "mine",
                    *[c for c in held.columns if c not in ("key", "parts")]))


def _by_group(dealt: DataFrame, compare) -> DataFrame:
    """The pairs (a, b) that ``compare`` finds in the rows of each group of ``blocks``, wherever it runs."""
    def run(batches):
        carry = []  # rows of a group that may go on in the next batch

        def found(table, upto):
            head = [table.column(c).to_numpy() for c in range(3)]
            new = np.flatnonzero(np.any([h[1:] != h[:-1] for h in head], axis=0)) + 1
            ends = [0, *new.tolist(), len(table)]
            cut = ends[-2] if upto is None else upto
            out = [compare(table.slice(x, y - x)) for x, y in zip(ends[:-1], ends[1:]) if y <= cut]
            a, b = (np.concatenate([o[k] for o in out]) if out else np.zeros(0, np.int64) for k in (0, 1))
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"]), table.slice(cut)

        for batch in batches:
            if len(batch):
                made, rest = found(pa.Table.from_batches([*carry, batch]).combine_chunks(), None)
                carry = rest.to_batches()
                yield made
        if carry:
            table = pa.Table.from_batches(carry).combine_chunks()
            yield found(table, len(table))[0]

    return dealt.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j").mapInArrow(run, "a long, b long")


def crossing(rows: DataFrame, threshold: float) -> DataFrame:
    """(a, b): the pairs of ids of different roots with the same key that lengths and bags allow;
    ``rows`` (key, id, root, words, bag), stored."""
    def compare(part):
        i, j, mine, ids, root, words = (part.column(c).to_numpy() for c in range(1, 7))
        group = ids, root, words, part.column(7).to_pylist()
        one = np.flatnonzero(mine == i)
        x, y = _allowed(group, one, one if i[0] == j[0] else np.flatnonzero(mine == j), threshold)
        return np.minimum(ids[x], ids[y]), np.maximum(ids[x], ids[y])

    return stored(_by_group(blocks(rows), compare).distinct(), "near-crossing")


def linking(rows: DataFrame, nodes: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """(a, b): the links between ids of different roots with the same bucket ``key``; ``rows``
    (key, id, root, words), stored, ``texts`` (id, text).  The pairs are aligned inside the task,
    each in the first of the buckets that both texts are in."""
    # texts join before the rows are dealt: the join makes a row per member, not one per block
    own = texts.join(nodes.select("id", "sketch"), "id")
    dealt = blocks(rows, own).select("key", "i", "j", "mine", "id", "root", "words", "sketch", "text")

    def compare(part):
        key, i, j, mine, ids, root, words = (part.column(c).to_numpy() for c in range(7))
        if (root == root[0]).all():
            return ids[:0], ids[:0]
        lists, text = (part.column(c).combine_chunks() for c in (7, 8))
        sketch = lists.flatten().to_numpy().reshape(len(ids), -1)
        bag = [x for _, _, data, offsets in groups(text) for x in bags(words_of(LOWER[data], offsets, NOT_SPACE))]

        def first_here(x, y):
            out = np.empty(len(x), bool)
            for at in range(0, len(x), 1 << 14):
                p, q = sketch[x[at:at + (1 << 14)]], sketch[y[at:at + (1 << 14)]]
                out[at:at + (1 << 14)] = p[np.arange(len(p)), (p == q).argmax(axis=1)] == key[0]
            return out

        one = np.flatnonzero(mine == i)
        x, y = _allowed((ids, root, words, bag), one, one if i[0] == j[0] else np.flatnonzero(mine == j), threshold, first_here)
        if not len(x):
            return ids[:0], ids[:0]
        need, at = np.unique(np.concatenate([x, y]), return_inverse=True)
        keep = similar_pairs(*_all_words(text.take(pa.array(need))), at[:len(x)], at[len(x):], threshold)
        return np.minimum(ids[x], ids[y])[keep], np.maximum(ids[x], ids[y])[keep]

    return stored(_by_group(dealt, compare), "near-links")


def compared(members: DataFrame, label: DataFrame, nodes: DataFrame, docs: DataFrame, threshold: float) -> DataFrame:
    """The links between different components among all members (bucket, id) of a bucket.

    A bucket of more than ``LARGE`` members is split by the rare words of its
    members' texts, which loses no similar pair.
    """
    held = stored(members.join(label.withColumnRenamed("node", "id"), "id", "left").withColumn("root", F.coalesce("root", "id")), "near-held")
    sizes = stored(held.groupBy("bucket").agg(F.count("*").alias("n"), F.min("root").alias("r"), F.max("root").alias("s"))
                   .where("r != s").select("bucket", "n"), "near-sizes")
    rows = stored(held.join(bounded(sizes), "bucket").join(nodes.select("id", "words"), "id"), "near-open")
    texts = _texts(rows.select("id").distinct(), nodes, docs)
    found = linking(rows.where(F.col("n") <= LARGE).select(F.col("bucket").alias("key"), "id", "root", "words"), nodes, texts, threshold)
    large = rows.where(F.col("n") > LARGE)
    if large.isEmpty():
        return found
    words = stored(rare_words(texts.join(large.select("id").distinct(), "id", "left_semi"), threshold), "near-rare")
    keyed = stored(large.join(words, "id").join(nodes.select("id", "bag"), "id")
                   .select(F.xxhash64("bucket", "word").alias("key"), "id", "root", "words", "bag"), "near-split")
    return found.union(verified(crossing(keyed, threshold), nodes, docs, threshold))


def linked(nodes: DataFrame, docs: DataFrame, threshold: float) -> DataFrame:
    """(node, root): ids in the components of the verified links between different texts;
    ``nodes`` (id, node, doc, sketch, words, bag), ``docs`` (doc, node, text)."""
    members = nodes.select("id", F.explode("sketch").alias("bucket"))
    buckets = stored(members.groupBy("bucket").agg(F.count("*").alias("n"), F.min("id").alias("centre")).where("n > 1").drop("n"), "near-buckets")
    members = stored(members.join(buckets, "bucket"), "near-members")
    pairs = members.where("id != centre").select(F.col("centre").alias("a"), F.col("id").alias("b")).distinct()
    label = components(verified(possible(pairs, nodes, threshold), nodes, docs, threshold))
    # the centre has met all others: what is open is between these
    new = compared(members.where("id != centre").select("bucket", "id"), label, nodes, docs, threshold)
    return label if new.isEmpty() else merged(label, new)


def merged(label: DataFrame, more: DataFrame) -> DataFrame:
    """``label`` (node, root) after further links: only the roots they join are worked on."""
    ends = [label.select(F.col("node").alias(e), F.col("root").alias(f"root_{e}")) for e in ("a", "b")]
    roots = more.join(ends[0], "a", "left").join(ends[1], "b", "left").select(
        F.coalesce("root_a", "a").alias("a"), F.coalesce("root_b", "b").alias("b"))
    moved = components(roots).select(F.col("node").alias("old"), F.col("root").alias("new"))
    known = label.select("node", "root").union(moved.select("old", "old")).distinct()
    return stored(known.join(moved, F.col("root") == F.col("old"), "left").select("node", F.coalesce("new", "root").alias("root")), "near-label")


def _node(text: str) -> Column:
    return F.unhex(F.md5(text))


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = KMER,
            sketches: int = SKETCHES, threshold: float = SIMILARITY) -> DataFrame:
    """(node, root, class_id): the class of every different text; node is the text's
    md5, root a number that its class has in this run, class_id its least doc_id.

    Texts without words have no k-mers and are alike only if equal.  A null text
    is no node.  Repeated rows and equal texts share a node; null doc_ids count
    as the largest.  An empty table gives no rows.
    """
    narrow = docs.select(F.col(doc_id).alias("doc"), _node(text).alias("node"), F.col(text).alias("text")).where("text is not null")

    def factory():
        def work(column):
            rows: list = [[]] * len(column)
            counts, bag = [], []
            for at, end, data, offsets in groups(column):
                words = words_of(LOWER[data], offsets, NOT_SPACE)
                texts, made = order_sketches(words, k, sketches)
                for t, row in zip(texts, made.view(np.int64)):
                    rows[at + t] = row
                counts.extend(words.counts)
                bag.extend(bags(words))
            return [pa.array(rows, pa.list_(pa.int64())), pa.array(counts, pa.int64()), pa.array(bag, pa.binary())]
        return work

    sketched, _ = append_columns(narrow, "text", [("sketch", T.ArrayType(T.LongType())), ("words", T.LongType()), ("bag", T.BinaryType())], factory, keep=["doc", "node"])
    nodes = stored(sketched.groupBy("node").agg(
        F.min("doc").alias("doc"), *[F.first(c).alias(c) for c in ("sketch", "words", "bag")]).withColumn("id", F.monotonically_increasing_id()), "near-nodes")
    label = linked(nodes, narrow, threshold)
    root = nodes.select("id", "node", "doc").join(label.withColumnRenamed("node", "id"), "id", "left").withColumn("root", F.coalesce("root", "id"))
    root = stored(root.drop("id"), "near-roots")
    least = stored(root.groupBy("root").agg(F.min("doc").alias("class_id")), "near-least")
    return stored(root.join(least, "root").select("node", "root", "class_id"), "near-classes")


def label_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row per document: doc_id, class_id, kept (it is the one of its class that stays).
    A document with a null text is a class of its own."""
    label = classes(docs, doc_id, text, **options)
    rows = docs.select(F.col(doc_id).alias("doc_id"), _node(text).alias("node"))
    joined = rows.join(label, "node", "left").withColumn("class_id", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("class_id")))
    return joined.select("doc_id", "class_id", F.col("doc_id").eqNullSafe(F.col("class_id")).alias("kept"))


def deduplicate(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One document of every class, with its columns: the one with the least
    doc_id (of rows that share it, any one; all null texts stay)."""
    label = classes(docs, doc_id, text, **options)
    node, root, class_id = free_names(docs.columns, ["node", "root", "class_id"])
    rows = docs.withColumn(node, _node(text))
    kept = rows.join(label.select(F.col("node").alias(node), F.col("root").alias(root), F.col("class_id").alias(class_id)), node, "left").where(
        F.col(node).isNull() | F.col(doc_id).eqNullSafe(F.col(class_id)))
    # rows that share the least doc_id of their class: of these one stays
    again = free_names([*docs.columns, node, root, class_id], ["again"])[0]
    repeated = docs.where(F.col(text).isNotNull()).groupBy(F.col(doc_id).alias(again)).agg(F.count("*").alias("n")).where("n > 1")
    if repeated.isEmpty():
        return kept.select(*docs.columns)
    repeated = stored(repeated.select(again), "near-repeated")
    same, some = F.col(class_id).eqNullSafe(F.col(again)), kept.where(F.col(node).isNotNull())
    out = kept.where(F.col(node).isNull()).unionByName(some.join(repeated, same, "left_anti")).unionByName(
        some.join(repeated, same, "left_semi").dropDuplicates([root]))
    return out.select(*docs.columns)
