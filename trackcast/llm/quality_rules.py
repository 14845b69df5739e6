"""Quality rules: gradient-boosted trees over document statistics.

Statistics of whole texts are computed in one map (see ``statistics``).  A fixed
base rule rejects short and repetitive texts; the trees judge the rest.  They
are fitted on a bounded labelled sample, with monotonic constraints: more
symbols, repeated lines or repeated words never raise the score.  The trees are
flattened into node arrays, so a batch is scored level by level with numpy.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .frames import append_columns
from .text import LOWER, NOT_SPACE, Words, groups, shingles, span_hashes, words_of

PER_LABEL = 4000     # labelled texts of a label that are learned from, about
TREES = 60
DEPTH = 3
RATE = 0.2
BINS = 64
LEAST_WORDS = 50     # the base rule
REPEAT_PERCENT = 50
KEEP_AT = 0.5

SYMBOL = np.zeros(256, dtype=bool)
SYMBOL[list(b"#*$%&|<>")] = True
_UPPER, _DIGIT, _PUNCT = (np.zeros(256, dtype=bool) for _ in range(3))
_UPPER[0x41:0x5B], _DIGIT[0x30:0x3A] = True, True
_PUNCT[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = True

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: name and direction: -1 if a higher value may never raise the score, 0 if free
FEATURES = [("log_words", 0), ("word_length", 0), ("symbol_share", -1), ("dup_line_share", -1), ("repeat_share", -1),
            ("upper_share", 0), ("digit_share", 0), ("punct_share", 0), ("line_words", 0), ("distinct_share", 0), ("bang_share", -1)]
_BANG = np.zeros(256, dtype=bool)
_BANG[ord("!")] = True


def _per_text(data: np.ndarray, offsets: np.ndarray, mask: np.ndarray) -> np.ndarray:
    total = np.zeros(len(data) + 1, np.int64)
    np.cumsum(mask, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def _repeats(value: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(in order of text and value: the order, whether a value is the same as the one before it)."""
    order = np.lexsort((value, text))
    same = np.zeros(len(value), dtype=bool)
    same[1:] = (value[order][1:] == value[order][:-1]) & (text[order][1:] == text[order][:-1])
    return order, same


def statistics(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of a group of texts: the five ``COUNTS`` and the ``FEATURES``, a row per text."""
    n = len(offsets) - 1
    words: Words = words_of(data, offsets, NOT_SPACE)
    n_words = words.counts
    chars = _per_text(data, offsets, NOT_SPACE[data] & ((data & 0xC0) != 0x80))
    symbols = _per_text(data, offsets, SYMBOL[data])

    hashes = words.hashes()
    value, at = shingles(hashes, words.first, 3)
    order, same = _repeats(value, words.text[at])
    twice = np.zeros(len(at), dtype=bool)
    again = np.flatnonzero(same)
    twice[order[again]] = twice[order[again - 1]] = True
    inside = np.zeros(len(hashes), dtype=bool)
    for j in range(3):
        inside[at[twice] + j] = True
    repeat_words = np.bincount(words.text[inside], minlength=n)

    breaks = np.ones(256, dtype=bool)
    breaks[0x0A] = False
    lines = words_of(data, offsets, breaks)
    # a line with a word: some word starts at or after its start, before its end
    has = np.searchsorted(words.starts, lines.starts) < np.searchsorted(words.starts, lines.ends)
    starts, ends, text = lines.starts[has], lines.ends[has], lines.text[has]
    _, same = _repeats(span_hashes(data, starts, ends), text)
    text_sorted = np.sort(text, kind="stable")
    dup_lines = np.bincount(text_sorted[same], minlength=n)
    n_lines = np.bincount(text, minlength=n)

    lower = words_of(LOWER[data], offsets, NOT_SPACE).hashes()
    order, same = _repeats(lower, words.text)
    distinct = n_words - np.bincount(words.text[order][same], minlength=n)
    counts = np.stack([n_words, chars, symbols, dup_lines, repeat_words], axis=1).astype(np.int64)
    w, c, ln = np.maximum(n_words, 1), np.maximum(chars, 1), np.maximum(n_lines, 1)
    shares = [np.log1p(n_words), chars / w, symbols / c, dup_lines / ln, repeat_words / w,
              _per_text(data, offsets, _UPPER[data]) / c, _per_text(data, offsets, _DIGIT[data]) / c,
              _per_text(data, offsets, _PUNCT[data]) / c, n_words / ln, distinct / w, _per_text(data, offsets, _BANG[data]) / c]
    return counts, np.stack(shares, axis=1).astype(np.float64)


@dataclass
class Trees:
    """Flattened trees: children of node i are at left[i] and right[i]; leaves point to themselves."""

    base: float = 0.0
    roots: list[int] = field(default_factory=list)
    feature: list[int] = field(default_factory=list)
    cut: list[float] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)

    def add(self) -> int:
        node = len(self.feature)
        for column, v in ((self.feature, 0), (self.cut, np.inf), (self.left, node), (self.right, node), (self.value, 0.0)):
            column.append(v)
        return node

    def score(self, x: np.ndarray, depth: int = DEPTH) -> np.ndarray:
        feature, cut = np.array(self.feature, np.int64), np.array(self.cut)
        left, right, value = np.array(self.left, np.int64), np.array(self.right, np.int64), np.array(self.value)
        rows, total = np.arange(len(x)), np.full(len(x), self.base)
        for root in self.roots:
            at = np.full(len(x), root)
            for _ in range(depth):
                at = np.where(x[rows, feature[at]] <= cut[at], left[at], right[at])
            total += value[at]
        return 1 / (1 + np.exp(-total))


def fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray, direction: list[int], trees: int = TREES,
        depth: int = DEPTH, rate: float = RATE, bins: int = BINS, ridge: float = 1.0) -> Trees:
    """Newton boosting of the logistic loss over binned features.

    A split on a constrained feature must order the values of its sides, and
    every node below keeps to the bounds that the splits above it set."""
    model = Trees()
    if not len(y) or y.min() == y.max():
        model.base = 4.0 if not len(y) or y[0] == 1 else -4.0
        return model
    share = np.average(y, weights=weight)
    model.base = float(np.log(share / (1 - share)))
    edges = [np.unique(np.quantile(x[:, f], np.arange(1, bins) / bins, method="lower")) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(edges[f], x[:, f]) for f in range(x.shape[1])], axis=1)  # bin <= i: x <= edges[i]
    total = np.full(len(y), model.base)

    def leaf(g: float, h: float, low: float, high: float) -> float:
        return float(np.clip(-g / (h + ridge), low, high))

    def grow(rows: np.ndarray, level: int, low: float, high: float) -> int:
        node = model.add()
        g, h = grad[rows], hess[rows]
        gs, hs = g.sum(), h.sum()
        model.value[node] = rate * leaf(gs, hs, low, high)
        step[rows] = model.value[node]
        best, chosen = 1e-3, None
        if level < depth:
            for f in range(x.shape[1]):
                n = len(edges[f])
                if n == 0:
                    continue
                gl = np.cumsum(np.bincount(binned[rows, f], g, n + 1))[:-1]
                hl = np.cumsum(np.bincount(binned[rows, f], h, n + 1))[:-1]
                vl = np.clip(-gl / (hl + ridge), low, high)
                vr = np.clip(-(gs - gl) / (hs - hl + ridge), low, high)
                loss = lambda v, a, b: -(a * v + 0.5 * (b + ridge) * v * v)
                gain = loss(vl, gl, hl) + loss(vr, gs - gl, hs - hl) - loss(leaf(gs, hs, low, high), gs, hs)
                gain[(hl < 1) | (hs - hl < 1)] = -np.inf
                if direction[f]:
                    gain[direction[f] * (vr - vl) < 0] = -np.inf
                i = int(gain.argmax())
                if gain[i] > best:
                    best, chosen = gain[i], (f, i, vl[i], vr[i])
        if chosen is not None:
            f, i, vl, vr = chosen
            model.feature[node], model.cut[node] = f, float(edges[f][i])
            middle = (vl + vr) / 2
            go_left = binned[rows, f] <= i
            bounds = {0: ((low, high), (low, high)), -1: ((middle, high), (low, middle)), 1: ((low, middle), (middle, high))}[direction[f]]
            model.left[node] = grow(rows[go_left], level + 1, *bounds[0])
            model.right[node] = grow(rows[~go_left], level + 1, *bounds[1])
        return node

    for _ in range(trees):
        p = 1 / (1 + np.exp(-total))
        grad, hess, step = (p - y) * weight, np.maximum(p * (1 - p), 1e-6) * weight, np.zeros(len(y))
        model.roots.append(grow(np.arange(len(y)), 0, -np.inf, np.inf))
        total += step
    return model


def base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < LEAST_WORDS) | (n_repeat_words * 100 > n_words * REPEAT_PERCENT)


def labelled(docs: DataFrame, labels: DataFrame, grade: Column, per_grade: int, doc_id: str, text: str) -> DataFrame:
    """(grade, text) of a bounded sample: of each grade about ``per_grade`` labelled documents, chosen by a hash of the id."""
    graded = labels.select(F.col("doc_id").alias("id"), grade.alias("grade")).dropna().groupBy("id").agg(F.min("grade").alias("grade"))
    count = {r[0]: r[1] for r in graded.groupBy("grade").count().collect()}
    if not count:
        return docs.select(F.lit(0).alias("grade"), F.col(text).alias("text")).limit(0)
    chance = F.element_at(F.create_map(*[F.lit(v) for k, n in count.items() for v in (k, min(1.0, per_grade / n))]), F.col("grade"))
    drawn = graded.where(F.shiftrightunsigned(F.xxhash64("id", F.lit(9)), 11) / F.lit(float(1 << 53)) < chance)
    drawn = drawn.limit(2 * per_grade * len(count))
    return (docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).where("text is not null")
            .join(F.broadcast(drawn), "id").select("grade", "text"))  # the sample's size is bounded by parameter


def train(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL, doc_id: str = "doc_id", text: str = "text") -> Trees:
    """Fit the trees on ``labels`` (doc_id, quality 0 or 1); a document with both labels counts as 0."""
    def work(column):
        rows: list = []
        for _, _, data, offsets in groups(column):
            rows.extend(statistics(data, offsets)[1].tolist())
        return [pa.array(rows, pa.list_(pa.float64()))]

    sample = labelled(docs, labels, F.col("quality"), per_label, doc_id, text)
    got, _ = append_columns(sample, "text", [("x", T.ArrayType(T.DoubleType()))], lambda: work, keep=["grade"])
    rows = got.limit(4 * per_label).collect()
    x = np.array([r["x"] for r in rows], dtype=float).reshape(-1, len(FEATURES))
    y = np.array([r["grade"] for r in rows], dtype=float)
    n = np.bincount(y.astype(int), minlength=2)
    order = np.lexsort((*x.T, y))  # rows come in any order; the model shall not depend on it
    x, y = x[order], y[order]
    weight = np.where(y == 1, len(y) / (2 * max(1, n[1])), len(y) / (2 * max(1, n[0])))
    return fit(x, y, weight, [d for _, d in FEATURES])


def judge(docs: DataFrame, model: Trees, text: str = "text", keep: list[str] | None = None) -> tuple[DataFrame, list[str]]:
    """``docs`` with the five counts, rule_score, base_failed and kept, and the names these got.

    A null or empty text has no words and fails the base rule.  Repeated rows
    are judged alike; an empty table stays empty.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)

    def factory():
        model = held.value

        def work(column):
            counts, score = np.zeros((len(column), len(COUNTS)), np.int64), np.zeros(len(column))
            for at, end, data, offsets in groups(column):
                counts[at:end], x = statistics(data, offsets)
                score[at:end] = model.score(x)
            return [*(pa.array(np.ascontiguousarray(c)) for c in counts.T), pa.array(score)]
        return work

    out, names = append_columns(docs, text, [*((c, T.LongType()) for c in COUNTS), ("rule_score", T.DoubleType())], factory, keep)
    failed, kept = "base_failed", "kept"
    while failed in out.columns:
        failed += "_"
    while kept in out.columns:
        kept += "_"
    out = out.withColumn(failed, base_failed(F.col(names[0]), F.col(names[4])))
    return out.withColumn(kept, ~F.col(failed) & (F.col(names[5]) >= KEEP_AT)), [*names, failed, kept]


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: the columns of query ``op9_quality_rules``."""
    out, names = judge(docs.select("doc_id", "text"), train(docs, labels), keep=["doc_id"])
    wanted = [*COUNTS, "rule_score", "base_failed", "kept"]
    return out.select("doc_id", *[F.col(a).alias(b) for a, b in zip(names, wanted)])
