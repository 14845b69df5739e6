"""Quality classifier: ordinal cumulative-link regression on graded ratings.

One weight vector over hashed text features gives a score; ordered thresholds
cut the score into grades: ``P(grade >= k) = sigmoid(score - threshold[k])``.
All thresholds share the weights, so every rating teaches the one direction from
bad to good.  The expected grade ranks documents, and a tail probability selects
them.

The grades of the ``labels`` table: 0 for poor quality, 1 for sound but toxic
text, 2 for sound and clean text.  The model is fitted on a bounded sample
(about ``PER_GRADE`` documents of a grade); scoring is one map over all texts.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cmp_to_key

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .frames import append_columns
from .quality_rules import labelled
from .text import ALNUM, LOWER, groups, mix, span_hashes, words_of

PER_GRADE = 2000    # labelled documents of a grade that are learned from, about
BITS = 18           # 2 ** BITS hashed features
STEPS = 150
RATE = 0.3
RIDGE = 1e-4
SELECT = 2          # the least grade that is selected ...
KEEP_AT = 0.5       # ... at this probability or more
_PART = 1 << 19     # entries of the sparse sample that are worked on together

_PUNCT, _UPPER = np.zeros(256, dtype=bool), np.zeros(256, dtype=bool)
_PUNCT[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = True
_UPPER[0x41:0x5B] = True


def grade_of(quality: Column, toxic: Column) -> Column:
    """0: poor; 1: sound but toxic; 2: sound and clean (an unknown toxic counts as clean)."""
    return F.when(quality == 0, 0).when((quality == 1) & F.coalesce(toxic == 1, F.lit(False)), 1).when(quality == 1, 2)


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, feature) of every token of a group of texts: words, their first four
    and six bytes, runs of punctuation, words in capitals, and repeats of the word before."""
    words = words_of(LOWER[data], offsets, ALNUM)
    marks = words_of(data, offsets, _PUNCT)
    h = words.hashes()
    capital = _UPPER[data[words.starts]] & (words.ends - words.starts > 1)
    capital &= _UPPER[data[np.minimum(words.starts + 1, max(0, len(data) - 1))]] if len(data) else capital
    same = np.zeros(len(h), dtype=bool)
    same[1:] = (h[1:] == h[:-1]) & (words.text[1:] == words.text[:-1])
    found = [(words.text, h), (marks.text, marks.hashes()),
             (words.text[capital], np.full(int(capital.sum()), 12345, np.uint64)),
             (words.text[same], np.full(int(same.sum()), 777, np.uint64))]
    for k in (4, 6):
        found.append((words.text, span_hashes(words.data, words.starts, np.minimum(words.ends, words.starts + k)) + np.uint64(k)))
    text, value = (np.concatenate(x) for x in zip(*found))
    return text, (mix(value) >> np.uint64(64 - BITS)).astype(np.int64)


@dataclass
class Model:
    weight: np.ndarray      # (2 ** BITS,)
    threshold: np.ndarray   # ascending, one less than the grades

    def score(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scores of a group of texts, and their numbers of tokens."""
        n = len(offsets) - 1
        text, feature = tokens(data, offsets)
        size = np.bincount(text, minlength=n)
        return np.bincount(text, self.weight[feature], minlength=n) / np.sqrt(np.maximum(size, 1)), size

    def tails(self, score: np.ndarray) -> np.ndarray:
        """(texts, thresholds): the probability of each grade from 1 on, or a better one."""
        return 1 / (1 + np.exp(-np.clip(score[:, None] - self.threshold[None], -40, 40)))


def fit(rows: np.ndarray, features: np.ndarray, counts: np.ndarray, grade: np.ndarray, steps: int = STEPS,
        rate: float = RATE, ridge: float = RIDGE) -> Model:
    """Maximum likelihood by full-batch Adam over sparse (row, feature, count); grades weigh alike."""
    n, levels = len(grade), int(grade.max()) + 1 if len(grade) else 1
    weight = np.zeros(1 << BITS)
    if levels < 2 or len(np.unique(grade)) < 2:  # nothing to tell apart: all is of the one grade seen
        seen = int(grade[0]) if n else 0
        return Model(weight, np.where(np.arange(max(SELECT, levels - 1)) < seen, -4.0, 4.0))
    ends = np.append(np.arange(0, len(rows), _PART), len(rows))
    parts = list(zip(ends[:-1], ends[1:]))  # bounds the temporary arrays
    present, size = np.zeros(1 << BITS, dtype=bool), np.zeros(n)
    for a, b in parts:
        present[features[a:b]] = True
        size += np.bincount(rows[a:b], counts[a:b], minlength=n)
    used = np.flatnonzero(present)
    place = np.zeros(1 << BITS, np.int32)
    place[used] = np.arange(len(used))
    column, x, root = place[features], np.empty(len(rows), np.float32), np.sqrt(size, dtype=np.float32)
    for a, b in parts:
        x[a:b] = counts[a:b].astype(np.float32) / root[rows[a:b]]
    k = levels - 1
    w, cut = np.zeros(len(used)), np.linspace(-2, -1, k) if k > 1 else np.array([-1.0])
    seen = np.bincount(grade, minlength=levels)
    share = 1 / (seen[grade] * (seen > 0).sum())
    m, v = np.zeros(len(used) + k), np.zeros(len(used) + k)
    one = np.eye(levels + 1)
    above, below = one[grade][:, :levels], one[grade + 1][:, :levels]  # cumulative probabilities on either side of the grade
    for t in range(1, steps + 1):
        score = np.zeros(n)
        for a, b in parts:
            score += np.bincount(rows[a:b], x[a:b] * w[column[a:b]], minlength=n)
        tail = 1 / (1 + np.exp(-np.clip(score[:, None] - cut[None], -30, 30)))
        slope = np.hstack([np.zeros((n, 1)), tail * (1 - tail)])          # of P(grade >= j), j = 0 .. k
        tail = np.hstack([np.ones((n, 1)), tail])
        p = np.maximum((tail * above).sum(axis=1) - (tail * below).sum(axis=1), 1e-9)
        pull = (slope * (above - below)) * (share / p)[:, None]             # d log p / d score, by threshold
        gw, total = ridge * w, pull.sum(axis=1)
        for a, b in parts:
            gw -= np.bincount(column[a:b], x[a:b] * total[rows[a:b]], minlength=len(used))
        g = np.concatenate([gw, pull[:, 1:].sum(axis=0)])
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        step = rate * np.sqrt(1 - 0.99 ** t) / (1 - 0.9 ** t) * m / (np.sqrt(v) + 1e-8)
        w, cut = w - step[:len(used)], np.sort(cut - step[len(used):])
    weight[used] = w
    return Model(weight, cut)


def _sparse(column: pa.Array) -> list[pa.Array]:
    feature, count = [], []
    for _, _, data, offsets in groups(column):
        text, value = tokens(data, offsets)
        key, n = np.unique(text * (1 << BITS) + value, return_counts=True)
        at = np.searchsorted(key >> BITS, np.arange(len(offsets)))
        for a, b in zip(at[:-1], at[1:]):
            feature.append((key[a:b] & ((1 << BITS) - 1)).astype(np.int32).tobytes())
            count.append(n[a:b].astype(np.int32).tobytes())
    return [pa.array(feature, pa.binary()), pa.array(count, pa.binary())]


def gathered(rows) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Features and counts of the rows (grade, f, n), one after the other, and the number of
    entries and the grade of each row; in one order, whatever order they come in.  The numbers lie in
    two growing buffers, so that the driver keeps no object per row and gives the memory back."""
    feature, count, grade, ends = bytearray(), bytearray(), [], [0]
    for r in rows:
        feature += r["f"]
        count += r["n"]
        grade.append(r["grade"])
        ends.append(len(feature))

    def key(i: int):
        return grade[i], feature[ends[i]:ends[i + 1]], count[ends[i]:ends[i + 1]]

    def least_first(i: int, j: int) -> int:
        a, b = key(i), key(j)
        return (a > b) - (a < b)

    order = np.array(sorted(range(len(grade)), key=cmp_to_key(least_first)), dtype=int)
    begin, end = np.array(ends[:-1], dtype=int) // 4, np.array(ends[1:], dtype=int) // 4

    def sorted_rows(held: bytearray) -> np.ndarray:
        numbers = np.frombuffer(held, np.int32)
        return np.concatenate([np.zeros(0, np.int32), *(numbers[i:j] for i, j in zip(begin[order], end[order]))])

    one = sorted_rows(feature)
    feature.clear()
    two = sorted_rows(count)
    return one, two, (end - begin)[order], np.array(grade, dtype=int)[order]


def train(docs: DataFrame, ratings: DataFrame, grade: Column, per_grade: int = PER_GRADE, doc_id: str = "doc_id", text: str = "text") -> Model:
    """Fit on ``ratings`` (doc_id and what ``grade`` takes); of several grades of a document the lowest counts."""
    sample = labelled(docs, ratings, grade, per_grade, doc_id, text)
    rows, _ = append_columns(sample, "text", [("f", T.BinaryType()), ("n", T.BinaryType())], lambda: _sparse, keep=["grade"])
    feature, count, size, grade_seen = gathered(rows.limit(8 * per_grade).toLocalIterator())
    return fit(np.repeat(np.arange(len(size), dtype=np.int32), size), feature, count, grade_seen)


def classify(docs: DataFrame, model: Model, text: str = "text", select: int = SELECT, keep_at: float = KEEP_AT,
             keep: list[str] | None = None) -> tuple[DataFrame, list[str]]:
    """``docs`` with expected_grade, tail_prob (of grade ``select`` or better) and
    kept, and the names these got.

    A null text, or one without a word or mark, is of grade 0 and not kept.
    Repeated rows are judged alike; an empty table stays empty.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)  # 2 ** BITS numbers

    def factory():
        model = held.value

        def work(column):
            expected, tail = np.zeros(len(column)), np.zeros(len(column))
            for at, end, data, offsets in groups(column):
                score, size = model.score(data, offsets)
                tails = model.tails(score) * (size > 0)[:, None]
                expected[at:end] = tails.sum(axis=1)
                tail[at:end] = tails[:, select - 1] if select <= tails.shape[1] else 0
            return [pa.array(expected), pa.array(tail), pa.array(tail >= keep_at)]
        return work

    return append_columns(docs, text, [("expected_grade", T.DoubleType()), ("tail_prob", T.DoubleType()),
                                       ("kept", T.BooleanType())], factory, keep)


def rated(docs: DataFrame, labels: DataFrame) -> Model:
    return train(docs, labels, grade_of(F.col("quality"), F.col("toxic")))


def select_documents(docs: DataFrame, model: Model, **options) -> DataFrame:
    """The documents that the classifier keeps, with their own columns."""
    out, names = classify(docs, model, **options)
    return out.where(F.col(names[2])).select(*docs.columns)


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, expected_grade, tail_prob, kept."""
    out, names = classify(docs.select("doc_id", "text"), rated(docs.select("doc_id", "text"), labels), keep=["doc_id"])
    return out.select("doc_id", *[F.col(a).alias(b) for a, b in zip(names, ("expected_grade", "tail_prob", "kept"))])
