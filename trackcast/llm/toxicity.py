"""Toxic spans by a linear-chain conditional random field over words.

Every word has a state, 0 or 1 (toxic).  The field scores a sequence of states by
weights of hashed features of the words (the word, and its first bytes, so that
unseen forms of a known stem count), and by weights of the transitions.

Labels are of documents, so words are labelled first: a word of a toxic document
is toxic if one of its features stands in toxic documents far more often than in
clean ones (log-odds over the labelled sample, each different text once); all
other words are not.  The field is then fitted to these labels by maximum
likelihood, and its transitions learn how far toxic words stand together.

Forward-backward gives each word's marginal.  Both directions are scans over
2 x 2 matrices in blocks, over all words of a batch at once: a text's first
matrix has equal rows, which resets the scan, so texts of any length cost the
same per word.  A document's score is a logistic function of its marginals'
sum and maximum, learned from texts that the field has not seen; its offending spans are the runs of words at 0.5 or more.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .frames import append_columns
from .quality_rules import labelled
from .text import ALNUM, LOWER, groups, mix, span_hashes, words_of

PER_LABEL = 1000       # labelled documents of a label that are learned from, about
SAMPLE_BYTES = 50_000  # longer texts are scored, but not learned from
BITS = 18              # 2 ** BITS hashed features
STEMS = (4, 5, 6, 8)   # first bytes of a word that are features
CUE_ODDS = 3.0         # log-odds from which on a feature marks a toxic word
CUE_TEXTS = 3          # ... if it stands in so many toxic texts
STEPS = 40
RATE = 0.4
RIDGE = 1e-5
CLEAN = 0.75           # weight of the clean texts in the verdict
SPAN_AT = 0.5
FLAG_AT = 0.7
_BLOCK = 64


def features(words) -> np.ndarray:
    """(words, 1 + len(STEMS)) hashed features of each word."""
    ends = [words.ends, *[np.minimum(words.ends, words.starts + k) for k in STEMS]]
    out = np.empty((len(words.starts), len(ends)), np.int32)
    for j, end in enumerate(ends):
        out[:, j] = mix(span_hashes(words.data, words.starts, end) + np.uint64(j)) >> np.uint64(64 - BITS)
    return out


def _times(p, q):
    """Products of rows of 2 x 2 matrices (as four arrays)."""
    a, b, c, d = p
    e, f, g, h = q
    return a * e + b * g, a * f + b * h, c * e + d * g, c * f + d * h


def _scaled(r):
    """The matrices with a greatest entry of 1."""
    top = np.maximum(np.maximum(r[0], r[1]), np.maximum(r[2], r[3]))
    return tuple(x / top for x in r)


def _scan(m: np.ndarray) -> np.ndarray:
    """(4, n) matrices -> (2, n): the vector (1, 1) times all matrices up to each, scaled."""
    n = m.shape[1]
    blocks = -(-n // _BLOCK)
    padded = np.zeros((4, blocks * _BLOCK))
    padded[0] = padded[3] = 1.0
    padded[:, :n] = m
    padded = np.ascontiguousarray(padded.reshape(4, blocks, _BLOCK).transpose(2, 0, 1))  # a block's k-th matrices together
    run, inside = tuple(padded[0]), np.empty((_BLOCK, 4, blocks))
    inside[0] = run
    for k in range(1, _BLOCK):
        run = _times(run, tuple(padded[k]))
        if k % 4 == 3:  # factors are e ** 80 at most, so that four of them stay finite
            run = _scaled(run)
        inside[k] = run
    u, v = np.empty(blocks), np.empty(blocks)
    x = y = 1.0
    for i, (a, b, c, d) in enumerate(inside[-1].T.tolist()):  # one step a block
        u[i], v[i] = x, y
        x, y = x * a + y * c, x * b + y * d
        top = max(x, y)
        x, y = x / top, y / top
    one, two = u * inside[:, 0] + v * inside[:, 2], u * inside[:, 1] + v * inside[:, 3]
    total = one + two
    return np.stack([(one / total).T.ravel()[:n], (two / total).T.ravel()[:n]])


@dataclass
class Field:
    """``weight`` of features (2 ** BITS), ``bias`` of state 1, ``step`` (2 x 2 transitions,
    from row to column), ``start`` of state 1, and the logistic ``verdict`` (sum, maximum, constant)."""

    weight: np.ndarray
    bias: float = 0.0
    start: float = 0.0
    step: np.ndarray | None = None
    verdict: tuple[float, float, float] = (0.0, 0.0, 0.0)

    def matrices(self, emission: np.ndarray, head: np.ndarray) -> np.ndarray:
        """(4, words): the factor of each word by the state before (row) and its own (column)."""
        e = np.exp(np.clip(emission, -40, 40))
        t = np.exp(np.clip(self.step if self.step is not None else np.zeros((2, 2)), -40, 40))
        m = np.empty((4, len(e)))
        m[0], m[1], m[2], m[3] = t[0, 0], t[0, 1] * e, t[1, 0], t[1, 1] * e
        m[:, head] = 1.0
        m[1, head] = m[3, head] = e[head] * np.exp(np.clip(self.start, -40, 40))
        return m

    def forward_backward(self, emission: np.ndarray, head: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(marginals of state 1, (4, words) marginals of the state pairs that end in each word;
        0 at the words in ``head``, the first of their texts)."""
        if not len(emission):
            return np.zeros(0), np.zeros((4, 0))
        m = self.matrices(emission, head)
        ahead = _scan(m)                                             # by the word's own state
        turned = _scan(np.ascontiguousarray(m[[0, 2, 1, 3], ::-1]))  # transposed, from the end
        behind = np.ones((2, len(emission)))
        behind[:, :-1] = turned[:, ::-1][:, 1:]                      # of all words after this one
        both = ahead * behind
        marginal = both[1] / both.sum(axis=0)
        before = np.empty_like(ahead)
        before[:, 1:], before[:, 0] = ahead[:, :-1], 0.5
        pair = before[[0, 0, 1, 1]] * m * behind[[0, 1, 0, 1]]
        pair /= pair.sum(axis=0)
        pair[:, head] = 0.0
        return marginal, pair

    def word_marginals(self, f: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """The marginal of state 1 of every word, by the words' features and the words of each text."""
        emission = np.full(len(f), self.bias)
        for j in range(f.shape[1]):
            emission += self.weight[f[:, j]]
        return self.forward_backward(emission, _heads(counts))[0]

    def score(self, total: np.ndarray, most: np.ndarray) -> np.ndarray:
        a, b, c = self.verdict
        return 1 / (1 + np.exp(-np.clip(a * np.log1p(total) + b * most + c, -40, 40)))


def _heads(counts: np.ndarray) -> np.ndarray:
    """The first word of every text that has words."""
    first = np.cumsum(counts) - counts
    return first[counts > 0]


def _per_text(marginal: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum and maximum of each text's marginals (0 where it has no words)."""
    text = np.repeat(np.arange(len(counts)), counts)
    total, most = np.bincount(text, marginal, minlength=len(counts)), np.zeros(len(counts))
    np.maximum.at(most, text, marginal)
    return total, most


def word_labels(f: np.ndarray, counts: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """1 for the words of toxic texts with a feature that marks them, else 0."""
    text = np.repeat(np.arange(len(counts)), counts)
    odds = np.full(1 << BITS, -np.inf)
    for j in range(f.shape[1]):
        held = np.unique(text * (1 << BITS) + f[:, j])  # each text counts a feature once
        of, which = held >> BITS, held & ((1 << BITS) - 1)
        bad = np.bincount(which[toxic[of]], minlength=1 << BITS)
        good = np.bincount(which[~toxic[of]], minlength=1 << BITS)
        log = np.log((bad + 0.5) / (toxic.sum() + 1)) - np.log((good + 0.5) / ((~toxic).sum() + 1))
        odds = np.where((bad >= CUE_TEXTS) & (log > odds), log, odds)
    return toxic[text] & (odds[f].max(axis=1) >= CUE_ODDS if len(f) else np.zeros(0, bool))


def _verdict(total: np.ndarray, most: np.ndarray, toxic: np.ndarray, steps: int = 400) -> tuple[float, float, float]:
    """Logistic regression of the label on the marginals' log sum and maximum; the clean texts weigh ``CLEAN`` of all."""
    x = np.stack([np.log1p(total), most, np.ones(len(total))], axis=1)
    y = toxic.astype(float)
    share = np.where(toxic, (1 - CLEAN) / max(1, toxic.sum()), CLEAN / max(1, (~toxic).sum()))
    w = np.zeros(3)
    for _ in range(steps):  # Newton steps with a ridge, so that separable labels stay finite
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (share * (p - y)) + 1e-4 * w
        h = (x * (share * p * (1 - p))[:, None]).T @ x + 1e-4 * np.eye(3)
        move = np.linalg.solve(h, g)
        w = w - np.clip(move, -1, 1)
        if np.abs(move).max() < 1e-6:
            break
    return tuple(w)


def fit_weights(f: np.ndarray, counts: np.ndarray, toxic: np.ndarray, steps: int = STEPS, rate: float = RATE, ridge: float = RIDGE) -> Field:
    """Maximum likelihood of the word labels by full-batch Adam; emissions and gradients go by different words."""
    field = Field(np.zeros(1 << BITS), step=np.zeros((2, 2)))
    y = word_labels(f, counts, toxic)
    head = _heads(counts)
    kind = np.zeros(len(f), np.uint64)
    for j in range(f.shape[1]):
        kind = mix(kind + f[:, j].astype(np.uint64))
    _, first, word = np.unique(kind, return_index=True, return_inverse=True)
    kinds = f[first]
    used = np.flatnonzero(np.bincount(kinds.ravel(), minlength=1 << BITS))
    place = np.zeros(1 << BITS, np.int32)
    place[used] = np.arange(len(used))
    column = np.ascontiguousarray(place[kinds].T)
    n_words, k = max(1, len(f)), len(used)
    inner = np.ones(len(f), dtype=bool)
    inner[head] = False
    at = np.flatnonzero(inner)
    seen_pairs = np.bincount(2 * y[at - 1].astype(int) + y[at].astype(int), minlength=4)
    theta = np.zeros(k + 6)  # features, bias, start, transitions
    theta[k] = -2.0
    m, v = np.zeros(k + 6), np.zeros(k + 6)
    for t in range(1, steps + 1):
        field.bias, field.start, field.step = theta[k], theta[k + 1], theta[k + 2:].reshape(2, 2)
        emission = (field.bias + theta[column].sum(axis=0))[word]
        marginal, pair = field.forward_backward(emission, head)
        pull = marginal - y
        of_kind = np.bincount(word, pull, minlength=len(kinds)) / n_words
        g = ridge * theta
        for c in column:
            g[:k] += np.bincount(c, of_kind, minlength=k)
        g[k] += of_kind.sum()
        g[k + 1] += pull[head].sum() / n_words
        g[k + 2:] += (pair.sum(axis=1) - seen_pairs) / n_words
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        theta = theta - rate * np.sqrt(1 - 0.99 ** t) / (1 - 0.9 ** t) * m / (np.sqrt(v) + 1e-8)
    field.weight[used] = theta[:k]
    field.bias, field.start, field.step = theta[k], theta[k + 1], theta[k + 2:].reshape(2, 2)
    return field


def fit(f: np.ndarray, counts: np.ndarray, toxic: np.ndarray, **options) -> Field:
    """The field of labelled texts: ``f`` (words, features), words of each text, their labels.

    The weights come from all texts.  The verdict comes from every third, seen by
    a field that has learned from the others only, so that words which are common to
    a few toxic texts by chance do not pass for evidence.  With texts of one
    label only, the score is that label's rate, drawn to a half by two texts.
    """
    if not toxic.any() or toxic.all():
        rate_seen = (toxic.sum() + 1) / (len(toxic) + 2)
        return Field(np.zeros(1 << BITS), step=np.zeros((2, 2)), verdict=(0.0, 0.0, float(np.log(rate_seen / (1 - rate_seen)))))
    order = np.argsort(toxic, kind="stable")  # every third of either label
    apart = np.zeros(len(toxic), dtype=bool)
    apart[order[::3]] = True
    field = fit_weights(f, counts, toxic, **options)
    if toxic[apart].all() or not toxic[apart].any() or not toxic[~apart].any():
        apart[:], judge = True, field
    else:
        judge = fit_weights(f[np.repeat(~apart, counts)], counts[~apart], toxic[~apart], **options)
    total, most = _per_text(judge.word_marginals(f[np.repeat(apart, counts)], counts[apart]), counts[apart])
    field.verdict = _verdict(total, most, toxic[apart])
    return field


def train(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL, doc_id: str = "doc_id", text: str = "text") -> Field:
    """Fit on ``labels`` (doc_id, toxic 0 or 1); a document with both labels counts as toxic.

    The driver holds a bounded sample: about ``per_label`` documents of each label,
    of ``SAMPLE_BYTES`` bytes at most, 20 bytes a word; equal texts count once.
    """
    def work(column):
        rows = []
        for _, _, data, offsets in groups(column):
            words = words_of(LOWER[data], offsets, ALNUM)
            f = features(words)
            rows.extend(f[a:b].tobytes() for a, b in zip(words.first[:-1], words.first[1:]))
        return [pa.array(rows, pa.binary())]

    sample = labelled(docs, labels, (1 - F.col("toxic")).cast("int"), per_label, doc_id, text).where(F.octet_length("text") <= SAMPLE_BYTES)
    got, _ = append_columns(sample, "text", [("f", T.BinaryType())], lambda: work, keep=["grade"])
    seen = sorted({(bytes(r["f"]), r["grade"]) for r in got.limit(4 * per_label).toLocalIterator()})
    width = 1 + len(STEMS)
    counts = np.array([len(f) // (4 * width) for f, _ in seen], dtype=np.int64)
    toxic = np.array([g == 0 for _, g in seen], dtype=bool)
    return fit(np.frombuffer(b"".join(f for f, _ in seen), np.int32).reshape(-1, width), counts, toxic)


def _spans(marginal: np.ndarray, words, at: float) -> list[list[dict]]:
    """Of each text the runs of words at ``at`` or more: start and end in characters, greatest marginal."""
    out: list = [[] for _ in words.counts]
    hit = np.flatnonzero(marginal >= at)
    if not len(hit):
        return out
    letters = np.concatenate([[0], np.cumsum((words.data & 0xC0) != 0x80)])  # characters before each byte
    cut = np.append(True, (np.diff(hit) > 1) | (words.text[hit[1:]] != words.text[hit[:-1]]))
    begin = np.flatnonzero(cut)
    for a, b in zip(begin, np.append(begin[1:], len(hit))):
        first, last, text = hit[a], hit[b - 1], words.text[hit[a]]
        zero = letters[words.offsets[text]]
        out[text].append({"start": int(letters[words.starts[first]] - zero), "end": int(letters[words.ends[last]] - zero),
                          "prob": float(marginal[first:last + 1].max())})
    return out


_SPAN = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("prob", T.DoubleType())])


def tag(docs: DataFrame, field: Field, text: str = "text", span_at: float = SPAN_AT, flag_at: float = FLAG_AT,
        keep: list[str] | None = None, spans: bool = True) -> tuple[DataFrame, list[str]]:
    """``docs`` with score, predicted (score at ``flag_at`` or more) and, if wanted, spans (start and end in
    characters of the text, prob), and the names these got.

    Null and empty texts, and those without a letter or digit, have no spans and
    the score of no toxic word.  Repeated rows are judged alike; an empty table
    stays empty.  Texts are read whole; a group of about 1 MB is worked on at a time.
    """
    # plain values (2 ** BITS numbers), so that reading them needs no copy of this package
    held = docs.sparkSession.sparkContext.broadcast((field.weight, field.bias, field.start, field.step, field.verdict))

    def factory():
        field = Field(*held.value)

        def work(column):
            scores, found = np.zeros(len(column)), []
            for at, end, data, offsets in groups(column):
                words = words_of(LOWER[data], offsets, ALNUM)
                marginal = field.word_marginals(features(words), words.counts)
                scores[at:end] = field.score(*_per_text(marginal, words.counts))
                if spans:
                    found.extend(_spans(marginal, words, span_at))
            flags = pa.array((scores >= flag_at).astype(np.int32))
            return [pa.array(scores), flags, *([pa.array(found, pa.list_(pa.struct(
                [("start", pa.int32()), ("end", pa.int32()), ("prob", pa.float64())])))] if spans else [])]
        return work

    fields = [("score", T.DoubleType()), ("predicted", T.IntegerType()), *([("spans", T.ArrayType(_SPAN))] if spans else [])]
    return append_columns(docs, text, fields, factory, keep)


def held_out(doc_id: Column) -> Column:
    """Of the query's documents those whose labels are not learned from (a null id is not held out)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: the columns of query ``op13_toxicity``."""
    narrow = docs.select("doc_id", "text")
    field = train(narrow, labels.where(~held_out(F.col("doc_id"))))
    out, (score, predicted) = tag(narrow, field, keep=["doc_id"], spans=False)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col(score).alias("score"), F.col(predicted).alias("predicted"))


