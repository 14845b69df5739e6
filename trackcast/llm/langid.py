"""Language identification with error-correcting output codes.

Every language gets a codeword of bits; for each bit a binary logistic
classifier over hashed byte n-grams predicts whether a text belongs to the
languages whose codeword has that bit set.  Decoding compares the margins of all
bits with every codeword under the logistic loss, each bit weighted for each
language by how well it was learned there, and takes the nearest codeword.  The
distance to the second nearest flags ambiguous texts.

The classifiers are fitted on a bounded sample (about ``PER_LANGUAGE`` texts of a
language); prediction is one map over all texts.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .frames import append_columns
from .text import LOWER, groups

PER_LANGUAGE = 600   # labelled texts of a language that are learned from, about
BUCKETS = 1 << 12    # hashed n-grams
EXHAUSTIVE = 6       # languages up to which all different codes are used
STEPS = 120
AMBIGUOUS = 0.6      # a score below flags the text
UNKNOWN = "und"

_HASH = np.random.default_rng(77).integers(0, BUCKETS, (5, 256)).astype(np.uint16)


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row per text: square roots of the shares of its hashed byte bigrams and
    trigrams (lower-cased, with a space before and behind the text)."""
    out = np.zeros((len(offsets) - 1, BUCKETS), np.float32)
    for i in range(len(out)):
        text = np.full(offsets[i + 1] - offsets[i] + 2, 0x20, np.uint8)
        text[1:-1] = LOWER[data[offsets[i]:offsets[i + 1]]]
        two = _HASH[0][text[:-1]] ^ _HASH[1][text[1:]]
        three = _HASH[2][text[:-2]] ^ _HASH[3][text[1:-1]] ^ _HASH[4][text[2:]]
        n = np.bincount(two, minlength=BUCKETS) + np.bincount(three, minlength=BUCKETS)
        out[i] = np.sqrt(n / n.sum())
    return out


def codewords(n: int, seed: int = 3) -> np.ndarray:
    """(n, bits) of -1 and 1: all different two-way splits for few languages,
    else the best of random codes by the least distance of two codewords."""
    if n <= 1:
        return np.ones((n, 1))
    if n <= EXHAUSTIVE:
        bits = [[1] + [1 if (c >> i) & 1 else -1 for i in range(n - 1)] for c in range((1 << (n - 1)) - 1)]
        return np.array(bits, dtype=float).T
    rng, best, apart = np.random.default_rng(seed), None, -1.0
    for _ in range(200):
        code = rng.choice([-1.0, 1.0], (n, int(np.ceil(10 * np.log2(n)))))
        least = ((code.shape[1] - code @ code.T) / 2 + np.eye(n) * 1e9).min()
        if least > apart and (np.abs(code.sum(axis=0)) < n).all():
            best, apart = code, least
    return best


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray      # (languages, bits)
    weight: np.ndarray    # (languages, bits), rows sum to 1
    matrix: np.ndarray    # (BUCKETS + 1, bits), the last row is the bias

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest codeword, and its share of the soft vote."""
        margin = x @ self.matrix[:-1] + self.matrix[-1]
        loss = np.logaddexp(0, -margin[:, None, :] * self.code[None]) * self.weight[None]
        vote = -loss.sum(axis=2) * 4
        vote = np.exp(vote - vote.max(axis=1, keepdims=True))
        vote /= vote.sum(axis=1, keepdims=True)
        best = vote.argmax(axis=1)
        return best, vote[np.arange(len(best)), best]


def fit(x: np.ndarray, lang: list[str], steps: int = STEPS, decay: float = 1e-5, seed: int = 3) -> Model:
    """Fit all bits together by full-batch Adam; languages weigh alike."""
    languages = sorted(set(lang))
    y = np.array([languages.index(v) for v in lang])
    code = codewords(len(languages), seed)
    target = code[y]
    share = 1 / np.bincount(y)[y] / len(languages)
    w, b = np.zeros((x.shape[1], code.shape[1]), np.float32), np.zeros(code.shape[1])
    mw, vw, mb, vb = np.zeros_like(w), np.zeros_like(w), np.zeros_like(b), np.zeros_like(b)
    for t in range(1, steps + 1):
        margin = x @ w + b
        slope = -target / (1 + np.exp(np.clip(target * margin, -30, 30))) * share[:, None]
        gw, gb = x.T @ slope.astype(np.float32) + decay * w, slope.sum(axis=0)
        mw, vw = 0.9 * mw + 0.1 * gw, 0.99 * vw + 0.01 * gw * gw
        mb, vb = 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
        rate = 0.3 * np.sqrt(1 - 0.99 ** t) / (1 - 0.9 ** t)
        w -= rate * mw / (np.sqrt(vw) + 1e-8)
        b -= rate * mb / (np.sqrt(vb) + 1e-8)
    right = (x @ w + b) * target > 0
    weight = np.stack([right[y == i].mean(axis=0) for i in range(len(languages))]) + 1e-3
    return Model(languages, code, weight / weight.sum(axis=1, keepdims=True), np.vstack([w, b[None]]).astype(np.float32))


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 4, is 2 (a null id counts as an empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def _feature_rows(column: pa.Array) -> list[pa.Array]:
    rows: list = []
    for _, _, data, offsets in groups(column):
        rows.extend(r.tobytes() for r in features(data, offsets).astype(np.float16))
    return [pa.array(rows, pa.binary())]


def train(docs: DataFrame, per_language: int = PER_LANGUAGE, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> Model:
    """Learn from texts that are not held out and have a language: of each
    language about ``per_language``, chosen by a hash of id and language."""
    usable = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull() & ~held_out(F.col(doc_id)))
    count = {r[0]: r[1] for r in usable.groupBy(lang).count().collect()}
    if not count:
        return Model([], np.ones((0, 1)), np.ones((0, 1)), np.zeros((BUCKETS + 1, 1), np.float32))
    chance = F.element_at(F.create_map(*[F.lit(v) for k, n in count.items() for v in (k, min(1.0, per_language / n))]), F.col(lang))
    drawn = usable.where(F.shiftrightunsigned(F.xxhash64(doc_id, lang), 11) / F.lit(float(1 << 53)) < chance)
    rows, _ = append_columns(drawn.select(F.col(lang).alias("lang"), F.col(text).alias("text")), "text",
                             [("x", T.BinaryType())], lambda: _feature_rows, keep=["lang"])
    got = rows.limit(2 * per_language * len(count)).collect()  # repeated rows are drawn together: the bound holds all the same
    x = np.frombuffer(b"".join(bytes(r["x"]) for r in got), np.float16).reshape(-1, BUCKETS).astype(np.float32)
    return fit(x, [r["lang"] for r in got])


def identify(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None,
             ambiguous_below: float = AMBIGUOUS) -> tuple[DataFrame, list[str]]:
    """``docs`` with lang_pred, score (0 to 1) and ambiguous, and the names these got.

    A null text, one without a letter, and any text under a model without
    languages are ``und`` with score 0.  Only the text is looked at, the whole of
    it however long; repeated rows are judged alike, an empty table stays empty.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS x bits numbers

    def factory():
        model = held.value

        def work(column):
            lang, score = [UNKNOWN] * len(column), np.zeros(len(column))
            for at, end, data, offsets in groups(column) if model.languages else ():
                best, score[at:end] = model.predict(features(data, offsets))
                lang[at:end] = [model.languages[i] for i in best]
            return [pa.array(lang, pa.string()), pa.array(score)]
        return work

    letters = "has_letter"
    while letters in docs.columns:
        letters += "_"
    keep = docs.columns if keep is None else keep
    rows = docs.withColumn(letters, F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)))
    out, (lang, score) = append_columns(rows, text, [("lang_pred", T.StringType()), ("score", T.DoubleType())], factory, keep=[*keep, letters])
    known = F.col(letters)
    flag = "ambiguous"
    while flag in out.columns:
        flag += "_"
    out = out.withColumns({lang: F.when(known, F.col(lang)).otherwise(UNKNOWN), score: F.when(known, F.col(score)).otherwise(0.0)})
    out = out.withColumn(flag, (F.col(lang) != UNKNOWN) & (F.col(score) < ambiguous_below)).drop(letters)
    return out, [lang, score, flag]


def digest(docs: DataFrame) -> DataFrame:
    """One row per document: the columns of query ``op2_language_id``."""
    out, (lang, score, flag) = identify(docs.select("doc_id", "text"), train(docs), keep=["doc_id"])
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col(lang).alias("lang_pred"),
                      F.col(score).alias("score"), F.col(flag).alias("ambiguous"))
