"""The conditional random field against plain loops; spans, odd rows, held-out accuracy."""

import itertools
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from trackcast.llm import toxicity as tx
from trackcast.llm.queries import QUERIES
from trackcast.llm.text import ALNUM, LOWER, groups, words_of

DOCS = "doc_id long, text string"


def random_field(seed=0):
    rng = np.random.default_rng(seed)
    return tx.Field(rng.normal(0, 1, 1 << tx.BITS), -1.0, 0.7, rng.normal(0, 1.5, (2, 2)), (1.3, 2.0, -2.5))


def words_in(text):
    ((_, _, data, offsets),) = groups(pa.array([text]), 1 << 30)
    return words_of(LOWER[data], offsets, ALNUM)


def plain_marginals(field, text):
    """Forward-backward over one text in a loop, with logarithms."""
    e = [field.bias + sum(field.weight[j] for j in row) for row in tx.features(words_in(text))]
    def lse(x, y):
        return max(x, y) + math.log1p(math.exp(-abs(x - y)))
    ahead, behind = [], []
    for i, x in enumerate(e):
        ahead.append([0.0, x + field.start] if i == 0 else [
            lse(ahead[-1][0] + field.step[0][b], ahead[-1][1] + field.step[1][b]) + (x if b else 0.0) for b in (0, 1)])
    for i in range(len(e) - 1, -1, -1):
        behind.append([0.0, 0.0] if i == len(e) - 1 else [
            lse(field.step[a][0] + behind[-1][0], field.step[a][1] + e[i + 1] + behind[-1][1]) for a in (0, 1)])
    behind.reverse()
    return [1 / (1 + math.exp(a[0] + b[0] - a[1] - b[1])) for a, b in zip(ahead, behind)]


def plain_score(field, text):
    p = plain_marginals(field, text or "")
    a, b, c = field.verdict
    return 1 / (1 + math.exp(-(a * math.log1p(sum(p)) + b * max(p, default=0.0) + c)))


def test_marginals_match_all_state_sequences():
    field, rng = random_field(3), np.random.default_rng(1)
    counts = np.array([4, 0, 1, 6])
    emission = rng.normal(0, 2, counts.sum())
    marginal, pair = field.forward_backward(emission, tx._heads(counts))
    at = 0
    for n in counts:
        e, weight = emission[at:at + n], {}
        for states in itertools.product((0, 1), repeat=int(n)):
            s = sum(e[i] for i in range(n) if states[i]) + (field.start if n and states[0] else 0)
            weight[states] = math.exp(s + sum(field.step[a][b] for a, b in zip(states, states[1:])))
        total = sum(weight.values())
        for i in range(n):
            assert marginal[at + i] == pytest.approx(sum(w for s, w in weight.items() if s[i]) / total)
            for k, (a, b) in enumerate(itertools.product((0, 1), repeat=2)):
                want = sum(w for s, w in weight.items() if s[i - 1:i + 1] == (a, b)) / total if i else 0
                assert pair[k, at + i] == pytest.approx(want)
        at += n


def test_scores_and_spans_match_plain_loops(spark):
    field, rng = random_field(), random.Random(2)
    texts = [None, "", " \n ", "...", "Ünder é1 WORD word", "a"] + [
        "  ".join(rng.choice(["Ärger", "b,c", "nice", "x" * 30, "日本", "ok"]) + str(rng.randrange(9)) for _ in range(n)) for n in (3, 63, 64, 65, 400, 3000)]
    df = spark.createDataFrame(list(enumerate(texts)) + [(99, texts[-2])] * 3, DOCS).withColumns({"score": F.lit("mine"), "SPANS": F.lit(1)})
    out, names = tx.tag(df, field)
    assert out.columns[:4] == ["doc_id", "text", "score", "SPANS"] and names == ["score_", "predicted", "spans_"]
    for r in out.collect():
        assert r["score_"] == pytest.approx(plain_score(field, r.text), abs=1e-9) and r.predicted == int(r["score_"] >= 0.7)
        found = list(re.finditer(r"[0-9A-Za-z\x80-\U0010ffff]+", r.text or ""))
        hit = [p >= 0.5 for p in plain_marginals(field, r.text or "")]
        want, i = [], 0
        while i < len(hit):
            j = i
            while j < len(hit) and hit[j]:
                j += 1
            if j > i:
                want.append((found[i].start(), found[j - 1].end()))
            i = max(j, i + 1)
        assert [(s.start, s.end) for s in r["spans_"]] == want


def test_long_text_is_linear_and_extreme_weights_stay_finite():
    field = random_field()
    field.step = np.array([[40.0, -40.0], [-40.0, 40.0]])
    marginal, _ = field.forward_backward(np.tile([40.0, -40.0, 3.0], 300_000), np.array([0, 7, 500_000]))
    assert np.isfinite(marginal).all() and marginal.min() >= 0 and marginal.max() <= 1


def test_learns_stems_and_leaves_clean_texts_alone(spark):
    rng = random.Random(8)
    syllables = ["ra", "ti", "on", "be", "lu", "che"]
    def prose(n):
        return [rng.choice(["the", "of", "and"]) if rng.random() < 0.3 else "".join(rng.choice(syllables) for _ in range(3)) for _ in range(n)]
    rows, labels = [], []
    for i in range(600):
        w, bad = prose(rng.randrange(5, 120)), i % 4 == 0
        for _ in range(3 if bad else 0):
            w.insert(rng.randrange(len(w)), "zork" + rng.choice(syllables) + rng.choice(syllables))
        rows.append((i, " ".join(w)))
        labels.append((i, 1, int(bad)))
    docs, marks = spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels + [(7, 1, None), (None, 1, 1), (9999, 0, 1)], "doc_id long, quality int, toxic int")
    field = tx.train(docs, marks.where(~tx.held_out(F.col("doc_id"))))
    out = {r.doc_id: r for r in tx.tag(docs, field)[0].collect()}
    held = [i for i in range(600) if zlib.crc32(str(i).encode()) % 3 == 1]
    assert np.mean([out[i].predicted == (i % 4 == 0) for i in held]) > 0.98
    for i in held:
        spans = [rows[i][1][s.start:s.end] for s in out[i].spans]
        assert all("zork" in s for s in spans) if i % 4 else any("zork" in s for s in spans)


@pytest.mark.parametrize("toxic, least, most", [([], 0.5, 0.5), ([0, 0, 0, 0], 0, 0.2), ([1, 1, 1, 1], 0.8, 1)])
def test_labels_of_one_kind_and_empty_tables(spark, toxic, least, most):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(6)] + [(None, None)], DOCS)
    marks = spark.createDataFrame([(i, 1, t) for i, t in enumerate(toxic)], "doc_id long, quality int, toxic int")
    field = tx.train(docs, marks)
    assert all(least <= r.score <= most for r in tx.tag(docs, field)[0].collect())
    assert tx.tag(docs.limit(0), field)[0].collect() == []
    assert tx.digest(docs.limit(0), marks).columns == ["doc_id", "held_out", "score", "predicted"]


def test_query_is_a_field_that_never_saw_the_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"{SF_SMALL}/{t}.parquet") for t in ("documents", "labels"))
    got = {r.doc_id: r for r in QUERIES["op13_toxicity"](spark, SF_SMALL).collect()}
    field = tx.train(docs.select("doc_id", "text"), labels.where("crc32(cast(doc_id as string)) % 3 != 1"))
    for doc_id, text in docs.select("doc_id", "text").collect():
        r = got.pop(doc_id)
        assert r.held_out == (zlib.crc32(str(doc_id).encode()) % 3 == 1)
        assert r.score == pytest.approx(plain_score(field, text), abs=1e-6) and r.predicted == int(r.score >= 0.7)
    assert not got
