"""Every operator's query on the sf0.001 tables, against its DuckDB SQL or a brute-force version."""

import base64
import hashlib
import os
import re
import sys
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from conftest import ROOT, SF_SMALL

sys.path.insert(0, os.path.join(ROOT, "tools"))
from check_oracle import digest  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
import corpus_pipeline  # noqa: E402
from trackcast.llm import queries as llm  # noqa: E402

QUERIES = entry.queries()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    yield con
    con.close()


@pytest.fixture(scope="module")
def docs(duck):
    return {r[0]: r for r in duck.execute("select doc_id, text, lang, source from documents").fetchall()}


def rows(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    return [r.asDict() for r in df.collect()]


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_every_operator_is_registered_once():
    assert [re.match(r"op(\d+)_", n)[1] for n in llm.QUERIES] == [str(i) for i in range(1, 1 + len(llm.QUERIES))]
    assert set(llm.ORACLE_SQL) <= set(llm.QUERIES) <= set(QUERIES) and "pipeline" in QUERIES


@pytest.mark.parametrize("name", sorted(llm.ORACLE_SQL))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    got, res = [tuple(r) for r in df.collect()], duck.execute(llm.ORACLE_SQL[name])
    columns, want = [d[0] for d in res.description], res.fetchall()
    assert sorted(df.columns) == sorted(columns) and len(got) == len(want)
    assert digest(got, df.columns)[0] == digest(want, columns)[0]


def test_sharding(spark, docs):
    got = rows(spark, "op1_sharding")
    assert sorted(r["doc_id"] for r in got) == sorted(docs)
    slots, sizes = defaultdict(list), Counter()
    for r in got:
        raw = (docs[r["doc_id"]][1] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(raw) + 1, zlib.crc32(raw), "bytes", None)
        slots[r["shard"]].append(r["slot"])
        sizes[r["shard"]] += r["size"]
    assert set(slots) == set(range(16)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(sizes.values()) - min(sizes.values()) <= 2 * max(r["size"] for r in got)


def test_language_id(spark, docs):
    got = rows(spark, "op2_language_id")
    assert sorted(r["doc_id"] for r in got) == sorted(docs)
    held = [r for r in got if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1 for r in got)
    known = [r for r in held if docs[r["doc_id"]][2] is not None]
    assert np.mean([r["lang_pred"] == docs[r["doc_id"]][2] for r in known]) >= 0.95


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_near_duplicates(spark, docs):
    got = {r["doc_id"]: r for r in rows(spark, "op3_order_minhash")}
    assert set(got) == set(docs)
    low = {i: words(re.sub("[A-Z]", lambda m: m[0].lower(), d[1] or "")) for i, d in docs.items()}
    grams = {i: {tuple(w[j:j + 5]) for j in range(max(1, len(w) - 4))} for i, w in low.items()}
    ids = sorted(docs)
    linked = {i: i for i in ids}

    def find(i):
        while linked[i] != i:
            i = linked[i]
        return i

    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            if docs[a][1] == docs[b][1]:
                same = docs[a][1] is not None
            else:
                longer = max(len(low[a]), len(low[b]))
                bag = sum((Counter(low[a]) & Counter(low[b])).values())
                same = bool(grams[a] & grams[b]) and bag >= 0.8 * longer and 1 - edit_distance(low[a], low[b]) / longer >= 0.8
            if same:
                linked[max(find(a), find(b))] = min(find(a), find(b))
    assert {i: r["class_id"] for i, r in got.items()} == {i: find(i) for i in ids}
    assert all(r["kept"] == (r["class_id"] == i) for i, r in got.items())


def test_quality_classifier(spark, duck):
    got = {r["doc_id"]: r for r in rows(spark, "op4_quality_classifier")}
    labels = duck.execute("select doc_id, quality, toxic from labels").fetchall()
    right = [got[i]["kept"] == (q == 1 and t == 0) for i, q, t in labels]
    assert np.mean(right) >= 0.95
    assert all(0 <= r["tail_prob"] <= 1 and r["tail_prob"] <= r["expected_grade"] <= 2 for r in got.values())


def test_warc(spark, duck):
    pages = duck.execute("select page_id, html from pages").fetchall()
    first = {}
    for i, html in sorted(pages):
        first.setdefault(html or "", i)
    want = set()
    for i, html in pages:
        raw = (html or "").encode()
        lead = first[html or ""]
        want.add((i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(),
                  "response" if lead == i else "revisit", None if lead == i else lead))
    got = [(r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in rows(spark, "op7_warc")]
    assert len(got) == len(pages) and set(got) == want


def counts(text):
    w = words(text)
    grams = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    inside = {i + j for i in range(len(w) - 2) if grams[tuple(w[i:i + 3])] > 1 for j in range(3)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(inside)


def test_quality_rules(spark, duck, docs):
    got = {r["doc_id"]: r for r in rows(spark, "op9_quality_rules")}
    assert set(got) == set(docs)
    for i, d in docs.items():
        r, c = got[i], counts(d[1])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == c
        assert r["base_failed"] == (c[0] < 50 or 100 * c[4] > 50 * c[0])
        assert not (r["base_failed"] and r["kept"])
    labels = duck.execute("select doc_id, quality from labels").fetchall()
    judged = [(got[i]["kept"], q == 1) for i, q in labels if not got[i]["base_failed"]]
    assert np.mean([a == b for a, b in judged]) >= 0.95


def test_pipeline_keeps_what_its_stages_decide(spark, docs):
    one = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    kept = corpus_pipeline.quality_classifier(spark, one, SF_SMALL)
    assert kept.columns == one.columns
    quality = {r["doc_id"] for r in rows(spark, "op4_quality_classifier") if r["kept"]}
    assert {r[0] for r in kept.select("doc_id").collect()} == quality
    clean = {r["doc_id"] for r in rows(spark, "op10_benchmark_decontamination") if not r["contaminated"]}
    left = corpus_pipeline.benchmark_decontamination(spark, one, SF_SMALL)
    assert {r[0] for r in left.select("doc_id").collect()} == clean and left.columns == one.columns
    single = corpus_pipeline.near_duplicates(spark, one, SF_SMALL)
    assert sorted(r[0] for r in single.select("doc_id").collect()) == sorted(
        r["doc_id"] for r in rows(spark, "op3_order_minhash") if r["kept"])
    mixed = Counter(r[0] for r in corpus_pipeline.source_mix(spark, one, SF_SMALL).select("doc_id").collect())
    assert mixed == Counter({r["doc_id"]: r["taken"] // r["size"] for r in rows(spark, "op6_mixing") if r["taken"]})

    out = corpus_pipeline.run(spark, SF_SMALL)
    assert out.columns == [*one.columns, "shard", "slot"]
    got = out.collect()
    assert {r["doc_id"] for r in got} <= quality & clean
    assert max(Counter(r["doc_id"] for r in got).values()) <= 2
    place = defaultdict(list)
    for r in got:
        assert r["text"] == docs[r["doc_id"]][1]
        place[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in place.values())
