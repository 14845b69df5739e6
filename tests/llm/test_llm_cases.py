"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns, operator by operator."""

import gzip
import hashlib
import io
import random
import re
import time
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from trackcast.llm import (decontamination, graph, langid, line_spread, mixing, near_dedup, quality, quality_rules,
                           sharding, url_filter, warc)
from trackcast.llm import text as scan

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def make(spark, rows, schema=SCHEMA, **more):
    df = spark.createDataFrame(rows, schema)
    return df.withColumns({k: F.lit(v) for k, v in more.items()})


def prose(n, seed=0, size=400):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(size)}" for _ in range(n))


@pytest.fixture(scope="module")
def odd(spark):
    """Null ids and texts, empty and blank texts, repeated rows, a long text, ids that tie."""
    long = prose(30_000, 7, 5000)
    rows = [(1, None, None, None, None), (None, "a lonely row without an id", "en", "s", 1), (2, "", "en", "s", 0),
            (3, " \n\t ", "de", None, 4), (4, long, "en", "t", len(long)), (4, "other text, same id", "en", "t", 3)]
    rows += [(5, "the very same row " * 20, "fr", "s", 9)] * 7
    return make(spark, rows)


def test_words_and_hashes_match_regular_expressions():
    texts = ["", None, "Hello wörld  x\n", " ", "a", "", "ab c", "é1 b" * 3, "", "\u3000x\u00a0y", "x" * 5000]
    column = pa.array(texts)
    for limit in (1, 10, 1 << 20):
        seen = {}
        for at, end, data, offsets in scan.groups(column, limit):
            w = scan.words_of(data, offsets, scan.NOT_SPACE)
            h = w.hashes()
            for i in range(at, end):
                mine = range(w.first[i - at], w.first[i - at + 1])
                assert [w.word(j).decode() for j in mine] == re.findall(r"[^\x20\x09-\x0D]+", texts[i] or "")
                for j in mine:
                    assert seen.setdefault(w.word(j), h[j]) == h[j]
        assert len(set(seen.values())) == len(seen)


@pytest.mark.parametrize("n", [8, 128, 255, 256, 257, 1024, 4096])
def test_hashes_of_thue_morse_strings_differ(n):
    one = "".join("ab"[bin(i).count("1") % 2] for i in range(n))
    two = "".join("ba"[bin(i).count("1") % 2] for i in range(n))
    data = np.frombuffer(f"{one}\n{two}\n{one}".encode(), np.uint8)
    h = scan.words_of(data, np.array([0, len(data)]), scan.NOT_SPACE).hashes()
    assert h[0] == h[2] != h[1]
    found = quality_rules.statistics(data, np.array([0, len(data)]))
    assert dict(zip(quality_rules.COUNTS, found[0][0]))["n_dup_lines"] == 1


def test_sharding_splits_hot_keys_and_repeated_rows(spark):
    rows = [(7, "hot key", "en", "a", 1)] * 300 + [(i, prose(i % 50, i), "en", "a", 1) for i in range(300)] + [
        (None, None, None, None, None)] * 20
    df = make(spark, rows, shard="mine", SLOT=3, k1=1)
    out, (shard, slot) = sharding.shard(df, 4)
    assert out.columns == [*df.columns, "shard_", "slot_"]
    got = out.collect()
    assert Counter(tuple(r)[:5] for r in got) == Counter(rows)
    size = Counter()
    for r in got:
        size[r[shard]] += len((r["text"] or "").encode()) + 1
    assert max(size.values()) - min(size.values()) <= 2 * 260
    for s in range(4):
        assert sorted(r[slot] for r in got if r[shard] == s) == list(range(sum(r[shard] == s for r in got)))


def test_sharding_subdivides_overfull_ranges(spark):
    keyed = spark.range(5000).select(F.col("id").alias("k1"), F.col("id").alias("k2"), F.col("id").alias("k3"),
                                     F.when(F.col("id") < 10, 1000).otherwise(1).cast("long").alias("size"))
    cuts = sharding.splitters(keyed, 64, 5000 - 10 + 10_000, 5000)
    share = np.where(np.arange(5000) < 10, 1000, 1) / 29980 + 0.5 / 5000
    at = np.searchsorted(cuts[:, 0], np.arange(5000), side="right")
    total, most = np.bincount(at, share), np.zeros(at.max() + 1)
    np.maximum.at(most, at, share)
    assert (total - most <= sharding.OVERFULL / 64 + 1e-12).all()


def test_sharding_odd_and_empty(spark, odd, scratch):
    got = sharding.digest(odd).collect()
    assert len(got) == odd.count() and {r["size"] for r in got if r["doc_id"] == 1} == {1}
    assert sharding.digest(odd.limit(0)).count() == 0
    path = scratch("shards")
    sharding.write_shards(sharding.shard(odd, 3)[0], path)
    assert spark.read.parquet(path).count() == odd.count()


def test_language_codes_and_odd_rows(spark, odd):
    for n in (1, 2, 4, 6, 12):
        code = langid.codewords(n)
        assert len(code) == n and len({tuple(c) for c in code}) == n
    texts = {"xx": "aba bab abba ", "yy": "cdc dcd cddc ", "zz": "efe fef effe "}
    rows = [(i, texts[k] * (i % 5 + 1), k, None, 0) for i in range(80) for k in texts]
    model = langid.train(make(spark, rows))
    assert model.languages == ["xx", "yy", "zz"]
    out, (lang, score, flag) = langid.identify(make(spark, rows, lang_pred=1, score="s", ambiguous=2, has_letter=3), model)
    got = out.collect()
    assert all(r[lang] == r["lang"] and 0 <= r[score] <= 1 for r in got) and lang == "lang_pred_"
    got = langid.digest(odd).collect()
    assert len(got) == odd.count() and all(r["lang_pred"] == "und" for r in got if r["doc_id"] in (1, 2, 3))
    assert langid.digest(odd.limit(0)).count() == 0
    none = langid.train(make(spark, [(1, "text", None, None, 0)]))
    assert langid.identify(odd, none)[0].where("lang_pred != 'und'").count() == 0


def plain(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_near_duplicates_many_pairs_at_once_match_plain_edit_distance(monkeypatch):
    rng, texts, pairs = random.Random(4), [[], [1], []], [(0, 2), (0, 1), (1, 0), (1, 1)]
    for _ in range(400):
        v = rng.choice([2, 5, 50])
        a = [rng.randrange(v) for _ in range(rng.randint(0, 60))]
        b = list(a)
        for _ in range(rng.randint(0, len(a) // 3 + 1)):
            at = rng.randint(0, len(b))
            b[at:at + rng.randint(0, 1)] = [rng.randrange(v)] * rng.randint(0, 1)
        pairs += [(len(texts), len(texts) + 1), (len(texts) + 1, rng.randrange(len(texts) + 2))]
        texts += [a, b]
    words = np.array([w for t in texts for w in t], np.uint64)
    first = np.cumsum([0, *map(len, texts)])
    one, two = np.array(pairs).T
    for threshold in (0.8, 0.6):
        want = [plain(texts[a], texts[b]) <= int((1 - threshold) * max(len(texts[a]), len(texts[b])) + 1e-9) for a, b in pairs]
        assert 100 < sum(want) < len(pairs) - 100
        for together, cells in ((512, 1 << 19), (512, 500), (3, 1 << 19)):
            monkeypatch.setattr(near_dedup, "TOGETHER", together)
            monkeypatch.setattr(near_dedup, "CELLS", cells)
            assert near_dedup.similar_pairs(words, first, one, two, threshold).tolist() == want


def test_near_duplicates_alignment_matches_plain_edit_distance(monkeypatch):
    rng = random.Random(1)

    for wide in [True, False] * 300:
        monkeypatch.setattr(near_dedup, "WIDE", -1 if wide else 64)
        v = rng.choice([2, 5, 50])
        a = [rng.randrange(v) for _ in range(rng.randint(0, 40))]
        b = list(a)
        for _ in range(rng.randint(0, 6)):
            at = rng.randint(0, len(b))
            b[at:at + rng.randint(0, 1)] = [rng.randrange(v)] * rng.randint(0, 1)
        most, d = rng.randint(0, 12), plain(a, b)
        assert near_dedup.edit_distance(np.array(a, np.uint64), np.array(b, np.uint64), most) == (d if d <= most else None)


def test_near_duplicates_order_matters():
    def sketch(text):
        data = np.frombuffer(text.encode(), np.uint8)
        return near_dedup.order_sketches(scan.words_of(data, np.array([0, len(data)]), scan.NOT_SPACE))[1][0]

    a, b = prose(200, 1), prose(200, 2)
    assert (sketch(f"{a} {b}") == sketch(f"{a} {b}")).all()
    assert (sketch(f"{a} {b}") == sketch(f"{b} {a}")).mean() < 0.7  # the same k-mers but a few, in another order


def test_near_duplicates_groups(spark, odd):
    base, rng = prose(120, 3).split(), random.Random(2)
    rows = [(100, " ".join(base), "en", "a", 0)] * 3
    for i in range(40):  # a chain of near copies of one text, and as many others
        near = list(base)
        for _ in range(4):
            near[rng.randrange(120)] = f"x{rng.randrange(1000)}"
        rows.append((200 + i, " ".join(near), "en", "a", 0))
        rows.append((300 + i, prose(120, 1000 + i, 5000), "en", "a", 0))
    rows += [(400, None, None, None, None), (401, None, None, None, None), (402, "", None, None, 0), (403, "", None, None, 0), (404, "one two", None, None, 0)]
    df = make(spark, rows, node="n", class_id=1)
    got = {(r["doc_id"], r["class_id"]) for r in near_dedup.label_documents(df).collect()}
    want = {(100, 100), *((200 + i, 100) for i in range(40)), *((300 + i, 300 + i) for i in range(40)),
            (400, 400), (401, 401), (402, 402), (403, 402), (404, 404)}
    assert got == want
    kept = near_dedup.deduplicate(df)
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted([100, *range(300, 340), 400, 401, 402, 404])
    assert near_dedup.label_documents(odd).count() == odd.count()
    assert near_dedup.deduplicate(odd).count() == 7  # the seven equal rows count once
    assert near_dedup.deduplicate(odd.limit(0)).count() == near_dedup.label_documents(odd.limit(0)).count() == 0


def sketched(texts):
    column = pa.array(texts)
    (_, _, data, offsets), = scan.groups(column, 1 << 26)
    words = scan.words_of(data, offsets, scan.NOT_SPACE)
    return near_dedup.order_sketches(words)[1], np.split(words.hashes(), words.first[1:-1])


def edited(words, edits, rng):
    out = list(words)
    for at in rng.sample(range(len(out)), edits):  # scattered over the whole text
        out[at] = f"z{rng.randrange(10 ** 6)}"
    return out


def around_a_passage(texts, planted, seed):
    """Texts of 200 words, 120 of them one passage of all; the first ``planted`` have a partner at 0.8 to 0.82."""
    rng = random.Random(seed)
    passage = [f"p{i}" for i in range(120)]
    out = []
    for _ in range(texts):
        own = [f"o{rng.randrange(10 ** 6)}" for _ in range(80)]
        at = rng.randrange(81)
        out.append(own[:at] + passage + own[at:])
    out += [edited(out[i], rng.choice([36, 38, 40]), rng) for i in range(planted)]
    return [" ".join(x) for x in out]


def classes_of(spark, texts):
    df = make(spark, [(i, t, "en", "a", 0) for i, t in enumerate(texts)])
    got = {r["doc_id"]: r["class_id"] for r in near_dedup.label_documents(df).collect()}
    return [got[i] for i in range(len(texts))]


def test_near_duplicates_large_bucket_is_compared_to_the_end(spark):
    texts = around_a_passage(1500, 150, 6)
    sketch, hashes = sketched(texts)
    surely = [i for i in range(150) if (sketch[i] == sketch[1500 + i]).any() and near_dedup.similar(hashes[i], hashes[1500 + i])]
    got = classes_of(spark, texts)
    assert len(surely) >= 100 and all(got[i] == got[1500 + i] for i in surely)


def test_near_duplicates_bounds_and_rare_words_lose_no_similar_pair(spark):
    texts = around_a_passage(60, 60, 7) + [prose(n, n, 30) for n in range(1, 40)] + [prose(n, n, 30) + " x" for n in range(1, 40)]
    texts += [" ".join(f"v{i % 28}" for i in range(8191)), " ".join([*(f"v{i % 28}" for i in range(8191)), "new"])]  # counts over 255
    rows = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    rare = {}
    for r in near_dedup.rare_words(rows, 0.8).collect():
        rare.setdefault(r["id"], set()).add(r["word"])
    (_, _, data, offsets), = scan.groups(pa.array(texts), 1 << 26)
    words = scan.words_of(data, offsets, scan.NOT_SPACE)
    bag, hashes, close = near_dedup.bags(words), np.split(words.hashes(), words.first[1:-1]), 0
    for a in range(len(texts)):
        for b in range(a):
            longer = max(len(hashes[a]), len(hashes[b]))
            distance = near_dedup.edit_distance(hashes[a], hashes[b], longer // 5)
            if distance is not None:
                close += 1
                assert near_dedup.least_edits([bag[a]], [bag[b]])[0] <= distance and rare[a] & rare[b]
    assert close >= 60
    assert classes_of(spark, texts[-2:]) == [0, 0]


def classes_by_brute_force(texts):
    """The least index of each text's class: all pairs with an equal sketch are compared."""
    sketch, hashes = sketched(texts)
    found = list(range(len(texts)))

    def find(x):
        while found[x] != x:
            x = found[x]
        return x

    for a in range(len(texts)):
        for b in a + 1 + np.flatnonzero((sketch[a] == sketch[a + 1:]).any(axis=1)):
            if near_dedup.similar(hashes[a], hashes[b]):
                x, y = sorted((find(a), find(b)))
                found[y] = x
    return [find(x) for x in range(len(texts))]


def test_near_duplicates_bags_of_few_different_words_bound_the_distance():
    rng, at = random.Random(11), []
    for _ in range(300):
        v, n = rng.choice([1, 2, 5, 28, 300]), rng.choice([3, 40, 255, 256, 511, 2000, 8200])
        a = [f"w{rng.randrange(v)}" for _ in range(n)]
        b = edited(a, rng.randrange(min(n, 9)), rng) + ["more"] * rng.choice([0, 0, 1, n // 10])
        at.append((a, b, sum(x != y for x, y in zip(a, b)) + len(b) - n))
    one, two = ([" ".join(x[k]) for x in at] for k in (0, 1))
    bag = []
    for side in (one, two):
        (_, _, data, offsets), = scan.groups(pa.array(side), 1 << 26)
        bag.append(near_dedup.bags(scan.words_of(data, offsets, scan.NOT_SPACE)))
    assert (near_dedup.least_edits(*bag) <= [x[2] for x in at]).all()


def test_near_duplicates_rejects_a_long_pair_in_time():
    rng = np.random.default_rng(5)
    a, b = rng.integers(0, 3000, 20_000).astype(np.uint64), rng.integers(0, 3000, 20_000).astype(np.uint64)
    b[:15_000] = a[:15_000]
    a[::13] = 9999
    began = time.monotonic()
    assert near_dedup.edit_distance(a, b, 4000, exact=False) is None
    assert time.monotonic() - began < 20


@pytest.mark.parametrize("texts, planted, block, large", [(40, 20, 256, 4096), (400, 40, 16, 4096), (400, 40, 64, 64)])  # one block, many, split by words
def test_near_duplicates_single_sketch_buckets_are_compared_to_the_end(spark, texts, planted, block, large, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    monkeypatch.setattr(near_dedup, "LARGE", large)
    texts = around_a_passage(texts, planted, 8)
    want = classes_by_brute_force(texts)
    assert sum(i != c for i, c in enumerate(want)) >= 10
    assert classes_of(spark, texts) == want


def test_near_duplicates_recall_at_the_threshold(spark):
    rng = random.Random(9)
    texts = [[f"o{rng.randrange(5000)}" for _ in range(200)] for _ in range(300)]
    for edits in (40, 30):  # word edit similarity 0.80 and 0.85, edits scattered
        partners = [edited(t, edits, rng) for t in texts]
        one, two = (sketched([" ".join(t) for t in x])[0] for x in (texts, partners))
        assert (one == two).any(axis=1).mean() >= 0.98
        got = classes_of(spark, [" ".join(t) for t in texts + partners])
        assert np.mean([got[300 + i] == i for i in range(300)]) >= 0.98


def test_components(spark):
    rng = random.Random(4)
    edges = [(f"n{rng.randrange(300):03d}", f"n{rng.randrange(300):03d}") for _ in range(220)]
    edges += [(f"p{i:03d}", f"p{i + 1:03d}") for i in range(40)] + [(None, "x"), ("y", "y")]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            a, b = sorted((find(a), find(b)))
            parent[b] = a
    got = {r["node"]: r["root"] for r in graph.components(spark.createDataFrame(edges, "a string, b string")).collect()}
    assert got == {x: find(x) for x in parent}
    assert graph.components(spark.createDataFrame([], "a string, b string")).count() == 0


def test_quality_ordinal_fit_and_odd_rows(spark, odd):
    rng = random.Random(5)
    rows, labels = [], []
    for i in range(240):
        g = i % 3
        rows.append((i, prose(60, i) + [" ### ### ###", " nasty nasty", ""][g], "en", "a", 0))
        labels.append((i, int(g > 0), int(g == 1)))
    labels += [(None, 1, 0), (3, None, None), (999, 1, None), (0, 1, 0)]  # document 0 has two grades: the lower counts
    ratings = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    docs = make(spark, rows, kept=rng.random(), tail_prob="t")
    model = quality.rated(docs, ratings)
    assert (np.diff(model.threshold) >= 0).all()
    out, (grade, tail, kept) = quality.classify(docs, model)
    got = out.collect()
    assert kept == "kept_" and np.mean([r[kept] == (r["doc_id"] % 3 == 2) for r in got]) > 0.97
    mean = [np.mean([r[grade] for r in got if r["doc_id"] % 3 == g]) for g in range(3)]
    assert mean[0] < mean[1] < mean[2]
    assert quality.select_documents(docs, model).columns == docs.columns
    got = quality.classify(odd, model)[0].collect()
    assert len(got) == odd.count() and not any(r["kept"] for r in got if r["doc_id"] in (1, 2, 3))
    assert quality.classify(odd.limit(0), model)[0].count() == 0
    none = quality.rated(docs, ratings.limit(0))
    assert quality.classify(docs, none)[0].count() == len(rows)


PAGES = "page_id long, url string, html string"


def test_url_rules(spark):
    urls = ["http://a.com/", "http://a.com", "https://EXAMPLE.com/en/x?q#f", "http://www.example.com/en/", "http://b.www.example.com/en/1",
            "http://notexample.com/en/", "http://x.net/es/1", "http://net/fr/", "http://x.net/esx", "no scheme", None, "", "a://b://c.com/x",
            "http://h.org?x=/es/", "http://x.COM#y"]
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.digest(
        spark.createDataFrame([(i, u, None) for i, u in enumerate(urls)], PAGES)).collect()}
    assert got == {
        0: ("a.com", "/", "com/", "allow"), 1: ("a.com", "", None, "allow"), 2: ("example.com", "/en/x", "example.com/en/", "block"),
        3: ("www.example.com", "/en/", "www.example.com/en/", "allow"), 4: ("b.www.example.com", "/en/1", "www.example.com/en/", "allow"),
        5: ("notexample.com", "/en/", "com/", "allow"), 6: ("x.net", "/es/1", "net/es/", "block"), 7: ("net", "/fr/", "net/fr/", "block"),
        8: ("x.net", "/esx", None, "allow"), 9: ("", "", None, "allow"), 10: ("", "", None, "allow"), 11: ("", "", None, "allow"),
        12: ("b:", "//c.com/x", None, "allow"), 13: ("h.org", "", None, "allow"), 14: ("x.com", "", None, "allow")}


def test_url_aliases_share_block_decisions(spark):
    def canonical(u):
        return f"<html><link  href='{u}' REL=\"canonical\"></html>"

    def refresh(u):
        return f'<meta http-equiv="Refresh" content="0; url={u}">'

    rows = [(1, "http://a.org/1", canonical("https://x.net/es/1")),         # names a blocked page
            (2, "http://b.org/2", refresh("http://a.org/1#top")),           # by way of 1
            (3, "http://c.org/3", "plain"),                                 # no alias
            (4, "http://d.org/4", canonical("http://x.net/fr/4")),          # blocked and allowed aliases: allow goes first
            (5, "http://e.org/5", canonical("http://d.org/4")), (6, "http://e.org/5?x=1&y", canonical("http://f.com/")),
            (7, "http://e.org/5", refresh("/5?x=1&amp;y")),
            (8, "http://www.example.com/en/", canonical("http://x.net/es/1")),  # its own rule stays
            (9, "https://a.org/1", None), (9, "https://a.org/1", None), (None, "http://g.org/", "canonical #")]
    pages = spark.createDataFrame(rows, PAGES).withColumns({"host": F.lit("h"), "key": F.lit(1), "a": F.lit("a")})
    got = [(r["page_id"], r["verdict"]) for r in url_filter.judge(pages).collect()]
    # pages 1, 2 and 9 are aliases of a blocked URL, but page 8, an alias too, is allowed by a rule
    assert Counter(got) == Counter([(i, "allow") for i in (1, 2, 3, 4, 5, 6, 7, 8, 9, 9, None)])
    got = {r["page_id"]: r["verdict"] for r in url_filter.judge(pages.where("page_id != 8")).collect()}
    assert got == {1: "block", 2: "block", 3: "allow", 4: "allow", 5: "allow", 6: "allow", 7: "allow", 9: "block"}
    more = spark.createDataFrame([("c.org/3", "net/fr/")], "a string, b string")
    assert {r["page_id"]: r["verdict"] for r in url_filter.judge(pages, edges=more).collect()}[3] == "block"
    assert url_filter.digest(pages.limit(0)).count() == 0


def test_url_all_links_of_a_page_count(spark):
    blocked = "href='http://x.net/es/1'"
    rows = [(1, "http://a.org/1", f"<link rel=canonical><link rel='canonical' {blocked}>"),   # the first has no target
            (2, "http://b.org/2", f"<link rel='canonical' href='http://b.org/3'><link {blocked} rel=\"canonical\">"),
            (3, "http://c.org/3", f"<link rel='alternate  canonical' {blocked}>"),            # a later token of rel
            (4, "http://d.org/4", f"<link rel='not-canonical' {blocked}><link rel='canonicals' {blocked}>"),
            (5, "http://e.org/5", '<meta http-equiv=refresh content="5"><meta http-equiv="refresh" content="0; url=http://x.net/es/1">')]
    rows += [(6, "http://f.org/6", '<link rel="canonical" href="/7">'), (7, "http://f.org/7", "<link rel=canonical href=http://a.org/1>"),  # a chain
             (8, "http://g.org/8", f"<link rel='canonical' {blocked}><link rel='canonical' href='http://h.com/'>"), (9, "http://i.org/9", None)]
    pages = spark.createDataFrame(rows, PAGES)
    got = {r["page_id"]: r["verdict"] for r in url_filter.digest(pages).collect()}
    # 8 allows all that shares its component, as h.com is allowed, but no page's own rule
    assert got == {i: "allow" for i in range(1, 10)}
    short = [r for r in rows if r[0] != 8]
    got = {r["page_id"]: r["verdict"] for r in url_filter.digest(pages.where("page_id != 8")).collect()}
    assert got == {1: "block", 2: "block", 3: "block", 4: "allow", 5: "block", 6: "block", 7: "block", 9: "allow"}
    for some in (rows, short):  # the SQL states the same rule
        con = duckdb.connect()
        con.execute("create table pages (page_id bigint, url varchar, html varchar)")
        con.executemany("insert into pages values (?, ?, ?)", some)
        want = sorted(con.execute(f"select page_id, host, path, rule, verdict from ({url_filter.SQL})").fetchall())
        made = url_filter.digest(spark.createDataFrame(some, PAGES)).select("page_id", "host", "path", "rule", "verdict")
        assert sorted(map(tuple, made.collect())) == want


def fill(sizes, weights, share, most):
    """Targets by repeated resharing, as stated."""
    target, open_, left = {}, set(sizes), share * sum(sizes.values())
    while open_:
        total = sum(weights[s] for s in open_)
        over = {s for s in open_ if left * weights[s] / total > most * sizes[s]}
        if not over:
            return target | {s: left * weights[s] / total for s in open_}
        for s in over:
            target[s] = most * sizes[s]
        left -= sum(target[s] for s in over)
        open_ -= over
    return target


def test_mixing_offset_is_unbiased_and_misses_by_less_than_a_document(spark):
    rng = random.Random(12)
    rows = [(i, prose(rng.randrange(1, 300), i), "en", f"s{rng.randrange(40):02d}", 0) for i in range(600)] + [(1000, "again and again", "en", "s00", 0)] * 20
    lined = mixing.placed(mixing.entries(make(spark, rows).select("doc_id", "text", "source")))
    every = lined.drop("offset").withColumn("offset", F.explode(F.sequence(F.lit(0), F.lit(1023))))
    times = mixing._copies(F.col("ahead"), F.col("n"), F.col("offset"))
    mean = every.groupBy("key", "id").agg(F.avg(times).alias("mean"), F.max(F.col("n") * F.col("rate")).alias("wanted"))
    assert all(abs(r["mean"] - r["wanted"]) < 0.003 for r in mean.collect())  # over all offsets a row comes as often as it expects
    words = every.groupBy("key", "offset").agg(F.sum(times * F.col("size")).alias("words"), F.max("target").alias("target"), F.max("size").alias("largest"))
    assert words.where(F.abs(F.col("words") - F.col("target")) > F.col("largest")).isEmpty()
    seeds = [F.abs(F.avg(mixing._bits(F.md5(F.concat(F.lit(f"{seed}|"), F.col("id").cast("string")))) % 1024) - 511.5) for seed in range(5)]
    assert all(off < 15 for off in spark.range(20_000).agg(*seeds).first())


def test_mixing_takes_the_nearest_of_its_offsets(spark):
    rng = random.Random(14)
    rows = [(i, prose(rng.randrange(1, 300), i), "en", f"s{rng.randrange(30):02d}", 0) for i in range(200)]
    lined = mixing.placed(mixing.entries(make(spark, rows).select("doc_id", "text", "source"))).select(
        "key", "size", "n", "ahead", "rate", "target", "offset").collect()
    for key in {r["key"] for r in lined}:
        own = [r for r in lined if r["key"] == key]
        start = int(hashlib.md5(f"mix-1|{key}".encode()).hexdigest()[:8], 16) % 1024

        def off(u):
            taken = [min(np.floor((r["ahead"] + r["n"]) * r["rate"] + u / 1024) - np.floor(r["ahead"] * r["rate"] + u / 1024), 2 * r["n"]) * r["size"] for r in own]
            return abs(sum(taken) - own[0]["target"])

        tried = [(start + 16 * k) % 1024 for k in range(64)]
        assert len({r["offset"] for r in own}) == 1 and own[0]["offset"] in tried
        assert off(own[0]["offset"]) <= min(map(off, tried)) + 1e-6


def test_mixing_targets_of_many_sources(spark):
    rng = random.Random(13)
    sizes = {f"={i:04d}": rng.choice([0, 1, 5, rng.randrange(1, 10 ** 6)]) for i in range(3000)}
    names = sorted(sizes)
    got = mixing.source_targets(spark.createDataFrame(list(sizes.items()), "key string, source_size long").repartition(7))
    want = fill({k: v for k, v in sizes.items() if v}, {k: (5, 2, 1)[i % 3] for i, k in enumerate(names)}, 1.5, 2.0)
    for r in got.collect():
        assert abs(r["target"] - want.get(r["key"], 0)) <= 1e-9 * want.get(r["key"], 0)
    assert got.count() == 3000


def test_mixing_targets_and_copies(spark, odd):
    rng = random.Random(8)
    rows = [(i, prose(rng.randrange(1, 80), i), "en", rng.choice(["b", "a", "c", "d", None, "hot", "hot"]), i) for i in range(1500)]
    rows += [(9999, "the same row again", "en", "hot", 0)] * 9000
    df = make(spark, rows)
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += len(r[1].split())
    names = sorted((s for s in sizes if s is not None)) + [None]
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    want, got = fill(sizes, weights, 1.5, 2.0), mixing.digest(df).collect()
    assert len(got) == len(rows)
    by_id = {r[0]: r[3] for r in rows}
    taken = Counter()
    for r in got:
        s = by_id[r["doc_id"]]
        assert r["source_size"] == sizes[s] and abs(r["target"] - want[s]) < 1e-6 * want[s]
        assert r["taken"] in (0, r["size"], 2 * r["size"])
        taken[s] += r["taken"]
    assert all(abs(taken[s] - want[s]) <= 160 for s in sizes)
    again = mixing.digest(df.repartition(3)).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))
    mixed = mixing.mix(df.withColumns({"h": F.lit("x"), "times": F.lit(2), "i": F.lit(None).cast("int")}))
    assert Counter(r["doc_id"] for r in mixed.collect()) == Counter(
        {i: n for i, n in ((i, sum(r["taken"] // r["size"] for r in got if r["doc_id"] == i)) for i in by_id) if n})
    assert mixing.digest(odd).count() == odd.count() and mixing.digest(odd.limit(0)).count() == 0
    blank = make(spark, [(1, None, None, "a", 0), (2, " ", None, None, 0)])
    assert {tuple(r)[1:] for r in mixing.digest(blank).collect()} == {(0, 0, 0.0, 0)}


def warc_file(payloads):
    return b"".join(warc.member(f"urn:page:{i}", f"http://h/{i}", p, warc.sha1_base32(p), len(p), None) for i, p in enumerate(payloads))


def test_warc_splits_anywhere():
    rng = random.Random(3)
    payloads = [bytes(rng.randrange(256) for _ in range(rng.choice([0, 10, 3000]))) + gzip.compress(b"not a record") for _ in range(40)]
    raw = b"junk" + warc_file(payloads[:20]) + bytes(7) + warc_file(payloads[20:])[:-5]  # padding, and a torn end
    whole = list(warc.scan(io.BytesIO(raw), 0, len(raw)))
    assert [warc.parse(c)["payload"] for _, c in whole] == payloads[:-1]
    for step in (1000, 4097, 20_000):
        parts = [x for at in range(0, len(raw), step) for x in warc.scan(io.BytesIO(raw), at, min(len(raw), at + step))]
        assert parts == whole
    assert gzip.decompress(warc_file(payloads[:3])).count(b"WARC/1.1\r\n") == 3


def test_warc_round_trip(spark, scratch):
    big = "".join(random.Random(1).choices("abcdefgh\u00e9 ", k=200_000))
    rows = [(1, "http://a/1", "same"), (2, "http://a/2", "same"), (3, None, None), (4, "http://a/\r\nX: y", ""), (5, "http://a/5", big),
            (None, "http://a/n", "same"), (7, "http://a/7", "\0\n\r\n\r\nWARC/1.1"), (7, "http://a/7", "\0\n\r\n\r\nWARC/1.1")]
    pages = spark.createDataFrame(rows, PAGES).withColumns({"digest": F.lit(1), "payload": F.lit("p"), "refers_to": F.lit(2)})
    path = scratch("warc-test")
    warc.write_archives(pages, path)
    got = warc.read_archives(spark, path, split_bytes=4096).collect()
    by = {(r["record_id"], r["record_type"]): r for r in got}
    assert len(got) == len(rows)
    assert bytes(by["urn:page:5", "response"]["payload"]).decode() == big
    assert by["urn:page:2", "revisit"]["refers_to_id"] == by["urn:page:none", "revisit"]["refers_to_id"] == "urn:page:1"
    assert by["urn:page:4", "revisit"]["url"] == "http://a/%0D%0AX: y" and by["urn:page:3", "response"]["payload_bytes"] == 0
    assert sum(r["record_id"] == "urn:page:7" and r["record_type"] == "response" for r in got) == 2
    assert {r["payload_digest"] for r in got if r["payload_bytes"] == 4} == {warc.sha1_base32(b"same")}
    for r in got:  # every record is a whole gzip member at its offset
        with warc.open_file(r["path"]) as f:
            assert gzip.GzipFile(fileobj=io.BytesIO(f.read()[r["offset"]:])).read(8) == b"WARC/1.1"
    assert warc.digest(pages.limit(0)).count() == 0
    long = scratch("warc-few")
    warc.write_archives(pages, long, least_bytes=5)
    assert warc.read_archives(spark, long).where("record_type = 'revisit'").count() == 0


def test_line_spread(spark, odd):
    rows = []
    for i in range(30):  # spread over 12 sites, 8 sites, 7 sites; and often on one site
        lines = [f"own line {i}", "everywhere"] + ["eight"] * (i < 8) + ["seven"] * (i < 7) + [""]
        rows.append((i, "\n".join(lines), "en", f"s{i % 12}", 0))
    rows += [(100 + i, "one site only\n  everywhere ", "en", "s0", 0) for i in range(50)]
    df = make(spark, rows, n_lines="n", k=1, at=2)
    out, (n_lines, n_removed) = line_spread.dedup_lines(df)
    got = {r["doc_id"]: (r["text"], r[n_removed]) for r in out.collect()}
    assert out.columns == [*df.columns, "n_lines_", "n_removed"]
    assert got[0] == ("own line 0\nseven\n", 2) and got[7] == ("own line 7\n", 2) and got[20] == ("own line 20\n", 1)
    assert got[100] == ("one site only", 1)
    same = line_spread.dedup_lines(odd)[0].collect()
    assert Counter(r["text"] for r in same) == Counter(r["text"] for r in odd.collect())
    assert line_spread.digest(odd.limit(0)).count() == 0


def test_line_spread_of_texts_of_many_lines(spark):
    common = [f"line {i}" for i in range(200_000)]
    rows = [(i, "\n".join(common), "en", f"s{i}", 0) for i in range(8)] + [(9, "\n".join(["mine", *common[:100_000], "", "too"]), "en", "s1", 0)]
    began = time.monotonic()
    out, (_, n_removed) = line_spread.dedup_lines(make(spark, rows))
    got = {r["doc_id"]: (r["text"], r[n_removed]) for r in out.collect()}
    assert time.monotonic() - began < 90  # seconds, where a search per line would take an hour
    assert got == {i: ("", 200_000) for i in range(8)} | {9: ("mine\n\ntoo", 100_000)}


def test_quality_rules_constraints_and_odd_rows(spark, odd):
    rng = np.random.default_rng(3)
    x = rng.random((2000, 3))
    y = (x[:, 0] + 0.3 * np.sin(12 * x[:, 1]) + 0.2 * rng.random(2000) > 0.7).astype(float)
    model = quality_rules.fit(x, y, np.ones(2000), [1, 0, -1], trees=30)
    grid = rng.random((200, 3))
    for f, sign in ((0, 1), (2, -1)):
        curve = []
        for v in np.linspace(0, 1, 40):
            point = grid.copy()
            point[:, f] = v
            curve.append(model.score(point))
        assert (sign * np.diff(np.stack(curve), axis=0) >= -1e-12).all()
    assert ((model.score(x) > 0.5) == y).mean() > 0.85
    rows = [(i, prose(80, i) + " ###" * (i % 2) * 30, "en", "a", 0) for i in range(60)]
    docs = make(spark, rows, kept="k", n_words=5)
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(60)] + [(None, 1), (5, None)], "doc_id long, quality int")
    trees = quality_rules.train(docs, labels)
    out, names = quality_rules.judge(docs, trees)
    assert names[0] == "n_words_" and names[-1] == "kept_"
    assert all(r["kept_"] == (r["doc_id"] % 2 == 0) for r in out.collect())
    got = quality_rules.judge(odd, trees)[0].collect()
    assert len(got) == odd.count() and all(r["n_words"] == 0 and r["base_failed"] for r in got if r["doc_id"] in (1, 2, 3))
    assert quality_rules.judge(odd.limit(0), trees)[0].count() == 0
    assert quality_rules.judge(docs, quality_rules.train(docs, labels.limit(0)))[0].count() == len(rows)


def test_decontamination_brute_force(spark, odd):
    rng = random.Random(6)
    items = [(i, prose(rng.choice([3, 8, 13, 14, 30]), 500 + i, 40)) for i in range(30)]
    items += [(None, "null id item"), (90, None), (91, "  ,. "), (92, "Zwölf Wörter"), (92, "Zwölf Wörter"), (93, items[4][1])]
    rows = []
    for i in range(120):
        parts = [prose(rng.randrange(0, 30), i, 40)]
        for _ in range(rng.randrange(0, 3)):
            t = rng.choice(items)[1] or ""
            parts += [t.upper() if rng.random() < 0.3 else t, prose(rng.randrange(0, 20), rng.randrange(10**6), 40)]
        rows.append((i, ", ".join(parts), "en", "a", 0))
    rows += [(500, None, None, None, None), (501, "", None, None, 0), (502, "zwölf wörter", None, None, 0), (502, "zwölf wörter", None, None, 0)]
    low = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low(t))
    windows = {}
    for i, t in items:
        w = split(t)
        for at in range(len(w) - min(13, len(w)) + 1 if w else 0):
            windows.setdefault(tuple(w[at:at + min(13, len(w))]), set()).add("null" if i is None else str(i))
    want = Counter()
    for i, t, *_ in rows:
        w, hit, ids = split(t), set(), set()
        for at in range(len(w)):
            for n in range(1, 14):
                if (found := windows.get(tuple(w[at:at + n]))) and at + n <= len(w):
                    hit |= set(range(at, at + n))
                    ids |= found
        want[i, len(w), len(hit), tuple(sorted(ids))] += 1
    docs = make(spark, rows, n_words="x", items=1)
    bench = spark.createDataFrame(items, "item_id long, text string")
    for options in ({}, {"block_words": 20}):
        out, (n, hit, found) = decontamination.contamination(docs, bench, **options)
        assert Counter((r["doc_id"], r[n], r[hit], tuple(r[found])) for r in out.collect()) == want
    left = decontamination.decontaminate(docs, bench)
    assert left.columns == docs.columns
    bad = {k[0] for k in want if k[2] and 20 * k[2] >= k[1]}
    assert {r["doc_id"] for r in left.collect()} == {r[0] for r in rows} - bad
    assert decontamination.digest(odd, bench.limit(0)).where("n_hit > 0").count() == 0
    assert decontamination.digest(odd, bench).count() == odd.count() and decontamination.digest(odd.limit(0), bench).count() == 0
