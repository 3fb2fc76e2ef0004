"""Lexical search, url filter and whitening against plain versions."""

import collections
import math
import re

import numpy as np
import pytest
from conftest import SF_SMALL
from oracle_harness import compare
from pyspark.sql import functions as F

from liftlens.llm import lexical, queries, url_filter, whitening
from llm import brute

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def ranked(docs, items, k=50):
    bags = [(i, collections.Counter(TERM.findall(brute.lower_ascii(t)))) for i, t in docs]
    n_docs, n_terms = sum(bool(b) for _, b in bags), sum(b.total() for _, b in bags)
    df = collections.Counter(t for _, b in bags for t in b)
    out = []
    for item, text in set(items):
        found = []
        for doc, bag in bags:
            score, n = 0, bag.total()
            for term in set(TERM.findall(brute.lower_ascii(text))) & set(bag):
                m = 100 - 50 + 50 * n * n_docs // n_terms
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[term] + 1)))
                score += w * (1000000000 * bag[term] // (1000 * bag[term] + 20 * m))
            if score > 0:
                found.append((-score, doc is None, doc or 0, doc))
        out += [(item, r, doc, -s) for r, (s, _, _, doc) in enumerate(sorted(found, key=lambda x: x[:3])[:k], 1)]
    return brute.key(out)


def test_lexical_odd_rows(spark):
    docs = [(1, None), (2, ""), (3, " .,! "), (4, "Ab1 çÇ_x ab1"), (4, "Ab1 çÇ_x ab1"), (5, "AB1"), (None, "ab1 zz"), (None, "zz"),
            (6, "w " * 3000 + "rare"), (7, "rare Ünï ünï"), (8, "İ ab1"), (9, "x" * 70000 + " zz"), (-3, "zz yy")]
    items = [(0, "ab1 RARE çÇ"), (0, "ab1 RARE çÇ"), (0, "zz"), (1, None), (2, " - "), (None, "w zz"), (3, "absent"), (4, "w w w ünï Ünï")]
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("score", F.lit(1)).withColumn("key", F.lit("a"))
    b = spark.createDataFrame(items, "item_id long, text string").withColumn("terms", F.lit(1))
    assert brute.key(map(tuple, lexical.search_report(d, b).collect())) == ranked(docs, items)
    for k in (2,):
        got = lexical.search(d, b, k=k, block_items=3).collect()
        assert brute.key(map(tuple, got)) == ranked(docs, items, k)
    assert lexical.search_report(d.limit(0), b).count() == lexical.search_report(d, b.limit(0)).count() == 0


@pytest.mark.parametrize("hashes, bits, broadcast", [(3, 10, 10 ** 6), (1, 1, 0)])
def test_lexical_is_exact_whatever_the_signatures(spark, monkeypatch, hashes, bits, broadcast):
    """Dense signatures and other joins change the work, never the result."""
    monkeypatch.setattr(lexical, "BROADCAST_ROWS", broadcast)
    monkeypatch.setattr(lexical, "BITS_PER_ENTRY", bits)
    monkeypatch.setattr(lexical, "HASHES", hashes)
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(60)]
    weights = 1 / np.arange(1, 61)
    docs = [(i, " ".join(rng.choice(words, rng.integers(0, 80), p=weights / weights.sum()))) for i in range(300)]
    docs += [(1000 + i, docs[5][1]) for i in range(120)]  # copies: ties at the floor
    items = [(i, " ".join(rng.choice(words, 6))) for i in range(12)] + [(50, docs[5][1])]
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    got = lexical.search_report(d, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert brute.key(map(tuple, got)) == ranked(docs, items)


def test_lexical_bounds_hold_and_exclude(spark):
    """No bound is below the exact score, and most documents are excluded without their texts."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    items = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").limit(3)
    index = lexical.build_index(docs)
    n_docs, n_terms = index.agg(F.sum("docs"), F.sum("total")).first()
    block = lexical.Queries([(r.item_id, [bytes(t) for t in r.terms]) for r in lexical._items(items, "item_id", "text").collect()])
    df = np.zeros(len(block.terms), np.int64)
    shared = spark.sparkContext.broadcast(block.terms)
    for row in lexical._frequencies(index, shared).collect():
        df[row.term] = row.df
    block.weigh(n_docs, n_terms, df)
    exact = {}
    for r in lexical.search(docs, items, k=20000, index=index).collect():
        exact[r.doc_id, block.item_ids.index(r.item_id)] = r.score
    close = 0
    for row in lexical._blocks_of(index).collect():
        for a, bound in block.bounds(row.width, np.array(row.n), bytes(row.slices)):
            for i, doc in enumerate(row.ids[a:a + len(bound)]):
                for item in range(len(block.item_ids)):
                    score = exact.get((doc, item), 0)
                    assert bound[i, item] >= score
                    close += bound[i, item] <= 1.3 * score
    assert close > 0.5 * len(exact)


RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("net", "/fr/", "block"))


def judged(url):
    low = brute.lower_ascii(url)
    host = path = ""
    if "://" in (url or ""):
        m = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1], re.S)
        host, path = brute.lower_ascii(m[1]), m[2]
    fits = [(len(h + p), h + p, v) for h, p, v in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    rule = max(fits, default=(0, None, None))

    def n(terms):
        return sum(bool(re.search(f"(?<![a-z0-9]){re.escape(t)}(?![a-z0-9])", low)) for t in terms)
    weight = 2 * n(url_filter.STRICT) + n(url_filter.SOFT)
    return host, path, rule[1], rule[2] or ("block" if weight >= 2 else "allow"), n(url_filter.STRICT), n(url_filter.SOFT), weight


URLS = [None, "", "no scheme porn", "http://", "http://a.com", "http://a.com/", "HTTP://A.COM?x=/", "https://com/", "http://xcom/y",
        "http://example.com/en/1", "http://www.example.com/en/1", "http://m.www.Example.com/en/", "http://example.com/EN/1",
        "http://bad.example.com/en", "ftp://x.net/es/?a", "http://net/fr/", "http://n.net/de/#es/", "http://a.org/porn", "http://a.org/pornx",
        "http://a.org/free/ads", "http://a.org/free-free", "http://a.org/ads.bet.free", "http://x.org/é-xxx-é", "http://a.org/adsé",
        "x://y://z.com/en/", "http://u:p@example.com:80/en/", "http://a.org/" + "free" * 50000 + "/ads/bet", "http://a.org\n.com/\n/porn"]


def test_url_filter_odd_rows(spark):
    rows = [(i % 20 if i else None, u) for i, u in enumerate(URLS + URLS[-5:])]
    df = spark.createDataFrame(rows, "page_id long, url string").withColumn("Host", F.lit(1)).withColumn("verdict", F.lit(2))
    got = url_filter.judge_urls(df).select("page_id", *url_filter.COLUMNS).collect()
    assert brute.key(map(tuple, got)) == brute.key((i, *judged(u)) for i, u in rows)
    kept = url_filter.keep_allowed(df)
    assert kept.columns == df.columns
    assert brute.key((r.page_id, r.url) for r in kept.collect()) == brute.key(
        (i, u) for i, u in rows if judged(u)[3] == "allow")
    assert url_filter.url_report(df.limit(0)).count() == 0
    free = url_filter.judge_urls(df, rules=(), strict=(), soft=()).select("verdict", "rule").distinct().collect()
    assert [tuple(r) for r in free] == [("allow", None)]


def plain_whitening(rows, components=32):
    """(vec_id, deviation, n, [|whitened|], [explained]) by a dense eigensolver."""
    out = []
    good = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    for d in {len(v) for _, v in good}:
        ids = [i for i, v in good if len(v) == d]
        x = np.array([[math.floor(64.0 * c) + 1000000 for c in v] for _, v in good if len(v) == d], object)
        n, s = len(x), x.sum(axis=0)
        y = ((n * x - s) / n).astype(float)
        cov = y.T @ y / n
        values, vectors = np.linalg.eigh(cov)
        values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
        held = values > 1e-12 * max(np.trace(cov), 1e-300)
        z = y @ vectors[:, held] / np.sqrt(values[held])
        for i, row, dev in zip(ids, z, ((n * x - s) ** 2).sum(axis=1)):
            out += [(i, c + 1, n, dev, abs(row[c]), values[c] / np.trace(cov)) for c in range(len(row))]
    return out


def assert_whitened(got, rows):
    want = plain_whitening(rows)
    order = lambda r: (repr(r[0]), r[1], r[3], round(abs(r[4]), 5))
    got = sorted(((r.vec_id, r.component, r.n, r.deviation, abs(r.whitened), r.explained) for r in got), key=order)
    want = sorted(want, key=order)
    assert [r[:4] for r in got] == [r[:4] for r in want]
    for a, b in zip(got, want):
        assert a[4] == pytest.approx(b[4], abs=1e-6) and a[5] == pytest.approx(b[5], rel=1e-8)


def test_whitening_of_a_table(spark):
    table = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    got = queries.QUERIES["op13_whitening"](spark, SF_SMALL).collect()
    assert_whitened(got, [tuple(r) for r in table.select("vec_id", "embedding").collect()])
    assert {r.identity_error for r in got} == {got[0].identity_error} and got[0].identity_error < 1e-10
    first = np.array([r.whitened for r in got if r.component == 1])
    assert abs(first.mean()) < 1e-9 and abs((first ** 2).mean() - 1) < 1e-9


def test_whitening_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rng = np.random.default_rng(3)
    rows = [(i, [float(c) for c in rng.normal(3, 2, 3) * [1, 5, .1]]) for i in range(40)]
    rows += [(None, rows[0][1]), (7, rows[7][1]), (50, None), (51, []), (52, [1.0, None, 2.0]), (53, [nan, 1.0, 1.0]),
             (54, [1.0, inf, 0.0]), (60, [1.0, 2.0]), (61, [1.0, 2.0]), (70, [5.0]), (71, [7.0]), (72, [9.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("n", F.lit("x")).withColumn("x", F.lit(1))
    got = whitening.whitening_report(df).collect()
    assert_whitened(got, rows)
    assert {r.vec_id for r in got} >= {None, 70, 71, 72} and not {60, 61, 50, 51} & {r.vec_id for r in got}
    assert whitening.whitening_report(df.limit(0)).count() == 0
    with pytest.raises(Exception, match="too large for exact"):
        whitening.whitening_report(spark.createDataFrame([(1, [1e300])], df.select("vec_id", "embedding").schema)).collect()
    with pytest.raises(Exception, match="too large for exact"):
        whitening.whitening_report(spark.createDataFrame([(1, [6e16]), (2, [3.0])], df.select("vec_id", "embedding").schema)).collect()


def test_deviation_beyond_a_long(spark):
    rows = [(1, [0.0, 1e8]), (2, [1e8, 0.0]), (3, [3e7, 5e8])]
    got = whitening.whitening_report(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    want = {i: dev for i, _, _, dev, _, _ in plain_whitening(rows)}
    assert all(int(r.deviation_exact) == want[r.vec_id] for r in got)
    assert all(r.deviation == (want[r.vec_id] if want[r.vec_id] < 2 ** 63 else None) for r in got)
    assert any(r.deviation is None for r in got)


def test_feast_against_a_dense_solver():
    rng = np.random.default_rng(0)
    for d, n in ((1, 9), (2, 9), (40, 500), (64, 20), (130, 400)):
        x = rng.standard_normal((n, d)) * np.geomspace(.01, 10, d)
        cov = np.cov(x.T, bias=True).reshape(d, d)
        values, vectors = whitening.leading(cov)
        want = np.linalg.eigvalsh(cov)[::-1][:32]
        assert np.allclose(values, want[:len(values)], rtol=1e-9, atol=1e-13 * want[0])
        assert np.abs(cov @ vectors - vectors * values).max() <= 1e-12 * want[0]
        assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-13
        for shift in (want[0] * 1.1, want[0] * .37, 0.0):
            assert whitening.count_below(cov, shift) == (np.linalg.eigvalsh(cov) < shift).sum() or shift == 0.0
    # equal eigenvalues, more than an interval takes, and none at all
    values, vectors = whitening.leading(np.diag([5.0] * 20 + [1.0] * 44))
    assert np.allclose(values, [5.0] * 20 + [1.0] * 12) and np.abs(vectors.T @ vectors - np.eye(32)).max() < 1e-13
    assert len(whitening.leading(np.zeros((4, 4)))[0]) == 0


@pytest.mark.parametrize("name", ["op11_lexical", "op12_url_filter"])
def test_sql_agrees(spark, name):
    from liftlens.llm.oracle import ORACLE
    assert compare(spark, SF_SMALL, name, queries.QUERIES[name], ORACLE[name])["status"] == "exact"
