import numpy as np
import pytest
from pyspark.sql import functions as F

from martweave.llm import neighbours, url_filter


def clustered(n, seed=1, size=8):
    random = np.random.default_rng(seed)
    centres = random.normal(size=(max(n // 20, 1), size)) * 4
    return centres[random.integers(0, len(centres), n)] + random.normal(size=(n, size)) * 0.3


def exact(ids, vectors, query, k):
    far = np.sqrt(((vectors - vectors[query]) ** 2).sum(axis=1))
    far[ids == ids[query]] = np.inf
    order = np.lexsort((ids, far))[:k]
    return [(int(ids[i]), float(far[i])) for i in order if far[i] < np.inf]


def test_recall_and_exact_scores(spark):
    vectors, ids = clustered(3000), np.arange(3000)
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, vectors)], "vec_id long, embedding array<double>")
    got = {}
    for r in neighbours.search(df.repartition(4), F.col("vec_id") % 100 == 0, sample=1000, leaf=32).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    hits = 0
    for q in range(0, 3000, 100):
        want = exact(ids, vectors, q, 10)
        found = sorted(got[q])
        assert [n for n, _, _ in found] == list(range(1, 11))
        assert [(s, v) for _, v, s in found] == sorted((s, v) for _, v, s in found)
        for _, v, s in found:
            assert s == pytest.approx(np.sqrt(((vectors[v] - vectors[q]) ** 2).sum()), abs=1e-12)
        hits += len({v for v, _ in want} & {v for _, v, _ in found})
    assert hits / 300 >= 0.9


def test_whole_forest_is_exact(spark):
    vectors, ids = clustered(400, 5), np.arange(400)
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, vectors)], "vec_id long, embedding array<double>")
    rows = neighbours.search(df, F.col("vec_id") % 50 == 0, recall=1.0, leaf=400).collect()
    for q in range(0, 400, 50):
        assert [r.vec_id for r in sorted((r for r in rows if r.query_id == q), key=lambda r: r["rank"])] == [
            v for v, _ in exact(ids, vectors, q, 10)
        ]


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 1.0]), (4, None), (5, [0.0, 0.0]), (6, [nan, 1.0]),
        (7, [inf, 1.0]), (8, [None, 1.0]), (9, [1.0]), (None, [1.0, 0.0]), (10, []), (3, [0.0, 1.0]),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("_id", F.lit("x"))
    got = sorted((r.query_id, r["rank"], r.vec_id, round(r.score, 9)) for r in neighbours.search(df, F.col("vec_id") >= 0).collect())
    root = round(2**0.5, 9)
    assert got == [
        (0, 1, 1, 0.0), (0, 2, 2, 0.0), (0, 3, 3, root),
        (1, 1, 0, 0.0), (1, 2, 2, 0.0), (1, 3, 3, root),
        (2, 1, 0, 0.0), (2, 2, 1, 0.0), (2, 3, 3, root),
        (3, 1, 0, root), (3, 2, 1, root), (3, 3, 2, root),
    ]
    assert neighbours.search(df.where("vec_id > 99"), F.lit(True)).collect() == []
    assert neighbours.search(df, F.col("vec_id") > 99).collect() == []


def test_many_equal_vectors_are_split_into_parts(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "PART", 16)
    df = spark.range(300).select(F.col("id").alias("vec_id"), F.array(F.lit(1.0), F.lit(2.0)).alias("embedding"))
    rows = neighbours.search(df, F.col("vec_id").isin(0, 250), leaf=8).collect()
    assert sorted(r.vec_id for r in rows if r.query_id == 250) == list(range(10))
    assert sorted(r.vec_id for r in rows if r.query_id == 0) == list(range(1, 11))


def test_large_norms_keep_ties_and_borders(spark):
    """Far from the origin, squared distances from norms and products are off by far more than the distances differ."""
    random = np.random.default_rng(4)
    for scale, step in ((1e5, 1e-3), (1e8, 1.0), (3e153, 1e150), (1e200, 1e195)):
        vectors = np.round(random.normal(size=(1, 6)) * 64) * scale + random.integers(-3, 4, (300, 6)) * step
        ids = np.arange(300)
        unit = np.abs(vectors).max()
        small = vectors / unit if scale > 1e100 else vectors
        df = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, vectors)], "vec_id long, embedding array<double>")
        rows = neighbours.search(df, F.col("vec_id") % 50 == 0, recall=1.0, leaf=400).collect()
        for q in range(0, 300, 50):
            got = sorted((r["rank"], r.vec_id, r.score) for r in rows if r.query_id == q)
            assert len(got) == 10
            far = np.sqrt(((small - small[q]) ** 2).sum(axis=1)) * (unit if scale > 1e100 else 1)
            assert [s for _, _, s in got] == pytest.approx(sorted(np.delete(far, q))[:10], rel=1e-9)
            for _, v, s in got:
                assert s == pytest.approx(far[v], rel=1e-9)
            if scale < 1e100:
                assert [v for _, v, _ in got] == [v for v, _ in exact(ids, vectors, q, 10)]


PAGES = [
    (1, "http://Shop.Example.COM/en/1?x#y", None),
    (2, "https://www.example.com/en/1", ""),
    (3, "http://a.net/es/1", '<link rel="canonical" href="/de/1">'),
    (4, "https://a.net/de/1#top", "<p>"),
    (5, "http://b.org/x", "<META HTTP-EQUIV='refresh' content='0; url=http://a.net/de/1'>"),
    (6, "http://c.org/", '<link href=//www.example.com/en/9 rel=canonical>'),
    (7, "http://c.org/p", '<link rel="canonical" href="http://c.org/"><link rel="canonical" href="http://example.com/en/z">'),
    (8, None, "x"),
    (9, "no scheme", '<link rel="canonical" href="http://a.net/es/1">'),
    (10, "http://notexample.com/en/1", None),
    (11, "http://example.net", None),
    (12, "ftp://example.com?en/", '<link rel="stylesheet" href="http://a.net/es/1">'),
    (1, "http://Shop.Example.COM/en/1?x#y", None),
]


def test_rules_and_aliases(spark):
    df = spark.createDataFrame([(*p, "r") for p in PAGES], "page_id long, url string, html string, rule string")
    got = sorted(url_filter.filter_urls(df, carry=["page_id"]).collect())
    assert [tuple(r) for r in got] == [
        (1, "shop.example.com", "/en/1", "example.com/en/", "block"),
        (1, "shop.example.com", "/en/1", "example.com/en/", "block"),
        (2, "www.example.com", "/en/1", "www.example.com/en/", "allow"),
        (3, "a.net", "/es/1", "net/es/", "block"),
        (4, "a.net", "/de/1", None, "block"),
        (5, "b.org", "/x", None, "block"),
        (6, "c.org", "/", None, "allow"),  # an allowed alias comes before a blocked one
        (7, "c.org", "/p", None, "allow"),
        (8, "", "", None, "allow"),
        (9, "", "", None, "allow"),
        (10, "notexample.com", "/en/1", "com/", "allow"),
        (11, "example.net", "", None, "allow"),
        (12, "example.com", "", None, "allow"),
    ]


def test_redirect_table_and_no_pages(spark):
    df = spark.createDataFrame([(1, "http://q.org/a", None), (2, "http://q.org/b", None)], "page_id long, url string, html string")
    hops = [("http://q.org/a", "http://r.org/1"), ("https://r.org/1", "http://s.net/fr/"), (None, "http://q.org/b")]
    redirects = spark.createDataFrame(hops, "from_url string, to_url string")
    got = {r.page_id: r.verdict for r in url_filter.filter_urls(df, redirects).collect()}
    assert got == {1: "block", 2: "allow"}
    assert url_filter.filter_urls(df.where("page_id > 9"), redirects).collect() == []


def test_links_without_a_host_join_nothing(spark):
    rows = []
    for n, link in enumerate(["http://", "//", "https:///x", "http://?q", "//#top"]):
        rows += [
            (3 * n, f"http://a{n}.net/es/1", f'<link rel="canonical" href="{link}">'),
            (3 * n + 1, f"http://b{n}.org/x", f'<link rel="canonical" href="{link}">'),
            (3 * n + 2, f"http://c{n}.org/x", f'<meta http-equiv="refresh" content="0; url={link}">'),
        ]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert url_filter.page_links(df).collect() == []
    got = {r.page_id: r.verdict for r in url_filter.filter_urls(df).collect()}
    assert got == {i: "block" if i % 3 == 0 else "allow" for i in range(15)}
