"""Vector search, HTML extraction, URL filter and WARC revisits on small and odd tables."""

import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_DIR
from ratestar.llm import html_extract, one_bit_search, url_filter, warc_revisits

# Vectors


def exact(rows, asks, k):
    """{query: [(id, score)]} by comparing all, in double precision from left to right."""
    good = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            good.setdefault(i, v)
    out = {}
    for q in (i for i in good if asks(i)):
        scores = []
        for i, v in good.items():
            if i != q and len(v) == len(good[q]):
                total = 0.0
                for a, b in zip(good[q], v):
                    total += float(np.float32(a)) * float(np.float32(b))
                scores.append((-total, i))
        if scores:
            out[q] = [(i, -s) for s, i in sorted(scores)[:k]]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert len(out[r["query_id"]]) == r["rank"]
    return out


def test_neighbours_of_odd_rows(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(np.float32(x)) for x in rng.standard_normal(12) * 10.0 ** rng.integers(-3, 4)]) for i in range(90)]
    rows += [(200 + i, rows[5][1]) for i in range(30)] + [(5, rows[5][1])] * 3
    rows += [(300, None), (301, []), (302, [0.0] * 12), (303, [1.0] * 11 + [None]), (304, [1.0] * 11 + [float("nan")]),
             (305, [float("inf")] * 12), (None, [1.0] * 12), (310, [1.0] * 7)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("id", F.lit("x")).withColumn("score", F.lit("y"))
    want = exact(rows[:-1], lambda i: i % 5 == 0, 8)
    for blocks in ({}, {"row_block": 16, "query_block": 4}):
        got = found(one_bit_search.nearest(df, F.col("vec_id") % 5 == 0, k=8, **blocks))
        assert got == want
    few = found(one_bit_search.nearest(df.where("vec_id < 4"), F.lit(True), k=8))
    assert few == exact(rows[:4], lambda i: True, 8) and all(len(x) == 3 for x in few.values())
    assert one_bit_search.nearest(df.limit(0), F.lit(True)).count() == 0


def test_repeated_rows_take_no_places(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(np.float32(x)) for x in rng.standard_normal(12)]) for i in range(400)]
    want = exact(rows, lambda i: i % 40 == 0, 20)
    near = {i: rows[i][1] for i in (want[0][0][0], want[40][0][0])}
    twice = rows * 2 + list(near.items()) * 300
    for blocks in ({}, {"row_block": 100, "query_block": 4}):
        df = spark.createDataFrame(twice, "vec_id long, embedding array<float>")
        assert found(one_bit_search.nearest(df, F.col("vec_id") % 40 == 0, **blocks)) == want


def test_an_id_with_many_vectors_takes_one_place(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(np.float32(x)) for x in rng.standard_normal(12)]) for i in range(400)]
    best = exact(rows, lambda i: i == 0, 1)[0][0][0]
    copies = [(best, [float(np.float32(x * (1 + j / 1000))) for x in dict(rows)[best]]) for j in range(1, 300)]
    want = exact([(i, v) for i, v in rows if i != best] + copies[-1:], lambda i: i == 0, 20)
    df = spark.createDataFrame(rows + copies, "vec_id long, embedding array<float>")
    assert found(one_bit_search.nearest(df, F.col("vec_id") == 0)) == want


def test_recall_and_error_bound(spark):
    vectors = spark.read.parquet(SF_DIR.rsplit("/", 1)[0] + "/sf0.1/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in vectors.collect()]
    matrix = np.array([v for _, v in rows], dtype=float)
    got = found(one_bit_search.nearest(vectors, F.col("vec_id") % 20 == 0))
    hits = 0
    for q, neighbours in got.items():
        scores = matrix @ matrix[q]
        scores[q] = -np.inf
        hits += len({i for i, _ in neighbours} & set(np.argsort(-scores)[:20]))
    assert hits / (20 * len(got)) > 0.99 and len(got) == len(rows) // 20
    turn = one_bit_search.Rotation(matrix.shape[1])
    assert turn.bits == one_bit_search.LEAST_BITS and np.allclose(np.linalg.norm(turn(np.eye(64)), axis=1), 1, atol=1e-5)
    codes, length, alignment, turned = one_bit_search.encode(matrix, turn)
    error = one_bit_search.estimates(codes, alignment, turned[::40]) - (matrix / length[:, None]) @ (matrix[::40] / length[::40, None]).T
    width = np.sqrt((1 - alignment ** 2) / (turn.bits - 1)) / alignment
    others = np.abs(error) > 1e-6
    assert abs(error[others].mean()) < 0.01 and (np.abs(error) / width[:, None] < one_bit_search.WIDTH).mean() > 0.99


def test_vectors_of_every_length_take_part(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(np.float32(x)) for x in rng.standard_normal((3, 4, 40)[i % 3])]) for i in range(600)] + [(600, [2.0]), (605, [-1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for blocks in ({}, {"row_block": 50, "query_block": 7}):
        assert found(one_bit_search.nearest(df, F.col("vec_id") % 5 == 0, k=12, width=5.0, **blocks)) == exact(rows, lambda i: i % 5 == 0, 12)


def test_long_and_extreme_vectors(spark, monkeypatch):
    monkeypatch.setattr(one_bit_search, "PART", 50)
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.standard_normal(130) * 10.0 ** (40 * (i % 3 - 1))]) for i in range(300)]
    turn = one_bit_search.Rotation(130)
    units = rng.standard_normal((5, 130))
    assert np.allclose(turn(units) @ turn(units).T, units @ units.T, atol=1e-3)
    got = one_bit_search.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 10 == 0, k=5, width=5.0)
    matrix = np.array([v for _, v in rows])
    for q, own in found(got).items():
        scores = np.cumsum(matrix * matrix[q], axis=1)[:, -1]
        scores[q] = -np.inf
        assert [i for i, _ in own] == np.argsort(-scores)[:5].tolist()


# HTML

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body><header><h1>Site name</h1><p>tagline of the site</p></header>
<div id="cookieNotice">We use cookies to improve things and so on for all of you people out there.</div>
<nav><ul><li><a href=x>Home</a><li><a href=y>More</a></ul></nav>
<div class="layout"><div class="sidebar"><h3>Popular</h3><p>Some long enough sidebar paragraph with text that is quite long, to be sure of it.</p></div>
<div class="post-content"><h1>Title &amp; m&#111;re</h1><p>First <b>para</b>graph
 of   the text.<p>Yes.<script>var a = "<p>no</p>";</script><div class="ad-slot">Buy now the best thing ever made by anyone.</div>
<p hidden>Not shown to anyone at all, ever</p><p>Last one with a <a href="y">link</a> in it, and 1 < 2.</p>
<ul><li>point one</li><li>point two</ul></div></div>
<section class="comments"><h2>Comments</h2><div class="comment"><p>I like this article so much, it is great and all that.</p></div></section>
<form><label>Name</label><input><p>Fill in the form please</p></form><footer><p>Copyright and so on, all rights reserved by us.</p></footer></body></html>"""
TEXT = "Title & more First paragraph of the text. Yes. Last one with a link in it, and 1 < 2. point one point two"


@pytest.mark.parametrize("page, text", [
    (PAGE, TEXT), (None, ""), ("", ""), ("<", ""), ("<p", ""), ("<nav>a</nav>", ""), ("<!-- <article><p>no</p> -->", ""),
    ("<article><h1>A</h1><p>b&nbsp;c &am &lt;d&gt;</p>", "A b c &am <d>"),
    ("<ARTICLE><P>Upper <I>case</I></P><aside>x</aside></ARTICLE>", "Upper case"),
    ("<main><p>one<br>two</p><textarea><p>no</p></textarea><p title='a>b'>three</p></main>", "one two three"),
    ("<article><header><h1>Head</h1></header><p>text</p><section id=comments><article><p>a reader's view</p></article></section></article>", "Head text")])
def test_main_text(page, text):
    assert html_extract.main_text(page) == text


@pytest.mark.parametrize("tag", ["<svg/>", '<SVG class="icon" />', "<math />", "<svg><path/></svg>"])
def test_self_closed_elements_hide_nothing(tag):
    assert html_extract.main_text(f"<div>{tag}</div><article><p>text of it</p></article>") == "text of it"


def test_deep_and_long_pages():
    assert html_extract.main_text("<div>" * 3000 + "<article><p>deep text</p></article>") == "deep text"
    many = html_extract.main_text("<article>" + "<p>some words here</p>" * 20_000 + "</article>")
    assert many.count("some words here") == 20_000
    assert html_extract.main_text("<a " * 20_000) == "" and html_extract.main_text("<p \"" * 20_000) == ""


LONG = "This is a sentence of an ordinary paragraph, with a clause or two and an end. " * 4


@pytest.mark.parametrize("page, text", [
    # Names of the article, or of its paragraphs, that also name boilerplate.
    ('<body><nav><a href=x>Home</a></nav><article class="search-result print"><p>First words of it.</p><p>More.</p></article></body>', "First words of it. More."),
    ('<div class="post-content tags-on"><p>First words of the post, and some more of them.</p></div>', "First words of the post, and some more of them."),
    ('<article><p>One thing is said.</p><p class="more">Then another one.</p><p id="side-effects">And side effects.</p></article>',
     "One thing is said. Then another one. And side effects."),
    (f'<article><p>Start.</p><p class="ad">{LONG}</p><div class="ad">Buy now!</div></article>', "Start. " + " ".join(LONG.split())),
    # An element that holds the whole text is not boilerplate for its name alone, nor is a form around the page.
    (f'<body><div class="sidebar"><p>{LONG}</p><p>{LONG}</p></div></body>', " ".join((LONG + LONG).split())),
    (f'<body><form id="aspnetForm"><div class="nav"><a href=x>a</a> <a href=y>b</a></div><p>{LONG}</p><p>{LONG}</p></form></body>', " ".join((LONG + LONG).split())),
    # Without <article>: names, links and places in the tree.
    (f'<body><div id="header"><a href="/">Site</a></div><div class="main-content"><h1>Title of it</h1><p>{LONG}</p><p>Short one.</p></div>'
     f'<div class="sidebar"><h3>Popular</h3><p>{LONG}</p></div><div id="comments"><h3>Comments</h3><div class="comment"><p>{LONG}</p></div></div>'
     '<div class="site-footer"><p>Copyright, all rights reserved by whoever wrote it.</p></div></body>', "Title of it " + " ".join((LONG + "Short one.").split())),
    (f'<body><table><tr><td><a href=1>One</a><br><a href=2>Two</a><br><a href=3>Three</a></td><td><p>{LONG}</p><p>{LONG}</p></td></tr></table></body>',
     " ".join((LONG + LONG).split())),
    (f'<body><ul class="menu"><li><a href=1>One</a><li><a href=2>Two</a></ul><div><h1>Head</h1>{LONG}<p>{LONG}</p></div><ul class="pagination"><li><a href=3>3</a></ul></body>',
     "Head " + " ".join((LONG + LONG).split())),
    (f'<body><div role="main"><p>{LONG}</p></div><div role="navigation"><p>Go to one of many places from here, please.</p></div><div style="display: none"><p>{LONG}</p></div></body>',
     " ".join(LONG.split())),
    (f'<body><div class="story"><p>Short story, all of it is here, really, not more than that.</p></div><div class="comments"><p>{LONG}</p><p>{LONG}</p><p>{LONG}</p></div></body>',
     "Short story, all of it is here, really, not more than that.")])
def test_no_single_name_decides(page, text):
    assert html_extract.main_text(page) == text


@pytest.mark.parametrize("page", [
    "<article " + "a" * 2_000_000 + "><p>kept text</p></article>",
    "<article " + "ab " * 600_000 + "><p>kept text</p></article>",
    "<article a" + " " * 2_000_000 + "><p>kept text</p></article>",
    "<div>" * 100_000 + "</span></section>" * 100_000 + "<article><p>kept text</p></article>",
    "<x>" * 100_000 + "<y>" * 100_000 + "<article><p>kept text</p></article>",
    "<li><div>" * 80_000 + "<article><p>kept text</p></article>",
    "<article>" + ("<div>" * 500 + "<p>a" + "</div>" * 500) * 500 + "<p>kept text</p></article>",
    "<article>" + "<p class='x y z'>some words of it, <a href=x>linked</a></p>" * 35_000 + "<p>kept text</p></article>"],
    ids=["long name", "many names", "blanks", "stray ends", "unknown elements", "items", "deep blocks", "many blocks"])
def test_parsing_is_linear(page):
    begun = time.process_time()
    found = html_extract.main_text(page)
    assert found.endswith("kept text") and time.process_time() - begun < 8 * len(page) / 2e6 + 2


def test_articles_of_the_table_are_found_whole(spark):
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet")
    inner = F.regexp_extract("html", "(?s)<article>(.*?)(</article>|$)", 1)
    plain = F.regexp_replace(F.regexp_replace(inner, "</?[a-z0-9]+[^>]*>", " "), "&amp;?", "&")
    want = F.trim(F.regexp_replace(F.regexp_replace(F.regexp_replace(plain, "&quot;?", '"'), r"\s+", " "), "^ ", ""))
    both = html_extract.extract(pages.withColumn("want", want).withColumn("text", F.lit("other")))
    assert both.where("text <> want").count() == 0 and both.count() == pages.count()
    assert html_extract.extract(pages.limit(0)).count() == 0


# URLs

def pages_frame(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit("x")).withColumn("salt", F.lit(1)).withColumn("rule", F.lit(2))


def test_rules_hosts_and_paths(spark):
    cases = [
        ("http://EXAMPLE.org/es/1", "example.org", "/es/1", "example.org/es/", "block"), ("https://a.example.org/en/15?x#y", "a.example.org", "/en/15", "example.org/en/1", "block"),
        ("http://badexample.org/es/1", "badexample.org", "/es/1", "org/", "allow"), ("x://org/z", "org", "/z", "org/", "allow"),
        ("http://example.com/fr/", "example.com", "/fr/", "com/fr/", "allow"), ("http://b.com/de/?q=http://c", "b.com", "/de/", "com/de/", "block"),
        ("http://example.org?x=/es/", "example.org", "", None, "block"), ("http://Ä.NET:80/Fr/#x", "Ä.net:80", "/Fr/", None, "allow"),
        (None, "", "", None, "allow"), ("no separator/com/fr/", "", "", None, "allow"), ("http://", "", "", None, "allow"), ("a://b://c/d", "b:", "//c/d", None, "allow")]
    rows = [(i if i else None, c[0], None) for i, c in enumerate(cases)] + [(1, cases[1][0], "<p>x</p>")]
    got = url_filter.judge_urls(pages_frame(spark, rows)).collect()
    assert sorted((r["page_id"] or 0, r["host"], r["path"], r["rule"], r["verdict"]) for r in got) == sorted(
        [(i, *c[1:]) for i, c in enumerate(cases)] + [(1, *cases[1][1:])], key=lambda x: (x[0], x[1]))
    assert url_filter.judge_urls(pages_frame(spark, [])).count() == 0
    # Beyond what one expression holds the rules are a table.
    more = url_filter.RULES + tuple(url_filter.Rule("block", f"h{i}.net/") for i in range(url_filter.MOST_IN_EXPRESSION))
    again = url_filter.judge_urls(pages_frame(spark, rows + [(99, "http://a.h7.net/x", None)]), more).collect()
    assert sorted((r["page_id"] or 0, r["rule"], r["verdict"]) for r in again if r["page_id"] != 99 and r["rule"]) == sorted(
        (r["page_id"] or 0, r["rule"], r["verdict"]) for r in got if r["rule"])
    assert [(r["rule"], r["verdict"]) for r in again if r["page_id"] == 99] == [("h7.net/", "block")]


def test_walks_agree_with_matrix_powers(spark):
    rng = random.Random(4)
    hosts = [f"h{i}" for i in range(30)]
    links = sorted({(a, b) for a in hosts for b in hosts if a != b and rng.random() < (0.9 if a == "h0" else 0.08)})
    edges = spark.createDataFrame([("allow", a, b) for a, b in links] + [("block", b, a) for a, b in links], "kind string, src string, dst string")
    seeds = spark.createDataFrame([("allow", "h0", 0.75), ("allow", "h3", 0.25), ("block", "h7", 1.0)], "kind string, host string, mass double")
    got = {(r["kind"], r["host"]): r["score"] for r in url_filter.propagate(seeds, edges).collect()}
    for kind, start, turn in (("allow", {"h0": 0.75, "h3": 0.25}, False), ("block", {"h7": 1.0}, True)):
        step = np.zeros((30, 30))
        for a, b in links:
            step[hosts.index(a if turn else b), hosts.index(b if turn else a)] = 1
        step = step / np.maximum(step.sum(axis=0), 1) * url_filter.DAMPING
        mass = np.array([start.get(h, 0.0) for h in hosts])
        total = mass.copy()
        for _ in range(url_filter.STEPS):
            mass = step @ mass
            total += mass
        for h, value in zip(hosts, total * (1 - url_filter.DAMPING)):
            assert abs(got.get((kind, h), 0.0) - value) < 1e-9


def test_distrust_runs_against_links(spark):
    link = '<a href="http://{}/x">l</a>'
    rows = [(1, "http://shop.com/de/1", ""), (2, "http://farm.net/a", link.format("shop.com")), (3, "http://good.org/a", link.format("friend.net")),
            (4, "http://friend.net/b", ""), (5, "http://lone.net/", link.format("LONE.net"))]
    got = {r["page_id"]: r["verdict"] for r in url_filter.judge_urls(pages_frame(spark, rows)).collect()}
    assert got == {1: "block", 2: "block", 3: "allow", 4: "allow", 5: "allow"}


def test_url_filter_is_native(spark):
    plan = url_filter.op6_url_filter(spark, SF_DIR)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan and "CartesianProduct" not in plan


# Web archives

@pytest.mark.parametrize("url, canonical", [
    ("HTTP://www.Example.com:80?utm_source=x#f", "example.com/"), ("https://a.com:443/P?b=2&a=1&&ref=q", "a.com/P?a=1&b=2"), ("https://a.com:8080/?reference=1", "a.com:8080/?reference=1"),
    ("nothing", None), (None, None)])
def test_canonical_urls(spark, url, canonical):
    row = spark.createDataFrame([(url,)], "url string").select(warc_revisits.canonical_url(F.col("url")).alias("c")).first()
    assert row["c"] == canonical


def resolve(records):
    """{record: (source, outcome, headers, digest)} one record after the other."""
    full = [r for r in records if r["kind"] == "response" and r["status"] == 200 and r["ts"] is not None and r["key"] is not None]
    out = []
    for r in records:
        if r["kind"] != "revisit":
            continue
        early = [f for f in full if r["ts"] is not None and f["key"] == r["key"] and f["ts"] < r["ts"]]
        source = max(early, key=lambda f: (f["ts"], f["record_id"]), default=None)
        own, outcome = r["headers"] or {}, "resolved"
        if source is None:
            outcome = "no earlier response"
        elif "etag" in own:
            if own["etag"].removeprefix("W/") != (source["headers"] or {}).get("etag", "?").removeprefix("W/"):
                outcome = "etag differs"
        elif "last-modified" in own:
            if own["last-modified"] != (source["headers"] or {}).get("last-modified"):
                outcome = "last-modified differs"
        elif r["payload_digest"] and source["payload_digest"] and r["payload_digest"] != source["payload_digest"]:
            outcome = "digest differs"
        good = outcome == "resolved"
        headers = {**(source["headers"] or {}), **{k: v for k, v in own.items() if k in warc_revisits.PERMITTED}} if good else None
        out.append((r["record_id"], source and source["record_id"], outcome, headers, source["payload_digest"] if good else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("block_rows", [1, 7, 8192])
def test_revisits_against_a_plain_loop(spark, block_rows):
    rng, records = random.Random(block_rows), []
    for i in range(500):
        url = rng.choice(["http://hot.com/"] * 5 + ["https://www.a.com/x?utm_id=1", "http://b.com/y#z", None, "odd"])
        key = {"http://hot.com/": "hot", "https://www.a.com/x?utm_id=1": "a", "http://b.com/y#z": "b"}.get(url)
        headers = rng.choice([None, {}, {"etag": '"1"', "date": "d1"}, {"etag": 'W/"1"', "content-type": "t"}, {"etag": '"2"'},
                              {"last-modified": "m", "vary": "v"}, {"last-modified": "n", "content-length": "5"}])
        records.append(dict(record_id=i, url=url, key=key, ts=rng.choice([None] + [rng.randrange(60)] * 9), kind=rng.choice(["response", "revisit", "revisit", "request", None]),
                            status=rng.choice([200, 200, 200, 304, 404, None]), headers=headers, payload_digest=rng.choice([None, "p", "q"])))
    records.append(dict(next(r for r in records if r["kind"] == "revisit")))
    schema = "record_id long, url string, key string, ts long, kind string, status int, headers map<string,string>, payload_digest string"
    df = spark.createDataFrame([tuple(r[k] for k in r) for r in records], schema).withColumn("span", F.lit("x")).withColumn("place", F.lit("y"))
    got = [(r["record_id"], r["refers_to"], r["outcome"], r["headers"], r["payload_digest"]) for r in warc_revisits.resolve_revisits(df, block_rows).collect()]
    assert sorted(got, key=str) == sorted(resolve(records), key=str)
    assert warc_revisits.resolve_revisits(df.limit(0), block_rows).count() == 0


def test_a_third_of_the_records_on_one_url_and_time_is_spread(spark):
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        i = F.col("id")
        records = spark.range(240_000).select(
            i.alias("record_id"), F.when(i % 3 == 0, "http://hot.com/").when(i % 3 == 1, F.concat(F.lit("http://h"), i % 5000, F.lit(".com/"))).alias("url"),
            F.when(i % 3 == 0, 5).otherwise(i % 100).alias("ts"), F.when(i % 6 == 0, "response").otherwise("revisit").alias("kind"), F.lit(200).alias("status"),
            F.create_map(F.lit("date"), F.lit("d")).alias("headers"), F.lit("p").alias("payload_digest"))
        found = warc_revisits.resolve_revisits(records, 1000)
        placed = found.where("canonical_url IS NOT NULL")
        sizes = [r["count"] for r in placed.groupBy(F.spark_partition_id()).count().collect()]
        assert max(sizes) <= 2 * sum(sizes) / len(sizes)
        assert found.count() == 200_000 and found.where("canonical_url IS NULL AND outcome <> 'no earlier response'").isEmpty()
    finally:
        spark.conf.set(key, before)


def test_many_rules_are_looked_up_in_a_table(spark, monkeypatch):
    rng = random.Random(8)
    hosts = ["com", "a.com", "b.a.com", "org", "x.org", "a", "", "co.uk", "ba.com"]
    paths = ["", "/", "/en", "/en/", "/en/1", "/EN/"]
    rules = tuple(url_filter.Rule(rng.choice(["allow", "block"]), rng.choice(hosts) + rng.choice(paths[1:])) for _ in range(25))
    rules += (url_filter.Rule("block", "org"), url_filter.Rule("allow", "x.org/"), url_filter.Rule("block", "x.org/"))
    rows = [(i, rng.choice(["http://", "https://", "", "://"]) + rng.choice(hosts + ["www.A.com", "deep.b.a.com", "xa.com", ".com", "com."]) + rng.choice(paths + ["/en/12?x", "#f"]), None)
            for i in range(400)] + [(None, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    one = url_filter.judge_urls(pages, rules).select("page_id", "host", "path", "rule", "verdict")
    monkeypatch.setattr(url_filter, "MOST_IN_EXPRESSION", 3)
    many = url_filter.judge_urls(pages, rules).select("page_id", "host", "path", "rule", "verdict")
    assert sorted(map(str, one.collect())) == sorted(map(str, many.collect())) and many.where("rule IS NOT NULL").count() > 100
    plan = many._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
