"""Top-k search and the URL filter."""

import math
import random

import duckdb
import edge
import numpy as np
import pyarrow as pa
import pytest

from cartwright.llm import queries, topk_search, url_filter

VECTORS = "vec_id bigint, embedding array<float>, label int, row bigint, v string"


def brute_top(rows, k, every):
    points = []
    for n, (vec_id, vector) in enumerate(rows):
        if vector is not None and all(x is not None and math.isfinite(x) for x in vector):
            points.append((n, vec_id, [math.floor(64 * float(np.float32(x))) for x in vector]))
    out = []
    for n, vec_id, query in points:
        if vec_id is None or vec_id % every:
            continue
        scored = [(-sum(a * b for a, b in zip(query, other, strict=False)), i is None, i or 0) for m, i, other in points if m != n]
        for rank, (score, missing, i) in enumerate(sorted(scored)[:k], 1):
            out.append((vec_id, rank, None if missing else i, -score))
    return sorted(out, key=lambda row: (row[0], row[1], row[3], row[2] is None, row[2] or 0))


def found_top(df):
    rows = [tuple(row) for row in df.select("query_id", "rank", "vec_id", "score").collect()]
    return sorted(rows, key=lambda row: (row[0], row[1], row[3], row[2] is None, row[2] or 0))


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, 1, "x") for i, v in rows], VECTORS).repartition(3)


def clustered(count, width, seed):
    chance = np.random.default_rng(seed)
    centres = chance.normal(size=(6, width))
    return [(i, (centres[i % 6] + 0.3 * chance.normal(size=width)).tolist()) for i in range(count)]


@pytest.mark.parametrize("shard, block, leaf", [(16_384, 2_048, 256), (60, 7, 8)])
def test_search_equals_brute_force(spark, monkeypatch, shard, block, leaf):
    monkeypatch.setattr(topk_search, "SHARD_ROWS", shard)
    monkeypatch.setattr(topk_search, "BLOCK_QUERIES", block)
    monkeypatch.setattr(topk_search.Tree.__init__, "__defaults__", (leaf,))
    rows = clustered(300, 8, 2)
    rows += [(1000 + i, rows[i % 40][1]) for i in range(60)]
    assert found_top(topk_search.top_k(frame(spark, rows))) == brute_top(rows, 20, 20)


def test_search_with_awkward_vectors(spark):
    bad = [None, [1.0, None], [float("nan"), 1.0], [float("inf"), 0.0], []]
    rows = [(20 * i, v) for i, v in enumerate(bad)] + [(None, [0.5, 0.5]), (200, [0.5, -0.5]), (200, [0.5, -0.5]), (201, [3.0]), (220, [0.0, 0.0])]
    assert found_top(topk_search.top_k(frame(spark, rows), k=3)) == brute_top(rows, 3, 20)
    huge = [(0, [1e7, 1.0]), (1, [-1e4, 2.5]), (2, [7e5, 7e5])]
    assert found_top(topk_search.top_k(frame(spark, huge))) == brute_top(huge, 20, 20)
    assert topk_search.top_k(frame(spark, [])).count() == 0


def test_tree_bounds_hold():
    chance = np.random.default_rng(3)
    points = chance.integers(-50, 50, (500, 6))
    tree = topk_search.Tree(points, 16)
    queries = chance.integers(-50, 50, (20, 6))
    bounds = tree.bounds(queries)
    for node, (begin, end) in enumerate(tree.spans):
        best = (queries @ points[tree.order[begin:end]].T).max(axis=1)
        assert (best <= bounds[:, node]).all()
        if not tree.children[node]:
            assert end - begin <= 16
    assert sorted(tree.order.tolist()) == list(range(500))


PAGES = "page_id bigint, url string, html string, host string, rule string, verdict string, pages int"
URLS = [
    (1, "http://a.example.net/en/5?x=1"), (2, "https://EXAMPLE.NET/en/"), (3, "http://x.net"), (4, "http://x.net/"), (5, "http://b.example.com/de/7#top"),
    (6, "http://badexample.com/de/7"), (7, "http://q.org/fr/1/2/3.html"), (8, None), (9, "no scheme/de/"), (10, ""), (11, "://?q"), (11, "://?q"),
    (12, "http://É.Org/fr/x"), (13, "http://notnet/a"), (14, "ftp://net/a://b/c"), (None, "http://h.example/" + "a/" * 300), (15, "http://h.example//double//"),
    (16, "http://h.example/x\ny?z"), (17, "http://example.net/english"),
]


def brute_rule(host, path):
    best = None
    for rule, verdict in url_filter.RULES:
        name, _, start = rule.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith("/" + start) and (best is None or len(rule) > len(best[0])):
            best = (rule, verdict)
    return best or (None, None)


def brute_split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min((rest.find(sign) for sign in "/?#" if sign in rest), default=len(rest))
    host, rest = rest[:end], rest[end:]
    stop = min((rest.find(sign) for sign in "?#" if sign in rest), default=len(rest))
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), rest[:stop]


def pages(spark, rows):
    return spark.createDataFrame([(i, url, "h", "H", "R", "V", 1) for i, url in rows], PAGES).repartition(3)


def test_rules_and_parts_of_awkward_urls(spark):
    found = url_filter.judge_urls(pages(spark, URLS)).collect()
    assert len(found) == len(URLS)
    wanted = {}
    for page_id, url in URLS:
        host, path = brute_split(url)
        wanted[page_id] = (host, path, *brute_rule(host, path))
    for row in found:
        host, path, rule, verdict = wanted[row.page_id]
        assert (row.host, row.path, row.rule) == (host, path, rule)
        assert row.verdict == verdict if verdict else row.verdict in ("allow", "block")
    assert url_filter.judge_urls(pages(spark, [])).count() == 0


def test_templates_follow_their_labels(spark):
    chance = random.Random(1)
    rules = (("ads.site.test/", "block"), ("news.site.test/", "allow"))
    rows = [(i, f"http://ads.site.test/offer/{chance.randint(0, 99)}") for i in range(60)]
    rows += [(100 + i, f"http://news.site.test/story/{i}") for i in range(60)]
    rows += [(200 + i, f"http://other.test/{kind}/{i}") for i in range(20) for kind in ("offer", "story")]
    found = url_filter.judge_urls(pages(spark, rows), rules).collect()
    for row in found:
        assert row.verdict == ("block" if "/offer/" in row.path else "allow")


def test_many_thin_children_become_a_wildcard(spark):
    rows = [(i, f"http://h.test/{name}/page") for i, name in enumerate(f"user-{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60))]
    rows += [(100 + i, "http://k.test/fixed/page") for i in range(60)]
    found = {row.template for row in url_filter.judge_urls(pages(spark, rows)).collect()}
    assert found == {"/*/page", "/fixed/page"}


def people(count, each):
    """(user, slug) pairs of letters only; every slug is its own."""
    def letters(n):
        return "".join(chr(97 + n // 26**i % 26) for i in range(4))

    return [(f"user-{letters(n)}", f"note-{letters(n * each + i)}") for n in range(count) for i in range(each)]


@pytest.mark.parametrize("count, each, copies", [(60, 1, 1), (1000, 5, 1), (200, 2, 4)])
def test_variable_segments_become_wildcards_at_every_size(spark, count, each, copies):
    urls = [f"http://h.test/user/{name}/{slug}" for name, slug in people(count, each) for _ in range(copies)]
    found = {row.template for row in url_filter.judge_urls(pages(spark, list(enumerate(urls)))).collect()}
    assert found == {"/user/*/*"}


def test_labels_reach_pages_below_wildcards(spark):
    rules = (("bad.test/user/user-a", "block"), ("good.test/", "allow"))
    urls = [f"http://bad.test/user/{name}/{slug}" for name, slug in people(400, 5)]
    urls += [f"http://good.test/{i}/{name}" for i, name in enumerate(["story", "offer"] * 400)]
    for row in url_filter.judge_urls(pages(spark, list(enumerate(urls))), rules).collect():
        assert row.verdict == ("block" if row.host == "bad.test" else "allow")


def test_a_large_child_and_one_with_other_labels_stay_beside_a_wildcard(spark):
    rules = (("h.test/ads/", "block"), ("h.test/", "allow"))
    urls = [f"http://h.test/{name}/page" for name, _ in people(300, 1)]
    urls += [f"http://h.test/{name}/{i}" for name, n in (("help", 300), ("ads", 40)) for i in range(n)]
    found = url_filter.judge_urls(pages(spark, list(enumerate(urls))), rules).collect()
    first = {row.path.split("/")[1]: row.template.split("/")[1] for row in found}
    assert first["ads"] == "ads" and first["help"] != "*" and {first[name] for name, _ in people(300, 1)} == {"*"}


def wide_site():
    """Urls with more than MANY children, labels of both kinds, repeated pages, and paths of unequal depth."""
    chance = random.Random(5)
    hosts = ["a.example.net", "shop.example.com", "b.org", "plain.test", "x.net", "long.test"]
    urls = []
    for n in range(1500):
        host, name = chance.choice(hosts), f"u{chr(97 + n % 26)}{chr(97 + n // 26 % 26)}{chr(97 + n // 676)}"
        kind = chance.choice(["en", "de", "fr", "user", "help"])
        tail = chance.choice([name, f"{name}/post", f"page/{n}", "", f"{name}/post/{chance.choice('abc')}"])
        urls += [f"http://{host}/{kind}/{tail}"] * chance.choice([1, 1, 1, 3])
    urls += [f"http://long.test/{'same/' * 40}{end}" for end in ("a", "b", "", "b/c")] + ["http://long.test", "http://long.test/", None, "x"]
    return urls


def test_tree_equals_sql_on_wide_and_deep_sites(spark):
    site = pages(spark, list(enumerate(wide_site())))
    found = edge.rows(url_filter.judge_urls(site), "page_id", "host", "path", "rule", "verdict")
    assert any("*" in row.template for row in url_filter.judge_urls(site).select("template").distinct().collect())
    tables = duckdb.connect()
    tables.register("pages", pa.table({"page_id": list(range(len(wide_site()))), "url": pa.array(wide_site(), pa.string())}))
    wanted = tables.execute(f"SELECT page_id, host, path, rule, verdict FROM ({queries.SQL['op10_url_filter']})").fetchall()
    assert found == sorted(wanted)


def test_shared_segments_cost_no_steps(spark, monkeypatch):
    steps, token = [], url_filter._tokens
    monkeypatch.setattr(url_filter, "_tokens", lambda children: steps.append(1) or token(children))
    rows = [(i, f"http://trap.test/{'loop/' * 500}{end}") for i, end in enumerate("ab")]
    found = {row.template for row in url_filter.judge_urls(pages(spark, rows)).collect()}
    assert len(steps) <= 2 and found == {row[1][len("http://trap.test"):] for row in rows}


def test_filter_runs_no_python(spark):
    plan = url_filter.judge_urls(pages(spark, URLS))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
