import random
import re
import urllib.parse
from collections import defaultdict

import duckdb
import pyarrow as pa
import pytest

from quadrille.llm.queries import OP8_SQL
from quadrille.llm.url_filter import RULES, filter_urls

SCHEMA = "page_id bigint, url string, html string, node string, host string, own string"


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def rule(host, path):
    fits = [(len(h) + len(p), h + p, v) for v, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


def canonical(to):
    return f'<html><LINK href="{to}" rel="canonical"><p>x</p>'


def refresh(to):
    return f"<meta http-equiv='Refresh' content='0; url={to}'>"


CASES = [
    (1, "http://a.example.com/en/5", None),  # blocked
    (2, "http://a.example.com/en/77?x#y", ""),  # allowed by the longer rule
    (3, "https://WWW.Example.NET/de/81", "x"),
    (4, "https://www.example.net/de/9", "x"),
    (5, "http://b.org/es/", "x"),
    (6, "http://borg/es/", "x"),
    (7, "http://mirror.xyz/1", canonical("http://a.example.com/en/5")),  # takes the block
    (8, "http://mirror.xyz/2", refresh("//mirror.xyz/1")),  # by way of 7
    (9, "http://mirror.xyz/3", refresh("/2")),  # by way of 8
    (10, "http://free.xyz/1", canonical("http://b.org/es/2")),  # blocked and allowed addresses meet
    (11, "http://free.xyz/2", canonical("http://free.xyz/1")),
    (12, "https://q.net/de/ok", canonical("http://free.xyz/1")),
    (13, "http://lone.xyz/", canonical("http://lone.xyz/")),
    (14, None, canonical("http://b.org/es/2")),
    (15, "no scheme", canonical("http://b.org/es/2")),
    (16, "http://", None),
    (17, "a://b://c/d?e", None),
    (18, "http://new\nline.org/es/1", None),
    (None, "http://b.org/es/9", None),
    (1, "http://a.example.com/en/5", None),
    (19, "http://logged.xyz/x", None),
]


def test_against_brute_force(spark):
    pages = spark.createDataFrame([(*r, "n", "h", "o") for r in CASES], SCHEMA)
    redirects = spark.createDataFrame([("http://logged.xyz/x", "http://a.example.com/en/5"), (None, "http://b.org/es/1"), ("x", "y")], "from_url string, to_url string")
    want = {i: "block" for i in (7, 8, 9, 19)}
    found = filter_urls(pages, redirects=redirects).collect()
    assert len(found) == len(CASES)
    urls = {r[0]: r[1] for r in CASES}
    for r in found:
        host, path = parts(urls[r["page_id"]])
        named, verdict = rule(host, path)
        assert (r["host"], r["path"], r["rule"]) == (host, path, named), r
        assert r["verdict"] == (verdict or want.get(r["page_id"], "allow")), r


def test_without_links_and_empty(spark):
    pages = spark.createDataFrame([(*r, "n", "h", "o") for r in CASES], SCHEMA)
    found = {r["page_id"]: r["verdict"] for r in filter_urls(pages, html_col=None).collect()}
    assert found[7] == "allow" and found[5] == "block"
    assert filter_urls(pages.limit(0)).collect() == []


def test_targets_relative_to_the_page(spark):
    cases = [
        (1, "http://shop.xyz/a/home.html", canonical("http://a.example.com/en/5"), "block"),
        (2, "http://shop.xyz/a/b/x?q=/z/", refresh("../home.html"), "block"),
        (3, "HTTP://Shop.xyz", canonical("a/./home.html#f"), "block"),
        (4, "http://shop.xyz/a/", refresh("home.html"), "block"),
        (5, "http://shop.xyz/a/q#/r", refresh("../../b/../a/home.html"), "block"),
        (6, "http://shop.xyz/a/home.html/y", canonical(".."), "block"),  # the folder, 4
        (7, "http://shop.xyz/free", canonical("?x=home.html"), "allow"),
        (8, "http://shop.xyz/a/mail", refresh("mailto:home.html"), "allow"),
        (9, "http://shop.xyz/a/z", canonical("home.html/."), "allow"),
        (10, "http://other.xyz/a/z", refresh("home.html"), "allow"),
    ]
    pages = spark.createDataFrame([(*r[:3], "n", "h", "o") for r in cases], SCHEMA)
    assert {r["page_id"]: r["verdict"] for r in filter_urls(pages).collect()} == {r[0]: r[3] for r in cases}


def with_base(base, to):
    return f'<head><base href="{base}"><base href="/no/"></head>' + canonical(to)


def test_base_elements_and_queries(spark):
    cases = [
        (1, "http://q.xyz/p?id=1", canonical("http://a.example.com/en/5"), "block"),
        (2, "http://q.xyz/p?id=2", None, "allow"),  # another page than 1
        (3, "http://q.xyz/p", None, "allow"),
        (4, "http://q.xyz/r", canonical("p?id=1&amp;"), "allow"),
        (5, "http://q.xyz/r/s?x", refresh("../p?id=1#top"), "block"),
        (6, "http://q.xyz/else", canonical("?id=1"), "allow"),
        (7, "http://m.xyz/a", with_base("http://q.xyz/z/", "../p?id=1"), "block"),
        (8, "http://m.xyz/b/c", with_base("/b/d/", "../../a"), "block"),
        (9, "http://m.xyz/b/e", with_base("x/", "../../a"), "block"),
        (10, "http://m.xyz/b/e/f", with_base("?y", "#part"), "allow"),
        (11, "http://root.xyz", canonical("http://m.xyz/a"), "block"),
        (12, "http://root.xyz/", None, "block"),
        (13, "http://root.xyz/?", None, "allow"),
        (14, "http://m.xyz/up", canonical("/b/.././a"), "block"),
    ]
    pages = spark.createDataFrame([(*r[:3], "n", "h", "o") for r in cases], SCHEMA)
    assert {r["page_id"]: r["verdict"] for r in filter_urls(pages).collect()} == {r[0]: r[3] for r in cases}


def made_pages(seed):
    """Chains, hubs and rings of pages, linked in every way, some to ruled addresses; pages that differ in queries."""
    draw, out = random.Random(seed), []
    urls = [f"http://h{draw.randrange(5)}.xyz/{draw.choice('ab')}/{draw.randrange(40)}{draw.choice(['', '', '?v=1', '?v=2'])}" for _ in range(160)]
    ruled = ["http://a.example.com/en/5", "http://b.org/es/2", "http://a.example.com/en/77", "https://q.net/de/ok", "http://x.example.net/de/81"]
    for i, u in enumerate(urls):
        kind, host = draw.random(), u.split("/")[2]
        if kind < 0.3:
            html = None
        elif kind < 0.4:
            html = canonical(draw.choice(ruled))
        elif kind < 0.6:
            html = canonical(urls[draw.randrange(160)])
        elif kind < 0.7:
            html = refresh(urls[i // 20 * 20])
        elif kind < 0.8:
            html = canonical(draw.choice(["3", "../b/4", "./5?v=1", "?v=2", "/a/6", f"//{host}/a/7", "#x"]))
        elif kind < 0.9:
            html = with_base(draw.choice(["/b/", "../a/x", "//h1.xyz/a/", "?z"]), draw.choice(["8", "../b/9", "?v=1"]))
        else:
            html = refresh("mailto:x@y.org")
        out.append((i, u, html))
    return out + [(500 + i, u, None) for i, u in enumerate(ruled)]


def plain_verdicts(pages):
    def node(u):
        parts = urllib.parse.urlsplit(u)
        return (parts.netloc.lower(), parts.path or "/", u.split("#")[0].partition("?")[1:]) if "://" in u and parts.netloc else None

    group, urls = {}, defaultdict(set)

    def find(x):
        while group.setdefault(x, x) != x:
            x = group[x]
        return x

    for _, u, html in pages:
        for to in re.findall(r"""(?:rel="canonical"|url=)""", html or "") and re.findall(r"""LINK href="([^"]*)"|url=([^']*)'""", html):
            base = re.search(r"""base href="([^"]*)""", html)
            to = urllib.parse.urljoin(urllib.parse.urljoin(u, base[1]) if base else u, to[0] or to[1])
            if node(to):
                urls[node(u)].add(u)
                urls[node(to)].add(to)
                group[find(node(u))] = find(node(to))
    says = defaultdict(set)
    for n, us in urls.items():
        says[find(n)] |= {rule(*parts(u))[1] for u in us}
    out = {}
    for i, u, _ in pages:
        joint = says[find(node(u))] if node(u) in urls else set()
        out[i] = rule(*parts(u))[1] or ("block" if "block" in joint and "allow" not in joint else "allow")
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_made_pages_against_brute_force_and_sql(spark, seed):
    given = made_pages(seed)
    pages = spark.createDataFrame([(*r, "n", "h", "o") for r in given], SCHEMA)
    want = plain_verdicts(given)
    found = filter_urls(pages).collect()
    assert {r["page_id"]: r["verdict"] for r in found} == want
    assert {"allow", "block"} == {want[r[0]] for r in given if not rule(*parts(r[1]))[1]}
    con = duckdb.connect()
    con.register("pages", pa.table({"page_id": [r[0] for r in given], "url": [r[1] for r in given], "html": pa.array([r[2] for r in given], pa.string())}))
    rows = con.execute(OP8_SQL).fetchall()
    assert sorted(rows) == sorted((r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in found)
