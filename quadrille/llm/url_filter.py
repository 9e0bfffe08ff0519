"""URL filters whose blocks reach the aliases of a page.

A page's own rule decides first.  Addresses that a redirect or a canonical link
joins form components (distributed connected components); a
page without a rule of its own takes the block of a component in which some
address is blocked and none is allowed.  An explicit allow therefore always
takes precedence: on the page itself, and over blocks that would spread.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quadrille.llm._components import connected_components
from quadrille.llm._store import Scratch

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: (verdict, host, path prefix)
RULES = (
    ("block", "com", "/en/"),
    ("allow", "example.com", "/en/7"),
    ("allow", "net", "/de/"),
    ("block", "example.net", "/de/8"),
    ("block", "org", "/es/"),
)


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path); both empty for null and for urls without ``://``."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)$", 1)
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return host, path


def rule_for(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else nulls."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for says, at, under in sorted(rules, key=lambda r: (len(r[1]) + len(r[2]), r[1:])):
        fits = ((host == at) | F.endswith(host, F.lit("." + at))) & F.startswith(path, F.lit(under))
        rule, verdict = F.when(fits, F.lit(at + under)).otherwise(rule), F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def _without_dots(path: Column) -> Column:
    """A path that begins with a slash, its segments ``.`` and ``..`` worked off; ``..`` at the top goes."""
    parts = F.split(path, "/", -1)

    def step(kept: Column, part: Column) -> Column:
        up = F.when(F.size(kept) > 1, F.slice(kept, 1, F.size(kept) - 1)).otherwise(kept)
        return F.when(part == "..", up).when(part == ".", kept).otherwise(F.concat(kept, F.array(part)))

    kept = F.aggregate(parts, F.array().cast("array<string>"), step)
    ends = F.element_at(parts, -1).isin(".", "..")
    return F.array_join(F.concat(kept, F.when(ends, F.array(F.lit(""))).otherwise(F.array().cast("array<string>"))), "/")


def address(url: Column) -> Column:
    """What a url is known by: host, path and query; a path left out is the root.  Empty without a host."""
    host, path = url_parts(url)
    query = F.regexp_extract(url, r"(?s)^.*?://[^?#]*(\?[^#]*)", 1)
    return F.when(host != "", F.concat(host, F.when(path == "", F.lit("/")).otherwise(path), query)).otherwise(F.lit(""))


def resolve(base: Column, target: Column) -> Column:
    """An absolute url for a reference found in a document whose base is ``base``."""
    scheme = F.regexp_extract(base, r"(?s)^(.*?)://", 1)
    site = F.regexp_extract(base, r"(?s)^.*?://[^/?#]*", 0)
    _, path = url_parts(base)
    own_query = F.regexp_extract(base, r"(?s)^.*?://[^?#]*(\?[^#]*)", 1)
    # Up to the last slash; a page without a path lies in the site's root.
    folder = F.when(path == "", F.lit("/")).otherwise(F.regexp_extract(path, r"(?s)^.*/", 0))
    place = F.regexp_extract(target, r"^[^?#]*", 0)
    rest = F.regexp_extract(target, r"^[^?#]*(.*)$", 1)
    return (
        F.when(F.startswith(target, F.lit("//")), F.concat(scheme, F.lit(":"), target))
        .when(F.startswith(target, F.lit("/")), F.concat(site, _without_dots(place), rest))
        .when(F.regexp_like(target, F.lit(r"^[A-Za-z][A-Za-z0-9+.-]*:")), target)
        .when(F.startswith(target, F.lit("?")), F.concat(site, path, target))
        .when(F.startswith(target, F.lit("#")), F.concat(site, path, own_query, target))
        .otherwise(F.concat(site, _without_dots(F.concat(folder, place)), rest))
    )


def _links(html: Column) -> tuple[Column, Column]:
    """(the href of the first base element or null, references that the page names as its canonical form or sends the reader to)."""
    tags = F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(r"(?i)<(?:link|meta|base)\b[^>]*>"), F.lit(0))
    of = lambda pattern: F.filter(tags, lambda t: F.regexp_like(t, F.lit(pattern)))
    plain = lambda t: F.replace(t, F.lit("&amp;"), F.lit("&"))
    href = lambda t: plain(F.regexp_extract(t, r"""(?i)\bhref\s*=\s*["']?\s*([^"'\s>]+)""", 1))
    base = F.filter(F.transform(of(r"(?i)^<base\b"), href), lambda t: t != "")
    canonical = of(r"""(?i)^<link\b[^>]*\brel\s*=\s*["']?canonical\b""")
    refresh = of(r"""(?i)^<meta\b[^>]*\bhttp-equiv\s*=\s*["']?refresh\b""")
    target = lambda t: plain(F.regexp_extract(t, r"""(?i)\burl\s*=\s*["']?\s*([^"'\s>]+)""", 1))
    found = F.concat(F.transform(canonical, href), F.transform(refresh, target))
    return F.get(base, F.lit(0)), F.filter(found, lambda t: t != "")


def filter_urls(
    pages: DataFrame,
    *,
    rules: Sequence[tuple[str, str, str]] = RULES,
    redirects: DataFrame | None = None,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str | None = "html",
) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict.

    ``redirects`` may add edges ``(from_url, to_url)``, as a crawl log has them;
    ``html_col=None`` leaves canonical links and refreshes out.  An address is
    the url's host, path and query, so pages that differ in their queries are
    different pages; rules read host and path alone.  References are resolved
    against the page's url, or its first ``base`` element.  Pages with a null
    url, or one without ``://``, have an empty host and path, no rule and no
    aliases, and are allowed.  Null html has no links.  Urls and pages of any
    length are read whole.  Repeated rows each get their verdict; of rules of
    equal length the one last by host and path decides.  Extra columns are
    ignored; an empty table gives an empty result.
    """
    scratch = Scratch(pages.sparkSession, "urls")
    url = F.col(url_col)
    host, path = url_parts(url)
    rule, verdict = rule_for(F.col("host"), F.col("path"), rules)
    named = pages.select(F.col(id_col).alias("page_id"), url.alias("url"), host.alias("host"), path.alias("path"), address(url).alias("node"))
    named = named.withColumn("rule", rule).withColumn("own", verdict)

    edges = redirects.select("from_url", "to_url") if redirects is not None else pages.sparkSession.createDataFrame([], "from_url string, to_url string")
    if html_col:
        base, links = _links(F.col(html_col))
        found = pages.select(url.alias("url"), base.alias("base"), links.alias("links")).where("size(links) > 0")
        found = found.withColumn("base", F.when(F.col("base").isNull(), F.col("url")).otherwise(resolve(F.col("url"), F.col("base"))))
        found = found.select("url", "base", F.explode("links").alias("to"))
        edges = edges.unionByName(found.select(F.col("url").alias("from_url"), resolve(F.col("base"), F.col("to")).alias("to_url")))
    edges = edges.select("from_url", "to_url", address(F.col("from_url")).alias("a"), address(F.col("to_url")).alias("b"))
    edges = scratch.save(edges.where("a <> '' and b <> ''"), "edges")
    members = connected_components(edges.select("a", "b"), scratch)
    ends = edges.select(F.col("a").alias("node"), F.col("from_url").alias("url")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("to_url").alias("url"))
    )
    _, of_end = rule_for(*url_parts(F.col("url")), rules)
    decided = (
        members.join(ends.select("node", of_end.alias("own")).distinct(), "node")
        .groupBy("component")
        .agg(F.bool_or(F.col("own") == "block").alias("blocked"), F.bool_or(F.col("own") == "allow").alias("allowed"))
        .where("blocked and not coalesce(allowed, false)")
    )
    spread = members.join(decided, "component", "left_semi").select(F.col("node").alias("__node"), F.lit("block").alias("spread"))
    return named.join(spread, F.col("node") == F.col("__node"), "left").select(
        "page_id", "host", "path", "rule", F.coalesce("own", "spread", F.lit("allow")).alias("verdict")
    )
