"""URL filter whose block decisions reach every alias of a page.

A rule is a verdict and a host with a path, as ``("block", "example.com/en/")``. It fits its host and
all subdomains if the path of the url starts with the rule's; the longest rule that fits wins (of
equal length the one with the longer host, then allow). Rules are a parameter and part of the plan: hundreds,
not millions.

Urls without a rule of their own take the decision of their class of aliases. Nodes are
addresses, that is host, path and query without scheme and fragment. Edges are

* redirects that a page declares (``meta http-equiv=refresh``) or that the caller knows from a crawl
  (``redirects``: from_url, to_url);
* canonical links (``link rel=canonical``), relative ones resolved against the page's url;
* the redirects that servers make by convention: from an address to the one without a leading
  ``www.`` or ``m.``, without tracking parameters and without a final slash.

Connected components of these edges are found on Spark (``graphs``). Explicit allow has precedence: a url
with an allow rule is allowed whatever its class, and a class that holds an allowed address passes no
block on. Otherwise one blocked address blocks all addresses of its class that have no rule. What no
rule and no alias decides is allowed.

Edge cases: a null url or one without ``://`` has an empty host and path, no node and no rule, and is
allowed. Null html declares nothing. Rows that repeat an address share its node and each give a
row. A third of all pages may have one address: joins by address go through ``common.bounded_join``.
Other columns are ignored.
"""

from __future__ import annotations

import html
import re
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from seamark.llm.common import bounded_join, written
from seamark.llm.graphs import components

URL = "(?s)^.*?://([^/?#]*)([^?#]*)([^#]*)"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Query parameters that name the way to a page, not the page.
TRACKING = r"(?:utm_[a-z]+|ref|fbclid|gclid)=[^&]*"
ALLOW, BLOCK = "allow", "block"
Rules = list[tuple[str, str]]


def host(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, URL, 1), F.lit("")), UPPER, LOWER)


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, URL, 2), F.lit(""))


def address(url: Column) -> Column:
    """Host, path and query; NULL where the url has no host."""
    return F.when(host(url) != "", F.concat(host(url), path(url), F.regexp_extract(url, URL, 3)))


def plain_address(node: Column) -> Column:
    """The address that servers redirect ``node`` to by convention."""
    place = F.regexp_replace(F.regexp_extract(node, r"(?s)^([^?]*)", 1), r"^(?:www|m)\.(?=[^/]*\.)|/$", "")
    query = F.regexp_replace(F.regexp_extract(node, r"(?s)^[^?]*\?(.*)", 1), f"(?<=^|&){TRACKING}(?:&|$)", "")
    query = F.regexp_replace(query, "&$", "")
    return F.concat(place, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))


def rule_for(host: Column, path: Column, rules: Rules) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits; NULL where none does."""
    by_host: dict[str, list[tuple[str, str]]] = {}
    for verdict, rule in rules:
        if verdict not in (ALLOW, BLOCK):
            raise ValueError(f"verdict {verdict!r}")
        name, slash, rest = rule.partition("/")
        by_host.setdefault(name.translate(str.maketrans(UPPER, LOWER)), []).append((slash + rest, verdict))
    if not by_host:
        return F.lit(None).cast("string"), F.lit(None).cast("string")
    entry = lambda name, p, v: F.struct(F.lit(len(name) + len(p)).alias("size"), F.lit(len(name)).alias("host_size"), F.lit(v == ALLOW).alias("allowed"), F.lit(p).alias("path"), F.lit(name + p).alias("rule"))
    table = F.create_map(*[x for name, found in by_host.items() for x in (F.lit(name), F.array(*[entry(name, p, v) for p, v in found]))])
    labels = F.split(host, r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    known = F.flatten(F.filter(F.transform(suffixes, lambda s: F.try_element_at(table, s)), lambda found: found.isNotNull()))
    best = F.array_max(F.filter(known, lambda r: F.startswith(path, r["path"])))
    return best["rule"], F.when(best["allowed"], ALLOW).when(~best["allowed"], BLOCK)


@F.pandas_udf(StringType())
def declared_target(url: pd.Series, tag: pd.Series) -> pd.Series:
    """The url that a link or meta tag names as canonical or as target of a redirect."""

    def attribute(text: str, name: str) -> str | None:
        found = re.search(rf"""(?is)[\s"'/]{name}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", text)
        return found and html.unescape(next(g for g in found.groups() if g is not None)).strip()

    def target(base: str, text: str) -> str | None:
        if text[:5].lower() == "<link":
            goal = attribute(text, "href") if "canonical" in (attribute(text, "rel") or "").lower().split() else None
        else:
            wait = attribute(text, "content") if (attribute(text, "http-equiv") or "").lower() == "refresh" else None
            found = re.search(r"(?is)url\s*=\s*['\"]?([^'\"]+)", wait or "")
            goal = found and found[1].strip()
        try:
            return urljoin(base, goal) if goal else None
        except ValueError:
            return None

    return pd.Series([target(u, t) for u, t in zip(url, tag)], dtype=object)


def declared(pages: DataFrame) -> DataFrame:
    """(from_url, to_url) of the redirects and canonical links in the html of ``pages``."""
    shown = F.regexp_replace("html", r"(?is)<!--.*?-->|<script\b.*?</script>", "")
    tags = pages.filter(F.col("url").isNotNull() & F.col("html").rlike("(?i)canonical|http-equiv")).select("url", F.explode(F.regexp_extract_all(shown, F.lit(r"(?is)<(?:link|meta)\b[^>]*>"), 0)).alias("tag"))
    return tags.filter(F.col("tag").rlike("(?i)canonical|refresh")).select(F.col("url").alias("from_url"), declared_target("url", "tag").alias("to_url")).filter("to_url IS NOT NULL")


def node(address: Column) -> Column:
    """128 bits that stand for an address."""
    return F.unhex(F.md5(address))


def links(pages: DataFrame, redirects: DataFrame | None = None) -> DataFrame:
    """(a, b): edges between addresses."""
    known = declared(pages)
    if redirects is not None:
        known = known.unionByName(redirects.select("from_url", "to_url"))
    known = known.select(address(F.col("from_url")).alias("a"), address(F.col("to_url")).alias("b"))
    seen = pages.select(address(F.col("url")).alias("a")).unionByName(known.select(F.col("b").alias("a"))).filter("a IS NOT NULL")
    usual = seen.select("a", plain_address(F.col("a")).alias("b"))
    return known.unionByName(usual).filter("a <> b").distinct()


def blocked_nodes(pages: DataFrame, rules: Rules, redirects: DataFrame | None = None) -> DataFrame:
    """The nodes whose class holds a blocked address and no allowed one."""
    edges = written(links(pages, redirects), "url-links")
    verdict = lambda a: rule_for(F.regexp_extract(a, "^([^/?]*)", 1), F.regexp_extract(a, "(?s)^[^/?]*([^?]*)", 1), rules)[1]
    ends = edges.select("a").unionByName(edges.select(F.col("b").alias("a"))).distinct()
    judged = ends.select(node(F.col("a")).alias("node"), verdict(F.col("a")).alias("verdict"))
    member = components(edges.select(node(F.col("a")).alias("a"), node(F.col("b")).alias("b")), hubs=True).select(F.col("a").alias("node"), F.col("b").alias("class"))
    classed = written(judged.join(member, "node", "left").select("node", "verdict", F.coalesce("class", "node").alias("class")), "url-classes")
    tainted = classed.groupBy("class").agg(F.bool_or(F.col("verdict") == BLOCK).alias("block"), F.bool_or(F.col("verdict") == ALLOW).alias("allow"))
    tainted = tainted.filter("block AND NOT coalesce(allow, false)").select("class", F.lit(True).alias("tainted"))
    return bounded_join(classed.filter("verdict IS NULL").select("node", "class"), tainted, "class").filter("tainted").select("node", "tainted")


def judge(pages: DataFrame, rules: Rules, redirects: DataFrame | None = None) -> DataFrame:
    """page_id, url, host, path, rule and verdict of every page."""
    url = F.col("url")
    rule, verdict = rule_for(F.col("host"), F.col("path"), rules)
    own = pages.select("page_id", "url", host(url).alias("host"), path(url).alias("path"), node(address(url)).alias("node"))
    own = own.select("*", rule.alias("rule"), verdict.alias("verdict"))
    out = bounded_join(written(own, "url-rules"), written(blocked_nodes(pages, rules, redirects), "url-blocked"), "node")
    return out.select("page_id", "url", "host", "path", "rule", F.coalesce("verdict", F.when(F.col("tainted"), BLOCK), F.lit(ALLOW)).alias("verdict"))
