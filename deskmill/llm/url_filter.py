"""URL rules that also reach the aliases of a page.

Redirects and canonical links tie URLs together; connected components over them are the
pages behind the URLs. A URL follows its own rule; one without a rule follows the
explicit decisions on its aliases, where allowing comes before blocking.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from deskmill.llm.common import let, stored, table, without
from deskmill.llm.graph import components

# --- fixed values: rules of the registered query (verdict, host, path) ----------------
RULES = [
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
]

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def parts(url: Column) -> tuple[Column, Column, Column]:
    """Scheme, host (A-Z lower-cased) and path; empty without ``://``."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    scheme = F.when(at > 0, F.translate(F.substr(url, F.lit(1), at - 1), UPPER, LOWER)).otherwise(F.lit(""))
    return scheme, F.translate(host, UPPER, LOWER), path


def longest_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """Name and verdict of the longest rule that fits, else null.

    A list of rules is a setting, not data: it is part of the plan and moves no rows.
    """
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        found = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def _folded(path: Column) -> Column:
    """A path that starts with a slash, without ``.`` and ``..`` steps."""

    def walk(steps: Column) -> Column:
        folded = F.aggregate(
            steps,
            F.array().cast("array<string>"),
            lambda done, x: F.when(x == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0))))
            .when(x == ".", done)
            .otherwise(F.concat(done, F.array(x))),
        )
        end = F.when(F.element_at(steps, -1).isin(".", ".."), F.array(F.lit(""))).otherwise(F.array().cast("array<string>"))
        return F.concat(F.lit("/"), F.array_join(F.concat(folded, end), "/"))

    return let(F.slice(F.split(path, "/", -1), 2, 1 << 30), walk)


def _absolute(link: Column, base: Column) -> Column:
    """A link target as a URL; null for a base without ``://`` and targets like ``mailto:``."""
    return let(F.struct(link.alias("link"), base.alias("base")), lambda x: _resolved(x["link"], x["base"]))


def _resolved(link: Column, base: Column) -> Column:
    scheme, host, path = parts(base)
    query = F.regexp_extract(base, r"^[^?#]*(\?[^#]*)", 1)
    site = F.concat(scheme, F.lit("://"), host)
    to, more = F.regexp_extract(link, r"^[^?#]*", 0), F.regexp_extract(link, r"^[^?#]*(.*)", 1)
    folder = F.when(path == "", F.lit("/")).otherwise(F.regexp_extract(path, r"^.*/", 0))
    return (
        F.when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*://"), link)
        .when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:") | (scheme == ""), None)
        .when(link.startswith("//"), F.concat(scheme, F.lit(":"), link))
        .when(link.startswith("/"), F.concat(site, _folded(to), more))
        .when(link.startswith("?"), F.concat(site, path, link))
        .when(link.startswith("#"), F.concat(site, path, query, link))
        .otherwise(F.concat(site, _folded(F.concat(folder, to)), more))
    )


def page_links(pages: DataFrame) -> DataFrame:
    """``a``, ``b``: from the URL to the canonical link and the refresh target of its page.

    Relative targets start from the page's URL, or from its ``base`` tag.
    """
    own = F.regexp_extract("html", r"(?is)<base\b[^>]*\bhref\s*=\s*[\"']?([^\"'\s>]+)", 1)
    base = F.coalesce(F.when(F.length(own) > 0, _absolute(F.regexp_replace(own, "&amp;", "&"), F.col("url"))), F.col("url"))
    tags = pages.filter("url IS NOT NULL AND (html ILIKE '%canonical%' OR html ILIKE '%refresh%')").select(
        "url",
        base.alias("_base"),
        F.explode(F.regexp_extract_all("html", F.lit(r"(?is)<(?:link|meta)\b[^>]*>"), F.lit(0))).alias("tag"),
    )
    # Canonical may be any of the words of rel.
    words = [rf"{q}(?:[^{q}]*\s)?canonical(?:\s[^{q}]*)?{q}" for q in "\"'"]
    canonical = F.col("tag").rlike(rf"(?is)^<link\b.*[\s\"'/]rel\s*=\s*(?:{words[0]}|{words[1]}|canonical[\s/>])")
    refresh = F.col("tag").rlike(r"(?is)^<meta\b.*\bhttp-equiv\s*=\s*[\"']?refresh\b")
    target = F.when(canonical, F.regexp_extract("tag", r"(?is)\bhref\s*=\s*[\"']?([^\"'\s>]+)", 1)).when(
        refresh, F.regexp_extract("tag", r"(?is)\burl\s*=\s*[\"']?([^\"'\s>]+)", 1)
    )
    return (
        tags.withColumn("_to", F.regexp_replace(target, "&amp;", "&"))
        .filter(F.length("_to") > 0)
        .select(F.col("url").alias("a"), _absolute(F.col("_to"), F.col("_base")).alias("b"))
        .filter("b IS NOT NULL")
    )


def usual_redirects(urls: DataFrame) -> DataFrame:
    """``a``, ``b``: from a URL to where sites commonly send it: https, no ``www.`` or
    ``m.``, no closing slash or ``.html``, no feed mark, no fragment."""
    scheme, host, path = parts(F.col("url"))
    query = F.regexp_extract("url", r"^[^?#]*(\?[^#]*)", 1)
    query = F.regexp_replace(F.regexp_replace(query, r"(?<=[?&])utm_[^&]*&?", ""), r"[?&]$", "")
    plain = F.regexp_replace(F.regexp_replace(path, r"/+$", ""), r"\.html$", "")
    target = F.concat(F.lit("https://"), F.regexp_replace(host, r"^(www|m)\.", ""), plain, query)
    return urls.filter((scheme == "http") | (scheme == "https")).select(F.col("url").alias("a"), target.alias("b"))


def url_filter(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, redirects: DataFrame | None = None) -> DataFrame:
    """``pages`` (page_id, url, html and more, html left out) with host, path, rule, verdict
    and alias_of, the smallest URL of the component; these replace columns of their names.

    ``redirects`` (a, b) are known redirects; links in the pages and the usual redirects
    are added. URLs that are only targets take part, with their own rules.

    Defined cases: a null URL or one without ``://`` has an empty host and path, no rule
    and no aliases, and is allowed; equal URLs get equal verdicts; a component that is
    explicitly allowed and blocked is allowed where a URL has no rule of its own; no
    decision at all allows.
    """
    pages = without(pages, "host", "path", "rule", "verdict", "alias_of")
    links = page_links(pages)
    if redirects is not None:
        links = links.unionByName(redirects.select("a", "b"))
    urls = pages.select("url").unionByName(links.select(F.col("b").alias("url")))
    links = links.unionByName(usual_redirects(urls.filter("url IS NOT NULL").distinct()))
    alias = stored(components(links))
    _, host, path = parts(F.col("node"))
    told = longest_rule(host, path, rules)["verdict"]
    decided = (
        alias.withColumn("_v", told)
        .groupBy("component")
        .agg(F.max(F.col("_v") == "allow").alias("_allow"), F.max(F.col("_v") == "block").alias("_block"))
        .filter("_allow OR _block")
        .select("component", F.when(F.col("_allow"), "allow").otherwise("block").alias("_shared"))
    )
    shared = alias.join(decided, "component", "left").select(
        F.col("node").alias("_url"), F.col("component").alias("_root"), "_shared"
    )
    _, host, path = parts(F.col("url"))
    judged = pages.withColumns({"host": host, "path": path}).withColumn(
        "_own", longest_rule(F.col("host"), F.col("path"), rules)
    )
    keep = [F.col(f"`{c}`") for c in pages.columns if c != "html"]
    return judged.join(shared, F.col("url") == F.col("_url"), "left").select(
        *keep,
        "host",
        "path",
        F.col("_own.rule").alias("rule"),
        F.coalesce(F.col("_own.verdict"), F.col("_shared"), F.lit("allow")).alias("verdict"),
        F.coalesce("_root", "url").alias("alias_of"),
    )


def op4_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    judged = url_filter(table(spark, folder, "pages", "page_id", "url", "html"))
    return judged.select("page_id", "host", "path", "rule", "verdict")


QUERIES = {"op4_url_filter": op4_url_filter}
