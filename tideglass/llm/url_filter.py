"""URL filter with redirect equivalence.

Rules judge a url by its host and path. Canonical links and refresh redirects in the pages, and any
given redirects, join urls to classes of aliases (connected components). A url that no rule fits
takes the decision of its class: an explicit allow of any alias comes first, then a block of any
alias; without either it is allowed. A url that a rule fits keeps that rule's verdict.

Urls are the same node if they differ only in scheme, letter case of the host or fragment. Everything
is built from DataFrame functions; only urls that have an alias link enter the components.

A url that is null or has no ``://`` has an empty host and path, fits no rule, has no aliases and is
allowed. Repeated pages are judged one by one, a page without markup has no links. Extra columns are
not looked at, and an empty table gives no rows. Markup of any length is searched whole.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideglass.llm.common import materialize
from tideglass.llm.components import components

ALLOW, BLOCK = "allow", "block"


@dataclass(frozen=True)
class Rule:
    """``allow``: ``verdict`` for ``host``, all its subdomains, and paths that start with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def host(url: Column) -> Column:
    raw = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def matching_rule(host: Column, path: Column, rules: list[Rule]) -> Column:
    """Struct ``rule``, ``verdict`` of the longest rule that fits, or null; of equally long ones the
    first given. All rules are tried on each url: meant for lists of up to some hundreds."""
    choice = F.lit(None).cast("struct<rule: string, verdict: string>")
    for rule in sorted(rules, key=lambda r: len(r.name)):
        within = (host == F.lit(rule.host)) | host.endswith("." + rule.host)
        fits = within & path.startswith(rule.path)
        value = F.struct(F.lit(rule.name).alias("rule"), F.lit(rule.verdict).alias("verdict"))
        choice = F.when(fits, value).otherwise(choice)
    return choice


def node(url: Column) -> Column:
    """What stands for a url among aliases; null without ``://``."""
    rest = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^#]*)", 1)
    return F.when(url.contains("://"), F.concat(F.lit("http://"), host(url), rest))


def _links_to(html: Column, tag: str, mark: str, place: str) -> Column:
    """The urls that tags of one kind with a certain mark point to."""
    tags = F.regexp_extract_all(html, F.lit(rf"(?is)<{tag}\b[^>]*>"), F.lit(0))
    marked = F.filter(tags, lambda t: t.rlike(mark))
    urls = F.transform(marked, lambda t: F.regexp_extract(t, place, 1))
    return F.transform(urls, lambda u: F.trim(F.replace(u, F.lit("&amp;"), F.lit("&"))))


def alias_targets(html: Column) -> Column:
    """Targets of canonical links and refresh redirects, as they are written."""
    html = F.coalesce(html, F.lit(""))
    canonical = _links_to(
        html, "link", r"(?is)\brel\s*=\s*[\"']?[^\"'>]*\bcanonical\b",
        r"(?is)\bhref\s*=\s*[\"']?\s*([^\"'\s>]+)",
    )
    refresh = _links_to(
        html, "meta", r"(?is)\bhttp-equiv\s*=\s*[\"']?refresh\b",
        r"(?is)\bcontent\s*=.*?\burl\s*=\s*[\"']?\s*([^\"'\s>]+)",
    )
    return F.concat(canonical, refresh)


def resolve(target: Column, url: Column) -> Column:
    """``target`` as an absolute url, seen from the page at ``url``."""
    scheme = F.regexp_extract(url, r"(?s)^(.*?)://", 1)
    site = F.regexp_extract(url, r"(?s)^(.*?://[^/?#]*)", 1)
    folder = F.regexp_extract(path(url), r"(?s)^(.*/)", 1)
    folder = F.when(folder == "", F.lit("/")).otherwise(folder)
    return (
        F.when(target.rlike("^[A-Za-z][A-Za-z0-9+.-]*://"), target)
        .when(target.startswith("//"), F.concat(scheme, F.lit(":"), target))
        .when(target.startswith("/"), F.concat(site, target))
        .when(target.startswith("?"), F.concat(site, path(url), target))
        .when(target.startswith("#"), url)
        .when(target.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), F.lit(None))
        .otherwise(F.concat(site, folder, target))
    )


def alias_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Links ``a``, ``b`` between the nodes of urls that pages declare to be the same."""
    targets = pages.select(
        F.col(url).alias("url"), F.explode(alias_targets(F.col(html))).alias("target")
    ).where(F.col("url").contains("://") & (F.col("target") != ""))
    both = targets.select(node(F.col("url")).alias("a"), node(resolve(F.col("target"), F.col("url"))).alias("b"))
    return both.where("a <> b")


def judge(
    pages: DataFrame,
    rules: list[Rule],
    redirects: DataFrame | None = None,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
) -> DataFrame:
    """One row per row of ``pages``: ``page_id``, ``host``, ``path``, ``rule`` (the name of the rule
    that fits), ``verdict``, and ``alias`` (the smallest url of its class, null if it has no alias).

    ``redirects`` may give more links: columns ``source`` and ``target``, absolute urls.
    """
    spark = pages.sparkSession
    links = alias_links(pages, url, html)
    if redirects is not None:
        links = links.unionByName(
            redirects.select(node(F.col("source")).alias("a"), node(F.col("target")).alias("b"))
        )
    classes = materialize(spark, components(links), "aliases")
    own = matching_rule(host(F.col("node")), path(F.col("node")), rules)["verdict"]
    decided = classes.withColumn("own", own).groupBy("component").agg(
        F.max(F.col("own") == ALLOW).alias("allowed"), F.max(F.col("own") == BLOCK).alias("blocked")
    )
    shared = F.when(F.coalesce("allowed", F.lit(False)), F.lit(ALLOW)).when(
        F.col("blocked"), F.lit(BLOCK)
    )
    decided = materialize(spark, decided.select("component", shared.alias("shared")), "decided")
    aliases = materialize(spark, classes.join(decided, "component"), "aliases")

    place = F.col("_url")
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("_url")).select(
        "page_id", node(place).alias("node"), host(place).alias("host"), path(place).alias("path")
    )
    found = rows.withColumn("match", matching_rule(F.col("host"), F.col("path"), rules))
    return found.join(aliases, "node", "left").select(
        "page_id",
        "host",
        "path",
        F.col("match.rule").alias("rule"),
        F.coalesce(F.col("match.verdict"), F.col("shared"), F.lit(ALLOW)).alias("verdict"),
        F.col("component").alias("alias"),
    )
