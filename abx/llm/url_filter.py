"""URL filter with redirect equivalence.

Host and path rules judge a url directly. Urls that no rule fits take the
decision of the pages they are equivalent to: redirects and canonical links are
edges, their connected components are classes of aliases, and a class with a
blocked member blocks its unruled members unless another member is explicitly
allowed (allow precedence). A url's own rule always wins over its class.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from abx.llm.components import connected_components
from abx.llm.runtime import let, written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Html that is not markup of the page itself.
HIDDEN = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>"
ABSOLUTE = r"^[A-Za-z][A-Za-z0-9+.\-]*:"

Rule = tuple[str, str]  # (verdict, "host/path-prefix")


def split_url(url: Column) -> tuple[Column, Column, Column]:
    """Host (A-Z lower-cased), path and query of a url; all empty for null or without ``://``."""
    shape = r"(?s)^.*?://([^/?#]*)([^?#]*)(\?[^#]*)?"
    u = F.coalesce(url, F.lit(""))
    return (F.translate(F.regexp_extract(u, shape, 1), UPPER, LOWER), F.regexp_extract(u, shape, 2),
            F.regexp_extract(u, shape, 3))


def rule_struct(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """``struct(rule, verdict)`` of the longest rule that fits, else null. A rule fits its
    host and all subdomains when the path starts with the rule's; allow wins a tie.
    ``rules`` is a parameter list: it becomes one native expression, no join."""
    chosen = None
    for verdict, text in sorted(rules, key=lambda r: (-len(r[1]), r[0] != "allow", r[1])):
        cut = (text + "/").index("/")
        name, prefix = text[:cut].lower(), text[cut:]
        fits = ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(path, F.lit(prefix))
        value = F.struct(F.lit(text).alias("rule"), F.lit(verdict).alias("verdict"))
        chosen = F.when(fits, value) if chosen is None else chosen.when(fits, value)
    if chosen is None:
        return F.lit(None).cast("struct<rule:string,verdict:string>")
    return chosen


def _attribute(tag: Column, name: str) -> Column:
    shape = rf"""(?is)\s{name}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
    return F.trim(F.concat(*(F.regexp_extract(tag, shape, g) for g in (1, 2, 3))))


def alias_edges(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``a, b``: keys (host, path and query) of each page url and of the urls its html
    names as canonical link or as meta refresh target. Relative targets are resolved
    against the page; other schemes (``mailto:``) and empty targets give no edge."""
    host, path, query = split_url(F.col(url_col))
    tags = (pages.where(F.col(html_col).rlike(r"(?i)canonical|http-equiv") & F.col(url_col).isNotNull())
            .select(host.alias("host"), path.alias("path"), query.alias("query"),
                    F.explode(F.regexp_extract_all(F.regexp_replace(F.col(html_col), HIDDEN, " "),
                                                   F.lit(r"(?is)<(?:link|meta)\s[^>]*>"), F.lit(0))).alias("tag")))
    home = F.concat(F.lit("x://"), F.col("host"))
    folder = F.concat(F.regexp_extract(F.col("path"), r"(?s)^(.*)/", 1), F.lit("/"))

    def target(tag: Column) -> Column:
        canonical = F.array_contains(F.split(F.lower(_attribute(tag, "rel")), r"\s+"), "canonical")
        refresh = F.lower(_attribute(tag, "http-equiv")) == "refresh"
        to = (F.when(canonical, _attribute(tag, "href"))
              .when(refresh, F.regexp_extract(_attribute(tag, "content"), r"""(?is)url\s*=\s*['"]?([^'"\s]+)""", 1)))
        return F.replace(to, F.lit("&amp;"), F.lit("&"))

    def resolved(to: Column) -> Column:
        return (F.when(F.coalesce(to, F.lit("")) == "", None)
                .when(to.contains("://") & to.rlike(ABSOLUTE), to)
                .when(F.startswith(to, F.lit("//")), F.concat(F.lit("x:"), to))
                .when(to.rlike(ABSOLUTE), None)
                .when(F.startswith(to, F.lit("/")), F.concat(home, to))
                .when(to.rlike(r"^[?#]"), F.concat(home, F.col("path"), to))
                .otherwise(F.concat(home, folder, to)))

    # let() keeps each step evaluated once; plain nesting would copy it into every use.
    key = let(F.col("tag"), lambda t: let(target(t), lambda to: let(resolved(to), lambda u: F.concat(*split_url(u)))))
    return (tags.select(F.concat("host", "path", "query").alias("a"), key.alias("b"))
            .where((F.col("a") != "") & (F.col("b") != "")))


def judge_urls(pages: DataFrame, rules: Sequence[Rule], id_col: str = "page_id", url_col: str = "url",
               html_col: str | None = "html", redirects: DataFrame | None = None) -> DataFrame:
    """One row per page: id, host, path, rule, verdict, ``alias_verdict`` (of its class, or null).

    ``redirects`` (columns ``from_url, to_url``) adds edges from crawl logs. A url
    that no rule and no class decides is allowed. Null urls and urls without
    ``://`` have empty host and path, no rule, no aliases, and are allowed. Repeated
    pages are judged alike; an empty table gives an empty result; other columns are
    not read.
    """
    host, path, query = split_url(F.col(url_col))
    judged = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"),
                          F.concat(host, path, query).alias("key"), rule_struct(host, path, rules).alias("r"))
    edges = []
    if html_col is not None:
        edges.append(alias_edges(pages, url_col, html_col))
    if redirects is not None:
        ha, pa_, qa = split_url(F.col("from_url"))
        hb, pb, qb = split_url(F.col("to_url"))
        edges.append(redirects.select(F.concat(ha, pa_, qa).alias("a"), F.concat(hb, pb, qb).alias("b"))
                     .where((F.col("a") != "") & (F.col("b") != "")))
    none = F.lit(None).cast("string")
    if edges:
        all_edges = edges[0]
        for e in edges[1:]:
            all_edges = all_edges.unionByName(e)
        found = connected_components(all_edges)
        node_host = F.regexp_extract("node", r"(?s)^([^/?]*)([^?]*)", 1)
        node_path = F.regexp_extract("node", r"(?s)^([^/?]*)([^?]*)", 2)
        ruled = found.withColumn("v", rule_struct(node_host, node_path, rules)["verdict"])
        # "allow" sorts before "block": the least verdict of a class is its decision.
        decided = ruled.groupBy("component").agg(F.min("v").alias("alias_verdict")).where("alias_verdict is not null")
        aliases = written(ruled.join(decided, "component").select(F.col("node").alias("key"), "alias_verdict"), "aliases")
        judged = judged.join(aliases, "key", "left")
    else:
        judged = judged.withColumn("alias_verdict", none)
    return judged.select(
        "page_id", "host", "path", F.col("r")["rule"].alias("rule"),
        F.coalesce(F.col("r")["verdict"], F.col("alias_verdict"), F.lit("allow")).alias("verdict"), "alias_verdict")
