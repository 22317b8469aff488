"""URL rules carried over redirects and canonical links.

A URL's own rule decides first: an allow always stands. URLs that no rule fits take the block of any URL that is the
same page, by connected components over redirects and canonical links (given as a table, or read from the pages'
link and meta tags); all others are allowed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise.llm.common import bind
from tillwise.llm.components import connected_components
from tillwise.session import materialize

#: Rules of the registered query: (host, path, verdict).
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise("")


def host_of(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z lower-cased; empty without one."""
    return F.coalesce(F.translate(F.regexp_extract(_rest(url), "^[^/?#]*", 0), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ?, # or the end."""
    return F.coalesce(F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def page_key(url: Column) -> Column:
    """A URL without its scheme and fragment, which name the same page; null if it has no host."""
    key = F.concat(host_of(url), F.regexp_extract(_rest(url), "^[^/?#]*([^#]*)", 1))
    return F.when(host_of(url) != "", key)


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]] | None = None) -> Column:
    """Struct (rule, verdict) of the longest rule that fits; null if none does. At equal length the longer host wins."""
    fits = [
        F.when(
            ((host == h) | host.endswith(f".{h}")) & path.startswith(p),
            F.struct(F.lit(len(h) + len(p)).alias("n"), F.lit(len(h)).alias("h"), F.lit(h + p).alias("rule"), F.lit(v).alias("verdict")),
        )
        for h, p, v in rules or RULES
    ]
    return F.array_max(F.array(*fits))


def _tag_value(tag: Column, name: str) -> Column:
    """An attribute's value, quoted or not."""
    value = F.regexp_extract(tag, rf"""(?is)\s{name}\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", 1)
    return F.trim(F.replace(F.regexp_replace(value, "^[\"']|[\"']$", ""), F.lit("&amp;"), F.lit("&")))


def _resolved(target: Column, url: Column) -> Column:
    """A link's target as a full URL, relative to url."""
    folder = F.regexp_replace(F.concat(F.lit("/"), F.regexp_extract(path_of(url), "^/?(.*)$", 1)), "[^/]*$", "")

    def whole(t: Column) -> Column:
        relative = F.when(t.startswith("/"), t).otherwise(F.concat(folder, t))
        return (
            F.when((t == "") | t.startswith("#"), F.lit(None))
            .when(F.instr(t, "://") > 0, t)
            .when(t.startswith("//"), F.concat(F.lit("http:"), t))
            .otherwise(F.concat(F.lit("http://"), host_of(url), relative))
        )

    return bind(target, whole)


def page_links(pages: DataFrame) -> DataFrame:
    """(source, target) URLs of the canonical links and refresh redirects in the pages' html."""
    html = F.coalesce(F.col("html"), F.lit(""))
    marked = pages.where("url is not null").where(html.rlike("(?i)canonical|refresh"))
    tags = marked.select("url", F.explode(F.regexp_extract_all(html, F.lit(r"(?i)<(?:link|meta)\s[^>]*>"), F.lit(0))).alias("tag"))
    canonical = F.lower(_tag_value(F.col("tag"), "rel")) == "canonical"
    refresh = F.lower(_tag_value(F.col("tag"), "http-equiv")) == "refresh"
    moved = F.trim(F.regexp_extract(_tag_value(F.col("tag"), "content"), r"(?i)url\s*=\s*[\"']?([^\"']*)", 1))
    target = F.when(canonical, _tag_value(F.col("tag"), "href")).when(refresh, moved)
    return tags.select(F.col("url").alias("source"), _resolved(target, F.col("url")).alias("target")).where("target is not null")


def judge_urls(
    pages: DataFrame, redirects: DataFrame | None = None, rules: list[tuple[str, str, str]] | None = None
) -> DataFrame:
    """(page_id, host, path, rule, verdict) of every row of pages (page_id, url, html, any more columns).

    redirects: more equivalences as (source, target) URLs. A null URL, or one without ://, has an empty host and path,
    no rule and no aliases, and is allowed. Null html has no links; repeated rows are judged each.
    """
    links = page_links(pages.select("url", "html"))
    if redirects is not None:
        links = links.union(redirects.select("source", "target"))
    edges = links.select(page_key(F.col("source")).alias("a"), page_key(F.col("target")).alias("b"))
    # written once: the components read their edges several times, and these come from whole pages
    same = connected_components(materialize(edges.distinct(), "url-edges"), "url-aliases")
    full = F.concat(F.lit("http://"), F.col("node"))
    judged = same.withColumn("own", rule_of(host_of(full), path_of(full), rules))
    blocked = judged.where(F.col("own.verdict") == "block").select("component").distinct()
    aliases = judged.join(blocked, "component", "left_semi").select(F.col("node").alias("key")).distinct()

    url = F.col("url")
    rows = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"), page_key(url).alias("key"))
    rows = rows.withColumn("own", rule_of(F.col("host"), F.col("path"), rules))
    found = rows.join(aliases.withColumn("blocked", F.lit(True)), "key", "left")
    verdict = F.coalesce("own.verdict", F.when(F.col("blocked"), "block"), F.lit("allow"))
    return found.select("page_id", "host", "path", F.col("own.rule").alias("rule"), verdict.alias("verdict"))
