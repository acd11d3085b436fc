"""URL filters that follow redirects and canonical links (operator 3)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..workspace import written
from .common import components, kept

#: Verdict and the host and path that a rule fits; fixed by the query's contract.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_ATTRIBUTE = r"\s*=\s*(?:\"([^\">]*)\"|'([^'>]*)'|([^\s\"'>]+))"


def host_of(url: Column) -> Column:
    """From after the first ``://`` to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """From after the host to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def ruled(df: DataFrame, rules=RULES, host: str = "host", path: str = "path") -> DataFrame:
    """``df`` with ``rule`` (such as ``net/``) and ``rule_verdict``: the longest rule that fits, both null without one.

    A rule fits its host and every subdomain, if the path starts with the rule's.  Rules are a short list of settings and
    become expressions.  Of rules equally long the later in order of text wins, and allow before block.
    """
    best = F.lit(None).cast("string")
    verdict = F.lit(None).cast("string")
    for kind, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1] + r[2], r[0] == "allow")):
        fits = ((F.col(host) == h) | F.col(host).endswith("." + h)) & F.col(path).startswith(p)
        best, verdict = F.when(fits, F.lit(h + p)).otherwise(best), F.when(fits, F.lit(kind)).otherwise(verdict)
    return df.withColumns({"rule": best, "rule_verdict": verdict})


def node_of(url: Column) -> Column:
    """A URL as a node of the link graph: host in lower case, path (``/`` if empty) and query; no scheme and no fragment.

    Null where there is no ``://``.
    """
    path = path_of(url)
    query = F.regexp_extract(url, r"(?s)^[^?#]*(\?[^#]*)", 1)
    return F.when(url.contains("://"), F.concat(host_of(url), F.when(path == "", F.lit("/")).otherwise(path), F.coalesce(query, F.lit(""))))


def absolute(link: Column, url: Column) -> Column:
    """A link in a page as a full URL: as it is, or taken from the page's scheme, host or folder."""
    link = F.trim(F.replace(link, F.lit("&amp;"), F.lit("&")))
    scheme = F.regexp_extract(url, r"(?s)^(.*?)://", 1)
    root = F.regexp_extract(url, r"(?s)^(.*?://[^/?#]*)", 1)
    folder = F.regexp_extract(F.regexp_extract(url, r"(?s)^([^?#]*)", 1), r"(?s)^(.*?://[^/]*(?:/.*)?)/[^/]*$", 1)
    return (
        F.when(link.isNull() | (link == ""), F.lit(None))
        .when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*://"), link)
        .when(link.startswith("//"), F.concat(scheme, F.lit(":"), link))
        .when(link.startswith("/"), F.concat(root, link))
        .when(link.rlike(r"^[?#]"), F.concat(F.regexp_extract(url, r"(?s)^([^?#]*)", 1), link))
        .when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), F.lit(None))
        .when(folder == "", F.concat(root, F.lit("/"), link))
        .otherwise(F.concat(folder, F.lit("/"), link))
    )


def _attribute(tag: Column, name: str) -> Column:
    """The value of an attribute of a tag, in whatever quotes; null without it."""
    found = [F.regexp_extract(tag, rf"(?is)[\s\"']{name}{_ATTRIBUTE}", i) for i in (1, 2, 3)]
    return F.coalesce(*[F.nullif(x, F.lit("")) for x in found])


def page_links(df: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Edges ``a``, ``b`` between nodes: a page and the URL that its canonical link or its refresh names.

    Comments are left out first.  Several such tags give several edges.
    """
    body = F.regexp_replace(F.coalesce(F.col(html), F.lit("")), r"(?s)<!--.*?-->", "")
    tags = F.filter(
        F.regexp_extract_all(body, F.lit(r"(?is)<(?:link|meta)\s[^>]*>"), 0),
        lambda t: t.rlike(r"(?is)[\s\"']rel\s*=\s*[\"']?[^\"'>]*\bcanonical\b") | t.rlike(r"(?is)[\s\"']http-equiv\s*=\s*[\"']?\s*refresh\b"),
    )
    tag, value = F.col("tag"), F.col("value")
    some = df.select(F.col(url).alias("url"), F.explode(tags).alias("tag"))
    some = some.withColumn("value", F.when(tag.rlike(r"(?is)^<link"), _attribute(tag, "href")).otherwise(_attribute(tag, "content")))
    refresh = F.nullif(F.regexp_extract(value, r"(?is)^\s*[\d.]+\s*[;,]\s*url\s*=\s*['\"]?([^'\"]*)", 1), F.lit(""))
    some = some.withColumn("link", F.when(tag.rlike(r"(?is)^<link"), value).otherwise(refresh))
    # written in steps: as one expression this is more than one generated method holds
    some = written(some.select("url", "link").where("link is not null"), "links")
    some = written(some.select("url", absolute(F.col("link"), F.col("url")).alias("to")), "links")
    edges = written(some.select(node_of(F.col("url")).alias("a"), node_of(F.col("to")).alias("b")), "links")
    return edges.where("a is not null and b is not null and a <> b").distinct()


def judge(df: DataFrame, edges: DataFrame | None = None, rules=RULES, url: str = "url", html: str | None = "html", keep: tuple[str, ...] | None = None) -> DataFrame:
    """The columns ``keep`` of ``df`` (all by default) with ``host``, ``path``, ``rule``, ``verdict``.

    A URL with a rule has the rule's verdict.  Any other takes what its aliases say: URLs tied by redirects (``edges``: full
    URLs ``a``, ``b``; nulls tie nothing), canonical links or refreshes in the pages' ``html``.  If an alias is explicitly
    allowed the URL is allowed; else if one is blocked it is blocked; else it is allowed.  URLs that only edges name take part
    with their rules.  A null URL, or one without ``://``, has no host, path or alias and is allowed.  Columns of ``df`` with the
    names of the new ones are replaced; repeated rows are judged alike.
    """
    own = df.select(kept(df, keep, replaced=("host", "path", "rule", "verdict")), df[f"`{url}`"].alias("url"))
    own = own.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    parts = []
    if html is not None:
        parts.append(page_links(df, url, html))
    if edges is not None:
        parts.append(edges.select(node_of(F.col("a")).alias("a"), node_of(F.col("b")).alias("b")).where("a is not null and b is not null"))
    spoken = ruled(own, rules)
    if not parts:
        return spoken.select("row.*", "host", "path", "rule", F.coalesce("rule_verdict", F.lit("allow")).alias("verdict"))
    links = parts[0] if len(parts) == 1 else parts[0].union(parts[1])
    tied = written(components(links), "tied")
    names = ruled(tied.union(tied.select("root", "root")).distinct().select("node", "root", F.regexp_extract("node", r"(?s)^([^/]*)", 1).alias("host"), F.regexp_extract("node", r"(?s)^[^/]*([^?]*)", 1).alias("path")), rules)
    said = written(names.groupBy("root").agg(F.max(F.col("rule_verdict") == "allow").alias("allowed"), F.max(F.col("rule_verdict") == "block").alias("blocked")), "said")
    blocked = said.where("blocked and not coalesce(allowed, false)").select("root")
    aliases = written(names.where("rule is null").join(blocked, "root", "left_semi").select("node"), "aliases")
    # only URLs without a rule ask their aliases; each alias is one row, and a URL on many pages splits as a skewed join does
    asked = F.when(F.col("rule").isNull(), node_of(F.col("url")))
    out = spoken.withColumn("asked", asked).join(aliases.withColumn("found", F.lit(True)), F.col("asked") == F.col("node"), "left")
    verdict = F.coalesce("rule_verdict", F.when(F.col("found"), F.lit("block")), F.lit("allow"))
    return out.select("row.*", "host", "path", "rule", verdict.alias("verdict"))


def op3_url_filter(spark, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of the URL of every page."""
    return judge(spark.read.parquet(f"{sf_dir}/pages.parquet"), keep=("page_id",))


#: No page of the given tables names a canonical link or a refresh, so no URL there has an alias; tests cover those.
ORACLE = r"""
WITH p AS (
  SELECT page_id, url, html,
    CASE WHEN contains(url, '://') THEN translate(regexp_extract(url, '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END AS host,
    CASE WHEN contains(url, '://') THEN regexp_extract(url, '://[^/?#]*([^?#]*)', 1) ELSE '' END AS path
  FROM pages),
k(kind, h, pre) AS (VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
m AS (SELECT page_id, arg_max(h || pre, length(h || pre)) AS rule, arg_max(kind, length(h || pre)) AS verdict
      FROM p JOIN k ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, pre) GROUP BY page_id)
SELECT p.page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM p LEFT JOIN m USING (page_id)
"""
