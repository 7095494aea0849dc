"""URL filters whose decisions follow redirects and canonical links.

Rules: (host, path, verdict).  A rule fits its host and all subdomains if the
url's path starts with the rule's path; of several the longest (host plus
path) wins, then the first in code-point order.  The few rules become one
expression, so every url is judged without a join.

Aliases: a page names another url as its own by ``<link rel="canonical">`` or
sends readers on by ``<meta http-equiv="refresh">``; known redirects may be
given as a table.  Both are edges between urls (scheme and host in lower case,
fragment dropped, character references decoded, relative targets resolved against
the page's ``<base>`` or url, dot segments removed); comments, scripts and styles
are not looked into.  Distributed connected components join the aliases, and a url
that no rule fits takes its component's decision: allow if a rule allows some
alias (explicit allow comes first), else block if a rule blocks one, else
``DEFAULT``.  A url with a rule of its own keeps that rule's verdict.  Targets
that are no page themselves count: their rules decide too.

All of it is DataFrame expressions and joins.

Defined results: a null url or one without ``://`` has empty host and path, no
rule and no alias; null or empty html has no edges; repeated pages are judged
alike; an empty table gives no row.  Extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written
from .components import connected_components

#: Fixed values of the contract.
RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)
DEFAULT = "allow"

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(c: Column) -> Column:
    return F.translate(c, _UPPER, _LOWER)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return F.coalesce(lower_ascii(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """struct(rule, verdict) of the longest rule that fits, or null."""
    found = F.lit(None)
    for h, p, verdict in sorted(rules, key=lambda r: (len(r[0]) + len(r[1]), [-ord(c) for c in r[0] + r[1]])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        found = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def _without_dots(rest: Column) -> Column:
    """A path (with its query) without ``.`` and ``..`` segments, as RFC 3986 has it."""
    path, query = F.regexp_extract(rest, r"(?s)^([^?]*)", 1), F.regexp_extract(rest, r"(?s)^[^?]*(.*)$", 1)
    segments = F.split(F.regexp_replace(path, "^/", ""), "/")
    plain = F.aggregate(segments, F.lit(""), lambda done, x: F.when(x == ".", done).when(
        x == "..", F.regexp_replace(done, r"(?s)/[^/]*$", "")).otherwise(F.concat(done, F.lit("/"), x)))
    end = F.when(path.rlike(r"/\.\.?$"), "/").otherwise("")  # such a path names a folder
    return F.when(path.rlike(r"/\.\.?(?:/|$)"), F.concat(plain, end, query)).otherwise(rest)


def node_of(url: Column) -> Column:
    """The url as a vertex: scheme and host in lower case, no fragment, no dot
    segments; null without ``://``."""
    plain = F.regexp_replace(F.trim(url), r"(?s)#.*$", "")
    head = F.regexp_extract(plain, r"(?s)^(.*?://[^/?]*)", 1)
    rest = F.regexp_extract(plain, r"(?s)^.*?://[^/?]*(.*)$", 1)
    return F.when(head != "", F.concat(lower_ascii(head), F.when(rest == "", "/").otherwise(_without_dots(rest))))


def _resolved(url: Column, target: Column) -> Column:
    """A link's target as a whole url."""
    scheme = F.regexp_extract(url, r"(?s)^(.*?)://", 1)
    origin = F.regexp_extract(url, r"(?s)^(.*?://[^/?#]*)", 1)
    folder = F.regexp_extract(F.regexp_replace(url, r"(?s)[?#].*$", ""), r"(?s)^(.*?://[^/]*(?:/.*/|/)?)", 1)
    folder = F.when(folder.endswith("/"), folder).otherwise(F.concat(folder, F.lit("/")))
    return (F.when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*://"), target)
            .when(target.startswith("//"), F.concat(scheme, F.lit(":"), target))
            .when(target.startswith("/"), F.concat(origin, target))
            .when(target.startswith("?"), F.concat(F.regexp_replace(url, r"(?s)[?#].*$", ""), target))
            .when((target == "") | target.startswith("#") | target.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), None)
            .otherwise(F.concat(folder, target)))


#: The named references that markup needs in attribute values.
NAMED = {"amp": "&", "quot": '"', "apos": "'", "lt": "<", "gt": ">"}
_REFERENCE = r"&(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|amp|quot|apos|lt|gt);"


def _entities(c: Column) -> Column:
    """Character references decoded, each once; those of no character stay."""
    def decoded(reference: Column) -> Column:
        hexadecimal = F.regexp_extract(reference, r"^&#[xX]([0-9a-fA-F]+);$", 1)
        decimal = F.regexp_extract(reference, r"^&#([0-9]+);$", 1)
        code = F.when(hexadecimal != "", F.conv(hexadecimal, 16, 10)).otherwise(decimal).try_cast("int")
        char = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
        out = F.when(code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF), char)
        for name, value in NAMED.items():
            out = out.when(reference == f"&{name};", F.lit(value))
        return out.otherwise(reference)

    between = F.split(c, _REFERENCE)
    references = F.concat(F.regexp_extract_all(c, F.lit(_REFERENCE), F.lit(0)), F.array(F.lit("")))
    return F.array_join(F.zip_with(between, references, lambda text, ref: F.concat(text, decoded(ref))), "")


def page_edges(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(a, b): each page's url and the url that it names or sends on to."""
    hint = F.col(html).rlike(r"(?i)canonical|http-equiv") & F.col(url).contains("://")
    bare = F.regexp_replace(F.col("html"), r"(?is)<!--.*?(?:-->|$)|<(script|style)\b.*?(?:</\1\s*>|$)", " ")
    # possessive: a repeated group that may go back would take a stack frame a character of a long tag
    tags = F.regexp_extract_all(bare, F.lit(r"""(?is)<(?:link|meta)\b(?:[^<>"']++|"[^"]*+"|'[^']*+')*+>"""), F.lit(0))
    based = F.regexp_extract(bare, r"""(?is)<base\b(?:[^<>"']++|"[^"]*+"|'[^']*+')*+>""", 0)

    def value(name: str, tag: Column = F.col("tag")) -> Column:
        found = F.regexp_extract(tag, rf"""(?is)[\s"']{name}\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", 1)
        return F.trim(F.regexp_replace(found, r"""^["']|["']$""", ""))

    # tables in between keep each expression small and evaluated once
    found = written(pages.select(F.col(url).alias("url"), F.col(html).alias("html")).where(hint)
                    .select("url", based.alias("base"), F.explode(tags).alias("tag")), "url-tags")
    kind = F.lower(F.substring("tag", 2, 4))
    values = written(found.select(
        "url", value("href", F.col("base")).alias("base"), F.lower(F.when(kind == "link", value("rel"))).alias("rel"), value("href").alias("href"),
        F.lower(F.when(kind == "meta", value("http-equiv"))).alias("equiv"), value("content").alias("content")),
        "url-values")
    onward = F.trim(F.regexp_extract("content", r"(?is)^[^;,]*[;,]\s*url\s*=\s*(.*)$", 1))
    onward = F.regexp_replace(onward, r"""^["']|["']$""", "")
    target = (F.when(F.col("rel").rlike(r"(^|\s)canonical(\s|$)"), F.col("href"))
              .when(F.col("equiv") == "refresh", onward))
    links = written(values.where(target != "").select(
        "url", F.trim(_entities(F.col("base"))).alias("base"), F.trim(_entities(target)).alias("target")), "url-links")
    based = written(links.where("target <> ''").select(
        "url", F.coalesce(F.when(F.col("base") != "", _resolved(F.col("url"), F.col("base"))), "url").alias("from"),
        "target"), "url-bases")
    whole = written(based.select("url", _resolved(F.col("from"), F.col("target")).alias("target")), "url-targets")
    return written(whole.select(node_of(F.col("url")).alias("a"), node_of(F.col("target")).alias("b")), "url-edges")


def judge(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", rules=RULES,
          redirects: DataFrame | None = None) -> DataFrame:
    """Per page: key, host, path, rule, verdict.  ``redirects`` may add edges
    (source_url, target_url)."""
    edges = page_edges(pages, url, html)
    if redirects is not None:
        edges = edges.union(redirects.select(node_of(F.col("source_url")), node_of(F.col("target_url"))))
    edges = edges.where("a <> b")
    link = F.col(url)
    judged = pages.select(F.col(key).alias(key), host_of(link).alias("host"), path_of(link).alias("path"),
                          node_of(link).alias("node"))
    judged = judged.withColumn("own", rule_of(F.col("host"), F.col("path"), rules))
    if edges.isEmpty():
        return judged.select(key, "host", "path", "own.rule", F.coalesce("own.verdict", F.lit(DEFAULT)).alias("verdict"))
    aliases = connected_components(edges)
    ruled = aliases.withColumn("own", rule_of(host_of(F.col("node")), path_of(F.col("node")), rules))
    decided = (ruled.groupBy("component")
               .agg(F.max(F.expr("int(own.verdict = 'allow')")).alias("allows"),
                    F.max(F.expr("int(own.verdict = 'block')")).alias("blocks"))
               .where("allows = 1 OR blocks = 1")
               .withColumn("shared", F.when(F.col("allows") == 1, "allow").otherwise("block")))
    by_url = ruled.where("own IS NULL").join(decided, "component").select(F.col("node").alias("_node"), "shared")
    # urls with a rule of their own need no partner
    wanted = F.when(F.col("own").isNull(), F.col("node"))
    return (judged.join(by_url, wanted == F.col("_node"), "left")
            .select(key, "host", "path", "own.rule",
                    F.coalesce("own.verdict", "shared", F.lit(DEFAULT)).alias("verdict")))


def oracle_sql() -> str:
    """The same by DuckDB: rules as a join, aliases by a recursive closure."""
    rules = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES)
    host = r"lower(regexp_extract({u}, '^(?s:.*?)://([^/?#]*)', 1))"
    path = r"regexp_extract({u}, '^(?s:.*?)://[^/?#]*([^?#]*)', 1)"
    # a path without dot segments, and what follows it
    rest = r"regexp_extract({u}, '://[^/?#]*([^#]*)', 1)"
    dotless = (r"CASE WHEN regexp_matches({u}, '://[^/?#]*[^?#]*/\.\.?(/|[?#]|$)') THEN "
               r"list_reduce(list_prepend('', string_split(regexp_extract({u}, '://[^/?#]*/([^?#]*)', 1), '/')), lambda done, x: "
               r"CASE x WHEN '.' THEN done WHEN '..' THEN regexp_replace(done, '/[^/]*$', '') ELSE done || '/' || x END) || "
               r"CASE WHEN regexp_matches({u}, '://[^?#]*/\.\.?([?#]|$)') THEN '/' ELSE '' END || "
               r"regexp_extract({u}, '://[^?#]*([?][^#]*)', 1) ELSE " + rest + " END")

    def node(u: str) -> str:
        return (f"lower(regexp_extract({u}, '^(.*?://[^/?#]*)', 1)) || CASE WHEN {rest.format(u=u)} = '' THEN '/' "
                f"ELSE {dotless.format(u=u)} END")

    canonical = (r"""(?is)<link\s[^>]*rel\s*=\s*["'']?canonical["'']?[^>]*>""")
    return rf"""
WITH RECURSIVE rules(rh, rp, rv) AS (VALUES {rules}),
plain AS (
  SELECT page_id, url, regexp_replace(coalesce(html, ''), '(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>', ' ', 'g') AS html
  FROM pages),
named AS (
  SELECT url, regexp_extract(regexp_extract(replace(html, '&amp;', '&'), '{canonical}'), '(?is)href\s*=\s*["'']?([^"''\s>]*)', 1) AS target FROM plain
  UNION
  SELECT url, regexp_extract(regexp_extract(html, '(?is)<meta\s[^>]*http-equiv\s*=\s*["'']?refresh[^>]*>'),
                             '(?is)url\s*=\s*["'']?([^"''>]*)', 1) FROM plain),
resolved AS (
  SELECT url, CASE WHEN target LIKE '%://%' THEN target
                   WHEN target LIKE '//%' THEN regexp_extract(url, '^(.*?):', 1) || ':' || target
                   WHEN target LIKE '/%' THEN regexp_extract(url, '^(.*?://[^/?#]*)', 1) || target
                   WHEN target NOT LIKE '#%' AND target NOT LIKE '?%' AND target NOT LIKE '%:%'
                   THEN regexp_extract(regexp_replace(url, '[?#].*$', '') || CASE WHEN regexp_matches(url, '://[^/?#]*$') THEN '/' ELSE '' END,
                                       '^(.*/)', 1) || target END AS target
  FROM named WHERE target <> '' AND url LIKE '%://%'),
edges AS (
  SELECT {node('url')} AS a,
         {node('target')} AS b
  FROM resolved WHERE target IS NOT NULL),
both_ways AS (SELECT a, b FROM edges UNION SELECT b, a FROM edges),
reach(node, other) AS (
  SELECT a, a FROM both_ways UNION SELECT r.node, e.b FROM reach r JOIN both_ways e ON r.other = e.a),
ruled AS (
  SELECT node, other, max_by(rv, length(rh) + length(rp)) AS rv
  FROM reach LEFT JOIN rules ON ({host.format(u='other')} = rh OR ends_with({host.format(u='other')}, '.' || rh))
       AND starts_with({path.format(u='other')}, rp)
  GROUP BY node, other),
shared AS (
  SELECT node, CASE WHEN bool_or(rv = 'allow') THEN 'allow' WHEN bool_or(rv = 'block') THEN 'block' END AS verdict
  FROM ruled GROUP BY node),
urls AS (
  SELECT page_id, row_number() OVER () AS row_no, coalesce({host.format(u='url')}, '') AS host, coalesce({path.format(u='url')}, '') AS path,
         {node('url')} AS node
  FROM pages),
own AS (
  SELECT page_id, row_no, host, path, node, max_by(rh || rp, length(rh) + length(rp)) AS rule,
         max_by(rv, length(rh) + length(rp)) AS rv
  FROM urls LEFT JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)
  GROUP BY page_id, row_no, host, path, node)
SELECT page_id, host, path, rule, coalesce(rv, shared.verdict, '{DEFAULT}') AS verdict
FROM own LEFT JOIN shared ON own.node = shared.node
"""
