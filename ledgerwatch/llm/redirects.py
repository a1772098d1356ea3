"""URL rules with redirect equivalence.

A page's own rule decides first: of the rules that fit its host (or a parent domain) and path, the
longest, at equal length an allow.  Pages without a rule take what their aliases say: redirects
(meta refresh, or a table of observed ones) and canonical links are edges between URLs, the
connected components of these edges are classes of aliases, and a class with a blocked URL blocks
all its pages that no rule allows explicitly.  All other pages are allowed.

Edges are read with expressions in one pass over the pages; components are computed by rounds of
joins (see ``components``).  A URL to which a third of all pages point is a node of high degree,
whose neighbours are never gathered.

A null URL, or one without ``://``, has empty host and path and no aliases; null html has no links.
Repeated pages each get their row.  Empty tables give no rows.  Other columns are ignored.
"""

from pyspark.sql import functions as F

from ledgerwatch.llm.components import components
from ledgerwatch.llm.staging import stage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host(url):
    return F.coalesce(F.translate(
        F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path(url):
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def matching_rule(host_col, path_col, rules):
    """(rule, action) struct of the longest fitting rule, else null; ``rules``: (action, rule).

    The rules travel in the plan; a row's work grows with their number.
    """
    ordered = sorted(rules, key=lambda r: (-len(r[1]), r[0] != "allow", r[1]))
    chosen = None
    for action, rule in ordered:
        name, _, rest = rule.partition("/")
        fits = ((host_col == name) | host_col.endswith(f".{name}")) & path_col.startswith(f"/{rest}")
        value = F.struct(F.lit(rule).alias("rule"), F.lit(action).alias("action"))
        chosen = F.when(fits, value) if chosen is None else chosen.when(fits, value)
    return chosen if chosen is not None else F.lit(None).cast("struct<rule:string,action:string>")


def node(url):
    """A URL as a node: without fragment, the host in lower case; null where it has no ``://``."""
    plain = F.regexp_replace(F.trim(url), "(?s)#.*$", "")
    start = F.regexp_extract(plain, r"(?s)^(.*?://)[^/?#]*", 1)
    rest = F.regexp_extract(plain, r"(?s)^.*?://[^/?#]*(.*)$", 1)
    return F.when(F.contains(plain, F.lit("://")), F.concat(
        F.translate(start, UPPER, LOWER), host(plain), rest))


def resolve(base, href):
    """``href`` seen from the page ``base``."""
    href = F.replace(F.trim(href), F.lit("&amp;"), F.lit("&"))
    scheme = F.regexp_extract(base, r"(?s)^(.*?)://", 1)
    site = F.regexp_extract(base, r"(?s)^(.*?://[^/?#]*)", 1)
    folder = F.regexp_extract(base, r"(?s)^.*?://[^/?#]*([^?#]*/)", 1)
    return (F.when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), href)
            .when(href.startswith("//"), F.concat(scheme, F.lit(":"), href))
            .when(href.startswith("/"), F.concat(site, href))
            .when(href != "", F.concat(site, F.when(folder == "", "/").otherwise(folder), href)))


def links(html):
    """Targets of canonical links and of meta refreshes, as they are written."""
    link = F.filter(F.regexp_extract_all(html, F.lit(r"(?is)(<link\b[^>]*>)"), 1), lambda t: t.rlike(
        r"""(?is)\brel\s*=\s*["']?\s*canonical\b"""))
    meta = F.filter(F.regexp_extract_all(html, F.lit(r"(?is)(<meta\b[^>]*>)"), 1), lambda t: t.rlike(
        r"""(?is)\bhttp-equiv\s*=\s*["']?\s*refresh\b"""))
    href = r"""(?is)\bhref\s*=\s*["']?\s*([^"'\s>]+)"""
    url = r"""(?is)\burl\s*=\s*["']?\s*([^"'\s>]+)"""
    return F.concat(F.transform(link, lambda t: F.regexp_extract(t, href, 1)),
                    F.transform(meta, lambda t: F.regexp_extract(t, url, 1)))


def alias_edges(pages, url_col="url", html_col="html", redirects=None):
    """(u, v): the pages' links, and ``redirects`` (source, target) where such a table is given."""
    found = pages.select(node(F.col(url_col)).alias("u"), F.col(url_col).alias("base"),
                         F.explode(links(F.col(html_col))).alias("href"))
    edges = found.select("u", node(resolve(F.col("base"), F.col("href"))).alias("v"))
    if redirects is not None:
        edges = edges.unionAll(redirects.select(node(F.col("source")), node(F.col("target"))))
    return edges.dropna()


def judge(pages, rules, redirects=None, id_col="page_id", url_col="url", html_col="html"):
    """(id, host, path, rule, verdict) of every page."""
    def ruled(url):
        return matching_rule(host(url), path(url), rules)

    own = pages.select(
        F.col(id_col).alias(id_col), host(F.col(url_col)).alias("host"),
        path(F.col(url_col)).alias("path"), ruled(F.col(url_col)).alias("own"),
        node(F.col(url_col)).alias("node"))
    classes = stage(components(alias_edges(pages, url_col, html_col, redirects)), "url-classes")
    blocked = classes.withColumn("stop", ruled(F.col("node"))["action"] == "block").groupBy(
        "component").agg(F.max("stop").alias("stop")).filter("stop")
    aliases = classes.join(blocked, "component", "left_semi").select("node", F.lit(True).alias("alias"))
    return own.join(aliases, "node", "left").select(
        id_col, "host", "path", F.col("own.rule").alias("rule"),
        F.coalesce("own.action", F.when(F.col("alias"), "block"), F.lit("allow")).alias("verdict"))


SQL = r"""
WITH RECURSIVE raw AS (
  SELECT page_id, url, html, url AS u FROM pages
), links AS (
  SELECT u AS base, regexp_extract(t, '(?is)\bhref\s*=\s*["'']?\s*([^"''\s>]+)', 1) AS href
  FROM (SELECT u, unnest(regexp_extract_all(html, '(?is)<link\b[^>]*>')) AS t FROM raw)
  WHERE regexp_matches(t, '(?is)\brel\s*=\s*["'']?\s*canonical\b')
  UNION ALL
  SELECT u, regexp_extract(t, '(?is)\burl\s*=\s*["'']?\s*([^"''\s>]+)', 1)
  FROM (SELECT u, unnest(regexp_extract_all(html, '(?is)<meta\b[^>]*>')) AS t FROM raw)
  WHERE regexp_matches(t, '(?is)\bhttp-equiv\s*=\s*["'']?\s*refresh\b')
), targets AS (
  SELECT base, CASE
    WHEN regexp_matches(h, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN h
    WHEN h LIKE '//%' THEN regexp_extract(base, '(?s)^(.*?)://', 1) || ':' || h
    WHEN h LIKE '/%' THEN regexp_extract(base, '(?s)^(.*?://[^/?#]*)', 1) || h
    WHEN h <> '' THEN regexp_extract(base, '(?s)^(.*?://[^/?#]*)', 1)
      || COALESCE(NULLIF(regexp_extract(base, '(?s)^.*?://[^/?#]*([^?#]*/)', 1), ''), '/') || h
    END AS target
  FROM (SELECT base, replace(trim(href), '&amp;', '&') AS h FROM links)
), urls AS (
  SELECT base AS url FROM targets UNION SELECT target FROM targets UNION SELECT url FROM pages
), split AS (
  SELECT url, regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1) AS h0,
    COALESCE(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path,
    regexp_replace(trim(url), '(?s)#.*$', '') AS bare
  FROM urls
), named AS (
  SELECT url, COALESCE(translate(h0, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '')
      AS host, path,
    CASE WHEN bare LIKE '%://%' THEN translate(regexp_extract(bare, '(?s)^(.*?://[^/?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
      || regexp_extract(bare, '(?s)^.*?://[^/?#]*(.*)$', 1) END AS node
  FROM split
), rules(action, rule, rhost, rpath) AS (
  VALUES ('allow', 'org/', 'org', '/'), ('block', 'example.org/es/', 'example.org', '/es/'),
    ('block', 'example.org/en/1', 'example.org', '/en/1'), ('allow', 'com/fr/', 'com', '/fr/'),
    ('block', 'com/de/', 'com', '/de/')
), ruled AS (
  SELECT n.url, n.host, n.path, n.node, r.action, r.rule,
    row_number() OVER (PARTITION BY n.url ORDER BY length(r.rule) DESC NULLS LAST, r.action) AS place
  FROM named n LEFT JOIN rules r
    ON (n.host = r.rhost OR n.host LIKE '%.' || r.rhost) AND starts_with(n.path, r.rpath)
), best AS (SELECT * FROM ruled WHERE place = 1),
edges AS (
  SELECT a.node AS u, b.node AS v FROM targets t JOIN named a ON t.base = a.url
    JOIN named b ON t.target = b.url WHERE a.node IS NOT NULL AND b.node IS NOT NULL
), both_ways AS (SELECT u, v FROM edges UNION SELECT v, u FROM edges),
stopped(node) AS (
  SELECT b.node FROM best b JOIN both_ways e ON b.node = e.u WHERE b.action = 'block'
  UNION
  SELECT e.v FROM stopped s JOIN both_ways e ON s.node = e.u
)
SELECT p.page_id, COALESCE(b.host, '') AS host, COALESCE(b.path, '') AS path, b.rule,
  COALESCE(b.action, CASE WHEN b.node IN (SELECT node FROM stopped) THEN 'block' END, 'allow')
    AS verdict
FROM pages p LEFT JOIN best b ON p.url IS NOT DISTINCT FROM b.url
"""
