"""URL filter with redirect equivalence.

Rules name a host with a path and hold for all its subdomains; the longest that fits decides.
Pages that no rule fits take the decision of their aliases: canonical links, refreshes in a page
and given redirects are edges between URLs, and a connected component with a blocked URL is blocked
unless one of its URLs is explicitly allowed. URLs that are no page of the table link and decide
as well. Nodes are 125-bit hashes of URLs.
"""

from pyspark.sql import DataFrame, functions as F

from trajspark.llm.common import cut
from trajspark.llm.components import components

ALLOW, BLOCK = "allow", "block"
# The rules of the contract.
RULES = ((BLOCK, "net/"), (ALLOW, "example.net/en/"), (BLOCK, "example.com/de/"),
         (ALLOW, "org/fr/"))
SALTS = 16
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# A page without one of these has no edge; the costlier patterns are not tried on it.
HINT = r"(?i)canonical|http-equiv"
HIDDEN = r"(?is)<!--.*?(?:-->|\z)|<(script|style|template)\b.*?(?:</\1\s*>|\z)"
# Possessive groups run as loops, so that a long tag needs no stack.
TAG = r"(?is)<(?:link|meta)\b[^>\"']*+(?:(?:\"[^\"]*+\"|'[^']*+')[^>\"']*+)*+>"
VALUE = r"\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))"


def _lower(text):
    return F.translate(text, UPPER, LOWER)


def host_of(url):
    """What stands between the first `://` and the next `/`, `?` or `#`, A-Z lower-cased."""
    return F.coalesce(_lower(F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url):
    return F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def ruled(host, path, rules=RULES):
    """(rule, verdict) of the longest rule that fits, an allowing one of equal ones, or null.
    The rules are literals of the plan, so their number is bounded by the caller's."""
    order = sorted(rules, key=lambda r: (-len(r[1]), r[0] != ALLOW, r[1]))
    best = F.lit(None).cast("struct<rule: string, verdict: string>")
    for verdict, rule in reversed(order):
        name, slash, rest = rule.partition("/")
        name = name.translate(str.maketrans(UPPER, LOWER))
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        best = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))
                      ).otherwise(best)
    return best


def _attribute(tag, name):
    """The value of an attribute, whatever its quotes, with `&amp;` undone; empty without one."""
    pattern = rf"(?is)[\s\"'/]{name}{VALUE}"
    value = F.concat(*[F.regexp_extract(tag, pattern, k) for k in (1, 2, 3)])
    return F.replace(F.trim(value), F.lit("&amp;"), F.lit("&"))


def _undotted(path):
    """A path without `.` and `..` segments."""
    path = F.when(path.rlike(r"(?s)/\.\.?\z"), F.concat(path, F.lit("/"))).otherwise(path)
    return F.aggregate(
        F.split(F.regexp_replace(path, r"\A/", ""), "/", -1), F.lit(""),
        lambda done, part: F.when(part == ".", done).when(
            part == "..", F.regexp_replace(done, r"/[^/]*\z", "")).otherwise(
            F.concat(done, F.lit("/"), part)))


def resolved(url, href):
    """The URL that a reference in the page `url` points to; null for none and for schemes without
    a host. A `<base>` of the page is not heeded."""
    scheme = F.regexp_extract(url, r"(?s)\A(.*?)://", 1)
    root = F.regexp_extract(url, r"(?s)\A(.*?://[^/?#]*)", 1)
    bare = F.regexp_extract(href, r"(?s)\A([^?#]*)", 1)
    tail = F.regexp_extract(href, r"(?s)\A[^?#]*(.*)", 1)
    folder = F.regexp_replace(path_of(url), r"[^/]*\z", "")
    folder = F.when(folder == "", F.lit("/")).otherwise(folder)
    return F.when(href.rlike(r"(?s)\A[A-Za-z][A-Za-z0-9+.-]*://"), href).when(
        href.startswith("//"), F.concat(scheme, F.lit(":"), href)).when(
        (href == "") | href.startswith("#") | href.rlike(r"(?s)\A[A-Za-z][A-Za-z0-9+.-]*:")
        | (root == ""), None).when(
        href.startswith("?"), F.concat(root, path_of(url), href)).when(
        href.startswith("/"), F.concat(root, _undotted(bare), tail)).otherwise(
        F.concat(root, _undotted(F.concat(folder, bare)), tail))


def targets(url, html):
    """The URLs that a page names as its own other ones: canonical links and refreshes outside
    comments, scripts, styles and templates."""
    tags = F.regexp_extract_all(F.regexp_replace(html, HIDDEN, " "), F.lit(TAG), F.lit(0))

    def href(tag):
        link = tag.rlike(r"(?i)\A<link") & F.array_contains(
            F.split(_lower(_attribute(tag, "rel")), r"\s+"), "canonical")
        refresh = tag.rlike(r"(?i)\A<meta") & (_lower(_attribute(tag, "http-equiv")) == "refresh")
        sent = F.regexp_extract(_attribute(tag, "content"),
                                r"(?is)\A[\d.\s]*[;,]\s*url\s*=\s*[\"']?([^\"']*)", 1)
        return F.when(link, _attribute(tag, "href")).when(refresh, F.trim(sent))
    found = F.filter(F.transform(tags, href), lambda h: h.isNotNull())
    return F.filter(F.transform(found, lambda h: resolved(url, h)), lambda u: u.isNotNull())


def plain(url):
    """One spelling of a URL: scheme and host in small letters, no fragment."""
    start = F.regexp_extract(url, r"(?s)\A(.*?://[^/?#]*)", 1)
    rest = F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^#]*)", 1)
    return F.when(start != "", F.concat(_lower(start), rest))


def node(url):
    """A URL's node: two hashes in one number, so that equal nodes are equal URLs at any scale."""
    key = plain(url)
    high, low = F.xxhash64(key), F.xxhash64(F.lit("low"), key).bitwiseAND(F.lit((1 << 62) - 1))
    return F.when(key.isNotNull(), (high.cast("decimal(20,0)") * F.lit(1 << 62).cast(
        "decimal(19,0)") + low).cast("decimal(38,0)"))


def _met(rows, few, key, by, limit=32 << 20, row_bytes=128):
    """Left join with rows of unique `key`: a broadcast if they are counted as few, else a shuffle
    in which the partners of a hot key are spread by `by`."""
    if few.count() * row_bytes <= limit:
        return rows.join(F.broadcast(few), key, "left")
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt")
    return (rows.withColumn("_salt", F.pmod(F.xxhash64(*by), F.lit(SALTS)).cast("int"))
            .join(few.select("*", salts), [key, "_salt"], "left").drop("_salt"))


def alias_edges(pages: DataFrame, redirects: DataFrame | None = None) -> DataFrame:
    """(a, b) pairs of different URLs, once each, from the pages' html and (from_url, to_url)."""
    found = (pages.filter(F.col("html").rlike(HINT))
             .select("url", F.explode(targets(F.col("url"), F.col("html"))).alias("to")))
    if redirects is not None:
        found = found.union(redirects.select("from_url", "to_url"))
    urls = found.select(plain(F.col("url")).alias("a"), plain(F.col("to")).alias("b"))
    return urls.filter(F.col("a") != F.col("b")).distinct()


def blocked_nodes(edges: DataFrame, rules=RULES) -> DataFrame:
    """Nodes of components that hold a blocked URL and no explicitly allowed one."""
    def end(c):
        return F.struct(node(F.col(c)).alias("node"), ruled(
            host_of(F.col(c)), path_of(F.col(c)), rules)["verdict"].alias("verdict"))
    ends = cut(edges.select(end("a").alias("a"), end("b").alias("b")))
    roots = components(ends.select(F.col("a.node").alias("a"), F.col("b.node").alias("b")))
    nodes = ends.select(F.explode(F.array("a", "b")).alias("end")).select("end.*").distinct()
    nodes = cut(nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")))
    bad = cut(nodes.groupBy("root").agg(
        F.max(F.col("verdict") == BLOCK).alias("bad"), F.max(F.col("verdict") == ALLOW).alias("good"))
        .filter(F.col("bad") & ~F.coalesce("good", F.lit(False))).select("root", "bad"))
    return cut(_met(nodes.select("node", "root"), bad, "root", ["node"]).filter("bad")
               .select("node", F.lit(True).alias("alias_blocked")))


def url_verdicts(pages: DataFrame, rules=RULES, redirects: DataFrame | None = None) -> DataFrame:
    """page_id, host, path, rule and verdict of every page.

    A rule that fits the page's own URL decides; a page without one is blocked if its component is
    and allowed otherwise, also without any alias. Null urls and those without `://` have empty
    host and path, fit no rule and have no alias. Null html has no links; repeated rows are judged
    each. Other columns are ignored; an empty table gives an empty result.
    """
    blocked = blocked_nodes(alias_edges(pages, redirects), rules)
    rows = pages.select("page_id", host_of(F.col("url")).alias("host"),
                        path_of(F.col("url")).alias("path"), node(F.col("url")).alias("node"))
    rows = rows.withColumn("_rule", ruled(F.col("host"), F.col("path"), rules))
    rows = _met(rows, blocked, "node", ["page_id"])
    return rows.select("page_id", "host", "path", F.col("_rule.rule").alias("rule"), F.coalesce(
        "_rule.verdict", F.when(F.col("alias_blocked"), BLOCK), F.lit(ALLOW)).alias("verdict"))


def allowed_pages(pages: DataFrame, rules=RULES, redirects: DataFrame | None = None) -> DataFrame:
    """The pages, all columns, whose verdict is allow."""
    blocked = blocked_nodes(alias_edges(pages, redirects), rules)
    url, names = F.col("url"), [F.col(f"`{c}`") for c in pages.columns]
    rows = pages.select(F.struct(*names).alias("_page"), node(url).alias("node"),
                        ruled(host_of(url), path_of(url), rules)["verdict"].alias("_own"))
    rows = _met(rows, blocked, "node", ["_page.page_id"])
    kept = rows.filter(F.coalesce("_own", F.when(F.col("alias_blocked"), BLOCK), F.lit(ALLOW))
                       == ALLOW)
    return kept.select("_page.*")


def _sql_host(u):
    return (f"translate(coalesce(regexp_extract({u}, '(?s)\\A.*?://([^/?#]*)', 1), ''), "
            f"'{UPPER}', '{LOWER}')")


def _sql_path(u):
    return f"coalesce(regexp_extract({u}, '(?s)\\A.*?://[^/?#]*([^?#]*)', 1), '')"


def _sql_rule(host, path, part):
    """The chosen rule, or its verdict, by the length of rules."""
    cases = []
    for verdict, rule in sorted(RULES, key=lambda r: -len(r[1])):
        name, rest = rule.split("/", 1)
        cases.append(f"WHEN ({host} = '{name}' OR ends_with({host}, '.{name}')) AND "
                     f"starts_with({path}, '/{rest}') THEN '{rule if part == 'rule' else verdict}'")
    return f"CASE {' '.join(cases)} END"


def _sql_attribute(tag, name):
    value = "(?:\"([^\"]*)\"|''([^'']*)''|([^\\s\"''>]+))"
    parts = " || ".join(f"regexp_extract({tag}, '(?is)[\\s\"''/]{name}\\s*=\\s*{value}', {k})"
                        for k in (1, 2, 3))
    return f"replace(trim({parts}), '&amp;', '&')"


def _sql_plain(u):
    start = f"regexp_extract({u}, '(?s)\\A.*?://[^/?#]*')"
    return (f"CASE WHEN {start} <> '' THEN translate({start}, '{UPPER}', '{LOWER}') || "
            f"regexp_extract({u}, '(?s)\\A.*?://[^/?#]*([^#]*)', 1) END")


_HIDDEN = "|".join(["(?is)<!--.*?(?:-->|\\z)"] + [
    f"<{n}\\b.*?(?:</{n}\\s*>|\\z)" for n in ("script", "style", "template")])
_UNDOTTED = """list_reduce(list_prepend('', string_split(CASE
    WHEN regexp_matches(way, '/\\.\\.?\\z') THEN way || '/' ELSE way END, '/')[2:]),
  lambda done, part: CASE part WHEN '.' THEN done
    WHEN '..' THEN regexp_replace(done, '/[^/]*\\z', '') ELSE done || '/' || part END)"""

ORACLE_SQL = f"""
WITH RECURSIVE judged AS (
  SELECT page_id, url, html, {_sql_host('url')} AS host, {_sql_path('url')} AS path FROM pages),
tags AS (
  SELECT url, host, path, unnest(regexp_extract_all(regexp_replace(html, '{_HIDDEN}', ' ', 'g'),
    '(?is)<(?:link|meta)\\b[^>"'']*(?:(?:"[^"]*"|''[^'']*'')[^>"'']*)*>')) AS tag
  FROM judged WHERE contains(url, '://')),
named AS (
  SELECT url, path, CASE
    WHEN tag ILIKE '<link%' AND list_contains(
      regexp_split_to_array(lower({_sql_attribute('tag', 'rel')}), '\\s+'), 'canonical')
      THEN {_sql_attribute('tag', 'href')}
    WHEN tag ILIKE '<meta%' AND lower({_sql_attribute('tag', 'http-equiv')}) = 'refresh'
      THEN trim(regexp_extract({_sql_attribute('tag', 'content')},
        '(?is)\\A[\\d.\\s]*[;,]\\s*url\\s*=\\s*["'']?([^"'']*)', 1)) END AS href
  FROM tags),
split AS (
  SELECT *, regexp_extract(url, '(?s)\\A(.*?)://', 1) AS scheme,
    regexp_extract(url, '(?s)\\A.*?://[^/?#]*') AS root,
    regexp_extract(href, '(?s)\\A[^?#]*') AS bare,
    regexp_extract(href, '(?s)\\A[^?#]*(.*)', 1) AS tail,
    CASE WHEN regexp_replace(path, '[^/]*\\z', '') = '' THEN '/'
      ELSE regexp_replace(path, '[^/]*\\z', '') END AS folder
  FROM named WHERE href <> '' AND NOT starts_with(href, '#')),
ways AS (SELECT *, CASE WHEN starts_with(bare, '/') THEN bare ELSE folder || bare END AS way
  FROM split),
found AS (
  SELECT url, CASE WHEN regexp_matches(href, '\\A[A-Za-z][A-Za-z0-9+.-]*://') THEN href
    WHEN starts_with(href, '//') THEN scheme || ':' || href
    WHEN regexp_matches(href, '\\A[A-Za-z][A-Za-z0-9+.-]*:') THEN NULL
    WHEN starts_with(href, '?') THEN root || path || href
    ELSE root || {_UNDOTTED} || tail END AS target
  FROM ways),
edges AS (
  SELECT DISTINCT a, b FROM (SELECT {_sql_plain('url')} AS a, {_sql_plain('target')} AS b FROM found)
  WHERE a <> b),
both_ways AS (SELECT a, b FROM edges UNION SELECT b, a FROM edges),
nodes AS (SELECT a, {_sql_rule(_sql_host('a'), _sql_path('a'), 'verdict')} AS verdict
  FROM (SELECT DISTINCT a FROM both_ways)),
reach AS (
  SELECT a, verdict FROM nodes WHERE verdict IS NOT NULL
  UNION SELECT e.b, r.verdict FROM reach r JOIN both_ways e ON e.a = r.a),
blocked AS (SELECT a FROM reach GROUP BY a HAVING bool_and(verdict = 'block'))
SELECT page_id, host, path, {_sql_rule('host', 'path', 'rule')} AS rule,
  coalesce({_sql_rule('host', 'path', 'verdict')}, CASE WHEN {_sql_plain('url')} IN (
    SELECT a FROM blocked) THEN 'block' END, 'allow') AS verdict
FROM judged
"""
