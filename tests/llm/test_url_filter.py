import re
from html.parser import HTMLParser
from urllib.parse import urldefrag, urljoin

import duckdb
import pandas as pd
import pytest

from tests.llm.helpers import MIDDLE, least_reachable, oracle, rows, same_rows
from trajspark.llm import queries, url_filter

COLUMNS = ("page_id", "host", "path", "rule", "verdict")
SCHEMA = "page_id long, url string, html string"


class Links(HTMLParser):
    def __init__(self):
        super().__init__()
        self.found, self.skip = [], 0

    def handle_starttag(self, tag, attrs):
        a = {k: v or "" for k, v in reversed(attrs)}
        if tag == "template":
            self.skip += 1
        if self.skip:
            return
        if tag == "link" and "canonical" in a.get("rel", "").lower().split():
            self.found.append(a.get("href", "").strip())
        if tag == "meta" and a.get("http-equiv", "").lower() == "refresh":
            sent = re.match(r"(?is)[\d.\s]*[;,]\s*url\s*=\s*[\"']?([^\"']*)", a.get("content", ""))
            self.found += [sent[1].strip()] if sent else []

    def handle_endtag(self, tag):
        self.skip -= tag == "template"


def parts(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    low = str.maketrans(url_filter.UPPER, url_filter.LOWER)
    return (m[1].translate(low), m[2]) if m else ("", "")


def rule_of(url):
    host, path = parts(url)
    best = None
    for verdict, rule in (("block", "net/"), ("allow", "example.net/en/"),
                          ("block", "example.com/de/"), ("allow", "org/fr/")):
        name, _, rest = rule.partition("/")
        if ("." + host).endswith("." + name) and path.startswith("/" + rest) and (
                best is None or len(rule) > len(best[0])):
            best = rule, verdict
    return best


def spelled(url):
    m = re.match(r"(?s)(.*?://[^/?#]*)([^#]*)", url or "")
    return m and m[1].lower() + m[2]


def slow(pages, redirects=()):
    edges = list(redirects)
    for _, url, html in pages:
        finder = Links()
        finder.feed(html or "")
        finder.close()
        for href in finder.found:
            if url and href and "://" in url:
                edges.append((url, urljoin(url, href)))
    edges = [(spelled(a), spelled(b)) for a, b in edges]
    edges = [(a, b) for a, b in edges if a and b and a != b]
    roots = least_reachable({x for e in edges for x in e}, edges)
    groups = {}
    for url, root in roots.items():
        groups.setdefault(root, set()).add((rule_of(url) or (None, None))[1])
    out = []
    for page_id, url, _ in pages:
        rule = rule_of(url)
        said = groups.get(roots.get(spelled(url)), set())
        verdict = rule[1] if rule else (
            "block" if "block" in said and "allow" not in said else "allow")
        out.append((page_id, *parts(url), rule and rule[0], verdict))
    return sorted(out, key=repr)


def link(href):
    return f'<html><head><link rel="canonical" href="{href}"></head><p>x</p></html>'


PAGES = [
    (1, "http://a.example.com/en/1", link("https://x.net/1")),              # alias of a blocked one
    (2, "http://a.example.com/en/2#top", link("http://a.example.com/en/1")),
    (3, "http://A.Example.com/en/3", "<META content='0; URL=/en/2' HTTP-EQUIV=refresh>"),
    (4, "http://b.example.com/q", link("http://x.net/4") + link("http://y.org/fr/4")),    # allowed
    (5, "http://b.example.com/dir/r", "<link rel='x CANONICAL' href=../q?a=1&amp;b=2>"),
    (6, "http://b.example.com/q?a=1&b=2", link("?z")),
    (7, "http://b.example.com/q?z", link("//example.com/de/1")),
    (8, "http://c.example.com/1", "<!-- " + link("http://x.net/1") + " -->"),
    (9, "http://c.example.com/2", "<script>" + link("http://x.net/1") + "</SCRIPT >"),
    (10, "http://c.example.com/3", '<link rel="alternate" href="http://x.net/1">'),
    (11, "http://c.example.com/4", '<link rel="canonical"><link rel=canonical href="#a">'
                                   '<link rel=canonical href="mailto:a@x.net">'),
    (12, "http://www.example.net/en/1", link("http://x.net/1")),            # allowed by its own rule
    (13, "http://www.example.net/fr/1", None), (14, "http://example.net", ""),
    (15, "http://example.com/de/", "<p>"), (16, "http://notexample.com/de/", "<p>"),
    (17, None, link("http://x.net/1")), (18, "no scheme", link("http://x.net/1")),
    (19, "http://s.org/fr/1", "x" * 200_000), (20, "http://d.example.com/x/./y/..", link("../z/./a")),
    (21, "http://d.example.com/z/a", link("http://v.net/")), (None, "http://d.example.com/x/", "<p>"),
    (22, "http://e.example.com/1", "<link rel=canonical " + 'a="1" ' * 20_000 + "href=http://w.net/>"),
    (23, "http://e.example.com/2", "<meta name=a content='3;url=http://w.net/'><link rel=canonical "),
    (24, "http://e.example.com/3", "<template>" + link("http://x.net/1") + "</template>"),
    (1, "http://a.example.com/en/1", link("https://x.net/1")), (25, "HTTP://ÄB.EXAMPLE.COM/De", ""),
    (26, "://net/", ""), (27, "http://é.net/a\nb", link("c\nd")), (28, "http://f.com/1", ""),
]


@pytest.fixture(scope="module")
def pages(spark):
    frame = spark.createDataFrame(PAGES, SCHEMA)
    return frame.selectExpr("*", "1 AS node", "2 AS host", "'x' AS verdict", "3 AS `a.b`")


def test_cases(pages):
    assert rows(url_filter.url_verdicts(pages), *COLUMNS) == slow(PAGES)


def test_cases_by_sql(pages):
    con = duckdb.connect()
    con.register("pages", pd.DataFrame(PAGES, columns=["page_id", "url", "html"]).convert_dtypes())
    same_rows(url_filter.url_verdicts(pages).toPandas(), con.execute(url_filter.ORACLE_SQL).df())


def test_without_broadcast_and_with_redirects(spark, pages, monkeypatch):
    moved = [("http://f.com/1", "http://f.com/2"), ("http://f.com/2", "http://u.net/a"),
             (None, "http://u.net/a"), ("http://s.org/fr/1", "http://u.org/1")]
    given = spark.createDataFrame(moved, "from_url string, to_url string")
    wanted = slow(PAGES, moved)
    assert next(r for r in wanted if r[0] == 28)[4] == "block"
    assert rows(url_filter.url_verdicts(pages, redirects=given), *COLUMNS) == wanted
    plain_met = url_filter._met
    monkeypatch.setattr(url_filter, "_met", lambda *a: plain_met(*a, limit=-1))
    assert rows(url_filter.url_verdicts(pages, redirects=given), *COLUMNS) == wanted
    kept = url_filter.allowed_pages(pages, redirects=given)
    assert kept.columns == pages.columns
    assert sorted((r.page_id for r in kept.collect()), key=repr) == sorted(
        (r[0] for r in wanted if r[4] == "allow"), key=repr)


def test_hrefs_like_a_url_library(spark):
    base = "http://h.com/a/b/c?q#f"
    hrefs = ["d", "./d", "../d", "../../d", "../../../d", "/d/../e/", "..", ".", "d/.", "d/..", "?x",
             "//k.org/z", "https://K.org", "d?x=../y", "d#../y", "/", "/../x", "d/./e"]
    got = spark.createDataFrame([(base, h) for h in hrefs], "u string, h string").select(
        "h", url_filter.resolved(url_filter.F.col("u"), url_filter.F.col("h")).alias("r")).collect()
    for r in got:
        assert urldefrag(r.r)[0] == urldefrag(urljoin(base, r.h))[0], r.h


def test_a_long_chain_and_a_hot_target(spark):
    chain = [(k, f"http://g.com/{k}", link(f"/{k + 1}")) for k in range(300)]
    star = [(1000 + k, f"http://h.com/{k}", link("http://h.net/home")) for k in range(300)]
    got = url_filter.url_verdicts(spark.createDataFrame(
        chain + star + [(999, "http://g.com/300", link("http://z.net/end"))], SCHEMA))
    assert {r.verdict for r in got.collect()} == {"block"}


def test_empty_table(spark):
    assert url_filter.url_verdicts(spark.createDataFrame([], SCHEMA)).count() == 0


def test_whole_table(spark):
    found = queries.op13_url_filter(spark, MIDDLE)
    pages = [tuple(r) for r in queries.table(spark, MIDDLE, "pages").select(
        "page_id", "url", "html").collect()]
    assert rows(found, *COLUMNS) == slow(pages)
    same_rows(found.toPandas(), oracle(url_filter.ORACLE_SQL, MIDDLE))
