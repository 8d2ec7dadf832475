"""Rules against a plain version; blocks over aliases by hand."""

import random
import re
from urllib.parse import urljoin, urlsplit

import pytest

from tidemill.llm.urlfilter import RULES, address, judge, links, resolved

SCHEMA = "page_id long, url string, html string, host int, component string, own int"


def plain(url):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host):])[0]
        host = "".join(c.lower() if c.isascii() else c for c in host)
    best = None
    for verdict, h, p in RULES:
        if (host == h or host.endswith("." + h)) and path.startswith(p):
            if best is None or len(h + p) > len(best[0]):
                best = h + p, verdict
    return host, path, *(best or (None, None))


def run(spark, rows, **how):
    pages = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA)
    return {(r.page_id, r.host, r.path): (r.rule, r.verdict)
            for r in judge(pages, **how).collect()}


def link(target):
    return f'<html><head><LINK href="{target}" rel="canonical"></head></html>'


def test_rules_equal_plain(spark):
    urls = [None, "", "no scheme", "http://", "HTTP://A.ORG", "http://a.org/", "x://org/es/",
            "http://example.org/es/1", "http://b.EXAMPLE.org/en/12?x#y", "http://notexample.org/es/",
            "http://c.com/fr/", "http://c.com/FR/", "http://c.com/de/#", "http://com/de/",
            "http://c.com?/de/", "http://c.com#/de/", "a://b://c.org/", "http://é.com/de/\nx",
            "http://u:p@c.com:80/de/", "http://c.org:80/", "http://İ.org/", "://org/"]
    got = run(spark, [(k, u, None) for k, u in enumerate(urls)])
    assert len(got) == len(urls)
    for k, u in enumerate(urls):
        host, path, rule, verdict = plain(u)
        assert got[(k, host, path)][0] == rule, u
        assert got[(k, host, path)][1] == (verdict or "allow"), u


def test_blocks_spread_over_aliases_and_allow_goes_first(spark):
    rows = [
        (1, "http://a.com/de/1", None),                      # blocked by a rule
        (2, "http://b.net/2", link("HTTP://A.com:80/x/../de/1#part")),
        (3, "http://c.net/3", '<meta http-equiv="refresh" content="0; url=http://b.net/2#top">'),
        (4, "http://d.net/4", link("/5")), (5, "http://d.net/5?a=1", None),
        (6, "http://e.net/6", link("http://gone.com/de/x")),  # alias that is no page
        (7, "http://f.net/7", link("http://x.org/7")),        # alias allowed ...
        (8, "http://g.net/8", link("http://f.net/7")),
        (9, "http://h.com/de/9", link("http://g.net/8")),     # ... and one blocked
        (10, "http://b.net/2#x", None), (10, "http://b.net/2#x", None),
        (11, "http://i.net/11", "<link rel=canonical href=>"),
    ]
    got = {k[0]: v for k, v in run(spark, rows).items()}
    assert [got[k][1] for k in range(1, 12)] == [
        "block", "block", "block", "allow", "allow", "block", "allow", "allow", "block", "block",
        "allow"]
    assert got[3][0] is None and got[9][0] == "com/de/"


def test_targets_that_end_in_a_slash_and_references(spark):
    refresh = '<meta http-equiv="refresh" content="0; url=http://shop.com/de/">'
    rows = [
        (1, "http://a.net/1", link("http://shop.com/de/")), (2, "http://b.net/2", refresh),
        (3, "http://c.com/de/3", None), (4, "http://d.net/4", link("http://c.com/de/3")),
        (5, "http://e.net/5", link("http://c.com/de/3")), (5, "http://e.net/5", link("http://x.org/")),
        (6, "http://f.net/6", link("http://g.net/a?x=1&amp;y=2")),
        (7, "http://g.net/a?x=1&y=2", link("http://h.com/de&#x2F;")),
        (8, "http://own.com/de", link("/de/")), (9, "http://i.net/9", link("/a?b=1&copy=2&#0;&#99999999;")),
    ]
    got = {k[0]: v[1] for k, v in run(spark, rows).items()}
    assert [got[k] for k in range(1, 10)] == [
        "block", "block", "block", "allow", "allow", "block", "block", "block", "allow"]


def test_a_hub_and_a_long_chain(spark):
    rows = [(0, "http://hub.com/de/0", None)]
    rows += [(k, f"http://n.net/{k}", link("http://hub.com/de/0")) for k in range(1, 300)]
    rows += [(k, f"http://n.net/{k}", link(f"http://n.net/{k - 1}")) for k in range(300, 380)]
    got = run(spark, rows)
    assert len(got) == 380 and {v[1] for v in got.values()} == {"block"}


def test_empty_table(spark):
    assert run(spark, []) == {}


def test_address_forms_are_ties_only_when_asked(spark):
    rows = [(1, "http://a.com/de/1", None), (2, "http://b.net/2", link("https://www.b.com/2/")),
            (3, "http://b.com/2?utm_source=x", link("http://a.com/de/1")),
            (4, "https://www.b.com/2", None)]
    pages = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA)
    plainly = {r.page_id: (r.verdict, r.decided) for r in judge(pages).collect()}
    assert plainly == {1: ("block", "rule"), 2: ("allow", "default"), 3: ("block", "alias"),
                       4: ("allow", "default")}
    tied = {r.page_id: (r.verdict, r.decided) for r in judge(pages, plain_forms=True).collect()}
    assert tied == {1: ("block", "rule"), 2: ("block", "alias or form"),
                    3: ("block", "alias or form"), 4: ("block", "alias or form")}


PAGE = "http://site.net/dir/page?id=1"


@pytest.mark.parametrize("html,want", [
    ('<link rel=canonical href="/login?next=http://shop.com/de/x">',
     ["http://site.net/login?next=http://shop.com/de/x"]),
    ('<link rel=canonical href="../b">', ["http://site.net/b"]),
    ('<link rel=canonical href="./b">', ["http://site.net/dir/b"]),
    ('<link rel=canonical href="?id=2">', ["http://site.net/dir/page?id=2"]),
    ('<link rel="shortlink Canonical" href=/c>', ["http://site.net/c"]),
    ('<link title="a > b" rel=canonical href="/c">', ["http://site.net/c"]),
    ('<meta http-equiv=Refresh content="0; http://o.org/x">', ["http://o.org/x"]),
    ('<meta http-equiv=refresh content="0;URL=\'/y\'z">', ["http://site.net/y"]),
    ('<meta http-equiv=refresh content="5">', []),
    ('<meta http-equiv=refresh content="  3.5 , /w ">', ["http://site.net/w"]),
    ('<link rel=canonical href="HTTP://Shop.COM:80">', ["http://shop.com/"]),
    ('<link rel=canonical href="https://shop.com:443/a">', ["https://shop.com/a"]),
    ('<link rel=canonical href="https://shop.com:80/a">', ["https://shop.com:80/a"]),
    ('<!-- <link rel=canonical href="/c"> -->', []),
    ('<!--><link rel=canonical href="/c">', ["http://site.net/c"]),
    ('<!-- open <link rel=canonical href="/c">', []),
    ('<script>"<link rel=canonical href=/c>"</script><link rel=canonical href=/d>',
     ["http://site.net/d"]),
    ('<link rel=canonical href=b><base href="//cdn.net/q/"><base href="/z/">',
     ["http://cdn.net/q/b"]),
    ('<link rel=canonical href="mailto:a@b.com"><link rel=canonical href="javascript:x://y">', []),
    ('<link rel=canonical rel=next href="/1" href="/2">', ["http://site.net/1"]),
    ('<link rel=next href="/1"><linker rel=canonical href="/2">', []),
    ('<link rel=canonical href="/a?x=1&amp;y=2&copy=3&#x26;z">',
     ["http://site.net/a?x=1&y=2&copy=3&z"]),
    ('<link rel=canonical href="#top">', ["http://site.net/dir/page?id=1"]),
    ('<link rel=canonical href=" /s\np ">', ["http://site.net/sp"]),
    ('<link rel=canonical href="unclosed>', []),
])
def test_links_of_a_page(html, want):
    assert links(address(PAGE), f"<html>{html}</html>") == want


def test_resolution_equals_the_library():
    rng = random.Random(3)
    signs = ["/", "..", ".", "a", "b c", "?", "#", "x=1", "//", "é", "%41"]
    for _ in range(4000):
        base = "http://h.net/" + "".join(rng.choice(["d/", "e/", "f", "?q", "..x/"]) for _ in range(4))
        target = "".join(rng.choice(signs) for _ in range(rng.randint(1, 6)))
        # the library joins empty segments, a browser keeps them
        if "//" in target[1:] or target.startswith("//") and not re.match("//[^/?#]", target):
            continue
        want = urlsplit(urljoin(address(base), target.strip()))
        path = want.path
        got = resolved(address(base), target)
        if not path.startswith("/") and path:
            continue
        assert urlsplit(got).netloc == want.netloc.lower(), (base, target)
        assert address(want._replace(fragment="").geturl()) == got.rstrip("?") or "?" in target, (
            base, target, got)


def test_generated_pages_equal_union_find(spark):
    rng = random.Random(9)
    hosts = ["a.com", "b.net", "x.org", "example.org", "shop.com", "c.net"]
    paths = ["/", "/de/", "/de/1", "/fr/2", "/es/3", "/en/1", "/q", "/q?p=1", "/w/x/y"]
    pool = [f"{s}://{h}{p}" for s in ("http", "https") for h in hosts for p in paths]
    rows, edges = [], []
    for k in range(400):
        url = rng.choice(pool) if rng.random() < 0.4 else f"http://n{k}.net/{k}"
        html = None
        if rng.random() < (0.6 if "//n" in url else 0.01):  # more would tie all pages together
            to = rng.choice([rng.choice(pool), f"http://n{k - 1}.net/{k - 1}", "../z",
                             "/de/", "?p=2", "", "//shop.com/fr/"])
            if rng.random() < 0.5:
                html = f"<p>x</p><link class='>' rel='canonical' href='{to}'>"
            else:
                html = f'<meta content="1;url={to}" http-equiv="refresh">'
            if to:
                edges.append((url, urljoin(url, to)))
        rows.append((k, url, html))
    clean = lambda u: u if urlsplit(u).path else u + "/"
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        root[find(clean(a))] = find(clean(b))
    seen = {}
    for u in {clean(u) for _, u, _ in rows} | {clean(b) for _, b in edges}:
        seen.setdefault(find(u), set()).add(plain(u)[3])
    got = run(spark, rows)
    for k, u, _ in rows:
        host, path, rule, own = plain(u)
        group = seen[find(clean(u))]
        want = own or ("allow" if "allow" in group else "block" if "block" in group else "allow")
        assert got[(k, host, path)] == (rule, want), u
    assert {v[1] for v in got.values()} == {"allow", "block"} and any(
        r is None and v == "block" for r, v in got.values())
