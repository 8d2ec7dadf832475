"""URL rules whose blocks spread over redirect and canonical-link aliases.

Addresses are nodes; a page's canonical links and refresh targets, resolved as a browser does, are
edges. Connected components give the alias groups. A page with a rule keeps the rule's verdict. A page
without one is allowed if any alias is allowed by a rule, else blocked if any alias is blocked,
else allowed.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from html import unescape
from html.entities import html5
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.llm.common import UPPER, stored
from tidemill.llm.components import connected_components


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str


RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)
#: Query parameters that name the way to a page and not the page.
TRACKING = r"(?:utm_[a-z]+|fbclid|gclid|ref)=[^&#]*"


def _lower(text: Column) -> Column:
    return F.translate(text, UPPER, UPPER.lower())


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; null or none: empty."""
    return F.coalesce(_lower(F.regexp_extract(url, r"(?s)^(?:(?!://).)*+://([^/?#]*+)", 1)),
                      F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.coalesce(
        F.regexp_extract(url, r"(?s)^(?:(?!://).)*+://[^/?#]*+(/[^?#]*+)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[Rule] = RULES) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, null if none does. Ties: the first listed."""
    text = verdict = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: len(r.host + r.path)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        text = F.when(fits, r.host + r.path).otherwise(text)
        verdict = F.when(fits, r.verdict).otherwise(verdict)
    return text, verdict


def plain_form(url: Column) -> Column:
    """Address without scheme, ``www.``, tracking parameters, fragment and trailing slash."""
    host = F.regexp_replace(host_of(url), "^www\\.", "")
    path = F.regexp_replace(path_of(url), "/+$", "")
    query = F.regexp_extract(url, r"(?s)^[^?#]*+\?([^#]*+)", 1)
    kept = F.regexp_replace(F.regexp_replace(query, rf"(?:^|(?<=&)){TRACKING}(?:&|$)", ""), "&$", "")
    return F.when(host != "", F.concat(host, path, F.when(kept != "", F.concat(F.lit("?"), kept))
                                       .otherwise("")))


#: Comments, elements whose content is text, and the tags that can hold links.
_TAGS = re.compile(
    r"""<!--(?:-?>|.*?--!?>|.*\Z)
      |<(script|style|textarea|title|xmp|iframe|noembed|noframes)\b(?:[^>"']|"[^"]*"|'[^']*')*+>
         .*?(?:</\1\b[^>]*>|\Z)
      |<(link|meta|base)(?=[\s/])((?:[^>"']|"[^"]*"|'[^']*')*+)>""", re.I | re.S | re.X)
_ATTRIBUTES = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>][^\s>]*))?""", re.S)
_REFERENCE = re.compile(r"&(?:#[0-9]+;?|#[xX][0-9A-Fa-f]+;?|[A-Za-z][A-Za-z0-9]*(?:;|(?![A-Za-z0-9=])))")
_REFRESH = re.compile(r"""\s*(?:\d+(?:\.[\d.]*)?|\.[\d.]+)(?:\s*[;,]\s*|\s+)(?:url\s*=\s*)?(.*)""",
                      re.I | re.S)
_ADDRESS = re.compile(r"([A-Za-z][A-Za-z0-9+.\-]*)://([^/?#]*)([^?#]*)(\?[^#]*)?", re.S)
_SCHEME = re.compile(r"[A-Za-z][A-Za-z0-9+.\-]*:")
_PORTS = {"http": "80", "https": "443"}
_LOWER = {ord(c): c.lower() for c in UPPER}


def _reference(found: re.Match) -> str:
    name = found[0]
    if name[1] != "#" and not name.endswith(";") and name[1:] not in html5:
        return name
    return unescape(name)


def _attributes(tag: str) -> dict[str, str]:
    """Attributes by lower-case name; of repeated ones the first counts."""
    out: dict[str, str] = {}
    for name, value in _ATTRIBUTES.findall(tag):
        value = value[1:-1] if value[:1] in "\"'" else value
        out.setdefault(name.lower(), _REFERENCE.sub(_reference, value))
    return out


def _segments(path: str) -> str:
    """``path`` with its dot segments carried out."""
    out: list[str] = []
    parts = path.split("/")[1:]
    for k, part in enumerate(parts):
        dots = part.lower().replace("%2e", ".")
        if dots == "..":
            del out[-1:]
        if dots not in (".", ".."):
            out.append(part)
        elif k == len(parts) - 1:
            out.append("")
    return "/" + "/".join(out)


def address(url: str | None) -> str | None:
    """``url`` as one name of what it leads to: scheme and host in lower case, no default port, no
    fragment, dot segments carried out, ``/`` for no path. None if it has no scheme and host."""
    cleaned = re.sub("[\t\n\r]", "", (url or "").strip("".join(map(chr, range(33)))))
    found = _ADDRESS.match(cleaned)
    if not found or not found[2]:
        return None
    scheme, host, path, query = found[1].lower(), found[2], found[3], found[4] or ""
    if scheme in _PORTS:
        path = path.replace("\\", "/")
    user, at, host = host.rpartition("@")
    host, colon, port = host.partition(":") if not host.startswith("[") else (host, "", "")
    port = "" if port == _PORTS.get(scheme, "") else port
    return (f"{scheme}://{user}{at}{host.translate(_LOWER)}{':' + port if port else ''}"
            f"{_segments(path)}{query}")


def resolved(base: str, target: str) -> str | None:
    """Address of ``target`` as seen from the address ``base``; None if it leads to no host."""
    target = re.sub("[\t\n\r]", "", target.strip("".join(map(chr, range(33)))))
    if _SCHEME.match(target):
        return address(target)
    scheme, host, path, query = _ADDRESS.match(base).groups(default="")
    origin = f"{scheme}://{host}"
    if scheme in _PORTS and target[:1] == "\\":
        target = target.replace("\\", "/")
    if target.startswith("//"):
        return address(f"{scheme}:{target}")
    if target.startswith("/"):
        return address(origin + target)
    if target.startswith("?"):
        return address(origin + path + target)
    if not target or target.startswith("#"):
        return address(origin + path + query)
    return address(origin + path[:path.rfind("/") + 1] + target)


def links(page: str, html: str) -> list[str]:
    """Addresses that the page at address ``page`` names as canonical or refreshes to.

    The first ``base`` moves what other links start from, wherever it stands in the page. Comments
    and the content of scripts, styles and text fields hold no links.
    """
    base, found = None, []
    for _, name, tag in _TAGS.findall(html):
        if not name:
            continue
        own = _attributes(tag)
        if name.lower() == "base":
            if base is None and "href" in own:
                base = resolved(page, own["href"])
        elif name.lower() == "link":
            if "canonical" in own.get("rel", "").lower().split() and own.get("href", "").strip():
                found.append(own["href"])
        elif own.get("http-equiv", "").strip().lower() == "refresh":
            to = _REFRESH.match(own.get("content", ""))
            to = to[1].strip() if to else ""
            if to[:1] in ("'", '"') and to:
                to = to[1:].partition(to[0])[0]
            if to:
                found.append(to)
    return [a for a in (resolved(base or page, t) for t in found) if a is not None]


def addresses(pages: DataFrame, id_col: str, url_col: str) -> DataFrame:
    """``page_id, url, address`` of every row."""
    kind = pages.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array([address(u) for u in batch.column(1).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, found], ["page_id", "url", "address"])

    return pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url")).mapInArrow(
        run, f"page_id {kind}, url string, address string")


def alias_edges(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``a, b``: addresses of pages and of what they name canonical or refresh to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = []
            for url, html in zip(batch.column(0), batch.column(1)):
                page = address(url.as_py())
                if page is not None:
                    pairs += [(page, to) for to in links(page, html.as_py())]
            yield pa.RecordBatch.from_arrays(
                [pa.array([p[k] for p in pairs], pa.string()) for k in (0, 1)], ["a", "b"])

    return pages.select(F.col(url_col).alias("url"), F.col(html_col).alias("html")).where(
        F.lower("html").contains("canonical") | F.lower("html").contains("http-equiv")
    ).mapInArrow(run, "a string, b string").distinct()


def judge(pages: DataFrame, rules: Sequence[Rule] = RULES, id_col: str = "page_id",
          url_col: str = "url", html_col: str = "html", plain_forms: bool = False) -> DataFrame:
    """``page_id, host, path, rule, verdict, decided`` for every row of ``pages``.

    ``decided`` says what gave the verdict: ``rule``, ``alias`` (an address of the group has a
    rule) or ``default`` (allow). ``plain_forms`` also ties addresses that only differ by scheme,
    ``www.``, a trailing slash or tracking parameters, which no link states; such verdicts read
    ``alias or form``.

    A null url or one without ``://`` has no host, no path, no rule and no aliases and is allowed.
    Null html has no links. Repeated rows are judged each. Equal rule lengths cannot fit one url
    with these rules; in general the rule listed first wins. An empty table gives no rows.
    """
    found = addresses(pages, id_col, url_col).select(
        "page_id", "url", "address", host_of(F.col("url")).alias("host"),
        path_of(F.col("url")).alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    rows = stored(found.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("own"),
                               "address"), "urls")
    edges = stored(alias_edges(pages, url_col, html_col), "aliases")
    # addresses of pages and of links with their own verdicts, with map-side combine
    _, far = rule_of(host_of(F.col("b")), path_of(F.col("b")), rules)
    named = stored(
        rows.where("address is not null").select("address", "own").union(edges.select("b", far))
        .groupBy("address").agg(F.max(F.col("own") == "allow").alias("allowed"),
                                F.max(F.col("own") == "block").alias("blocked")), "named")
    ties = edges.where("a <> b")
    if plain_forms:
        ties = ties.union(named.select("address", F.concat(F.lit("form "), plain_form(
            F.col("address")))))
    groups = stored(connected_components(stored(ties.distinct(), "links")), "groups")
    grouped = named.join(groups, F.col("address") == F.col("node")).select(
        "address", "component", "allowed", "blocked")
    spread = stored(grouped.groupBy("component").agg(
        F.max("allowed").alias("any_allowed"), F.max("blocked").alias("any_blocked")), "spread")
    final = stored(
        grouped.select("address", "component").join(spread, "component").select(
            F.col("address").alias("node"),
            F.when(F.col("any_allowed"), "allow").when(F.col("any_blocked"), "block")
            .alias("shared")), "verdicts")
    return rows.join(final, F.col("address") == F.col("node"), "left").select(
        "page_id", "host", "path", "rule",
        F.coalesce("own", "shared", F.lit("allow")).alias("verdict"),
        F.when(F.col("own").isNotNull(), "rule")
        .when(F.col("shared").isNotNull(), "alias or form" if plain_forms else "alias")
        .otherwise("default").alias("decided"))
