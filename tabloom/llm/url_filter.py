"""URL rules whose decisions spread over redirect and canonical-link aliases."""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tabloom.llm.components import components
from tabloom.llm.storage import written

#: Fixed values: (verdict, host, path).
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
#: Comments, elements whose content is text, and then the tags that declare links.
PARTS = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(script|style|textarea|title|xmp|iframe|noembed|noframes)\b[^>]*>.*?(?:</\1\b|\Z)|<(link|meta|base)\b((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""", re.I | re.S
)
ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
#: In the content of a refresh: seconds, then the address.
TARGET = re.compile(r"""[\s\d.]*[;,\s]\s*(?:url\s*=\s*)?(?:"([^"]*)|'([^']*)|([^"'\s].*))""", re.I | re.S)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.coalesce(F.when(at > 0, url.substr(at + 3, F.length(url))), F.lit(""))


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def node_of(url: Column) -> Column:
    """The resource an address names: no fragment, lower-case scheme and host; NULL if it has no ``://``."""
    rest = F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^#]*)", 1)
    return F.when(F.instr(url, "://") > 0, F.concat(F.lower(F.substring_index(url, "://", 1)), F.lit("://"), host_of(url), rest))


def _declared(url: str, html: str) -> Iterator[str]:
    """Addresses, resolved, of all canonical and refresh tags."""
    base, targets = "", []
    for found in PARTS.finditer(html):
        tag = (found[2] or "").lower()
        own: dict[str, str] = {}
        for name, *values in ATTRIBUTE.findall(found[3] or ""):
            own.setdefault(name.lower(), entities.unescape("".join(values)))
        if tag == "base":
            base = base or own.get("href", "")
        elif tag == "link" and "canonical" in own.get("rel", "").lower().split():
            targets.append(own.get("href", ""))
        elif tag == "meta" and own.get("http-equiv", "").strip().lower() == "refresh" and (to := TARGET.match(own.get("content", ""))):
            targets.append(to[1] or to[2] or to[3] or "")
    for to in targets:
        to = to.strip()
        if to and not to.startswith("#"):
            try:
                yield urljoin(urljoin(url, base.strip()), to)
            except ValueError:  # an address that cannot be read, such as http://[
                continue


def page_links(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Edges (src, dst) that pages declare: every ``rel=canonical`` and ``http-equiv=refresh``.

    Targets are resolved against the page's address, or its ``base``. Tags in comments
    and scripts do not count; pages without address or html have none. Only pages that
    hold one of the two words are read in Python.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = [(url, to) for url, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) for to in _declared(url, html)]
            columns = list(zip(*pairs)) or [(), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], names=["url", "to"])

    worded = F.col(html_col).rlike("(?i)canonical|refresh|&#")  # a value may be written in entities
    able = pages.where(F.col(url_col).contains("://") & worded).select(F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    seen = able.mapInArrow(read, "url string, to string")
    return seen.select(node_of(F.col("url")).alias("src"), node_of(F.col("to")).alias("dst")).where("src IS NOT NULL AND dst IS NOT NULL AND src <> dst").distinct()


def _fitting(host: Column, path: Column, rules) -> tuple[Column, Column]:
    """(rule text, verdict) of the longest rule that fits; a chain of conditions, longest first."""
    text = verdict = F.lit(None).cast("string")
    for kind, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        text = F.when(fits, F.lit(rule_host + rule_path)).otherwise(text)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return text, verdict


def judge_urls(
    pages: DataFrame, rules=RULES, redirects: DataFrame | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, alias_id.

    A page's own rule decides. Otherwise its alias class decides: the addresses that
    redirects (``src``, ``dst`` addresses) and the pages' own canonical and refresh
    links connect, and repeats of one address. A class that holds an address with an
    allow rule is allowed, else one with a block rule is blocked, else all is allowed.
    ``alias_id`` is the smallest address of the class. NULL addresses and those without
    ``://`` have empty host and path, no class, and are allowed. Repeated pages give
    repeated rows; an empty table gives none.
    """
    url = F.col(url_col)
    text, verdict = _fitting(F.col("host"), F.col("path"), rules)
    seen = pages.select(F.col(id_col).alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"), node_of(url).alias("node"))
    seen = seen.withColumns({"rule": text, "own": verdict})
    links = page_links(pages, url_col, html_col)
    if redirects is not None:
        links = links.unionByName(redirects.select(node_of(F.col("src")).alias("src"), node_of(F.col("dst")).alias("dst")))
    linked = written(components(links, "src", "dst"), "url-aliases")
    # addresses that only links name have a rule as well
    nodes = seen.select("node", "own").unionByName(
        linked.select("node", _fitting(host_of(F.col("node")), path_of(F.col("node")), rules)[1].alias("own"))
    )
    ruled = nodes.where("node IS NOT NULL AND own IS NOT NULL").distinct()
    alias = F.coalesce("component", "node").alias("alias_id")
    decided = (
        ruled.join(linked, "node", "left")
        .select(alias, "own")
        .groupBy("alias_id")
        .agg(F.min("own").alias("class_verdict"))  # "allow" sorts before "block"
    )
    decided = written(decided, "url-verdicts")  # a join of two plain shuffles can split a hot class
    out = seen.join(linked, "node", "left").select("page_id", "host", "path", "rule", "own", alias)
    return out.join(decided, "alias_id", "left").select(
        "page_id", "host", "path", "rule", F.coalesce("own", "class_verdict", F.lit("allow")).alias("verdict"), "alias_id"
    )


SQL = r"""
WITH p AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest,
         CASE WHEN instr(url, '://') > 0 THEN lower(substr(url, 1, instr(url, '://') - 1)) END AS scheme FROM pages),
q AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path, scheme, regexp_extract(rest, '^[^/?#]*([^#]*)', 1) AS tail FROM p),
rules(kind, rhost, rpath) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
r AS (SELECT page_id, host, path, scheme || '://' || host || tail AS node,
             (SELECT max_by(rhost || rpath, length(rhost || rpath)) FROM rules WHERE (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)) AS rule,
             (SELECT max_by(kind, length(rhost || rpath)) FROM rules WHERE (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)) AS own FROM q)
SELECT page_id, host, path, rule,
       coalesce(own, min(own) OVER (PARTITION BY CASE WHEN node IS NULL THEN 'id' || page_id ELSE node END), 'allow') AS verdict,
       node AS alias_id
FROM r
"""
