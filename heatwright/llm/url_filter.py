"""URL filters: pattern rules indexed by their rarest literal token.

A URL is cut into tokens (runs of ASCII letters and digits, A-Z lowered). Every rule names tokens that any
URL it fits must hold whole; the rule is filed under the one that is rarest in the URLs at hand, counted by
Spark over all of them. A URL fetches the rules filed under its own tokens, and only those run their regular
expressions. Rules without a token are tried on every URL.

Site rules (host and path) take precedence over pattern rules, and the longest one wins. Pattern rules decide
the rest: a fitting allow rule first, then a fitting block rule, else allow.

Defined results: a null URL or one without ``://`` has empty host and path, fits no site rule and is allowed
unless a pattern fits its text. Rows are judged alone; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heatwright.llm.texts import arrow_rows, on_batches, only

_TOKENS = re.compile(r"[a-z0-9]+")
_LOWER = {code: code + 32 for code in range(65, 91)}


@dataclass(frozen=True)
class SiteRule:
    """Fits ``host`` and its subdomains where the path starts with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path

    @property
    def tokens(self) -> set[str]:
        # The last run of the path may go on in the URL, so it counts only if a separator ends it.
        return set(_TOKENS.findall(re.sub(r"[A-Za-z0-9]+$", "", self.name).translate(_LOWER)))

    @property
    def pattern(self) -> str:
        return rf"(?:[^/]*\.)?{re.escape(self.host.translate(_LOWER))}{re.escape(self.path)}"


@dataclass(frozen=True)
class PatternRule:
    """Fits where ``pattern`` is found in the URL. ``tokens``: whole tokens that every such URL holds."""

    verdict: str
    name: str
    pattern: str
    tokens: frozenset[str]


# The site rules in use.
SITE_RULES = (
    SiteRule("block", "net", "/"),
    SiteRule("allow", "example.net", "/en/"),
    SiteRule("block", "example.com", "/de/"),
    SiteRule("allow", "org", "/fr/"),
)
PATTERN_RULES = (
    PatternRule("block", "feed copies", r"[?&]utm_source=feed(?:[&#]|$)", frozenset({"utm", "source", "feed"})),
    PatternRule("block", "listing pages", r"[?&]page=[0-9]+&ref=", frozenset({"page", "ref"})),
    PatternRule("block", "log-in pages", r"/login(?:[/?#]|$)", frozenset({"login"})),
    PatternRule("block", "shop carts", r"/cart(?:[/?#]|$)", frozenset({"cart"})),
    PatternRule("block", "print versions", r"[?&]print=1(?:[&#]|$)", frozenset({"print", "1"})),
)

JUDGED = pa.schema(
    [
        ("page_id", pa.int64()),
        *[(name, pa.string()) for name in ("host", "path", "rule", "verdict", "pattern_rule")],
    ]
)
JUDGED_DDL = "page_id bigint, host string, path string, rule string, verdict string, pattern_rule string"


def host_and_path(url: str | None) -> tuple[str, str]:
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    path = re.split(r"[?#]", rest[len(host) :], maxsplit=1)[0]
    return host.translate(_LOWER), path


class RuleIndex:
    def __init__(self, sites, patterns, counts: dict[str, int]):
        self.by_token: dict[str, list[tuple]] = {}
        self.always: list[tuple] = []
        for rule in (*sites, *patterns):
            entry = (rule, re.compile(rule.pattern), isinstance(rule, SiteRule))
            if rule.tokens:
                rarest = min(sorted(rule.tokens), key=lambda t: counts.get(t, 0))
                self.by_token.setdefault(rarest, []).append(entry)
            else:
                self.always.append(entry)

    def judge(self, url: str | None) -> tuple[str, str, str | None, str, str | None]:
        host, path = host_and_path(url)
        url = url or ""
        site, fitting = None, {}
        for entries in (
            self.always,
            *(self.by_token.get(t, ()) for t in sorted(set(_TOKENS.findall(url.translate(_LOWER))))),
        ):
            for rule, pattern, is_site in entries:
                if is_site:
                    if pattern.match(host + path) and (site is None or len(rule.name) > len(site.name)):
                        site = rule
                elif pattern.search(url):
                    fitting.setdefault(rule.verdict, []).append(rule.name)
        if site:
            return host, path, site.name, site.verdict, None
        verdict = "block" if "block" in fitting and "allow" not in fitting else "allow"
        return host, path, None, verdict, min(fitting.get(verdict, [None]), key=str)


def _judging(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            found = [index.judge(url) for url in batch.column("url").to_pylist()]
            if found:
                yield arrow_rows(JUDGED, [batch.column("page_id"), *zip(*found, strict=True)])

    return run


def judge_urls(pages: DataFrame, sites=SITE_RULES, patterns=PATTERN_RULES) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule``, ``verdict`` and the deciding ``pattern_rule`` of each row."""
    pages = only(pages, "page_id", "url")
    wanted = sorted({t for rule in (*sites, *patterns) for t in rule.tokens})
    # At most one count for each token of the rules comes back.
    counts = {
        r["token"]: r["n"]
        for r in pages.select(
            F.explode(F.array_distinct(F.split(F.lower("url"), "[^a-z0-9]+"))).alias("token")
        )
        .filter(F.col("token").isin(wanted))
        .groupBy("token")
        .agg(F.count("*").alias("n"))
        .collect()
    }
    shared = pages.sparkSession.sparkContext.broadcast(RuleIndex(sites, patterns, counts))
    return on_batches(pages, _judging(shared), JUDGED_DDL)
