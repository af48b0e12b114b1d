"""URL filters: allow and block rules on hosts and paths, then pattern rules found through their rarest token.

A pattern rule is a regular expression with the literal tokens every match must hold.  Token frequencies are counted
over all URLs, each pattern is filed under its rarest token, and a URL's own tokens fetch the candidates: only those
run.  Patterns decide where no host rule does; the one of highest priority (the first listed) wins.

Null URLs, and URLs without ``://``, have an empty host and path and no tokens: no rule fits, the verdict is the
default.  Repeated rows are judged alike.  Other columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quartermaster.llm.common import map_batches, schema_of

TOKEN = re.compile(r"[a-z0-9]+")
URL_PARTS = re.compile(r"://([^/?#]*)([^?#]*)")
LOWER = str.maketrans({c: chr(c + 32) for c in range(65, 91)})


@dataclass(frozen=True)
class HostRule:
    """``text`` is host/path; fits the host and its subdomains where the URL's path starts with the rule's."""

    verdict: str
    text: str

    @property
    def parts(self) -> tuple[str, str]:
        host, slash, path = self.text.partition("/")
        return host, slash + path


@dataclass(frozen=True)
class PatternRule:
    """``literals``: tokens (runs of a-z and 0-9) of which every matching URL holds each, whole, after lower-casing."""

    verdict: str
    pattern: str
    literals: tuple[str, ...]


#: Default pattern rules: session links, log-in and shop pages, binaries, adult and gambling pages.
PATTERNS = (
    PatternRule("allow", r"/sitemap\.xml($|[?#])", ("sitemap", "xml")),
    PatternRule("block", r"[?&]phpsessid=[0-9a-f]+", ("phpsessid",)),
    PatternRule("block", r"/cart(/|\?|$)", ("cart",)),
    PatternRule("block", r"/checkout(/|\?|$)", ("checkout",)),
    PatternRule("block", r"/wp-login\b", ("wp", "login")),
    PatternRule("block", r"/wp-admin\b", ("wp", "admin")),
    PatternRule("block", r"/login\b[^#]*[?&](return|next)=", ("login",)),
    PatternRule("block", r"\.exe($|[?#])", ("exe",)),
    PatternRule("block", r"\.zip($|[?#])", ("zip",)),
    PatternRule("block", r"\bonline-casino\b", ("online", "casino")),
    PatternRule("block", r"\bfree-porn\b", ("free", "porn")),
)


def split_url(url: str | None) -> tuple[str, str]:
    m = URL_PARTS.search(url or "")
    return (m[1].translate(LOWER), m[2]) if m else ("", "")


def url_tokens(url: str | None) -> list[str]:
    return TOKEN.findall((url or "").translate(LOWER)) if "://" in (url or "") else []


class HostIndex:
    """Rules by host; a URL looks its host and every parent domain up."""

    def __init__(self, rules: tuple[HostRule, ...]):
        self.by_host: dict[str, list[HostRule]] = {}
        for r in rules:
            self.by_host.setdefault(r.parts[0], []).append(r)

    def find(self, host: str, path: str) -> HostRule | None:
        fits, labels = [], host.split(".") if host else []
        for i in range(len(labels)):
            fits += [r for r in self.by_host.get(".".join(labels[i:]), ()) if path.startswith(r.parts[1])]
        return max(fits, key=lambda r: (len(r.text), len(r.parts[0])), default=None)


class PatternIndex:
    """Patterns filed under their rarest literal."""

    def __init__(self, rules: tuple[PatternRule, ...], frequency: dict[str, int]):
        self.rules = [(re.compile(r.pattern), r) for r in rules]
        self.by_token: dict[str, list[int]] = {}
        for i, r in enumerate(rules):
            if not r.literals:
                raise ValueError(f"a pattern rule needs a literal token: {r.pattern}")
            self.by_token.setdefault(min(r.literals, key=lambda t: (frequency.get(t, 0), t)), []).append(i)

    def find(self, url: str) -> PatternRule | None:
        candidates: set[int] = set()
        for t in url_tokens(url):
            candidates.update(self.by_token.get(t, ()))
        low = url.translate(LOWER)
        return next((self.rules[i][1] for i in sorted(candidates) if self.rules[i][0].search(low)), None)


def literal_frequency(urls: DataFrame, rules: tuple[PatternRule, ...], url: str = "url") -> dict[str, int]:
    """How many URLs hold each literal of the rules, over all rows; the result has a row for each literal at most."""
    wanted = sorted({t for r in rules for t in r.literals})
    if not wanted:
        return {}
    tokens = F.array_distinct(F.split(F.translate(F.col(url), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), "[^a-z0-9]+"))
    literals = F.array(*(F.lit(t) for t in wanted))
    held = urls.select(F.explode(F.array_intersect(tokens, literals)).alias("t"))
    return {r["t"]: r["count"] for r in held.groupBy("t").count().collect()}


def judge(df: DataFrame, rules: tuple[HostRule, ...], patterns: tuple[PatternRule, ...] = PATTERNS,
          default: str = "allow", key: str = "page_id", url: str = "url") -> DataFrame:
    """(key, host, path, rule, verdict, pattern): ``rule`` is the longest fitting host rule, ``pattern`` the pattern that
    decided where none fits."""
    frequency = literal_frequency(df, patterns, url)

    def run(batch):
        hosts, found = HostIndex(rules), PatternIndex(patterns, frequency)
        out = {n: [] for n in ("host", "path", "rule", "verdict", "pattern")}
        for u in batch.column(url).to_pylist():
            host, path = split_url(u)
            rule = hosts.find(host, path)
            pattern = found.find(u) if rule is None and u and "://" in u else None
            for n, v in (("host", host), ("path", path), ("rule", rule and rule.text), ("pattern", pattern and pattern.pattern),
                         ("verdict", rule.verdict if rule else pattern.verdict if pattern else default)):
                out[n].append(v)
        return {key: batch.column(key), **out}

    out = schema_of((key, T.LongType()), *((n, T.StringType()) for n in ("host", "path", "rule", "verdict", "pattern")))
    return map_batches(df.select(F.col(key).cast("long").alias(key), url), run, out)
