"""URL filters: pattern rules indexed by their rarest literal token.

Every rule names sets of literal tokens, one set for each of its alternatives: in any url it matches, all tokens of one
of the sets stand whole. Token frequencies over all urls decide under which token of each set a rule is filed, the
rarest. A url's tokens fetch the rules filed under them, and only those run their regular expression, with the rules of
which no token is certain to stand whole, which run on every url. Rules, and so the index and the counts that come to
the driver, are bounded by max_rules.
"""

from __future__ import annotations

import itertools
import re
from collections import Counter
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow

# The base rules (verdict, host, path).
BASE_RULES = (
    ("block", "com", "/en/"),
    ("allow", "example.com", "/en/7"),
    ("allow", "net", "/de/"),
    ("block", "example.net", "/de/8"),
    ("block", "org", "/es/"),
)
# Patterns of the method's own, each with the literal tokens that each of its alternatives needs; none if there are no such tokens.
PATTERNS = (
    ("block", r"(?:^|[./-])cheap-pills[./]", (("cheap", "pills"),)),
    ("block", r"(?:^|[./-])spam-farm[./]", (("spam", "farm"),)),
    ("block", r"^(?:[^/]*\.)?casino[^/]*/", ()),
    ("block", r"/(?:ads|adserver|doubleclick)/", (("ads",), ("adserver",), ("doubleclick",))),
    ("block", r"[./-]porn[./-]", (("porn",),)),
)
_TOKEN = re.compile(r"[^a-z0-9]+")
_HOST_END, _PATH_END = re.compile(r"[/?#]"), re.compile(r"[?#]")
_UPPER = bytes(range(256)).translate(bytes(c + 32 if 65 <= c <= 90 else c for c in range(256)))


def host_and_path(url: str | None) -> tuple[str, str]:
    """Host in lower case (A-Z) and path; both empty for a null url and one without ://."""
    _, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    end = _HOST_END.search(rest)
    host, rest = (rest[: end.start()], rest[end.start() :]) if end else (rest, "")
    end = _PATH_END.search(rest)
    return host.encode("utf-8", "surrogatepass").translate(_UPPER).decode("utf-8", "surrogatepass"), rest[: end.start()] if end else rest


@dataclass(frozen=True)
class Rule:
    verdict: str
    pattern: re.Pattern  # on host + path
    tokens: tuple[tuple[str, ...], ...]  # a set for each alternative; with none, the rule runs on every url
    name: str | None  # of a base rule: its host and path


def rules(base=BASE_RULES, patterns=PATTERNS, max_rules: int = 100_000) -> list[Rule]:
    """A base rule fits its host and all subdomains if the path starts with the rule's path; it needs a literal token."""
    out = [Rule(v, re.compile(rf"\A(?:[^/?#]*\.)?{re.escape(host)}{re.escape(path)}", re.S), (_whole_tokens(host, path),), host + path) for v, host, path in base]
    out += [Rule(v, re.compile(p), tuple(map(tuple, sets)), None) for v, p, sets in patterns]
    if len(out) > max_rules or any(not tokens for r in out for tokens in r.tokens):
        raise ValueError(f"at most {max_rules} rules, each with a literal token in every set")
    return out


def _whole_tokens(host: str, path: str) -> tuple[str, ...]:
    """The last token of a path counts only if something ends it: /en/7 also fits /en/75."""
    tokens = [t for t in _TOKEN.split((host + path).lower()) if t]
    return tuple(dict.fromkeys(tokens if not path or _TOKEN.match(path[-1].lower()) else tokens[:-1]))


def tokens_of(host: str, path: str) -> set[str]:
    return set(_TOKEN.split(f"{host}{path}".lower()))


def token_counts(pages: DataFrame, wanted: set[str], url_col: str = "url") -> dict[str, int]:
    """In how many urls of the whole table each wanted token stands; as many rows as wanted tokens at most."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found: Counter = Counter()
        for url in batch.column(0).to_pylist():
            found.update(wanted & tokens_of(*host_and_path(url)))
        return pa.RecordBatch.from_pydict({"token": pa.array(list(found), pa.string()), "n": pa.array(list(found.values()), pa.int64())})

    counted = map_arrow(pages.select(F.col(f"`{url_col}`").cast("string").alias("url")), run, "token string, n long")
    return {r.token: r.n for r in counted.groupBy("token").agg(F.sum("n").alias("n")).collect()}


class Index:
    def __init__(self, items: list[Rule], counts: dict[str, int]):
        self.filed: dict[str, list[Rule]] = {}
        self.always = [rule for rule in items if not rule.tokens]
        for rule in items:
            for token in {min(tokens, key=lambda t: (counts.get(t, 0), t)) for tokens in rule.tokens}:
                self.filed.setdefault(token, []).append(rule)

    def judge(self, host: str, path: str) -> tuple[str | None, str]:
        """The longest base rule that fits, null if none, and its verdict; else the verdict of a pattern; else allow."""
        fits = [r for r in itertools.chain(self.always, *(self.filed.get(t, ()) for t in tokens_of(host, path))) if r.pattern.search(host + path)]
        named = max((r for r in fits if r.name), key=lambda r: (len(r.name), r.name), default=None)
        if named:
            return named.name, named.verdict
        return None, "block" if any(r.verdict == "block" for r in fits) else "allow"


def judge_urls(pages: DataFrame, items: list[Rule] | None = None, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row a page: page_id, host, path, rule, verdict.

    A null url, or one without ://, has an empty host and path, no rule, and is allowed. Repeated rows each give a
    row. Other columns are not read.
    """
    items = rules() if items is None else items
    index = Index(items, token_counts(pages, {t for r in items for tokens in r.tokens for t in tokens}, url_col))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [(h, p, *index.judge(h, p)) for h, p in map(host_and_path, batch.column(1).to_pylist())]
        cols = [pa.array(list(c), pa.string()) for c in zip(*rows, strict=True)]
        return pa.RecordBatch.from_arrays([batch.column(0), *cols], ["page_id", "host", "path", "rule", "verdict"])

    return map_arrow(pages.select(F.col(f"`{id_col}`").cast("long").alias("page_id"), F.col(f"`{url_col}`").cast("string").alias("url")), run, "page_id long, host string, path string, rule string, verdict string")
