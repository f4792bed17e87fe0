"""URL filters: rules found through their rarest literal token.

Two kinds of rule, both turned into one regular expression on host + path:

* a domain rule ``host/path`` with a verdict fits its host and all
  subdomains, if the url's path starts with the rule's; the longest wins;
* a pattern rule (``*``: any run, ``^``: one character that is no letter or
  digit, or an end) gives the verdict where no domain rule fits; the longest
  wins, and without any the url is allowed.

A rule is filed under that one of its whole literal tokens (letters and
digits between delimiters) that is rarest in the urls at hand, by a count over
all of them. A url's tokens fetch the candidate rules, and only their regular
expressions run. A rule without a whole token is tried on every url.

Scale: two narrow passes over the url column alone; the count returns at most
one row for each token of the rules, whatever the number of urls.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from percepta.llm.common import ROW, TEXT, add_columns, decoded, field, texts_of, with_row

ALLOW, BLOCK = "allow", "block"

#: Fixed domain rules: verdict and host/path.
DOMAIN_RULES = (
    (BLOCK, "net/"),
    (ALLOW, "example.net/en/"),
    (BLOCK, "example.com/de/"),
    (ALLOW, "org/fr/"),
)

#: Words that name unwanted sites when they stand alone in a host or path ...
WORDS = "adult ads bets casino pills poker porn spam viagra xxx".split()
#: ... but not next to one of these, ...
HELP = "addiction awareness filter help prevention support".split()
#: and pairs of words that do so only together, the second anywhere behind the first.
LURES = "cheap earn fast free hot online win".split()
GOODS = "cash gift loans meds money prize singles".split()
PATTERN_RULES = (
    *((BLOCK, f"^{word}^") for word in WORDS),
    *((ALLOW, f"^{word}^{near}^") for word in WORDS for near in HELP),
    *((BLOCK, f"^{lure}^{between}{good}^") for lure in LURES for good in GOODS for between in ("", "*^")),
)

_TOKEN = re.compile(r"[a-z0-9]+")


@dataclass(frozen=True)
class Rule:
    text: str
    verdict: str
    regex: str
    tokens: tuple[str, ...]


def domain_rule(verdict: str, text: str) -> Rule:
    host, slash, path = text.partition("/")
    path = slash + path
    # The host's tokens are whole, and so are the path's but for one that the path ends in.
    tokens = _TOKEN.findall(host) + [
        m[0] for m in _TOKEN.finditer(path.lower()) if m.end() < len(path)
    ]
    if not path and tokens:
        tokens = tokens[:-1] if host[-1:].isalnum() else tokens
    after = re.escape(path) or r"(?:/|\Z)"
    regex = rf"(?s)(?:[^/]*\.)?{re.escape(host)}{after}"
    return Rule(text, verdict, regex, tuple(tokens))


def pattern_rule(verdict: str, text: str) -> Rule:
    parts = {"*": ".*", "^": r"(?:[^A-Za-z0-9]|^|\Z)"}
    regex = "(?s).*?" + "".join(parts.get(c) or re.escape(c) for c in text)
    low = text.lower()
    tokens = [
        m[0]
        for m in _TOKEN.finditer(low)
        if m.start() and low[m.start() - 1] != "*" and m.end() < len(low) and low[m.end()] != "*"
    ]
    return Rule(text, verdict, regex, tuple(tokens))


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path; both empty without ``://``."""
    _, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    m = re.match(r"([^/?#]*)([^?#]*)", rest)
    return m[1].translate(_LOWER), m[2]


_LOWER = {c: c + 32 for c in range(65, 91)}


def tokens_of(url: str) -> set[str]:
    return set(_TOKEN.findall(url.translate(_LOWER)))


class RuleIndex:
    """Rules by their rarest token; ``counts``: how many urls hold a token."""

    def __init__(self, rules: list[Rule], counts: dict[str, int]):
        self.by_token: dict[str, list[tuple]] = {}
        self.always: list[tuple] = []
        for k, rule in enumerate(rules):
            entry = (len(rule.text), -k, rule, re.compile(rule.regex))
            if rule.tokens:
                rarest = min(rule.tokens, key=lambda t: (counts.get(t, 0), -len(t), t))
                self.by_token.setdefault(rarest, []).append(entry)
            else:
                self.always.append(entry)

    def candidates(self, place: str) -> list[tuple]:
        """The rules whose regular expressions run on ``place``."""
        found = list(self.always)
        for token in tokens_of(place):
            found += self.by_token.get(token, ())
        return found

    def best(self, place: str) -> Rule | None:
        """The longest rule that fits ``place`` (host + path); the first among equals."""
        found = [e for e in self.candidates(place) if e[3].match(place)]
        return max(found, key=lambda e: e[:2])[2] if found else None


def token_counts(urls: DataFrame, tokens: set[str]) -> dict[str, int]:
    """How many urls hold each of ``tokens``, over all rows of (``__text``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for url in texts_of(batch):
                total.update(tokens & tokens_of("".join(split_url(decoded(url)))))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())],
            names=["token", "n"],
        )

    counts = urls.select(TEXT).mapInArrow(run, "token string, n long")
    return {r.token: r.n for r in counts.groupBy("token").agg(F.sum("n").alias("n")).collect()}


def judge_urls(
    pages: DataFrame,
    url_col: str = "url",
    domain_rules: tuple[tuple[str, str], ...] = DOMAIN_RULES,
    pattern_rules: tuple[tuple[str, str], ...] = PATTERN_RULES,
) -> DataFrame:
    """``__row``, host, path, rule, verdict and pattern of every url.

    ``rule`` is the domain rule that decided, else null; ``pattern`` the
    pattern rule that decided, else null. A null url, or one without ``://``,
    has an empty host and path and is allowed. Repeated urls are judged each,
    very long ones whole; malformed UTF-8 is read as U+FFFD. An empty table gives
    no rows; other columns stay inside ``__row``, whatever their names.
    """
    domains = [domain_rule(*r) for r in domain_rules]
    patterns = [pattern_rule(*r) for r in pattern_rules]
    rows = with_row(pages, url_col)
    counts = token_counts(rows, {t for r in domains + patterns for t in r.tokens})
    indexes: list[RuleIndex] = []

    def setup() -> None:
        indexes[:] = [RuleIndex(domains, counts), RuleIndex(patterns, counts)]

    def compute(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        names = ("host", "path", "rule", "verdict", "pattern")
        out: dict[str, list] = {k: [] for k in names}
        for url in texts_of(batch):
            host, path = split_url(decoded(url))
            domain = indexes[0].best(host + path)
            pattern = indexes[1].best(host + path) if domain is None else None
            decided = domain or pattern
            row = (host, path, domain and domain.text, decided.verdict if decided else ALLOW, pattern and pattern.text)
            for k, v in zip(names, row, strict=True):
                out[k].append(v)
        return {k: pa.array(v, pa.string()) for k, v in out.items()}

    fields = [field(k, T.StringType()) for k in ("host", "path", "rule", "verdict", "pattern")]
    return add_columns(rows, compute, fields, setup=setup)


def url_report(pages: DataFrame) -> DataFrame:
    """page_id, host, path, rule, verdict and pattern of every page."""
    return judge_urls(pages.select("page_id", "url")).select(
        F.col(f"{ROW}.page_id").alias("page_id"), "host", "path", "rule", "verdict", "pattern"
    )
