"""URL filter: rules indexed by their rarest literal token.

Every rule is a regular expression with the literal tokens (alphanumeric
runs) that any URL it fits must contain.  One pass over the URLs counts how
many of them hold each rule token; each rule is then filed under its rarest
token.  A URL's own tokens fetch the candidate rules, and only those run
their expressions.  Rules without a literal token run on every URL.

The rule list is a parameter (bounded by whoever writes it), and so is what
each task holds.  URLs are judged row by row: no shuffle, no skew.
"""
from __future__ import annotations

import re
import re._constants as rc
import re._parser as rp
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKEN = re.compile(r"[a-z0-9]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ALLOW, BLOCK = "allow", "block"


@dataclass(frozen=True)
class HostRule:
    """Fits ``host`` and its subdomains where the path starts with ``path``; the longest rule wins."""
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path

    @property
    def regex(self) -> str:
        return r"(?s)\A(?:[^/]*\.)?" + re.escape(self.host) + re.escape(self.path)

    def tokens(self) -> set[str]:
        # A path that ends inside a token does not promise that whole token.
        whole = re.sub(r"[A-Za-z0-9]+\Z", "", self.path)
        return set(TOKEN.findall((self.host + whole).translate(LOWER)))


@dataclass(frozen=True)
class PatternRule:
    """A pattern searched in the whole URL (A-Z lower-cased); decides only where no host rule fits."""
    verdict: str
    regex: str

    def tokens(self) -> set[str]:
        return literal_tokens(self.regex)


#: The registered query's rules.
HOST_RULES = (
    HostRule(ALLOW, "com", "/"),
    HostRule(BLOCK, "example.com", "/en/"),
    HostRule(ALLOW, "www.example.com", "/en/"),
    HostRule(BLOCK, "net", "/es/"),
    HostRule(BLOCK, "net", "/fr/"),
)
PATTERN_RULES = (
    PatternRule(BLOCK, r"[/.-]spam[.-]"),
    PatternRule(BLOCK, r"[/.-]pills[.-]"),
    PatternRule(BLOCK, r"[/.-]casino[s]?[.-]"),
    PatternRule(BLOCK, r"[/.-]viagra[.-]"),
    PatternRule(BLOCK, r"[/.-](?:porn|xxx)[.-]"),
)


def literal_tokens(pattern: str) -> set[str]:
    """Whole alphanumeric runs that every match of ``pattern`` holds.

    A run counts only if what stands on both sides is certain not to extend
    it: a non-alphanumeric literal or a class of such characters.
    """
    parts: list[str] = []
    for kind, value in rp.parse(pattern):
        if kind is rc.LITERAL:
            parts.append(chr(value))
        elif kind is rc.IN and value[0][0] is rc.LITERAL and all(
                k is rc.LITERAL and not TOKEN.match(chr(v)) for k, v in value):
            parts.append("/")
        else:
            parts.append("\0")  # unknown: may extend a neighbouring run
    return set(re.findall(r"(?<=[^a-z0-9\0])[a-z0-9]+(?=[^a-z0-9\0])", "".join(parts)))


def split_url(url: str | None) -> tuple[str, str]:
    """(host, path): host follows the first ``://`` up to ``/ ? #``, A-Z lower-cased; path up to ``? #``."""
    _, sep, rest = (url or "").partition("://")
    if not sep:
        return "", ""
    stop = re.match(r"[^?#]*", rest).group()
    host, slash, path = stop.partition("/")
    return host.translate(LOWER), slash + path


def token_frequencies(urls: DataFrame, url: str, tokens: Sequence[str]) -> dict[str, int]:
    """How many URLs hold each of ``tokens`` (all rows counted; the answer has one entry per rule token)."""
    if not tokens:
        return {}
    own = F.array_distinct(F.regexp_extract_all(F.lower(F.col(url)), F.lit("([a-z0-9]+)"), 1))
    hits = (urls.select(F.explode(F.array_intersect(own, F.array(*map(F.lit, tokens)))).alias("token"))
            .groupBy("token").count())
    return {r["token"]: r["count"] for r in hits.collect()}


def index_rules(rules, frequency: dict[str, int]) -> tuple[dict[str, list], list]:
    """Rules by their rarest token, and the rules that have none."""
    by_token: dict[str, list] = {}
    always: list = []
    for rule in rules:
        if tokens := rule.tokens():
            by_token.setdefault(min(tokens, key=lambda t: (frequency.get(t, 0), t)), []).append(rule)
        else:
            always.append(rule)
    return by_token, always


class Judge:
    """Judges URLs with one rule index."""

    def __init__(self, by_token: dict[str, list], always: list, default: str):
        self.by_token, self.always, self.default = by_token, always, default
        self.compiled = {r: re.compile(r.regex) for rs in [*by_token.values(), always] for r in rs}

    def __call__(self, url: str | None) -> tuple[str, str, str | None, str]:
        host, path = split_url(url)
        lowered = (url or "").translate(LOWER)
        found = [r for t in set(TOKEN.findall(lowered)) for r in self.by_token.get(t, ())] + self.always
        target = host + path
        fits = [r for r in found if self.compiled[r].search(target if isinstance(r, HostRule) else lowered)]
        if hosts := [r for r in fits if isinstance(r, HostRule)]:
            best = max(hosts, key=lambda r: (len(r.name), r.verdict == BLOCK, r.name))
            return host, path, best.name, best.verdict
        verdicts = {r.verdict for r in fits}
        return host, path, None, BLOCK if BLOCK in verdicts else ALLOW if ALLOW in verdicts else self.default


def filter_urls(urls: DataFrame, key: str = "page_id", url: str = "url",
                host_rules: Sequence[HostRule] = HOST_RULES,
                pattern_rules: Sequence[PatternRule] = PATTERN_RULES, default: str = ALLOW) -> DataFrame:
    """Judge every row of ``urls``: ``key``, host, path, rule, verdict.

    ``rule`` names the longest fitting host rule (ties: block first), else
    null; then pattern rules decide (block before allow), else ``default``.
    Null urls, or ones without ``://``, have empty host and path and fit no
    host rule.  Repeated rows and null keys give one output row each; other
    input columns are ignored; an empty table gives no rows.
    """
    rules = [*host_rules, *pattern_rules]
    frequency = token_frequencies(urls, url, sorted(set().union(*(r.tokens() for r in rules))) if rules else [])
    by_token, always = index_rules(rules, frequency)
    slim = urls.select(F.col(key).alias("page_id"), F.col(url).alias("url"))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = Judge(by_token, always, default)
        for b in batches:
            columns = zip(*map(one, b.column("url").to_pylist())) if b.num_rows else [()] * 4
            yield pa.RecordBatch.from_arrays([b.column("page_id"), *(pa.array(c, pa.string()) for c in columns)],
                                             names=["page_id", "host", "path", "rule", "verdict"])

    schema = f"page_id {dict(slim.dtypes)['page_id']}, host string, path string, rule string, verdict string"
    return slim.mapInArrow(judge, schema).withColumnRenamed("page_id", key)
