"""URL filters: pattern rules kept under their rarest literal token.

A url's tokens (runs of letters a-z and digits of host and path, lower-cased) fetch the candidate rules; only those run
their regular expressions. How rare a token is, is counted over all urls. Host rules (``net/de/``: host, then the
start of the path, all subdomains included) come first and the longest wins; else an allow pattern, else a block
pattern decides; else the url is allowed.

Pattern syntax: ``*`` stands for any characters, ``^`` for the border of a run of a-z and 0-9, the rest for
itself; patterns see host and path in lower case.

Defined results: a null url or one without ``://`` has empty host and path, no rule, and is allowed; ids may be null
or repeat (a row for each row); an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The rules go to every worker: so many at most.
MOST_RULES = 100_000
#: The host rules and patterns of the registered query.
HOST_RULES = (("block", "com/en/"), ("allow", "example.com/en/7"), ("allow", "net/de/"), ("block", "example.net/de/8"), ("block", "org/es/"))
PATTERNS = (
    ("block", "^casino^"), ("block", "^poker^"), ("block", "^viagra^"), ("block", "^free-pills^"), ("block", "^porn^"),
    ("block", "^xxx^"), ("block", "^adserver*/click"), ("block", "/phpmyadmin/"), ("block", "/wp-login.php^"),
    ("allow", "^casino-museum^"), ("allow", "^poker-history^"),
)
_TOKEN = re.compile(r"[a-z0-9]+")
_UPPER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


@dataclass(frozen=True)
class Rule:
    name: str
    action: str
    is_host: bool
    regex: str
    literals: tuple[str, ...]


def host_rule(action: str, name: str) -> Rule:
    host, slash, path = name.partition("/")
    host = host.translate(_UPPER)
    whole = _TOKEN.findall(host) + [t.lower() for t in re.findall(r"(?<![A-Za-z0-9])[A-Za-z0-9]+(?![A-Za-z0-9])(?!$)", slash + path)]
    return Rule(name, action, True, rf"(?:[^/]*\.)?{re.escape(host)}{re.escape(slash + path) if slash else '(?=/|$)'}", tuple(dict.fromkeys(whole)))


def pattern_rule(action: str, pattern: str) -> Rule:
    regex = "".join({"*": ".*", "^": "(?:(?<![a-z0-9])|(?![a-z0-9]))"}.get(c, re.escape(c)) for c in pattern)
    whole = re.findall(r"(?<=[^a-z0-9*])[a-z0-9]+(?=[^a-z0-9*])", pattern)
    return Rule(pattern, action, False, regex, tuple(dict.fromkeys(whole)))


def read_rules(rules: DataFrame) -> tuple[list[tuple[str, str]], list[tuple[str, str]]]:
    """Host rules and patterns of a table (kind: host or pattern, action: block or allow, rule); ``MOST_RULES`` at most.

    Rows with a null, and rows of other kinds or actions, are an error, so that no rule is lost without a word.
    """
    rows = rules.select("kind", "action", "rule").distinct().limit(MOST_RULES + 1).collect()
    if len(rows) > MOST_RULES:
        raise ValueError(f"over {MOST_RULES} rules")
    for r in rows:
        if r.kind not in ("host", "pattern") or r.action not in ("block", "allow") or not r.rule:
            raise ValueError(f"no rule: {r}")
    return tuple(sorted((r.action, r.rule) for r in rows if r.kind == kind) for kind in ("host", "pattern"))


def split_url(url: str | None) -> tuple[str, str]:
    rest = url.partition("://")[2] if url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    return host.translate(_UPPER), re.match(r"[^?#]*", rest[len(host) :])[0]


def rule_index(rules: Sequence[Rule], seen: Mapping[str, int]) -> dict[str, list[Rule]]:
    """Rules under their rarest literal token; those without one under the empty token, which every url has."""
    found: dict[str, list[Rule]] = {}
    for rule in rules:
        token = min(rule.literals, key=lambda t: (seen.get(t, 0), -len(t), t), default="")
        found.setdefault(token, []).append(rule)
    return found


def judge(host: str, path: str, index: Mapping[str, Sequence[Rule]], compiled: Callable[[Rule], re.Pattern]) -> tuple[str | None, str]:
    lower = (host + path).translate(_UPPER)
    candidates = [rule for token in {"", *_TOKEN.findall(lower)} for rule in index.get(token, ())]
    best, actions = None, set()
    for rule in candidates:
        regex = compiled(rule)
        if rule.is_host:
            if regex.match(host + path) and (best is None or (-len(rule.name), rule.name) < (-len(best.name), best.name)):
                best = rule
        elif regex.search(lower):
            actions.add(rule.action)
    if best:
        return best.name, best.action
    return None, "block" if actions == {"block"} else "allow"


def filter_urls(pages: DataFrame, host_rules: Sequence = HOST_RULES, patterns: Sequence = PATTERNS, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """id, host, path, rule (the host rule that decides, or null) and verdict of every url."""
    rules = [host_rule(*r) for r in host_rules] + [pattern_rule(*p) for p in patterns]
    if len(rules) > MOST_RULES:
        raise ValueError(f"{len(rules)} rules; {MOST_RULES} at most")
    known = sorted({t for r in rules for t in r.literals})
    tokens = pages.select(F.explode(F.split(F.lower(F.col(url_col)), "[^a-z0-9]+")).alias("token"))
    listed = pages.sparkSession.createDataFrame([(t,) for t in known], "token string")
    seen = dict(Counter({r.token: r["count"] for r in tokens.join(F.broadcast(listed), "token").groupBy("token").count().collect()}))
    index = rule_index(rules, seen)
    source = pages.select(F.col(id_col), F.col(url_col).alias("__url"))

    sent = pages.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = cache(lambda rule: re.compile(rule.regex, re.DOTALL))  # rules that no url meets are never compiled
        for batch in batches:
            parts = [split_url(u) for u in batch.column(1).to_pylist()]
            judged = [judge(h, p, sent.value, compiled) for h, p in parts]
            columns = [[h for h, _ in parts], [p for _, p in parts], [r for r, _ in judged], [v for _, v in judged]]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.string()) for c in columns)], [id_col, "host", "path", "rule", "verdict"])

    return source.mapInArrow(run, f"`{id_col}` {source.schema[0].dataType.simpleString()}, host string, path string, rule string, verdict string")
