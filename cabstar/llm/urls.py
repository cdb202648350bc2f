"""URL filter: pattern rules indexed by their rarest literal token.

A pattern is ``||host/path`` (that host or a subdomain of it, and a path that begins so) or
a substring of the url after its ``://``; there ``*`` stands for any characters, ``^`` for a
separator or the end, and a ``|`` at either end ties the pattern to that end. A token is a
whole run of letters and digits. Each rule lies in the index under that one of its literal
tokens which is rarest among all urls; a url's tokens fetch candidate rules and only those
run their regular expression.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabstar.llm.common import map_rows, operator

_TOKEN = re.compile("[0-9a-z]+")
_PARTS = re.compile(r"^.*?://([^/?#]*)([^?#]*)(.*)$", re.S)
_UPPER = {c: c + 32 for c in range(65, 91)}


@dataclass(frozen=True)
class Rule:
    """``name`` is given for rules that outrank plain patterns (longest name wins)."""

    pattern: str
    action: str
    name: str | None = None

    @property
    def regex(self) -> str:
        body, head, tail = self.pattern, "", ""
        if body.startswith("||"):
            body, head = body[2:], r"^(?:[^/?#]*\.)?"
        elif body.startswith("|"):
            body, head = body[1:], "^"
        if body.endswith("|"):
            body, tail = body[:-1], r"\Z"
        signs = {"*": ".*", "^": r"(?:[^0-9A-Za-z_.%-]|\Z)"}
        return head + "".join(signs.get(c) or re.escape(c) for c in body) + tail

    @property
    def tokens(self) -> set[str]:
        """Runs of letters and digits that every matching url holds as whole tokens."""
        whole, body = set(), self.pattern.lower()
        for m in _TOKEN.finditer(body):
            before, after = body[: m.start()], body[m.end() :]
            if before and before[-1] != "*" and after and after[0] != "*":
                whole.add(m[0])
        return whole


def host_rule(name: str, action: str) -> Rule:
    """A rule written ``host/path``."""
    return Rule("||" + name, action, name)


#: The contract's rules.
HOST_RULES = (
    host_rule("com/", "allow"),
    host_rule("example.com/en/", "block"),
    host_rule("www.example.com/en/", "allow"),
    host_rule("net/es/", "block"),
    host_rule("net/fr/", "block"),
)
#: Pages that carry no prose, by path or query.
PATTERN_RULES = tuple(
    Rule(p, "block")
    for p in (
        "/login^", "/signin^", "/wp-login.php", "/wp-admin/", "/cgi-bin/", "/checkout^", "/cart^", "^phpsessid=",
        "^sessionid=", "^add-to-cart=", "/ads/*", "/casino^", "/xxx/", "/torrent^", ".exe|", ".zip|", ".jpg|",
    )
)


def split_url(url: str | None) -> tuple[str, str, str]:
    """Host (A-Z lower-cased), path and the rest; all empty without a ``://``."""
    m = _PARTS.match(url) if url else None
    return (m[1].translate(_UPPER), m[2], m[3]) if m else ("", "", "")


def token_counts(urls: DataFrame, rules: Sequence[Rule], url_col: str = "url") -> dict[str, int]:
    """How often each literal token of the rules occurs among all urls (a row per token)."""
    known = sorted(set().union(*(r.tokens for r in rules))) if rules else []
    if not known:
        return {}
    found = F.explode(F.split(F.lower(F.col(url_col)), "[^0-9a-z]+"))
    counts = urls.select(found.alias("token")).where(F.col("token").isin(known)).groupBy("token").count()
    return dict.fromkeys(known, 0) | {r["token"]: r["count"] for r in counts.collect()}


class Index:
    """Rules by rarest token; those without a whole literal token are always candidates."""

    def __init__(self, rules: Sequence[Rule], counts: dict[str, int]):
        self.rules = [(re.compile(r.regex, re.S), r) for r in rules]
        self.by_token: dict[str, list[int]] = {}
        self.always: list[int] = []
        for i, r in enumerate(rules):
            if token := min(r.tokens, key=lambda t: (counts[t], t), default=None):
                self.by_token.setdefault(token, []).append(i)
            else:
                self.always.append(i)

    def fits(self, subject: str) -> list[Rule]:
        candidates = list(self.always)
        for token in set(_TOKEN.findall(subject.lower())):
            candidates += self.by_token.get(token, ())
        return [self.rules[i][1] for i in candidates if self.rules[i][0].search(subject)]


@operator
def judge_urls(
    urls: DataFrame,
    rules: Sequence[Rule] = HOST_RULES + PATTERN_RULES,
    keep: Sequence[str] = ("page_id",),
    url_col: str = "url",
    default: str = "allow",
) -> DataFrame:
    """Judge every url: ``keep``, host, path, rule, verdict and pattern; a row for each row.

    The longest fitting named rule decides (ties: block first, then by name); without one a
    fitting pattern does (block before allow, then by pattern) and is shown in ``pattern``;
    else the verdict is ``default``. Null urls and urls without ``://`` have empty host and
    path and fit no rule. An empty rule set gives the default everywhere.
    """
    counts = token_counts(urls, rules, url_col)

    def rows():
        index = Index(rules, counts)

        def row(url):
            host, path, rest = split_url(url)
            fits = index.fits(host + path + rest) if host or path or rest else []
            rank = lambda r: (-len(r.name or ""), r.action != "block", r.name or r.pattern)
            best = min(fits, key=rank, default=None)
            if best is None:
                return host, path, None, default, None
            return host, path, best.name, best.action, best.pattern

        return row

    schema = "host string, path string, rule string, verdict string, pattern string"
    return map_rows(urls, rows, schema, (url_col,), keep)
