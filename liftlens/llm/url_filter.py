"""URL filter: host and path rules first, then a weighted vocabulary.

Rules name a host and a path.  A rule fits its host and all subdomains where the url's path
starts with the rule's; the longest fitting rule decides (of equally long ones that with the
longer host, then a blocking one).  Where no rule fits, one Aho-Corasick pass over the whole
url counts the terms of a vocabulary: a hit counts if neither neighbour is an ASCII letter or
digit.  Every distinct term adds its weight once: a strict term weighs ``limit``, a soft term 1,
and ``limit`` rejects, so one strict or ``limit`` distinct soft terms do.  Terms and urls are
compared with A-Z lower-cased; nothing is percent-decoded.

Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path: from
there up to ``?``, ``#`` or the end.  Ports and user names belong to the host, as written.  Null
urls and urls without ``://`` have an empty host and path, so no rule fits them; the vocabulary
still reads the whole url (null: empty, allowed).  Empty tables give empty results, repeated
rows the same result each, long urls take one linear pass.  Input columns named like output
columns are replaced; the others pass through.

No shuffle: every row is judged by itself.  Rules and vocabulary are parameters that travel
with the task.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from typing import NamedTuple

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_text, set_aside

ALLOW, BLOCK = "allow", "block"


class Rule(NamedTuple):
    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


# Fixed values of the registered query.
RULES = (Rule("com", "/", ALLOW), Rule("example.com", "/en/", BLOCK), Rule("www.example.com", "/en/", ALLOW),
         Rule("net", "/es/", BLOCK), Rule("net", "/fr/", BLOCK))

STRICT = ("porn", "porno", "xxx", "hentai", "camgirl", "escort", "warez", "keygen", "phishing", "malware")
SOFT = ("ads", "adserver", "track", "tracker", "tracking", "click", "popup", "banner", "affiliate", "sponsored",
        "casino", "poker", "bet", "betting", "slots", "jackpot", "lottery", "sex", "adult", "nude", "dating",
        "viagra", "cialis", "pharmacy", "replica", "crack", "torrent", "download", "free", "cheap", "loan", "payday")
LIMIT = 2

_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_END_OF_HOST, _END_OF_PATH = re.compile("[/?#]"), re.compile("[?#]")
_INNER = frozenset("abcdefghijklmnopqrstuvwxyz0123456789")
COLUMNS = ("host", "path", "rule", "verdict", "n_strict", "n_soft", "weight")


def host_and_path(url: str | None) -> tuple[str, str]:
    _, found, rest = (url or "").partition("://")
    if not found:
        return "", ""
    at = _END_OF_HOST.search(rest)
    host, rest = (rest[:at.start()], rest[at.start():]) if at else (rest, "")
    return host.translate(_LOWER), _END_OF_PATH.split(rest, maxsplit=1)[0]


class RuleSet:
    """Rules by host: a lookup costs one step per label of the url's host."""

    def __init__(self, rules: Iterable[Rule]):
        self.by_host: dict[str, list[Rule]] = {}
        for rule in sorted(set(rules), key=lambda r: (len(r.text), len(r.host), r.verdict == BLOCK), reverse=True):
            self.by_host.setdefault(rule.host, []).append(rule)

    def best(self, host: str, path: str) -> Rule | None:
        fits = []
        while host:
            # longest first within a host
            fits += [r for r in self.by_host.get(host, ()) if path.startswith(r.path)][:1]
            host = host.partition(".")[2]
        return max(fits, key=lambda r: (len(r.text), len(r.host)), default=None)


class Vocabulary:
    """Distinct strict and soft terms of a url, by one Aho-Corasick pass."""

    def __init__(self, strict: Iterable[str], soft: Iterable[str]):
        self.automaton = ahocorasick.Automaton()
        for terms, is_strict in ((soft, False), (strict, True)):  # a term in both lists is strict
            for term in terms:
                self.automaton.add_word(term.translate(_LOWER), (term.translate(_LOWER), is_strict))
        if len(self.automaton):
            self.automaton.make_automaton()

    def hits(self, url: str | None) -> tuple[int, int]:
        text = (url or "").translate(_LOWER)
        found = set()
        for last, (term, is_strict) in self.automaton.iter(text) if len(self.automaton) else ():
            before, after = last - len(term), last + 1
            if (before < 0 or text[before] not in _INNER) and (after >= len(text) or text[after] not in _INNER):
                found.add((term, is_strict))
        n_strict = sum(is_strict for _, is_strict in found)
        return n_strict, len(found) - n_strict


def judge_urls(df: DataFrame, url_col: str = "url", rules: Iterable[Rule] = RULES, strict: Iterable[str] = STRICT,
               soft: Iterable[str] = SOFT, limit: int = LIMIT) -> DataFrame:
    """``df`` with host, path, rule (null where none fits), verdict, n_strict, n_soft and weight."""
    rules, strict, soft = tuple(rules), tuple(strict), tuple(soft)
    text, count = T.StringType(), T.LongType()
    fields = [T.StructField(c, t) for c, t in zip(COLUMNS, (text, text, text, text, count, count, count))]

    def make():
        known, words = RuleSet(rules), Vocabulary(strict, soft)

        def judge(url):
            host, path = host_and_path(url)
            rule = known.best(host, path)
            n_strict, n_soft = words.hits(url)
            weight = limit * n_strict + n_soft
            verdict = rule.verdict if rule else BLOCK if weight >= limit else ALLOW
            return host, path, rule.text if rule else None, verdict, n_strict, n_soft, weight

        def run(urls):
            rows = [judge(u) for u in urls]
            return [pa.array([r[i] for r in rows], type=pa.string() if i < 4 else pa.int64()) for i in range(len(COLUMNS))]
        return run
    return map_text(df, url_col, fields, make)


def keep_allowed(df: DataFrame, url_col: str = "url", **kw) -> DataFrame:
    """Rows of ``df`` whose url is allowed; same columns."""
    plain, restore = set_aside(df, [c for c in COLUMNS if c != url_col])
    return restore(judge_urls(plain, url_col, **kw).where(F.col("verdict") == ALLOW))


def url_report(pages: DataFrame) -> DataFrame:
    """Contract columns, one row per page."""
    return judge_urls(pages.select("page_id", "url")).select("page_id", *COLUMNS)
