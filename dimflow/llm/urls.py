"""Verdicts on URLs: rules for hosts and paths first, then a weighted vocabulary matched by an Aho-Corasick automaton.

A term hits where the lower-cased URL holds it between characters other than a-z and 0-9 (or its ends). Every term has a
weight; the URL is rejected when the weights of its different hits come to ``REJECT``. A strict term weighs that much by
itself, of soft terms several different ones are needed; the same one again counts once.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimflow.llm.words import kept

REJECT = 2
STRICT = ("camgirls", "cialis", "escorts", "hentai", "keygen", "milf", "nudes", "porn", "porno", "sexcam", "viagra", "warez", "xxx")
SOFT = ("ads", "adult", "bet", "bets", "betting", "bonus", "casino", "cheap", "crack", "dating", "escort", "farm", "free", "gambling",
        "jackpot", "loans", "nude", "payday", "pharmacy", "pills", "poker", "replica", "sex", "sexy", "slots", "spam", "torrent",
        "track", "webcam", "win", "x")
VOCABULARY = {t: REJECT for t in STRICT} | {t: 1 for t in SOFT}

_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
_JUDGED = "host string, path string, rule string, verdict string, n_strict long, n_soft long, hits array<string>"


@dataclass(frozen=True)
class Rule:
    """Fits ``host`` and all its subdomains where the URL's path starts with ``path``."""

    verdict: str
    host: str
    path: str = "/"

    def __str__(self) -> str:
        return self.host + self.path


def split_url(url: str | None) -> tuple[str, str]:
    """(host, path): what follows the first ``://`` up to ``/``, ``?`` or ``#``, lower-cased A-Z; then up to ``?`` or ``#``."""
    _, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    rest = rest.partition("#")[0].partition("?")[0]
    host, slash, path = rest.partition("/")
    return host.translate(_LOWER), slash + path


@dataclass(frozen=True)
class UrlFilter:
    """Rules and vocabulary, as plain lists of the caller's. ``rules`` may be many: a URL only looks up its own domains."""

    rules: tuple[Rule, ...] = ()
    vocabulary: Mapping[str, int] = field(default_factory=lambda: dict(VOCABULARY))

    def _tools(self):
        import ahocorasick

        terms = ahocorasick.Automaton()
        for term, weight in self.vocabulary.items():
            terms.add_word(term, (term, weight))
        if len(terms):
            terms.make_automaton()
        by_host: dict[str, list[Rule]] = {}
        for rule in self.rules:
            by_host.setdefault(rule.host, []).append(rule)
        return terms, by_host

    @staticmethod
    def _rule(by_host: dict[str, list[Rule]], host: str, path: str) -> Rule | None:
        """The longest rule that fits; of equally long ones that of the longer host."""
        fits, domain = [], host
        while True:
            fits += [r for r in by_host.get(domain, ()) if path.startswith(r.path)]
            _, dot, domain = domain.partition(".")
            if not dot:
                return max(fits, key=lambda r: (len(str(r)), len(r.host)), default=None)

    @staticmethod
    def _hits(terms, url: str) -> dict[str, int]:
        text = url.translate(_LOWER)
        bounded = lambda c: not ("a" <= c <= "z" or "0" <= c <= "9")
        found = {}
        for end, (term, weight) in terms.iter(text) if len(terms) else ():
            start = end - len(term) + 1
            if (start == 0 or bounded(text[start - 1])) and (end + 1 == len(text) or bounded(text[end + 1])):
                found[term] = weight
        return found

    def judge(self, urls: Iterable[str | None]) -> pd.DataFrame:
        name = f"url filter {hash((self.rules, tuple(sorted(self.vocabulary.items()))))}"
        terms, by_host = kept(name, self._tools)
        rows = []
        for url in urls:
            host, path = split_url(url)
            rule, hits = self._rule(by_host, host, path), self._hits(terms, url or "")
            own = "block" if sum(hits.values()) >= REJECT else "allow"
            strict = sum(w >= REJECT for w in hits.values())
            rows.append((host, path, rule and str(rule), rule.verdict if rule else own, strict, len(hits) - strict, sorted(hits)))
        return pd.DataFrame(rows, columns=[c.split()[0] for c in _JUDGED.split(", ")])


def judged(pages: DataFrame, wanted: UrlFilter) -> DataFrame:
    """page_id, host, path, rule, verdict, n_strict, n_soft, hits for every row of ``pages`` (page_id, url).

    One pass, no shuffle; other columns are not read. The verdict is that of the longest rule that fits, else ``block`` when
    the vocabulary rejects the URL and ``allow`` when not. A NULL or empty url has an empty host and path and is allowed; one
    without ``://`` has an empty host and path too, but is matched against the vocabulary. Every row is judged by itself:
    repeated rows and NULL ids stay as they are. ``hits`` lists the different terms found, also where a rule decides.
    """
    find = F.pandas_udf(lambda urls: wanted.judge(None if pd.isna(u) else u for u in urls), _JUDGED)
    return pages.select("page_id", find("url").alias("_judged")).select("page_id", "_judged.*")
