"""URL filter by host and path rules and by a weighted vocabulary.

The vocabulary is searched with one Aho-Corasick automaton. A term counts only if it stands alone: no letter or digit
touches it on either side. One strict term rejects; so do several different soft terms whose weights reach a sum.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import ahocorasick
from pyspark.sql import DataFrame

from farebox.llm.tasks import with_python_columns

# Fixed values of the default vocabulary.
STRICT_TERMS = ("adult", "casino", "escort", "gambling", "hentai", "phishing", "porn", "warez", "xxx")
SOFT_TERMS = {
    "bet": 1.0, "bets": 1.0, "bonus": 1.0, "cheap": 1.0, "click": 1.0, "coupon": 1.0, "crack": 1.0, "dating": 1.0,
    "farm": 1.0, "free": 1.0, "jackpot": 1.0, "keygen": 1.0, "loan": 1.0, "loans": 1.0, "pills": 1.0, "poker": 1.0,
    "prize": 1.0, "promo": 1.0, "sex": 1.0, "slots": 1.0, "spam": 1.0, "torrent": 1.0, "viagra": 1.0, "win": 1.0,
}
SOFT_LIMIT = 2.0
LEAST_SOFT_TERMS = 2

_UPPER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


@dataclass(frozen=True)
class Rule:
    """``allow`` or ``block`` for a host with its subdomains and the paths that start with ``path``."""

    action: str
    host: str
    path: str = "/"

    @property
    def name(self) -> str:
        return self.host + self.path


def host_and_path(url: str | None) -> tuple[str, str]:
    """Host (between the first ``://`` and ``/``, ``?``, ``#`` or the end; A-Z lower-cased) and path (up to ``?``, ``#``
    or the end); both empty for NULL or without ``://``."""
    _, found, rest = (url or "").partition("://")
    if not found:
        return "", ""
    rest = rest.partition("#")[0].partition("?")[0]
    host, slash, path = rest.partition("/")
    return host.translate(_UPPER), slash + path


def best_rule(host: str, path: str, rules: dict[str, list[Rule]]) -> Rule | None:
    """The longest rule that fits; of equally long ones the one with the longer host."""
    fitting, at = [], 0
    while at >= 0 and host:
        fitting += [r for r in rules.get(host[at:], ()) if path.startswith(r.path)]
        at = host.find(".", at) + 1 or -1
    return max(fitting, key=lambda r: (len(r.name), len(r.host)), default=None)


class Vocabulary:
    """Strict and soft terms in one automaton."""

    def __init__(self, strict: Sequence[str], soft: dict[str, float]):
        self.automaton = ahocorasick.Automaton()
        for term in strict:
            self.automaton.add_word(term, (term, None))
        for term, weight in soft.items():
            self.automaton.add_word(term, (term, weight))
        self.automaton.make_automaton()

    def count(self, url: str) -> tuple[int, int, float]:
        """Different strict terms, different soft terms, and the sum of the soft terms' weights."""
        text = url.translate(_UPPER)
        strict, soft = set(), {}
        if len(self.automaton):
            for last, (term, weight) in self.automaton.iter(text):
                first = last - len(term) + 1
                if (first == 0 or not text[first - 1].isalnum()) and (last + 1 == len(text) or not text[last + 1].isalnum()):
                    if weight is None:
                        strict.add(term)
                    else:
                        soft[term] = weight
        return len(strict), len(soft), sum(soft.values())


def judge_urls(
    df: DataFrame, rules: Sequence[Rule] = (), strict: Sequence[str] = STRICT_TERMS, soft: dict[str, float] = SOFT_TERMS,
    limit: float = SOFT_LIMIT, least: int = LEAST_SOFT_TERMS, url: str = "url",
) -> DataFrame:
    """``df`` with ``host``, ``path``, ``rule`` (NULL if none fits), ``n_strict``, ``n_soft``, ``soft_weight`` and ``verdict``.

    The verdict is the longest fitting rule's, otherwise ``block`` if a strict term or at least ``least`` different
    soft terms of a joint weight of ``limit`` stand in the url, otherwise ``allow``. NULL and empty urls have an empty
    host and path, fit no rule and are allowed. Rows are judged one by one: repeated rows alike, long urls whole.
    Columns of the same names are replaced. Rules and terms are parameters, so their size is the caller's.
    """
    by_host: dict[str, list[Rule]] = {}
    for rule in rules:
        by_host.setdefault(rule.host, []).append(rule)

    def make():
        vocabulary = Vocabulary(strict, soft)

        def one(text):
            host, path = host_and_path(text)
            rule = best_rule(host, path, by_host)
            n_strict, n_soft, weight = vocabulary.count(text or "")
            bad = n_strict >= 1 or n_soft >= least and weight >= limit
            verdict = rule.action if rule else "block" if bad else "allow"
            return host, path, rule.name if rule else None, n_strict, n_soft, weight, verdict

        return lambda urls: list(zip(*map(one, urls))) or [()] * 7

    columns = "host string, path string, rule string, n_strict int, n_soft int, soft_weight double, verdict string"
    return with_python_columns(df, [url], columns, make)
