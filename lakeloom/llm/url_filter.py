"""URL filter: weighted vocabulary found by an Aho-Corasick automaton, under host/path rules.

A term counts when neither neighbour in the lower-cased (A-Z) url is a letter or digit
(a-z, 0-9).  The weights of the *distinct* terms found are added; a url is rejected at
``REJECT_AT``.  Strict terms weigh ``REJECT_AT`` and reject alone, soft terms weigh less
and reject from two different ones on.  A rule (host, path) fits its host and every
subdomain when the url's path starts with the rule's; the longest fitting rule decides,
otherwise the vocabulary does.

Defined results: a null url, or one without ``://``, has an empty host and path, hence no
rule, and is judged by its terms (a null has none: allow).  Repeated rows give repeated
rows.  Only the id and url columns are read, so other columns can't clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import UPPER, arrow_limits, ascii_lower

REJECT_AT = 2
#: The vocabulary.
STRICT = ("adult", "casino", "escort", "hentai", "malware", "phishing", "porn", "sex", "spam", "viagra", "warez", "xxx")
SOFT = ("ads", "bet", "bets", "bonus", "cheap", "click", "deal", "farm", "free", "loan", "pills", "poker", "promo",
        "track", "tracker", "win", "winner")
WEIGHTS = {t: REJECT_AT for t in STRICT} | {t: 1 for t in SOFT}
#: The rules of the contract, (host, path, verdict).
RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("net", "/fr/", "block"))

_WORD = frozenset("abcdefghijklmnopqrstuvwxyz0123456789")


def automaton(weights: dict[str, int]) -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for term, weight in weights.items():
        found.add_word(term, (term, weight))
    found.make_automaton()
    return found


def terms_in(url: str, found: ahocorasick.Automaton) -> dict[str, int]:
    """The distinct vocabulary terms of a lower-cased url that stand between boundaries."""
    hits: dict[str, int] = {}
    last = len(url) - 1
    for end, (term, weight) in found.iter(url):
        start = end - len(term)
        if (start < 0 or url[start] not in _WORD) and (end == last or url[end + 1] not in _WORD):
            hits[term] = weight
    return hits


def score_urls(df: DataFrame, id_col: str, url_col: str, weights: dict[str, int] | None = None) -> DataFrame:
    """(id, url, terms, weight): what the vocabulary finds in every url."""
    weights = WEIGHTS if weights is None else weights
    arrow_limits(df.sparkSession)
    slim = df.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url"))
    lower = str.maketrans(UPPER, UPPER.lower())

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = automaton(weights) if weights else None
        for b in batches:
            hits = [terms_in(u.translate(lower), found) if u and found else {} for u in b.column("url").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("url"), pa.array([sorted(h) for h in hits], pa.list_(pa.string())),
                 pa.array([sum(h.values()) for h in hits], pa.int32())], ["id", "url", "terms", "weight"])

    return slim.mapInArrow(scan, "id long, url string, terms array<string>, weight int")


def url_parts(url) -> tuple:
    """(host, path) of a url column, both empty without ``://``."""
    at = F.locate("://", url)
    rest = F.coalesce(F.when(at > 0, F.substring(url, at + F.lit(3), F.length(url))), F.lit(""))
    return ascii_lower(F.regexp_extract(rest, r"^([^/?#]*)", 1)), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def judge(df: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES,
          weights: dict[str, int] | None = None, reject_at: int = REJECT_AT) -> DataFrame:
    """(id, host, path, rule, verdict, terms, weight) for every row."""
    host, path = url_parts(F.col("url"))
    scored = score_urls(df, id_col, url_col, weights).select("*", host.alias("host"), path.alias("path"))
    rule, verdict = F.lit(None).cast("string"), F.when(F.col("weight") >= reject_at, "block").otherwise("allow")
    for r_host, r_path, r_verdict in sorted(rules, key=lambda r: len(r[0]) + len(r[1])):  # the longest is put outermost
        fits = ((F.col("host") == r_host) | F.col("host").endswith("." + r_host)) & F.col("path").startswith(r_path)
        rule = F.when(fits, r_host + r_path).otherwise(rule)
        verdict = F.when(fits, r_verdict).otherwise(verdict)
    return scored.select(F.col("id").alias(id_col), "host", "path", rule.alias("rule"), verdict.alias("verdict"),
                         "terms", "weight")
