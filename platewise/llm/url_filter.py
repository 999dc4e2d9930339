"""URL filter: host and path rules before a weighted vocabulary (6).

A url's host is what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; its path what
then follows up to ``?``, ``#`` or the end. The longest rule whose host is the url's or a parent domain of it and
whose path begins the url's path decides. Without such a rule one Aho-Corasick automaton runs over the A-Z
lower-cased url: terms count where no letter or digit touches them, and one strict term or ``SOFT_LIMIT`` distinct
soft terms reject the url. ``weight`` sums the distinct terms found, strict ones as ``STRICT_WEIGHT``.

Results for special input: a null url or one without ``://`` has empty host and path and no rule; a null url is
allowed; repeated rows are judged each; urls of any length are scanned whole; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from platewise.llm.common import LONG, STRING, carry, fields, pick, restore

#: (host, path, verdict) of the registered query.
RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
         ("com", "/fr/", "allow"), ("com", "/de/", "block"))
#: Terms that reject alone, and terms that reject in company.
STRICT = ("porn", "porno", "xxx", "hentai", "casino", "viagra", "cialis", "warez", "torrent", "crackz", "escort",
          "escorts", "camgirls", "phishing", "malware")
SOFT = ("adult", "sex", "sexy", "nude", "dating", "bet", "betting", "poker", "slots", "jackpot", "loan", "loans",
        "payday", "pharmacy", "pills", "keygen", "serial", "crack", "cheap", "free", "download", "click", "win",
        "prize", "track", "redirect", "popup", "ads")
SOFT_LIMIT, STRICT_WEIGHT = 2, 10
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_FOLD = str.maketrans(_UPPER, _LOWER)


def split_url(url: str | None) -> tuple[str, str]:
    """Host and path of a url."""
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1].split("#", 1)[0].split("?", 1)[0]
    host, slash, path = rest.partition("/")
    return host.translate(_FOLD), slash + path


class Judge:
    """Built once per task from the rules and the vocabulary."""

    def __init__(self, rules=RULES, strict=STRICT, soft=SOFT, soft_limit: int = SOFT_LIMIT):
        self.by_host: dict[str, list[tuple[str, str]]] = {}
        for host, path, verdict in rules:
            self.by_host.setdefault(host, []).append((path, verdict))
        self.limit = soft_limit
        self.terms = ahocorasick.Automaton()
        for term in soft:
            self.terms.add_word(term, (term, False))
        for term in strict:
            self.terms.add_word(term, (term, True))
        if strict or soft:
            self.terms.make_automaton()

    def rule(self, host: str, path: str) -> tuple[str, str] | None:
        """The longest fitting rule and its verdict. Looks up the host and its parents, not every rule."""
        best, at = None, 0
        while host and at >= 0:
            parent = host[at:]
            for prefix, verdict in self.by_host.get(parent, ()):
                if path.startswith(prefix) and (best is None or len(parent + prefix) > len(best[0])):
                    best = (parent + prefix, verdict)
            dot = host.find(".", at)
            at = dot + 1 if dot >= 0 else -1
        return best

    def hits(self, url: str) -> tuple[set[str], set[str]]:
        """Distinct strict and soft terms that stand free in the url."""
        text, strict, soft = url.translate(_FOLD), set(), set()
        for end, (term, hard) in self.terms.iter(text) if len(self.terms) else ():
            start = end + 1 - len(term)
            if (start == 0 or not text[start - 1].isalnum()) and (end + 1 == len(text) or not text[end + 1].isalnum()):
                (strict if hard else soft).add(term)
        return strict, soft

    def __call__(self, url: str | None) -> tuple[str, str, str | None, str, int, int, int]:
        host, path = split_url(url)
        strict, soft = self.hits(url or "")
        rule = self.rule(host, path)
        verdict = rule[1] if rule else "block" if strict or len(soft) >= self.limit else "allow"
        return (host, path, rule[0] if rule else None, verdict, len(strict), len(soft),
                STRICT_WEIGHT * len(strict) + len(soft))


OUT = fields(host=STRING, path=STRING, rule=STRING, verdict=STRING, strict_terms=LONG, soft_terms=LONG, weight=LONG)


def judge_urls(pages: DataFrame, rules=RULES, strict=STRICT, soft=SOFT, soft_limit: int = SOFT_LIMIT) -> DataFrame:
    """``pages`` with host, path, rule, verdict and the numbers of terms; columns of these names are replaced."""
    source = carry(pages, "url").withColumn("url", F.col("url").cast("string"))
    schema = T.StructType([source.schema["row"], *OUT.fields])
    kinds = [pa.string()] * 4 + [pa.int64()] * 3

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Judge(rules, strict, soft, soft_limit)
        for batch in batches:
            got = list(zip(*map(judge, batch.column("url").to_pylist()))) or [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([batch.column("row"), *map(pa.array, got, kinds)], names=["row", *OUT.names])

    return restore(source.mapInArrow(run, schema), pages, *OUT.names)


def judged_pages(pages: DataFrame) -> DataFrame:
    return judge_urls(pick(pages, "page_id", "url"))


def oracle_sql() -> str:
    """The registered query in SQL."""
    rules = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES)
    free = lambda t: f"regexp_matches(u, '(^|[^\\p{{L}}\\p{{N}}]){t}($|[^\\p{{L}}\\p{{N}}])')::BIGINT"
    return f"""
WITH p AS (
  SELECT page_id, url, translate(coalesce(url, ''), '{_UPPER}', '{_LOWER}') AS u,
         CASE WHEN contains(url, '://')
              THEN split_part(split_part(url[strpos(url, '://') + 3:], '#', 1), '?', 1) ELSE '' END AS rest
  FROM pages),
s AS (
  SELECT *, row_number() OVER () AS k, translate(split_part(rest, '/', 1), '{_UPPER}', '{_LOWER}') AS host,
         CASE WHEN contains(rest, '/') THEN rest[strpos(rest, '/'):] ELSE '' END AS path,
         {' + '.join(map(free, STRICT))} AS strict_terms,
         {' + '.join(map(free, SOFT))} AS soft_terms
  FROM p),
r AS (SELECT * FROM (VALUES {rules}) t(rh, rp, rv)),
b AS (
  SELECT k, arg_max(rh || rp, length(rh || rp)) AS rule, arg_max(rv, length(rh || rp)) AS rv
  FROM s JOIN r ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY k)
SELECT page_id, url, host, path, rule,
       coalesce(rv, CASE WHEN strict_terms > 0 OR soft_terms >= {SOFT_LIMIT} THEN 'block' ELSE 'allow' END) AS verdict,
       strict_terms, soft_terms, {STRICT_WEIGHT} * strict_terms + soft_terms AS weight
FROM s LEFT JOIN b USING (k)"""
