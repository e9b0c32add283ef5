"""URL filter by a weighted vocabulary.

An automaton counts strict and soft terms in the whole lower-cased url. A hit counts if no letter or digit stands
next to it. One strict term, or soft terms whose distinct weights add up to the limit, reject the url. Host and path
rules come first; the longest fitting rule decides.

Null url, or one without `://`: host and path are empty, no rule fits, and the vocabulary still judges a url that is
not null. Other columns pass through. Vocabulary and rules are parameters whose size does not grow with the urls;
a rule is found by looking up the host's suffixes, not by trying all rules.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

# The rules, as (verdict, rule).
RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)

# Terms that reject alone, and terms that reject together, with their weights.
STRICT = (
    "porn", "porno", "xxx", "hentai", "escort", "escorts", "casino", "viagra", "cialis", "warez", "torrent",
    "malware", "phishing", "keygen",
)
SOFT = {
    "adult": 1, "sex": 1, "sexy": 1, "nude": 1, "naked": 1, "dating": 1, "bet": 1, "betting": 1, "poker": 1,
    "gambling": 1, "jackpot": 1, "loan": 1, "loans": 1, "pills": 1, "pharmacy": 1, "crack": 1, "serial": 1,
    "free": 1, "win": 1, "bonus": 1, "promo": 1,
}
SOFT_LIMIT = 2

_UPPER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
_PLAIN = frozenset("abcdefghijklmnopqrstuvwxyz0123456789")


@dataclass(frozen=True)
class Vocabulary:
    strict: tuple[str, ...] = STRICT
    soft: dict[str, int] = field(default_factory=lambda: dict(SOFT))
    limit: int = SOFT_LIMIT


def split_url(url: str | None) -> tuple[str, str]:
    """Host, A-Z lower-cased, and path."""
    at = url.find("://") if url is not None else -1
    if at < 0:
        return "", ""
    rest = url[at + 3 :]
    end = min((i for i in map(rest.find, "/?#") if i >= 0), default=len(rest))
    tail = rest[end:]
    stop = min((i for i in map(tail.find, "?#") if i >= 0), default=len(tail))
    return rest[:end].translate(_UPPER), tail[:stop]


def host_rules(rules) -> dict[str, list[tuple[str, str, str]]]:
    """Rules by host, each host's longest path first."""
    by_host = defaultdict(list)
    for verdict, rule in rules:
        host, slash, path = rule.partition("/")
        by_host[host].append((slash + path, rule, verdict))
    return {h: sorted(r, key=lambda x: -len(x[0])) for h, r in by_host.items()}


def fitting(host: str, path: str, by_host) -> tuple[str, str] | None:
    """The longest rule for the host or a domain above it, and its verdict."""
    best, suffix = None, host
    while suffix:
        for start, rule, verdict in by_host.get(suffix, ()):
            if path.startswith(start):
                if best is None or len(rule) > len(best[0]):
                    best = (rule, verdict)
                break
        suffix = suffix.partition(".")[2]
    return best


def automaton(words: Vocabulary) -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    for term in {*words.strict, *words.soft}:
        a.add_word(term, term)
    a.make_automaton()
    return a


def hits(url: str, a: ahocorasick.Automaton) -> set[str]:
    """Distinct terms with no letter or digit beside them."""
    low = url.translate(_UPPER)
    found = set()
    for end, term in a.iter(low):
        start = end - len(term)
        if (start < 0 or low[start] not in _PLAIN) and (end + 1 >= len(low) or low[end + 1] not in _PLAIN):
            found.add(term)
    return found


_OUT = StructType(
    [
        StructField("host", StringType()),
        StructField("path", StringType()),
        StructField("rule", StringType()),
        StructField("verdict", StringType()),
        StructField("strict_hits", IntegerType()),
        StructField("soft_weight", IntegerType()),
    ]
)


def filter_urls(
    pages: DataFrame, keep: list[str], url_col: str = "url", rules=RULES, words: Vocabulary = Vocabulary()
) -> DataFrame:
    """The kept columns, then host, path, rule, verdict and what the vocabulary found.

    One pass without a shuffle. A kept column named like one of the results is replaced by it.
    """
    keep = [c for c in keep if c not in _OUT.fieldNames()]
    source = pages.select(*keep, F.col(url_col).alias("__url"))
    schema = StructType(source.drop("__url").schema.fields + _OUT.fields)
    arrow, by_host = to_arrow_schema(schema), host_rules(rules)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = automaton(words)
        for batch in batches:
            rows = []
            for url in batch.column(len(keep)).to_pylist():
                host, path = split_url(url)
                found = hits(url, a) if url else set()
                strict = sum(t in words.strict for t in found)
                soft = sum(words.soft.get(t, 0) for t in found)
                rule = fitting(host, path, by_host)
                verdict = rule[1] if rule else "block" if strict or soft >= words.limit else "allow"
                rows.append((host, path, rule and rule[0], verdict, strict, soft))
            columns = [batch.column(i).cast(arrow.field(i).type) for i in range(len(keep))]
            made = zip(*rows) if rows else [[]] * len(_OUT)
            columns += [pa.array(list(v), f.type) for v, f in zip(made, list(arrow)[len(keep) :])]
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return source.mapInArrow(judge, schema)


def oracle_sql(rules=RULES, words: Vocabulary = Vocabulary()) -> str:
    """The same judgement in SQL, term by term with patterns."""

    def quoted(text):
        return "'" + text.replace("'", "''") + "'"

    def fits(rule):
        host, slash, path = rule.partition("/")
        return (
            f"(host = {quoted(host)} OR ends_with(host, {quoted('.' + host)})) "
            f"AND starts_with(path, {quoted(slash + path)})"
        )

    ordered = sorted(rules, key=lambda r: -len(r[1]))
    rule = " ".join(f"WHEN {fits(r)} THEN {quoted(r)}" for _, r in ordered)
    by_rule = " ".join(f"WHEN rule = {quoted(r)} THEN {quoted(v)}" for v, r in ordered)

    def hit(term):
        return f"CAST(regexp_matches(low, '(^|[^a-z0-9]){term}($|[^a-z0-9])') AS INTEGER)"

    strict = " + ".join(hit(t) for t in words.strict)
    soft = " + ".join(f"{w} * {hit(t)}" for t, w in words.soft.items())
    capitals, small = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""
WITH u AS (SELECT page_id, translate(url, '{capitals}', '{small}') AS low,
                  CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
           FROM pages),
p AS (SELECT page_id, low,
             translate(regexp_extract(rest, '^[^/?#]*'), '{capitals}', '{small}') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
      FROM u),
r AS (SELECT *, CASE {rule} END AS rule, CAST(coalesce({strict}, 0) AS INTEGER) AS strict_hits,
             CAST(coalesce({soft}, 0) AS INTEGER) AS soft_weight
      FROM p)
SELECT page_id, host, path, rule,
       CASE {by_rule} WHEN strict_hits > 0 OR soft_weight >= {words.limit} THEN 'block' ELSE 'allow' END AS verdict,
       strict_hits, soft_weight
FROM r"""
