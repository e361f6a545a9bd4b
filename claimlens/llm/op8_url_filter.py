"""URL filter: host and path rules first, then a weighted vocabulary found by an Aho-Corasick automaton.

A strict term rejects a url by itself; soft terms reject it when the weights of the distinct ones found
reach a threshold. A term counts only between boundaries: neither neighbour is an ASCII letter or digit.

Defined results: a null url has an empty host and path, no rule and the verdict allow. A url without
``://`` has an empty host and path, so no rule fits, but its characters are still searched for terms. Every
input row gives one output row, repeated rows and null ids included; other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame

# fixed values: rules as (action, host, path)
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
# fixed values: terms that reject by themselves
STRICT = (
    "adult", "adulte", "bdsm", "camgirl", "camgirls", "casino", "casinos", "cialis", "erotic", "escort", "escorts", "fetish",
    "hardcore", "hentai", "keygen", "malware", "milf", "nsfw", "nude", "nudes", "phishing", "porn", "porno", "pornos", "sex",
    "sexcam", "sexy", "slots", "spam", "spyware", "steroids", "viagra", "warez", "webcamsex", "xanax", "xxx",
)
# fixed values: terms that reject together, weighted by how seldom they stand in the addresses of ordinary pages
SOFT = (
    ("ad", 0.25), ("ads", 0.5), ("affiliate", 1.0), ("banner", 0.75), ("bet", 1.25), ("bets", 1.5), ("betting", 1.75), ("bingo", 1.25),
    ("bonus", 1.0), ("buy", 0.5), ("cash", 0.75), ("cheap", 1.0), ("click", 1.0), ("clickbait", 1.75), ("coupon", 0.75), ("crack", 1.5),
    ("cracked", 1.5), ("credit", 0.5), ("dating", 1.25), ("deal", 0.75), ("deals", 0.75), ("diet", 0.75), ("discount", 0.75),
    ("download", 0.25), ("farm", 0.25), ("forex", 1.25), ("free", 0.5), ("gambling", 1.75), ("girls", 1.0), ("hack", 1.0), ("hot", 0.75),
    ("jackpot", 1.75), ("lead", 0.25), ("loan", 1.25), ("loans", 1.5), ("lottery", 1.5), ("lotto", 1.5), ("mortgage", 0.75), ("offer", 0.75),
    ("offers", 0.75), ("payday", 1.75), ("pharmacy", 1.25), ("pill", 1.25), ("pills", 1.5), ("poker", 1.75), ("popup", 1.25), ("prize", 1.0),
    ("promo", 1.0), ("replica", 1.5), ("roulette", 1.75), ("sale", 0.5), ("serial", 0.75), ("singles", 1.0), ("slim", 0.75), ("sponsored", 1.0),
    ("survey", 0.5), ("torrent", 1.5), ("track", 0.5), ("tracker", 0.75), ("win", 0.75), ("winner", 0.75),
)
SOFT_LIMIT = 2.0

SCHEMA = "page_id long, host string, path string, rule string, verdict string, strict_hit boolean, soft_weight double"


@dataclass(frozen=True)
class Vocabulary:
    strict: Sequence[str] = STRICT
    soft: Sequence[tuple[str, float]] = SOFT
    soft_limit: float = SOFT_LIMIT


def _ascii_lower(s: str) -> str:
    return s.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def host_and_path(url: str | None) -> tuple[str, str]:
    if url is None or (at := url.find("://")) < 0:
        return "", ""
    rest = url[at + 3 :]
    end = min((i for c in "/?#" if (i := rest.find(c)) >= 0), default=len(rest))
    path = rest[end:]
    stop = min((i for c in "?#" if (i := path.find(c)) >= 0), default=len(path))
    return _ascii_lower(rest[:end]), path[:stop]


def longest_rule(host: str, path: str, rules=RULES) -> tuple[str | None, str | None]:
    """(rule text, action) of the longest rule that fits the host or a parent of it, and the path's start."""
    fits = [
        (len(h) + len(p), h + p, action)
        for action, h, p in rules
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    _, rule, action = max(fits, default=(0, None, None))
    return rule, action


def _automaton(vocabulary: Vocabulary):
    import ahocorasick

    a = ahocorasick.Automaton()
    for term in vocabulary.strict:
        a.add_word(term, (term, None))
    for term, weight in vocabulary.soft:
        a.add_word(term, (term, weight))
    a.make_automaton()
    return a


def _word_char(c: str) -> bool:
    return c.isascii() and c.isalnum()


def vocabulary_hits(automaton, url: str | None) -> tuple[bool, float]:
    """(any strict hit, weight of the distinct soft terms) between boundaries."""
    s = _ascii_lower(url or "")
    strict, soft = False, {}
    for end, (term, weight) in automaton.iter(s):
        start = end - len(term)
        if (start >= 0 and _word_char(s[start])) or (end + 1 < len(s) and _word_char(s[end + 1])):
            continue
        if weight is None:
            strict = True
        else:
            soft[term] = weight
    return strict, float(sum(soft.values()))


def url_verdicts(pages: DataFrame, rules=RULES, vocabulary: Vocabulary = Vocabulary()) -> DataFrame:
    """Host, path, rule and verdict of each page; one pass without a shuffle."""
    rules = tuple(rules)

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        automaton = _automaton(vocabulary)
        for batch in batches:
            rows = []
            for page_id, url in zip(batch["page_id"].array, batch["url"].array, strict=True):
                url = url if isinstance(url, str) else None
                host, path = host_and_path(url)
                rule, verdict = longest_rule(host, path, rules)
                strict, soft = vocabulary_hits(automaton, url)
                if verdict is None:
                    verdict = "block" if strict or soft >= vocabulary.soft_limit else "allow"
                rows.append((page_id, host, path, rule, verdict, strict, soft))
            out = pd.DataFrame(rows, columns=["page_id", "host", "path", "rule", "verdict", "strict_hit", "soft_weight"])
            out["page_id"] = pd.array([None if pd.isna(x) else int(x) for x in out["page_id"]], "Int64")
            yield out

    return pages.selectExpr("cast(page_id as string) as page_id", "url").mapInPandas(judge, SCHEMA)


def query(spark, sf_dir):
    from claimlens.llm.common import table

    return url_verdicts(table(spark, sf_dir, "pages"))


def _term_pattern(terms) -> str:
    return f"(^|[^a-z0-9])({'|'.join(terms)})($|[^a-z0-9])"


def oracle() -> str:
    soft = " + ".join(
        f"case when regexp_matches(u, '{_term_pattern([term])}') then {weight} else 0.0 end" for term, weight in SOFT
    )
    ranked = sorted(RULES, key=lambda r: -len(r[1] + r[2]))
    rule = "case " + " ".join(
        f"when (host = '{h}' or suffix(host, '.{h}')) and starts_with(path, '{p}') then '{h + p}'" for _, h, p in ranked
    ) + " end"
    verdict = " ".join(f"when rule = '{h + p}' then '{action}'" for action, h, p in RULES)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""
with split as (
  select page_id, coalesce(translate(regexp_extract(url, '://([^/?#]*)', 1), '{upper}', '{lower}'), '') as host,
    coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') as path,
    translate(coalesce(url, ''), '{upper}', '{lower}') as u
  from pages
), ruled as (
  select *, {rule} as rule,
    regexp_matches(u, '{_term_pattern(STRICT)}') as strict_hit,
    cast({soft} as double) as soft_weight
  from split
)
select page_id, host, path, rule,
  case {verdict} when strict_hit or soft_weight >= {SOFT_LIMIT} then 'block' else 'allow' end as verdict,
  strict_hit, soft_weight
from ruled"""
