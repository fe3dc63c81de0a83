"""URL filter: host and path rules first, then a weighted vocabulary of URL terms.

Terms are found by one Aho-Corasick pass over the lower-cased URL. A term counts
only as a whole word of the URL: the characters beside it are no letters or
digits. A strict term rejects at once; soft terms reject when so many different
ones occur that their weights reach ``limit``.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower

# The default vocabulary. Strict terms reject alone; soft terms have a weight:
# 3 for a term that seldom stands on a page worth keeping, 2 for one that often does not, 1 for a
# word of shops and advertisements. No term alone reaches the limit.
STRICT = [
    "camgirl", "camgirls", "casino", "casinos", "crackz", "escort", "escorts", "fapping", "hardcore", "hentai", "malware", "milf",
    "phishing", "porn", "porno", "pornhub", "ransomware", "torrent", "torrents", "warez", "xvideos", "xxx",
]
SOFT = {
    "adult": 3, "betting": 3, "jackpot": 3, "keygen": 3, "nude": 3, "nudes": 3, "pills": 3, "poker": 3, "replica": 3, "sex": 3,
    "sexy": 3, "slots": 3, "steroids": 3, "viagra": 3,
    "bet": 2, "bonus": 2, "cheap": 2, "cheat": 2, "cheats": 2, "click": 2, "coupon": 2, "coupons": 2, "crack": 2, "cracked": 2,
    "dating": 2, "discount": 2, "download": 2, "erotic": 2, "free": 2, "gambling": 2, "giveaway": 2, "hack": 2, "hookup": 2, "loan": 2,
    "loans": 2, "lottery": 2, "payday": 2, "prize": 2, "serial": 2, "singles": 2, "unlock": 2, "win": 2, "winner": 2,
    "affiliate": 1, "bargain": 1, "best": 1, "buy": 1, "crypto": 1, "deal": 1, "deals": 1, "offer": 1, "offers": 1, "online": 1,
    "order": 1, "outlet": 1, "promo": 1, "rewards": 1, "sale": 1, "save": 1, "shop": 1, "spam": 1, "sponsored": 1, "voucher": 1,
}
SOFT_LIMIT = 4

#: (verdict, rule): a rule is host/path and fits its host and all subdomains.
RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]


def url_host(url: Column) -> Column:
    """What stands after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """The longest rule that fits, or null. The rules are a short list typed by hand."""
    fits = F.lit(None).cast("string")
    for _, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        at, _, rest = rule.partition("/")
        hit = ((host == at) | host.endswith("." + at)) & path.startswith("/" + rest)
        fits = F.when(hit, F.lit(rule)).otherwise(fits)
    return fits


class Vocabulary:
    """Strict and soft terms in one automaton."""

    def __init__(self, strict: list[str], soft: dict[str, int]):
        import ahocorasick

        self.found = ahocorasick.Automaton()
        for term, weight in {**soft, **dict.fromkeys(strict, 0)}.items():
            self.found.add_word(term, (len(term), term, weight))
        if len(self.found):
            self.found.make_automaton()

    def hits(self, url: str) -> tuple[list[str], list[str], int]:
        """The different strict and soft terms of a lower-cased URL, and the weight of the soft ones."""
        strict: set[str] = set()
        soft: dict[str, int] = {}
        if len(self.found):
            for end, (size, term, weight) in self.found.iter(url):
                start = end - size + 1
                if (start and url[start - 1].isalnum()) or url[end + 1 : end + 2].isalnum():
                    continue
                if weight:
                    soft[term] = weight
                else:
                    strict.add(term)
        return sorted(strict), sorted(soft), sum(soft.values())


def url_terms(
    pages: DataFrame, strict: list[str] = STRICT, soft: dict[str, int] = SOFT, id_col: str = "page_id", url_col: str = "url"
) -> DataFrame:
    """Per row: page_id, url, strict_terms, soft_terms (sorted, each once) and soft_weight.

    A null or empty URL has no terms. Repeated rows stay; other columns are left
    behind; an empty table gives no rows.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(strict, soft)
        names = ["page_id", "url", "strict_terms", "soft_terms", "soft_weight"]
        kinds = [pa.list_(pa.string()), pa.list_(pa.string()), pa.int64()]
        for batch in batches:
            found = [vocabulary.hits((u or "").lower()) for u in batch.column(1).to_pylist()]
            columns = [pa.array([f[i] for f in found], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], names)

    rows = pages.select(F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).alias("url"))
    schema = "page_id bigint, url string, strict_terms array<string>, soft_terms array<string>, soft_weight bigint"
    return rows.mapInArrow(scan, schema)


def url_verdicts(
    pages: DataFrame,
    rules: list[tuple[str, str]] = RULES,
    strict: list[str] = STRICT,
    soft: dict[str, int] = SOFT,
    limit: int = SOFT_LIMIT,
    id_col: str = "page_id",
    url_col: str = "url",
) -> DataFrame:
    """Per row: page_id, host, path, rule, verdict, and the terms behind the method's part.

    The longest fitting rule decides; without one, a URL with a strict term or
    with soft terms of weight ``limit`` together is blocked and any other allowed
    (also a null, empty or relative one, whose host and path are empty). A null id
    stays null; repeated rows are judged each; other columns are left behind; an empty
    table gives no rows. A URL of any length is read whole.
    """
    terms = url_terms(pages, strict, soft, id_col, url_col)
    judged = terms.withColumns({"host": url_host(F.col("url")), "path": url_path(F.col("url"))})
    judged = judged.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    by_rule = F.lit(None).cast("string")
    for verdict, rule in rules:
        by_rule = F.when(F.col("rule") == rule, F.lit(verdict)).otherwise(by_rule)
    bad = (F.size("strict_terms") > 0) | (F.col("soft_weight") >= limit)
    by_terms = F.when(bad, F.lit("block")).otherwise(F.lit("allow"))
    return judged.select(
        "page_id", "host", "path", "rule", F.coalesce(by_rule, by_terms).alias("verdict"), "strict_terms", "soft_terms", "soft_weight"
    )
