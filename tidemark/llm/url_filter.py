"""URL filters: host and path rules, then a blocked Bloom filter of listed canonical URLs before an exact hash join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import BlockedBloom, Scratch, ascii_lower

#: Fixed values: (verdict, host, path) of the production rules.
RULES = [
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
]
#: Parameters that say where a visit came from, not what the page is.
TRACKING = r"^(utm_[a-z]+|ref)="
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)(?:\?([^#]*))?.*$"


def host(url: Column) -> Column:
    """What follows the first :// up to /, ? or #, A-Z lower-cased; empty for null or without ://."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit("")))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def canonical(url: Column) -> Column:
    """Host without www., path without slashes at its end, and the sorted parameters that aren't for tracking. Null without ://."""
    kept = F.array_sort(F.filter(F.split(F.regexp_extract(url, _PARTS, 3), "&"), lambda p: (p != "") & ~p.rlike(TRACKING)))
    query = F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise("")
    whole = F.concat(F.regexp_replace(host(url), r"^www\.", ""), F.regexp_replace(path(url), "/+$", ""), query)
    return F.when(url.contains("://"), whole)


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]], value) -> Column:
    """value(verdict, rule) of the longest rule that fits the host, or one of its parents, and the start of the path; else null."""
    out = F.when(F.lit(False), F.lit(""))
    for verdict, domain, start in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2])):
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith(start)
        out = out.when(fits, F.lit(value(verdict, domain + start)))
    return out


def repeated(pages: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """A list made from the pages themselves: canonical URLs of more than one row, with the smallest id, which is spared."""
    keyed = pages.select(canonical(F.col(url_col)).alias("canonical"), F.col(id_col).alias("id")).where("canonical IS NOT NULL")
    counted = keyed.groupBy("canonical").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("spared"))
    return counted.where("n > 1").select("canonical", "spared")


def filter_urls(
    pages: DataFrame, listed: DataFrame, rules: list[tuple[str, str, str]] = RULES, id_col: str = "page_id", url_col: str = "url", bloom_blocks: int | None = None,
) -> DataFrame:
    """A row per page: id, host, path, rule, listed, verdict.

    ``listed`` has a row per canonical URL, and in ``spared`` the id (or null) of
    the page that may keep it. A page is blocked or allowed by the longest rule
    that fits; without a rule, it is blocked if its canonical URL is listed and it
    isn't spared. Only pages that pass the Bloom filter (16 bits a listed URL and
    upwards, up to 64 MB; or ``bloom_blocks`` x 8 bytes) meet the list in a hash
    join, which removes what the filter let through by chance; the others never move.

    Null URLs and URLs without :// have empty host and path, fit no rule and are
    allowed. Repeated rows are judged alike; null ids are never spared; empty
    tables give empty results or, for an empty list, no blocks but by rules.
    """
    url = F.col(url_col)
    bloom = BlockedBloom(bloom_blocks)
    keyed = pages.select(F.col(id_col).alias("id"), host(url).alias("host"), path(url).alias("path"), canonical(url).alias("canonical"))
    listed = Scratch(pages.sparkSession, "urls").write(listed, "listed")  # counted, filtered by and joined
    filled = bloom.build(listed, "canonical")
    exact = listed.select("canonical", "spared", F.lit(True).alias("listed")).hint("shuffle_hash")
    possible = bloom.may_hold(keyed, filled, "canonical").join(exact, "canonical", "left").select("id", "host", "path", F.coalesce("listed", F.lit(False)).alias("listed"), (F.coalesce(F.col("spared") == F.col("id"), F.lit(False))).alias("spared"))
    rest = bloom.may_hold(keyed, filled, "canonical", keep=False).select("id", "host", "path", F.lit(False).alias("listed"), F.lit(False).alias("spared"))
    own = F.when(F.col("listed") & ~F.col("spared"), "block").otherwise("allow")
    return possible.unionByName(rest).select(
        F.col("id").alias(id_col), "host", "path", rule_of(F.col("host"), F.col("path"), rules, lambda v, r: r).alias("rule"), "listed",
        F.coalesce(rule_of(F.col("host"), F.col("path"), rules, lambda v, r: v), own).alias("verdict"),
    )
