"""URL filter: rules by host and path, and a block list behind a blocked Bloom filter.

DataFrame functions only. The filter holds the listed canonical URLs in blocks of eight 32-bit
words; a URL's block comes from its hash and it sets one bit in each word. Its size has a fixed
bound, so it can be sent to every task. URLs that hit all eight bits go on to a join with
the list itself, which removes the false positives.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import apart

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORDS = 8
#: Blocks per filter: bits for each listed URL, and at most 2^17 blocks (32 bytes each, 4 MB of bits).
BITS_PER_URL = 12
MAX_BLOCKS = 1 << 17
#: Odd multipliers that spread one hash over the words of a block.
_SALTS = [0x47B7, 0x4497, 0x8825, 0xA2B7, 0x7055, 0x2DF1, 0x9EFD, 0x5C6B]

#: Rules as (verdict, host, path).
RULES = [
    ("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"), ("block", "com", "/de/"),
]


def _rest(url: Column) -> Column:
    """What follows the first `://`; empty without it."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z in lower case; empty without `://`."""
    return F.translate(F.regexp_extract(_rest(url), r"^([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host, up to `?`, `#` or the end."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def canonical(url: Column) -> Column:
    """Host and path without scheme, a leading `www.` or `m.`, query, fragment, `.html` and closing slashes.

    Null where there is no `://`.
    """
    host = F.regexp_replace(host_of(url), r"^(www|m)\.", "")
    path = F.regexp_replace(F.regexp_replace(path_of(url), r"\.html$", ""), r"/+$", "")
    return F.when(F.instr(url, "://") > 0, F.concat(host, path))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]] = RULES) -> Column:
    """struct(rule, verdict) of the longest rule that fits the host or a domain above it and the
    start of the path; null if none does. Of equally long rules the longer host wins."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, h, p in sorted(rules, key=lambda r: (len(r[1]) + len(r[2]), len(r[1]))):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        found = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def _block(url: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(url), F.lit(blocks))


def _bits(url: Column) -> list[Column]:
    """For each word of a block, the bit of this URL."""
    h = F.hash(url).cast("bigint").bitwiseAND(F.lit(0xFFFFFFFF))
    place = [F.shiftright((h * salt).bitwiseAND(F.lit(0xFFFFFFFF)), 27).cast("int") for salt in _SALTS]
    return [F.call_function("shiftleft", F.lit(1).cast("bigint"), p) for p in place]


def build_filter(listed: DataFrame, url: str = "url") -> tuple[DataFrame, int]:
    """The blocked Bloom filter of a column of canonical URLs: (block, w0 .. w7) and its number of
    blocks, which follows the number of URLs up to `MAX_BLOCKS`. Beyond that the filter passes
    more false positives, and stays right."""
    keys = listed.select(F.col(url).alias("_u")).where("_u IS NOT NULL")
    count = keys.agg(F.approx_count_distinct("_u")).first()[0]
    blocks = 1
    while blocks < MAX_BLOCKS and blocks * 32 * WORDS < count * BITS_PER_URL:
        blocks *= 2
    bits = {f"w{k}": b for k, b in enumerate(_bits(F.col("_u")))}
    words = keys.withColumn("block", _block(F.col("_u"), blocks)).withColumns(bits)
    return words.groupBy("block").agg(*(F.bit_or(c).alias(c) for c in bits)), blocks


@apart
def judge(pages: DataFrame, listed: DataFrame, url: str = "url", listed_url: str = "url",
          rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    """All rows of `pages` with host, path, rule, canonical, listed and verdict.

    verdict is the rule's; without a rule a listed canonical URL is blocked and any other allowed.
    `listed` is a table of URLs in any form. Rows are neither lost nor added: null or malformed
    URLs have an empty host and path, fit no rule, are not listed and are allowed; repeated rows
    stay; an empty list blocks nothing. Columns of `pages` named like a result are replaced.
    """
    names = listed.select(canonical(F.col(listed_url)).alias("_listed")).where("_listed IS NOT NULL").distinct()
    bloom, blocks = build_filter(names, "_listed")
    bits = _bits(F.col("_canonical"))
    hit = F.lit(True)
    for k, b in enumerate(bits):
        hit = hit & (F.col(f"_w{k}").bitwiseAND(b) != 0)
    bloom = bloom.select(F.col("block").alias("_block"), *(F.col(f"w{k}").alias(f"_w{k}") for k in range(WORDS)))
    u = F.col(url)
    out = pages.withColumns({"_canonical": canonical(u), "_h": host_of(u), "_p": path_of(u)})
    out = out.join(F.broadcast(bloom), _block(F.col("_canonical"), blocks) == F.col("_block"), "left")
    # Only possible hits carry a key into the exact join; the others match nothing.
    out = out.withColumn("_key", F.when(F.coalesce(hit, F.lit(False)), F.col("_canonical")))
    out = out.drop("_block", *(f"_w{k}" for k in range(WORDS)))
    misses = out.where("_key IS NULL").withColumn("_listed", F.lit(None).cast("string"))
    hits = out.where("_key IS NOT NULL").join(names, F.col("_key") == F.col("_listed"), "left")
    out = misses.unionByName(hits).withColumn("_rule", rule_of(F.col("_h"), F.col("_p"), rules))
    return out.withColumns({
        "host": F.col("_h"), "path": F.col("_p"), "canonical": F.col("_canonical"), "rule": F.col("_rule.rule"),
        "listed": F.col("_listed").isNotNull(),
        "verdict": F.coalesce(F.col("_rule.verdict"), F.when(F.col("_listed").isNotNull(), "block").otherwise("allow")),
    }).drop("_canonical", "_h", "_p", "_key", "_listed", "_rule")
