"""URL filter: rules, then a blocked Bloom filter over listed canonical URLs with an exact join behind it.

The Bloom filter is a table of blocks of eight 32-bit words, built by one aggregation over the
list: the first hash of a canonical URL picks its block, the second sets one bit in each word. It
is broadcast while it has at most ``broadcast_blocks`` blocks and joined by block number beyond.
Only possible hits go on to the exact join on the canonical URL, which removes false positives.

Canonical: white space trimmed; scheme, user, a leading ``www.``, default port, fragment, trailing
slashes and tracking parameters (``utm_*``, ``ref``, ``gclid``, ``fbclid``) dropped; host in lower case; the other
parameters sorted.

Defined cases: NULL and URLs without ``://`` have empty host and path, no rule and no listing, so
they are allowed; an empty list blocks nothing; an empty table gives no rows; URLs of any length are judged whole; of rules
that fit, the longest wins, of equally long ones the one that sorts first; repeated URLs are each judged. Input columns named
like an output are replaced.
"""

from __future__ import annotations

from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from traceframe.llm.common import ascii_lower, column, without

WORDS = 8
URLS_PER_BLOCK = 16  # 256 bits a block: 16 bits a URL
BROADCAST_BLOCKS = 1 << 20
TRACKING = r"^(utm_[^=]*|ref|gclid|fbclid)(=|$)"
SEEDS = (31, 37)
OUTPUTS = ("host", "path", "rule", "listed", "verdict")


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """Between ``://`` and the next ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(url: Column) -> Column:
    """One spelling of a URL; NULL without ``://``."""
    given = F.trim(url)
    host = F.regexp_replace(F.regexp_replace(host_of(given), r"^[^@]*@", ""), r":(80|443)?$", "")
    host = F.regexp_replace(host, r"^www\.", "")
    path = F.regexp_replace(path_of(given), r"/+$", "")
    asked = F.split(F.regexp_extract(given, r"(?s)^[^?#]*\?([^#]*)", 1), "&")
    kept = F.array_sort(F.filter(asked, lambda x: (x != "") & ~x.rlike(TRACKING)))
    query = F.array_join(kept, "&")
    whole = F.concat(host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))
    return F.when(given.contains("://"), whole)


def best_rule(host: Column, path: Column, rules: Iterable[Rule]) -> Column:
    """The longest rule that fits, as struct (rule, verdict); NULL if none does."""
    found: Column | None = None
    for r in sorted(rules, key=lambda r: (-len(r.name), r.name)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        value = F.struct(F.lit(r.name).alias("rule"), F.lit(r.verdict).alias("verdict"))
        found = F.when(fits, value) if found is None else found.when(fits, value)
    return found if found is not None else F.lit(None).cast("struct<rule:string,verdict:string>")


def block_of(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(SEEDS[0])), F.lit(blocks))


def bit_of(key: Column, word: int) -> Column:
    """The one bit that a URL sets in a word: five bits of its second hash."""
    at = F.shiftright(F.xxhash64(key, F.lit(SEEDS[1])), word * 5).bitwiseAND(31)
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), at.cast("int"))


def bloom(keys: DataFrame, key: str, blocks: int) -> DataFrame:
    """Blocks of the filter: ``block`` and ``words``."""
    words = [F.bit_or(bit_of(F.col(key), w)).alias(f"w{w}") for w in range(WORDS)]
    return keys.groupBy(block_of(F.col(key), blocks).alias("block")).agg(*words)


def judge(
    pages: DataFrame,
    listed: DataFrame,
    rules: Iterable[Rule] = (),
    *,
    url_col: str = "url",
    listed_col: str = "url",
    broadcast_blocks: int = BROADCAST_BLOCKS,
) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule``, ``listed`` and ``verdict``."""
    keys = listed.select(canonical(column(listed, listed_col).cast("string")).alias("__key"))
    keys = keys.where("__key IS NOT NULL").distinct()
    blocks = max(1, -(-keys.count() // URLS_PER_BLOCK))
    table = bloom(keys, "__key", blocks).withColumnRenamed("block", "__block")
    if blocks <= broadcast_blocks:
        table = F.broadcast(table)
    base = without(pages, OUTPUTS)
    kept = base.columns
    url = column(pages, url_col).cast("string")
    made = base.select(
        *[column(base, c) for c in kept], host_of(url).alias("host"), path_of(url).alias("path"),
        canonical(url).alias("__url"),
    )
    made = made.withColumn("__at", block_of(F.coalesce("__url", F.lit("")), blocks))
    probed = made.join(table, F.col("__at") == F.col("__block"), "left")
    hit = F.col("__url").isNotNull()
    for w in range(WORDS):
        bit = bit_of(F.col("__url"), w)
        hit = hit & (F.coalesce(F.col(f"w{w}"), F.lit(0)).bitwiseAND(bit) == bit)
    columns = [*[column(probed, c) for c in kept], "host", "path", "__url"]
    probed = probed.select(*columns, F.coalesce(hit, F.lit(False)).alias("__maybe"))
    maybe = probed.where("__maybe").join(keys.withColumn("__in", F.lit(True)), F.col("__url") == F.col("__key"), "left")
    maybe = maybe.withColumn("listed", F.coalesce("__in", F.lit(False))).drop("__key", "__in")
    out = probed.where(~F.col("__maybe")).withColumn("listed", F.lit(False)).unionByName(maybe)
    rule = best_rule(F.col("host"), F.col("path"), rules)
    out = out.withColumn("__rule", rule)
    verdict = F.coalesce(F.col("__rule.verdict"), F.when(F.col("listed"), "block").otherwise("allow"))
    return out.select(
        *[column(out, c) for c in kept], "host", "path", F.col("__rule.rule").alias("rule"), "listed",
        verdict.alias("verdict"),
    )
