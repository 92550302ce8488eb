"""URL verdicts: rules on host and path, then a long list of addresses behind a blocked Bloom filter.

Everything is DataFrame expressions. The list is turned into a table of 256-bit blocks, one row per
block; an address sets eight bits of one block. Rows whose block lacks a bit are not listed, for
certain. The few that may be listed meet the list in an exact hash join, which removes false hits.
"""

from __future__ import annotations

import math
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scoreloom.llm.common import ascii_lower
from scoreloom.session import materialize

WORDS = 4
BITS_PER_KEY = 16
BLOCK_BYTES = 8 * (WORDS + 1)
#: A filter up to this size is broadcast; a larger one is joined by block number.
BROADCAST_BYTES = 8 << 20


def _rest(url: Column) -> Column:
    """What follows the first ``://``; null without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def host_of(url: Column) -> Column:
    """Up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; empty for null or no ``://``."""
    return F.coalesce(ascii_lower(F.regexp_extract(_rest(url), "^[^/?#]*", 0)), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(host: Column, path: Column) -> Column:
    """The address that is listed: host and path without closing slashes; null without a host."""
    return F.when(host != "", F.concat(host, F.regexp_replace(path, "/+$", "")))


def _masks(address: str) -> list[Column]:
    """Per word of a block, two bits drawn from a second hash."""
    drawn = f"xxhash64({address}, 1)"
    bit = "shiftleft(1L, cast(shiftright({h}, {n}) & 63 as int))"
    return [
        F.expr(f"{bit.format(h=drawn, n=12 * w)} | {bit.format(h=drawn, n=12 * w + 6)}") for w in range(WORDS)
    ]


def build_filter(listed: DataFrame, blocks: int) -> DataFrame:
    """``listed`` (address) as rows ``(block, w0, w1, w2, w3)``; combined on the map side."""
    bits = listed.select(
        F.expr(f"pmod(xxhash64(address), {blocks}L)").alias("block"),
        *[m.alias(f"m{w}") for w, m in enumerate(_masks("address"))],
    )
    return bits.groupBy("block").agg(*[F.bit_or(f"m{w}").alias(f"w{w}") for w in range(WORDS)])


def may_hold(rows: DataFrame, bloom: DataFrame, blocks: int, broadcast: bool) -> DataFrame:
    """``rows`` (with ``address``) plus ``maybe``: false only where the address is not listed."""
    probe = rows.withColumn("block", F.expr(f"pmod(xxhash64(address), {blocks}L)"))
    joined = probe.join(F.broadcast(bloom) if broadcast else bloom, "block", "left")
    hit = F.lit(True)
    for w, mask in enumerate(_masks("address")):
        hit = hit & (F.col(f"w{w}").bitwiseAND(mask) == mask)
    return joined.select(*rows.columns, F.coalesce(hit & F.col("address").isNotNull(), F.lit(False)).alias("maybe"))


def rule_columns(rules: Iterable[tuple[str, str, str]], host: Column, path: Column) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict; null where none does.

    A rule ``(verdict, host, path)`` fits its host and every subdomain where the path starts with
    its path. Two rules for one host and path are refused.
    """
    rules = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1], r[2]))
    if len({r[1:] for r in rules}) < len(rules):
        raise ValueError("two rules for one host and path")
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, rule_host, rule_path in reversed(rules):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        name, verdict = F.when(fits, rule_host + rule_path).otherwise(name), F.when(fits, kind).otherwise(verdict)
    return name, verdict


def judge(
    pages: DataFrame, listed: DataFrame, rules: Iterable[tuple[str, str, str]], key: str = "page_id", url: str = "url"
) -> DataFrame:
    """One row per row of ``pages``: key, host, path, rule, verdict, listed.

    ``listed`` holds canonical addresses in its first column. The verdict is that of the longest
    rule; without a rule an address that is listed is blocked and any other allowed.

    Null urls and urls without ``://`` have an empty host and path, match no rule and are allowed.
    Repeated rows stay repeated, nulls and repeats in the list count for nothing, an empty list
    blocks nothing, and further columns of the input are not looked at.
    """
    addresses = listed.select(F.col(listed.columns[0]).cast("string").alias("address"))
    addresses = materialize(addresses.where(F.col("address").isNotNull()).distinct(), "listed")
    blocks = max(1, math.ceil(addresses.count() * BITS_PER_KEY / (64 * WORDS)))
    bloom = build_filter(addresses, blocks)
    rows = pages.select(F.col(key), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    name, verdict = rule_columns(rules, F.col("host"), F.col("path"))
    rows = rows.select(
        "*", name.alias("rule"), verdict.alias("ruled"), canonical(F.col("host"), F.col("path")).alias("address")
    )
    probed = may_hold(rows, bloom, blocks, blocks * BLOCK_BYTES <= BROADCAST_BYTES)
    clear = probed.where(~F.col("maybe")).withColumn("listed", F.lit(False))
    hits = probed.where("maybe").join(addresses.withColumn("found", F.lit(True)), "address", "left")
    hits = hits.withColumn("listed", F.col("found").isNotNull())
    out = [key, "host", "path", "rule", "ruled", "listed"]
    both = clear.select(out).unionByName(hits.select(out))
    verdict = F.coalesce("ruled", F.when(F.col("listed"), "block").otherwise("allow"))
    return both.select(key, "host", "path", "rule", verdict.alias("verdict"), "listed")
