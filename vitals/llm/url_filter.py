"""URL filter: host and path rules first, then a list of canonical URLs behind a blocked Bloom filter.

A rule names a host and the beginning of a path, and fits urls of that host and its subdomains; the
longest fitting rule decides. A url without a rule is blocked if its canonical form is listed. The list
is hashed into a Bloom filter of 64-bit blocks, one row per block and at most ``MAX_BLOCKS`` rows, which
is broadcast. Urls it passes as possible hits meet the list in an exact hash join, which removes the
false positives; all others never leave their task. A list too long for the filter only makes it pass
more to the exact join.

Null urls and urls without ``://`` have an empty host and path, fit no rule and are never listed. A url
without a path fits no rule, as rules name paths that begin with ``/``. Repeated rows get equal results;
listed urls may repeat; an empty table gives an empty result, an empty list blocks nothing. Rules of equal
length cannot fit one url with different texts, so there are no ties. Only key and url are read.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

#: Bounds the broadcast filter to 2 MB.
MAX_BLOCKS = 1 << 17
_BITS_PER_URL = 16
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Rule(NamedTuple):
    host: str
    path: str
    verdict: str


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, _URL, 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def canonical(url: Column) -> Column:
    """Host and path without scheme, ``www.``, default port, index page and last slash, and the query without
    tracking parameters; null for what is no url."""
    host = F.regexp_replace(host_of(url), r"^www\.|:(?:80|443)$", "")
    path = F.regexp_replace(path_of(url), r"(?:/index\.html?)?/*$", "")
    query = F.regexp_extract(url, r"^[^#?]*\?([^#]*)", 1)
    kept = F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(r"^(?:utm_[a-z]+|ref|fbclid|gclid)="))
    whole = F.concat(host, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(F.array_sort(kept), "&"))).otherwise(""))
    return F.when(host != "", whole)


def _block(url: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(url), F.lit(blocks)).cast("int")


def _mask(hash64: Column) -> Column:
    """Four bits of a block, chosen by parts of the hash that do not choose the block."""
    one = F.lit(1).cast("bigint")
    bits = [F.call_function("shiftleft", one, F.shiftrightunsigned(hash64, 20 + 6 * k).bitwiseAND(63).cast("int")) for k in range(4)]
    return bits[0].bitwiseOR(bits[1]).bitwiseOR(bits[2]).bitwiseOR(bits[3])


def bloom_filter(listed: DataFrame, blocks: int) -> DataFrame:
    """(block, bits) of the distinct urls in column ``canonical``."""
    return (
        listed.select(_block(F.col("canonical"), blocks).alias("block"), _mask(F.xxhash64("canonical")).alias("mask"))
        .groupBy("block")
        .agg(F.bit_or("mask").alias("bits"))
    )


def fitting_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest rule that fits, as a struct (length, rule, verdict), or null."""
    fits = [
        F.when(
            ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path),
            F.struct(
                F.lit(len(r.host + r.path)).alias("length"),
                F.lit(r.host + r.path).alias("rule"),
                F.lit(r.verdict).alias("verdict"),
            ),
        )
        for r in rules
    ]
    return F.greatest(*fits) if len(fits) > 1 else fits[0]


def judge(pages: DataFrame, listed: DataFrame, rules: Sequence[Rule], key: str = "page_id", url: str = "url") -> DataFrame:
    """Per page: key, host, path, rule, listed, verdict. ``listed`` has urls in its column ``url``."""
    wanted = stored(
        listed.select(canonical(F.col("url")).alias("canonical")).filter("canonical IS NOT NULL").distinct(), "listed-urls"
    )
    needed = max(1, wanted.count() * _BITS_PER_URL // 64)
    blocks = min(MAX_BLOCKS, 1 << (needed - 1).bit_length())
    filter_rows = stored(bloom_filter(wanted, blocks), "bloom-filter")
    rows = pages.select(F.col(key).alias("id"), F.col(url).alias("url")).select(
        "id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"),
        canonical(F.col("url")).alias("canonical"),
    )
    probed = (
        rows.withColumn("block", _block(F.col("canonical"), blocks))
        .withColumn("mask", _mask(F.xxhash64("canonical")))
        .join(F.broadcast(filter_rows), "block", "left")
        .withColumn("possible", F.col("canonical").isNotNull() & F.coalesce(F.col("bits").bitwiseAND(F.col("mask")) == F.col("mask"), F.lit(False)))
        .select("id", "host", "path", "canonical", "possible")
    )
    hits = probed.filter("possible").join(wanted.withColumn("listed", F.lit(True)), "canonical", "left").select(
        "id", "host", "path", F.coalesce("listed", F.lit(False)).alias("listed")
    )
    misses = probed.filter("NOT possible").select("id", "host", "path", F.lit(False).alias("listed"))
    ruled = hits.unionByName(misses).withColumn("fit", fitting_rule(F.col("host"), F.col("path"), rules))
    return ruled.select(
        F.col("id").alias(key), "host", "path", F.col("fit.rule").alias("rule"), "listed",
        F.coalesce(F.col("fit.verdict"), F.when(F.col("listed"), "block").otherwise("allow")).alias("verdict"),
    )
