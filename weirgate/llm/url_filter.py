"""Operator 4: URL filters. A blocked Bloom filter passes possible hits to an exact hash join.

Everything here is a DataFrame expression; no Python runs on the executors.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirgate.llm.common import UPPER, free_name, lower_ascii, table

# (verdict, rule): host before the first slash, path from it on.
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))

# The query's list: every URL below a host with this label.
LISTED_LABEL = "ads-track"

WORDS = 4


def url_parts(url: Column) -> tuple[Column, Column, Column]:
    """Host, path and query string of a URL; all empty for null or without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = lower_ascii(F.regexp_extract(rest, r"^[^/?#]*", 0))
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.regexp_extract(rest, r"^[^?#]*\?([^#]*)", 1)


def canonical_url(url: Column) -> Column:
    """Host, path without final slashes, query without ``utm_`` parameters; no scheme, no fragment."""
    host, path, query = url_parts(url)
    kept = F.regexp_replace(F.regexp_replace(query, r"(^|&)utm_[^&]*", ""), r"^&+", "")
    return F.concat(host, F.regexp_replace(path, r"/+$", ""), F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise(""))


def _slots(url: Column, blocks: int) -> list[Column]:
    """The block of a canonical URL, and one bit for each word of that block."""
    block = F.pmod(F.xxhash64(url), F.lit(blocks)).alias("block")
    bits = F.xxhash64(url, F.lit("bits"))
    return [block, *(_bit(bits, i).alias(f"b{i}") for i in range(WORDS))]


def _bit(bits: Column, i: int) -> Column:
    place = F.shiftrightunsigned(bits, 6 * i).bitwiseAND(F.lit(63)).cast("int")
    return F.call_function("shiftleft", F.lit(1).cast("long"), place)


def bloom_filter(listed: DataFrame, blocks: int) -> DataFrame:
    """``(block, w0..w3)`` for ``listed(canonical)``: at most ``blocks`` rows of 40 bytes, whatever the list.

    A longer list sets more bits, which lets more URLs through to the exact join; it never
    loses one.
    """
    slots = listed.select(*_slots(F.col("canonical"), blocks))
    return slots.groupBy("block").agg(*[F.bit_or(f"b{i}").alias(f"w{i}") for i in range(WORDS)])


def marked(rows: DataFrame, key: Column, listed: DataFrame, entries: int, name: str, most: int = 1 << 18) -> DataFrame:
    """``rows`` with ``name``: whether ``key`` may be among the ``entries`` values of the one column of ``listed``.

    It is true for all values that are and for few others. An entry has 16 bits of the filter
    or more; beyond ``most`` blocks the filter grows no more, and more of the others pass.
    """
    blocks = min(most, 1 << max(0, -(-entries // 16) - 1).bit_length())
    filled = bloom_filter(listed.select(F.col(listed.columns[0]).alias("canonical")), blocks)
    there, slots = free_name(rows, "there"), free_name(rows, "slots")
    probed = rows.withColumn(slots, F.struct(*_slots(key, blocks)))
    probed = probed.join(F.broadcast(filled.select(F.struct(*filled.columns).alias(there))), F.col(slots)["block"] == F.col(there)["block"], "left")
    hit = F.lit(True)
    for i in range(WORDS):
        hit = hit & (F.col(there)[f"w{i}"].bitwiseAND(F.col(slots)[f"b{i}"]) != 0)
    return probed.select(*rows.columns, F.coalesce(hit, F.lit(False)).alias(name))


def longest_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """The longest fitting rule as a struct ``(n, verdict, rule)``, or null.

    A rule fits its host and all subdomains if the path starts with the rule's path. Among
    equally long rules a block wins, then the larger rule text.
    """
    fits = []
    for verdict, rule in rules:
        at = rule.index("/")
        own, start = rule[:at].translate(str.maketrans(UPPER, UPPER.lower())), rule[at:]
        fit = ((host == own) | F.endswith(host, F.lit(f".{own}"))) & F.startswith(path, F.lit(start))
        fits.append(
            F.when(fit, F.struct(F.lit(len(rule)).alias("n"), F.lit(verdict).alias("verdict"), F.lit(rule).alias("rule")))
        )
    return F.array_max(F.array(*fits)) if fits else F.lit(None).cast("struct<n:int,verdict:string,rule:string>")


def judge_urls(
    pages: DataFrame,
    listed: DataFrame,
    rules: Sequence[tuple[str, str]] = RULES,
    id_col: str = "page_id",
    url_col: str = "url",
    listed_col: str = "url",
    blocks: int = 1 << 15,
) -> DataFrame:
    """One row ``(page_id, host, path, rule, verdict, listed)`` per input row.

    The verdict is that of the longest fitting rule; without one, ``block`` if the canonical
    URL is in ``listed``, else ``allow``. ``rules`` is a short literal list. Only the columns
    named are read, so others may clash with ours.

    Nulls: a null URL, or one without ``://``, has an empty host and path and is allowed; a
    null id is kept. Null, empty and hostless entries of the list are ignored. Repeated rows
    are judged each; repeated list entries count once. Empty tables give an empty result, or
    no listed URL.

    The filter has a fixed size (``blocks`` rows), so it may be broadcast. URLs without a hit
    never reach the shuffle; hits meet the distinct list in a hash join whose large left
    partitions adaptive execution can split.
    """
    host, path, _ = url_parts(F.col("url"))
    base = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"))
    base = base.select("page_id", host.alias("host"), path.alias("path"), canonical_url(F.col("url")).alias("canonical"))
    wanted = listed.select(canonical_url(F.col(listed_col)).alias("canonical")).where("canonical != ''").distinct()

    probed = base.select("*", *_slots(F.col("canonical"), blocks)).join(F.broadcast(bloom_filter(wanted, blocks)), "block", "left")
    hit = F.lit(True)
    for i in range(WORDS):
        hit = hit & (F.col(f"w{i}").bitwiseAND(F.col(f"b{i}")) != 0)
    probed = probed.select("page_id", "host", "path", "canonical", F.coalesce(hit, F.lit(False)).alias("hit"))
    missed = probed.where(~F.col("hit")).select("page_id", "host", "path", F.lit(False).alias("listed"))
    exact = wanted.select("canonical", F.lit(True).alias("on_list")).hint("shuffle_hash")
    possible = probed.where("hit").join(exact, "canonical", "left")
    found = possible.select("page_id", "host", "path", F.coalesce("on_list", F.lit(False)).alias("listed"))

    rule = longest_rule(F.col("host"), F.col("path"), rules)
    judged = missed.unionByName(found).withColumn("_r", rule)
    own = F.when(F.col("listed"), "block").otherwise("allow")
    return judged.select("page_id", "host", "path", F.col("_r.rule").alias("rule"), F.coalesce("_r.verdict", own).alias("verdict"), "listed")


def query(spark, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    host, _, _ = url_parts(F.col("url"))
    listed = pages.where(F.concat(F.lit("."), host).contains(f".{LISTED_LABEL}.")).select("url")
    return judge_urls(pages, listed)


SQL = """
WITH rest AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
  SELECT page_id,
    translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
    regexp_replace(regexp_replace(regexp_extract(rest, '^[^?#]*\\?([^#]*)', 1), '(^|&)utm_[^&]*', '', 'g'), '^&+', '') AS kept
  FROM (SELECT page_id, coalesce(rest, '') AS rest FROM rest)
), keyed AS (
  SELECT *, host || regexp_replace(path, '/+$', '') || CASE WHEN kept <> '' THEN '?' || kept ELSE '' END AS canonical FROM parts
), listed AS (
  SELECT DISTINCT canonical FROM keyed WHERE contains('.' || host, '.ads-track.') AND canonical <> ''
), rules(verdict, rule, rhost, rpath) AS (
  VALUES ('block', 'net/', 'net', '/'), ('allow', 'example.net/en/', 'example.net', '/en/'),
         ('block', 'example.com/de/', 'example.com', '/de/'), ('allow', 'org/fr/', 'org', '/fr/')
), judged AS (
  SELECT k.page_id, k.host, k.path, k.canonical IN (SELECT canonical FROM listed) AS listed, r.rule, r.verdict,
    row_number() OVER (PARTITION BY k.page_id ORDER BY length(r.rule) DESC NULLS LAST) AS place
  FROM keyed k LEFT JOIN rules r ON (k.host = r.rhost OR ends_with(k.host, '.' || r.rhost)) AND starts_with(k.path, r.rpath)
)
SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN listed THEN 'block' ELSE 'allow' END) AS verdict, listed
FROM judged WHERE place = 1
"""
