"""URL filters: host and path rules, then a list of canonical URLs.

The list is tested in two steps.  A blocked Bloom filter (512-bit blocks of
eight 64-bit words, one bit in each word) holds every listed canonical URL; a
URL that misses a bit is not listed.  The few that pass go to an exact hash join
with the list, which removes the filter's false positives.  The filter is a
table of blocks built by one grouped bit-or.  It is broadcast only when the
*counted* list is small enough for that; beyond it, rows and blocks meet by a
shuffle on the block number.

Nulls and empties: a null URL, or one without ``://``, has an empty host and an
empty path, fits no rule and is never listed.  Repeated rows stay repeated.  An
empty list or table is fine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Bits of the filter for each listed URL: a false positive in some thousands.
BITS_PER_URL = 16
#: Longer lists meet the rows by a shuffle: at 16 bits each, 4 MB are broadcast at most.
BROADCAST_URLS = 2_000_000
#: So many rules become one expression; more are a table that hosts are joined with.
EXPRESSION_RULES = 500


def rest(url: Column) -> Column:
    """What follows the first ://, else null."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def host(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(rest(url), "^[^/?#]*", 0), UPPER, LOWER), F.lit(""))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(rest(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(url: Column) -> Column:
    """Host without www., path without a last slash, query without trackers; no scheme, no fragment."""
    query = F.regexp_extract(rest(url), "^[^?#]*\\?([^#]*)", 1)
    params = F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike("^(utm_[a-z]+|ref)="))
    query = F.when(F.size(params) > 0, F.concat(F.lit("?"), F.array_join(params, "&"))).otherwise("")
    whole = F.concat(F.regexp_replace(host(url), "^www\\.", ""), F.regexp_replace(path(url), "/$", ""), query)
    return F.when(F.instr(url, "://") > 0, whole)


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else nulls. A rule is (verdict, host with path)."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for says, text in sorted(rules, key=lambda r: len(r[1])):  # the last one that fits wins
        name, _, tail = text.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(f"/{tail}")
        rule = F.when(fits, F.lit(text)).otherwise(rule)
        verdict = F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def with_rules(rows: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """Adds rule, says: those of the longest rule that fits host and path.

    Beyond EXPRESSION_RULES the rules are a table: each distinct host and path
    looks up its host and all parent domains there, and rows take up the result.
    """
    if len(rules) <= EXPRESSION_RULES:
        rule, says = rule_of(F.col("host"), F.col("path"), rules)
        return rows.withColumns({"rule": rule, "says": says})
    parts = [(says, text, text.partition("/")[0], f"/{text.partition('/')[2]}") for says, text in rules]
    table = rows.sparkSession.createDataFrame(parts, "says string, rule string, rule_host string, rule_path string")
    labels = F.split("host", "\\.")
    parents = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))
    places = rows.select("host", "path").distinct()
    fits = places.withColumn("rule_host", F.explode(parents)).join(table, "rule_host").where(F.startswith("path", F.col("rule_path")))
    best = fits.groupBy("host", "path").agg(F.max_by(F.struct("rule", "says"), F.length("rule")).alias("x")).select("host", "path", "x.rule", "x.says")
    return rows.join(best, ["host", "path"], "left")


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks))


def _bits(key: Column) -> list[Column]:
    """The bit of each of the eight words that stands for key."""
    second = F.xxhash64(key, F.lit(1))
    return [F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.shiftrightunsigned(second, 6 * k), F.lit(64)).cast("int")) for k in range(8)]


def blocked_bloom(listed: DataFrame, n: int) -> tuple[DataFrame, int]:
    """(block, w0..w7) over the column url_key of listed; number of blocks."""
    blocks = 1
    while blocks * 512 < n * BITS_PER_URL:
        blocks *= 2
    bits = listed.select(_block(F.col("url_key"), blocks).alias("block"), *(b.alias(f"w{k}") for k, b in enumerate(_bits(F.col("url_key")))))
    return bits.groupBy("block").agg(*(F.bit_or(f"w{k}").alias(f"w{k}") for k in range(8))), blocks


def judge(pages: DataFrame, listed: DataFrame, rules: list[tuple[str, str]], id_column: str = "page_id", url_column: str = "url") -> DataFrame:
    """Per row: id, host, path, rule, verdict, listed. listed: a table whose column url_key has canonical URLs."""
    keys = listed.select("url_key").where(F.col("url_key").isNotNull()).distinct()
    n = keys.count()
    bloom, blocks = blocked_bloom(keys, n)
    url = F.col(url_column)
    rows = pages.select(F.col(id_column), host(url).alias("host"), path(url).alias("path"), canonical(url).alias("url_key"))
    small = n <= BROADCAST_URLS
    # without a key a row has no block: it may not meet others of its kind in one task
    block = _block(F.coalesce("url_key", F.concat_ws("\x00", "host", "path", id_column)), blocks)
    probed = rows.withColumn("block", block).join(F.broadcast(bloom) if small else bloom, "block", "left")
    hit = F.lit(True)
    for k, b in enumerate(_bits(F.col("url_key"))):
        hit = hit & (F.col(f"w{k}").bitwiseAND(b) != 0)
    columns = [id_column, "host", "path", "url_key"]
    probed = probed.withColumn("possible", F.coalesce(hit, F.lit(False)))
    exact = probed.where("possible").select(*columns).join(keys.withColumn("listed", F.lit(True)).hint("shuffle_hash"), "url_key", "left")
    out = exact.select(*columns, F.coalesce("listed", F.lit(False)).alias("listed"))
    out = with_rules(out.unionByName(probed.where("not possible").select(*columns, F.lit(False).alias("listed"))), rules)
    return out.select(id_column, "host", "path", "rule", F.coalesce("says", F.when(F.col("listed"), "block").otherwise("allow")).alias("verdict"), "listed")
