"""URL filter: host/path rules, then a list of blocked canonical URLs.

Listed URLs are looked up in two steps. A blocked Bloom filter (256-bit blocks
of four longs; a URL sets two bits in each long of one block) lets through the
possible hits, and an exact equi-join of these few rows with the list removes
the false positives. The filter is a table of one row per non-empty block,
built by one map-side combined ``bit_or`` aggregate. It is broadcast while its
known size (40 bytes for each block) stays under ``broadcast_bytes`` and joined on
the block number otherwise, so a list of any size works. Only DataFrame functions are
used.

A page is judged by the longest fitting rule, else by the list: block if its
canonical URL is listed, else allow.

Canonical URL: host in lower case without ``www.``, a default port or a final
dot; path without a final ``/`` or index page; query without tracking
parameters; no scheme, no fragment.

Defined cases: a null URL or one without ``://`` has an empty host and path, no rule and no
canonical URL, and is allowed; null ids stay null; repeated URLs are judged
row by row (the list is made distinct first); other columns are ignored; empty
tables give empty results, an empty list blocks nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import quoted, stored, table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BITS_PER_URL = 16
BLOCK_BITS = 256
BLOCK_BYTES = 40
BROADCAST_BYTES = 32 << 20
WORDS = 4

# The rules of the contract.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"),
         ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
# Host labels whose pages make up the list of the registered query.
LISTED_LABELS = "ads|adult|bets|casino|malware|phish|pills|poker|porn|spam|viagra|warez|xxx"


def after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.lit(2147483647))).otherwise(F.lit(None))


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(after_scheme(url), r"^([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(after_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(url: Column) -> Column:
    """Canonical form; null where the URL has no scheme or no host."""
    rest = after_scheme(url)
    host = F.regexp_replace(F.regexp_replace(host_of(url), r"(:80|:443)?$", ""), r"\.$", "")
    host = F.regexp_replace(host, r"^www\.", "")
    path = F.regexp_replace(F.regexp_replace(path_of(url), r"/index\.(html?|php)$", "/"), r"/+$", "")
    query = F.regexp_extract(rest, r"^[^?#]*\?([^#]*)", 1)
    query = F.regexp_replace(query, r"(^|&)(utm_[a-z]+|ref|fbclid|gclid)=[^&]*", "")
    query = F.regexp_replace(query, r"^&+", "")
    return F.when(host != "", F.concat(host, path, F.when(query != "", F.concat(F.lit("?"), query))
                                       .otherwise(F.lit(""))))


def masks(url: Column) -> list[Column]:
    """The bits of a URL: one mask for each long of its block."""
    h = F.xxhash64(url, F.lit(1))

    def bit(i: int) -> Column:
        return F.call_function("shiftleft", F.lit(1).cast("long"),
                               F.shiftright(h, 6 * i).bitwiseAND(F.lit(63)).cast("int"))

    return [bit(j).bitwiseOR(bit(j + WORDS)) for j in range(WORDS)]


def bloom(listed: DataFrame, blocks: int) -> DataFrame:
    """The filter over the column ``canon``: (block, w0..w3)."""
    parts = listed.select(F.pmod(F.xxhash64("canon"), F.lit(blocks)).alias("block"),
                          *(m.alias(f"w{j}") for j, m in enumerate(masks(F.col("canon")))))
    return parts.groupBy("block").agg(*(F.bit_or(f"w{j}").alias(f"w{j}") for j in range(WORDS)))


def possible_hits(urls: DataFrame, listed: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``urls`` (with ``canon``) plus boolean ``maybe`` from the Bloom filter."""
    n = listed.count()
    blocks = max(1, -(-n * BITS_PER_URL // BLOCK_BITS))
    filter_rows = bloom(listed, blocks)
    if blocks * BLOCK_BYTES <= broadcast_bytes:
        filter_rows = F.broadcast(filter_rows)
    # rows without a canonical URL meet no block; their ids spread them, so that they are no hot key
    key = F.coalesce("canon", F.concat(F.lit("://"), F.col("id").cast("string")), F.lit(""))
    wanted = urls.withColumn("block", F.pmod(F.xxhash64(key), F.lit(blocks)))
    hit = F.lit(True)
    for j, m in enumerate(masks(F.col("canon"))):
        hit = hit & (F.col(f"w{j}").bitwiseAND(m) == m)
    return (wanted.join(filter_rows, "block", "left")
            .withColumn("maybe", F.col("canon").isNotNull() & F.coalesce(hit, F.lit(False)))
            .drop("block", *(f"w{j}" for j in range(WORDS))))


def filter_urls(pages: DataFrame, listed: DataFrame, rules: Sequence[tuple[str, str, str]] = (),
                id_col: str = "page_id", url_col: str = "url", listed_col: str = "url",
                broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """(id, host, path, rule, verdict, listed) for every row of ``pages``."""
    url = quoted(url_col)
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, host, path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = (((F.col("host") == host) | F.col("host").endswith("." + host))
                & F.col("path").startswith(path))
        rule = F.when(fits, host + path).otherwise(rule)
        verdict = F.when(fits, kind).otherwise(verdict)
    urls = (pages.select(quoted(id_col).alias("id"), host_of(url).alias("host"), path_of(url).alias("path"),
                         canonical(url).alias("canon"))
            .withColumn("rule", rule).withColumn("ruled", verdict))
    block = stored(listed.select(canonical(quoted(listed_col)).alias("canon")).filter("canon is not null").distinct(),
                   "listed-urls")
    tested = possible_hits(urls, block, broadcast_bytes)
    sure = block.withColumn("listed", F.lit(True))
    hits = tested.filter("maybe").join(sure, "canon", "left")
    rest = tested.filter("not maybe").withColumn("listed", F.lit(False))
    return (hits.unionByName(rest)
            .withColumn("listed", F.coalesce("listed", F.lit(False)))
            .select(F.col("id").alias(id_col), "host", "path", "rule",
                    F.coalesce("ruled", F.when(F.col("listed"), "block").otherwise("allow")).alias("verdict"),
                    "listed"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The list: canonical URLs of all pages on hosts with a listed label."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    listed = pages.filter(host_of(F.col("url")).rlike(rf"(^|[.-])({LISTED_LABELS})([.-]|$)"))
    return filter_urls(pages, listed, RULES)


_CANON = """
  CASE WHEN chost <> '' THEN chost || cpath ||
    CASE WHEN q <> '' THEN '?' || q ELSE '' END END"""
SQL = f"""
WITH rest AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, position('://' IN url) + 3) END AS r
  FROM pages),
parts AS (
  SELECT page_id, r,
    coalesce(translate(regexp_extract(r, '^([^/?#]*)', 1), '{UPPER}', '{LOWER}'), '') AS host,
    coalesce(regexp_extract(r, '^[^/?#]*([^?#]*)', 1), '') AS path FROM rest),
clean AS (
  SELECT *,
    regexp_replace(regexp_replace(regexp_replace(host, '(:80|:443)?$', ''), '\\.$', ''), '^www\\.', '') AS chost,
    regexp_replace(regexp_replace(path, '/index\\.(html?|php)$', '/'), '/+$', '') AS cpath,
    coalesce(regexp_replace(regexp_replace(regexp_extract(r, '^[^?#]*\\?([^#]*)', 1),
      '(^|&)(utm_[a-z]+|ref|fbclid|gclid)=[^&]*', '', 'g'), '^&+', ''), '') AS q FROM parts),
canon AS (SELECT *, {_CANON} AS canon FROM clean),
list AS (
  SELECT DISTINCT canon FROM canon
  WHERE canon IS NOT NULL AND regexp_matches(host, '(^|[.-])({LISTED_LABELS})([.-]|$)')),
ruled AS (
  SELECT *, CASE
    WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM canon)
SELECT page_id, host, path, rule,
  CASE rule WHEN 'net/' THEN 'block' WHEN 'example.com/de/' THEN 'block'
    WHEN 'example.net/en/' THEN 'allow' WHEN 'org/fr/' THEN 'allow'
    ELSE CASE WHEN l.canon IS NOT NULL THEN 'block' ELSE 'allow' END END AS verdict,
  l.canon IS NOT NULL AS listed
FROM ruled LEFT JOIN list l ON ruled.canon = l.canon
"""

QUERIES = {"op6_url_filter": op6_url_filter}
ORACLES = {"op6_url_filter": SQL}
