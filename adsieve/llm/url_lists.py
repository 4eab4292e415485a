"""URL filters: dated list entries become validity intervals, captures are judged as of their fetch.

A list entry says that a key (a host, or a registered domain) was put on or taken off the list on a
day. Entries of one key become intervals: each state holds from its day until the key's next entry.
An as-of join finds the interval that holds on the day of a capture's fetch: the same key, begun,
and not ended. A capture is blocked if its host or its domain was listed then. DataFrame functions
only.

A registered domain is the last two labels of a host, or the last three if the last two are one of
``suffixes`` (such as ``co.uk``); numeric addresses, IPv6 in brackets among them, have none. Dots at a host's end don't count.

Intervals of a key don't overlap, so a page's row never multiplies. Rows of a hot host are dealt
over ``salt`` partitions, and the list is copied as often.

Defined results: a null or unreadable URL has a null host and isn't blocked; a null fetch day isn't
blocked; entries with a null key or day are void; on one day, ``add`` beats ``remove`` and repeated
entries count once; repeated captures are judged each by itself; empty tables give empty results,
an empty list blocks nothing; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ADDRESS = r"^[0-9]+(\.[0-9]+){3}$|^\["
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?(\[[^\]/?#@]*\]|[^/?#:@\[]+)"
# Suffixes of two labels under which names are registered.
SUFFIXES = ("co.uk", "org.uk", "ac.uk", "gov.uk", "com.au", "net.au", "org.au", "co.nz", "co.jp", "ne.jp", "com.br", "com.cn", "com.vn", "edu.vn", "gov.vn", "co.in", "co.kr", "co.za")


def host_of(url: Column) -> Column:
    host = F.regexp_replace(F.lower(F.regexp_extract(url, HOST, 1)), r"\.+\z", "")
    return F.when(host != "", host)


def domain_of(host: Column, suffixes: tuple[str, ...] = ()) -> Column:
    two = F.substring_index(host, ".", -2)
    domain = F.when(two.isin(*suffixes), F.substring_index(host, ".", -3)).otherwise(two) if suffixes else two
    return F.when(~host.rlike(ADDRESS), domain)


def intervals(entries: DataFrame) -> DataFrame:
    """(kind, key, listed, valid_from, valid_to) from (kind, key, day, action); valid_to is exclusive, null if open."""
    valid = entries.where(F.col("key").isNotNull() & F.col("day").isNotNull() & F.col("action").isin("add", "remove"))
    daily = valid.groupBy("kind", "key", "day").agg(F.max(F.col("action") == "add").alias("listed"))
    ends = F.lead("day").over(Window.partitionBy("kind", "key").orderBy("day"))
    return daily.select("kind", "key", "listed", F.col("day").alias("valid_from"), ends.alias("valid_to"))


def judge(captures: DataFrame, entries: DataFrame, salt: int = 16, suffixes: tuple[str, ...] = ()) -> DataFrame:
    """(page_id, host, fetched_on, host_listed_since, domain_listed_since, blocked) of (page_id, url, fetched_on)."""
    host = host_of(F.col("url"))
    own = captures.select("page_id", "fetched_on", host.alias("host"), domain_of(host, suffixes).alias("domain"), F.pmod(F.xxhash64("page_id", "url"), F.lit(salt)).cast("int").alias("salt"))
    listed = intervals(entries).where("listed").withColumn("list_salt", F.explode(F.array(*map(F.lit, range(salt)))))
    for kind in ("host", "domain"):
        since, until = F.col(f"{kind}_listed_since"), F.col("valid_to")
        side = listed.where(F.col("kind") == kind).select("key", "list_salt", F.col("valid_from").alias(f"{kind}_listed_since"), "valid_to")
        same = (F.col(kind) == F.col("key")) & (F.col("salt") == F.col("list_salt"))
        as_of = (since <= F.col("fetched_on")) & (until.isNull() | (F.col("fetched_on") < until))
        own = own.join(side, same & as_of, "left").drop("key", "list_salt", "valid_to")
    blocked = F.col("host_listed_since").isNotNull() | F.col("domain_listed_since").isNotNull()
    return own.select("page_id", "host", "fetched_on", "host_listed_since", "domain_listed_since", blocked.alias("blocked"))


def demonstration(pages: DataFrame, suffixes: tuple[str, ...] = SUFFIXES) -> tuple[DataFrame, DataFrame]:
    """Captures and list entries for tables without dates: both follow from page ids and host names by rule."""
    captures = pages.select("page_id", "url", F.date_add(F.lit("2024-01-01").cast("date"), F.pmod(F.col("page_id"), F.lit(366)).cast("int")).alias("fetched_on"))
    host = host_of(F.col("url"))
    hosts = pages.select(host.alias("host")).where(F.col("host").isNotNull()).distinct()
    code = lambda c: F.conv(F.substring(F.md5(c), 1, 4), 16, 10).cast("int")
    first = F.lit("2024-01-01").cast("date")
    by_host = hosts.select(F.lit("host").alias("kind"), F.col("host").alias("key"), code(F.col("host")).alias("v")).where("v % 3 = 0")
    domains = hosts.select(domain_of(F.col("host"), suffixes).alias("key")).where(F.col("key").isNotNull()).distinct()
    by_domain = domains.select(F.lit("domain").alias("kind"), "key", code(F.col("key")).alias("v")).where("v % 7 < 3")
    start = F.col("v") % 200
    dated = [(F.lit(True), start, "add"), (F.col("v") % 2 == 0, start + 30 + F.col("v") % 100, "remove"), (F.col("v") % 4 == 0, start + 160, "add")]
    entries = by_host.unionByName(by_domain).select(
        "kind", "key", F.explode(F.array(*[F.when(c, F.struct(F.date_add(first, d.cast("int")).alias("day"), F.lit(a).alias("action"))) for c, d, a in dated])).alias("e")
    )
    return captures, entries.where("e IS NOT NULL").select("kind", "key", "e.day", "e.action")


ORACLE = r"""
WITH captures AS (
  SELECT page_id, DATE '2024-01-01' + (page_id % 366)::INT AS fetched_on,
         nullif(regexp_replace(lower(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9.+-]*://([^@/?#]*@)?(\[[^/?#@\]]*\]|[^\[@:/?#]+)', 2)), '[.]+$', ''), '') AS host
  FROM pages
), parts AS (SELECT *, string_split(host, '.') AS labels FROM captures),
named AS (
  SELECT page_id, fetched_on, host, CASE WHEN host LIKE '[%' OR regexp_full_match(host, '\d+([.]\d+){3}') THEN NULL
    WHEN array_to_string(labels[-2:], '.') IN ('co.uk', 'org.uk', 'ac.uk', 'gov.uk', 'com.au', 'net.au', 'org.au', 'co.nz', 'co.jp', 'ne.jp', 'com.br', 'com.cn', 'com.vn', 'edu.vn', 'gov.vn', 'co.in', 'co.kr', 'co.za')
    THEN array_to_string(labels[-3:], '.') ELSE array_to_string(labels[-2:], '.') END AS domain FROM parts
), keys AS (
  SELECT DISTINCT 'host' AS kind, host AS key FROM named WHERE host IS NOT NULL
  UNION ALL SELECT DISTINCT 'domain', domain FROM named WHERE domain IS NOT NULL
), coded AS (SELECT *, ('0x' || substr(md5(key), 1, 4))::INT AS v FROM keys),
chosen AS (SELECT * FROM coded WHERE (kind = 'host' AND v % 3 = 0) OR (kind = 'domain' AND v % 7 < 3)),
entries AS (
  SELECT kind, key, DATE '2024-01-01' + (v % 200) AS day, true AS listed FROM chosen
  UNION ALL SELECT kind, key, DATE '2024-01-01' + (v % 200 + 30 + v % 100), false FROM chosen WHERE v % 2 = 0
  UNION ALL SELECT kind, key, DATE '2024-01-01' + (v % 200 + 160), true FROM chosen WHERE v % 4 = 0
), daily AS (SELECT kind, key, day, bool_or(listed) AS listed FROM entries GROUP BY ALL),
held AS (SELECT *, lead(day) OVER (PARTITION BY kind, key ORDER BY day) AS until FROM daily)
SELECT n.page_id, n.host, n.fetched_on::DATE AS fetched_on, h.day::DATE AS host_listed_since, d.day::DATE AS domain_listed_since,
       (h.day IS NOT NULL OR d.day IS NOT NULL) AS blocked
FROM named n
LEFT JOIN held h ON h.kind = 'host' AND h.key = n.host AND h.listed AND h.day <= n.fetched_on AND (h.until IS NULL OR n.fetched_on < h.until)
LEFT JOIN held d ON d.kind = 'domain' AND d.key = n.domain AND d.listed AND d.day <= n.fetched_on AND (d.until IS NULL OR n.fetched_on < d.until)"""
