"""URL filters: a temporal join of captures with dated list entries.

A list is a table of dated events (pattern, verdict, listed_from day, and
whether the event adds or removes the pattern).  The events of a pattern
become disjoint validity intervals with one window over the list.  A capture
asks for its keys -- the URL without query and fragment, its host, and every
parent domain -- and an equi-join on the key with the interval condition gives
the entry that was active at fetch time: at most one per key, so no row
multiplies.  The most specific active entry decides; ``allow`` beats a wider
``block``.

Only DataFrame functions run here.  The intervals are written once, so both
sides of the join arrive by plain exchanges, and adaptive execution may
broadcast a list that it has measured, or split a domain that holds a third
of all captures.

Odd input: a null or unparsable URL has no keys and is not blocked; a null
fetch day matches no interval; of several events of a pattern on one day a
removal wins, then an ``allow``; an interval without days is dropped.
Repeated captures give repeated rows; empty tables give empty tables, or
nothing blocked.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

NEVER = 2**31 - 1


def host_of(url: Column) -> Column:
    """Lower-case host of a URL; null where there is none."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1))
    return F.when(host != "", host)


def page_of(url: Column) -> Column:
    """Host and path without query, fragment and closing slash."""
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    return F.concat(host_of(url), F.regexp_replace(path, "/+$", ""))


def keys_of(url: Column) -> Column:
    """(rank, key) of a URL: 0 the page, 1 the host, then its parent domains with two labels or more."""
    labels = F.split(host_of(url), r"\.")
    parents = F.transform(F.sequence(F.lit(2), F.size(labels) - 1),
                          lambda n: F.struct(n.alias("rank"), F.concat(F.lit("domain:"), F.concat_ws(
                              ".", F.slice(labels, n, F.size(labels) - n + 1))).alias("key")))
    own = F.array(F.struct(F.lit(0).alias("rank"), F.concat(F.lit("page:"), page_of(url)).alias("key")),
                  F.struct(F.lit(1).alias("rank"), F.concat(F.lit("host:"), host_of(url)).alias("key")),
                  F.struct(F.lit(1).alias("rank"), F.concat(F.lit("domain:"), host_of(url)).alias("key")))
    return (F.when(host_of(url).isNull(), F.array().cast("array<struct<rank:int,key:string>>"))
            .when(F.size(labels) > 2, F.concat(own, parents)).otherwise(own))


def intervals(events: DataFrame) -> DataFrame:
    """key, verdict, valid_from, valid_to (exclusive) of the dated events
    (key, verdict, day, removes)."""
    one = (events.filter("key is not null and day is not null").groupBy("key", "day")
           .agg(F.max("removes").alias("removes"),
                F.min_by("verdict", F.struct(~F.col("removes"), F.col("verdict"))).alias("verdict")))
    return (one.withColumn("valid_to", F.coalesce(F.lead("day").over(W.partitionBy("key").orderBy("day")), F.lit(NEVER)))
            .filter("not removes").select("key", "verdict", F.col("day").alias("valid_from"), "valid_to"))


def judge(captures: DataFrame, listed: DataFrame, page_id: str = "page_id", url: str = "url",
          fetched: str = "fetched") -> DataFrame:
    """page_id, host, fetched, blocked, rule (key of the deciding entry), since (its first day)."""
    rows = captures.select(F.col(f"`{page_id}`").alias("page_id"), F.col(f"`{url}`").alias("url"),
                           F.col(f"`{fetched}`").alias("fetched")).withColumn("row", F.monotonically_increasing_id())
    asked = rows.select("row", "page_id", "fetched", host_of(F.col("url")).alias("host"),
                        F.explode_outer(keys_of(F.col("url"))).alias("k"))
    met = asked.select("row", "page_id", "fetched", "host", "k.rank", "k.key").join(
        listed, (F.col("listed_key") == F.col("key")) & (F.col("valid_from") <= F.col("fetched"))
        & (F.col("fetched") < F.col("valid_to")), "left")
    best = F.min(F.when(F.col("verdict").isNotNull(), F.struct(
        F.col("rank"), F.col("verdict"), F.col("key"), F.col("valid_from"))))
    return (met.groupBy("row").agg(F.first("page_id").alias("page_id"), F.first("host").alias("host"),
                                   F.first("fetched").alias("fetched"), best.alias("best"))
            .select("page_id", "host", "fetched", F.coalesce(F.col("best.verdict") == "block", F.lit(False)).alias("blocked"),
                    F.col("best.key").alias("rule"), F.col("best.valid_from").alias("since")))


def url_filter(captures: DataFrame, events: DataFrame, stage, page_id: str = "page_id", url: str = "url",
               fetched: str = "fetched") -> DataFrame:
    """``judge`` against the intervals of the events, which ``stage`` writes once."""
    listed = stage(intervals(events).withColumnRenamed("key", "listed_key"))
    return judge(captures, listed, page_id, url, fetched)


def number_of(text: Column, at: int = 1) -> Column:
    """A number below 2**24 from the md5 of a text; the same in other SQL engines."""
    return F.conv(F.substring(F.md5(text.cast("binary")), at, 6), 16, 10).cast("int")


def sample_captures(pages: DataFrame) -> DataFrame:
    """Pages with a fetch day (0 to 364) derived from page_id, as the table has none."""
    return pages.select("page_id", "url", F.pmod(number_of(F.col("page_id").cast("string")), F.lit(365)).alias("fetched"))


def sample_events(pages: DataFrame) -> DataFrame:
    """Dated list events derived from the pages, as there is no list table.

    One host in four is blocked on a day and, one in two of those, removed 45
    days later; one page in eight of the other hosts is allowed; one host in
    eight and one in sixteen parent domains are blocked as domains.
    """
    hosts = pages.select(host_of(F.col("url")).alias("h")).filter("h is not null").distinct().withColumn(
        "n", number_of(F.col("h"))).withColumn("m", number_of(F.col("h"), 7))
    paths = pages.select(page_of(F.col("url")).alias("p")).filter("p is not null").distinct().withColumn(
        "n", number_of(F.col("p")))
    parents = hosts.select(F.regexp_extract("h", r"([^.]+\.[^.]+)$", 1).alias("d")).filter("d != ''").distinct().withColumn(
        "n", number_of(F.col("d")))

    def event(df, prefix, column, verdict, day, removes=False):
        return df.select(F.concat(F.lit(prefix), F.col(column)).alias("key"), F.lit(verdict).alias("verdict"),
                         day.cast("int").alias("day"), F.lit(removes).alias("removes"))
    day = F.pmod("n", F.lit(300))
    blocked = hosts.filter("m % 4 = 0")
    return (event(blocked, "host:", "h", "block", day)
            .unionByName(event(blocked.filter("m % 8 = 0"), "host:", "h", "block", day + 45, True))
            .unionByName(event(blocked.filter("m % 16 = 0"), "host:", "h", "block", day + 60))
            .unionByName(event(paths.filter("n % 8 = 0"), "page:", "p", "allow", F.pmod("n", F.lit(200))))
            .unionByName(event(hosts.filter("m % 8 = 1"), "domain:", "h", "block", day))
            .unionByName(event(parents.filter("n % 16 = 1 or n % 16 = 2"), "domain:", "d", "block", day)))


#: The query over sample_captures and sample_events in DuckDB's SQL.
SQL = r"""
with c as (
  select row_number() over () as row, page_id, url,
         ('0x' || substr(md5(cast(page_id as varchar)), 1, 6))::int % 365 as fetched,
         nullif(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)', 1)), '') as host,
         regexp_replace(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '/+$', '') as path
  from pages),
hosts as (select distinct host as h, ('0x' || substr(md5(host), 1, 6))::int as n,
                 ('0x' || substr(md5(host), 7, 6))::int as m from c where host is not null),
paths as (select distinct host || path as p, ('0x' || substr(md5(host || path), 1, 6))::int as n
          from c where host is not null),
parents as (select distinct regexp_extract(h, '([^.]+\.[^.]+)$', 1) as d from hosts),
parents2 as (select d, ('0x' || substr(md5(d), 1, 6))::int as n from parents where d <> ''),
events as (
  select 'host:' || h as key, 'block' as verdict, n % 300 as day, false as removes from hosts where m % 4 = 0
  union all select 'host:' || h, 'block', n % 300 + 45, true from hosts where m % 8 = 0
  union all select 'host:' || h, 'block', n % 300 + 60, false from hosts where m % 16 = 0
  union all select 'page:' || p, 'allow', n % 200, false from paths where n % 8 = 0
  union all select 'domain:' || h, 'block', n % 300, false from hosts where m % 8 = 1
  union all select 'domain:' || d, 'block', n % 300, false from parents2 where n % 16 in (1, 2)),
one as (select key, day, bool_or(removes) as removes, min(verdict) as verdict from events group by key, day),
spans as (select *, coalesce(lead(day) over (partition by key order by day), 2147483647) as valid_to from one),
asked as (
  select row, 0 as rank, 'page:' || host || path as key from c where host is not null
  union all select row, 1, 'host:' || host from c where host is not null
  union all select row, 1, 'domain:' || host from c where host is not null
  union all select row, i, 'domain:' || array_to_string(list_slice(string_split(host, '.'), i, len(string_split(host, '.'))), '.')
  from (select row, host, unnest(range(2, len(string_split(host, '.')))) as i from c where host is not null)),
best as (
  select a.row, min({'rank': a.rank, 'verdict': s.verdict, 'key': a.key, 'since': s.day}) as b
  from asked a join c on a.row = c.row
  join spans s on s.key = a.key and not s.removes and s.day <= c.fetched and c.fetched < s.valid_to
  group by a.row)
select c.page_id, c.host, c.fetched, coalesce(b.verdict = 'block', false) as blocked, b.key as rule, b.since as since
from c left join best on c.row = best.row
"""
