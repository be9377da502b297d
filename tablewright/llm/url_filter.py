"""URL filters by a temporal list join.

A block list is a table of dated entries: a pattern (a domain, which covers
its subdomains too) is listed or taken off on a day, in a category.  The
entries of a pattern and category become validity intervals [from, until): an
entry holds until the next one of the same pattern and category, repeated
entries change nothing, and of several on one day taking off comes last.
Every capture is evaluated as of its fetch day: the intervals that hold then,
for its host or any parent domain, decide.

Scale: captures shrink to distinct (host, day) pairs before anything is
joined.  Intervals are cut at multiples of ``span`` days, so the join has the
equal keys (domain, span) and a host with a long history meets only the
entries of one span; it is an ordinary sorted join, in which Spark splits hot
hosts.  The verdict goes back to the captures on (host, day); captures without
a host are spread over keys of their own, so they never meet in one task.

Edge cases: a URL without a host, or a null URL or day, is blocked by nothing;
entries with a null pattern, day or action are ignored; captures that repeat
keep their rows; an empty list blocks nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stage

HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)"
FOREVER = 1 << 40
SPREAD = 4096           # keys over which captures without a host are spread


def host_of(url: Column) -> Column:
    """Lower-case host of a URL without user, port and closing dot; null if there is none."""
    host = F.regexp_replace(F.lower(F.regexp_extract(url, HOST, 1)), r"\.$", "")
    return F.when(F.length(host) > 0, host)


def domains_of(host: Column) -> Column:
    """The host and its parent domains of at least two labels, longest first."""
    parts = F.split(host, r"\.")
    last = F.greatest(F.size(parts) - 1, F.lit(1))
    return F.transform(F.sequence(F.lit(1), last), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))


def intervals(entries: DataFrame) -> DataFrame:
    """``pattern, category, since, until`` from entries (pattern, category, day, listed).

    One entry a (pattern, category, day) counts, off before on; changes only are kept.
    """
    daily = (entries.where("pattern is not null and day is not null and listed is not null")
             .groupBy(F.lower("pattern").alias("pattern"), "category", "day").agg(F.min("listed").alias("listed")))
    order = Window.partitionBy("pattern", "category").orderBy("day")
    changes = (daily.withColumn("before", F.lag("listed").over(order))
               .where("before is null or before <> listed")
               .withColumn("until", F.coalesce(F.lead("day").over(order), F.lit(FOREVER))))
    return changes.where("listed").select("pattern", "category", F.col("day").cast("long").alias("since"),
                                          F.col("until").cast("long").alias("until"))


def evaluate(captures: DataFrame, entries: DataFrame, span: int = 64, url_col: str = "url",
             day_col: str = "fetch_day") -> DataFrame:
    """``captures`` with ``host, blocked, matched, categories``.

    ``matched`` is the longest listed domain as of the capture's day and
    ``categories`` its and its parents' categories, in order, joined by commas.
    """
    held = captures.select(F.struct("*").alias("row"), host_of(F.col(f"`{url_col}`")).alias("host"),
                           F.col(f"`{day_col}`").cast("long").alias("day"))
    asked = (held.where("host is not null and day is not null").select("host", "day").distinct()
             .withColumn("pattern", F.explode(domains_of(F.col("host"))))
             .withColumn("part", F.floor(F.col("day") / span)))
    last = captures.agg(F.max(F.col(f"`{day_col}`").cast("long"))).first()[0]
    first = captures.agg(F.min(F.col(f"`{day_col}`").cast("long"))).first()[0]
    # only the spans in which captures were made
    low, high = F.greatest("since", F.lit(first or 0)), F.least(F.col("until") - 1, F.lit(last or 0))
    cut = (intervals(entries).where(low <= high)
           .withColumn("part", F.explode(F.sequence(F.floor(low / span), F.floor(high / span)))))
    hits = asked.join(cut, ["pattern", "part"]).where("day >= since and day < until")
    verdict = hits.groupBy("host", "day").agg(
        F.max(F.struct(F.length("pattern").alias("n"), "pattern")).alias("m"),
        F.array_join(F.array_sort(F.collect_set("category")), ",").alias("categories"))
    verdict = verdict.select(F.col("host").alias("_host"), F.col("day").alias("_day"), F.col("m.pattern").alias("matched"), "categories")
    verdict = stage(verdict, "verdicts")
    # no host has a slash: rows without a host or day match nothing and are spread over many keys
    spread = F.concat(F.lit("/"), (F.monotonically_increasing_id() % SPREAD).cast("string"))
    held = held.withColumn("_key", F.when(F.col("day").isNotNull() & F.col("host").isNotNull(), F.col("host")).otherwise(spread))
    out = held.join(verdict, (held["_key"] == F.col("_host")) & (F.coalesce(held["day"], F.lit(0)) == F.col("_day")), "left")
    found = {"host": F.col("host"), "blocked": F.col("matched").isNotNull(), "matched": F.col("matched"),
             "categories": F.col("categories")}
    others = [c for c in captures.columns if c not in found]
    return out.select(*[F.col("row").getField(c).alias(c) for c in others], *[c.alias(n) for n, c in found.items()])


def _number(text: Column, n: int) -> Column:
    return (F.conv(F.substring(F.md5(text), 1, 7), 16, 10).cast("long") % n)


def dated_pages(pages: DataFrame) -> DataFrame:
    """``page_id, url, fetch_day``: the pages table has no fetch time, so a day in 0..364 comes from the id."""
    return pages.select("page_id", "url", _number(F.col("page_id").cast("string"), 365).alias("fetch_day"))


def entries_from(pages: DataFrame) -> DataFrame:
    """Dated entries for about two fifths of the domains that the pages' hosts have.

    The tables hold no list; every domain's history (listed, off, listed again
    for some) follows from a hash of its name, so the list grows with the pages.
    """
    names = (pages.select(F.explode(domains_of(host_of(F.col("url")))).alias("pattern")).distinct()
             .where(F.size(F.split("pattern", r"\.")) > 2)
             .withColumn("a", _number(F.col("pattern"), 300))
             .withColumn("b", _number(F.concat(F.lit("b"), "pattern"), 60) + 1)
             .where(_number(F.concat(F.lit("c"), "pattern"), 5) < 2))
    kind = F.element_at(F.array(*[F.lit(c) for c in ("adult", "malware", "phishing", "spam")]),
                        (F.col("b") % 4 + 1).cast("int"))
    steps = F.explode(F.array(
        F.struct(F.col("a").alias("day"), F.lit(True).alias("listed")),
        F.struct((F.col("a") + F.col("b")).alias("day"), F.lit(False).alias("listed")),
        F.struct((F.col("a") + F.col("b") * 2).alias("day"), (F.col("b") % 3 == 0).alias("listed"))))
    return names.select("pattern", kind.alias("category"), steps.alias("s")).select(
        "pattern", "category", "s.day", "s.listed")


def oracle() -> str:
    """DuckDB SQL for ``evaluate(dated_pages(pages), entries_from(pages))``."""
    number = "(('0x' || substr(md5({}), 1, 7))::bigint % {})"
    return f"""
    with p as (select row_number() over () as r, page_id, url, {number.format("page_id::varchar", 365)} as fetch_day,
                      nullif(regexp_replace(lower(regexp_extract(url, '{HOST}', 1)), '\\.$', ''), '') as host from pages),
    x as (select r, fetch_day, host, string_split(host, '.') as parts from p where host is not null),
    y as (select r, fetch_day, array_to_string(parts[i:], '.') as pattern, len(parts) - i + 1 as labels
          from x, (select unnest(range(1, 64)) as i) where i <= greatest(len(parts) - 1, 1)),
    n as (select distinct pattern, {number.format("pattern", 300)} as a, {number.format("'b' || pattern", 60)} + 1 as b
          from y where labels > 2 and {number.format("'c' || pattern", 5)} < 2),
    h as (select r, arg_max(y.pattern, strlen(y.pattern)) as matched,
                 array_to_string(list_sort(list(distinct ['adult', 'malware', 'phishing', 'spam'][b % 4 + 1])), ',') as categories
          from y join n using (pattern)
          where (fetch_day >= a and fetch_day < a + b) or (b % 3 = 0 and fetch_day >= a + b * 2) group by r)
    select page_id, url, fetch_day, host, matched is not null as blocked, matched, categories from p left join h using (r)"""
