"""Web-log analytics: domain filters, line parsing, request counts by country
and host, top-k hosts with a ``rest`` row, and the day x hour activity grid.

All of it is one scan and one projection; the three per-country filters of a
classic implementation become one array-filter + explode, so the log is read
once however many domains are asked for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# fixed values: country -> domain suffix of its universities
DOMAINS = {"JP": ".ac.jp", "UK": ".ac.uk", "US": ".edu"}

TS_FORMAT = "dd/MMM/yyyy:HH:mm:ss Z"


# fixed values: the patterns of the log's fields. The label in front of a domain suffix has at most 50 characters.
HOST_PATTERN = r"([^\.]{1,50}%s)"
TIMESTAMP_PATTERN = r".* - - \[(.*)\].*"
REQUEST_PATTERN = r'.*"(.*)".*'


def _host_pattern(suffix: str) -> str:
    return HOST_PATTERN % suffix.replace(".", r"\.")


def filter_contains_domain(lines: DataFrame, domains: dict[str, str] | None = None,
                           mode: str = "line") -> DataFrame:
    """(country, value) for each line that mentions a country's domain.

    ``mode='line'`` tests the whole line (a URL in the request also counts);
    ``mode='host'`` tests only the host field. A line matching two domains
    appears once per domain, exactly as separate filters would count it.
    """
    domains = domains or DOMAINS
    target = F.col("value") if mode == "line" else F.substring_index(F.col("value"), " ", 1)
    tagged = F.array(*[F.struct(F.lit(c).alias("country"), F.lit(s).alias("suffix"))
                       for c, s in domains.items()])
    if mode == "line":
        hit = F.filter(tagged, lambda d: F.contains(target, d["suffix"]))
    else:
        hit = F.filter(tagged, lambda d: F.endswith(target, d["suffix"]))
    return (lines.select(F.explode(hit).alias("d"), "value")
            .select(F.col("d.country").alias("country"), "value"))


def _per_country(domains: dict[str, str], build) -> Column:
    expr = None
    for c, s in domains.items():
        e = build(s)
        expr = F.when(F.col("country") == c, e) if expr is None else expr.when(F.col("country") == c, e)
    return expr


def parse_log(lines: DataFrame, domains: dict[str, str] | None = None, mode: str = "line",
              keep_value: bool = False) -> DataFrame:
    """Parse the lines of each country into host, timestamp, request, status, bytes.

    * host: registered domain label + suffix (``''`` when absent);
    * timestamp: text between ``- - [`` and ``]``, and ``event_time`` parsed from it
      (NULL if malformed);
    * request: the quoted request string;
    * status / bytes: second-last and last space-separated tokens as int,
      NULL when malformed (``-`` bytes).
    """
    domains = domains or DOMAINS
    tagged = filter_contains_domain(lines, domains, mode)
    parts = F.split(F.col("value"), " ")
    ts_text = F.regexp_extract("value", TIMESTAMP_PATTERN, 1)
    cols = [
        "country",
        _per_country(domains, lambda s: F.regexp_extract("value", _host_pattern(s), 1)).alias("host"),
        ts_text.alias("timestamp"),
        F.try_to_timestamp(ts_text, F.lit(TS_FORMAT)).alias("event_time"),
        F.regexp_extract("value", REQUEST_PATTERN, 1).alias("request"),
        F.try_element_at(parts, F.lit(-2)).try_cast("int").alias("status"),
        F.try_element_at(parts, F.lit(-1)).try_cast("int").alias("bytes"),
    ]
    if keep_value:
        cols.append("value")
    return tagged.select(*cols)


def filter_sql_string(df: DataFrame, predicate: str) -> DataFrame:
    """Keep rows matching a predicate written as SQL text, e.g. ``"host='x'"``."""
    return df.where(predicate)


def extract_day_hour(df: DataFrame, ts_col: str = "event_time") -> DataFrame:
    return df.withColumn("day", F.dayofmonth(ts_col)).withColumn("hour", F.hour(ts_col))


def count_by_country(parsed: DataFrame) -> DataFrame:
    """(country, requests): lines per domain group, one aggregation pass."""
    return parsed.groupBy("country").agg(F.count(F.lit(1)).alias("requests"))


def count_by_host(parsed: DataFrame) -> DataFrame:
    """(country, host, requests)."""
    return parsed.groupBy("country", "host").agg(F.count(F.lit(1)).alias("requests"))


def rank_within_group(df: DataFrame, group: list[str], order: list[Column], k: int,
                      rank_col: str = "rank") -> DataFrame:
    """Top ``k`` rows of each group by ``order`` (a total order: add a key as
    the last tie-break). ``row_number <= k`` lets Spark cut each group to k
    rows before the shuffle (WindowGroupLimit), so a huge group never travels
    whole to one task."""
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= k)


def top_hosts(parsed: DataFrame, k: int = 9) -> DataFrame:
    """(country, host, requests, rank) for the k busiest hosts of each country."""
    return top_of_counts(count_by_host(parsed), k)


def top_of_counts(counts: DataFrame, k: int) -> DataFrame:
    """The k busiest hosts of each country from (country, host, requests)."""
    return rank_within_group(counts, ["country"], [F.desc("requests"), F.asc("host")], k)


def top_plus_rest(parsed: DataFrame, k: int = 9) -> DataFrame:
    """Top ``k`` hosts of each country plus a ``rest`` row holding the other
    requests, and each row's share (%) of the country's total.

    Output: (country, host, requests, share_pct, rank) with rank k+1 for rest.
    """
    # both branches read the same counts per host: one scan, and the second use of its exchange is free
    counts = count_by_host(parsed)
    top = top_of_counts(counts, k)
    totals = counts.groupBy("country").agg(F.sum("requests").alias("total"))
    top_sum = top.groupBy("country").agg(F.sum("requests").alias("top_requests"))
    # one row per country on both sides: the join input is bounded by the
    # number of domains, so broadcasting it is safe
    rest = (totals.join(F.broadcast(top_sum), "country")
            .select("country", F.lit("rest").alias("host"),
                    (F.col("total") - F.col("top_requests")).alias("requests"),
                    F.lit(k + 1).alias("rank"), "total"))
    top_t = top.join(F.broadcast(totals), "country").select("country", "host", "requests", "rank", "total")
    both = top_t.unionByName(rest)
    return both.select("country", "host", "requests",
                       F.round(F.col("requests") * 100.0 / F.col("total"), 6).alias("share_pct"),
                       F.col("rank").cast("int").alias("rank"))


def day_hour_grid(parsed: DataFrame, hosts: DataFrame | None = None, days: int = 31) -> DataFrame:
    """Requests by (day of month 1..days, hour 0..23) for one host per country,
    zeros included. ``hosts`` (country, host) defaults to each country's
    busiest host, computed here rather than typed in."""
    cells = extract_day_hour(parsed).groupBy("country", "host", "day", "hour").agg(F.count(F.lit(1)).alias("requests"))
    if hosts is None:
        # one scan: a host's cells travel as one array (at most days x 24 and a null cell), its total is their sum
        per_host = cells.groupBy("country", "host").agg(
            F.sum("requests").alias("total"), F.collect_list(F.struct("day", "hour", "requests")).alias("cells"))
        top = per_host.groupBy("country").agg(F.min_by(F.struct("host", "cells"), F.struct(-F.col("total"), F.col("host"))).alias("t"))
        found = F.map_from_entries(F.transform(
            F.filter("t.cells", lambda c: c["day"].isNotNull() & c["hour"].isNotNull()),
            lambda c: F.struct((c["day"] * 24 + c["hour"]).alias("key"), c["requests"].alias("value"))))
        grid = (top.select("country", F.col("t.host").alias("host"), found.alias("found"), F.explode(F.sequence(F.lit(1), F.lit(days))).alias("day"))
                .select("country", "host", "found", "day", F.explode(F.sequence(F.lit(0), F.lit(23))).alias("hour")))
        at = F.try_element_at("found", F.col("day") * 24 + F.col("hour"))
        return grid.select("country", "host", "day", "hour", F.coalesce(at, F.lit(0)).cast("bigint").alias("requests"))
    hosts = hosts.select("country", "host")
    # a caller's host list has no bound here: the planner and AQE pick the join
    counts = cells.join(hosts, ["country", "host"], "left_semi")
    grid = (hosts.select("country", "host", F.explode(F.sequence(F.lit(1), F.lit(days))).alias("day"))
            .select("country", "host", "day", F.explode(F.sequence(F.lit(0), F.lit(23))).alias("hour")))
    return (grid.join(counts, ["country", "host", "day", "hour"], "left")
            .select("country", "host", "day", "hour",
                    F.coalesce(F.col("requests"), F.lit(0)).cast("bigint").alias("requests")))


def sort_desc_limit(df: DataFrame, by: str, k: int, *ties: str) -> DataFrame:
    """Global top-k: planned as TakeOrderedAndProject (per-partition top-k,
    then a k-row merge), never a full sort."""
    return df.orderBy(F.desc(by), *[F.asc(t) for t in ties]).limit(k)
