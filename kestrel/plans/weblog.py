"""Web-log plans: S1, P1-P7, A1-A4, W3, T1 over the ``log_lines`` view."""

from __future__ import annotations

from pyspark.sql import functions as F

from kestrel.operators import weblog as wl
from kestrel.plans.registry import register
from kestrel.sources import fixtures as fx
from kestrel.session import scratch_path
from kestrel.sources.files import scan_text_lines

_TAGGED = r"""
    SELECT 'JP' AS country, value FROM log_lines WHERE contains(value, '.ac.jp')
    UNION ALL SELECT 'UK', value FROM log_lines WHERE contains(value, '.ac.uk')
    UNION ALL SELECT 'US', value FROM log_lines WHERE contains(value, '.edu')"""

_PARSED = r"""
    SELECT country, value,
           CASE country WHEN 'JP' THEN regexp_extract(value, '([^\.]{1,50}\.ac\.jp)', 1)
                        WHEN 'UK' THEN regexp_extract(value, '([^\.]{1,50}\.ac\.uk)', 1)
                        WHEN 'US' THEN regexp_extract(value, '([^\.]{1,50}\.edu)', 1) END AS host,
           regexp_extract(value, '.* - - \[(.*)\].*', 1) AS timestamp,
           timezone('UTC', try_strptime(regexp_extract(value, '.* - - \[(.*)\].*', 1),
                                        '%d/%b/%Y:%H:%M:%S %z')) AS event_time,
           regexp_extract(value, '.*"(.*)".*', 1) AS request,
           TRY_CAST(string_split(value, ' ')[-2] AS INTEGER) AS status,
           TRY_CAST(string_split(value, ' ')[-1] AS INTEGER) AS bytes
    FROM tagged"""


def _sql(body: str, extra=None) -> str:
    return fx.with_views(["log_lines"], body, [("tagged", _TAGGED), ("parsed", _PARSED)] + (extra or []))


def _parsed(spark, sf):
    return wl.parse_log(fx.log_lines(spark, sf), keep_value=True)


@register("scan_text_lines", fx.with_views(["log_lines"], "SELECT value FROM log_lines"))
def q_scan_text_lines(spark, sf):
    """The log written as gzip text (one task per file when read) and scanned
    back, spread over the cluster's cores for the parsing stages."""
    path = scratch_path(spark, "log-gz")
    fx.log_lines(spark, sf).write.mode("overwrite").option("compression", "gzip").text(path)
    return scan_text_lines(spark, path, partitions=spark.sparkContext.defaultParallelism)


@register("filter_contains_domain", _sql("SELECT country, value FROM tagged"))
def q_filter_contains_domain(spark, sf):
    return wl.filter_contains_domain(fx.log_lines(spark, sf))


@register("filter_host_domain", fx.with_views(["log_lines"], """
    SELECT country, value FROM log_lines, (VALUES ('JP', '.ac.jp'), ('UK', '.ac.uk'), ('US', '.edu')) d(country, suffix)
    WHERE ends_with(split_part(value, ' ', 1), suffix)"""))
def q_filter_host_domain(spark, sf):
    """Only the host decides, not a URL in the request (P1 with mode='host')."""
    return wl.filter_contains_domain(fx.log_lines(spark, sf), mode="host")


@register("parse_log_host", _sql("SELECT country, value, host FROM parsed"))
def q_parse_log_host(spark, sf):
    return _parsed(spark, sf).select("country", "value", "host")


@register("parse_log_timestamp", _sql(
    "SELECT country, value, timestamp, strftime(event_time, '%Y-%m-%d %H:%M:%S') AS event_time FROM parsed"))
def q_parse_log_timestamp(spark, sf):
    return _parsed(spark, sf).select(
        "country", "value", "timestamp",
        F.date_format("event_time", "yyyy-MM-dd HH:mm:ss").alias("event_time"))


@register("parse_log_request", _sql("SELECT country, value, request FROM parsed"))
def q_parse_log_request(spark, sf):
    return _parsed(spark, sf).select("country", "value", "request")


@register("parse_log_status_bytes", _sql("SELECT country, value, status, bytes FROM parsed"))
def q_parse_log_status_bytes(spark, sf):
    return _parsed(spark, sf).select("country", "value", "status", "bytes")


@register("filter_sql_string", _sql(
    "SELECT country, host, timestamp, status FROM parsed WHERE status = 404 AND country = 'US'"))
def q_filter_sql_string(spark, sf):
    return wl.filter_sql_string(_parsed(spark, sf), "status = 404 AND country = 'US'").select(
        "country", "host", "timestamp", "status")


@register("extract_day_hour", _sql(
    "SELECT country, value, CAST(day(event_time) AS INTEGER) AS day, "
    "CAST(hour(event_time) AS INTEGER) AS hour FROM parsed"))
def q_extract_day_hour(spark, sf):
    return wl.extract_day_hour(_parsed(spark, sf)).select("country", "value", "day", "hour")


@register("count_by_country", _sql("SELECT country, count(*) AS requests FROM parsed GROUP BY country"))
def q_count_by_country(spark, sf):
    return wl.count_by_country(_parsed(spark, sf))


@register("count_by_host", _sql(
    "SELECT country, host, count(*) AS requests FROM parsed GROUP BY country, host"))
def q_count_by_host(spark, sf):
    return wl.count_by_host(_parsed(spark, sf))


_HOST_RANK = """
    SELECT country, host, requests,
           CAST(row_number() OVER (PARTITION BY country ORDER BY requests DESC, host) AS INTEGER) AS rank
    FROM (SELECT country, host, count(*) AS requests FROM parsed GROUP BY country, host)"""


@register("rank_within_group", _sql("SELECT * FROM ranked WHERE rank <= 9", [("ranked", _HOST_RANK)]))
def q_rank_within_group(spark, sf):
    return wl.top_hosts(_parsed(spark, sf), 9)


@register("top9_plus_rest", _sql(
    """SELECT country, host, requests, round(requests * 100.0 / total, 6) AS share_pct, CAST(rank AS INTEGER) AS rank
       FROM totaled WHERE rank <= 9
       UNION ALL
       SELECT country, 'rest', sum(CASE WHEN rank > 9 THEN requests ELSE 0 END),
              round(sum(CASE WHEN rank > 9 THEN requests ELSE 0 END) * 100.0 / any_value(total), 6), 10
       FROM totaled GROUP BY country""",
    [("ranked", _HOST_RANK),
     ("totaled", "SELECT r.*, sum(requests) OVER (PARTITION BY country) AS total FROM ranked r")]))
def q_top9_plus_rest(spark, sf):
    return wl.top_plus_rest(_parsed(spark, sf), 9)


@register("day_hour_grid", _sql(
    """SELECT h.country, h.host, d.day, hr.hour, CAST(coalesce(c.n, 0) AS BIGINT) AS requests
       FROM (SELECT country, host FROM ranked WHERE rank = 1) h
       CROSS JOIN (SELECT CAST(range AS INTEGER) AS day FROM range(1, 32)) d
       CROSS JOIN (SELECT CAST(range AS INTEGER) AS hour FROM range(0, 24)) hr
       LEFT JOIN (SELECT country, host, day(event_time) AS day, hour(event_time) AS hour, count(*) AS n
                  FROM parsed GROUP BY ALL) c
         ON c.country = h.country AND c.host = h.host AND c.day = d.day AND c.hour = hr.hour""",
    [("ranked", _HOST_RANK)]))
def q_day_hour_grid(spark, sf):
    return wl.day_hour_grid(_parsed(spark, sf))


@register("sort_desc_limit", _sql(
    """SELECT country, host, count(*) AS requests FROM parsed GROUP BY country, host
       ORDER BY requests DESC, country, host LIMIT 10"""))
def q_sort_desc_limit(spark, sf):
    return wl.sort_desc_limit(wl.count_by_host(_parsed(spark, sf)), "requests", 10, "country", "host")
