"""File-format plans.

The test tables are Parquet, so each plan first writes a view in the file
format the original analysis read (delimited text with or without a header,
multi-line quoted CSV, one ISO-8859-1 sentence file per class, a commented
word list), under the session's checkpoint folder, and then reads it back
with the library's reader. The SQL oracle is the view itself: a reader is
right when the round trip is the identity.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel.plans import recsys as rp
from kestrel.plans import sentiment as sp
from kestrel.plans import weblog as wp
from kestrel.plans.registry import register
from kestrel.session import scratch_path
from kestrel.sources import fixtures as fx
from kestrel.sources import files as fs

RATINGS_SCHEMA = T.StructType([
    T.StructField("userId", T.LongType()), T.StructField("movieId", T.IntegerType()),
    T.StructField("rating", T.DoubleType()), T.StructField("timestamp", T.LongType())])

WIDE_FEATURES = 64


def _plain_csv(df, path: str, header: bool, **options) -> None:
    """CSV as a plain text tool would write it: no trimming of values."""
    w = (df.write.mode("overwrite").option("header", header)
         .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False))
    for k, v in options.items():
        w = w.option(k, v)
    w.csv(path)


@register("scan_csv_header", fx.with_views(["ratings"], """
    SELECT user_id AS userId, item AS movieId, rating, CAST(floor(epoch(ts)) AS BIGINT) AS "timestamp" FROM ratings"""))
def q_scan_csv_header(spark, sf):
    """Ratings as ``userId,movieId,rating,timestamp`` with a header line, read
    back with a given schema (no inference pass over the data)."""
    path = scratch_path(spark, "ratings-csv")
    r = fx.ratings(spark, sf).select(
        F.col("user_id").alias("userId"), F.col("item").alias("movieId"), "rating",
        F.unix_timestamp("ts").alias("timestamp"))
    _plain_csv(r, path, header=True)
    return fs.scan_csv(spark, path, RATINGS_SCHEMA, header=True)


@register("scan_csv_noheader", fx.with_views(["wide"], "SELECT CAST(label AS DOUBLE) AS label, " + ", ".join(
    f"CAST(features[{i}] AS DOUBLE) AS f{i}" for i in range(1, WIDE_FEATURES + 1)) + " FROM wide"))
def q_scan_csv_noheader(spark, sf):
    """The wide numeric table as gzip CSV without a header, label first; read
    back by position as ``label, f1..f64``."""
    path = scratch_path(spark, "wide-csv")
    w = fx.wide(spark, sf)
    cols = [F.col("label")] + [F.col("features")[i - 1].cast("double").alias(f"f{i}")
                               for i in range(1, WIDE_FEATURES + 1)]
    _plain_csv(w.select(*cols), path, header=False, compression="gzip")
    return fs.scan_csv_noheader(spark, path, WIDE_FEATURES, label_first=True)


@register("scan_labelled_text", fx.with_views(["texts"], "SELECT text, label FROM texts"))
def q_scan_labelled_text(spark, sf):
    """Labelled texts (which hold line breaks and quotes) as a quoted
    ``text,label`` CSV, read back as multi-line records."""
    path = scratch_path(spark, "texts-csv")
    t = fx.texts(spark, sf).select("text", "label")
    _plain_csv(t, path, header=False, quote='"', escape='"')
    return fs.scan_labelled_text(spark, path, ["text", "label"])


def _class_lines(texts):
    """Every non-blank line of every labelled text, with its label."""
    return (texts.select(F.explode(F.split("text", "\n")).alias("text"), "label")
            .where(F.trim(F.col("text")) != ""))


@register("scan_class_files", fx.with_views(["texts"], r"""
    SELECT text, CASE label WHEN 1 THEN 'pos' ELSE 'neg' END AS label
    FROM (SELECT unnest(string_split(text, chr(10))) AS text, label FROM texts)
    WHERE trim(text) <> ''"""))
def q_scan_class_files(spark, sf):
    """One ISO-8859-1 file of sentences per class (negative first), read back
    with the label taken from the file."""
    lines = _class_lines(fx.texts(spark, sf))
    files = {}
    for label, name in ((0, "neg"), (1, "pos")):
        path = scratch_path(spark, f"class-{name}")
        # a single text column, never quoted: each line is written as is
        _plain_csv(lines.where(F.col("label") == label).select("text"), path, header=False,
                   encoding="ISO-8859-1", quote="\u0000", escapeQuotes=False, sep="\u0001")
        files[path] = name
    return fs.scan_class_files(spark, files, encoding="ISO-8859-1").select("text", "label")


def _lexicon_files(spark, sf):
    """The derived lexicon as two word lists (negative, then positive), each under a ``;`` comment header."""
    lex = sp._lexicon(spark, sf)
    files = {}
    for pol, name in ((-1, "negative"), (1, "positive")):
        path = scratch_path(spark, f"lexicon-{name}")
        header = spark.createDataFrame([(f"; {name} words of the opinion lexicon",), (";",)], "value string")
        body = lex.where(F.col("polarity") == pol).select(F.col("word").alias("value"))
        # at most USEFUL_N words per list: one file, header lines first
        header.unionByName(body).coalesce(1).write.mode("overwrite").text(path)
        files[path] = pol
    return files


@register("scan_lexicon", fx.with_views(["texts"], """
    SELECT word, max(polarity) AS polarity FROM lexicon GROUP BY word""", sp._CTES))
def q_scan_lexicon(spark, sf):
    """Word lists without their comments; a word in both lists takes the later one."""
    # derived words are arbitrary tokens (digits, accents, apostrophes): one per line
    return fs.scan_lexicon(spark, _lexicon_files(spark, sf), pattern=r"\S+")


@register("scan_lexicon_comments", fx.with_views(["texts"], """
    SELECT word, CAST(max(polarity) AS INTEGER) AS polarity FROM (
      SELECT word, polarity FROM lexicon UNION ALL
      SELECT unnest([';', name, 'words', 'of', 'the', 'opinion', 'lexicon']), polarity FROM (VALUES ('negative', -1), ('positive', 1)) v(name, polarity))
    GROUP BY word""", sp._CTES))
def q_scan_lexicon_comments(spark, sf):
    """Word lists scanned with their comment lines (S6 with include_comments)."""
    return fs.scan_lexicon(spark, _lexicon_files(spark, sf), include_comments=True, pattern=r"\S+")


_REPORT_SQL = fx.with_views(["ratings", "items"], """
    SELECT 'cluster_sizes' AS section, cluster, size, rank, CAST(NULL AS VARCHAR) AS genre, CAST(NULL AS BIGINT) AS n
    FROM sizes
    UNION ALL
    SELECT 'genre_counts', NULL, NULL, NULL, genre, n FROM genres""", rp._CTES)


@register("report_table", _REPORT_SQL)
def q_report_table(spark, sf):
    """Cluster sizes and the genre counts of the largest cluster stacked into
    one tagged table, written as Parquet and read back."""
    sizes = rp.q_cluster_sizes(spark, sf)
    genres = rp.q_genre_counts(spark, sf)
    path = scratch_path(spark, "report")
    fs.report_table({"cluster_sizes": sizes, "genre_counts": genres}).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@register("cached_scan", wp._sql("""
    SELECT country, count(*) AS requests, count(DISTINCT host) AS hosts FROM parsed GROUP BY country"""))
def q_cached_scan(spark, sf):
    """Parsed log persisted once and read by two aggregations (requests per
    country, distinct hosts per country)."""
    p = fs.cached_scan(wp._parsed(spark, sf).select("country", "host"))
    requests = p.groupBy("country").agg(F.count(F.lit(1)).alias("requests"))
    hosts = p.groupBy("country").agg(F.count_distinct("host").alias("hosts"))
    return requests.join(hosts, "country")

