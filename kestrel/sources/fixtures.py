"""Deterministic views over the generated Parquet tables.

Each view stands for one input of the original analyses (web log, ratings,
claims table, review texts, ...). Every view is defined twice with the same
meaning: as a DataFrame here and as SQL text in ``FIXTURE_SQL`` (DuckDB
dialect), which the oracle queries put in front of their own SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.functions import hash_bucket, word_tokens

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ---------------------------------------------------------------- web log

# fixed values: domain suffix by user_id % 4, as the fixture defines it
DOMAIN_SUFFIXES = [".ac.jp", ".ac.uk", ".edu", ".com"]


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One Common Log Format line per event:
    ``host - - [dd/MMM/yyyy:HH:mm:ss +0000] "GET /type HTTP/1.0" status bytes``."""
    e = table(spark, sf_dir, "events")
    uid = F.col("user_id")
    suffix = (F.when(uid % 4 == 0, DOMAIN_SUFFIXES[0]).when(uid % 4 == 1, DOMAIN_SUFFIXES[1])
              .when(uid % 4 == 2, DOMAIN_SUFFIXES[2]).otherwise(DOMAIN_SUFFIXES[3]))
    host = F.concat(F.lit("n"), uid.cast("string"), F.lit(".d"), (uid % 23).cast("string"), suffix)
    tail = F.when(F.col("event_type") == "error", F.lit("404 -")).otherwise(
        F.concat(F.lit("200 "), F.floor(F.col("value") * 100).cast("string")))
    value = F.concat(host, F.lit(" - - ["), F.date_format("ts", "dd/MMM/yyyy:HH:mm:ss"),
                     F.lit(" +0000] \"GET /"), F.col("event_type"), F.lit(" HTTP/1.0\" "), tail)
    return e.select(value.alias("value"))


# ---------------------------------------------------------------- ratings

def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("user_id"),
        F.get_json_object("props", "$.k").cast("int").alias("item"),
        (F.lit(1) + F.floor(F.col("value") * 100) % 5).cast("double").alias("rating"),
        F.col("ts"),
        F.col("event_id"),
    )


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").alias("item"),
        F.concat(F.regexp_replace("p_name", " ", "|"), F.lit("|"), F.col("p_type")).alias("genres"),
    )


# ---------------------------------------------------------------- numeric / claims

def wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = table(spark, sf_dir, "embeddings")
    return v.select("vec_id", (F.col("label") >= 5).cast("int").alias("label"),
                    F.col("embedding").alias("features"))


CLAIM_CATEGORIES = ["o_orderpriority", "p_brand", "p_type", "l_linestatus", "o_orderstatus"]
CLAIM_NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "p_retailprice", "o_totalprice"]


def claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Claims-like table: ids, string categories with planted ``?`` tokens,
    numeric variables and a zero-inflated ``claim_amount``."""
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders")
    p = table(spark, sf_dir, "part")
    j = li.join(o, li.l_orderkey == o.o_orderkey).join(p, li.l_partkey == p.p_partkey)
    return j.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("row_id"),
        F.col("o_custkey").alias("household_id"),
        F.year("o_orderdate").alias("calendar_year"),
        F.when(F.col("l_orderkey") % 3 == 0, F.lit("?")).otherwise(F.col("o_orderpriority")).alias("o_orderpriority"),
        F.when(F.col("l_orderkey") % 17 == 0, F.lit("?")).otherwise(F.col("p_brand")).alias("p_brand"),
        "p_type", "l_linestatus", "o_orderstatus", "p_size",
        *CLAIM_NUMERIC,
        F.when((F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 1),
               F.col("l_extendedprice") * F.col("l_discount")).otherwise(F.lit(0.0)).alias("claim_amount"),
    )


# ---------------------------------------------------------------- texts

def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, text, label, split): labelled documents, ~10 % test by md5 bucket."""
    d = table(spark, sf_dir, "documents")
    lab = table(spark, sf_dir, "labels")
    return d.join(lab, "doc_id").select(
        "doc_id", "text", F.col("quality").alias("label"),
        F.when(hash_bucket("doc_id") == 0, "test").otherwise("train").alias("split"))


# fixed values: topic label by language
TOPIC_LABELS = {"en": 1, "fr": 2, "de": 3, "es": 4}


def topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    lab = F.lit(None).cast("int")
    for lang, number in TOPIC_LABELS.items():
        lab = F.when(F.col("lang") == lang, number).otherwise(lab)
    return (d.select("doc_id", "text", lab.alias("label"),
                     F.when(hash_bucket("doc_id") == 0, "test").otherwise("train").alias("split"))
            .where(F.col("label").isNotNull()))


# ---------------------------------------------------------------- retrieval

def queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(qid, text): every benchmark passage is a query, whole."""
    b = table(spark, sf_dir, "benchmark")
    return b.select(F.col("item_id").alias("qid"), "text")


def gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(qid, docid) where the document contains the whole passage."""
    from kestrel.operators.retrieval import containing_documents

    return containing_documents(queries(spark, sf_dir), table(spark, sf_dir, "documents"))


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings")


def word_vector_expr(word_col: str = "word", dim: int = 8):
    """8 floats in [0,1] from the md5 bytes of the word (same in DuckDB)."""
    h = F.md5(F.col(word_col))
    return F.array(*[(F.conv(F.substr(h, F.lit(2 * i + 1), F.lit(2)), 16, 10).cast("int") / 255.0).cast("float")
                     for i in range(dim)])


def word_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(word, vector) for every distinct word of the documents."""
    t = table(spark, sf_dir, "documents")
    words = t.select(F.explode(word_tokens("text", lower=True)).alias("word")).distinct()
    return words.select("word", word_vector_expr().alias("vector"))


# ---------------------------------------------------------------- SQL twins

FIXTURE_SQL = {
    "log_lines": """
        SELECT 'n' || CAST(user_id AS VARCHAR) || '.d' || CAST(user_id % 23 AS VARCHAR)
               || CASE user_id % 4 WHEN 0 THEN '.ac.jp' WHEN 1 THEN '.ac.uk' WHEN 2 THEN '.edu' ELSE '.com' END
               || ' - - [' || strftime(ts, '%d/%b/%Y:%H:%M:%S') || ' +0000] "GET /' || event_type || ' HTTP/1.0" '
               || CASE WHEN event_type = 'error' THEN '404 -'
                       ELSE '200 ' || CAST(CAST(floor(value * 100) AS BIGINT) AS VARCHAR) END AS value
        FROM events""",
    "ratings": """
        SELECT user_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS item,
               CAST(1 + CAST(floor(value * 100) AS BIGINT) % 5 AS DOUBLE) AS rating, ts, event_id
        FROM events""",
    "items": """
        SELECT p_partkey AS item, replace(p_name, ' ', '|') || '|' || p_type AS genres FROM part""",
    "wide": """
        SELECT vec_id, CAST(label >= 5 AS INTEGER) AS label, embedding AS features FROM embeddings""",
    "claims": """
        SELECT l_orderkey * 10 + l_linenumber AS row_id, o_custkey AS household_id,
               CAST(year(o_orderdate) AS INTEGER) AS calendar_year,
               CASE WHEN l_orderkey % 3 = 0 THEN '?' ELSE o_orderpriority END AS o_orderpriority,
               CASE WHEN l_orderkey % 17 = 0 THEN '?' ELSE p_brand END AS p_brand,
               p_type, l_linestatus, o_orderstatus, p_size,
               l_quantity, l_extendedprice, l_discount, l_tax, p_retailprice, o_totalprice,
               CASE WHEN l_returnflag = 'R' AND l_linenumber = 1 THEN l_extendedprice * l_discount
                    ELSE 0.0 END AS claim_amount
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey""",
    "texts": """
        SELECT d.doc_id, d.text, l.quality AS label,
               CASE WHEN ('0x' || substr(md5(CAST(d.doc_id AS VARCHAR)), 1, 8))::BIGINT % 10 = 0
                    THEN 'test' ELSE 'train' END AS split
        FROM documents d JOIN labels l ON d.doc_id = l.doc_id""",
    "topics": """
        SELECT doc_id, text, CASE lang WHEN 'en' THEN 1 WHEN 'fr' THEN 2 WHEN 'de' THEN 3 WHEN 'es' THEN 4 END AS label,
               CASE WHEN ('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8))::BIGINT % 10 = 0
                    THEN 'test' ELSE 'train' END AS split
        FROM documents WHERE lang IN ('en', 'fr', 'de', 'es')""",
    "queries": "SELECT item_id AS qid, text FROM benchmark",
    "gold": """
        SELECT b.item_id AS qid, d.doc_id AS docid
        FROM benchmark b JOIN documents d ON contains(d.text, b.text)""",
}

# Views that other views depend on (emitted first in a WITH list).
FIXTURE_DEPS = {"gold": []}


def with_views(views: list[str], body: str, ctes: list[tuple[str, str]] | None = None) -> str:
    """Prefix ``body`` with a WITH list holding the fixture views and extra CTEs."""
    parts = [f"{v} AS ({FIXTURE_SQL[v]})" for v in views]
    parts += [f"{name} AS ({sql})" for name, sql in (ctes or [])]
    if not parts:
        return body
    return "WITH " + ",\n".join(parts) + "\n" + body
