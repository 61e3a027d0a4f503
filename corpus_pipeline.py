"""A corpus pipeline of the training-text operators: each stage takes what its predecessor kept.

1. ``language``: documents without a recognisable language go (null texts, texts without a letter, and those whose
   best language has a posterior under one half). Where no row is labelled, so that no language can be learned, all
   texts with a letter stay.
2. ``near_duplicates``: of each group of near copies the document with the smallest doc_id stays; of rows with one
   doc_id and text a single one; rows with one doc_id and different texts are documents of their own; rows with a null
   doc_id stay.
3. ``decontamination``: documents that hold a benchmark item go.
4. ``pii``: personal data in the texts is replaced by its kind in brackets, and n_chars follows.
5. ``bpe``: the texts as token ids, with digests of the ids and of the bytes decoded from them.

Every stage but the last returns the columns of its input. Nulls in other columns, empty texts and an empty table
pass through as each operator's docstring defines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.llm import bpe, decontaminate, langid, near_dups, pii
from kestrel.llm.batches import append, fresh, struct, table
from kestrel.llm.queries import bpe_files, held_out
from kestrel.llm.tables import keep, not_among
from kestrel.session import result_of

MIN_SCORE = 0.5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a recognised language; fitted on those of ``docs`` that aren't held out."""
    model = langid.fit(docs.where(~held_out()))
    if model.n_languages:
        out, lang, score = langid.identified(docs, model)
        return out.where((F.col(lang) != langid.UNKNOWN) & (F.col(score) >= MIN_SCORE)).select(*docs.columns)
    lettered = fresh(docs, "__lettered")[0]
    make = lambda: lambda text: (any(True for _ in langid.text_bins(text or "")),)
    return append(docs, ["text"], make, struct(f"{lettered} boolean")).where(lettered).drop(lettered)


def _one_of_each_text(docs: DataFrame, several: DataFrame) -> DataFrame:
    """``near_duplicates`` where some doc_ids (``several``) have different texts: there each text has an id of its own."""
    row = docs.select("doc_id", "text", F.struct(*docs.columns).alias("row"))
    keyed = keep(row.join(several.withColumn("many", F.lit(True)), "doc_id", "left").select(
        F.when(F.col("many"), F.xxhash64("doc_id", "text")).otherwise(F.col("doc_id").cast("long")).alias("id"), "text", "row"), "keyed")
    found = result_of(docs.sparkSession, lambda: near_dups.near_duplicates(keyed.select(F.col("id").alias("doc_id"), "text")).where(
        "doc_id is not null").select(F.col("doc_id").alias("id"), "component_id").distinct())
    ids = keyed.select("id", F.col("row.doc_id").alias("doc_id")).distinct()
    first = ids.join(found, "id").groupBy("component_id").agg(F.min(F.struct("doc_id", "id")).alias("first")).select("first.id")
    once = keyed.join(first, "id", "left_semi").groupBy("id").agg(F.min("row").alias("row"))
    return keyed.where("id is null").select("row.*").unionByName(once.select("row.*"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    several = docs.where("doc_id is not null").select("doc_id", F.xxhash64("text").alias("h")).groupBy("doc_id").agg(
        F.min("h").alias("lo"), F.max("h").alias("hi")).where("lo < hi")
    several = keep(several.select("doc_id"), "several")
    if several.head(1):
        return _one_of_each_text(docs, several)
    # what the operator writes on its way, copies of texts among it, goes as soon as the groups are written
    found = result_of(spark, lambda: near_dups.near_duplicates(docs).where("doc_id is not null").groupBy("doc_id").agg(
        F.max("kept").alias("kept"), F.count(F.lit(1)).alias("n")))
    out = not_among(docs, keep(found.where("not kept").select("doc_id"), "others"), "doc_id")
    repeated = found.where("kept and n > 1").select("doc_id")
    if not repeated.head(1):
        return out
    # rows that share a doc_id: one of them, the same one whatever the order they come in
    once = out.join(repeated, "doc_id", "left_semi").groupBy("doc_id").agg(F.min(F.struct(*docs.columns)).alias("row")).select("row.*")
    return out.join(repeated, "doc_id", "left_anti").select(*docs.columns).unionByName(once.select(*docs.columns))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.without_items(docs, table(spark, sf_dir, "benchmark"))


def redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their personal data replaced."""
    return pii.redact(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, token_ids, ids_sha256, decoded_sha256) of every document."""
    files = bpe_files()
    return bpe.encode_and_decode(docs, *files).select(
        "doc_id", F.expr("octet_length(token_ids) div 4").alias("n_tokens"), "token_ids",
        F.sha2("token_ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
          ("pii", redaction), ("bpe", tokens)]

#: Naive Bayes, the bootstrapped patterns and byte-pair merges have no SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what each keeps is written and read again as the next one's input."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
