"""The retrieval index (S8, A12, A13, J5): immutable segments of postings, and statistics over all of them.

A segment holds the postings (segment, term, docid, tf, band) of some documents, a document's in one file and each file sorted
by term, with one row of each term beside them (segment, term, df, fanout). A term with more than ``SALT_ROWS`` postings is
dealt into ``fanout`` salts by document when the index is opened, so that a join on (segment, term, salt) never brings all
postings of a frequent term to one task. ``band`` is the class of the document's length.

Statistics are merged over the segments when an index is opened: document frequencies add up, N is the number of documents,
and the norms (which depend on every document through idf) and the blocks are computed anew from the stored postings. A
*block* is a term's postings within a band and a level of their counts, with the greatest share that any of them can add to a
score: what lets a search skip documents (``topk``). Adding documents writes one more segment and never touches the others; ``compact`` joins segments.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kestrel.session import scratch_path

#: Postings of a term in one salt, about.
SALT_ROWS = 1 << 18
#: Most terms whose idf is sent to every task for the norms; the postings of the others are joined by term.
COMMON = 1 << 18
#: Bands of document lengths, and levels of term counts, per doubling.
BANDS = 8
LEVELS = 2
WEIGHTINGS = ("binary", "tf", "tfidf")


@dataclass(frozen=True)
class Index:
    """``postings`` (segment, term, salt, docid, tf, band), ``segment_terms`` (segment, term, df, fanout), ``terms`` (term, df),
    ``norms`` (docid, band, binary, tf, tfidf: squared norms), the number of documents and the segments' folders; ``blocks``
    (term, band, level, n, and for each weighting the greatest weight of a posting divided by its document's norm)."""

    postings: DataFrame
    segment_terms: DataFrame
    terms: DataFrame
    norms: DataFrame
    n_docs: int
    segments: tuple[str, ...] = field(default=())

    @cached_property
    def blocks(self) -> DataFrame:
        """Not written: a search computes those of its own terms, whose postings are few among all."""
        return _blocks(self.postings, self.norms)


def _salt(fanout: Column) -> Column:
    return F.pmod(F.xxhash64("docid"), fanout).cast("int")


def level(tf: str = "tf") -> Column:
    return F.floor(LEVELS * F.log2(tf)).cast("int")


def _write_segment(postings: DataFrame, number: int, salt_rows: int) -> str:
    """Write (term, docid, tf) as segment ``number`` and return its folder."""
    spark, path = postings.sparkSession, scratch_path(postings.sparkSession, f"segment-{number}")
    # no shuffle where the postings come grouped by document, as from ``build_postings``
    n_terms = F.count(F.lit(1)).over(Window.partitionBy("docid"))
    postings.where("docid is not null").select(
        F.lit(number).alias("segment"), "term", "docid", "tf", F.floor(BANDS * F.log2(n_terms)).cast("int").alias("band")
    ).sortWithinPartitions("term", "docid").write.parquet(f"{path}/postings")
    spark.read.parquet(f"{path}/postings").groupBy("term").agg(F.count(F.lit(1)).alias("df")).select(
        F.lit(number).alias("segment"), "term", "df", F.ceil(F.col("df") / salt_rows).cast("int").alias("fanout")).write.parquet(f"{path}/terms")
    return path


def _read(spark: SparkSession, paths: tuple[str, ...], table: str) -> DataFrame:
    return spark.read.parquet(*[f"{p}/{table}" for p in paths])


def open_index(spark: SparkSession, segments: tuple[str, ...]) -> Index:
    """The index over these segments, with statistics merged over all of them."""
    stored, segment_terms = _read(spark, segments, "postings"), _read(spark, segments, "terms")
    # there is at most one such term for ``salt_rows`` postings
    frequent = F.broadcast(segment_terms.where("fanout > 1").select("segment", "term", "fanout"))
    postings = stored.join(frequent, ["segment", "term"], "left").select(
        "segment", "term", _salt(F.coalesce("fanout", F.lit(1))).alias("salt"), "docid", "tf", "band")
    terms = segment_terms.select("term", "df") if len(segments) == 1 else segment_terms.groupBy("term").agg(F.sum("df").alias("df"))
    n = n_documents(stored)
    path = scratch_path(spark, "index-statistics")
    _norms(stored, terms, n).write.parquet(f"{path}/norms")
    norms = spark.read.parquet(f"{path}/norms")
    return Index(postings, segment_terms, terms, norms, n, segments)


def _norms(stored: DataFrame, terms: DataFrame, n: int) -> DataFrame:
    """(docid, band, binary, tf, tfidf). The postings of common terms, most of all postings, get their idf where they are and
    are summed by document in the task that reads them; only those of rare terms are shuffled, and none of these is frequent."""
    idf = terms.select("term", "df", F.log(F.lit(float(max(n, 1))) / F.col("df")).alias("idf"))
    least = (terms.agg(F.sum("df")).first()[0] or 0) / COMMON  # at most COMMON terms have more postings
    common = F.broadcast(idf.where(F.col("df") > least).select("term", "idf"))
    square = F.sum((F.col("tf") * F.col("idf")) * (F.col("tf") * F.col("idf")))
    known = stored.join(common, "term", "left")
    own = known.groupBy("docid").agg(
        F.first("band").alias("band"), F.count(F.lit(1)).cast("double").alias("binary"),
        F.sum(F.col("tf") * F.col("tf")).cast("double").alias("tf"), square.alias("common"))
    rare = known.where("idf is null").select("term", "docid", "tf").join(idf.where(F.col("df") <= least).select("term", "idf"), "term")
    rare = rare.groupBy("docid").agg(square.alias("rare"))
    tfidf = F.coalesce("common", F.lit(0.0)) + F.coalesce("rare", F.lit(0.0))
    return own.join(rare, "docid", "left").select("docid", "band", "binary", "tf", tfidf.alias("tfidf"))


def _blocks(postings: DataFrame, norms: DataFrame) -> DataFrame:
    whole = postings.join(norms.select("docid", *WEIGHTINGS).withColumnsRenamed({w: f"norm_{w}" for w in WEIGHTINGS}), "docid")
    share = lambda value, norm: F.coalesce(F.max(F.try_divide(value, F.sqrt(F.col(f"norm_{norm}")))), F.lit(0.0)).alias(norm)
    return whole.groupBy("term", "band", level().alias("level")).agg(
        F.count(F.lit(1)).alias("n"), share(F.lit(1.0), "binary"), share(F.col("tf").cast("double"), "tf"),
        share(F.col("tf").cast("double"), "tfidf"))


def write_index(postings: DataFrame, salt_rows: int = SALT_ROWS) -> Index:
    """An index of one segment with these (term, docid, tf) postings, under the session's checkpoint folder."""
    return open_index(postings.sparkSession, (_write_segment(postings, 0, salt_rows),))


def add_documents(index: Index, postings: DataFrame, salt_rows: int = SALT_ROWS) -> Index:
    """``index`` with the postings of further documents as one more segment. A docid belongs to one segment only."""
    return open_index(postings.sparkSession, (*index.segments, _write_segment(postings, len(index.segments), salt_rows)))


def compact(index: Index, salt_rows: int = SALT_ROWS) -> Index:
    """The same documents in a single segment, written from the stored postings."""
    return write_index(index.postings.select("term", "docid", "tf"), salt_rows)


def n_documents(postings: DataFrame) -> int:
    """Collection size N = distinct documents in the index."""
    return postings.select("docid").distinct().count()


def by_salt(terms: DataFrame, postings: DataFrame, *more: str) -> DataFrame:
    """``terms`` (segment, term, fanout, ...) joined with their postings: a row of a frequent term meets its postings in as
    many places as the term has salts (J5). ``more`` names further columns to join on."""
    spread = terms.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("fanout") - 1))).drop("fanout")
    return postings.join(spread, ["segment", "term", "salt", *more])


#: Most query terms that are looked up in the files' statistics as a list; beyond them the join alone selects.
LISTED = 1000


def postings_of(index: Index, terms: DataFrame) -> DataFrame:
    """Postings of the index whose files may hold one of ``terms``; a filter for the scan, not an exact one."""
    named = [r.term for r in terms.select("term").distinct().limit(LISTED + 1).collect()]
    return index.postings.where(F.col("term").isin(named)) if len(named) <= LISTED else index.postings


def hits(index: Index, qterms: DataFrame) -> DataFrame:
    """(qid, term, docid, qtf, tf): every posting of every query term."""
    placed = qterms.join(index.segment_terms.select("segment", "term", "fanout"), "term")
    return by_salt(placed, postings_of(index, qterms)).select("qid", "term", "docid", "qtf", "tf")
