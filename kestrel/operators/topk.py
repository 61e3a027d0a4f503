"""The exact best k documents of each query (R1-R5), without a shuffle of (query, document) pairs.

1. *Start*: the documents with the query's rarest terms are scored in full, then a ``SHARE`` of all documents; the k-th best of
   either is a threshold that no document of the result lies below.
2. *Bounds*: a document of a band can't score more than the sum, over the query's terms, of the term's weight times the
   greatest share of its blocks. Blocks whose bounds together stay below the threshold can't make a result by themselves; the
   ones with the most postings for what they add are set aside so (MaxScore, Turtle and Flood 1995, by blocks). If all blocks of
   a band fall short, its documents are skipped altogether.
3. *Scores*: the postings of query terms are dealt by document, so that the task that holds a document scores it in full for
   all queries (the query terms go to every task, ``BLOCK`` of them at a time). What lies below the threshold ends there.
4. What is left is ranked.

Queries with fewer than k scored documents in the start have no threshold: all their documents are ranked. Scores are
sums of non-negative shares, and comparisons leave room for rounding, so that the result equals that of scoring everything.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kestrel.operators.index import Index, by_salt, level, postings_of
from kestrel.operators.retrieval import rank_top
from kestrel.operators.retrieval import score as score_all
from kestrel.session import materialise

#: Documents of the start, as a multiple of k.
START = 4
#: One in so many documents gives a second threshold: about k * SHARE documents of a query lie above it.
SHARE = 64
#: Query terms that are sent to every task at a time, about; a query is never cut.
BLOCK = 1 << 17
#: Pairs that one task sums up at a time, about.
PAIRS = 1 << 21
_SLACK = 2e-9


def weights(index: Index, qterms: DataFrame, weighting: str, mode: str) -> DataFrame:
    """(qid, term, w, df): what a query's term adds to the score of a document for each unit of its share."""
    if weighting == "binary":
        w = F.lit(1.0)
    elif weighting == "tf":
        w = F.col("qtf").cast("double")
    else:
        idf = F.log(F.lit(float(max(index.n_docs, 1))) / F.col("df"))
        w = (F.col("qtf") * F.col("qtf") if mode == "literal" else F.col("qtf")) * idf * idf
    return qterms.join(index.terms, "term").select("qid", "term", w.alias("w"), "df")


def _units(weighting: str) -> Column:
    return F.lit(1.0) if weighting == "binary" else F.col("tf").cast("double")


def _placed(index: Index, terms: DataFrame) -> DataFrame:
    return terms.join(index.segment_terms.select("segment", "term", "fanout"), "term")


def _in_full(index: Index, pairs: DataFrame, terms: DataFrame, postings: DataFrame, weighting: str) -> DataFrame:
    """(qid, docid, score) of the pairs (qid, docid)."""
    wanted = postings.select("term", "docid", "tf").join(pairs, "docid").join(terms.select("qid", "term", "w"), ["qid", "term"])
    added = wanted.groupBy("qid", "docid").agg(F.sum(F.col("w") * _units(weighting)).alias("num"))
    return added.join(index.norms.select("docid", F.col(weighting).alias("norm_sq")), "docid").select(
        "qid", "docid", F.try_divide("num", F.sqrt("norm_sq")).alias("score"))


def start(index: Index, terms: DataFrame, postings: DataFrame, k: int) -> DataFrame:
    """(qid, docid): documents with the rarest terms of each query, terms taken until they have ``START`` * k postings. A term
    with ``SHARE`` times as many starts nothing: a share of all documents gives a threshold for less."""
    w = Window.partitionBy("qid").orderBy("df", "term")  # the terms of one query
    before = F.coalesce(F.sum("df").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rare = terms.withColumn("before", before).where((F.col("before") < START * k) & (F.col("df") <= SHARE * START * k))
    return postings.select("term", "docid").join(F.broadcast(rare.select("qid", "term")), "term").select("qid", "docid").distinct()


def thresholds(scores: DataFrame, k: int) -> DataFrame:
    """(qid, least): no document of a query's best k scores less; queries without k scores are missing."""
    ranked = rank_top(scores.where("score is not null"), k).where(F.col("rank") == k)
    return ranked.select("qid", (F.col("score") * (1 - _SLACK) - _SLACK).alias("least"))


def essential(index: Index, terms: DataFrame, least: DataFrame, weighting: str) -> DataFrame:
    """(qid, term, w, band, level, rest, least): the blocks whose postings form pairs; ``rest`` bounds what the others add."""
    # the semi join moves below the aggregation: only the postings of these terms are read into blocks
    blocks = index.blocks.join(terms.select("term").distinct(), "term", "left_semi").select(
        "term", "band", "level", "n", F.col(weighting).alias("share"))
    if weighting == "binary":  # counts don't matter: one block for each band
        blocks = blocks.groupBy("term", "band").agg(F.lit(None).cast("int").alias("level"), F.sum("n").alias("n"), F.max("share").alias("share"))
    bounds = terms.join(blocks, "term").join(least, "qid", "left").select(
        "qid", "term", "w", "band", "level", "n", (F.col("w") * F.col("share")).alias("bound"), F.coalesce("least", F.lit(-1.0)).alias("least"))
    # the blocks of one term in one band, from the least bound on: setting aside one more raises what the term can add
    own = Window.partitionBy("qid", "band", "term").orderBy("bound", "level")
    steps = bounds.withColumn("added", F.col("bound") - F.lag("bound", 1, 0.0).over(own))
    steps = steps.withColumn("cost", F.max(F.col("added") / F.col("n")).over(own.rowsBetween(Window.unboundedPreceding, 0)))
    # the blocks of one query in one band; those with most postings for what they add are set aside first
    w = Window.partitionBy("qid", "band").orderBy("cost", "term", "bound", "level")
    sums = steps.withColumn("sum", F.sum("added").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    aside = F.col("sum") < F.col("least")
    rest = F.max(F.when(aside, F.col("sum")).otherwise(0.0)).over(Window.partitionBy("qid", "band"))
    return sums.withColumn("rest", rest).where(~aside).select("qid", "term", "w", "band", "level", "rest", "least")


def candidates(index: Index, kept: DataFrame, postings: DataFrame, weighting: str) -> DataFrame:
    """(qid, docid, num, rest, least): the pairs that the essential terms form, with the sum of their shares so far. ``best``
    scores the documents of their bands in full at once instead; this tells how many pairs the bounds can't rule out."""
    by = ["band"] if weighting == "binary" else ["band", "level"]
    return by_salt(_placed(index, kept.drop(*{"level"}.difference(by))), postings.withColumn("level", level()), *by).groupBy("qid", "docid").agg(
        F.sum(F.col("w") * _units(weighting)).alias("num"), F.first("rest").alias("rest"), F.first("least").alias("least"))


def searched(index: Index, terms: DataFrame) -> DataFrame:
    """The postings of these terms, written: a search reads them several times."""
    return materialise(postings_of(index, terms).join(terms.select("term").distinct(), "term", "left_semi"), "searched")


def scored(index: Index, terms: DataFrame, postings: DataFrame, weighting: str, least: DataFrame, n_queries: int) -> DataFrame:
    """(qid, docid, score) of all documents that share a term with a query and reach its threshold: ``least`` is (qid, least)
    or (qid, band, least), with which only documents of these bands count. ``terms`` are sent to every task."""
    n = max(int(postings.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-index.n_docs * n_queries // PAIRS))
    dealt = postings.select("docid", "term", "tf", "band").repartition(n, "docid")
    found = dealt.join(F.broadcast(terms.select("qid", "term", "w")), "term")
    by = [c for c in least.columns if c != "least"]
    num = found.join(F.broadcast(least), by).groupBy("docid", "qid", "least").agg(F.sum(F.col("w") * _units(weighting)).alias("num"))
    # a task's documents are few and its pairs many: the norms are the side to hash
    norms = index.norms.select("docid", F.col(weighting).alias("norm_sq")).hint("shuffle_hash")
    out = num.join(norms, "docid").select("qid", "docid", F.try_divide("num", F.sqrt("norm_sq")).alias("score"), "least")
    return out.where(F.coalesce("score", F.lit(0.0)) >= F.col("least")).select("qid", "docid", "score")


def _best_of(index: Index, terms: DataFrame, postings: DataFrame, weighting: str, k: int) -> DataFrame:
    qids = materialise(terms.select("qid").distinct(), "queries")
    n_queries = qids.count()
    every = lambda least: qids.join(least, "qid", "left").select("qid", F.coalesce("least", F.lit(-1.0)).alias("least"))
    few = materialise(start(index, terms, postings, k), "start")
    first = thresholds(_in_full(index, few, terms, postings, weighting), k)
    some = postings.where(F.pmod(F.xxhash64("docid"), F.lit(SHARE)) == 0)
    least = materialise(every(first), "first")
    second = thresholds(scored(index, terms, some, weighting, least, -(-n_queries // SHARE)), k)
    least = materialise(every(least.union(second).groupBy("qid").agg(F.max("least").alias("least"))), "least")
    bands = essential(index, terms, least, weighting).select("qid", "band", "least").distinct()
    return rank_top(scored(index, terms, postings, weighting, bands, n_queries), k)


def best(index: Index, qterms: DataFrame, weighting: str = "tfidf", k: int = 10, mode: str = "fixed") -> DataFrame:
    """(qid, docid, score, rank)."""
    if weighting == "binary" and mode == "literal":
        return _best_literal(index, qterms, k)
    terms = materialise(weights(index, qterms, weighting, mode), "query-terms")
    postings = searched(index, terms)
    blocks, out = max(1, -(-terms.count() // BLOCK)), None
    for block in range(blocks):
        part = terms.where(F.pmod(F.xxhash64("qid"), F.lit(blocks)) == block) if blocks > 1 else terms
        found = _best_of(index, part, postings, weighting, k)
        out = found if out is None else out.unionByName(found)
    return out


#: Shares of the documents, in the order of their ids, that the literal binary search has looked at after each step.
STEPS = (1 / 64, 1 / 8, 1.0)


def _best_literal(index: Index, qterms: DataFrame, k: int) -> DataFrame:
    """The literal binary score is 1, 0 or nothing, and ties go to the smaller docid, so that the k smallest docids with
    score 1 are the result: documents are searched in steps in the order of their ids, for the queries that need more."""
    if dict(index.norms.dtypes)["docid"] == "string":  # no quantiles of strings
        return rank_top(score_all(index, qterms, "binary", "literal"), k)
    cuts = index.norms.agg(F.percentile_approx("docid", F.array(*[F.lit(s) for s in STEPS[:-1]]), F.lit(10_000)).alias("q")).first().q
    out, left = None, qterms
    for cut in [*(cuts or []), None]:
        part = index if cut is None else Index(index.postings.where(F.col("docid") <= F.lit(cut)), index.segment_terms, index.terms, index.norms, index.n_docs)
        found = materialise(rank_top(score_all(part, left, "binary", "literal"), k), "literal")
        done = found.where("score = 1").groupBy("qid").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == k).select("qid") if cut is not None else found.select("qid").distinct()
        kept = found.join(done, "qid", "left_semi")
        out = kept if out is None else out.unionByName(kept)
        left = left.join(done, "qid", "left_anti")
    return out
