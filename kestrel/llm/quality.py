"""Quality rules as a short-circuit cascade, in Spark expressions only.

``measure`` computes the base counts of every whole text; ``order_rules`` estimates, on a bounded sample, what
each rule costs and how many of the rows still left it rejects, and orders the rules by rejections per cost;
``verdict`` evaluates them in that order in one CASE, which stops at a row's first rejection. The order changes
the time only: a row is kept if no rule rejects it, in whichever order.

Words are runs of anything but the ASCII white space. Windows of five words are compared by 64-bit hashes; only
texts with a repeated window are sorted, so a text costs n log n at most. A null or empty text has no words and
fails the base check; repeated rows are judged each; extra columns are dropped; an empty table gives an empty one
and leaves the rules in the order given.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.llm.tables import keep

MIN_WORDS = 10
MAX_REPEATED_PCT = 20
#: Rows that rule costs and selectivities are estimated on.
SAMPLE_ROWS = 2000

_WHITE = r"[\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Rule:
    """``rejects`` is an expression over the columns of ``measure``."""

    name: str
    rejects: Column


def _count(pattern_of_others: str) -> Column:
    """Number of code points of the text outside the pattern."""
    return F.length(F.regexp_replace("text", pattern_of_others, ""))


def default_rules() -> list[Rule]:
    words, h = F.col("n_words"), F.col("_hashes")
    lettered = F.size(F.filter(F.col("_words"), lambda w: w.rlike(r"\p{L}")))
    stutter = F.size(F.filter(h, lambda x, i: F.get(h, i - 1) == x))
    return [
        Rule("symbols", F.col("n_symbols") * 10 > words),
        Rule("repeated_lines", F.col("n_dup_lines") * 100 > F.col("_n_lines") * 40),
        Rule("word_length", ~(F.col("word_chars")).between(words * 2, words * 12)),
        Rule("shouting", _count(r"[^!]+") * 10 > words * 3),
        Rule("capitals", _count(r"\P{Lu}+") * 2 > _count(r"\P{L}+")),
        Rule("no_letters", lettered * 2 < words),
        Rule("stutter", stutter * 10 > words * 2),
    ]


def measure(docs: DataFrame) -> DataFrame:
    """doc_id, text, the counts n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, and the
    intermediate columns (with a leading underscore) that rules may use."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    d = d.withColumns({
        "_words": F.array_remove(F.split("text", _WHITE), ""),
        "_lines": F.filter(F.split("text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")),
    })
    d = d.withColumns({
        "n_words": F.size("_words").cast("long"),
        "word_chars": F.length(F.array_join("_words", "")).cast("long"),
        "n_symbols": _count(r"[^#*$%&|<>]+").cast("long"),
        "_n_lines": F.size("_lines").cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "_hashes": F.transform("_words", lambda w: F.xxhash64(w)),
    }).drop("_lines")
    two = F.zip_with("_hashes", F.slice("_hashes", F.lit(2), F.greatest(F.size("_hashes"), F.lit(1))), lambda a, b: F.xxhash64(a, b))
    d = d.withColumn("_two", two)
    four = F.zip_with("_two", F.slice("_two", F.lit(3), F.greatest(F.size("_two"), F.lit(1))), lambda a, b: F.xxhash64(a, b))
    d = d.withColumn("_four", four)
    five = F.zip_with("_four", F.slice("_hashes", F.lit(5), F.greatest(F.size("_hashes"), F.lit(1))), lambda a, b: F.xxhash64(a, b))
    # the last four have no full window
    d = d.withColumn("_five", five).withColumn("_five", F.slice("_five", F.lit(1), F.greatest(F.size("_five") - 4, F.lit(0)))).drop("_two", "_four")
    placed = F.sort_array(F.transform("_five", lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
    # the array in front gives the sorted windows a name inside the lambda, so they are sorted once
    starts = F.get(F.transform(F.array(placed), lambda s: F.sort_array(F.transform(
        F.filter(s, lambda e, k: (F.get(s, k - 1)["x"] == e["x"]) | (F.get(s, k + 1)["x"] == e["x"])), lambda e: e["i"]))), F.lit(0))
    covered = lambda p: F.aggregate(  # noqa: E731  each start covers five words, or as many as come before the next
        F.zip_with(p, F.slice(p, F.lit(2), F.greatest(F.size(p), F.lit(1))), lambda a, b: F.coalesce(F.least(b - a, F.lit(5)), F.lit(5))),
        F.lit(0), lambda total, x: total + x)
    repeated = F.get(F.transform(F.array(starts), covered), F.lit(0))
    d = d.withColumn("n_repeat_words", F.when(F.size(F.array_distinct("_five")) == F.size("_five"), F.lit(0)).otherwise(repeated).cast("long")).drop("_five")
    return d.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEATED_PCT))


def order_rules(docs: DataFrame, rules: list[Rule], sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """The rules by rejections per second among the rows that those before them leave, from a sample."""
    n = docs.count()
    if not n or len(rules) < 2:
        return rules
    fraction = min(1.0, sample_rows / n)
    sample = keep(measure(docs.sample(fraction, seed=17) if fraction < 1 else docs), "sample")

    def seconds(*columns) -> float:
        start = time.perf_counter()
        sample.agg(*columns).collect()
        return time.perf_counter() - start

    reads = [F.max("n_words"), F.max(F.length("text")), F.max(F.size("_hashes")), F.max(F.size("_words"))]
    seconds(*reads)
    idle = min(seconds(*reads), seconds(*reads))
    cost = {r.name: max(1e-3, min(seconds(*reads, F.sum(r.rejects.cast("int"))) for _ in range(2)) - idle) for r in rules}
    passed = [bits for bits in sample.where("not base_failed").select(*(F.coalesce(r.rejects, F.lit(False)).alias(r.name) for r in rules)).collect()]
    out, left = [], list(rules)
    while left:
        best = max(left, key=lambda r: sum(row[r.name] for row in passed) / cost[r.name])
        out.append(best)
        left.remove(best)
        passed = [row for row in passed if not row[best.name]]
    return out


def verdict(rules: list[Rule]) -> Column:
    """Name of the first rule that rejects a row, null if none does; later rules aren't evaluated."""
    first = F.when(F.col("base_failed"), F.lit("base"))
    for r in rules:
        first = first.when(r.rejects, F.lit(r.name))
    return first


def judge(docs: DataFrame, rules: list[Rule] | None = None, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, the counts, base_failed, kept and rejected_by (any one of the rejecting rules) of every row."""
    ordered = order_rules(docs, default_rules() if rules is None else rules, sample_rows)
    return (measure(docs).withColumn("rejected_by", verdict(ordered)).withColumn("kept", F.col("rejected_by").isNull())
            .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rejected_by"))
