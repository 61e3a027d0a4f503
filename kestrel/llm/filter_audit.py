"""Filter interaction audit: what each of five filters removes in every order of application, from subset survivors.

A document fails some of the five filters; it survives a set of filters if it fails none of them. So each document is a
32-bit *survival word*: bit ``s`` is set if it survives the set ``s`` of filters. The 32 possible words are a truth table
(``WORDS``). Positional popcounts of the words, by carry-save adders (``Popcount``), give the survivors of every set per
part and label, and every count of every order is a difference of two of them: no order is applied to the documents.

The filters, as failure conditions over whole texts (words are maximal runs of ``[^\\x20\\x09-\\x0D]``, case-sensitive):
A fewer than 50 words; B 100 * distinct words < 65 * words; C 100 * ``[A-Z]`` > 5 * code points; D any of ``#$%&*|``;
E the text is that of a smaller doc_id somewhere in the table, removed or not (by a 128-bit digest).

A null text counts as empty, a null part as the empty string; an empty text fails A only (and E). A row without doc_id
is counted, never fails E and has no label. Rows that share doc_id and text don't fail E by each other; each is counted.
Of several labels of a document one that says quality 1 (toxic 1) is enough; other or missing labels count as neither.
Very long texts are taken whole; extra columns are dropped; an empty table gives no part, so no row. Ties don't occur.
"""

from __future__ import annotations

from hashlib import blake2b
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.llm.batches import lean, map_rows, small_batches, struct

FILTERS = "ABCDE"
ALL = (1 << len(FILTERS)) - 1
#: Survival word of each set of failed filters.
WORDS = np.array([sum(1 << s for s in range(ALL + 1) if not s & failed) for failed in range(ALL + 1)], np.uint32)
_UPPER = bytes(range(ord("A"), ord("Z") + 1))
_MARKS = b"#$%&*|"
#: Parts that a task counts at a time; beyond them it hands on what it has and begins anew.
_GROUPS = 4096


class Popcount:
    """Number of words with each of 32 bits set. ``planes[k]`` holds, for each bit, the binary digit 2^k of its count."""

    def __init__(self):
        self.planes: list[np.uint32] = []

    def add(self, words: np.ndarray) -> None:
        k = 0
        while len(words):
            if k == len(self.planes):
                self.planes.append(np.uint32(0))
            words = np.append(words, self.planes[k])
            carries = []
            while len(words) > 1:
                n = max(1, len(words) // 3)
                a, b = words[:n], words[n:2 * n]
                c = words[2 * n:3 * n] if len(words) > 2 else np.zeros(1, np.uint32)
                odd = a ^ b
                carries.append((a & b) | (odd & c))
                words = np.append(odd ^ c, words[3 * n:])
            self.planes[k] = words[0]
            carried = np.concatenate(carries)
            words, k = carried[carried != 0], k + 1

    def counts(self) -> list[int]:
        return [sum((int(p) >> bit & 1) << k for k, p in enumerate(self.planes)) for bit in range(32)]


def own_failures(text: bytes) -> int:
    """Bits of the filters A to D that the text fails."""
    words = text.split()  # of bytes: at 20 and 09-0D only
    n, points = len(words), len(text.decode("utf-8", "replace"))
    capitals = len(text) - len(text.translate(None, _UPPER))
    marked = len(text.translate(None, _MARKS)) < len(text)
    return (n < 50) | (100 * len(set(words)) < 65 * n) << 1 | (100 * capitals > 5 * points) << 2 | marked << 3


def failures(docs: DataFrame, part: Column) -> DataFrame:
    """(doc_id, part, failed): the set of failed filters of every document, as bits 0 (A) to 4 (E)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(part.cast("string"), F.lit("")).alias("part"),
                       F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))

    def make():
        def one(doc_id, part, text):
            return doc_id, part, blake2b(text, digest_size=16).digest(), own_failures(text)

        return one

    own = map_rows(rows, make, struct("doc_id long, part string, digest binary, failed int"))
    # the first document of each text passes E; as the key holds doc_id too, copies of one text are spread like other rows
    first = own.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).select("digest", "doc_id", F.lit(1).alias("is_first"))
    copy = (F.col("doc_id").isNotNull() & F.col("is_first").isNull()).cast("int")
    return own.join(first, ["digest", "doc_id"], "left").select("doc_id", "part", F.col("failed").bitwiseOR(copy * 16).alias("failed"))


def survivors(failed: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, subset, n, good, toxic): documents that survive each of the 32 sets of filters, all of them and those
    with the labels quality 1 and toxic 1."""
    said = lambda c: F.coalesce(F.max((F.col(c) == 1).cast("int")), F.lit(0))
    labelled = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        (said("quality") + 2 * said("toxic")).alias("label")).where("label > 0")
    small_batches(failed.sparkSession)
    rows = failed.join(labelled, "doc_id", "left").select("part", F.coalesce("label", F.lit(0)).cast("int").alias("label"), "failed")

    def run(batches):
        groups: dict[tuple, Popcount] = {}

        def out():
            return pa.RecordBatch.from_arrays(
                [pa.array([p for p, _ in groups], pa.string()), pa.array([x for _, x in groups], pa.int32()),
                 pa.array([g.counts() for g in groups.values()], pa.list_(pa.int64()))], ["part", "label", "counts"])

        for batch in batches:
            if not batch.num_rows:
                continue
            parts = batch.column(0).dictionary_encode()
            key = parts.indices.to_numpy(zero_copy_only=False).astype(np.int64) * 4 + batch.column(1).to_numpy(zero_copy_only=False)
            words = WORDS[batch.column(2).to_numpy(zero_copy_only=False)]
            order = np.argsort(key, kind="stable")
            keys, starts = np.unique(key[order], return_index=True)
            names = parts.dictionary.to_pylist()
            for k, own in zip(keys.tolist(), np.split(words[order], starts[1:])):
                groups.setdefault((names[k // 4], k % 4), Popcount()).add(own)
            if len(groups) > _GROUPS:
                yield out()
                groups.clear()
        if groups:
            yield out()

    counted = rows.mapInArrow(lean(run), struct("part string, label int, counts array<long>"))
    # the counts of a task are at most 32 rows for each part and label
    return counted.select("part", "label", F.posexplode("counts").alias("subset", "n")).groupBy("part", "subset").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("label").bitwiseAND(1) == 1, F.col("n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("label") >= 2, F.col("n")).otherwise(0)).alias("toxic"))


def orders(surviving: DataFrame) -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley): 600 rows a part."""
    by_subset = surviving.groupBy("part").agg(F.array_sort(F.collect_list(F.struct("subset", "n", "good", "toxic"))).alias("s"))  # 32 each
    named = F.array(*[F.lit("".join(p)) for p in permutations(FILTERS)])
    steps = by_subset.select("part", "s", F.explode(named).alias("filter_order")).select(
        "*", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))).alias("step"))
    steps = steps.withColumn("own", F.expr(f"1 << (instr('{FILTERS}', substr(filter_order, step, 1)) - 1)")).withColumn(
        "before", F.expr(f"aggregate(filter(sequence(1, {len(FILTERS)}), i -> i < step), 0, (m, i) -> m | (1 << (instr('{FILTERS}', substr(filter_order, i, 1)) - 1)))"))
    at = lambda of, what: F.element_at("s", of + 1)[what]
    lost = lambda what: at(F.col("before"), what) - at(F.col("before").bitwiseOR(F.col("own")), what)
    per_step = steps.select(
        "part", "filter_order", "step", "own", at(F.col("before").bitwiseOR(F.col("own")), "n").alias("kept"), lost("n").alias("removed"),
        (at(F.lit(0), "n") - at(F.col("own"), "n") - lost("n")).alias("redundant"),
        (at(F.lit(ALL).bitwiseXOR(F.col("own")), "n") - at(F.lit(ALL), "n")).alias("unique_fails"),
        lost("good").alias("good_lost"), lost("toxic").alias("toxic_lost"))
    # shapley: over the 120 orders of one part and filter
    shapley = per_step.groupBy("part", "own").agg(F.sum("removed").alias("shapley"))
    return per_step.join(shapley, ["part", "own"]).drop("own")


def audit(docs: DataFrame, labels: DataFrame, part: str = "source") -> DataFrame:
    """What each filter removes at each step of each order, per value of the column ``part``."""
    return orders(survivors(failures(docs, F.col(part)), labels))
