"""Benchmark decontamination by pigeonhole edit matching.

A text holds a test item if some stretch of it lies within k edits of the item, k = ``error_rate`` of its
length. The item is cut into k + 1 pieces: k edits leave one piece untouched, so every such stretch holds a
piece exactly, at most k places from where the item puts it. Exact piece hits come from one pass of an
Aho-Corasick automaton; each hit's window is verified with Myers' bit-parallel distance. Texts and items are
lower-cased and runs of white space become one space first.

Test items are taken in blocks of at most ``BLOCK_CHARS`` code points, each broadcast and held against all
rows, so the broadcast doesn't grow with the benchmark. k is lowered where pieces would fall under
``MIN_PIECE`` code points. Items under ``min_chars`` code points match exactly and at word boundaries only, and those of
a single word (without a letter of a script that has no spaces) only as a whole line, as words alone identify nothing.

Items without an id have no row in ``matches``, but ``without_items`` heeds them. Null or empty texts and items match nothing; repeated rows are matched each; extra columns are dropped; an
empty table on either side gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.batches import append, fresh, id_and_text, lean, pieces, struct

ERROR_RATE = 0.05
MIN_PIECE = 12
MIN_CHARS = 24
BLOCK_CHARS = 4_000_000


# Scripts written without spaces: Thai to Myanmar, Khmer, and the ideographs and syllables of East Asia.
_UNSPACED = re.compile(r"[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u2e80-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")


def normalise(text: str) -> str:
    return " ".join(text.lower().split())


def myers(masks: dict[str, int], m: int, text: str) -> tuple[int, int]:
    """Least edit distance between the pattern of these masks and any stretch of ``text``, and its end."""
    full, high = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score = full, 0, m
    best, end = m, 0
    for i, ch in enumerate(text, 1):
        eq = masks.get(ch, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | ~(xh | pv) & full
        mh = pv & xh
        if ph & high:
            score += 1
        elif mh & high:
            score -= 1
        if score < best:
            best, end = score, i
        ph = ph << 1 & full
        mh = mh << 1 & full
        pv = mh | ~(xv | ph) & full
        mv = ph & xv
    return best, end


def _inside_word(text: str, at: int) -> bool:
    return 0 < at < len(text) and text[at - 1].isalnum() and text[at].isalnum()


class Matcher:
    """Automaton over the pieces of a block of items."""

    def __init__(self, items: list[tuple[int, str]], error_rate: float, min_chars: int):
        import ahocorasick

        self.items: dict[str, tuple[list[int], int, dict[str, int]]] = {}
        self.lines: dict[str, list[int]] = {}
        self.min_chars = min_chars
        for item_id, text in items:
            text = normalise(text or "")
            if item_id is None or not text:
                continue
            if len(text) < min_chars and " " not in text and not _UNSPACED.search(text):
                self.lines.setdefault(text, []).append(item_id)
                continue
            if text in self.items:
                self.items[text][0].append(item_id)
                continue
            masks: dict[str, int] = {}
            for i, ch in enumerate(text):
                masks[ch] = masks.get(ch, 0) | 1 << i
            k = max(0, min(int(error_rate * len(text)), len(text) // MIN_PIECE - 1)) if len(text) >= min_chars else 0
            self.items[text] = [item_id], k, masks
        where: dict[str, list[tuple[str, int]]] = {}
        for text, (_, k, _) in self.items.items():
            for j in range(k + 1):
                a, b = j * len(text) // (k + 1), (j + 1) * len(text) // (k + 1)
                where.setdefault(text[a:b], []).append((text, a))
        self.automaton = ahocorasick.Automaton()
        for piece, uses in where.items():
            self.automaton.add_word(piece, (len(piece), uses))
        if where:
            self.automaton.make_automaton()

    def find(self, text: str) -> dict[int, tuple[int, int]]:
        """item_id -> (edits, end in the normalised text) of its best match."""
        found: dict[int, tuple[int, int]] = {}
        if self.lines:
            at = 0
            for line in map(normalise, text.split("\n")):
                for item_id in self.lines.get(line, ()):
                    found.setdefault(item_id, (0, at + len(line)))
                at += len(line) + 1 if line else 0
        if not self.items:
            return found
        text = normalise(text)
        starts: dict[str, set[int]] = {}
        for end, (n, uses) in self.automaton.iter(text):
            for item, offset in uses:
                starts.setdefault(item, set()).add(end + 1 - n - offset)
        for item, places in starts.items():
            ids, k, masks = self.items[item]
            m, best = len(item), (k + 1, 0)
            for start in sorted(places):
                if m < self.min_chars:  # a piece of such an item is the whole of it
                    if not (_inside_word(text, start) or _inside_word(text, start + m)):
                        best = 0, start + m
                        break
                    continue
                if 0 <= start and text.startswith(item, start):
                    got = 0, start + m
                else:
                    low = max(0, start - k)
                    edits, end = myers(masks, m, text[low:start + m + k])
                    got = edits, low + end
                if got < best:
                    best = got
                if not best[0]:
                    break
            if best[0] <= k:
                for item_id in ids:
                    if item_id not in found or best < found[item_id]:
                        found[item_id] = best
        return found


def item_blocks(benchmark: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """The items in blocks of about ``BLOCK_CHARS`` code points, collected one block at a time."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where(F.col("text").isNotNull())
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = max(1, -(-chars // BLOCK_CHARS))
    for i in range(n):
        block = items.where(F.pmod(F.xxhash64("text"), F.lit(n)) == i) if n > 1 else items
        yield [(r[0], r[1]) for r in block.collect()]


def matches(docs: DataFrame, benchmark: DataFrame, error_rate: float = ERROR_RATE, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, item_id, edits, end_char): one row per text and test item it holds, with the fewest edits."""
    schema = struct("doc_id long, item_id long, edits int, end_char long")
    texts = id_and_text(docs)

    def against(block):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches):
            matcher = Matcher(shared.value, error_rate, min_chars)
            for batch in pieces(batches):
                out = [(doc_id, item_id, edits, end) for doc_id, text in zip(*(c.to_pylist() for c in batch.columns))
                       for item_id, (edits, end) in sorted(matcher.find(text).items())]
                if out:
                    d, i, e, p = zip(*out)
                    yield pa.RecordBatch.from_arrays([pa.array(d, pa.int64()), pa.array(i, pa.int64()), pa.array(e, pa.int32()),
                                                      pa.array(p, pa.int64())], schema.fieldNames())

        return texts.mapInArrow(lean(run), schema)

    result = None
    for block in item_blocks(benchmark):
        part = against(block)
        result = part if result is None else result.unionByName(part)
    return result


def without_items(docs: DataFrame, benchmark: DataFrame, error_rate: float = ERROR_RATE, min_chars: int = MIN_CHARS) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose text holds no test item."""
    for block in item_blocks(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast([(item_id or 0, text) for item_id, text in block])

        def make(shared=shared):
            matcher = Matcher(shared.value, error_rate, min_chars)
            return lambda text: (bool(matcher.find(text or "")),)

        holds = fresh(docs, "__holds_item")[0]
        docs = append(docs, ["text"], make, struct(f"{holds} boolean")).where(f"not {holds}").drop(holds)
    return docs
