"""Suffix-array dedup: removal of the bytes of 100-byte strings that also start earlier.

Texts are byte strings in the order of doc_id. Of all suffixes those at content-chosen positions are enough
(``anchors``): a string of 100 bytes repeats only if the suffix at its anchor repeats in its first 32 bytes, with
the same bytes on its left. The steps:

1. Every task lists its anchors, keeps the first of equal stretches and marks the others as repeats; the rest are
   dealt by core hash and sorted. A stretch that equals an earlier one repeats as a whole. Cores with one stretch
   are done. Others go to step 2.
2. Their suffixes are sorted into runs per task, front-coded, and exchanged by core; loser trees that never compare
   a known prefix again merge the runs of a slot. The common-prefix lengths of the merged order, with the bytes to
   the left, tell which windows are equal; all but the first are repeats.
   Cores with more than ``HOT`` different stretches (a passage that very many texts share, each with other words
   around it) aren't gathered: their windows are aggregated by two 64-bit hashes, with partial sums before the shuffle.
3. The intervals found go back to their texts, which are cut once.

Stretches and windows are compared by 64-bit hashes of the bytes within an equal 64-bit core hash.

Null or empty texts and those under 100 bytes lose nothing. Rows that repeat a doc_id are documents of their own,
in the order of their texts' digests, and null doc_ids come last. Extra columns are dropped; an empty table gives
an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.anchors import CORE, WINDOW, anchors, window_hashes
from kestrel.llm.batches import id_and_text, lean, pieces, struct
from kestrel.llm.shingles import mix
from kestrel.llm.suffix_runs import decode, front_code, merge
from kestrel.llm.tables import keep

#: Most different stretches around one core that a merge resolves; beyond it windows are aggregated.
HOT = 4096
RUN_ANCHORS = 1 << 20
RUN_SUFFIXES = 1 << 16
_REPEAT, _HOT = -1, -2


def _place(at, left, right):
    """Position, bytes to the left and to the right of an anchor in one integer."""
    return at << 16 | left << 8 | right


def _u(x: np.ndarray) -> np.ndarray:
    return x.view(np.uint64)


def _batch(schema, *columns):
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema[1])], schema[0])


def _keyed(docs: DataFrame) -> DataFrame:
    """(key, doc_id, text): key is unique and orders the texts; it is doc_id unless that repeats or is null."""
    texts = id_and_text(docs)
    odd = texts.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1 or doc_id is null")
    if not odd.head(1):
        return texts.withColumn("key", F.col("doc_id"))
    from kestrel.operators.splits import ordinal_by

    return keep(ordinal_by(texts.withColumn("_digest", F.md5("text")).withColumn("_null", F.col("doc_id").isNull()),
                           ["_null", "doc_id", "_digest"], "key").select(F.col("key").cast("long").alias("key"), "doc_id", "text"), "keyed")


def _stretches(texts: DataFrame) -> DataFrame:
    """(spread, core, stretch, key, place, seen) of each task's different stretches, and of the others with seen = true."""
    schema = (["spread", "core", "stretch", "key", "place", "seen"], [pa.int64()] * 5 + [pa.bool_()])

    def flush(parts):
        core, stretch, key, place = (np.concatenate(x) for x in zip(*parts))
        both = mix(_u(core) * np.uint64(3) + _u(stretch))
        order = np.argsort(both, kind="stable")
        same = np.concatenate([[False], both[order][1:] == both[order][:-1]])
        twice = same | np.concatenate([same[1:], [False]])
        seen = np.zeros(len(core), bool)
        some = order[twice]
        some = some[np.lexsort((place[some], key[some], both[some]))]
        seen[some[1:]] = both[some][1:] == both[some][:-1]
        spread = np.where(seen, mix(_u(key) + _u(place)).view(np.int64), core)
        for start in range(0, len(core), 1 << 16):
            s = slice(start, start + (1 << 16))
            yield _batch(schema, spread[s], core[s], stretch[s], key[s], place[s], seen[s])

    def run(batches):
        parts, n = [], 0
        for batch in pieces(batches):
            for key, text in zip(*(c.to_pylist() for c in batch.columns)):
                for at, left, right, core, stretch in anchors(text.encode("utf-8", "surrogatepass")):
                    parts.append((core, stretch, np.full(len(at), key, np.int64), _place(at, left, right)))
                    n += len(at)
            if n >= RUN_ANCHORS:
                yield from flush(parts)
                parts, n = [], 0
        if parts:
            yield from flush(parts)

    return texts.select("key", "text").mapInArrow(lean(run), struct("spread long, core long, stretch long, key long, place long, seen boolean"))


def _classified(stretches: DataFrame, slots: int) -> DataFrame:
    """(key, place, slot): repeats, hot ones, and those whose core has several stretches with the slot that merges them."""
    schema = (["key", "place", "slot"], [pa.int64(), pa.int64(), pa.int32()])

    def run(batches):
        held: list = []  # rows of the last core, of which more may come; no more than HOT of them
        hot = last_core = last_stretch = None

        def settle(rows, is_hot):
            """Rows (core, stretch, key, place) of whole cores, first of each stretch only."""
            core, _, key, place = rows
            starts = np.flatnonzero(np.concatenate([[True], core[1:] != core[:-1]]))
            size = np.diff(np.append(starts, len(core)))
            several = np.repeat(size, size) > 1
            slot = np.where(np.repeat(size, size) > HOT, _HOT, (mix(_u(core)) % np.uint64(slots)).astype(np.int64))
            if is_hot:
                several[:], slot[:] = True, _HOT
            if several.any():
                yield _batch(schema, key[several], place[several], slot[several].astype(np.int32))

        for batch in batches:
            core, stretch, key, place, seen = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(5))
            if seen.any():
                yield _batch(schema, key[seen], place[seen], np.full(int(seen.sum()), _REPEAT, np.int32))
                core, stretch, key, place = (x[~seen] for x in (core, stretch, key, place))
            if not len(core):
                continue
            again = np.concatenate([[last_core == core[0] and last_stretch == stretch[0]], (core[1:] == core[:-1]) & (stretch[1:] == stretch[:-1])])
            last_core_before, last_core, last_stretch = last_core, core[-1], stretch[-1]
            if again.any():
                yield _batch(schema, key[again], place[again], np.full(int(again.sum()), _REPEAT, np.int32))
            rows = tuple(x[~again] for x in (core, stretch, key, place))
            if hot is not None and hot == last_core_before and len(rows[0]):
                more = rows[0] == hot
                if more.any():
                    yield from settle(tuple(x[more] for x in rows), True)
                    rows = tuple(x[~more] for x in rows)
            if held:
                rows = tuple(np.concatenate(x) for x in zip(held[0], rows))
                held = []
            if not len(rows[0]):
                continue
            open_ = rows[0] == last_core
            if int(open_.sum()) > HOT:  # more of it may come; all of it is hot
                yield from settle(tuple(x[open_] for x in rows), True)
                hot = last_core
            elif open_.any():
                held = [tuple(x[open_] for x in rows)]
            closed = tuple(x[~open_] for x in rows)
            if len(closed[0]):
                yield from settle(closed, False)
        if held:
            yield from settle(held[0], False)

    dealt = stretches.repartition("spread").sortWithinPartitions("seen", "core", "stretch", "key", "place")
    return dealt.select("core", "stretch", "key", "place", "seen").mapInArrow(lean(run), struct("key long, place long, slot int"))


def _runs(texts: DataFrame, open_places: DataFrame) -> DataFrame:
    """Rows with a slot: a front-coded run of suffixes; without one: two hashes and the start of a window."""
    schema = (["slot", "run", "a", "b", "key", "start"], [pa.int32(), pa.binary()] + [pa.int64()] * 4)

    def flush(items):
        """Items (slot, right bytes, left bytes reversed, key, place)."""
        items.sort(key=lambda x: (x[0], x[1]))
        i = 0
        out = []
        while i < len(items):
            j = i
            while j < len(items) and items[j][0] == items[i][0]:
                j += 1
            shared, own, tails = front_code([x[1] for x in items[i:j]])
            lefts = b"".join(x[2] for x in items[i:j])
            key, place = (np.array([x[k] for x in items[i:j]], np.int64) for k in (3, 4))
            head = np.array([j - i, len(tails)], np.int64)
            out.append((items[i][0], zstandard.compress(b"".join([head.tobytes(), shared.tobytes(), own.tobytes(), key.tobytes(), place.tobytes(), tails, lefts]), 3)))
            i = j
        none = [None] * len(out)
        yield _batch(schema, [x[0] for x in out], [x[1] for x in out], none, none, none, none)

    def run(batches):
        items = []
        for batch in pieces(batches, 64):
            for key, text, places, slots in zip(*(c.to_pylist() for c in batch.columns)):
                data = text.encode("utf-8", "surrogatepass")
                hot = [p for p, slot in zip(places, slots) if slot == _HOT]
                for p, slot in zip(places, slots):
                    if slot != _HOT:
                        at, left, right = p >> 16, p >> 8 & 255, p & 255
                        items.append((slot, data[at:at + right], data[at - left:at][::-1], key, p))
                if hot:
                    starts = np.unique(np.concatenate([np.arange((p >> 16) - (p >> 8 & 255), (p >> 16) + (p & 255) - WINDOW + 1) for p in hot]))
                    a, b = window_hashes(data, starts)
                    none = [None] * len(starts)
                    yield _batch(schema, none, none, a, b, np.full(len(starts), key, np.int64), starts)
            if len(items) >= RUN_SUFFIXES:
                yield from flush(items)
                items = []
        if items:
            yield from flush(items)

    per_text = open_places.groupBy("key").agg(F.collect_list(F.struct("place", "slot")).alias("p")).select("key", "p.place", "p.slot")
    return texts.select("key", "text").join(per_text, "key").select("key", "text", "place", "slot").mapInArrow(
        lean(run), struct("slot int, run binary, a long, b long, key long, start long"))


def _unpack(data: bytes):
    raw = zstandard.decompress(data)
    n, n_tails = np.frombuffer(raw, np.int64, 2).tolist()
    at = 16
    out = []
    for kind in (np.uint16, np.uint16, np.int64, np.int64):
        out.append(np.frombuffer(raw, kind, n, at))
        at += n * np.dtype(kind).itemsize
    shared, own, key, place = out
    return shared, own, raw[at:at + n_tails], key, place, raw[at + n_tails:]


def _repeated_windows(lcp: np.ndarray, left: np.ndarray, key: np.ndarray, place: np.ndarray):
    """(key, start, end) of the runs of repeated windows; rows are suffixes in merged order, ``lcp`` with the one before,
    ``left`` the bytes in front of the anchor, nearest first."""
    n = len(lcp)
    n_left, n_right = place >> 8 & 255, place & 255
    most = int(n_left.max())
    repeated = np.zeros((n, most + 2), bool)  # by bytes to the left of the anchor; the last column stays false
    prefix = np.zeros(n, np.uint64)
    for j in range(most + 1):
        if j:
            prefix = mix(prefix * np.uint64(0x9E3779B97F4A7C15) + left[:, j - 1].astype(np.uint64) + np.uint64(1))
        here = np.flatnonzero((n_left >= j) & (n_right >= WINDOW - j))
        if len(here) < 2:
            continue
        right_class = np.cumsum(lcp < WINDOW - j)[here].astype(np.uint64)
        both = mix(prefix[here] ^ mix(right_class * np.uint64(0xD6E8FEB86659FD93) + np.uint64(0xA0761D6478BD642F)))
        order = np.argsort(both, kind="stable")
        same = both[order][1:] == both[order][:-1]
        if not same.any():
            continue
        twice = np.concatenate([[False], same]) | np.concatenate([same, [False]])
        some = order[twice]
        some = some[np.lexsort((place[here[some]], key[here[some]], both[some]))]
        later = np.concatenate([[False], both[some][1:] == both[some][:-1]])
        repeated[here[some[later]], j] = True
    edge = np.diff(np.concatenate([np.zeros((n, 1), np.int8), repeated.astype(np.int8)], axis=1), axis=1)
    row, low = np.nonzero(edge == 1)
    _, beyond = np.nonzero(edge == -1)
    at = place[row] >> 16
    return key[row], at - (beyond - 1), at - low + WINDOW


def _merged(runs: DataFrame) -> DataFrame:
    """(key, start, end) of the repeated windows that the merged runs of each slot show."""
    schema = (["key", "start", "end"], [pa.int64()] * 3)
    most_left = WINDOW - CORE

    def slot_intervals(blobs):
        unpacked = [_unpack(b) for b in blobs]
        offsets = [np.concatenate([[0], np.cumsum(u[4] >> 8 & 255)]).tolist() for u in unpacked]
        taken = [0] * len(unpacked)
        lcp, left, key, place = [], [], [], []

        def resolve(n):
            """The first n rows, which end with a core."""
            matrix = np.zeros((n, most_left), np.uint8)
            for i, s in enumerate(left[:n]):
                matrix[i, :len(s)] = np.frombuffer(s, np.uint8)
            got = _repeated_windows(np.array(lcp[:n]), matrix, np.array(key[:n], np.int64), np.array(place[:n], np.int64))
            for x in (lcp, left, key, place):
                del x[:n]
            if len(got[0]):
                yield _batch(schema, *got)

        for _, shared, r in merge([decode(*u[:3]) for u in unpacked]):
            if shared < CORE:
                if len(lcp) >= 16384:
                    yield from resolve(len(lcp))
            i = taken[r]
            taken[r] = i + 1
            lcp.append(shared)
            key.append(int(unpacked[r][3][i]))
            place.append(int(unpacked[r][4][i]))
            left.append(unpacked[r][5][offsets[r][i]:offsets[r][i + 1]])
        if lcp:
            yield from resolve(len(lcp))

    def run(batches):
        slot, blobs = None, []
        for batch in batches:
            for s, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if s != slot and blobs:
                    yield from slot_intervals(blobs)
                    blobs = []
                slot = s
                blobs.append(blob)
        if blobs:
            yield from slot_intervals(blobs)

    return runs.repartition("slot").sortWithinPartitions("slot").mapInArrow(lean(run), struct("key long, start long, end long"))


def _hot_windows(windows: DataFrame) -> DataFrame:
    """(key, start, end) of the windows that an earlier one equals, by their hashes."""
    first = windows.groupBy("a", "b").agg(F.min(F.struct("key", "start")).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select("a", "b", "first")
    later = windows.join(first, ["a", "b"]).where("key <> first.key or start <> first.start")
    return later.select("key", "start", (F.col("start") + WINDOW).alias("end"))


def intervals(texts: DataFrame, slots: int | None = None) -> DataFrame:
    """(key, start, end) of repeated bytes of (key, text); intervals may overlap."""
    spark = texts.sparkSession
    slots = slots or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = keep(_classified(_stretches(texts), slots), "places")
    runs = keep(_runs(texts, placed.where(f"slot <> {_REPEAT}")), "runs")
    whole = placed.where(f"slot = {_REPEAT}").select("key", F.expr("shiftright(place, 16) - (shiftright(place, 8) & 255)").alias("start"),
                                                   F.expr("shiftright(place, 16) + (place & 255)").alias("end"))
    return whole.unionByName(_merged(runs.where("slot is not null").select("slot", "run"))).unionByName(
        _hot_windows(runs.where("slot is null").select("a", "b", "key", "start")))


def without_repeats(docs: DataFrame, slots: int | None = None) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept binary) of every row."""
    texts = _keyed(docs)
    found = keep(intervals(texts, slots), "intervals")
    per_text = found.groupBy("key").agg(F.collect_list(F.struct("start", "end")).alias("i")).select("key", F.col("i.start").alias("starts"), F.col("i.end").alias("ends"))
    schema = (["doc_id", "n_bytes", "n_removed", "n_spans", "kept"], [pa.int64()] * 4 + [pa.binary()])

    def run(batches):
        for batch in pieces(batches):
            out = []
            texts_ = batch.column(1).to_pylist()
            for i, (doc_id, text) in enumerate(zip(batch.column(0).to_pylist(), texts_)):
                data = text.encode("utf-8", "surrogatepass")
                if not batch.column(2)[i].is_valid:
                    out.append((doc_id, len(data), 0, 0, data))
                    continue
                starts, ends = (np.array(batch.column(c)[i].as_py(), np.int64) for c in (2, 3))
                depth = np.bincount(starts, minlength=len(data) + 1) - np.bincount(ends, minlength=len(data) + 1)
                gone = np.cumsum(depth)[:len(data)] > 0
                spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                out.append((doc_id, len(data), int(gone.sum()), spans, np.frombuffer(data, np.uint8)[~gone].tobytes()))
            if out:
                yield _batch(schema, *zip(*out))

    return texts.join(per_text, "key", "left").select("doc_id", "text", "starts", "ends").mapInArrow(
        lean(run), struct("doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"))
