"""Language identification: multinomial naive Bayes over hashed character n-grams.

``fit`` counts n-grams of orders 1 to 3 of every labelled text (letters lower-cased, everything else one
space) into a fixed number of hash bins per language. The log-probability matrix is broadcast in blocks of at most
``MAX_LANGUAGES`` x ``BINS`` floats, one block for up to ``MAX_LANGUAGES`` languages, and texts are scored in numpy as a
sparse batch of bin counts times the matrix. With more languages there is a pass over the texts for each block, which
keeps the best language so far and the sum of all posteriors; the result is that of one matrix.

A text that is null, empty or without a letter is ``und`` with score 0; equal scores go to the language that
sorts first; without any training text every text is ``und``. Rows with a null language are not learned from.
Repeated rows are scored each; extra columns are dropped; an empty table gives an empty one.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.batches import fresh, lean, pieces, small_batches, struct
from kestrel.llm.tables import keep
from kestrel.operators.splits import ordinal_by

BIN_BITS = 16
BINS = 1 << BIN_BITS
#: Languages of one broadcast block: 256 languages x 65,536 bins x 4 bytes = 64 MB.
MAX_LANGUAGES = 256
CHUNK = 1 << 20  # code points handled at a time, so that a very long text needs no more memory
SPACE = 32
UNKNOWN = "und"


@functools.cache
def _letters() -> np.ndarray:
    """For each code point its lower-case letter, or a space."""
    out = np.full(0x110000, SPACE, np.uint32)
    for cp in range(0x110000):
        ch = chr(cp)
        if ch.isalpha():
            low = ch.lower()
            out[cp] = ord(low) if len(low) == 1 else cp
    return out


def _bins(codes: np.ndarray, known: int) -> np.ndarray:
    """Hash bins of all 1-, 2- and 3-grams of the codes but those inside the first ``known`` ones."""
    a = codes * np.uint32(2654435761)
    b = codes * np.uint32(2246822519)
    c = codes * np.uint32(3266489917)
    two = (a[:-1] + b[1:])[max(known - 1, 0):]
    three = (a[:-2] + b[1:-1] + c[2:])[max(known - 2, 0):]
    h = np.concatenate([a[known:] + np.uint32(1), two + np.uint32(2), three + np.uint32(3)])
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x2C1B3C6D)
    return h >> np.uint32(32 - BIN_BITS)


def text_bins(text: str):
    """Arrays of hash bins of the text, chunk by chunk; none if it has no letter."""
    table, carry, known, seen = _letters(), np.array([SPACE], np.uint32), 0, False
    for start in range(0, len(text), CHUNK):
        part = text[start:start + CHUNK]
        raw = table[np.frombuffer(part.encode("utf-32-le", "surrogatepass"), np.uint32)]
        raw = np.concatenate([carry, raw, [np.uint32(SPACE)]] if start + CHUNK >= len(text) else [carry, raw])
        keep = np.ones(len(raw), bool)
        keep[1:] = (raw[1:] != SPACE) | (raw[:-1] != SPACE)
        codes = raw[keep]
        if not seen and not (codes != SPACE).any():
            carry = codes[-1:]
            continue
        seen = True
        yield _bins(codes, known)
        carry = codes[-2:]
        known = len(carry)


@dataclass
class Block:
    """Some languages, in order, with their log-probabilities (bins x languages, float32) and log-priors."""

    languages: list[str]
    log_prob: np.ndarray
    log_prior: np.ndarray


@dataclass
class Model:
    """``counts`` (place, lang, bin, n) of the languages by their place in the order of names; bin -1 has the texts."""

    n_languages: int
    n_texts: int
    counts: DataFrame

    def blocks(self) -> Iterator[Block]:
        for start in range(0, self.n_languages, MAX_LANGUAGES):
            got = self.counts.where((F.col("place") >= start) & (F.col("place") < start + MAX_LANGUAGES)).select(
                "bin", "n", (F.col("place") - start).cast("int").alias("at"), F.when(F.col("bin") < 0, F.col("lang")).alias("lang")).toArrow()
            bins, n, at = (got[c].to_numpy() for c in ("bin", "n", "at"))
            names = got["lang"].to_pylist()
            places = np.flatnonzero(bins < 0)
            languages = [names[i] for i in places[np.argsort(at[places])]]
            table, texts = np.zeros((BINS, len(languages))), np.zeros(len(languages))
            table[bins[bins >= 0], at[bins >= 0]] = n[bins >= 0]
            texts[at[places]] = n[places]
            yield Block(languages, np.log((table + 0.5) / (table + 0.5).sum(axis=0)).astype(np.float32), np.log(texts / self.n_texts))


def fit(labelled: DataFrame, lang_col: str = "lang", text_col: str = "text") -> Model:
    """Counts over all rows with a language, summed per (language, bin) by Spark."""

    def count(batches):
        counts: dict[str, np.ndarray] = {}
        docs: dict[str, int] = {}

        def out():
            for lang, mine in counts.items():
                at = np.flatnonzero(mine)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * (len(at) + 1), pa.string()), pa.array(np.append(at, -1).astype(np.int32)),
                     pa.array(np.append(mine[at], docs[lang]))], ["lang", "bin", "n"])
            counts.clear()
            docs.clear()

        for batch in pieces(batches):
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if lang not in counts and len(counts) >= MAX_LANGUAGES:
                    yield from out()
                mine = counts.setdefault(lang, np.zeros(BINS, np.int64))
                docs[lang] = docs.get(lang, 0) + 1
                for bins in text_bins(text):
                    mine += np.bincount(bins, minlength=BINS)
        yield from out()

    small_batches(labelled.sparkSession)
    rows = labelled.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    per_task = rows.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text")).mapInArrow(
        lean(count), struct("lang string, bin int, n long"))
    summed = keep(per_task.groupBy("lang", "bin").agg(F.sum("n").alias("n")), "language-counts")
    names = summed.where("bin < 0").select("lang", "n")
    n_languages, n_texts = names.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    if n_languages <= MAX_LANGUAGES:  # few names: their order is known at once
        order = {r.lang: i for i, r in enumerate(sorted(names.select("lang").collect()))}
        placed = labelled.sparkSession.createDataFrame(list(order.items()), "lang string, place long")
    else:
        placed = ordinal_by(names.select("lang"), ["lang"], "place").withColumn("place", F.col("place") - 1)
    counts = summed.join(placed, "lang").select("place", "lang", "bin", "n")
    return Model(n_languages, n_texts, counts if n_languages <= MAX_LANGUAGES else keep(counts, "language-counts"))


def _counted(text: str | None) -> tuple[np.ndarray, np.ndarray] | None:
    """Distinct bins of a text and their counts; None without a letter."""
    total = None
    for bins in text_bins(text or ""):
        mine = np.bincount(bins, minlength=BINS)
        total = mine if total is None else total + mine
    if total is None:
        return None
    at = np.flatnonzero(total)
    return at, total[at]


#: Products of a sparse batch that are formed at a time.
_PRODUCTS = 1 << 21


def scores(block: Block, texts: list[str | None]) -> np.ndarray:
    """Log-probability of each text with each language of the block; a row of NaN for a text without a letter."""
    out = np.full((len(texts), len(block.languages)), np.nan)
    room = max(1, _PRODUCTS // max(1, len(block.languages)))
    which, bins, n = [], [], []

    def multiply():
        b, times = np.concatenate(bins), np.concatenate(n)
        starts = np.concatenate([[0], np.cumsum([len(x) for x in bins])[:-1]])
        out[which] = np.add.reduceat(block.log_prob[b] * times[:, None].astype(np.float64), starts, axis=0) + block.log_prior
        which.clear(), bins.clear(), n.clear()

    for i, text in enumerate(texts):
        found = _counted(text)
        if found is None:
            continue
        if bins and sum(map(len, bins)) + len(found[0]) > room:
            multiply()
        which.append(i)
        bins.append(found[0])
        n.append(found[1])
    if which:
        multiply()
    return out


def _merge(old: tuple, block: Block, found: np.ndarray) -> tuple[list, list, list]:
    """Best score so far, its language, and the sum of all likelihoods relative to it, with a block's scores added."""
    tops, langs, masses = (list(x) for x in old)
    for i in np.flatnonzero(~np.isnan(found[:, 0])).tolist():
        at = int(np.argmax(found[i]))
        top = float(found[i, at])
        mass = float(np.exp(found[i] - top).sum())
        if tops[i] is None or top > tops[i]:  # equal scores go to the language that sorts first
            mass += 0.0 if tops[i] is None else masses[i] * float(np.exp(tops[i] - top))
            tops[i], langs[i], masses[i] = top, block.languages[at], mass
        else:
            masses[i] += mass * float(np.exp(top - tops[i]))
    return tops, langs, masses


def best(model: Model, texts: list[str | None]) -> list[tuple[str, float]]:
    """The likeliest language of each text and its posterior probability, on the driver."""
    state = tuple([None] * len(texts) for _ in range(3))
    for block in model.blocks():
        state = _merge(state, block, scores(block, texts))
    return [(lang or UNKNOWN, 1.0 / mass if lang else 0.0) for lang, mass in zip(state[1], state[2])]


def identified(docs: DataFrame, model: Model, text_col: str = "text") -> tuple[DataFrame, str, str]:
    """``docs`` with the language and the score of every row in two more columns, and the names of these."""
    top, lang, mass = fresh(docs, "lang_top", "lang_pred", "lang_mass")
    out = docs.withColumns({top: F.lit(None).cast("double"), lang: F.lit(None).cast("string"), mass: F.lit(None).cast("double")})
    at, names = docs.columns.index(text_col), [*docs.columns, top, lang, mass]
    small_batches(docs.sparkSession)
    for block in model.blocks():
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches, shared=shared):
            for batch in pieces(batches):
                state = _merge(tuple(c.to_pylist() for c in batch.columns[-3:]), shared.value, scores(shared.value, batch.column(at).to_pylist()))
                yield pa.RecordBatch.from_arrays([*batch.columns[:-3], *(pa.array(x, t) for x, t in zip(state, (pa.float64(), pa.string(), pa.float64())))], names)

        out = out.mapInArrow(lean(run), out.schema)
        if model.n_languages > MAX_LANGUAGES:  # one block at a time is broadcast
            out = keep(out, "languages")
    score = fresh(out, "score")[0]
    out = out.withColumns({score: F.coalesce(1.0 / F.col(mass), F.lit(0.0)), lang: F.coalesce(lang, F.lit(UNKNOWN))}).drop(top, mass)
    return out, lang, score


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score) of every row."""
    texts = docs.select(F.col(id_col).cast("long").alias(id_col), F.col(text_col).alias("text"))
    out, lang, score = identified(texts, model)
    return out.select(id_col, F.col(lang).alias("lang_pred"), F.col(score).alias("score"))
