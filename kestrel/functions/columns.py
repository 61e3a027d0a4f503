from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A word is a run of Unicode letters, digits, underscore or apostrophe. This is
# what Python's `[\w']+` matches on str; Java's `\w` is ASCII-only, so the
# classes are spelled out (the DuckDB oracle uses the same pattern).
WORD_PATTERN = r"[\p{L}\p{N}_']+"
ALPHA_PATTERN = r"^[A-Za-z]{2,}$"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def word_tokens(text: Column | str, lower: bool = False) -> Column:
    """array<string> of word tokens, case kept unless ``lower``."""
    t = _c(text)
    if lower:
        t = F.lower(t)
    return F.regexp_extract_all(t, F.lit(WORD_PATTERN), 0)


def alpha_tokens(text: Column | str, lower: bool = False) -> Column:
    """Tokens of two or more ASCII letters (whole word runs only, so a run such
    as ``café`` is not cut down to ``caf``)."""
    toks = F.filter(word_tokens(text), lambda w: w.rlike(ALPHA_PATTERN))
    return F.transform(toks, F.lower) if lower else toks


def hash_bucket(key: Column | str, buckets: int = 10) -> Column:
    """Deterministic bucket 0..buckets-1 from the first 32 bits of md5(key).

    Engine independent (DuckDB: ``('0x'||substr(md5(k),1,8))::bigint % n``),
    so splits made with it can be checked by SQL.
    """
    h = F.conv(F.substr(F.md5(_c(key).cast("string")), F.lit(1), F.lit(8)), 16, 10).cast("bigint")
    return F.pmod(h, F.lit(buckets)).cast("int")


def try_int(c: Column | str) -> Column:
    """int, or NULL for malformed text (ANSI-safe)."""
    return F.expr(f"try_cast({c} as int)") if isinstance(c, str) else _c(c).try_cast("int")


def safe_ratio(num: Column, den: Column) -> Column:
    """num / den as double, 0 when the denominator is 0 or NULL (zero-safe metric)."""
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(0.0))


def round6(c: Column) -> Column:
    return F.round(c.cast("double"), 6)
