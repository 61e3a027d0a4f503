"""Column-expression helpers: everything here returns a ``Column`` built from
Spark built-ins, so it stays inside whole-stage code generation."""

from kestrel.functions.columns import (  # noqa: F401
    WORD_PATTERN,
    alpha_tokens,
    hash_bucket,
    round6,
    safe_ratio,
    try_int,
    word_tokens,
)
