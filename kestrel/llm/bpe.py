"""Byte-level BPE encoding and decoding with the tiktoken library and a local rank file.

``encode`` splits long texts at boundaries that no match of the pre-splitting pattern can cross, so the ids
equal those of the whole text; ``decode`` joins the raw bytes of the ids. A null or empty text gives no ids
and no bytes; repeated rows give repeated rows; other columns are dropped; an empty table gives an empty one.
"""

from __future__ import annotations

import base64
import functools
import re
from array import array
import sys

from pyspark.sql import DataFrame

from kestrel.llm.batches import id_and_text, map_rows, struct

#: Longest text handed over in one piece when it has a safe boundary, in code points.
PIECE_CHARS = 1 << 16

# No match of the pattern crosses these places: every alternative holds letters only, digits only, or
# neither, with white space only in front. The classes are ASCII on purpose: they don't depend on a
# Unicode version. A contraction ('s, 're) starts at the apostrophe and is never cut, as both of its
# sides would have to be a letter followed by a letter.
_SAFE = re.compile(r"(?<=\S)(?=[ \t\r\n])|(?<=[A-Za-z])(?=[\x00-\x40\x5B-\x60\x7B-\x7F])|(?<=[0-9])(?=[\x00-\x2F\x3A-\x7F])")


def safe_pieces(text: str, limit: int = PIECE_CHARS) -> list[str]:
    """``text`` cut after at least ``limit`` code points, at the next safe boundary each time."""
    out, start = [], 0
    while len(text) - start > limit:
        cut = _SAFE.search(text, start + limit)
        if not cut or cut.start() >= len(text):
            break
        out.append(text[start:cut.start()])
        start = cut.start()
    out.append(text[start:])
    return out


@functools.lru_cache(maxsize=4)
def encoding(rank_file: str, pattern: str):
    """The tiktoken encoding of a rank file, without special tokens; built once per Python worker."""
    import tiktoken

    with open(rank_file, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def _pack(ids: list[int]) -> bytes:
    a = array("I", ids)
    if sys.byteorder == "big":
        a.byteswap()
    return a.tobytes()


def _unpack(data: bytes) -> list[int]:
    a = array("I")
    a.frombytes(data)
    if sys.byteorder == "big":
        a.byteswap()
    return a.tolist()


def encode(docs: DataFrame, rank_file: str, pattern: str, limit: int = PIECE_CHARS) -> DataFrame:
    """(doc_id, token_ids binary): the ids of the whole text as little-endian unsigned 32-bit integers."""

    def make():
        enc = encoding(rank_file, pattern)

        def one(doc_id, text):
            if len(text) <= limit:
                return doc_id, _pack(enc.encode_ordinary(text))
            return doc_id, b"".join(_pack(enc.encode_ordinary(p)) for p in safe_pieces(text, limit))

        return one

    return map_rows(id_and_text(docs), make, struct("doc_id long, token_ids binary"))


def decode(tokens: DataFrame, rank_file: str, pattern: str) -> DataFrame:
    """(doc_id, token_ids, decoded binary): the bytes of the ids, joined; null ids count as none."""

    def make():
        enc = encoding(rank_file, pattern)
        return lambda doc_id, data: (doc_id, data, enc.decode_bytes(_unpack(data or b"")))

    return map_rows(tokens.select("doc_id", "token_ids"), make, struct("doc_id long, token_ids binary, decoded binary"))


def encode_and_decode(docs: DataFrame, rank_file: str, pattern: str, limit: int = PIECE_CHARS) -> DataFrame:
    """(doc_id, token_ids, decoded) as ``decode(encode(docs))`` gives them, in one pass of one Python worker a task."""

    def make():
        enc = encoding(rank_file, pattern)

        def one(doc_id, text):
            ids = [i for p in safe_pieces(text, limit) for i in enc.encode_ordinary(p)]
            packed = _pack(ids)
            return doc_id, packed, enc.decode_bytes(_unpack(packed))

        return one

    return map_rows(id_and_text(docs), make, struct("doc_id long, token_ids binary, decoded binary"))
