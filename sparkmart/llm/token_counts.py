"""Operator 8: token counts of whole texts, huge ones by overlapping chunks.

A text of at most ``chunk_chars`` characters is counted at once.  A longer one is encoded
in chunks that overlap, with the offsets of their tokens.  Two neighbours are spliced at a
common boundary: a place in the overlap where both encodings have a token's edge, and
where the tokenizer is proven to start anew whatever stands around it — a character that
is not white space, followed by white space.  Tokens before it come from the left chunk,
those behind it from the right one.  If an overlap has no such place it is widened, on both
sides, to the text's end if need be, so the count is exact for every text.  What is encoded
at once is a chunk or two, or a few times the longest stretch without white space.

NULL and empty texts have no tokens.  Special strings count as the library counts them by
default.  Repeated rows give repeated results.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

from sparkmart.llm.common import map_texts
from sparkmart.llm.tokenizer_memo import byte_token_counts, load

CHUNK_CHARS, OVERLAP_CHARS = 32_768, 256
#: White space of the tokenizer's pattern; other control characters are ordinary ones to it.
_STARTS_ANEW = re.compile(r"(?<=[^\s\x1c-\x1f])(?=[ \n\t\r])")


def token_edges(path: str, text: str) -> list[int]:
    """Where each token of a text ends, in characters."""
    return [end for _, end in load(path).encode(text, add_special_tokens=False).offsets]


def count_long(path: str, text: str, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> int:
    """Tokens of one text, by chunks of ``chunk`` characters and what they overlap."""
    if len(text) <= chunk + overlap:
        return len(token_edges(path, text))
    total, start, done, stop = 0, 0, 0, chunk + overlap
    edges = token_edges(path, text[:stop])
    while stop < len(text):
        cut = max(start + chunk, done)
        right_stop = min(len(text), stop + chunk)
        right = token_edges(path, text[cut:right_stop])
        common = {cut + e for e in right}.intersection(start + e for e in edges)
        places = (m.start() for m in _STARTS_ANEW.finditer(text, cut + 1, stop - 1) if m.start() in common)
        splice = next(places, None)
        if splice is None:
            stop = min(len(text), cut + 2 * (stop - cut))
            edges = token_edges(path, text[start:stop])
            continue
        total += sum(done < start + e <= splice for e in edges)
        start, done, edges, stop = cut, splice, right, right_stop
    return total + sum(start + e > done for e in edges)


def token_counts(docs: DataFrame, path: str, limit: int = 512, chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every text.  No shuffle."""

    def rows(keys, texts):
        short = iter(byte_token_counts(path, [text for text in texts if len(text) <= chunk_chars]))
        for key, text in zip(keys, texts, strict=True):
            n = next(short) if len(text) <= chunk_chars else count_long(path, text, chunk_chars)
            yield key, len(text.encode()), n, n > limit

    return map_texts(docs, rows, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
