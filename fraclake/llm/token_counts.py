"""Token counts of whole texts, huge ones in overlapping chunks that resynchronise.

A text of more than ``chunk`` characters is encoded as chunks that overlap by ``overlap``
characters. The cuts fall anywhere, so tokens at a chunk's ends may be wrong; but where a
character that is no blank is followed by a blank, the pre-tokenizer always cuts, whatever
stands before or after. The last such place in an overlap at which both chunks begin a token
is the seam: tokens before it count from the left chunk, tokens after it from the right one.
Where an overlap holds no such place, it is doubled until it does or reaches the end.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fraclake.llm.bpe import BLANKS, SLICE, Encoder, texts_of
from fraclake.llm.frames import by_text

CHUNK, OVERLAP = 1 << 15, 1 << 9
_BLANKS = frozenset(map(chr, BLANKS))


def chunked(encoder: Encoder, text: str, chunk: int, overlap: int) -> int:
    """Tokens of one text from its chunks; memory is bounded by a chunk and its overlap."""
    total, since, cut = 0, 0, chunk  # tokens before ``since`` are counted; ``cut`` is where the next chunk begins
    left = _tokens(encoder, text, 0, chunk + overlap)
    while cut < len(text):
        width = overlap
        right = _tokens(encoder, text, cut, cut + chunk + width)
        seam = _seam(text, left[0], right[0], cut, min(cut + width, len(text)))
        while seam is None and cut + width < len(text):
            width *= 2
            left = _tokens(encoder, text, since, cut + width)
            right = _tokens(encoder, text, cut, cut + chunk + width)
            seam = _seam(text, left[0], right[0], cut, min(cut + width, len(text)))
        if seam is None:  # the left chunk has reached the end of the text
            break
        total += int(left[1][(left[0] >= since) & (left[0] < seam)].sum())
        since, left, cut = seam, right, max(cut + chunk, seam)
    return total + int(left[1][left[0] >= since].sum())


def _tokens(encoder: Encoder, text: str, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
    """Where runs begin in the text, and their numbers of tokens."""
    found = encoder.encode([text[lo:hi]])
    return found.char + lo, found.count


def _seam(text: str, left: np.ndarray, right: np.ndarray, lo: int, hi: int) -> int | None:
    both = np.intersect1d(left[(left > lo) & (left < hi)], right[right < hi])
    for at in both[::-1].tolist():
        if text[at] in _BLANKS and text[at - 1] not in _BLANKS:
            return at
    return None


def counter(path: str, chunk: int = CHUNK, overlap: int = OVERLAP):
    """A column function: tokens of each text; null counts as empty."""

    def count(column: pa.Array) -> pa.Array:
        encoder, texts = Encoder.at(path), texts_of(column)
        out = np.zeros(len(texts), np.int64)
        short = [i for i, t in enumerate(texts) if len(t) <= chunk]
        out[short] = encoder.encode([texts[i] for i in short]).tokens()
        for i, text in enumerate(texts):
            if len(text) > chunk:
                out[i] = chunked(encoder, text, chunk, overlap)
        return pa.array(out)

    return by_text(count, "bigint", SLICE)


def token_counts(docs: DataFrame, path: str, limit: int = 512, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for each row of (doc_id, text).

    Null and empty texts have no bytes and no tokens. Repeated rows and null ids are
    counted like any other; other columns are not looked at.
    """
    text: Column = F.coalesce(F.col("text"), F.lit(""))
    counted = docs.select("doc_id", F.octet_length(text).cast("long").alias("n_bytes"), counter(path, chunk, overlap)("text").alias("n_tokens"))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
