"""Token counts by overlap resynchronisation (operator 3).

A text up to `chunk` characters is encoded at once. A longer one is encoded in
overlapping chunks with the byte offset of every token. Two neighbouring chunks
are spliced at a token boundary of both that lies where a character that is not
white space is followed by a space or line feed. Such a place is stable whatever
stands around it: no pre-token goes on over white space that does not begin it,
and no look-ahead of the pre-tokeniser reaches behind it, so what precedes it is
encoded alike in any text that continues it, and what follows alike after any
text that ends in it. Where an overlap has no such place, it is widened until it
has one or the chunk reaches the text's end. Memory is that of one chunk.

Texts of Latin letters, digits and common signs go to the rank encoder, whose
vocabulary is the same; a text with any other character goes to the `tokenizers`
library itself, as that library's tables of Unicode classes decide there.

Defined results: null and empty texts have 0 bytes and 0 tokens; the special
string counts as one token wherever it stands; ties and repeated rows are
counted row by row; an empty table gives an empty result; extra columns of the
input are not read.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from . import common

#: Characters of a chunk and of the first overlap.
CHUNK, OVERLAP = 1 << 15, 1 << 9
_UNUSUAL = re.compile("[^\x00-ſ‐-…€]")
_CUT = re.compile(r"[^\s](?=[ \n])")


@cache
def library(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@cache
def ranked(path: str, pattern: str, special: tuple[tuple[str, int], ...]):
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens=dict(special))


def byte_bpe(json_path: str, rank_path: str, pattern: str, special: tuple[tuple[str, int], ...] = (("<|endoftext|>", 50256),)) -> Callable[[str], np.ndarray]:
    """text -> the byte length of each token."""

    def lengths(text: str) -> np.ndarray:
        if _UNUSUAL.search(text):
            # offsets are in characters: bytes follow from the running width of the text
            ends = [b for _, b in library(json_path).encode(text, add_special_tokens=False).offsets]
            width = np.concatenate([[0], np.cumsum(np.frombuffer(text.encode("utf-32-le"), np.uint32) > np.array([[0x7F], [0x7FF], [0xFFFF]], np.uint32), axis=1).sum(0) + np.arange(1, len(text) + 1)])
            return np.diff(width[np.maximum.accumulate(np.array([0, *ends]))])
        enc = ranked(rank_path, pattern, special)
        ids = enc.encode(text, allowed_special="all")
        return np.array([len(x) for x in enc.decode_tokens_bytes(ids)], np.int64)

    return lengths


def count(text: str, whole: Callable[[str], int], lengths: Callable[[str], np.ndarray], chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
    """Tokens of text: whole(text) where it is short, spliced from chunks where it is long."""
    if len(text) <= chunk:
        return whole(text)
    total, begin, wide = 0, 0, overlap
    while True:
        end = begin + chunk + wide
        if end >= len(text):
            return total + whole(text[begin:])
        # the places where this chunk and the next can meet, the last first
        left, low = text[begin:end], end - wide
        spots = [m.end() for m in _CUT.finditer(text, low, end - 1)]
        if spots:
            right = text[low : end + overlap]
            after_left, after_right = np.cumsum(lengths(left)), np.cumsum(lengths(right))
            base = len(text[begin:low].encode())
            for p in reversed(spots):
                inner = len(text[low:p].encode())
                k = int(np.searchsorted(after_left, base + inner, "right"))  # tokens up to here; those of one character's bytes end together
                j = int(np.searchsorted(after_right, inner, "right"))
                if k and j and after_left[k - 1] == base + inner and after_right[j - 1] == inner:
                    total, begin, wide = total + k, p, overlap
                    break
            else:
                wide *= 2
        else:
            wide *= 2


def counter(json_path: str, rank_path: str, pattern: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> Callable[[str], int]:
    lengths = byte_bpe(json_path, rank_path, pattern)

    def whole(text: str) -> int:
        if _UNUSUAL.search(text):
            return len(library(json_path).encode(text, add_special_tokens=False).ids)
        return len(ranked(rank_path, pattern, (("<|endoftext|>", 50256),)).encode(text, allowed_special="all"))

    return lambda text: count(text, whole, lengths, chunk, overlap)


def count_tokens(df: DataFrame, json_path: str, rank_path: str, pattern: str, key: str = "doc_id", text: str = "text", chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """key, n_bytes, n_tokens of every row; no shuffle."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = counter(json_path, rank_path, pattern, chunk, overlap)
        for batch in batches:
            n_bytes, n_tokens = [], []
            for value in batch.column(1):
                t = value.as_py() or ""
                n_bytes.append(len(t.encode()))
                n_tokens.append(tokens(t))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64())], ["key", "n_bytes", "n_tokens"])

    rows = df.select(df[key].alias("key"), df[text].alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(kernel, f"key {kind}, n_bytes long, n_tokens long").withColumnRenamed("key", key)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as p

    out = count_tokens(common.table(spark, sf_dir, "documents"), p.path("byte_bpe_50k.json"), p.path("byte_bpe_50k.tiktoken"), p.PATTERN)
    return out.selectExpr("doc_id", "n_bytes", "n_tokens", "n_tokens > 512 AS over_limit")
