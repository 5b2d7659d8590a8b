"""Order-preserving packing into fixed windows by dynamic programming (operator 6).

Documents follow each other by doc_id. A window may end at a document's end, at a
sentence's end inside it or, at a higher price, every STEP tokens of a long
sentence. The cost of a window is its padding plus the price of the place where
it ends; the cheapest sequence of cuts is found with

    best[j] = price[j] + length - t[j] + min over t[i] >= t[j] - length of best[i] + t[i]

whose minimum a monotone queue keeps in constant time per place.

The texts are encoded once. What leaves that pass is, for every place, the number
of tokens before it and the crc32 of the ids before it; the crc32 of a piece
follows from those at its two ends by the algebra of the checksum. These small
rows are ranged by doc_id, each range packed on its own in blocks of bounded
size, and the windows numbered through from the counts of the ranges.

Defined results: a null or empty text is one end token; rows with a null doc_id
come first, repeated rows follow each other; an empty table gives an empty
result; extra columns are not read.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, kernel, wordpieces

LENGTH, END_ID, STEP = 2048, 1, 64
#: Prices in tokens of padding: a cut at a sentence's end and inside a sentence.
SENTENCE, INSIDE = 2, 24
#: Tokens that one run of the dynamic programme takes at most (beyond one document).
BLOCK_TOKENS = 1 << 20
_STOP = np.zeros(256, bool)
_STOP[list(b".!?")] = True


def _zero_operators(most: int) -> np.ndarray:
    """Row n: the linear map (32 columns) that feeding 4 * n zero bytes is on a crc32 register."""
    table = np.zeros(256, np.uint32)
    for k in range(256):
        c = k
        for _ in range(8):
            c = (c >> 1) ^ (0xEDB88320 if c & 1 else 0)
        table[k] = c
    out = np.zeros((most + 1, 32), np.uint32)
    out[0] = np.uint32(1) << np.arange(32, dtype=np.uint32)
    for n in range(1, most + 1):
        x = out[n - 1]
        for _ in range(4):
            x = table[x & 0xFF] ^ (x >> 8)
        out[n] = x
    return out


_operators: np.ndarray | None = None


def piece_crc(before: np.ndarray, after: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """crc32 of the last `tokens` uint32 values, from the crc32 without and with them."""
    global _operators
    if _operators is None:
        _operators = _zero_operators(LENGTH)
    columns = _operators[tokens]
    bits = (before[:, None].astype(np.uint32) >> np.arange(32, dtype=np.uint32)) & np.uint32(1)
    return after.astype(np.uint32) ^ np.bitwise_xor.reduce(columns * bits, axis=1)


def _sentence_places(data: np.ndarray, words: kernel.Words, token: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(tokens before, kind) of the places at sentences' ends and inside long ones, and each row's first place.

    token: tokens before each word, and in all. A sentence ends after a word that
    ends with one of .!?, at a new line and at the end of its row.
    """
    if not len(words.start):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(words.rows + 1, np.int64)
    end = words.start + words.length
    lines = np.concatenate([[0], np.cumsum(data == 10)])
    ends = _STOP[data[end - 1]]
    ends[:-1] |= (lines[words.start[1:]] > lines[end[:-1]]) | (words.row[1:] != words.row[:-1])
    ends[-1] = True
    last = np.flatnonzero(ends)
    stop = token[last + 1]
    start = np.concatenate([[0], stop[:-1]])
    filled = stop > start  # signs that the vocabulary drops may be a whole sentence
    last, stop, start = last[filled], stop[filled], start[filled]
    per = -(-(stop - start) // STEP)
    final = np.cumsum(per) - 1
    before = np.repeat(start, per) + STEP * (np.arange(per.sum()) - np.repeat(final - per, per))
    kind = np.full(len(before), 2)
    before[final], kind[final] = stop, 1
    return before, kind, np.searchsorted(np.repeat(words.row[last], per), np.arange(words.rows + 1))


def places(docs: DataFrame, path: str, end_id: int = END_ID) -> DataFrame:
    """doc_id, doc_tokens and, of every place where a window may end, tokens and crc32 before it and its kind (0 document, 1 sentence, 2 inside)."""

    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = wordpieces.shared(path)
        last = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            data, offsets = kernel.utf8(batch.column(1))
            for a, b in kernel.blocks(offsets, 1 << 20):
                block = data[offsets[a] : offsets[b]]
                words = kernel.Words(block, offsets[a : b + 1] - offsets[a])
                ids, size = table.ids(table.entries(words))
                raw = memoryview(ids.astype("<u4").tobytes())
                token = np.concatenate([[0], np.cumsum(size)])
                base = token[words.first].tolist()
                before, kind, first = _sentence_places(block, words, token)
                bounds, before = first.tolist(), before.tolist()
                totals, blobs = [], []
                for i in range(b - a):
                    at, crc, crcs = base[i], 0, []
                    own_places = before[bounds[i] : bounds[i + 1]]
                    for t in own_places:
                        crc = zlib.crc32(raw[4 * at : 4 * t], crc)
                        crcs.append(crc)
                        at = t
                    rows = np.empty((len(own_places) + 1, 3), "<u4")
                    rows[:-1, 0] = np.array(own_places, np.int64) - base[i]
                    rows[:-1, 1] = crcs
                    rows[:-1, 2] = kind[bounds[i] : bounds[i + 1]]
                    rows[-1] = at + 1 - base[i], zlib.crc32(last, crc), 0
                    totals.append(at + 1 - base[i])
                    blobs.append(rows.tobytes())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(totals, pa.int64()), pa.array(blobs, pa.binary())], ["doc_id", "doc_tokens", "places"])

    return docs.select("doc_id", "text").mapInArrow(body, "doc_id long, doc_tokens long, places binary")


def cuts(t: np.ndarray, price: np.ndarray, length: int = LENGTH) -> list[int]:
    """Numbers of the places (t ascending, all gaps at most length) where windows end; the last place is one."""
    at, cost = t.tolist(), price.tolist()
    queue: deque[tuple[int, int, int]] = deque([(0, 0, -1)])  # (best + t, t, place)
    come = [0] * len(at)
    for j, (tj, pj) in enumerate(zip(at, cost, strict=True)):
        while queue[0][1] < tj - length:
            queue.popleft()
        value, _, come[j] = queue[0]
        value += pj + length
        while queue and queue[-1][0] >= value:
            queue.pop()
        queue.append((value, tj, j))
    out, j = [], len(at) - 1
    while j >= 0:
        out.append(j)
        j = come[j]
    return out[::-1]


def pack_block(ids: list, blobs: list[bytes], length: int = LENGTH, first_window: int = 0) -> tuple[list[pa.Array], int]:
    """Columns doc_id, start, length, ids_crc32, doc_tokens, window, offset; the number of the next window."""
    parts = [np.frombuffer(x, "<u4").reshape(-1, 3) for x in blobs]
    rows = np.concatenate(parts)
    per = np.array([len(p) for p in parts])
    doc = np.repeat(np.arange(len(parts)), per)
    tokens = np.array([p[-1, 0] for p in parts], np.int64)
    base = np.concatenate([[0], np.cumsum(tokens)])
    inner, crc, kind = rows[:, 0].astype(np.int64), rows[:, 1], rows[:, 2]
    t = base[doc] + inner
    ends = np.array(cuts(t, np.array([0, SENTENCE, INSIDE])[kind], length))
    # pieces end at every cut and at every document's end
    is_end = kind == 0
    is_end[ends] = True
    at = np.flatnonzero(is_end)
    same = np.zeros(len(at), bool)
    same[1:] = doc[at[1:]] == doc[at[:-1]]
    start = np.where(same, np.roll(inner[at], 1), 0)
    before = np.where(same, np.roll(crc[at], 1), 0)
    size = inner[at] - start
    keep = size > 0
    window = np.searchsorted(ends, at)
    window_start = np.concatenate([[0], t[ends]])[window]
    offset = base[doc[at]] + start - window_start
    crcs = piece_crc(before[keep], crc[at][keep], size[keep])
    ids_array = pa.array(ids, pa.int64()).take(pa.array(doc[at][keep]))
    return [ids_array, pa.array(start[keep]), pa.array(size[keep]), pa.array(crcs.astype(np.int64)), pa.array(tokens[doc[at]][keep]), pa.array(window[keep] + first_window), pa.array(offset[keep])], first_window + len(ends)


_NAMES = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "window", "offset", "part"]


def pack(docs: DataFrame, path: str, length: int = LENGTH, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset of every piece."""
    if length > LENGTH or length < STEP:
        raise ValueError(f"length must lie in {STEP}..{LENGTH}")
    spark = docs.sparkSession
    # a range of documents each; the rows are small, so AQE joins ranges to few tasks
    # saved first, as ranging samples its input and would encode the texts a second time
    ranged = common.save(places(docs, path), "places").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "doc_tokens", "places")

    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, nxt = TaskContext.get().partitionId(), 0
        ids, blobs, held = [], [], 0

        def out() -> pa.RecordBatch:
            nonlocal nxt, ids, blobs, held
            columns, nxt = pack_block(ids, blobs, length, nxt)
            ids, blobs, held = [], [], 0
            return pa.RecordBatch.from_arrays([*columns, pa.array(np.full(len(columns[0]), part, np.int32))], _NAMES)

        for batch in batches:
            for d, n, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                ids.append(d)
                blobs.append(blob)
                held += n
                if held >= block_tokens:
                    yield out()
        if ids:
            yield out()

    pieces = common.save(ranged.mapInArrow(body, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, window long, offset long, part int"), "pieces")
    base, offsets = 0, []
    for part, n in sorted((r["part"], r["n"]) for r in pieces.groupBy("part").agg((F.max("window") + 1).alias("n")).collect()):  # a row for each task
        offsets.append((part, base))
        base += n
    return pieces.join(F.broadcast(spark.createDataFrame(offsets, "part int, base long")), "part").select("doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("base") + F.col("window")).alias("sequence_id"), "offset")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as p

    return pack(common.table(spark, sf_dir, "documents"), p.path("word_bpe_49k.json"))
