"""Benchmark passages in documents by q-gram lemma filtering (operator 2).

Texts are lower-cased and white space runs become one blank. A passage of m
characters within k edits of a document's region shares at least m - Q + 1 - k * Q
of its character q-grams with the region, on diagonals that lie within k of each
other. Hits of shared q-grams are counted in diagonal bands of twice the widest
spread that overlap by half, so one band holds all of them; bands that reach the
bound are verified by a banded alignment that gives the exact edit distance of
the passage to the best region.

The edit budget of a passage is RATE * m, rounded down. A passage too short for
the bound to be positive gets the largest budget that keeps it at least 1; one
shorter than Q is searched as a plain substring. The benchmark is taken in blocks of at
most BLOCK_CHARS characters, one pass over the documents each; a block's hits are
saved and its index destroyed before the next, so what is broadcast has a fixed bound
however large the benchmark is. Hits of one document are expanded HITS at a time and
only their counts by band kept, so a long run of one letter against another costs
time, but no memory.

Defined results: null and empty documents match nothing; an empty passage is
matched nowhere; repeated rows give repeated matches; ties of regions go to the
first; an empty table on either side gives an empty result; extra columns are not
read. `decontaminate` judges every row by its own text, whatever its doc_id, keeps
rows with a null text and all columns, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from . import common

Q, RATE = 12, 0.06
#: Characters of the benchmark that one pass over the documents takes.
BLOCK_CHARS = 8 << 20
#: Hits of q-grams that are expanded at once.
HITS = 1 << 20
_BITS = 20
_M = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


def normalise(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def codes(text: str) -> np.ndarray:
    """Hashes of the text's q-grams of 12: of 1, 2, 4, 8 and 8 + 4 characters."""
    x = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    if len(x) < Q:
        return np.zeros(0, np.uint64)
    x = x[:-1] * np.uint64(1 << 21) + x[1:]
    four = x[:-2] * _M[0] + x[2:]
    four ^= four >> np.uint64(29)
    x = four[:-4] * _M[1] + four[4:]
    return x[:-4] * _M[2] + four[8:]


def edit_distance(pattern: str, text: str, low: int, high: int, budget: int) -> tuple[int, int]:
    """(edits, end) of the best match of pattern to a region of text that starts in low..high; budget + 1 if none is within budget.

    Only diagonals low - budget .. high + budget are computed. Insertions along a
    row are resolved by a running minimum.
    """
    p = np.frombuffer(pattern.encode("utf-32-le", "surrogatepass"), np.uint32)
    t = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    first, last = low - budget, high + budget
    width = last - first + 1
    # text by diagonal; outside of it stands a sign that matches nothing, which costs what leaving out a character does
    span = np.full(width + len(p), 0xFFFFFFFF, np.uint32)
    a, b = max(first, 0), min(last + len(p), len(t))
    if a < b:
        span[a - first : b - first] = t[a:b]
    place = np.arange(width, dtype=np.int32)
    row, up = -place, np.full(width, 1 << 30, np.int32)  # edits less the diagonal's number
    for i in range(len(p)):
        np.add(row[1:], 2, out=up[:-1])  # a pattern character left out: from the next diagonal
        row += span[i : i + width] != p[i]
        np.minimum(row, up, out=row)
        np.minimum.accumulate(row, out=row)  # text characters put in
        if i % 16 == 15 and (row + place).min() > budget:
            return budget + 1, -1
    row += place
    best = int(np.argmin(row))
    return int(row[best]), min(first + best + len(p), len(t))


class Benchmark:
    """Index of one block of passages: q-grams sorted by hash, with passage and place."""

    def __init__(self, items: list[tuple[int, str]], rate: float = RATE) -> None:
        self.ids = [i for i, _ in items]
        self.texts = [normalise(t) for _, t in items]
        m = np.array([len(t) for t in self.texts], np.int64)
        grams = m - Q + 1
        most = np.maximum((grams - 1) // Q, 0)  # keeps the bound at 1 or more
        self.budget = np.minimum((m * rate).astype(np.int64), most)
        self.need = np.maximum(grams - self.budget * Q, 1)
        self.short = [k for k in range(len(items)) if 0 < m[k] < Q]
        parts = [codes(t) for t in self.texts]
        code = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
        item = np.repeat(np.arange(len(items)), [len(p) for p in parts])
        place = np.concatenate([np.arange(len(p)) for p in parts]) if parts else np.zeros(0, np.int64)
        order = np.argsort(code, kind="stable")
        self.item, self.place = item[order], place[order]
        self.code, self.at = np.unique(code[order], return_index=True)
        self.at = np.append(self.at, len(code))
        self.seen = np.zeros(1 << _BITS, bool)
        self.seen[(self.code >> np.uint64(64 - _BITS)).view(np.int64)] = True
        self.spread = int(2 * self.budget.max(initial=0) + 1)

    def matches(self, text: str | None) -> list[tuple[int, int, int]]:
        """(passage number, edits, end) for every passage within its budget."""
        doc = normalise(text)
        out = [(k, 0, doc.find(self.texts[k]) + len(self.texts[k])) for k in self.short if self.texts[k] in doc]
        x = codes(doc)
        pos = np.flatnonzero(self.seen[(x >> np.uint64(64 - _BITS)).view(np.int64)])
        if len(pos) and len(self.code):
            x = x[pos]
            where = np.minimum(np.searchsorted(self.code, x), len(self.code) - 1)
            hit = self.code[where] == x
            pos, where = pos[hit], where[hit]
        if not len(pos) or not len(self.code):
            return out
        total = np.concatenate([[0], np.cumsum(self.at[where + 1] - self.at[where])])
        bands, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for a in range(0, int(total[-1]), HITS):
            hit = np.arange(a, min(a + HITS, int(total[-1])))
            of = np.searchsorted(total, hit, "right") - 1
            entry = self.at[where[of]] + hit - total[of]
            shift = pos[of] - self.place[entry] + (1 << 32)
            # overlapping bands: band b holds the diagonals b * spread .. (b + 2) * spread - 1
            band = self.item[entry].astype(np.int64) * (1 << 40) + shift // self.spread
            new, n = np.unique(np.concatenate([band, band - 1]), return_counts=True)
            bands, at = np.unique(np.concatenate([bands, new]), return_inverse=True)
            counts = np.bincount(at, np.concatenate([counts, n]), len(bands)).astype(np.int64)
        kept = bands[counts >= self.need[bands >> 40]]
        best: dict[int, tuple[int, int]] = {}
        for b in kept.tolist():
            k = b >> 40
            if k in best and best[k][0] == 0:
                continue
            low = (b & ((1 << 40) - 1)) * self.spread - (1 << 32)
            budget = int(self.budget[k])
            edits, end = edit_distance(self.texts[k], doc, low, low + 2 * self.spread - 1, budget)
            if edits <= budget and (k not in best or edits < best[k][0]):
                best[k] = edits, end
        return out + [(k, *best[k]) for k in sorted(best)]


def blocks(benchmark: DataFrame, limit: int = BLOCK_CHARS) -> Iterator[list[tuple[int, str]]]:
    """The benchmark's rows in blocks; one block is held at a time."""
    block, size = [], 0
    for row in benchmark.select("item_id", "text").where("text IS NOT NULL AND text <> ''").orderBy("item_id", "text").toLocalIterator():
        if block and size + len(row["text"]) > limit:
            yield block
            block, size = [], 0
        block.append((row["item_id"], row["text"]))
        size += len(row["text"])
    if block:
        yield block


def find(docs: DataFrame, benchmark: DataFrame, rate: float = RATE, limit: int = BLOCK_CHARS) -> DataFrame:
    """(doc_id, item_id, edits, end): every passage found in every document; end counts normalised characters."""
    spark, schema = docs.sparkSession, "doc_id long, item_id long, edits int, end long"
    out = spark.createDataFrame([], schema)
    for block in blocks(benchmark, limit):
        shared = spark.sparkContext.broadcast(Benchmark(block, rate))

        def body(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch in batches:
                rows = [(d, *m) for d, t in zip(batch.column(0).to_pylist(), batch.column(1), strict=True) for m in index.matches(t.as_py())]
                cols = list(zip(*rows, strict=True)) if rows else [(), (), (), ()]
                yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array([index.ids[k] for k in cols[1]], pa.int64()), pa.array(cols[2], pa.int32()), pa.array(cols[3], pa.int64())], ["doc_id", "item_id", "edits", "end"])

        out = out.unionByName(common.save(docs.select("doc_id", "text").where("text IS NOT NULL").mapInArrow(body, schema), "hits"))
        common.drop(shared)
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, rate: float = RATE, limit: int = BLOCK_CHARS) -> DataFrame:
    """docs without those that hold a benchmark passage; saved between blocks and at the end."""
    out, at = docs, docs.columns.index("text")
    for block in blocks(benchmark, limit):
        shared = docs.sparkSession.sparkContext.broadcast(Benchmark(block, rate))

        def body(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch in batches:
                yield batch.filter(pa.array([not index.matches(t.as_py()) for t in batch.column(at)], pa.bool_()))

        old, out = out, common.save(out.mapInArrow(body, docs.schema), "clean")
        common.drop(shared, old if old is not docs else None)
    return out


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each benchmark passage found in a document; documents without any have none."""
    return find(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark"))
