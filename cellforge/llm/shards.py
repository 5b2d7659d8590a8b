"""Reproducible shuffle into shards by a Feistel permutation (operator 8).

Rows get dense global numbers in the order of (doc_id, size, crc32): a range
partitioning sorts narrow rows (never the texts), partition sizes give offsets.
A balanced Feistel network on the smallest even number of bits permutes the
numbers; values outside 0..n-1 walk on along their cycle until they are inside,
so the result is a permutation of 0..n-1. Its value v gives shard v mod shards
and slot v div shards: shard sizes differ by at most one row, slots have no gap,
and both follow from the row number and the key alone, without data.

Defined results: a null text has size 1 and the crc32 of nothing; a null doc_id
sorts first; repeated rows get different numbers, alike in all they return; an
empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

SHARDS, SEED, ROUNDS = 16, 0x5EED, 6


def _round(x: np.ndarray, key: int) -> np.ndarray:
    x = (x + np.uint64(key)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def _keys(seed: int, rounds: int) -> list[int]:
    return [int(x) for x in np.random.RandomState(seed & 0xFFFFFFFF).randint(0, 1 << 62, rounds, dtype=np.int64)]


def _half_bits(n: int) -> int:
    return max(1, (max(n - 1, 1).bit_length() + 1) // 2)


def permute(x: np.ndarray, n: int, seed: int = SEED, rounds: int = ROUNDS) -> np.ndarray:
    """The place of each row number of 0..n-1 in the permutation of 0..n-1."""
    half = np.uint64(_half_bits(n))
    mask = (np.uint64(1) << half) - np.uint64(1)
    out = x.astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> half, out[todo] & mask
        for key in _keys(seed, rounds):
            left, right = right, left ^ (_round(right, key) & mask)
        out[todo] = (left << half) | right
        todo = todo[out[todo] >= np.uint64(n)]
    return out.astype(np.int64)


def invert(y: np.ndarray, n: int, seed: int = SEED, rounds: int = ROUNDS) -> np.ndarray:
    """The row number at each place: the rounds backwards, walking the cycle the other way."""
    half = np.uint64(_half_bits(n))
    mask = (np.uint64(1) << half) - np.uint64(1)
    out = y.astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> half, out[todo] & mask
        for key in reversed(_keys(seed, rounds)):
            left, right = right ^ (_round(left, key) & mask), left
        out[todo] = (left << half) | right
        todo = todo[out[todo] >= np.uint64(n)]
    return out.astype(np.int64)


def number_rows(rows: DataFrame, order: list[str], name: str = "row") -> tuple[DataFrame, int]:
    """rows with dense numbers from 0 in the given order, and how many there are.

    The sorted partitions are written once with their numbers, so a lost executor
    never changes them; the offsets are one row for each partition.
    """
    parts = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_part", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
    parts = common.save(parts, "numbered")
    sizes = [(r["_part"], r["n"]) for r in parts.groupBy("_part").agg(F.count("*").alias("n")).collect()]  # a row for each partition
    base, offsets = 0, []
    for part, n in sorted(sizes):
        offsets.append((part, base))
        base += n
    offset = rows.sparkSession.createDataFrame(offsets, "_part int, _base long")
    return parts.join(F.broadcast(offset), "_part").withColumn(name, F.col("_base") + F.col("_at")).drop("_part", "_at", "_base"), base


def shuffle(rows: DataFrame, order: list[str], shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """rows with shard and slot."""
    numbered, n = number_rows(rows, order, "_row")
    schema = numbered.drop("_row").schema.add("shard", T.IntegerType()).add("slot", T.LongType())

    def kernel(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            place = permute(pdf.pop("_row").to_numpy(np.int64), n, seed)
            yield pdf.assign(shard=(place % shards).astype(np.int32), slot=place // shards)

    return numbered.mapInPandas(kernel, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    rows = common.table(spark, sf_dir, "documents").select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).cast("long").alias("text_crc32"))
    out = shuffle(rows, ["doc_id", "size", "text_crc32"])
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
