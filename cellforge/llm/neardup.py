"""Near-duplicate documents by a multi-index Hamming join of MinHash signatures (operator 4).

A document's signature has CHUNKS * SYMBOLS MinHash values of 16 bits. The
distance of two signatures is the number of values that differ. By pigeonhole,
signatures at a distance up to CHUNKS * (ERRORS + 1) - 1 have a chunk with at most
ERRORS differing values; each chunk enters the index once for every choice of
ERRORS positions left out, so that all such pairs share a key: 60 keys a document
guarantee every pair with up to 23 of 60 values different. (Two documents at the
similarity threshold differ in 12 of 60 on average; the chance that no chunk
agrees to within an error, which alone loses them, is (1 - 0.737)**12 = 1e-7.)

Rows with the same shingle set are first folded into one node. The nodes of a key
are not paired with each other: in each of ROUNDS rounds all of them are compared
with the key's most popular one, the one with the most partners over all its keys,
which is then done with in that key; components form, and a key is closed when the
nodes left in it lie in one component. What is left after that, keys with many nodes
that are no links of each other, is a query set: nodes outside their key's largest
component are held against all nodes of the key, in blocks and slices of at most
UNIT_BYTES each, which are dealt to tasks; neither pairs nor sets pass through the
driver. Links are decided on full shingle sets. Thousands of near copies so cost a
few comparisons each, and no link between different texts is lost.

Defined results: a null or empty text has an empty set and is linked with nothing;
with fewer words than a shingle, the whole sequence is the one shingle; repeated
rows of one doc_id get one row each, linked by their own texts; component_id is the
smallest doc_id reached, so ties cannot be; an empty table gives an empty result;
extra columns are not read. Rows with a null doc_id are returned unlinked, each with
a null component, and count as kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, kernel

CHUNKS, SYMBOLS, ERRORS = 12, 5, 1
#: Rounds against one popular document a key; bytes of a block and of a slice of the rest.
ROUNDS, UNIT_BYTES = 2, 4 << 20
#: Largest distance at which the index is certain to pair two signatures.
GUARANTEED = CHUNKS * (ERRORS + 1) - 1

_seeds = np.random.RandomState(97).randint(1, 1 << 62, (2, CHUNKS * SYMBOLS), dtype=np.int64).astype(np.uint64)
_XOR, _MUL = _seeds[0] * np.uint64(2654435761), _seeds[1] | np.uint64(1)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct shingle hashes of all rows one after another, offsets by row)."""
    words = kernel.Words(data, offsets, lower=True)
    h = words.hashes()
    n = np.diff(words.first)
    grams = kernel.runs(h, size)
    row = words.row[: len(grams)]
    inside = row == words.row[size - 1 : size - 1 + len(grams)]
    grams, row = grams[inside], row[inside]
    few = np.flatnonzero((n > 0) & (n < size))
    if len(few):  # the whole sequence is the one shingle
        whole = []
        for r in few:
            part = h[words.first[r] : words.first[r + 1]]
            whole.append(kernel.runs(part, len(part))[0] ^ np.uint64(len(part)))
        grams, row = np.concatenate([grams, np.array(whole, np.uint64)]), np.concatenate([row, few])
    order = np.lexsort((grams, row))
    grams, row = grams[order], row[order]
    new = np.ones(len(grams), bool)
    new[1:] = (grams[1:] != grams[:-1]) | (row[1:] != row[:-1])
    grams, row = grams[new], row[new]
    return grams, np.searchsorted(row, np.arange(len(offsets)))


def signature(grams: np.ndarray) -> np.ndarray:
    """16-bit MinHash values of one set (not empty), in slices of bounded memory."""
    low = np.full(len(_MUL), np.iinfo(np.uint64).max, np.uint64)
    for a in range(0, len(grams), 4096):
        x = (grams[a : a + 4096, None] ^ _XOR) * _MUL
        low = np.minimum(low, (x ^ (x >> np.uint64(32))).min(axis=0))
    return (kernel.mix(low) >> np.uint64(48)).astype(np.uint16)


def index_keys(signatures: np.ndarray) -> np.ndarray:
    """(documents, keys): for each chunk and each choice of positions left out, a 64-bit key."""
    chunks = signatures.reshape(len(signatures), CHUNKS, SYMBOLS).astype(np.uint64)
    out = []
    for c in range(CHUNKS):
        for left in combinations(range(SYMBOLS), ERRORS):
            key = np.full(len(chunks), np.uint64(c * 131 + sum((p + 1) * 17**i for i, p in enumerate(left))), np.uint64)
            for p in range(SYMBOLS):
                if p not in left:
                    key = kernel.mix(key * np.uint64(0x9FB21C651E98DF25) + chunks[:, c, p] + np.uint64(1))
            out.append(key)
    return np.stack(out, axis=1).view(np.int64)


def _set_hash(grams: np.ndarray) -> bytes | None:
    """128 bits of a whole set."""
    return grams.sum(dtype=np.uint64).tobytes() + np.bitwise_xor.reduce(kernel.mix(grams)).tobytes() if len(grams) else None


def sketches(docs: DataFrame, size: int) -> DataFrame:
    """rid (a number of the row, to be saved with it), doc_id, n_shingles, set_hash, sig of every row of (doc_id, text)."""

    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nxt = TaskContext.get().partitionId() << 40
        for batch in batches:
            data, offsets = kernel.utf8(batch.column(1))
            for a, b in kernel.blocks(offsets):
                grams, at = shingle_sets(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], size)
                sets = [grams[at[i] : at[i + 1]] for i in range(b - a)]
                columns = [pa.array(nxt + np.arange(b - a)), batch.column(0).slice(a, b - a), pa.array(np.diff(at), pa.int64()), pa.array([_set_hash(x) for x in sets], pa.binary()), pa.array([signature(x).tobytes() if len(x) else None for x in sets], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["rid", "doc_id", "n_shingles", "set_hash", "sig"])
                nxt += b - a

    return docs.select("doc_id", "text").mapInArrow(body, "rid long, doc_id long, n_shingles long, set_hash binary, sig binary")


def keyed(reps: DataFrame) -> DataFrame:
    """(key, node) for every index key of every node (node, sig)."""

    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 2048):
                part = batch.slice(a, 2048)
                sig = np.frombuffer(b"".join(part.column(1).to_pylist()), np.uint16).reshape(part.num_rows, -1)
                keys = index_keys(sig)
                ids = np.repeat(part.column(0).to_numpy(), keys.shape[1])
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(ids)], ["key", "node"])

    return reps.select("node", "sig").mapInArrow(body, "key long, node long")


def similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether 100 * |both| >= percent * |either|, of sorted sets."""
    least, most = sorted((len(x), len(y)))
    if 100 * least < percent * most:  # too different in size to be linked
        return False
    z = np.sort(np.concatenate([x, y]), kind="stable")
    both = int((z[1:] == z[:-1]).sum())
    return 100 * both >= percent * (len(x) + len(y) - both)


def verified(pairs: DataFrame, full: DataFrame, percent: int) -> DataFrame:
    """Those pairs (u, v) whose full shingle sets (node, grams) have 100 * |both| >= percent * |either|."""
    both = (
        pairs.join(full.select(F.col("node").alias("u"), F.col("grams").alias("gu")), "u")
        .join(full.select(F.col("node").alias("v"), F.col("grams").alias("gv")), "v")
        .select("u", "v", "gu", "gv")
    )

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [similar(np.frombuffer(gu.as_buffer(), np.uint64), np.frombuffer(gv.as_buffer(), np.uint64), percent) for gu, gv in zip(batch.column(2), batch.column(3), strict=True)]
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return common.save(both.mapInArrow(test, "u long, v long"), "links")


def against_rest(rest: DataFrame, members: DataFrame, full: DataFrame, percent: int, limit: int = UNIT_BYTES) -> DataFrame:
    """Links (u, v) between rows of rest and of members that share a key and lie in different components.

    Both have key, node, comp, n (size of the set); full has node, grams. Of each key,
    blocks of rest meet slices of members, both of about `limit` bytes: a task holds
    one of each. Small keys share a task by their hash.
    """
    whole = members.groupBy("key").agg(F.sum("n").alias("_m")).join(rest.groupBy("key").agg(F.sum("n").alias("_r")), "key")
    parts = lambda c: F.ceil(F.col(c) * 8 / limit).cast("int")
    whole = common.save(whole.select("key", parts("_r").alias("blocks"), parts("_m").alias("slices"), (F.col("_m") + F.col("_r")).alias("_n")), "units")
    shared = max(1, -(-8 * (whole.where("blocks * slices = 1").agg(F.sum("_n")).first()[0] or 0) // limit))
    place = lambda c: F.pmod(F.xxhash64("node"), F.col(c)).cast("int")
    every = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    dealt = None
    for side, df in ((True, rest), (False, members)):
        df = df.join(whole.drop("_n"), "key")
        df = df.withColumn("i", place("blocks")).withColumn("j", every("slices")) if side else df.withColumn("j", place("slices")).withColumn("i", every("blocks"))
        unit = F.when(F.col("blocks") * F.col("slices") == 1, F.pmod(F.xxhash64("key"), F.lit(shared))).otherwise(F.xxhash64("key", "i", "j"))
        df = df.select(unit.alias("unit"), "key", F.lit(side).alias("asks"), "node", "comp")
        dealt = df if dealt is None else dealt.unionByName(df)

    def body(table: pa.Table) -> pa.Table:
        keys, asks, nodes, comps = (table[c].to_numpy() for c in ("key", "asks", "node", "comp"))
        grams = table["grams"]
        set_of = lambda i: np.frombuffer(grams[i].as_buffer(), np.uint64)
        found: set[tuple[int, int]] = set()
        order = np.lexsort((asks, keys))
        for group in np.split(order, np.flatnonzero(np.diff(keys[order])) + 1):
            queries, others = group[asks[group]].tolist(), group[~asks[group]]
            if not queries or not len(others):
                continue
            # shingles of the slice in order, each with its node: a query meets only those it has
            sets = [set_of(i) for i in others.tolist()]
            size = np.array([len(x) for x in sets])
            owner = np.repeat(np.arange(len(sets)), size)
            every = np.concatenate(sets)
            by = np.argsort(every, kind="stable")
            every, owner = every[by], owner[by]
            for q in queries:
                x = set_of(q)
                low = np.searchsorted(every, x)
                n = np.searchsorted(every, x, "right") - low
                at = np.repeat(low - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
                both = np.bincount(owner[at], minlength=len(sets))
                near = np.flatnonzero((100 * both >= percent * (len(x) + size - both)) & (comps[others] != comps[q]))
                found.update((min(nodes[q], nodes[o]), max(nodes[q], nodes[o])) for o in others[near].tolist())
        return pa.table([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], ["u", "v"])

    out = common.save(dealt.join(full, "node").groupBy("unit").applyInArrow(body, "u long, v long").distinct(), "restlinks")
    common.drop(whole)
    return out


def node_sets(docs: DataFrame, needed: DataFrame, size: int) -> DataFrame:
    """node, grams (sorted shingle hashes) of the nodes needed (doc_id, node, set_hash), from a row of (doc_id, text) each."""

    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = kernel.utf8(batch.column(1))
            for a, b in kernel.blocks(offsets):
                grams, at = shingle_sets(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], size)
                sets = [grams[at[i] : at[i + 1]] for i in range(b - a)]
                wanted = batch.column(3).slice(a, b - a).to_pylist()
                keep = [i for i, x in enumerate(sets) if _set_hash(x) == wanted[i]]  # another text of the same doc_id goes
                yield pa.RecordBatch.from_arrays([batch.column(2).slice(a, b - a).take(pa.array(keep, pa.int64())), pa.array([sets[i].tobytes() for i in keep], pa.binary())], ["node", "grams"])

    return docs.join(needed, "doc_id").select("doc_id", "text", "node", "set_hash").mapInArrow(body, "node long, grams binary")


def link(docs: DataFrame, size: int = 5, percent: int = 80, rounds: int = ROUNDS, unit_bytes: int = UNIT_BYTES) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of (doc_id, text)."""
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    sketch = common.save(sketches(docs, size), "sketch")
    filled = sketch.where("set_hash IS NOT NULL AND doc_id IS NOT NULL")
    folds = common.save(filled.groupBy("set_hash").agg(F.min("rid").alias("node"), F.min("doc_id").alias("low"), F.count("*").alias("n")), "folds")
    node_of = common.save(common.join_keyed(filled.select("rid", "doc_id", "set_hash"), folds, "set_hash").select("rid", "doc_id", "set_hash", "node", "low"), "nodes")
    reps = node_of.where("rid = node")
    keys = common.save(keyed(filled.select("rid", "sig").join(reps.select("rid", "node"), "rid")), "keys")
    # keys of a single node link nothing
    popular = common.save(keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "popular")
    shared = common.save(common.join_keyed(keys, popular, "key"), "shared")
    common.drop(keys, popular)
    # nodes with the most partners lie closest to what a group was copied from
    rank = common.save(shared.groupBy("node").agg(F.sum("n").alias("pop")), "rank")
    needed = reps.join(rank.select("node"), "node", "left_semi").select("doc_id", "node", "set_hash")
    full = node_sets(docs, needed, size)
    if not filled.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").isEmpty():
        full = full.groupBy("node").agg(F.min("grams").alias("grams"))  # repeated rows give their set once
    full = common.save(full, "sets")
    links = spark.createDataFrame([], "u long, v long")
    labels: DataFrame | None = None
    left = shared.select("key", "node")
    for turn in range(rounds + 1):
        own = left.join(labels, "node", "left").select("key", "node", F.coalesce("component", "node").alias("comp")) if labels else left.withColumn("comp", F.col("node"))
        mixed = own.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low <> high").select("key")
        still = common.save(own.join(mixed, "key", "left_semi"), "open")
        if still.isEmpty():
            common.drop(still)
            break
        if turn < rounds:
            # every node of a key against the key's most popular one, which is then done with there
            heads = still.join(rank, "node").groupBy("key").agg(F.max_by(F.struct(F.col("node").alias("hub"), F.col("comp").alias("hub_comp")), F.struct("pop", F.negate("node"))).alias("h")).select("key", "h.*")
            near = common.save(still.join(heads, "key").where("node <> hub"), "near")  # AQE splits the rows of a hot key
            pairs = near.where("comp <> hub_comp").select(F.least("hub", "node").alias("u"), F.greatest("hub", "node").alias("v")).distinct()
            more = verified(pairs, full, percent)
            common.drop(still, left if left is not shared else None)
            left = near.select("key", "node")
            left._scratch = near._scratch
        else:
            # what is not in a key's largest component, in full against all of the key
            large = still.groupBy("key", "comp").agg(F.count("*").alias("n")).groupBy("key").agg(F.max_by("comp", F.struct("n", "comp")).alias("major"))
            members = common.save(still.join(full.select("node", (F.length("grams") / 8).cast("long").alias("n")), "node").select("key", "node", "comp", "n"), "members")
            rest = members.join(large, "key").where("comp <> major").select("key", "node", "comp", "n")
            more = against_rest(rest, members, full, percent, unit_bytes)
            common.drop(still, members)
        old, links = links, common.save(links.unionByName(more), "links")
        common.drop(old, more, labels)
        labels = common.components(links)
    common.drop(shared, full, rank, left)
    whole = node_of.select("rid", "node", "low")
    if labels:
        ends = folds.select("node", "low").join(labels, "node")
        ends = ends.join(ends.groupBy("component").agg(F.min("low").alias("least")), "component").select("node", "least")
        whole = whole.join(ends, "node", "left").select("rid", F.coalesce("least", "low").alias("low"))
    whole = whole.select("rid", F.col("low").alias("component_id"))
    return sketch.select("rid", "doc_id", "n_shingles").join(whole, "rid", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def keep_first(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """docs without documents that are not the smallest of their class (rows with a null doc_id stay)."""
    later = link(docs, size, percent).where("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(later, "doc_id", "left_anti").select(docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = link(common.table(spark, sf_dir, "documents"), size=2, percent=80)
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
