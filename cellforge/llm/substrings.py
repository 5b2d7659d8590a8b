"""Removal of repeated word windows with a log-structured fingerprint index (operator 9).

A window of WINDOW words is filed under its anchor: the smallest hash among the
GRAM-word runs inside it (the first one of equals). Equal windows have equal
anchors, and neighbouring windows mostly share one, so the index holds about two
rows for every WINDOW - GRAM words instead of one a word, yet finds every window.

The index lives in a folder and is opened by its path, in this session or a later
one. It is a list of immutable runs, each a table of (anchor, doc_id) bucketed and
sorted by anchor, and the filed documents, bucketed by doc_id. A new batch
 1. is written as a new run,
 2. is merge-joined with the older runs and itself, bucket by bucket, so that the
    history is not shuffled: anchors held by two documents. The few anchors of more
    than 1 / common.HOT of a run's rows are kept beside the buckets and joined by
    broadcast (there are at most common.HOT of them a run),
 3. is verified: the documents that hold such an anchor are read again, their
    windows under it told apart by a cryptographic digest (BLAKE2b, 128 bits) of
    their words, and each window's smallest document found,
 4. loses the words covered by windows that also start in a smaller document,
and runs of one level are compacted into one of the next when FAN_IN of them exist.
Batches come in ascending ranges of doc_id, so an older document never changes; the
index refuses a batch that does not.

Defined results: null and empty texts have no words; texts of fewer than WINDOW
words lose nothing; repeated rows of one doc_id are the same document and treated
alike; rows with a null doc_id lose nothing and are not indexed; an empty table
gives an empty result; extra columns, whatever their names, are kept by
`deduplicate` and not read by the query.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, kernel

WINDOW, GRAM = 50, 8
#: Runs of a level before they are compacted; batches of the query.
FAN_IN, BATCHES = 2, 3
#: Bytes of text to a bucket of the query's index, where that gives fewer than the session's shuffle partitions.
BUCKET_BYTES = 16 << 20


def anchors(hashes: np.ndarray, row: np.ndarray, window: int = WINDOW, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word, row, anchor hash) of every window that stays inside its row."""
    grams = kernel.runs(hashes, gram)
    span = window - gram + 1
    n = len(hashes) - window + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    low, have = grams, 1
    while have * 2 <= span:  # sliding minimum by doubling
        low = np.minimum(low[: len(low) - have], low[have:])
        have *= 2
    low = np.minimum(low[:n], low[span - have : span - have + n])
    start = np.flatnonzero(row[:n] == row[window - 1 : window - 1 + n])
    return start, row[start], low[start]


def _blocks(batch: pa.RecordBatch, at: int) -> Iterator[tuple[int, int, kernel.Words]]:
    data, offsets = kernel.utf8(batch.column(at))
    for a, b in kernel.blocks(offsets):
        yield a, b, kernel.Words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])


def profile(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, text_key, n_words, kept_sha256 of all words, anchors (distinct) of every row."""

    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, words in _blocks(batch, 1):
                h = words.hashes()
                _, row, low = anchors(h, words.row, window)
                change = np.ones(len(low), bool)
                change[1:] = (low[1:] != low[:-1]) | (row[1:] != row[:-1])
                low, row = low[change], row[change]
                at = np.searchsorted(row, np.arange(b - a + 1))
                raw = words.texts()
                sha, found = [], []
                for i in range(b - a):
                    sha.append(hashlib.sha256(b" ".join(raw[words.first[i] : words.first[i + 1]])).hexdigest())
                    found.append(np.unique(low[at[i] : at[i + 1]]).view(np.int64))
                sizes = pa.array(np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int32))
                lists = pa.ListArray.from_arrays(sizes, pa.array(np.concatenate(found) if found else np.zeros(0, np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), batch.column(2).slice(a, b - a), pa.array(np.diff(words.first), pa.int64()), pa.array(sha), lists], ["doc_id", "text_key", "n_words", "kept_sha256", "anchors"])

    return docs.select("doc_id", "text", "text_key").mapInArrow(body, "doc_id long, text_key long, n_words long, kept_sha256 string, anchors array<long>")


def windows_under(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(fp, doc_id, text_key, pos) of the windows whose anchor is in the row's wanted array; fp is a digest of the words."""

    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = hashlib.blake2b
        for batch in batches:
            wanted = batch.column(3)
            for a, b, words in _blocks(batch, 1):
                h = words.hashes()
                start, row, low = anchors(h, words.row, window)
                at = np.searchsorted(row, np.arange(b - a + 1))
                keep = np.zeros(len(start), bool)
                for i in range(b - a):
                    own = np.frombuffer(np.asarray(wanted[a + i].values), np.int64).view(np.uint64)
                    keep[at[i] : at[i + 1]] = np.isin(low[at[i] : at[i + 1]], own)
                start, row = start[keep], row[keep]
                # all words of the block, each with one blank after it
                size = words.length + 1
                begin = np.concatenate([[0], np.cumsum(size)])
                spaced = memoryview(b" ".join(words.texts()) + b" ")
                fp = [digest(spaced[i:j], digest_size=16).digest() for i, j in zip(begin[start].tolist(), (begin[start + window] if len(start) else start).tolist(), strict=True)]
                ids, keys = batch.column(0).slice(a, b - a).to_numpy(), batch.column(2).slice(a, b - a).to_numpy()
                pos = (start - words.first[row]).astype(np.int32)
                for k in range(0, len(fp), 1 << 16):
                    part = slice(k, k + (1 << 16))
                    yield pa.RecordBatch.from_arrays([pa.array(fp[part], pa.binary()), pa.array(ids[row[part]]), pa.array(keys[row[part]]), pa.array(pos[part])], ["fp", "doc_id", "text_key", "pos"])

    return docs.select("doc_id", "text", "text_key", "wanted").mapInArrow(body, "fp binary, doc_id long, text_key long, pos int")


def cut(docs: DataFrame, window: int = WINDOW, as_text: bool = False) -> DataFrame:
    """doc_id, text_key, n_removed and the sha256 of the kept words or, as_text, the text without the covered words.

    docs has pos, the array of window starts. Text around kept words stays as it
    is; the white space before a removed word goes with it.
    """
    extra = "text string" if as_text else "kept_sha256 string"

    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, out = [], []
            for a, b, words in _blocks(batch, 1):
                raw = words.texts()
                for i in range(b - a):
                    first, last = int(words.first[i]), int(words.first[i + 1])
                    pos = np.frombuffer(np.asarray(batch.column(3)[a + i].values), np.int32)
                    edge = np.zeros(last - first + window + 1, np.int64)
                    np.add.at(edge, pos, 1)
                    np.add.at(edge, pos + window, -1)
                    gone = np.cumsum(edge)[: last - first] > 0
                    removed.append(int(gone.sum()))
                    stay = np.flatnonzero(~gone)
                    if as_text:
                        source = batch.column(1)[a + i].as_py().encode()
                        out.append(_without(source, gone))
                    else:
                        out.append(hashlib.sha256(b" ".join(raw[first + k] for k in stay.tolist())).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(removed, pa.int64()), pa.array(out, pa.string())], ["doc_id", "text_key", "n_removed", extra.split()[0]])

    return docs.select("doc_id", "text", "text_key", "pos").mapInArrow(body, f"doc_id long, text_key long, n_removed long, {extra}")


def _without(source: bytes, gone: np.ndarray) -> str:
    """source without the words gone and the white space before each of them."""
    spans = [m.span() for m in re.finditer(rb"[^ \t-\r]+", source)]
    parts, at = [], 0
    for (begin, end), drop in zip(spans, gone.tolist(), strict=True):
        if not drop:
            parts.append(source[at:end] if parts or at == 0 else source[begin:end])
        at = end
    parts.append(source[at:])
    return b"".join(parts).decode()


class FingerprintIndex:
    """Runs of (anchor, doc_id) by level, and the filed documents, in one folder; open it by its path."""

    def __init__(self, spark: SparkSession, path: str, window: int = WINDOW, fan_in: int = FAN_IN, buckets: int | None = None) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        held = common.read_text(spark, f"{self.path}/index.json")
        if held is None:
            held = {"window": window, "fan_in": fan_in, "buckets": buckets or int(spark.conf.get("spark.sql.shuffle.partitions")), "high": None, "runs": [], "stores": []}
        else:
            held = json.loads(held)
            if held["window"] != window:
                raise ValueError(f"the index has windows of {held['window']} words, not {window}")
        self.state, self.tables = held, {}

    def _commit(self, **changes) -> None:
        """The list of runs is replaced at once; until then a new run is not part of the index."""
        self.state = self.state | changes
        common.write_text(self.spark, f"{self.path}/index.json", json.dumps(self.state))

    def _write(self, df: DataFrame, by: list[str]) -> str:
        """A bucketed, sorted table of the folder, one file a bucket."""
        name, n = f"part-{uuid.uuid4().hex}", self.state["buckets"]
        table = f"cellforge_{name.replace('-', '_')}"
        writer = df.repartitionById(n, F.pmod(F.hash(by[0]), F.lit(n))).write.bucketBy(n, by[0]).sortBy(*by).option("path", f"{self.path}/{name}").option("compression", "zstd").format("parquet")
        writer.saveAsTable(table)
        self.tables[name] = table
        return name

    def _read(self, name: str, kind: str) -> DataFrame:
        """A table of the folder, with its buckets known to Spark."""
        if name not in self.tables:
            columns, key = {"run": ("anchor BIGINT, doc_id BIGINT", "anchor"), "store": ("doc_id BIGINT, text_key BIGINT, text STRING", "doc_id")}[kind]
            table = f"cellforge_{name.replace('-', '_')}"
            self.spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet CLUSTERED BY ({key}) INTO {self.state['buckets']} BUCKETS LOCATION '{self.path}/{name}'")
            self.tables[name] = table
        return self.spark.table(self.tables[name])

    def _hot(self, run: dict) -> DataFrame | None:
        return self.spark.read.schema("anchor long, doc_id long").parquet(f"{self.path}/{run['hot']}") if run["hot"] else None

    def _run(self, rows: DataFrame, level: int) -> dict:
        """A new run of saved (anchor, doc_id) rows: hot anchors beside the buckets."""
        counts = common.save(rows.groupBy("anchor").agg(F.count("*").alias("n")), "anchors")
        total = counts.agg(F.sum("n")).first()[0] or 0
        hot = common.save(counts.where(F.col("n") * common.HOT > max(total, 1 << 16)).select("anchor"), "hot")  # at most HOT rows
        run = {"level": level, "rows": total, "hot": None}
        if hot.isEmpty():
            run["name"] = self._write(rows, ["anchor", "doc_id"])
        else:
            run["name"] = self._write(rows.join(F.broadcast(hot), "anchor", "left_anti"), ["anchor", "doc_id"])
            run["hot"] = f"hot-{uuid.uuid4().hex}"
            rows.join(F.broadcast(hot), "anchor", "left_semi").write.option("compression", "zstd").parquet(f"{self.path}/{run['hot']}")
        common.drop(counts, hot)
        return run

    def add(self, docs: DataFrame, prof: DataFrame) -> DataFrame:
        """File a batch; its documents with repeated windows as (doc_id, text_key, text, pos array).

        docs: doc_id, text_key, text, no doc_id null; prof: their `profile`.
        """
        low, high = prof.agg(F.min("doc_id"), F.max("doc_id")).first()
        if low is not None and self.state["high"] is not None and low <= self.state["high"]:
            raise ValueError(f"the batch begins at doc_id {low}, but documents up to {self.state['high']} are filed")
        if not prof.groupBy("doc_id", "text_key").agg(F.count("*").alias("n")).where("n > 1").isEmpty():
            docs = docs.groupBy("doc_id", "text_key").agg(F.min("text").alias("text"))
        store = {"name": self._write(docs.select("doc_id", "text_key", "text"), ["doc_id"]), "low": low, "high": high}
        rows = common.save(prof.select("doc_id", F.explode("anchors").alias("anchor")).distinct().select("anchor", "doc_id"), "rows")
        run = self._run(rows, 0)
        common.drop(rows)
        held = common.save(self.shared(run).groupBy("doc_id").agg(F.collect_list("anchor").alias("wanted")), "held")  # a document's own anchors
        found = None
        for x in [*self.state["stores"], store]:
            # the documents are bucketed by doc_id: only what they are asked for moves
            ask = held.where(F.col("doc_id").between(x["low"], x["high"])) if x["low"] is not None else held
            part = windows_under(self._read(x["name"], "store").join(ask.hint("merge"), "doc_id"), self.state["window"])
            found = part if found is None else found.unionByName(part)
        found = common.save(found, "windows")
        first = common.save(found.groupBy("fp").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.count("*").alias("n")).where("low <> high").select("fp", "low", "n"), "first")
        mine = found.where(F.col("doc_id") >= F.lit(low)) if low is not None else found
        again = common.join_keyed(mine, first, "fp").where("doc_id > low").groupBy("doc_id", "text_key").agg(F.collect_list("pos").alias("pos"))
        out = common.save(self._read(store["name"], "store").join(again.hint("merge"), ["doc_id", "text_key"]).select("doc_id", "text_key", "text", "pos"), "again")
        common.drop(held, found, first)
        top = [x for x in (high, self.state["high"]) if x is not None]
        self._commit(runs=[*self.state["runs"], run], stores=[*self.state["stores"], store], high=max(top, default=None))
        self.compact()
        return out

    def shared(self, new: dict) -> DataFrame:
        """(anchor, doc_id): holders, old and new, of the new run's anchors that at least two documents hold."""
        rows, hot = self._read(new["name"], "run"), self._hot(new)
        by = rows.groupBy("anchor").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))  # in place: the buckets are the groups
        hot_by = hot.groupBy("anchor").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")) if hot else None
        hits = []
        for run in self.state["runs"]:
            old, old_hot = self._read(run["name"], "run"), self._hot(run)
            hits.append(old.join(by.select("anchor").hint("merge"), "anchor", "left_semi"))
            if hot:
                hits.append(old.join(F.broadcast(hot_by.select("anchor")), "anchor", "left_semi"))
            if old_hot:
                names = F.broadcast(old_hot.select("anchor").distinct())  # at most HOT
                asked = by.select("anchor").join(names, "anchor", "left_semi")
                if hot:
                    asked = asked.unionByName(hot_by.select("anchor").join(names, "anchor", "left_semi"))
                hits.append(old_hot.join(F.broadcast(asked), "anchor", "left_semi"))
        twice = by.where("low <> high").select("anchor")
        if hits:
            hit = hits[0]
            for x in hits[1:]:
                hit = hit.unionByName(x)
            hit = common.save(hit, "hits")
            twice = twice.unionByName(hit.select("anchor").distinct()).distinct()
        out = rows.join(twice.hint("merge"), "anchor", "left_semi")
        if hot:
            wanted = hot_by.where("low <> high").select("anchor")
            wanted = wanted.unionByName(hit.select("anchor").join(F.broadcast(hot_by.select("anchor")), "anchor", "left_semi").distinct()).distinct() if hits else wanted
            out = out.unionByName(hot.join(F.broadcast(wanted), "anchor", "left_semi"))
        return out.unionByName(hit) if hits else out

    def compact(self) -> None:
        """Merge the runs of every full level into one run of the next."""
        level = 0
        while any(r["level"] >= level for r in self.state["runs"]):
            full = [r for r in self.state["runs"] if r["level"] == level]
            if len(full) >= self.state["fan_in"]:
                merged = None
                for r in full:
                    for part in (self._read(r["name"], "run"), self._hot(r)):
                        if part is not None:
                            merged = part if merged is None else merged.unionByName(part)
                run = self._run(merged, level + 1)
                self._commit(runs=[*[r for r in self.state["runs"] if r["level"] != level], run])
                for r in full:
                    self._forget(r["name"])
                    for x in (r["name"], r["hot"]):
                        if x:
                            common.delete(self.spark, f"{self.path}/{x}")
            level += 1

    def _forget(self, name: str) -> None:
        if name in self.tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.tables.pop(name)}")  # the files stay: the tables are external

    def close(self) -> None:
        for name in list(self.tables):
            self._forget(name)

    def remove(self) -> None:
        self.close()
        common.delete(self.spark, self.path)


def with_key(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key"))


def add_batches(index: FingerprintIndex, docs: DataFrame, batches: int = 1) -> tuple[DataFrame, list[DataFrame]]:
    """(profile of all rows of docs (doc_id, text), for each batch the documents with repeated windows)."""
    docs = with_key(docs)
    prof = common.save(profile(docs, index.state["window"]), "profile")
    bounds = prof.select(F.percentile_approx("doc_id", [k / batches for k in range(1, batches)], 1000)).first()[0] if batches > 1 else []
    edges = [None, *sorted(set(bounds or [])), None]
    out = []
    for low, high in zip(edges, edges[1:], strict=False):
        within = F.col("doc_id").isNotNull()
        if low is not None:
            within &= F.col("doc_id") > low
        if high is not None:
            within &= F.col("doc_id") <= high
        out.append(index.add(docs.where(within), prof.where(within)))
    return prof, out


def bucket_count(docs: DataFrame, size: int = BUCKET_BYTES) -> int:
    """Buckets for an index of docs (text): every table of the index has a file a bucket, and each file written locally starts processes beside the executor."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(1, min(-(-total // size), int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))))


def repeated(docs: DataFrame, window: int = WINDOW, batches: int = BATCHES) -> tuple[DataFrame, list[DataFrame]]:
    """The same with an index that goes afterwards."""
    spark = docs.sparkSession
    index = FingerprintIndex(spark, common.scratch_path(spark, "index"), window, buckets=bucket_count(docs))
    out = add_batches(index, docs, batches)
    index.remove()
    return out


def summarise(prof: DataFrame, parts: list[DataFrame], window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every row that was profiled."""
    changed = cut(parts[0], window)
    for p in parts[1:]:
        changed = changed.unionByName(cut(p, window))
    changed = changed.select("doc_id", "text_key", "n_removed", F.col("kept_sha256").alias("_sha"))
    return prof.drop("anchors").join(changed, ["doc_id", "text_key"], "left").select("doc_id", "n_words", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"), F.coalesce("_sha", "kept_sha256").alias("kept_sha256"))


def summary(docs: DataFrame, window: int = WINDOW, batches: int = BATCHES) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every row."""
    return summarise(*repeated(docs, window, batches), window)


def deduplicate(docs: DataFrame, window: int = WINDOW, batches: int = BATCHES) -> DataFrame:
    """docs with the repeated windows' words cut from text; documents that lose all their words go."""
    _, parts = repeated(docs, window, batches)
    changed = cut(parts[0], window, as_text=True)
    for p in parts[1:]:
        changed = changed.unionByName(cut(p, window, as_text=True))
    new_id, key, text = (common.fresh(docs, x) for x in ("_id", "_key", "_cut_text"))
    changed = changed.select(F.col("doc_id").alias(new_id), F.col("text_key").alias(key), F.col("text").alias(text))
    out = docs.join(changed, (docs["doc_id"] == changed[new_id]) & (F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == changed[key]), "left")
    out = out.where(changed[text].isNull() | changed[text].rlike("[^ \\t-\\r]"))
    return out.select(*[F.coalesce(changed[text], docs["text"]).alias("text") if c == "text" else docs[c] for c in docs.columns])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary(common.table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[ \t\n\x0B\f\r]+'), lambda x: x <> '') AS ws FROM documents),
w AS (SELECT doc_id, i, md5(array_to_string(ws[i:i + 49], ' ')) AS h FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM d)),
m AS (SELECT h, min(doc_id) AS low FROM w GROUP BY h),
r AS (SELECT DISTINCT w.doc_id, i FROM w JOIN m USING (h) WHERE w.doc_id > m.low),
g AS (SELECT doc_id, list(DISTINCT j) AS js FROM (SELECT doc_id, unnest(range(i, i + 50)) AS j FROM r) GROUP BY doc_id),
k AS (SELECT d.doc_id, ws, coalesce(js, []) AS js FROM d LEFT JOIN g USING (doc_id))
SELECT k.doc_id, cast(len(ws) AS BIGINT) AS n_words, cast(len(js) AS BIGINT) AS n_removed,
  sha256(CASE WHEN len(js) = 0 THEN array_to_string(ws, ' ') WHEN len(js) = len(ws) THEN '' ELSE
    array_to_string(list_transform(list_filter(list_zip(ws, range(1, len(ws) + 1)), lambda p: NOT list_contains(js, p[2])), lambda p: p[1]), ' ') END) AS kept_sha256
FROM k
"""
