"""Language identification by rank-order profiles (operator 10).

A profile is the list of the most frequent letter n-grams (one to three letters,
words padded with a blank), most frequent first. A text's own profile is
compared with that of each language by the out-of-place distance: the sum of the
differences of ranks, an absent n-gram counting the profile's length. The
smallest distance wins; ties go to the language that sorts first.

Profiles are learnt from all training texts: every task counts n-grams by
language over its rows and hands on one row for each distinct pair, which are
summed and ranked; what reaches the driver is PROFILE rows a language.

Defined results: a null text, or one without letters, is `und` with score 0;
texts are read whole; ties and repeated rows are judged row by row; without any
training text every row is `und`; an empty table gives an empty result; extra
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import common, kernel

#: n-grams of a profile.
PROFILE = 300
#: One in so many labelled texts may score below what the pipeline keeps.
LOW = 1000
FOLDS = 5
_CODES = 1 << 21  # a code point has 21 bits; three make one n-gram's code


def _letter_table() -> np.ndarray:
    """Code point -> its lower-case letter, or 0 where it is no letter."""
    out = np.zeros(0x110000, np.uint32)
    for c in range(0x110000):
        if (0xD800 > c or c > 0xDFFF) and (ch := chr(c)).isalpha():
            low = ch.lower()
            out[c] = ord(low[0])
    return out


_table: np.ndarray | None = None


def letters(text: str) -> np.ndarray:
    """Lower-case letters of text; every run of others is one blank (0), as are both ends."""
    global _table
    if _table is None:
        _table = _letter_table()
    x = _table[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
    x = np.concatenate([np.zeros(1, np.uint32), x, np.zeros(1, np.uint32)])
    keep = np.ones(len(x), bool)
    keep[1:] = (x[1:] != 0) | (x[:-1] != 0)
    return x[keep]


def grams(x: np.ndarray) -> np.ndarray:
    """Codes of the n-grams of 1 to 3 that hold a letter and no inner blank."""
    y = x.astype(np.uint64)
    one = y[y != 0]
    a, b = y[:-1], y[1:]
    two = (a * np.uint64(_CODES) + b + np.uint64(1 << 42))[(a != 0) | (b != 0)]
    if len(y) > 2:
        a, b, c = y[:-2], y[1:-1], y[2:]
        three = (((a * np.uint64(_CODES) + b) * np.uint64(_CODES)) + c)[b != 0] | np.uint64(1 << 63)
        return np.concatenate([one, two, three])
    return np.concatenate([one, two])


def ranked(codes: np.ndarray, counts: np.ndarray, size: int = PROFILE) -> np.ndarray:
    """The most frequent codes, ties by code."""
    order = np.lexsort((codes, -counts))[:size]
    return codes[order]


def _count(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    x = np.sort(x)
    at = np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]])) if len(x) else np.zeros(0, np.int64)
    return x[at], np.diff(np.append(at, len(x)))


class Profiles:
    """Languages and, for each, ranks by n-gram in one sorted table."""

    def __init__(self, rows: list[tuple[str, int, int]], size: int = PROFILE) -> None:
        self.size = size
        self.langs = sorted({r[0] for r in rows})
        codes = np.array(sorted({r[1] & 0xFFFFFFFFFFFFFFFF for r in rows}), np.uint64)
        self.codes = codes
        self.rank = np.full((len(self.langs), len(codes)), -1, np.int64)
        for lang, code, rank in rows:
            self.rank[self.langs.index(lang), np.searchsorted(codes, np.uint64(code & 0xFFFFFFFFFFFFFFFF))] = rank

    def predict(self, text: str | None) -> tuple[str, float]:
        x = letters(text) if text else np.zeros(0, np.uint32)
        if not x.any() or not self.langs:
            return "und", 0.0
        own = ranked(*_count(grams(x)), self.size)
        at = np.minimum(np.searchsorted(self.codes, own), len(self.codes) - 1)
        known = self.codes[at] == own
        theirs = np.where(known, self.rank[:, at], -1)
        off = np.where(theirs >= 0, np.minimum(np.abs(theirs - np.arange(len(own))), self.size), self.size)
        near = 1.0 - off.sum(1) / (self.size * len(own))
        best = int(np.argmax(near))
        return self.langs[best], float(min(1.0, max(0.0, near[best])))


def count_grams(df: DataFrame) -> DataFrame:
    """(lang, gram, n) over the rows of (text, lang)."""

    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[np.ndarray, np.ndarray]] = {}

        def add(lang: str, codes: np.ndarray, counts: np.ndarray) -> None:
            if lang in held:
                codes, counts = np.concatenate([held[lang][0], codes]), np.concatenate([held[lang][1], counts])
                order = np.argsort(codes, kind="stable")
                codes, counts = codes[order], counts[order]
                at = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
                codes, counts = codes[at], np.add.reduceat(counts, at)
            held[lang] = codes, counts

        def out() -> Iterator[pa.RecordBatch]:
            for lang, (codes, counts) in held.items():
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(codes), pa.string()), pa.array(codes.view(np.int64)), pa.array(counts.astype(np.int64))], ["lang", "gram", "n"])
            held.clear()

        for batch in batches:
            _, offsets = kernel.utf8(batch.column(0))
            for a, b in kernel.blocks(offsets):
                by: dict[str, list[str]] = {}
                for text, lang in zip(batch.column(0).slice(a, b - a).to_pylist(), batch.column(1).slice(a, b - a).to_pylist(), strict=True):
                    by.setdefault(lang, []).append(text)
                for lang, texts in by.items():
                    codes, counts = _count(grams(letters("\0".join(texts))))
                    if len(codes):
                        add(lang, codes, counts)
                if sum(len(c) for c, _ in held.values()) > 1 << 20:
                    yield from out()
        yield from out()

    return df.select("text", "lang").mapInArrow(body, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def learn(training: DataFrame, size: int = PROFILE) -> Profiles:
    """Profiles of the non-null languages of (text, lang); all rows count."""
    counts = count_grams(training.where("text IS NOT NULL AND lang IS NOT NULL"))
    # one slice of ranks a language and salt first, so that no task sorts all n-grams of a large language
    salted = counts.withColumn("_salt", F.pmod(F.xxhash64("gram"), F.lit(64)))
    unsigned = F.col("gram").bitwiseXOR(F.lit(-(1 << 63)))
    first = salted.withColumn("_r", F.row_number().over(Window.partitionBy("lang", "_salt").orderBy(F.desc("n"), unsigned))).where(F.col("_r") <= size)
    best = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), unsigned)) - 1).where(F.col("rank") < size)
    return Profiles([(r["lang"], r["gram"], r["rank"]) for r in best.select("lang", "gram", "rank").collect()], size)


def identify(df: DataFrame, profiles: Profiles, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, lang_pred, score; no shuffle."""
    shared = df.sparkSession.sparkContext.broadcast(profiles)

    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            found = [model.predict(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())], ["key", "lang_pred", "score"])

    rows = df.select(df[key].alias("key"), df[text].alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(body, f"key {kind}, lang_pred string, score double").withColumnRenamed("key", key)


def least_score(training: DataFrame, profiles: Profiles) -> float:
    """The score that all but one in LOW of the labelled texts with letters reach; 0 without any."""
    scores = identify(training.where("text IS NOT NULL AND lang IS NOT NULL"), profiles, "lang").where("lang_pred <> 'und'")
    return scores.agg(F.percentile_approx("score", 1 / LOW, LOW * 10).alias("s")).first()["s"] or 0.0


def keep_known(docs: DataFrame, profiles: Profiles, least: float = 0.0) -> DataFrame:
    """The rows of docs whose text is in a language that can be told: with letters, a score above 0 and of `least` at least.

    Without profiles nothing can be told apart, and all rows with letters stay. No shuffle.
    """
    shared = docs.sparkSession.sparkContext.broadcast(profiles)
    at = docs.columns.index("text")

    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            yield batch.filter(pa.array([told(model, t.as_py()) for t in batch.column(at)], pa.bool_()))

    def told(model: Profiles, text: str | None) -> bool:
        if not model.langs:
            return bool(text) and bool(letters(text).any())
        score = model.predict(text)[1]
        return score > 0 and score >= least

    return docs.mapInArrow(body, docs.schema)


def held_out(column: str = "doc_id"):
    return F.pmod(common.crc_of_id(column), F.lit(FOLDS)) == 0


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    profiles = learn(docs.where(~held_out()).select("text", "lang"))
    return identify(docs, profiles).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
