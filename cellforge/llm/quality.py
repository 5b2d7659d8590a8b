"""Quality rules as a short-circuit cascade (operator 1, DataFrame functions only).

Every rule is a boolean expression over features of the whole text. On a sample
the operator measures, for each rule, the share of rows it rejects and the time it
takes from the raw text, its features included: the least of RUNS runs over the
sample repeated REPEAT times, less that of a run which evaluates no rule. The rules
are ordered by rejections per cost; the cascade is one CASE, so a row that an earlier
rule rejects never evaluates the later ones. The order changes only which rule is
named and the work done, never the verdict. The counts that the query returns are
made for every row whatever the order; the expressions of the rules themselves, such
as those over letters and capitals, are what a rejection saves.

All the work on a row is done in that row: it needs memory in proportion to its text
(about 100 bytes a word for the 3-word windows of the longest text in a task).

Defined results: a null or empty text has no words and fails the base rule
(fewer than 50 words). Ties and repeated rows are judged row by row. An empty
table gives an empty result. Columns of the input that clash with feature names
are dropped by `base_features`; `apply_rules` keeps them under their own names.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\f\r"
#: Rows at most of the sample on which costs and selectivities are measured.
SAMPLE_ROWS = 400
#: Timed runs of a rule, and how often a run goes over the sample.
RUNS, REPEAT = 3, 4


@dataclass(frozen=True)
class Rule:
    """name; rejects(features, text) -> Column, true where the rule rejects a row."""

    name: str
    rejects: Callable[[], Column]
    cost: float = field(default=1.0, compare=False)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value evaluated once a row, however often body names it in inner lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _count(text: Column, chars: str) -> Column:
    return F.length(text) - F.length(F.translate(text, chars, ""))


def base_features(df: DataFrame, text: str = "text", key: Sequence[str] = ("doc_id",)) -> DataFrame:
    """key columns, `_text` and the counts n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words.

    Repeats: 3-word windows are sorted with their positions, neighbours compared,
    and the positions that repeated windows cover counted once; all inside the
    row, so nothing is shuffled.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    out = df.select(*key, t.alias("_text"))
    out = out.withColumn("_w", F.filter(F.split("_text", r"[ \t-\r]+"), lambda x: x != ""))
    out = out.withColumn("n_words", F.size("_w").cast("long"))
    out = out.withColumn("word_chars", F.length(F.translate("_text", SPACES, "")).cast("long"))
    out = out.withColumn("n_symbols", _count(F.col("_text"), SYMBOLS).cast("long"))
    lines = F.filter(F.split("_text", "\n"), lambda x: x.rlike(r"[^ \t-\r]"))
    out = out.withColumn("_lines", _let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n"), F.size(F.array_distinct(x)).cast("long").alias("d"))))
    out = out.withColumn("n_lines", F.col("_lines.n")).withColumn("n_dup_lines", F.col("_lines.n") - F.col("_lines.d"))
    grams = _let(
        F.col("_w"),
        lambda w: F.transform(
            F.when(F.size(w) >= 3, F.sequence(F.lit(0), F.size(w) - 3)).otherwise(F.expr("cast(array() as array<int>)")),
            lambda i: F.struct(F.concat_ws(" ", F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("g"), i.alias("i")),
        ),
    )
    twice = _let(F.sort_array(grams), lambda g: F.filter(g, lambda e, j: (e["g"] == F.get(g, j - 1)["g"]) | (e["g"] == F.get(g, j + 1)["g"])))
    covered = F.array_distinct(F.flatten(F.transform(twice, lambda e: F.array(e["i"], e["i"] + 1, e["i"] + 2))))
    out = out.withColumn("n_repeat_words", F.size(covered).cast("long"))
    return out.drop("_w", "_lines")


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _letters(pattern: str) -> Column:
    return F.length(F.regexp_replace("_text", pattern, ""))


#: The usual bounds of heuristic web-text filters; all are ratios of whole-text counts.
DEFAULT_RULES: tuple[Rule, ...] = (
    Rule("word_length", lambda: (F.col("word_chars") < 2 * F.col("n_words")) | (F.col("word_chars") > 12 * F.col("n_words"))),
    Rule("symbols", lambda: 10 * F.col("n_symbols") > F.col("n_words")),
    Rule("duplicate_lines", lambda: 10 * F.col("n_dup_lines") > 3 * F.col("n_lines")),
    Rule("capitals", lambda: 10 * F.length(F.regexp_replace("_text", r"[^\p{Lu}]+", "")) > 3 * F.length(F.regexp_replace("_text", r"[^\p{L}]+", ""))),
    Rule("letters", lambda: 10 * F.length(F.regexp_replace("_text", r"[^\p{L}]+", "")) < 7 * F.col("word_chars")),
    Rule("repeated_words", lambda: 100 * F.col("n_repeat_words") > 30 * F.col("n_words")),
)


def order_rules(documents: DataFrame, rules: Sequence[Rule] = DEFAULT_RULES, sample_rows: int = SAMPLE_ROWS) -> list[tuple[Rule, float, float]]:
    """(rule, seconds on the sample, rejected share of what the base rule leaves), most rejections per second first.

    documents: doc_id, text; the sample is at most sample_rows of them, saved once.
    Without rows the rules keep their given order. Only costs and order come from it.
    """
    sample = common.save(documents.select("doc_id", "text").limit(sample_rows).repartition(1), "sample")
    passed = base_features(sample).where(~base_failed())
    passed = common.save(passed.select("doc_id", F.col("_text").alias("text")).repartition(1), "passed")
    n = passed.count()
    often = passed.select("doc_id", "text", F.explode(F.sequence(F.lit(1), F.lit(REPEAT)))).select("doc_id", "text") if n else passed

    def run(reject: Column | None) -> tuple[float, float]:
        began = time.perf_counter()
        share = base_features(often).select(F.avg(F.coalesce(reject, F.lit(False)).cast("double")) if reject is not None else F.avg(F.length("_text"))).first()[0]
        return time.perf_counter() - began, share or 0.0

    found = [(rule, 0.0, 0.0, k) for k, rule in enumerate(rules)]
    if n:
        least = min(run(None)[0] for _ in range(RUNS + 1))
        for k, rule in enumerate(rules):
            times, share = zip(*[run(rule.rejects()) for _ in range(RUNS)], strict=True)
            found[k] = rule, max(min(times) - least, 1e-3), share[0], k
        found.sort(key=lambda x: (-x[2] / x[1], x[3]))
    common.drop(sample, passed)
    return [x[:3] for x in found]


def apply_rules(features: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Adds first_rejection: the name of the first rule in the given order that rejects the row, else null."""
    verdict = F.when(F.col("base_failed"), F.lit("base"))
    for rule in rules:
        verdict = verdict.when(rule.rejects(), F.lit(rule.name))
    return features.withColumn("first_rejection", verdict)


def score_documents(documents: DataFrame, rules: Sequence[Rule] = DEFAULT_RULES, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Base counts, base_failed, kept and first_rejection of every document."""
    docs = documents.select("doc_id", "text")
    ordered = [rule for rule, _, _ in order_rules(docs.sample(0.02, seed=7), rules, sample_rows)]
    full = base_features(docs).withColumn("base_failed", base_failed())
    out = apply_rules(full, ordered)
    return out.withColumn("kept", F.col("first_rejection").isNull()).drop("_text")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(common.table(spark, sf_dir, "documents")).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(t, '[ \t\n\x0B\f\r]+'), lambda x: x <> '') AS ws,
  list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^ \t\n\x0B\f\r]')) AS ls FROM d),
c AS (SELECT doc_id, ws, cast(len(ws) AS BIGINT) AS n_words,
  cast(length(regexp_replace(t, '[ \t\n\x0B\f\r]', '', 'g')) AS BIGINT) AS word_chars,
  cast(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
  cast(len(ls) AS BIGINT) AS n_lines, cast(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
  length(regexp_replace(t, '[^\p{Lu}]', '', 'g')) AS caps, length(regexp_replace(t, '[^\p{L}]', '', 'g')) AS letters FROM w),
g AS (SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS gram FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM c)),
k AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) AS k FROM g) WHERE k > 1),
p AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS j FROM k) GROUP BY doc_id),
f AS (SELECT c.*, cast(coalesce(p.n, 0) AS BIGINT) AS n_repeat_words FROM c LEFT JOIN p USING (doc_id)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM f)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR word_chars < 2 * n_words OR word_chars > 12 * n_words OR 10 * n_symbols > n_words OR 10 * n_dup_lines > 3 * n_lines
    OR 10 * caps > 3 * letters OR 10 * letters < 7 * word_chars OR 100 * n_repeat_words > 30 * n_words) AS kept
FROM b
"""
