"""A training corpus from raw documents: five stages, each written as Parquet and reread.

language ID -> near duplicates -> repeated windows -> benchmark passages -> packing.
Every stage takes (spark, docs, sf_dir) and works on all that its predecessor kept;
all but the last return the columns of documents, others that docs has with them,
whatever their names.

Defined results, stage by stage. Null or empty texts have no letter: the language
stage drops them, and where they are given to a later stage they are linked with
nothing, lose nothing, hold no passage and pack as one end token. Very long texts are
read whole. Rows with a null doc_id are judged on their own: kept as near duplicates
of nothing, not cut, decontaminated by their text, packed first. Repeated rows of one
doc_id are one document to near_duplicates (they stay or go together) and are treated
alike by the others. Ties of languages go to the one that sorts first, of a group of
copies to the smallest doc_id. An empty table gives an empty result in every stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cellforge.llm import common, decontam, language, neardup, packing, substrings

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns from the labelled rows and drops texts without letters or unlike all profiles (a score of 0, or under that of 99.9 % of the labelled texts); lang is left as it is."""
    training = docs.where(~language.held_out()).select("text", "lang")
    profiles = language.learn(training)
    return language.keep_known(docs, profiles, language.least_score(training, profiles) if profiles.langs else 0.0)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest doc_id of every group linked by five-word shingles at a similarity of 0.8."""
    return neardup.keep_first(docs, size=5, percent=80)


def repeated_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts words covered by 50-word windows that also start in a smaller document; emptied documents go."""
    return substrings.deduplicate(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a passage of the benchmark."""
    return decontam.decontaminate(docs, common.table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents in sequences of at most 2048 tokens."""
    import public_tokenizers as p

    return packing.pack(docs, p.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("language", identify_language),
    ("near_duplicates", near_duplicates),
    ("repeated_windows", repeated_windows),
    ("decontamination", benchmark_passages),
    ("packing", pack_sequences),
]

#: SQL can't express rank-order profiles, edit distances in regions or the packing; the stages are tested by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = common.save(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
