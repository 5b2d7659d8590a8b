"""Files: Parquet write policy, directory digests, manifests, front matter, listings, storage index."""

from __future__ import annotations

import json
import os
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.fingerprint import table_digest


def write_parquet(df: DataFrame, path: str, order_by: list[str] | None = None, partition_by: list[str] | None = None, block_mb: int = 80) -> None:
    """zstd, writer v2; ordered by ranges so that row-group statistics prune; partitions overwritten one by one."""
    if order_by:
        df = df.repartitionByRange(*order_by).sortWithinPartitions(*order_by)
    elif partition_by:
        df = df.repartition(*partition_by)
    w = df.write.mode("overwrite").option("compression", "zstd").option("parquet.writer.version", "v2").option("parquet.block.size", block_mb << 20)
    if partition_by:
        w = w.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    w.parquet(path)


def read_any(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("mergeSchema", True).parquet(path)


def write_manifest(path: str, target: str, content_hash: str, stats: dict, force: bool = False) -> bool:
    """Deterministic JSON; an identical file is left alone. True if written."""
    text = json.dumps({"target": target, "content_hash": content_hash} | dict(sorted(stats.items())), indent=2) + "\n"
    p = Path(path)
    if p.exists() and p.read_text() == text and not force:
        return False
    p.write_text(text)
    return True


def forced(target: str, env: str = "FORCE_TARGETS") -> bool:
    # fixed values: what counts as true
    v = os.environ.get(env, "").strip()
    return v.lower() in ("1", "true", "yes", "t", "on") or target in [x.strip() for x in v.split(",") if x.strip()]


def parquet_manifest(spark: SparkSession, root: str) -> list[dict]:
    """A digest for each {name}.parquet or {name}/ under root, sorted by name; any store that Spark reads."""
    jvm = spark.sparkContext._jvm
    top = jvm.org.apache.hadoop.fs.Path(root)
    fs = top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = [(x.getPath().getName(), x.getPath().toString(), x.isDirectory()) for x in fs.listStatus(top)]
    out = []
    for name, path, folder in sorted(found):
        if name.endswith(".parquet") or (folder and not name.startswith(("_", "."))):
            df = read_any(spark, path)
            size = fs.getContentSummary(jvm.org.apache.hadoop.fs.Path(path)).getLength()
            out.append({"name": name.removesuffix(".parquet"), "n_files": len(df.inputFiles()), "bytes": size} | table_digest(df))
    return out


def front_matter(text: str) -> dict | None:
    """The YAML between the first two lines of ---."""
    import yaml

    lines = text.split("\n")
    marks = [i for i, x in enumerate(lines) if x.strip() == "---"][:2]
    return yaml.safe_load("\n".join(lines[marks[0] + 1 : marks[1]])) if len(marks) == 2 else None


def pipeline_targets(root: str, key: str = "target") -> list[dict]:
    found = []
    for p in sorted(Path(root).glob("*.qmd")):
        meta = front_matter(p.read_text())
        if meta and key in meta:
            found.append({"file": p.name} | (meta[key] if isinstance(meta[key], dict) else {"name": meta[key]}))
    return found


def listing(lines: DataFrame, column: str = "line") -> DataFrame:
    """(key, size) of a store's text listing."""
    # fixed value: a line of the listing
    p = r"^\S+\s+\S+\s+(\d+)\s+(.+)$"
    return lines.where(F.col(column).rlike(p)).select(F.regexp_extract(column, p, 2).alias("key"), F.regexp_extract(column, p, 1).cast("long").alias("size"))


def storage_rollup(objects: DataFrame) -> DataFrame:
    """dir, n_files, bytes of every folder, all below it counted."""
    parts = F.split("key", "/")
    up = F.transform(F.sequence(F.lit(0), F.size(parts) - 1), lambda i: F.array_join(F.slice(parts, 1, i), "/"))
    return objects.withColumn("dir", F.explode(up)).groupBy("dir").agg(F.count("*").alias("n_files"), F.sum("size").alias("bytes"))
