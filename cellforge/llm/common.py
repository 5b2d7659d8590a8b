"""Tables in the shared scratch folder, and small helpers of the operators."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def scratch_root(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, which driver and executors share; on one machine (tests) a folder of our own where it is unset."""
    conf = spark.sparkContext.getConf()
    root = conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = getattr(scratch_root, "own", None)
        if root is None:
            root = scratch_root.own = tempfile.mkdtemp(prefix="cellforge-")
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark)}/cellforge/{name}-{uuid.uuid4().hex}"


def save(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Write df to the shared folder and read it back: lineage ends, and a lost executor costs one stage."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", codec).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def drop(*frames: DataFrame | Broadcast | None) -> None:
    """Delete saved tables, and destroy broadcasts, that no later plan reads."""
    for df in frames:
        if isinstance(df, Broadcast):
            df.destroy()
            continue
        path = getattr(df, "_scratch", None)
        if path:
            delete(df.sparkSession, path)


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small text file of the shared folder; None if there is none."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Replace a small text file: written beside its place, then renamed."""
    jvm = spark.sparkContext._jvm
    p, new = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}")
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    stream = fs.create(new)
    stream.write(text.encode())
    stream.close()
    fs.delete(p, False)
    fs.rename(new, p)


def delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def fresh(df: DataFrame, name: str) -> str:
    """name, with underscores before it until df has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Keys with more than one in so many of all rows are joined by broadcast; there are at most as many.
HOT = 1000


def join_keyed(rows: DataFrame, table: DataFrame, key: str, n: str = "n") -> DataFrame:
    """Inner join with a saved table of one row a key, n being how many rows of `rows` have it.

    Keys of more than 1 / HOT of all rows, of which there are at most HOT, are
    broadcast, so no task gets the rows of a hot key; the others are shuffled.
    """
    total = table.agg(F.sum(n)).first()[0] or 0
    hot = table.where(F.col(n) * HOT > total)
    cold = table.where(F.col(n) * HOT <= total)
    return rows.join(F.broadcast(hot), key).unionByName(rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(cold, key))


def crc_of_id(column: str = "doc_id"):
    """crc32 of an id's decimal text (null id: of the empty text)."""
    return F.crc32(F.encode(F.coalesce(F.col(column).cast("string"), F.lit("")), "UTF-8"))


def components(edges: DataFrame) -> DataFrame:
    """Connected components of edges (u, v): (node, component), component the smallest node.

    Each round maps every node to the smallest node of its closed neighbourhood
    and contracts the edges; the minimum of a component maps to itself, so it is
    what remains. Rounds follow the logarithm of the longest path. Both steps are
    aggregations with map-side combine and joins that AQE can split, so a hub
    with millions of edges is not gathered anywhere.
    """
    left = save(edges.where("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), "edges")
    maps: DataFrame | None = None
    while not left.isEmpty():
        near = (
            left.select(F.col("u").alias("node"), F.col("v").alias("other"))
            .unionByName(left.select(F.col("v").alias("node"), F.col("u").alias("other")))
            .groupBy("node")
            .agg(F.min("other").alias("low"))
            .select("node", F.least("node", "low").alias("low"))
        )
        near = save(near, "near")
        a, b = near.select(F.col("node").alias("u"), F.col("low").alias("a")), near.select(F.col("node").alias("v"), F.col("low").alias("b"))
        after = save(left.join(a, "u").join(b, "v").where("a <> b").select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).distinct(), "edges")
        step = near.select(F.col("node").alias("component"), "low")
        # a node seen first in this round enters with itself
        before = maps if maps is not None else None
        if before is None:
            maps2 = near.select("node", F.col("low").alias("component"))
        else:
            maps2 = before.join(step, "component", "left").select("node", F.coalesce("low", "component").alias("component"))
        maps2 = save(maps2, "labels")
        drop(before, left, near)
        maps, left = maps2, after
    if maps is None:
        return left.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return maps
