"""Content addressing: hashes and digests that ignore row order and physical layout."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _canonical(df: DataFrame, columns: list[str]) -> list[Column]:
    """(is null, value) of every column, whole numbers widened: xxhash64 skips nulls and tells int from long."""
    out = []
    for c in columns:
        kind = df.schema[c].dataType
        v = F.col(c)
        if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType)):
            v = v.cast("long")
        elif isinstance(kind, T.FloatType):
            v = v.cast("double")
        out += [v.isNull(), v]
    return out


def _fold(n: Column, x: Column, s: Column) -> Column:
    return F.lower(F.lpad(F.hex(F.xxhash64(F.concat_ws("|", n.cast("string"), x.cast("string"), s.cast("string")))), 16, "0"))


def content_hashes(df: DataFrame, by: list[str], columns: list[str]) -> DataFrame:
    """by, content_hash, n: count, xor and exact sum of row hashes; one shuffle of one row a group and task."""
    h = F.xxhash64(*_canonical(df, columns))
    g = df.select(*by, h.alias("_h")).groupBy(*by).agg(F.count("*").alias("n"), F.bit_xor("_h").alias("_x"), F.sum(F.col("_h").cast("decimal(38,0)")).alias("_s"))
    return g.select(*by, _fold(F.col("n"), F.coalesce("_x", F.lit(0)), F.coalesce("_s", F.lit(0).cast("decimal(38,0)"))).alias("content_hash"), "n")


def hash_table(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    return content_hashes(df, [], sorted(columns or df.columns))


def hash_query(spark: SparkSession, source: str, columns: list[str] | None = None, **tables: DataFrame) -> DataFrame:
    """`hash_table` of a view's or table's name, or of a SELECT over views or the given tables."""
    df = spark.sql(source, **tables) if len(source.split()) > 1 else tables[source] if source in tables else spark.table(source)
    return hash_table(df, columns)


def digest_lanes(df: DataFrame) -> DataFrame:
    """n_rows, n_groups and four 32-bit lanes: the xor over distinct rows of md5(row text, count)."""
    row = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"})
    groups = df.select(row.alias("r")).groupBy("r").agg(F.count("*").alias("n"))
    m = groups.select("n", F.md5(F.encode(F.concat("r", F.lit("\x1f"), F.col("n").cast("string")), "UTF-8")).alias("m"))
    lane = lambda k: F.bit_xor(F.conv(F.substring("m", 8 * k + 1, 8), 16, 10).cast("long"))
    return m.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.count("*").alias("n_groups"), *[F.coalesce(lane(k), F.lit(0)).alias(f"lane{k}") for k in range(4)])


def table_digest(df: DataFrame) -> dict[str, object]:
    """Scalar digest of a table; 32 zeros for an empty one."""
    import hashlib

    r = digest_lanes(df).first()
    data = "".join(f"{r[f'lane{k}']:08x}" for k in range(4))
    schema = ",".join(f"{f.name}:{f.dataType.simpleString()}" for f in sorted(df.schema.fields, key=lambda f: f.name))
    sd = hashlib.md5(schema.encode()).hexdigest()
    return {"n_rows": r["n_rows"], "n_groups": r["n_groups"], "schema": schema, "schema_digest": sd, "data_digest": data, "digest": hashlib.md5(f"{sd}|{data}|{r['n_rows']}".encode()).hexdigest()}


def sync_plan(local: DataFrame, remote: DataFrame, by: str = "name", digest: str = "digest") -> DataFrame:
    """name, status same / changed / missing (remotely) / extra, what needs work first."""
    a, b = local.select(by, F.col(digest).alias("digest_local")), remote.select(by, F.col(digest).alias("digest_remote"))
    status = F.when(F.col("digest_remote").isNull(), "missing").when(F.col("digest_local").isNull(), "extra").when(F.col("digest_local") == F.col("digest_remote"), "same").otherwise("changed")
    return a.join(b, by, "full_outer").withColumn("status", status).orderBy(status != "changed", status != "missing", by)


def summary(df: DataFrame) -> DataFrame:
    """Rows and, where the columns exist, distinct models and the range of values."""
    aggs = [F.count("*").alias("n_rows")]
    if "mdl_key" in df.columns:
        aggs.append(F.countDistinct("mdl_key").alias("n_models"))
    if "val" in df.columns:
        aggs += [F.min("val").alias("val_min"), F.max("val").alias("val_max")]
    return df.agg(*aggs)
