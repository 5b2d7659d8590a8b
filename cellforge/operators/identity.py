"""Stable ids, taxon matching, registries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..sources.scratch import saved


def _dense(keys: DataFrame, key: str, base: int) -> DataFrame:
    """Ids base + 1.. in binary order of the distinct keys; each range sorts its own part, offsets come from counts."""
    d = keys.select(key).distinct()
    ranged = d.repartitionByRange(key).withColumn("_p", F.spark_partition_id())
    ranged = saved(ranged, "ids")  # numbers and counts come from the same rows, whatever is lost
    sizes = {r["_p"]: r["count"] for r in ranged.groupBy("_p").count().collect()}  # a row for each partition
    at, offsets = base, []
    for p in sorted(sizes):
        offsets.append((p, at))
        at += sizes[p]
    off = keys.sparkSession.createDataFrame(offsets, "_p int, _o long")
    w = Window.partitionBy("_p").orderBy(key)
    return ranged.join(F.broadcast(off), "_p").select(key, (F.col("_o") + F.row_number().over(w)).cast("long").alias("mdl_id"))


def assign_mdl_id(keys: DataFrame, published: DataFrame | None = None, key: str = "mdl_key") -> DataFrame:
    """Published ids stay; new keys are appended above the largest, in binary order."""
    if published is None:
        return _dense(keys, key, 0)
    if published.groupBy("mdl_id").count().where("count > 1").head(1):
        raise ValueError("a published mdl_id is used twice")
    first = published.groupBy(key).agg(F.min("mdl_id").cast("long").alias("mdl_id"))
    top = first.agg(F.coalesce(F.max("mdl_id"), F.lit(0))).first()[0]
    new = keys.select(key).distinct().join(first, key, "left_anti")
    return first.join(keys.select(key).distinct(), key, "left_semi").unionByName(_dense(new, key, top))


def match_taxa(d: DataFrame, itis: DataFrame, worms: DataFrame, rest: DataFrame | None = None) -> DataFrame:
    """worms_id by ITIS id, then by exact scientific name, then from a third source (name, worms_id).

    A row whose id or name has several targets is returned once for each distinct one;
    the first source that has any decides.
    """
    targets = lambda t, key, name, of: t.where(F.col(of).isNotNull()).groupBy(F.col(key).alias(name)).agg(F.sort_array(F.collect_set(of)))
    out = d.join(targets(itis, "taxonID", "itis_id", "acceptedNameUsageID").toDF("itis_id", "_a"), "itis_id", "left")
    out = out.join(targets(worms, "scientificName", "name", "acceptedNameUsageID").toDF("name", "_b"), "name", "left")
    ids = [F.col("_a"), F.col("_b")]
    if rest is not None:
        out = out.join(targets(rest, "name", "name", "worms_id").toDF("name", "_c"), "name", "left")
        ids.append(F.col("_c"))
    return out.withColumn("worms_id", F.explode_outer(F.coalesce(*ids))).withColumn("botw_id", F.lit(None).cast("long")).drop("_a", "_b", "_c")


def dataset_is_scored(datasets: DataFrame, relation: DataFrame | None, merged: str = "ms_merge") -> DataFrame:
    if relation is None:
        return datasets.withColumn("is_scored", F.lit(True))
    used = relation.select("ds_key").distinct().withColumn("_u", F.lit(True))
    return datasets.join(used, "ds_key", "left").withColumn("is_scored", F.coalesce("_u", F.lit(False)) | (F.col("ds_key") == merged)).drop("_u")


CLASS = ["ds_key", "asset_type", "representation"]


def registry_merge(old: DataFrame, new: DataFrame, allow_shrink: bool = False) -> DataFrame:
    """New rows, and the old rows of classes the new registry lacks; a class must not shrink.

    allow_shrink takes the new registry as it is: nothing is carried and nothing refused.
    Null class columns are a class like any other.
    """
    if allow_shrink:
        return new
    a, b = old.groupBy(*CLASS).agg(F.count("*").alias("n_old")), new.groupBy(*[F.col(c).alias(f"_{c}") for c in CLASS]).agg(F.count("*").alias("n_new"))
    same = None
    for c in CLASS:
        on = F.col(c).eqNullSafe(F.col(f"_{c}"))
        same = on if same is None else same & on
    bad = a.join(b, same).where("n_new < n_old").orderBy(*CLASS).head(5)
    if bad:
        raise ValueError("classes shrank: " + ", ".join(f"{r['ds_key']}/{r['asset_type']}/{r['representation']} {r['n_old']} to {r['n_new']}" for r in bad))
    return new.unionByName(old.join(b, same, "left_anti").select(*old.columns), allowMissingColumns=True)


def zone_set_resolve(registry: DataFrame, wanted: DataFrame) -> DataFrame:
    """(zone_type, version) -> zone_set_key: the one set naming the version as a whole word, else the one canonical set."""
    r = registry.withColumn("_v", F.split("versions", r"\s+"))
    j = wanted.join(r, "zone_type", "left")
    hit, canon = F.array_contains("_v", F.col("version")), F.coalesce("canonical", F.lit(False))
    g = j.groupBy("zone_type", "version").agg(F.count_if(hit).alias("_n"), F.max(F.when(hit, F.col("zone_set_key"))).alias("_k"), F.count_if(canon).alias("_m"), F.max(F.when(canon, F.col("zone_set_key"))).alias("_c"))
    return g.select("zone_type", "version", F.when(F.col("_n") == 1, F.col("_k")).when(F.col("_m") == 1, F.col("_c")).alias("zone_set_key"))


def zone_collapse(zones: DataFrame) -> DataFrame:
    """The largest table by zone set (ties by name); rows without a set all stay."""
    w = Window.partitionBy("zone_set_key").orderBy(F.desc("n"), "tbl")
    return zones.withColumn("_r", F.row_number().over(w)).where("zone_set_key IS NULL OR _r = 1").drop("_r")


def taxon_unpivot(wide: DataFrame, datasets: list[str], taxon: str = "taxon_id") -> DataFrame:
    """(taxon, ds_key, mdl_seq): one row for each dataset with a model, and the merged model's."""
    long = wide.unpivot([taxon], datasets, "ds_key", "mdl_seq").where("mdl_seq IS NOT NULL")
    return long.unionByName(wide.where("mdl_seq IS NOT NULL").select(taxon, F.lit("ms_merge").alias("ds_key"), "mdl_seq"))
