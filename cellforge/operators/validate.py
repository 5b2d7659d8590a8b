"""Deltas between releases, tolerances, invariants."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.catalog import Catalog


def score_delta(a: DataFrame, b: DataFrame, key: str, score: str = "score", labels: tuple[str, str] = ("a", "b")) -> DataFrame:
    if labels[0] == labels[1]:
        raise ValueError("labels must differ")
    x, y = (d.select(key, F.col(score).alias(f"{score}_{n}")) for d, n in zip((a, b), labels, strict=True))
    out = x.join(y, key).withColumn("delta", F.col(f"{score}_{labels[1]}") - F.col(f"{score}_{labels[0]}"))
    return out.orderBy(F.abs("delta").desc_nulls_last(), key)


def score_delta_summary(d: DataFrame) -> DataFrame:
    x = F.col("delta")
    return d.where(x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))).agg(F.count("*").alias("n"), F.avg(F.abs(x)).alias("mean_abs"), F.max(F.abs(x)).alias("max_abs"), F.sqrt(F.avg(x * x)).alias("rmse"))


def assert_within_tolerance(d: DataFrame, mean: float, most: float) -> DataFrame:
    r = score_delta_summary(d).first()
    if r["n"] and (r["mean_abs"] > mean or r["max_abs"] > most):
        raise ValueError(f"scores moved too far: mean {r['mean_abs']}, most {r['max_abs']}")
    return d


def zone_metric_scores(cat: Catalog, field: str = "programarea_key", zone_set: str | None = None) -> DataFrame:
    """zone_key, metric_key, score of a release, whatever its generation."""
    z = cat["zone"].where(F.col("fld") == field)
    if zone_set is not None and "zone_set_key" in z.columns:
        z = z.where(F.col("zone_set_key") == zone_set)
        if z.isEmpty():
            raise ValueError(f"no zone of set {zone_set}")
    z = z.select("zone_seq", F.col(cat.value("zone")).cast("string").alias("zone_key"))
    zm = cat["zone_metric"].select("zone_seq", "metric_seq", F.col(cat.value("zone_metric")).cast("double").alias("score"))
    return z.join(zm, "zone_seq").join(cat["metric"].select("metric_seq", "metric_key"), "metric_seq").select("zone_seq", "zone_key", "metric_key", "score")


def pra_score_delta(a: Catalog, b: Catalog, metric: str, labels: tuple[str, str] = ("a", "b"), zone_set: str | None = None) -> DataFrame:
    """Scores of one metric by program area in two releases, of whatever generation, largest change first."""
    x, y = (zone_metric_scores(c, zone_set=zone_set).where(F.col("metric_key") == metric).select("zone_key", "score") for c in (a, b))
    return score_delta(x, y, "zone_key", labels=labels)


def zone_score_delta(a: DataFrame, b: DataFrame) -> DataFrame:
    """By shared metric over shared zones: counts, means, deltas and correlation; of a repeated zone the row with the smallest zone_seq counts, or the smallest score without one."""
    first = lambda d: F.min_by("score", "zone_seq") if "zone_seq" in d.columns else F.min("score")
    x, y = (d.groupBy("zone_key", "metric_key").agg(first(d).alias(n)) for d, n in ((a, "sa"), (b, "sb")))
    d = x.join(y, ["zone_key", "metric_key"]).withColumn("d", F.col("sb") - F.col("sa"))
    sd = F.stddev_samp("sa") * F.stddev_samp("sb")
    cor = F.when((F.count("*") > 2) & (sd > 0), F.try_divide(F.covar_samp("sa", "sb"), sd))
    return d.groupBy("metric_key").agg(F.count("*").alias("n_zones"), F.avg("sa").alias("mean_a"), F.avg("sb").alias("mean_b"), F.avg("d").alias("mean_delta"), F.avg(F.abs("d")).alias("mean_abs_delta"), F.max(F.abs("d")).alias("max_abs_delta"), cor.alias("cor"))


def set_differences(a: DataFrame, b: DataFrame) -> DataFrame:
    """side, kind, key: zones and metrics of one side only."""
    out = None
    for kind in ("zone_key", "metric_key"):
        for side, x, y in (("a", a, b), ("b", b, a)):
            d = x.select(kind).distinct().join(y.select(kind).distinct(), kind, "left_anti").select(F.lit(side).alias("side"), F.lit(kind).alias("kind"), F.col(kind).alias("key"))
            out = d if out is None else out.unionByName(d)
    return out


def mass_conservation(before: DataFrame, after: DataFrame, value: str, tol: float) -> DataFrame:
    x, y = before.agg(F.sum(value).alias("before")), after.agg(F.sum(value).alias("after"))
    ratio = F.try_divide(F.col("after"), F.col("before"))
    return x.crossJoin(y).select("before", "after", ratio.alias("ratio"), (F.abs(ratio - 1) <= tol).alias("ok"))  # one row each


def pct_marine(cells: DataFrame, ocean: DataFrame, area: str | None = None) -> DataFrame:
    flag = cells.join(ocean.select("cell_id").distinct().withColumn("_o", F.lit(1)), "cell_id", "left").withColumn("_o", F.coalesce("_o", F.lit(0)))
    w = F.col(area) if area else F.lit(1)
    return flag.agg(F.bround(F.try_divide(F.sum(F.col("_o") * w) * 100.0, F.sum(w)), 1).alias("pct_marine"))


def zone_set_faults(d: DataFrame) -> DataFrame:
    """(rule, key) of every broken invariant of a registry (zone_set_key, zone_type, vintage, geom_hash)."""
    need = {"zone_set_key", "zone_type", "vintage", "geom_hash"} - set(d.columns)
    if need:
        raise ValueError(f"registry lacks {', '.join(sorted(need))}")
    two = lambda by, of: d.groupBy(F.col(by).alias("key")).agg(F.countDistinct(of).alias("n")).where("n > 1").select("key")
    rules = [
        ("duplicate_row", d.groupBy(F.col("zone_set_key").alias("key"), "zone_type").count().where("count > 1").select("key")),
        ("key_has_geometries", two("zone_set_key", "geom_hash")), ("geometry_has_keys", two("geom_hash", "zone_set_key")),
        ("key_is_type_vintage", d.where(F.col("zone_set_key") != F.concat_ws("_", "zone_type", "vintage")).select(F.col("zone_set_key").alias("key"))),
    ]
    out = None
    for name, f in rules:
        f = f.select(F.lit(name).alias("rule"), "key")
        out = f if out is None else out.unionByName(f)
    return out
