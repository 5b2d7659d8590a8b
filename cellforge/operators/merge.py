"""Fusion of model surfaces by taxon under masking rules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEY = "ms_merge_key"


def by_cell(b: DataFrame) -> DataFrame:
    """(key, cell_id, am, has_range): one pass over (key, ds_key, cell_id, val)."""
    return b.groupBy(KEY, "cell_id").agg(F.max(F.when(F.col("ds_key") == "am", F.col("val"))).alias("am"), F.bool_or(F.col("ds_key") != "am").alias("has_range"))


def flags(cells: DataFrame) -> DataFrame:
    """(key, has_am, has_range) of every taxon."""
    return cells.groupBy(KEY).agg(F.bool_or(F.col("am").isNotNull()).alias("has_am"), F.bool_or("has_range").alias("has_range"))


def _ranged(cells: DataFrame, taxon: DataFrame) -> DataFrame:
    return cells.where("has_range").join(taxon.select(KEY, F.col("er_score").alias("er")).distinct(), KEY)


def range_footprint(cells: DataFrame, taxon: DataFrame) -> DataFrame:
    """(key, cell_id, er): cells of every range dataset with the taxon's risk."""
    return _ranged(cells, taxon).select(KEY, "cell_id", "er")


def model_at_range(cells: DataFrame, taxon: DataFrame) -> DataFrame:
    """(key, cell_id, am): the largest model value on range cells of known taxa."""
    return cells.where("has_range AND am IS NOT NULL").join(taxon.select(KEY), KEY, "left_semi").select(KEY, "cell_id", "am")


def _fused():
    return F.greatest("er", F.coalesce("am", F.lit(0.0))).cast("double")


def merge_global(cells: DataFrame, taxon: DataFrame) -> DataFrame:
    return _ranged(cells, taxon).select(KEY, "cell_id", _fused().alias("val"))


def merge_us(b: DataFrame, cells: DataFrame, taxon: DataFrame, us_cells: DataFrame, taxon_flags: DataFrame | None = None) -> DataFrame:
    """Merged cells within the US, and raw model cells there of taxa without a range; duplicates are kept.

    Without taxon_flags they follow from the cells, whose exchange is read again; b is
    scanned once for the cells and once for the raw rows.
    """
    us = us_cells.select("cell_id").distinct()
    known = taxon_flags if taxon_flags is not None else flags(cells)
    bare = known.where("has_am AND NOT has_range").select(KEY)
    only = b.where("ds_key = 'am'").select(KEY, "cell_id", F.col("val").cast("double").alias("val")).join(us, "cell_id", "left_semi").join(bare, KEY, "left_semi")
    return merge_global(cells, taxon).join(us, "cell_id", "left_semi").select(KEY, "cell_id", "val").unionByName(only)


def merge(b: DataFrame, taxon: DataFrame, taxon_flags: DataFrame | None, us_cells: DataFrame) -> dict[str, DataFrame]:
    cells = by_cell(b)
    return {"b_range": range_footprint(cells, taxon), "b_am_rng": model_at_range(cells, taxon), "global": merge_global(cells, taxon), "us": merge_us(b, cells, taxon, us_cells, taxon_flags)}


def turtle(src: DataFrame, turtle_ds: str, suit_ds: str, ch_keys: list[str]) -> DataFrame:
    """One pass over (key, ds_key, cell_id, val): risk scaled by suitability, raised by critical habitat."""
    val = lambda cond: F.max(F.when(cond, F.col("val")))
    ds = F.col("ds_key")
    habitat = val(ds.isin(*ch_keys)) if ch_keys else F.lit(None).cast("double")
    wide = src.groupBy(KEY, "cell_id").agg(val(ds == turtle_ds).alias("er"), val(ds == suit_ds).alias("suit"), habitat.alias("ch")).where("er IS NOT NULL")
    scaled = F.greatest(F.lit(1.0), F.round(F.col("er") * F.coalesce("suit", F.lit(1.0)) / 100))
    return wide.select(KEY, "cell_id", F.greatest(scaled, F.coalesce("ch", F.lit(0.0))).alias("val"))
