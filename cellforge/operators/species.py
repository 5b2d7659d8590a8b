"""Species of zones and cells, component scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import grid
from ..functions.keys import component_label
from ..sources.catalog import Catalog

#: Columns of a species table; categories that are left out.
GROUP = ["sp_cat", "sp_common", "sp_scientific", "taxon_id", "taxon_authority", "er_code", "er_score", "is_mmpa", "is_mbta", "mdl_key"]
COLUMNS = [*GROUP, "area_km2", "avg_suit", "suit_er", "suit_er_area", "cat_suit_er_area", "pct_cat"]
LEFT_OUT = ("reptile", "amphibian")


def _taxa(cat: Catalog) -> DataFrame:
    """Eligible taxa with canonical columns; columns that a generation lacks are typed nulls."""
    k, t = cat.species_columns(None), cat["taxon"]
    have = lambda c, expr, kind: expr if c in t.columns else F.lit(None).cast(kind)
    t = t.where(F.col(k["valid"]) & ~F.col("sp_cat").isin(*LEFT_OUT))
    if k["marine"]:
        t = t.where(F.col(k["marine"]))
    return t.select(
        F.col(k["tkey"]).cast("string").alias("mdl_key"), "sp_cat", F.col("common_name").alias("sp_common"), F.col("scientific_name").alias("sp_scientific"), "taxon_id", "taxon_authority",
        have("extrisk_code", F.col("extrisk_code"), "string").alias("er_code"), have("er_score", F.col("er_score") / 100.0, "double").alias("er_score"),
        have("is_mmpa", F.col("is_mmpa"), "boolean").alias("is_mmpa"), have("is_mbta", F.col("is_mbta"), "boolean").alias("is_mbta"),
    )


#: Rows of a model table up to which it is broadcast.
BROADCAST_ROWS = 1 << 20


def _source(cat: Catalog, tiles: list[int] | None) -> tuple[DataFrame, str, str]:
    """The cell-oriented twin where it exists (with a literal tile filter), else model_cell."""
    if "cell_model" in cat:
        df = cat["cell_model"]
        if tiles is not None and "tile" in df.columns:
            df = df.where(F.col("tile").isin(tiles))
        if "mdl_id" in df.columns and "mdl_key" not in df.columns and "model" in cat:
            model = cat["model"].select("mdl_id", "mdl_key")
            small = model.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
            df = df.join(F.broadcast(model) if small else model, "mdl_id")
        key = next(c for c in ("mdl_key", "mdl_seq", "ms_merge_key") if c in df.columns)
        return df, key, cat.value("cell_model")
    k = cat.species_columns()
    return cat["model_cell"], k["mkey"], k["val"]


def aggregate(cat: Catalog, covered: DataFrame, by: list[str], tiles: list[int] | None = None) -> DataFrame:
    """Area and mean suitability by taxon over covered cells (cell_id, pct_covered and the columns of by).

    Model cells of other taxa go before the sums; the taxon's descriptions join the sums.
    """
    src, key, val = _source(cat, tiles)
    taxa = _taxa(cat)
    src = src.select("cell_id", F.col(key).cast("string").alias("mdl_key"), F.col(val).cast("double").alias("_v")).join(taxa.select("mdl_key"), "mdl_key", "left_semi")
    pct = F.col("pct_covered")
    cells = covered.join(cat["cell"].select("cell_id", "area_km2"), "cell_id").select(*by, "cell_id", pct, (F.col("area_km2") * pct / 100.0).alias("_a"))
    sums = src.join(cells, "cell_id").groupBy(*by, "mdl_key").agg(F.sum("_a").alias("area_km2"), (F.try_divide(F.sum(F.col("_v") * pct), F.sum(pct)) / 100.0).alias("avg_suit"))
    return sums.join(taxa, "mdl_key").select(*by, *GROUP, "area_km2", "avg_suit")


def shares(df: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Contribution of a species to its category.

    The categories' sums are grouped, with partial sums, and joined back: no task holds a category.
    """
    keys = [*(by or []), "sp_cat"]
    df = df.withColumn("suit_er", F.col("avg_suit") * F.col("er_score")).withColumn("suit_er_area", F.col("suit_er") * F.col("area_km2"))
    sums = df.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.sum("suit_er_area").alias("_s"))
    on = None
    for k in keys:
        same = F.col(k).eqNullSafe(F.col(f"_{k}"))
        on = same if on is None else on & same
    out = df.join(sums, on).withColumn("cat_suit_er_area", F.coalesce("_s", F.lit(0.0)))
    return out.withColumn("pct_cat", F.try_divide("suit_er_area", "cat_suit_er_area")).select(*(by or []), *COLUMNS)


def listed(df: DataFrame) -> DataFrame:
    """A species table in its published order."""
    return df.orderBy("sp_cat", "sp_scientific", "mdl_key")


def tile_check(cat: Catalog) -> bool:
    """Raises where a cell of cell_model is not in the tile that the reported grid width gives, or there is none; pruning would drop such rows. All rows are checked."""
    if "cell_model" not in cat or "tile" not in cat["cell_model"].columns:
        return True
    width = cat.tile_width()
    cells = cat["cell_model"].groupBy("cell_id").agg(F.min("tile").alias("tile"), F.max("tile").alias("_top"))
    wrong = ~(F.col("tile").eqNullSafe(grid.tile(F.col("cell_id"), width)) & F.col("tile").eqNullSafe(F.col("_top")))
    r = cells.agg(F.count("*").alias("n"), F.count_if(wrong).alias("bad"), F.min(F.when(wrong, F.struct("cell_id", "tile", grid.tile(F.col("cell_id"), width).alias("want")))).alias("one")).first()
    if not r["n"]:
        raise ValueError("cell_model has no rows to check")
    if r["bad"]:
        x = r["one"]
        raise ValueError(f"cell_model tile ids do not match the grid width {width}: cell {x['cell_id']} is stored in tile {x['tile']}, not {x['want']}; {r['bad']} of {r['n']} cells disagree")
    return True


def top(df: DataFrame, n: int = 10, by: str = "suit_er_area") -> DataFrame:
    """The n species of a table with the largest values, ties by model key."""
    return df.orderBy(F.desc_nulls_last(by), "mdl_key").limit(n)


def report(df: DataFrame, model_url: str) -> DataFrame:
    """A species table as shown: an address by model key, percentages, published order; either generation's key."""
    key = "mdl_key" if "mdl_key" in df.columns else "mdl_seq"
    pct = lambda c: F.round(F.col(c) * 100, 1)
    return df.select("sp_cat", "sp_common", "sp_scientific", F.concat(F.lit(model_url), F.url_encode(F.col(key).cast("string"))).alias("model_url"), "er_code", pct("er_score").alias("er_pct"), "is_mmpa", "is_mbta", F.round("area_km2", 0).alias("area_km2"), pct("avg_suit").alias("suit_pct"), pct("pct_cat").alias("pct_cat")).orderBy("sp_cat", "sp_scientific", "model_url")


def for_cells(cat: Catalog, cells: DataFrame, cell_list: list[int] | None = None) -> DataFrame:
    """Species over the caller's cells (cell_id, pct_covered; a repeated cell counts twice); cell_list prunes tiles."""
    for c in ("cell_id", "pct_covered"):
        if c not in cells.columns:
            raise ValueError(f"cells need a {c} column")
    if cell_list is not None:
        tile_check(cat)
    tiles = grid.tiles_of(cell_list, cat.tile_width()) if cell_list is not None else None
    return shares(aggregate(cat, cells.select("cell_id", "pct_covered"), [], tiles))


def zone_cells(cat: Catalog, field: str | None = None, value: str | None = None) -> DataFrame:
    z = cat["zone"].select("zone_seq", F.col("fld").alias("zone_fld"), F.col(cat.value("zone")).cast("string").alias("zone_value"))
    if field is not None:
        z = z.where((F.col("zone_fld") == F.lit(field)) & (F.col("zone_value") == F.lit(value)))
    return z.join(cat["zone_cell"], "zone_seq").select("zone_fld", "zone_value", "cell_id", "pct_covered")


def for_zone(cat: Catalog, field: str, value: str, use_precomputed: bool = True) -> DataFrame:
    if use_precomputed and "zone_taxon" in cat:
        d = cat["zone_taxon"].where((F.col("zone_fld") == F.lit(field)) & (F.col("zone_value") == F.lit(value)))
        return normalise_vintage(d)
    return shares(aggregate(cat, zone_cells(cat, field, value).drop("zone_fld", "zone_value"), []))


def build_zone_taxon(cat: Catalog) -> DataFrame:
    """The species table of every zone in one aggregation; never reads its own output."""
    by = ["zone_fld", "zone_value"]
    return shares(aggregate(cat, zone_cells(cat), by), by)


def normalise_vintage(d: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Three published vintages to the canonical columns; the risk scale follows from the schema."""
    has = set(d.columns)
    key = "mdl_key" if "mdl_key" in has else "mdl_seq" if "mdl_seq" in has else None
    if key is None:
        raise ValueError("no model id column (mdl_key or mdl_seq)")
    score = (F.col("er_score") / 100.0 if "rl_code" in has else F.col("er_score")) if "er_score" in has else F.col("rl_score") if "rl_score" in has else F.lit(None)
    score = score.cast("double")
    score = F.when(score.isNull() | score.between(0.0, 1.0), score).otherwise(F.raise_error(F.lit("er_score is not a 0-1 fraction")))
    flag = lambda c: (F.col(c) if c in has else F.lit(None)).cast("boolean").alias(c)
    out = d.select(
        *(by or []), "sp_cat", "sp_common", "sp_scientific", "taxon_id", "taxon_authority", F.col("er_code" if "er_code" in has else "rl_code").cast("string").alias("er_code"),
        score.alias("er_score"), flag("is_mmpa"), flag("is_mbta"), F.col(key).cast("string").alias("mdl_key"), F.col("area_km2").cast("double"), F.col("avg_suit").cast("double"),
    )
    return shares(out, by)


def cells_in_zone(cat: Catalog, key: str) -> DataFrame:
    return zone_cells(cat, "programarea_key", key).select("cell_id", F.lit(100).alias("pct_covered"))


def _components(df: DataFrame) -> DataFrame:
    return df.withColumn("component", component_label(F.col("metric_key"))).where("component <> 'all'").select("component", "score", F.lit(1).alias("even"))


def scores_for_cells(cat: Catalog, cells: DataFrame, pattern: str = "_ecoregion_rescaled$") -> DataFrame:
    """Coverage-weighted mean by metric; the weight of a cell without value counts."""
    val = F.col(cat.value("cell_metric"))
    d = cat["metric"].where(F.col("metric_key").rlike(pattern)).select("metric_seq", "metric_key").join(cat["cell_metric"].withColumn("_v", val).select("metric_seq", "cell_id", "_v"), "metric_seq").join(cells.select("cell_id", "pct_covered"), "cell_id")
    return _components(d.groupBy("metric_key").agg(F.try_divide(F.sum(F.col("_v") * F.col("pct_covered")), F.sum("pct_covered")).alias("score")))


def scores_for_zone(cat: Catalog, key: str, pattern: str = "_ecoregion_rescaled$") -> DataFrame:
    """Precomputed zone metrics."""
    z = cat["zone"].where((F.col("fld") == "programarea_key") & (F.col(cat.value("zone")) == F.lit(key))).select("zone_seq")
    d = z.join(cat["zone_metric"].withColumn("score", F.col(cat.value("zone_metric"))).select("zone_seq", "metric_seq", "score"), "zone_seq")
    return _components(d.join(cat["metric"].where(F.col("metric_key").rlike(pattern)).select("metric_seq", "metric_key"), "metric_seq"))


def weighted_mean(x: Column, w: Column) -> Column:
    """Pairs with a null leave both sums."""
    both = x.isNotNull() & w.isNotNull()
    return F.try_divide(F.sum(F.when(both, x * w)), F.sum(F.when(both, w)))


def mean_score(scores: DataFrame) -> DataFrame:
    return scores.agg(weighted_mean(F.col("score"), F.col("even")).alias("mean_score"))


def petals(df: DataFrame, category: str, height: str, width: str) -> DataFrame:
    """Rectangles of a flower plot: widths side by side in the order of the category."""
    w = Window.orderBy(category)
    top = F.sum(F.col(width).cast("double")).over(w.rowsBetween(Window.unboundedPreceding, 0))
    return df.withColumn("ymax", top).withColumn("ymin", F.lag("ymax", 1, 0.0).over(w)).withColumn("xmax", F.col(height).cast("double")).withColumn("xmin", F.lit(0.0))
