"""Zone sets: which column names a zone, what identifies a set of geometries, registry faults; views of study areas."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import grid
from ..functions.keys import zone_set_key
from .spatial import enclosing_centre
from .validate import zone_set_faults


def key_column(zone_type: str, columns: Iterable[str]) -> str:
    """`<type>_key`, else the first column that ends in key."""
    columns = list(columns)
    if f"{zone_type}_key" in columns:
        return f"{zone_type}_key"
    other = next((c for c in columns if c.endswith("key")), None)
    if other is None:
        raise ValueError(f"no key column for {zone_type} among {', '.join(columns)}")
    return other


def geometry_hashes(zones: DataFrame, key: str, by: str = "zone_type", geometry: str = "wkb") -> DataFrame:
    """by, n, geom_hash: 16 hex digits of a set's geometries in the order of their keys, whatever the order of rows.

    Zones are hashed on their own first, so what is gathered is two hashes a zone.
    """
    each = zones.select(by, F.col(key).cast("string").alias("_k"), F.xxhash64(F.col(key).cast("string"), F.coalesce(geometry, F.lit(b""))).alias("_h"))
    ordered = F.array_sort(F.collect_list(F.struct("_k", "_h")))
    out = each.groupBy(by).agg(F.count("*").alias("n"), F.xxhash64(F.transform(ordered, lambda x: x["_h"])).alias("_x"))
    return out.select(by, "n", F.lower(F.lpad(F.hex("_x"), 16, "0")).alias("geom_hash"))


def group_sets(sets: DataFrame, vintages: Mapping[str, str]) -> DataFrame:
    """sets (zone_type, geom_hash, ...) with vintage and zone_set_key by hash; both null where the hash is unknown."""
    for c in ("zone_type", "geom_hash"):
        if c not in sets.columns:
            raise ValueError(f"sets need a {c} column")
    names = sets.sparkSession.createDataFrame(list(vintages.items()), "geom_hash string, vintage string")
    out = sets.drop("vintage", "zone_set_key").join(F.broadcast(names), "geom_hash", "left")  # the caller's own mapping
    return out.withColumn("zone_set_key", F.when(F.col("vintage").isNotNull(), zone_set_key(F.col("zone_type"), F.col("vintage"))))


def require_sound(registry: DataFrame) -> DataFrame:
    """The registry, or an error that names the first broken invariants."""
    bad = zone_set_faults(registry).orderBy("rule", "key").head(5)
    if bad:
        raise ValueError("zone set registry: " + "; ".join(f"{r['rule']} at {r['key']}" for r in bad))
    return registry


def area_views(vertices: DataFrame, full: str = "FULL", full_zoom: float = 2.16, labels: Mapping[str, str] | None = None) -> DataFrame:
    """key, label, lon, lat, zoom, ecoregions of every region of vertices (region_key, ecoregion_key, lon, lat), and of all.

    A region is framed by its smallest enclosing circle, over its distinct vertices to
    three places; all of them by their centroid on the sphere and a given zoom, as no
    view of a globe can hold more than half of it.
    """
    points = vertices.where("lon IS NOT NULL AND lat IS NOT NULL")
    names = F.create_map(*[F.lit(x) for pair in (labels or {}).items() for x in pair]) if labels else F.create_map(F.lit(""), F.lit(""))
    places = points.select(F.col("region_key").alias("key"), F.round("lon", 3).alias("lon"), F.round("lat", 3).alias("lat")).distinct()

    def circle(pdf: pd.DataFrame) -> pd.DataFrame:
        r, p = np.radians(pdf["lon"].to_numpy()), np.radians(pdf["lat"].to_numpy())
        xyz = np.column_stack([np.cos(p) * np.cos(r), np.cos(p) * np.sin(r), np.sin(p)])
        c = enclosing_centre(xyz)
        radius = float(np.degrees(np.arccos(np.clip(xyz @ c, -1, 1)).max()))
        return pd.DataFrame({"key": [pdf["key"].iloc[0]], "lon": [float(np.degrees(np.arctan2(c[1], c[0])))], "lat": [float(np.degrees(np.arcsin(c[2])))], "radius": [radius]})

    regions = places.groupBy("key").applyInPandas(circle, "key string, lon double, lat double, radius double").select("key", "lon", "lat", grid.view_zoom(F.col("radius")).alias("zoom"))
    lon, lat = grid.sphere_centroid()
    whole = points.agg(*grid.sphere_sums(F.col("lon"), F.col("lat"), F.lit(1.0))).select(F.lit(full).alias("key"), lon.alias("lon"), lat.alias("lat"), F.lit(full_zoom).alias("zoom"))
    said = lambda k: F.array_join(F.array_sort(F.collect_set("ecoregion_key")), " ").alias(k)
    eco = points.groupBy(F.col("region_key").alias("key")).agg(said("ecoregions")).unionByName(points.agg(said("ecoregions")).select(F.lit(full).alias("key"), "ecoregions"))
    out = whole.unionByName(regions).join(eco, "key")
    return out.select("key", F.coalesce(names[F.col("key")], "key").alias("label"), F.round("lon", 3).alias("lon"), F.round("lat", 3).alias("lat"), F.round("zoom", 2).alias("zoom"), "ecoregions")

