"""Grid arithmetic as Column expressions: cell ids, coordinates, tiles, longitude frames."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Grid:
    ncol: int
    nrow: int
    xmin: float
    ymax: float
    res: float
    lon360: bool

    @property
    def ncell(self) -> int:
        return self.ncol * self.nrow


#: Grids by name, and the tile side in cells.
GRIDS = {"usa05": Grid(3103, 2006, 141.10, 82.60, 0.05, True), "global05": Grid(7200, 3600, -180.0, 90.0, 0.05, False)}
TILE_SIDE = 50


def grid(name: str) -> Grid:
    if name not in GRIDS:
        raise ValueError(f"unknown grid {name!r}; known: {', '.join(GRIDS)}")
    return GRIDS[name]


def grid_of_version(version: str) -> Grid:
    return grid("global05" if int("".join(c for c in version if c.isdigit())) >= 8 else "usa05")


def row_index(cell: Column, ncol: int) -> Column:
    return F.floor((cell - 1) / ncol)


def col_index(cell: Column, ncol: int) -> Column:
    return F.pmod(cell - 1, F.lit(ncol))


def cell_lon(cell: Column, g: Grid, wrap: bool = True) -> Column:
    lon = F.lit(g.xmin) + (col_index(cell, g.ncol) + 0.5) * g.res
    return F.when(lon >= 180, lon - 360).otherwise(lon) if g.lon360 and wrap else lon


def cell_lat(cell: Column, g: Grid) -> Column:
    return F.lit(g.ymax) - (row_index(cell, g.ncol) + 0.5) * g.res


def cell_from_lonlat(lon: Column, lat: Column, g: Grid) -> Column:
    """The cell that holds a point, null outside the grid; the top edge belongs to the first row."""
    x = F.when(lon < g.xmin, lon + 360).otherwise(lon) if g.lon360 else lon
    col = F.floor((x - g.xmin) / g.res) + 1
    row = F.greatest(F.ceil((F.lit(g.ymax) - lat) / g.res), F.lit(1))
    inside = (x >= g.xmin) & (x < g.xmin + g.ncol * g.res) & (lat <= g.ymax) & (lat > g.ymax - g.nrow * g.res)
    return F.when(inside, (row - 1) * g.ncol + col).cast("long")


def cell_i_grid(lon: Column, lat: Column, res: float) -> Column:
    ncol = round(360 / res)
    return (F.floor((F.lit(90.0) - lat) / res) * ncol + F.least(F.lit(ncol - 1), F.floor((lon + 180) / res)) + 1).cast("long")


def tile(cell: Column, ncol: int, side: int = TILE_SIDE) -> Column:
    """The tile of a cell: one formula for writer and reader."""
    return (F.floor(row_index(cell, ncol) / side) * (ncol // side) + F.floor(col_index(cell, ncol) / side)).cast("long")


def tiles_of(cells: list[int], ncol: int, side: int = TILE_SIDE) -> list[int]:
    """Sorted tiles of a caller's cells, for a literal partition filter."""
    return sorted({((c - 1) // ncol // side) * (ncol // side) + ((c - 1) % ncol) // side for c in cells})


def lon_ranges(x0: float, x1: float) -> list[tuple[float, float]]:
    """Longitude ranges within -180..180 that x0..x1 covers."""
    if x1 - x0 >= 360:
        return [(-180.0, 180.0)]
    a, b = (x0 + 180) % 360 - 180, (x1 + 180) % 360 - 180
    if b == -180 and x1 > x0:
        b = 180.0
    return [(a, b)] if a <= b else [(a, 180.0), (-180.0, b)]


def lon_span_aggs(lon: Column) -> list[Column]:
    """min and max in both frames; give the row to `lon_span`."""
    east = F.when(lon < 0, lon + 360).otherwise(lon)
    return [F.min(lon).alias("min180"), F.max(lon).alias("max180"), F.min(east).alias("min360"), F.max(east).alias("max360")]


def lon_span() -> tuple[Column, Column]:
    """The narrower frame's span; the 0..360 frame only if narrower and under 350 degrees."""
    switch = (F.col("max360") - F.col("min360") < F.col("max180") - F.col("min180")) & (F.col("max360") - F.col("min360") < 350)
    return F.when(switch, F.col("min360")).otherwise(F.col("min180")), F.when(switch, F.col("max360")).otherwise(F.col("max180"))


def spans_globe(xmin: Column, xmax: Column) -> Column:
    width = xmax - xmin
    return F.coalesce((width >= 350) | F.isnan(width), F.lit(True))


def view_zoom(radius: Column) -> Column:
    z = F.lit(6.75) - F.log2(radius * 1.1)
    return F.when((radius > 0) & ~F.isnan(radius), F.greatest(F.lit(1.7), F.least(F.lit(5.0), z))).otherwise(5.0)


def rarity_class(area: Column) -> Column:
    """Right-closed classes of a range's area in km2."""
    return F.when(area <= 1e4, "very_rare").when(area <= 1e5, "rare").when(area <= 1e6, "common").when(area.isNotNull(), "very_common")


def colour_bin(value: Column, low: float, high: float, n: int) -> Column:
    """The equal-width bin 1..n-1 of seq(low, high, n), ends included."""
    return F.least(F.lit(n - 1), F.greatest(F.lit(1), F.floor((value - low) / ((high - low) / (n - 1))) + 1)).cast("int")


def sphere_sums(lon: Column, lat: Column, w: Column) -> list[Column]:
    """Weighted unit-vector sums; give the row to `sphere_centroid`."""
    r, p = F.radians(lon), F.radians(lat)
    return [F.sum(F.cos(p) * F.cos(r) * w).alias("sx"), F.sum(F.cos(p) * F.sin(r) * w).alias("sy"), F.sum(F.sin(p) * w).alias("sz")]


def sphere_centroid() -> tuple[Column, Column]:
    x, y, z = F.col("sx"), F.col("sy"), F.col("sz")
    ok = F.sqrt(x * x + y * y + z * z) >= 2.220446049250313e-16
    return F.when(ok, F.degrees(F.atan2(y, x))), F.when(ok, F.degrees(F.atan2(z, F.sqrt(x * x + y * y))))


def angular_distance(lon0: Column, lat0: Column, lon: Column, lat: Column) -> Column:
    a, b, dl = F.radians(lat0), F.radians(lat), F.radians(lon - lon0)
    dot = F.cos(a) * F.cos(b) * F.cos(dl) + F.sin(a) * F.sin(b)
    return F.degrees(F.acos(F.least(F.lit(1.0), F.greatest(F.lit(-1.0), dot))))
