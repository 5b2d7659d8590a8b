"""Polygon coverage of cells, nearest-neighbour interpolation, bilinear resampling, enclosing circles."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.grid import Grid, lon_ranges
from ..sources.scratch import saved


def clip_ring(ring: np.ndarray, x0: float, y0: float, x1: float, y1: float) -> np.ndarray:
    """A ring (n, 2) within a rectangle, by four half-plane clips; edges may run along the rectangle."""
    for axis, bound, sign in ((0, x0, 1), (0, x1, -1), (1, y0, 1), (1, y1, -1)):
        if not len(ring):
            break
        d = sign * (ring[:, axis] - bound)
        nxt, dn = np.roll(ring, -1, axis=0), np.roll(d, -1)
        out = []
        for p, q, a, b in zip(ring, nxt, d, dn, strict=True):
            if a >= 0:
                out.append(p)
            if a * b < 0:
                out.append(p + (q - p) * (a / (a - b)))
        ring = np.array(out).reshape(-1, 2)
    return ring


def ring_area(ring: np.ndarray) -> float:
    x, y = ring[:, 0], ring[:, 1]
    return abs(float(0.5 * np.sum(x * np.roll(y, -1) - np.roll(x, -1) * y))) if len(ring) else 0.0


def clip_area(ring: np.ndarray, x0: float, y0: float, x1: float, y1: float) -> float:
    """Area of a ring within a rectangle."""
    return ring_area(clip_ring(ring, x0, y0, x1, y1))


def union_area(parts: dict[int, list[np.ndarray]]) -> float:
    """Area that at least one part covers; a part covers what an odd number of its rings hold, so holes are rings too.

    Between the x of all vertices and crossings no edges cross, so the covered length
    is linear there and its middle gives the area exactly.
    """
    edges = []
    for part, rings in parts.items():
        for r in rings:
            for p, q in zip(r, np.roll(r, -1, axis=0), strict=True):
                if p[0] != q[0]:
                    edges.append((part, *(p if p[0] < q[0] else q), *(q if p[0] < q[0] else p)))
    if not edges:
        return 0.0
    e = np.array([x[1:] for x in edges])
    owner = [x[0] for x in edges]
    slope = (e[:, 3] - e[:, 1]) / (e[:, 2] - e[:, 0])
    base = e[:, 1] - slope * e[:, 0]
    stops = set(e[:, 0].tolist()) | set(e[:, 2].tolist())
    for i in range(len(e)):
        d = slope[i] - slope[:i]
        cross = np.flatnonzero(d != 0)
        x = (base[:i][cross] - base[i]) / d[cross]
        inside = (x > np.maximum(e[i, 0], e[:i][cross, 0])) & (x < np.minimum(e[i, 2], e[:i][cross, 2]))
        stops.update(x[inside].tolist())
    xs, total = sorted(stops), 0.0
    for a, b in zip(xs, xs[1:], strict=False):
        m = (a + b) / 2
        by: dict[int, list[float]] = {}
        for k in np.flatnonzero((e[:, 0] <= a) & (e[:, 2] >= b)).tolist():
            by.setdefault(owner[k], []).append(slope[k] * m + base[k])
        spans = sorted(pair for ys in by.values() for pair in zip(*[iter(sorted(ys))] * 2, strict=False))
        top = -np.inf
        for lo, hi in spans:
            total += (b - a) * max(0.0, hi - max(lo, top))
            top = max(top, hi)
    return total


def coverage(rings: DataFrame, g: Grid, key: str = "zone_key") -> DataFrame:
    """(key, cell_id, fraction): rings (key, part, is_hole, xy array of x1, y1, x2, y2..) against the cells of their boxes.

    Parts may overlap: what several cover counts once. A ring may cross the dateline,
    with longitudes that go on beyond 180 or that jump; it is laid over the grid in
    every turn of 360 degrees. Only cells of a ring's bounding box are made, and only
    those that several rings touch are gathered. Without a part column all outer rings
    are parts of their own and holes are taken from all.
    """
    kind = rings.schema[key].dataType.simpleString()
    named = "part" in rings.columns

    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for k, part, hole, xy in zip(pdf[key], pdf["part"], pdf["is_hole"], pdf["xy"], strict=True):
                ring = np.asarray(xy, float).reshape(-1, 2)
                if len(ring) < 3:
                    continue
                ring = np.column_stack([np.unwrap(ring[:, 0], period=360), ring[:, 1]])
                r0, r1 = (int(np.floor((g.ymax - v) / g.res + e)) for v, e in ((ring[:, 1].max(), 1e-9), (ring[:, 1].min(), -1e-9)))
                rows: list[tuple] = []
                for turn in (-720, -360, 0, 360, 720):
                    moved = ring + [turn, 0]
                    c0, c1 = (int(np.floor((v - g.xmin) / g.res + e)) for v, e in ((moved[:, 0].min(), 1e-9), (moved[:, 0].max(), -1e-9)))
                    if c1 < 0 or c0 >= g.ncol:
                        continue
                    for r in range(max(r0, 0), min(r1, g.nrow - 1) + 1):
                        y = g.ymax - (r + 1) * g.res
                        strip = clip_ring(moved, moved[:, 0].min(), y, moved[:, 0].max(), y + g.res)
                        for c in range(max(c0, 0), min(c1, g.ncol - 1) + 1):
                            x = g.xmin + c * g.res
                            own = (clip_ring(strip, x, y, x + g.res, y + g.res) - [x, y]) / g.res
                            area = ring_area(own)
                            if area > 1e-12:
                                rows.append((k, r * g.ncol + c + 1, part, hole, area, own.ravel().tolist()))
                        if len(rows) > 20_000:
                            yield pd.DataFrame(rows, columns=names)
                            rows = []
                if rows:
                    yield pd.DataFrame(rows, columns=names)

    def joined(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for k, cell, found in zip(pdf[key], pdf["cell_id"], pdf["rings"], strict=True):
                parts: dict[int, list[np.ndarray]] = {}
                for x in found:
                    for p in [x["part"]] if named or not x["is_hole"] else {y["part"] for y in found if not y["is_hole"]}:
                        parts.setdefault(p, []).append(np.asarray(x["xy"], float).reshape(-1, 2))
                out.append((k, cell, min(1.0, union_area(parts))))
            yield pd.DataFrame(out, columns=[key, "cell_id", "fraction"])

    names = [key, "cell_id", "part", "is_hole", "area", "xy"]
    df = rings if named else rings.withColumn("part", F.monotonically_increasing_id())
    cut = df.select(key, F.col("part").cast("long").alias("part"), "is_hole", "xy").mapInPandas(pieces, f"{key} {kind}, cell_id long, part long, is_hole boolean, area double, xy array<double>")
    cells = cut.groupBy(key, "cell_id").agg(F.count("*").alias("n"), F.sum(F.when(F.col("is_hole"), 0.0).otherwise(F.col("area"))).alias("one"), F.collect_list(F.struct("part", "is_hole", "xy")).alias("rings"))
    many = cells.where("n > 1").select(key, "cell_id", "rings").mapInPandas(joined, f"{key} {kind}, cell_id long, fraction double")
    return cells.where("n = 1").select(key, "cell_id", F.least("one", F.lit(1.0)).alias("fraction")).unionByName(many).where("fraction > 1e-12")


def whole_percents(cov: DataFrame, keep_zero: bool = False) -> DataFrame:
    """Whole percents, half to even; cells that round to 0 go unless the older rule keeps them."""
    out = cov.withColumn("pct_covered", F.bround(F.col("fraction") * 100).cast("int")).drop("fraction")
    return out if keep_zero else out.where("pct_covered > 0")


def cells_in_polygon(rings: DataFrame, source: DataFrame | Grid, g: Grid | None = None, key: str = "zone_key") -> DataFrame:
    """(key, cell_id, pct_covered) of polygons.

    source is a cell table: its cells (lon, lat, where it has them, are filtered to the
    polygons' box first, in one or two ranges of longitude) on grid g, less those that
    round to 0; or a grid alone, whose cells all count, those that round to 0 too.
    """
    if isinstance(source, Grid):
        return whole_percents(coverage(rings, source, key), keep_zero=True)
    if g is None:
        raise ValueError("a cell table needs the grid that its cell ids are of")
    cells = source
    if {"lon", "lat"} <= set(cells.columns):
        at = lambda k: F.transform(F.filter("xy", lambda x, i: i % 2 == k), lambda x: x)
        box = rings.agg(*[f(h(at(k))) for k in (0, 1) for f, h in ((F.min, F.array_min), (F.max, F.array_max))]).first()  # one row
        if box[0] is None:
            return whole_percents(coverage(rings, g, key))
        jumps = box[1] - box[0] > 180
        where = F.lit(False)
        for a, b in [(-180.0, 180.0)] if jumps else lon_ranges(box[0], box[1]):
            where |= F.col("lon").between(a - g.res, b + g.res)
        cells = cells.where(where & F.col("lat").between(box[2] - g.res, box[3] + g.res))
    return whole_percents(coverage(rings, g, key)).join(cells.select("cell_id"), "cell_id", "left_semi").select(key, "cell_id", "pct_covered")


def cells_from_ranges(cov: DataFrame, value: float, cover: bool = False, min_coverage: float = 0.0) -> DataFrame:
    """Flat value for any overlap, or value by coverage (2 places); the largest coverage of a cell counts."""
    best = cov.groupBy("cell_id").agg(F.max("fraction").alias("fraction")).where(F.col("fraction") > min_coverage)
    val = F.bround(F.col("fraction") * value, 2) if cover else F.lit(float(value))
    return best.select("cell_id", val.alias("val")).where("val > 0")


def overlap(a0: Column, a1: Column, b0: Column, b1: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(a1, b1) - F.greatest(a0, b0))


def rectangle_coverage(rects: DataFrame, keys: list[str], res: float, ncol: int) -> DataFrame:
    """Closed form for axis-aligned rectangles x0, y0, x1, y1 on a grid from (0, 0): only overlapped cells are made."""
    span = lambda lo, hi: F.sequence(F.floor(F.col(lo) / res), F.ceil(F.col(hi) / res) - 1)
    d = rects.where("x1 > x0 AND y1 > y0").withColumn("c", F.explode(span("x0", "x1"))).withColumn("r", F.explode(span("y0", "y1")))
    w = overlap(F.col("x0"), F.col("x1"), F.col("c") * res, (F.col("c") + 1) * res)
    h = overlap(F.col("y0"), F.col("y1"), F.col("r") * res, (F.col("r") + 1) * res)
    return d.select(*keys, (F.col("r") * ncol + F.col("c") + 1).cast("long").alias("cell_id"), (w * h / (res * res)).alias("fraction")).where("fraction > 0")


def _unit(df: DataFrame, **names: str) -> DataFrame:
    lon, lat = F.radians("lon"), F.radians("lat")
    return df.select(*[F.col(c).alias(n) for c, n in names.items()], (F.cos(lat) * F.cos(lon)).alias("x"), (F.cos(lat) * F.sin(lon)).alias("y"), F.sin(lat).alias("z"))


def nearest(targets: DataFrame, sources: DataFrame, k: int = 8) -> DataFrame:
    """(id, src_id, dist): the k sources nearest to each target on the unit sphere, ties (to 9 places) by src_id; exact.

    Points fall into cubes of a side; all sources within a side of a target lie in its
    27 cubes, so a target is done when its k-th source there is that near. The others
    go on with twice the side, until it spans the sphere. The first side is what a few
    sources share at an even density, so crowded places are done in the first rounds.
    """
    t, s = _unit(targets, id="id"), _unit(sources, src_id="src_id")
    n = sources.count()
    out, side = None, min(2.0, (max(1, k) / max(1, n)) ** 0.5)
    cube = lambda c: F.floor(F.col(c) / side).cast("int")
    while n:
        around = F.explode(F.sequence(F.lit(-1), F.lit(1)))
        near = s.select("src_id", F.col("x").alias("sx"), F.col("y").alias("sy"), F.col("z").alias("sz"), cube("x").alias("i"), cube("y").alias("j"), cube("z").alias("l"))
        ask = t.select("*", (cube("x")).alias("_i"), cube("y").alias("_j"), cube("z").alias("_l"))
        for c, d in (("_i", "i"), ("_j", "j"), ("_l", "l")):
            ask = ask.withColumn("_o", around).withColumn(d, (F.col(c) + F.col("_o")).cast("int")).drop("_o", c)
        gap = [(F.col(a) - F.col(b)) * (F.col(a) - F.col(b)) for a, b in (("x", "sx"), ("y", "sy"), ("z", "sz"))]
        pairs = ask.join(near, ["i", "j", "l"]).select("id", "src_id", F.sqrt(gap[0] + gap[1] + gap[2]).alias("dist"))
        w = Window.partitionBy("id").orderBy(F.round("dist", 9), "src_id")
        best = saved(pairs.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= k).drop("_r"), "nearest")
        last = side >= 2
        if last:
            return best if out is None else out.unionByName(best)
        done = best.groupBy("id").agg(F.count("*").alias("n"), F.max("dist").alias("far")).where((F.col("n") == min(k, n)) & (F.col("far") <= side)).select("id")
        part = best.join(done, "id", "left_semi")
        out = part if out is None else out.unionByName(part)
        t = saved(t.join(done, "id", "left_anti"), "targets")
        if t.isEmpty():
            return out
        side = min(2.0, side * 2)
    return targets.sparkSession.createDataFrame([], "id long, src_id long, dist double")


def weights(near: DataFrame, power: float = 2.0, radius_km: float | None = None) -> DataFrame:
    """1 / distance ** power, 1e12 at no distance; optionally only within a radius."""
    if radius_km is not None:
        near = near.where(F.col("dist") <= float(2 * np.sin(radius_km / 6371 / 2)))
    return near.withColumn("w", F.when(F.col("dist") > 0, F.try_divide(F.lit(1.0), F.pow("dist", F.lit(power)))).otherwise(1e12))


def idw(w: DataFrame, values: DataFrame, absent_is_zero: bool = False, threshold: float | None = None) -> DataFrame:
    """Weighted means by target; absent sources either leave both sums or count in the total weight."""
    j = w.join(values.select("src_id", F.col("val").alias("_v")), "src_id", "left")
    total = F.sum("w") if absent_is_zero else F.sum(F.when(F.col("_v").isNotNull(), F.col("w")))
    out = j.groupBy("id").agg(F.try_divide(F.sum(F.col("w") * F.col("_v")), total).alias("val")).where("val IS NOT NULL")
    return out.where(F.col("val") >= threshold) if threshold is not None else out


def bilinear(targets: DataFrame, source: DataFrame) -> DataFrame:
    """Values at fractional places (id, x, y) of a source raster (col, row, val): four neighbours as a join, weights renormalised."""
    fx, fy = F.floor("x"), F.floor("y")
    dx, dy = F.col("x") - fx, F.col("y") - fy
    four = F.array(*[F.struct((fx + i).cast("long").alias("col"), (fy + j).cast("long").alias("row"), ((dx if i else 1 - dx) * (dy if j else 1 - dy)).alias("w")) for i in (0, 1) for j in (0, 1)])
    e = targets.select("id", F.explode(four).alias("n")).select("id", "n.col", "n.row", "n.w").where("w > 0")
    return e.join(source, ["col", "row"]).groupBy("id").agg(F.try_divide(F.sum(F.col("w") * F.col("val")), F.sum("w")).alias("val"))


def enclosing_centre(points: np.ndarray, rounds: int = 300) -> np.ndarray:
    """Approximate centre of the smallest enclosing cap of unit vectors, by moving to the farthest point."""
    c = points.mean(axis=0)
    for i in range(1, rounds + 1):
        c = c + (points[np.argmin(points @ c)] - c) / (i + 1)
    return c / np.linalg.norm(c)


def widest_per_cell(cov: DataFrame, value: str = "val") -> DataFrame:
    """The value of the greatest coverage of each cell; ties go to the larger value."""
    w = Window.partitionBy("cell_id").orderBy(F.desc("fraction"), F.desc(value))
    return cov.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")
