"""Rules of the grid operators on small fixtures with exact results."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellforge.functions import grid, keys
from cellforge.operators import fingerprint, identity, merge, spatial, species, validate
from cellforge.plans import dag
from cellforge.sources import files
from cellforge.sources.catalog import Catalog


def _surface(df, key="ms_merge_key"):
    out = {}
    for r in df.collect():
        out.setdefault(r[key], []).append((r["cell_id"], r["val"]))
    return {k: sorted(v) for k, v in out.items()}


@pytest.fixture(scope="module")
def merged(spark):
    """Taxa with a range alone, with range and model that overlap in part, that never meet, and with a model alone."""
    rows = [("otter", "iucn", c, 1.0) for c in (3, 4, 40)] + [("seal", "iucn", 3, 1.0), ("seal", "bl", 3, 1.0), ("seal", "am", 3, 12.0), ("seal", "am", 3, 33.0), ("seal", "am", 9, 99.0)]
    rows += [("whale", "iucn", 50, 1.0), ("whale", "am", 4, 88.0), ("krill", "am", 4, 5.0), ("krill", "am", 4, 5.0), ("krill", "am", 60, 7.0), ("stray", "iucn", 3, 1.0)]
    b = spark.createDataFrame(rows, "ms_merge_key string, ds_key string, cell_id int, val double")
    taxon = spark.createDataFrame([("otter", 10), ("seal", 25), ("whale", 40), ("krill", 0)], "ms_merge_key string, er_score int")
    us = spark.createDataFrame([(c,) for c in (3, 4, 5, 9)], "cell_id int")
    return merge.merge(b, taxon, None, us)


def test_merge_us(merged):
    assert _surface(merged["us"]) == {"otter": [(3, 10), (4, 10)], "seal": [(3, 33)], "krill": [(4, 5), (4, 5)]}


def test_merge_global(merged):
    assert _surface(merged["global"]) == {"otter": [(3, 10), (4, 10), (40, 10)], "seal": [(3, 33)], "whale": [(50, 40)]}
    assert {(r.ms_merge_key, r.cell_id, r.am) for r in merged["b_am_rng"].collect()} == {("seal", 3, 33.0)}


def test_merge_scans_its_surface_twice(merged):
    plan = merged["us"]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("collect_list") == 0


def test_turtle(spark):
    src = spark.createDataFrame([("T", "turtles", 1, 80.0), ("T", "turtles", 2, 60.0), ("T", "am", 1, 50.0), ("T", "ch", 1, 90.0)], "ms_merge_key string, ds_key string, cell_id int, val double")
    assert _surface(merge.turtle(src, "turtles", "am", ["ch"])) == {"T": [(1, 90), (2, 1)]}


def _catalog(spark, new, **extra):
    t = {
        "cell": spark.createDataFrame([(11, 40.0), (12, 10.0), (13, 5.0)], "cell_id long, area_km2 double"),
        "zone": spark.createDataFrame([(7, "z", "programarea_key", "BAY")], "zone_seq int, tbl string, fld string, val string"),
        "zone_cell": spark.createDataFrame([(7, 11, 50.0), (7, 12, 100.0)], "zone_seq int, cell_id long, pct_covered double"),
    }
    rows = [(4, "WORMS", "Lutra ficta", "otter", "mammal", "IUCN:VU", 30.0, False, False, True), (5, "ITIS", "Phoca ficta", "seal", "mammal", "IUCN:LC", 90.0, True, True, False), (6, "WORMS", "Rana ficta", "frog", "amphibian", "IUCN:LC", 90.0, False, False, True)]
    taxon = spark.createDataFrame(rows, "taxon_id int, taxon_authority string, scientific_name string, common_name string, sp_cat string, extrisk_code string, er_score double, is_mmpa boolean, is_mbta boolean, is_ok boolean")
    surface = [(11, 60.0, 4), (12, 30.0, 4), (13, 99.0, 4), (11, 50.0, 5), (11, 50.0, 6)]
    if new:
        taxon = taxon.withColumnRenamed("is_ok", "is_valid_usa").withColumn("is_marine", F.lit(True)).withColumn("ms_merge_key", F.concat(F.lit("k"), "taxon_id"))
        mc = spark.createDataFrame([(c, v, f"k{t}") for c, v, t in surface], "cell_id long, val double, mdl_key string")
    else:
        taxon = taxon.withColumn("mdl_seq", F.col("taxon_id") + 100)
        mc = spark.createDataFrame([(c, v, t + 100) for c, v, t in surface], "cell_id long, value double, mdl_seq int")
    return Catalog(t | {"taxon": taxon, "model_cell": mc} | extra)


@pytest.mark.parametrize("new,key", [(False, "104"), (True, "k4")])
def test_species_generations(spark, new, key):
    (r,) = species.for_zone(_catalog(spark, new), "programarea_key", "BAY").collect()
    assert (r.mdl_key, r.area_km2, round(r.avg_suit, 6), r.er_score, r.pct_cat) == (key, 30, 0.4, 0.3, 1)


def test_species_needs_validity(spark):
    c = _catalog(spark, False)
    c.tables["taxon"] = c["taxon"].drop("is_ok")
    with pytest.raises(ValueError, match="cannot resolve"):
        species.for_zone(c, "programarea_key", "BAY")


def test_vintage_scale(spark):
    d = spark.createDataFrame([("m", "a", "A", 1, "W", "k", 5.0, 1.0, 0.5)], "sp_cat string, sp_common string, sp_scientific string, taxon_id int, taxon_authority string, mdl_key string, er_score double, area_km2 double, avg_suit double").withColumn("er_code", F.lit("x"))
    with pytest.raises(Exception, match="not a 0-1 fraction"):
        species.normalise_vintage(d).collect()


def test_grid(spark):
    g, known = grid.grid("usa05"), [(3418971, -90.525, 27.525), (3046011, -120.525, 33.525), (1587211, -140.025, 57.025), (1909113, 179.475, 51.825)]
    df = spark.createDataFrame(known, "id long, lon double, lat double")
    lon, lat = grid.cell_lon(F.col("id"), g), grid.cell_lat(F.col("id"), g)
    for r in df.select("id", "lon", "lat", lon.alias("x"), lat.alias("y"), grid.cell_from_lonlat(lon, lat, g).alias("back")).collect():
        assert (round(r.x, 6), round(r.y, 6), r.back) == (r.lon, r.lat, r.id)
    assert spark.createDataFrame([(0.0, 0.0), (-140.0, 89.0)], "a double, b double").select(grid.cell_from_lonlat(F.col("a"), F.col("b"), g).alias("c")).where("c IS NULL").count() == 2
    assert grid.lon_ranges(170, 190) == [(170, 180), (-180, -170)] and grid.lon_ranges(-180, 180) == [(-180, 180)]
    ids = [1, 7200, 7201, 1080221, 15480268, 25920000, 360000, 360001, 3600000]
    got = {r.t for r in spark.createDataFrame([(i,) for i in ids], "i long").select(grid.tile(F.col("i"), 7200).alias("t")).collect()}
    assert sorted(got) == grid.tiles_of(ids, 7200)


#: Cells and tiles of the two grids are in test_grid.
def test_polygon_coverage(spark):
    g = grid.grid("global05")
    ring = lambda x0, y0, x1, y1: [x0, y0, x1, y0, x1, y1, x0, y1]
    rings = spark.createDataFrame([("sq", False, ring(-121.0, 34.0, -119.0, 34.1)), ("half", False, ring(-120.05, 34.95, -120.025, 35.0)), ("hole", False, ring(0.0, 0.0, 0.1, 0.1)), ("hole", True, ring(0.0, 0.0, 0.05, 0.05))], "zone_key string, is_hole boolean, xy array<double>")
    got = {}
    for r in spatial.whole_percents(spatial.coverage(rings, g)).collect():
        got.setdefault(r.zone_key, []).append(r.pct_covered)
    assert got["sq"] == [100] * 80 and got["half"] == [50] and got["hole"] == [100] * 3
    u = np.array([[0, 0], [3, 0], [3, 3], [2, 3], [2, 1], [1, 1], [1, 3], [0, 3]], float)
    assert spatial.clip_area(u, 0.5, 2, 2.5, 3) == pytest.approx(1.0)


def test_fingerprints(spark):
    mc = spark.createDataFrame([(m, c, v) for m, x in ((1, 9), (2, 8), (3, 9)) for c, v in ((12, x), (10, 5), (11, 7))][::-1], "m int, cell_id long, val byte")
    h = {r.m: r.content_hash for r in fingerprint.content_hashes(mc, ["m"], ["cell_id", "val"]).collect()}
    assert h[1] == h[3] != h[2] and len(h[1]) == 16
    a = spark.createDataFrame([(None, "a"), ("a", None)], "x string, y string")
    hs = [fingerprint.hash_table(a.where(w)).first()[0] for w in ("x IS NULL", "y IS NULL")]
    assert hs[0] != hs[1]
    fx = spark.createDataFrame([(i, chr(97 + i), i / 4) for i in range(9)], "id int, nm string, val double")
    one = fingerprint.table_digest(fx)
    assert one["digest"] == fingerprint.table_digest(fx.repartition(3))["digest"] != fingerprint.table_digest(fx.union(fx.limit(1)))["digest"]
    assert fingerprint.table_digest(fx.where("id < 0"))["data_digest"] == "0" * 32


def test_ids(spark):
    df = lambda xs: spark.createDataFrame([(x,) for x in xs], "mdl_key string")
    assert {r.mdl_key: r.mdl_id for r in identity.assign_mdl_id(df("bac")).collect()} == {"a": 1, "b": 2, "c": 3}
    pub = spark.createDataFrame([("c", 7), ("a", 3)], "mdl_key string, mdl_id long")
    assert {r.mdl_key: r.mdl_id for r in identity.assign_mdl_id(df("abd"), pub).collect()} == {"a": 3, "b": 8, "d": 9}


def test_codes(spark):
    d = spark.createDataFrame([("NMFS:EN", False, False), ("NMFS:TN", True, False), ("IUCN:CR", True, True), (None, True, True), ("FWS:LC", None, False)], "c string, m boolean, b boolean")
    assert [r[0] for r in d.select(keys.er_score(F.col("c"), F.col("m"), F.col("b"))).collect()] == [100, 50, 50, 1, None]
    with pytest.raises(Exception, match="unrecognised"):
        spark.createDataFrame([("IUCN:TN",)], "c string").select(keys.er_score(F.col("c"), F.lit(True), F.lit(True))).collect()
    n = spark.createDataFrame([("Acipenser oxyrinchus (=oxyrhynchus) desotoi",)], "n string")
    assert n.select(keys.clean_name(F.col("n")), keys.clean_name(F.col("n"), True)).first()[:] == ("Acipenser oxyrinchus desotoi", "Acipenser oxyrinchus")


def test_validation(spark):
    a = spark.createDataFrame([("CGM", 0.5), ("WGM", 0.2), ("MAT", 0.8)], "k string, score double")
    b = spark.createDataFrame([("MAT", 0.83), ("CGM", 0.52), ("WGM", 0.2)], "k string, score double")
    d = validate.score_delta(a, b, "k")
    assert [r.k for r in d.collect()] == ["MAT", "CGM", "WGM"]
    with pytest.raises(ValueError):
        validate.assert_within_tolerance(d, 0.001, 1)
    z = spark.createDataFrame([("A", "m", 1.0), ("B", "m", 1.0), ("C", "m", 1.0)], "zone_key string, metric_key string, score double")
    assert validate.zone_score_delta(z, z).first()["cor"] is None


def test_registry_keeps_absent_classes(spark):
    s = "ds_key string, asset_type string, representation string, mdl_key string"
    old = spark.createDataFrame([("am", "cog", "model", "1"), ("bl", "pm", "native", "2")], s)
    assert identity.registry_merge(old, old.where("ds_key = 'am'")).count() == 2
    with pytest.raises(ValueError, match="shrank"):
        identity.registry_merge(old.union(old), old)


def test_idw_and_bilinear(spark):
    src = spark.createDataFrame([(1, 0.0, 0.0, 10.0), (2, 1.0, 0.0, 20.0)], "src_id long, lon double, lat double, val double")
    t = spark.createDataFrame([(1, 0.5, 0.0), (2, 0.0, 0.0)], "id long, lon double, lat double")
    got = {r.id: r.val for r in spatial.idw(spatial.weights(spatial.nearest(t, src, 2)), src).collect()}
    assert got[1] == pytest.approx(15) and got[2] == pytest.approx(10)
    raster = spark.createDataFrame([(c, r, float(c + r)) for c in range(3) for r in range(3)], "col long, row long, val double")
    assert spatial.bilinear(spark.createDataFrame([(1, 0.5, 1.25)], "id long, x double, y double"), raster).first()["val"] == pytest.approx(1.75)


def test_dag_and_tokens(tmp_path):
    t = [dag.Target("a", "grid"), dag.Target("b", "ingest", ["a"]), dag.Target("c", "calc", ["auto"])]
    assert dag.plan(t) == ["a", "b", "c"]
    with pytest.raises(ValueError, match="undefined"):
        dag.plan([dag.Target("x", "", ["nope"])])
    token = dag.sign("v8", "s", 2_000_000_000)
    assert dag.verify(token, "s", 1) == "v8" and dag.verify(token, "t", 1) is None and dag.verify(token, "s", 3e9) is None
    p = str(tmp_path / "m.json")
    assert files.write_manifest(p, "t", "h", {"b": 1, "a": 2}) and not files.write_manifest(p, "t", "h", {"a": 2, "b": 1})
    assert files.front_matter("---\na: 1\n---\nx") == {"a": 1}


def test_write_prunes(spark, tmp_path):
    d = spark.range(100).withColumn("tile", F.col("id") % 4)
    files.write_parquet(d, str(tmp_path / "t"), partition_by=["tile"])
    got = spark.read.parquet(str(tmp_path / "t")).where(F.col("tile").isin(1, 2))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert got.count() == 50 and "PartitionFilters: [" in plan and "tile" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_tile_check(spark):
    model = spark.createDataFrame([(1, 0), (7201, 0), (51, 1)], "cell_id long, tile long")
    width = lambda n: spark.createDataFrame([(n,)], "ncol int")
    species.tile_check(Catalog({"cell_model": model, "cell_grid": width(7200)}))
    with pytest.raises(ValueError, match="tile"):
        species.tile_check(Catalog({"cell_model": model, "cell_grid": width(3103)}))
    cells = spark.createDataFrame([(7201, 100)], "cell_id long, pct_covered int")
    with pytest.raises(ValueError, match="tile"):
        species.for_cells(Catalog({"cell_model": model, "cell_grid": width(3103)}), cells, [7201])
