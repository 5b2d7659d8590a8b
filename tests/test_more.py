"""Sources, zones, releases and the branches that registered queries do not take."""

import json
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellforge.functions import grid, keys
from cellforge.operators import fingerprint, identity, spatial, species, validate, zones
from cellforge.plans import dag, releases
from cellforge.sources import catalog, files
from cellforge.sources.catalog import Catalog
from tests.test_core import _catalog

BOX = lambda x0, y0, x1, y1: [float(v) for v in (x0, y0, x1, y0, x1, y1, x0, y1)]


def _cells(df):
    return {r.cell_id: round(r.fraction, 9) for r in df.collect()}


def test_polygons_union_and_dateline(spark):
    g = grid.grid("global05")
    s = "zone_key string, part long, is_hole boolean, xy array<double>"
    cov = lambda *rows: _cells(spatial.coverage(spark.createDataFrame([("z", p, hole, [float(v) for v in xy]) for p, hole, xy in rows], s), g))
    half = BOX(10.0, 20.0, 10.025, 20.05)
    assert list(cov((1, False, half), (2, False, half)).values()) == [0.5]  # the same half twice is a half
    assert list(cov((1, False, BOX(10, 20, 10.03, 20.05)), (2, False, BOX(10.02, 20, 10.04, 20.05))).values()) == [0.8]
    assert list(cov((1, False, BOX(10, 20, 10.05, 20.05)), (1, True, BOX(10.01, 20.01, 10.02, 20.02))).values()) == [0.96]
    assert list(cov((1, False, [10, 20, 10.05, 20, 10.05, 20.05]), (2, False, [10, 20, 10.05, 20.05, 10, 20.05])).values()) == [1.0]
    assert list(cov((1, False, [10, 20, 10.05, 20, 10.05, 20.05]), (2, False, [10, 20.05, 10.05, 20, 10, 20])).values()) == [0.75]  # crossing edges
    over = cov((1, False, BOX(179.9, 0.0, 180.1, 0.1)))
    assert len(over) == 8 and set(over.values()) == {1.0} and {(c - 1) % 7200 for c in over} == {7198, 7199, 0, 1}
    assert over == cov((1, False, [179.9, 0.0, -179.9, 0.0, -179.9, 0.1, 179.9, 0.1])) == cov((1, False, BOX(-180.1, 0.0, -179.9, 0.1)))
    u = grid.grid("usa05")
    seam = _cells(spatial.coverage(spark.createDataFrame([("z", 1, False, BOX(179.95, 50.0, 180.1, 50.05)), ("z", 2, False, BOX(-180.0, 50.0, -179.9, 50.05))], s), u))
    assert len(seam) == 3 and set(seam.values()) == {1.0}  # the second lies in the first, a turn away


def test_cells_in_polygon(spark):
    g = grid.grid("global05")
    rows = [(r * 7200 + c + 1, -180 + (c + 0.5) * 0.05, 90 - (r + 0.5) * 0.05) for r in range(1780, 1800) for c in [*range(0, 6), *range(7190, 7200), *range(3600, 3610)]]
    cells = spark.createDataFrame(rows, "cell_id long, lon double, lat double")
    rings = spark.createDataFrame([("z", False, BOX(179.9, 0.1, 180.1, 0.2)), ("y", False, BOX(0.0, 0.1, 0.02, 0.15)), ("y", False, BOX(0.05, 0.1, 0.0502, 0.15))], "zone_key string, is_hole boolean, xy array<double>")
    got = {(r.zone_key, r.cell_id): r.pct_covered for r in spatial.cells_in_polygon(rings, cells, g).collect()}
    assert sum(v for (z, _), v in got.items() if z == "z") == 800 and sorted(v for (z, _), v in got.items() if z == "y") == [40]
    narrow = spatial.cells_in_polygon(rings.where("zone_key = 'z'"), cells, g)
    plan = narrow._jdf.queryExecution().optimizedPlan().toString()
    assert "lat" in plan and narrow.count() == 8
    assert spatial.cells_in_polygon(rings, cells.drop("lon", "lat"), g).count() == len(got)
    assert sorted(r.pct_covered for r in spatial.cells_in_polygon(rings.where("zone_key = 'y'"), g).collect()) == [0, 40]  # a grid alone keeps zeros
    with pytest.raises(ValueError, match="grid"):
        spatial.cells_in_polygon(rings, cells)
    best = spark.createDataFrame([(1, 0.2), (1, 0.6), (2, 0.1), (3, 0.004)], "cell_id long, fraction double")
    assert sorted(map(tuple, spatial.cells_from_ranges(best, 50, cover=True).collect())) == [(1, 30.0), (2, 5.0), (3, 0.2)]
    assert sorted(map(tuple, spatial.cells_from_ranges(best, 50, min_coverage=0.15).collect())) == [(1, 50.0)]
    wide = spark.createDataFrame([(1, 0.5, 3.0), (1, 0.5, 4.0), (2, 0.1, 1.0), (2, 0.2, 0.5)], "cell_id long, fraction double, val double")
    assert sorted((r.cell_id, r.val) for r in spatial.widest_per_cell(wide).collect()) == [(1, 4.0), (2, 0.5)]


def test_nearest_against_all_pairs(spark):
    rng = np.random.RandomState(1)
    src = [(i, *p) for i, p in enumerate(np.concatenate([np.column_stack([rng.uniform(-180, 180, 120), rng.uniform(-90, 90, 120)]), np.tile([[10.0, 10.0]], (40, 1)), rng.normal([30, 5], 0.01, (60, 2))]).tolist())]
    tgt = [(0, 10.0, 10.0), (1, 179.99, 0.0), (2, 0.0, 90.0), (3, 30.0, 5.0), (4, -120.0, -60.0)]
    unit = lambda lon, lat: np.array([math.cos(math.radians(lat)) * math.cos(math.radians(lon)), math.cos(math.radians(lat)) * math.sin(math.radians(lon)), math.sin(math.radians(lat))])
    near = spatial.nearest(spark.createDataFrame(tgt, "id long, lon double, lat double"), spark.createDataFrame(src, "src_id long, lon double, lat double"), 7)
    got = {}
    for r in near.collect():
        got.setdefault(r.id, set()).add(r.src_id)
    for t, *p in tgt:
        order = sorted((round(float(np.linalg.norm(unit(*q) - unit(*p))), 9), i) for i, *q in src)
        assert got[t] == {i for _, i in order[:7]}
    few = spark.createDataFrame(src[:3], "src_id long, lon double, lat double")
    assert spatial.nearest(spark.createDataFrame(tgt, "id long, lon double, lat double"), few, 7).count() == 15
    assert spatial.nearest(spark.createDataFrame(tgt, "id long, lon double, lat double"), few.where("src_id < 0"), 7).count() == 0
    w = spatial.weights(spark.createDataFrame([(1, 1, 0.0), (1, 2, 0.5), (1, 3, 0.01)], "id long, src_id long, dist double"), radius_km=100)
    assert {r.src_id: r.w for r in w.collect()} == {1: 1e12, 3: pytest.approx(1e4)}
    even = spark.createDataFrame([(1, 1, 1.0), (1, 2, 3.0)], "id long, src_id long, w double")
    one = spark.createDataFrame([(2, 8.0)], "src_id long, val double")
    assert spatial.idw(even, one).first()["val"] == 8 and spatial.idw(even, one, absent_is_zero=True).first()["val"] == 6
    assert spatial.idw(even, one, threshold=9).count() == 0 and spatial.idw(even, one, threshold=8).count() == 1


def test_catalog(spark, tmp_path):
    base = str(tmp_path)
    spark.createDataFrame([(1, "k4"), (2, "k5")], "mdl_id int, mdl_key string").write.parquet(f"{base}/model.parquet")
    spark.createDataFrame([(7, 1, 0.5)], "zone_seq int, metric_seq int, val double").write.parquet(f"{base}/zone_metric.parquet")
    spark.createDataFrame([(11, 60.0, 1), (12, 1.0, 2)], "cell_id long, val double, mdl_id int").write.partitionBy("mdl_id").parquet(f"{base}/model_cell")
    c = Catalog.attach(spark, base, register=True)
    assert c["zone_metric"].first()["value"] == 0.5 and {(r.mdl_key, r.cell_id) for r in c["model_cell"].collect()} == {("k4", 11), ("k5", 12)}
    assert spark.sql("SELECT count(*) FROM zone_metric").first()[0] == 1 and "cell" not in c
    with pytest.raises(KeyError):
        c["cell"]
    assert c.exclude("model", "mdl_id").columns == ["mdl_key"]
    assert catalog.write_cell_grid(spark, base, "usa05").first()[1:] == (3103, 2006) and Catalog.attach(spark, base).tile_width() == 3103
    catalog.require_spark(spark, "3.5")
    with pytest.raises(ValueError, match="99"):
        catalog.require_spark(spark, "99.0")
    assert catalog.pages(120, 50) == [(1, 50), (51, 50), (101, 20)] and catalog.pages(100, 50) == [(1, 50), (51, 50)] and catalog.pages(7, None) == [(1, 7)] and catalog.pages(0, 5) == []
    lines = spark.createDataFrame([("x 1 y cog/g/0123456789abcdef.tif",), ("x 1 y cog/h/0123456789abcdef.tif",), ("cog/g/short.tif",)], "line string")
    assert [r.hash for r in catalog.content_index(lines, "g").collect()] == ["0123456789abcdef"]


def test_files(spark, tmp_path, monkeypatch):
    d = spark.createDataFrame([(3, "c"), (1, "a"), (2, "b")], "id int, nm string")
    files.write_parquet(d, str(tmp_path / "a.parquet"), order_by=["id"])
    back = spark.read.parquet(str(tmp_path / "a.parquet"))
    assert sorted(r.id for r in back.collect()) == [1, 2, 3] and any("zstd" in f for f in back.inputFiles())
    d.select("id", F.lit(1.5).alias("extra")).write.parquet(str(tmp_path / "more/p=1"))
    d.write.parquet(str(tmp_path / "more/p=2"))
    both = files.read_any(spark, str(tmp_path / "more"))
    assert set(both.columns) == {"id", "extra", "nm", "p"} and both.count() == 6  # union by name, folder columns
    assert files.read_any(spark, str(tmp_path / "more/p=*")).count() == 6
    found = {m["name"]: m for m in files.parquet_manifest(spark, str(tmp_path))}
    assert found["a"]["n_rows"] == 3 and found["a"]["bytes"] > 0 and found["more"]["n_rows"] == 6
    monkeypatch.setenv("FORCE_TARGETS", "grid, calc")
    assert files.forced("calc") and not files.forced("ca")
    (tmp_path / "one.qmd").write_text("---\ntarget: {name: x}\n---\n")
    assert files.pipeline_targets(str(tmp_path)) == [{"file": "one.qmd", "name": "x"}]
    h = fingerprint.hash_query(spark, "t", t=d).first()
    assert h == fingerprint.hash_table(d).first() == fingerprint.hash_query(spark, "SELECT * FROM {t} ORDER BY id", t=d).first() != fingerprint.hash_query(spark, "SELECT * FROM {t} WHERE id > 1", t=d).first()


def test_cell_model_and_precomputed_zones(spark):
    model = spark.createDataFrame([(1, "k4"), (2, "k5")], "mdl_id int, mdl_key string")
    cm = spark.createDataFrame([(0, 1, 11, 60.0), (0, 1, 12, 30.0), (0, 2, 11, 50.0)], "tile long, mdl_id int, cell_id long, val double")
    cells = spark.createDataFrame([(11, 50.0), (12, 100.0)], "cell_id long, pct_covered double")
    (r,) = species.for_cells(_catalog(spark, True, cell_model=cm, model=model), cells, [11, 12]).collect()
    assert (r.mdl_key, r.area_km2, round(r.avg_suit, 6)) == ("k4", 30, 0.4)
    with pytest.raises(ValueError, match="1 of 2 cells disagree"):
        species.tile_check(Catalog({"cell_model": cm.withColumn("tile", F.when(F.col("cell_id") == 12, 5).otherwise(0).cast("long"))}))
    with pytest.raises(ValueError, match="no rows"):
        species.tile_check(Catalog({"cell_model": cm.where("cell_id < 0")}))
    assert species.tile_check(Catalog({}))
    c = _catalog(spark, True)
    table = species.build_zone_taxon(c)
    live = species.for_zone(c, "programarea_key", "BAY")
    c.tables["zone_taxon"] = table.withColumn("area_km2", F.col("area_km2") + 1)
    assert species.for_zone(c, "programarea_key", "BAY").first()["area_km2"] == 31 and species.for_zone(c, "programarea_key", "BAY", use_precomputed=False).first() == live.first()
    assert species.build_zone_taxon(c).first()["area_km2"] == 30  # never its own output
    shown = species.report(live, "https://models/").first()
    assert (shown.model_url, shown.er_pct, shown.suit_pct, shown.pct_cat) == ("https://models/k4", 30.0, 40.0, 100.0)
    assert [r.mdl_key for r in species.top(live, 1).collect()] == ["k4"]
    nulls = live.withColumn("sp_cat", F.lit(None).cast("string"))
    assert species.shares(nulls.unionByName(nulls)).select("pct_cat").first()[0] == 0.5


def test_zones(spark):
    s = "zone_type string, eco_key string, wkb binary"
    a = spark.createDataFrame([("eco", "x", b"1"), ("eco", "y", b"2"), ("pra", "x", b"1")], s)
    h = {r.zone_type: (r.n, r.geom_hash) for r in zones.geometry_hashes(a, "eco_key").collect()}
    again = {r.zone_type: (r.n, r.geom_hash) for r in zones.geometry_hashes(a.orderBy(F.desc("eco_key")).repartition(3), "eco_key").collect()}
    other = {r.zone_type: r.geom_hash for r in zones.geometry_hashes(spark.createDataFrame([("eco", "x", b"2"), ("eco", "y", b"1")], s), "eco_key").collect()}
    assert h == again and h["eco"][0] == 2 and len(h["eco"][1]) == 16 and other["eco"] != h["eco"][1]
    sets = spark.createDataFrame([("eco", h["eco"][1]), ("pra", "unknown")], "zone_type string, geom_hash string")
    got = {r.zone_type: (r.vintage, r.zone_set_key) for r in zones.group_sets(sets, {h["eco"][1]: "2024-05"}).collect()}
    assert got == {"eco": ("2024-05", "eco_2024-05"), "pra": (None, None)}
    assert zones.key_column("eco", ["a", "eco_key"]) == "eco_key" and zones.key_column("pra", ["a", "b_key", "c_key"]) == "b_key"
    with pytest.raises(ValueError):
        zones.key_column("pra", ["a"])
    reg = spark.createDataFrame([("eco_2024-05", "eco", "2024-05", "h1")], "zone_set_key string, zone_type string, vintage string, geom_hash string")
    assert zones.require_sound(reg).count() == 1
    with pytest.raises(ValueError, match="key_has_geometries at eco_2024-05"):
        zones.require_sound(reg.union(reg.withColumn("geom_hash", F.lit("h2")).withColumn("zone_type", F.lit("x"))))
    v = spark.createDataFrame([("W", "B", -170.0, 10.0), ("W", "A", 170.0, 10.0), ("W", "A", 180.0, 12.0), ("E", "C", 0.0, -1.0), ("E", "C", 2.0, 1.0)], "region_key string, ecoregion_key string, lon double, lat double")
    views = {r.key: r for r in zones.area_views(v, labels={"W": "West"}).collect()}
    assert views["W"].label == "West" and views["W"].ecoregions == "A B" and abs(abs(views["W"].lon) - 180) < 1 and views["FULL"].ecoregions == "A B C" and views["FULL"].zoom == 2.16
    assert (views["E"].lon, views["E"].lat) == (pytest.approx(1, abs=0.1), pytest.approx(0, abs=0.1)) and views["E"].label == "E"


def test_registry_and_manifest(spark):
    texts = {"b/latest.txt": "v3\n", "b/versions.json": json.dumps([{"ver": "v1", "status": "retired"}, {"ver": "v3", "status": "released"}, {"ver": "v10", "status": "prerelease"}, {"ver": "v2", "status": "released", "access": "restricted"}])}
    asked, now = [], [0.0]
    reg = releases.Registry("b/", lambda p: asked.append(p) or texts[p], ttl=60, preview="p", clock=lambda: now[0])
    assert reg.resolve() == reg.resolve("latest") == "v3" and [v["ver"] for v in reg.versions()] == ["v10", "v3", "v2", "v1"]
    assert [reg.access(v) for v in ("v1", "v2", "v3", "v10")] == ["public", "restricted", "public", "restricted"] and len(asked) == 2
    now[0] = 61.0
    assert reg.latest() == "v3" and len(asked) == 3
    assert reg.resolve("v10") == "v10"
    for bad, kind in (("v9", ValueError), ("x", ValueError)):
        with pytest.raises(kind):
            reg.resolve(bad)
    with pytest.raises(releases.Restricted, match="see p"):
        reg.resolve("v2", access=("public",))
    with pytest.raises(ValueError, match="prerelease"):
        reg.resolve("v10", states=("released",))
    c = _catalog(spark, True, metric=spark.createDataFrame([(1, "a"), (2, "b")], "metric_seq int, metric_key string"), cell_metric=spark.createDataFrame([(1, 11, 1.0)], "metric_seq int, cell_id long, val double"))
    sets = spark.createDataFrame([("programarea_2024-01", "programarea", "v2 v3", False)], "zone_set_key string, zone_type string, versions string, canonical boolean")
    m = releases.build_manifest(c, "v3", "https://b", "usa05", zone_sets=sets, tiles={"programarea_2024-01": "t"}, capabilities={"extra": True})
    assert [x["metric_key"] for x in m["metrics"]] == ["a"] and m["zones"] == [{"zone_set_key": "programarea_2024-01", "tbl": "z", "fld": "programarea_key", "n": 1, "tiles": "t"}]
    assert releases.can(m, "programareas") and releases.can(m, "extra") and not releases.can(m, "zone_taxon") and not releases.can(m, "nothing") and m["access"] == "public" and "cell_metric" in m["tables"]
    texts["b/v3/manifest.json"] = json.dumps(m)
    assert reg.manifest()["ver"] == "v3"
    for bad in (m | {"ver": "v4"}, m | {"capabilities": {}}, m | {"id_field": "x"}, {k: x for k, x in m.items() if k != "tables"}):
        with pytest.raises(ValueError):
            releases.validate_manifest(bad, "v3")
    with pytest.raises(ValueError):
        releases.build_manifest(c, "v3", "b", "usa05", capabilities={"x": 1})


def test_addresses_and_tracking():
    assert releases.product_urls("v3", "a/", "d", "h", "p")["scores"] == "a/scores/?ver=v3" and releases.product_urls("v3", "a", "d", "h", "p", "restricted")["docs"] == "p/docs/v3/"
    assert releases.tile_url("t", mdl_key="ms|W:1", rescale=(0, 100)) == "t/tiles/{z}/{x}/{y}.png?mdl_key=ms%7CW%3A1&colormap=spectral_r&rescale=0,100"
    assert releases.tile_url("t", sql="SELECT  1\n", color="#ff0000") == "t/tiles/{z}/{x}/{y}.png?sql=U0VMRUNUIDE&color=ff0000"
    for bad in ({}, {"sql": "a", "mdl_key": "b"}, {"sql": "a", "color": "red"}):
        with pytest.raises(ValueError):
            releases.tile_url("t", **bad)
    said = []
    assert releases.tracked(said.append, "q", lambda: [1, 2], who="me") == [1, 2] and said[0]["n_rows"] == 2 and said[0]["status"] == "ok"
    with pytest.raises(ZeroDivisionError):
        releases.tracked(said.append, "q", lambda: 1 / 0)
    assert said[1]["status"] == "error" and releases.tracked(lambda _: 1 / 0, "q", lambda: 3) == 3
    assert dag.token_secret() == dag.token_secret() and len(dag.token_secret("NO_SUCH")) == 64


def test_small_expressions(spark):
    one = lambda *c: spark.range(1).select(*c).first()[:]
    lit = F.lit
    assert one(keys.file_size(lit(10.0)), keys.file_size(lit(2048.0)), keys.file_size(lit(3.0 * 1024**3))) == ("10 B", "2.0 KB", "3.0 GB")
    assert one(keys.escape_html(lit("<a & \"b\">"))) == ("&lt;a &amp; &quot;b&quot;&gt;",)
    assert one(keys.client_ip(lit(""), lit(" 1.1.1.1 , 2.2.2.2"), lit("3.3.3.3")), keys.client_ip(lit(None).cast("string"), lit(None).cast("string"), lit("3.3.3.3"))) == ("1.1.1.1", "3.3.3.3")
    assert one(keys.zone_set_key(lit("pra"), lit("2024-01")), keys.content_key(lit("g"), lit("h")), keys.content_url(lit("g"), lit("h"), "u/")) == ("pra_2024-01", "cog/g/h.tif", "u/cog/g/h.tif")
    a, b = one(keys.encoded_hash(lit("h"), lit("lzw")), keys.encoded_hash(lit("h"), lit("zstd")))
    assert len(a) == 16 and a != b
    assert one(keys.mtime(F.to_timestamp(lit("2024-05-06 07:08:09")))) == ("20240506T070809Z",)
    assert one(*[grid.colour_bin(lit(v), 0.0, 10.0, 6) for v in (-1.0, 0.0, 2.0, 9.9, 10.0, 99.0)]) == (1, 1, 2, 5, 5, 5)
    assert one(grid.view_zoom(lit(0.0)), grid.view_zoom(lit(1e9)), F.round(grid.view_zoom(lit(8.0)) - grid.view_zoom(lit(16.0)), 9)) == (5.0, 1.7, 1.0)
    r = validate.mass_conservation(spark.createDataFrame([(2.0,), (2.0,)], "v double"), spark.createDataFrame([(3.9,)], "v double"), "v", 0.05).first()
    assert r.ok and round(r.ratio, 3) == 0.975


def test_names_with_several_targets(spark):
    d = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (None, "d")], "itis_id int, name string")
    itis = spark.createDataFrame([(1, 10), (1, 11), (1, 11), (2, None)], "taxonID int, acceptedNameUsageID int")
    worms = spark.createDataFrame([("a", 99), ("b", 20), ("b", 21)], "scientificName string, acceptedNameUsageID int")
    rest = spark.createDataFrame([("c", 30)], "name string, worms_id int")
    got = sorted((r["name"], r.worms_id) for r in identity.match_taxa(d, itis, worms, rest).collect() if r.worms_id)
    assert got == [("a", 10), ("a", 11), ("b", 20), ("b", 21), ("c", 30)]
    s = "ds_key string, asset_type string, representation string, mdl_key string"
    old = spark.createDataFrame([("am", None, "model", "1"), ("am", None, "model", "2"), ("bl", "x", "y", "3")], s)
    assert identity.registry_merge(old, old.where("ds_key = 'am'")).count() == 3
    with pytest.raises(ValueError, match="2 to 1"):
        identity.registry_merge(old, old.where("mdl_key = '1'"))
    assert identity.registry_merge(old, old.where("mdl_key = '1'"), allow_shrink=True).count() == 1
    ids = identity.assign_mdl_id(spark.createDataFrame([("b",), ("a",), ("b",)], "mdl_key string"))
    assert sorted(map(tuple, ids.collect())) == [("a", 1), ("b", 2)]


def test_pra_scores(spark):
    z = spark.createDataFrame([(1, "programarea_key", "A", "s1"), (2, "programarea_key", "B", "s1")], "zone_seq int, fld string, val string, zone_set_key string")
    m = spark.createDataFrame([(5, "risk")], "metric_seq int, metric_key string")
    c = lambda col, *v: Catalog({"zone": z, "metric": m, "zone_metric": spark.createDataFrame([(i + 1, 5, x) for i, x in enumerate(v)], f"zone_seq int, metric_seq int, {col} double")})
    d = validate.pra_score_delta(c("val", 1.0, 2.0), c("value", 1.5, 4.0), "risk", zone_set="s1")
    assert [(r.zone_key, r.delta) for r in d.collect()] == [("B", 2.0), ("A", 0.5)]
    with pytest.raises(ValueError, match="no zone"):
        validate.pra_score_delta(c("val", 1.0, 2.0), c("val", 1.0, 2.0), "risk", zone_set="s9")
    assert validate.assert_within_tolerance(d, 2, 3) is d
