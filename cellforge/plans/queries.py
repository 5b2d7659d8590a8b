"""One query for each operator over the driver's tables, and the same in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import grid, keys
from ..operators import fingerprint, identity, merge, spatial, species, validate
from ..sources import files
from ..sources.catalog import Catalog, cell_grid
from ..sources.scratch import scratch_path
from . import releases
from .bindings import catalog, ctes, load, view

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None):
    def wrap(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return wrap


r6 = lambda c: F.round(F.col(c), 6).alias(c)

# ---- merge
_RANGE = ctes("b", "taxon") + """,
b_range AS (SELECT DISTINCT b.ms_merge_key, b.cell_id, t.er_score AS er FROM b JOIN taxon t USING (ms_merge_key) WHERE ds_key <> 'am'),
am AS (SELECT b.ms_merge_key, b.cell_id, max(b.val) AS am FROM b JOIN b_range r ON r.ms_merge_key = b.ms_merge_key AND r.cell_id = b.cell_id WHERE ds_key = 'am' GROUP BY 1, 2),
fused AS (SELECT r.ms_merge_key, r.cell_id, greatest(r.er, coalesce(am.am, 0)) AS val FROM b_range r LEFT JOIN am ON am.ms_merge_key = r.ms_merge_key AND am.cell_id = r.cell_id)
"""


def _merged(spark, d):
    b = view(spark, d, "b")
    return merge.merge(b, view(spark, d, "taxon"), None, view(spark, d, "us_cells"))


@query(_RANGE + "SELECT ms_merge_key, cell_id, er FROM b_range")
def merge_range_footprint(spark, d):
    return _merged(spark, d)["b_range"]


@query(_RANGE + "SELECT ms_merge_key, cell_id, am FROM am")
def merge_am_at_range(spark, d):
    return _merged(spark, d)["b_am_rng"]


@query(_RANGE + "SELECT ms_merge_key, cell_id, val FROM fused")
def merge_global(spark, d):
    return _merged(spark, d)["global"]


@query(_RANGE + """, us AS (SELECT DISTINCT cast(s_suppkey % 100 + 1 AS bigint) AS cell_id FROM supplier WHERE (s_suppkey % 100 + 1) % 5 = 0),
fl AS (SELECT ms_merge_key, bool_or(ds_key <> 'am') AS has_range FROM b GROUP BY 1)
SELECT ms_merge_key, cell_id, val FROM fused WHERE cell_id IN (SELECT cell_id FROM us)
UNION ALL SELECT ms_merge_key, cell_id, val FROM b WHERE ds_key = 'am' AND cell_id IN (SELECT cell_id FROM us) AND ms_merge_key IN (SELECT ms_merge_key FROM fl WHERE NOT has_range)""")
def merge_us(spark, d):
    return _merged(spark, d)["us"]


@query(ctes("b") + """, w AS (SELECT ms_merge_key, cell_id, max(val) FILTER (WHERE ds_key = 'rng') AS er, max(val) FILTER (WHERE ds_key = 'am') AS suit, max(val) FILTER (WHERE ds_key = 'ch') AS ch FROM b GROUP BY 1, 2)
SELECT ms_merge_key, cell_id, greatest(greatest(1, round(er * coalesce(suit, 1) / 100)), coalesce(ch, 0)) AS val FROM w WHERE er IS NOT NULL""")
def turtle_merge(spark, d):
    return merge.turtle(view(spark, d, "b"), "rng", "am", ["ch"])


# ---- species
_SPECIES = ctes("b", "taxon", "cell", "zone", "zone_cell") + """,
mc AS (SELECT ms_merge_key AS mdl_key, cell_id, max(val) AS val FROM b GROUP BY 1, 2),
z AS (SELECT fld AS zone_fld, val AS zone_value, cell_id, pct_covered FROM zone JOIN zone_cell USING (zone_seq)),
agg AS (SELECT z.zone_fld, z.zone_value, t.sp_cat, t.common_name AS sp_common, t.scientific_name AS sp_scientific, t.taxon_id, t.taxon_authority, t.extrisk_code AS er_code, t.er_score / 100.0 AS er_score, t.is_mmpa, t.is_mbta, mc.mdl_key,
  sum(c.area_km2 * z.pct_covered / 100.0) AS area_km2, sum(mc.val * z.pct_covered) / sum(z.pct_covered) / 100.0 AS avg_suit
  FROM mc JOIN z USING (cell_id) JOIN cell c USING (cell_id) JOIN taxon t ON t.ms_merge_key = mc.mdl_key
  WHERE t.is_valid_usa AND t.is_marine AND t.sp_cat NOT IN ('reptile', 'amphibian') {where} GROUP BY ALL),
s AS (SELECT *, avg_suit * er_score AS suit_er, avg_suit * er_score * area_km2 AS suit_er_area FROM agg),
k AS (SELECT *, sum(suit_er_area) OVER (PARTITION BY zone_fld, zone_value, sp_cat) AS cat_suit_er_area FROM s)
"""
_OUT = "sp_cat, sp_common, sp_scientific, taxon_id, taxon_authority, er_code, er_score, is_mmpa, is_mbta, mdl_key, round(area_km2 + 1e-9::DOUBLE, 6) AS area_km2, round(avg_suit + 1e-9::DOUBLE, 6) AS avg_suit, round(suit_er + 1e-9::DOUBLE, 6) AS suit_er, round(suit_er_area + 1e-9::DOUBLE, 6) AS suit_er_area, round(cat_suit_er_area + 1e-9::DOUBLE, 4) AS cat_suit_er_area, round(suit_er_area / nullif(cat_suit_er_area, 0) + 1e-9::DOUBLE, 6) AS pct_cat"


def _rounded(df: DataFrame, *by: str) -> DataFrame:
    digits = {"cat_suit_er_area": 4} | dict.fromkeys(("area_km2", "avg_suit", "suit_er", "suit_er_area", "pct_cat"), 6)
    return df.select(*by, *[F.round(F.col(c) + 1e-9, digits[c]).alias(c) if c in digits else F.col(c) for c in species.COLUMNS])


@query(_SPECIES.replace("{where}", "AND z.zone_value = 'NATION_3'") + f"SELECT {_OUT} FROM k")
def species_for_zone(spark, d):
    return _rounded(species.for_zone(catalog(spark, d), "programarea_key", "NATION_3"))


@query(_SPECIES.replace("{where}", "") + f"SELECT zone_fld, zone_value, {_OUT} FROM k")
def zone_taxon_all(spark, d):
    return _rounded(species.build_zone_taxon(catalog(spark, d)), "zone_fld", "zone_value")


_CELLS = "SELECT 'c' AS zone_fld, 'c' AS zone_value, cast(x AS bigint) AS cell_id, cast(x AS double) * 4 AS pct_covered FROM (VALUES (3), (7), (12), (20)) v(x)"


@query(_SPECIES.replace("SELECT fld AS zone_fld, val AS zone_value, cell_id, pct_covered FROM zone JOIN zone_cell USING (zone_seq)", _CELLS).replace("{where}", "") + f"SELECT {_OUT} FROM k")
def species_for_cells(spark, d):
    cells = spark.createDataFrame([(x, x * 4.0) for x in (3, 7, 12, 20)], "cell_id long, pct_covered double")
    return _rounded(species.for_cells(catalog(spark, d), cells))


@query("SELECT p_type AS sp_cat, p_partkey AS taxon_id, round(p_retailprice / nullif(sum(p_retailprice) OVER (PARTITION BY p_type), 0), 9) AS pct_cat FROM part")
def species_shares(spark, d):
    p = load(spark, d, "part").select(F.col("p_type").alias("sp_cat"), F.col("p_partkey").alias("taxon_id"), F.col("p_retailprice").alias("area_km2"), F.lit(1.0).alias("avg_suit"), F.lit(1.0).alias("er_score"))
    for c in set(species.GROUP) - set(p.columns):
        p = p.withColumn(c, F.lit(None).cast("string"))
    return species.shares(p).select("sp_cat", "taxon_id", F.round("pct_cat", 9).alias("pct_cat"))


_V = "SELECT {v} AS vintage, p_partkey AS taxon_id, p_size / 100.0::DOUBLE AS er_score, {m} AS is_mmpa, {k} AS mdl_key, round(0.5 * p_size / 100.0::DOUBLE * p_retailprice, 6) AS suit_er_area FROM part"


@query(" UNION ALL ".join(_V.format(v=v, m="cast(NULL AS BOOLEAN)" if v == 1 else "p_partkey % 3 = 0", k="'k' || p_partkey" if v == 8 else "cast(p_partkey AS VARCHAR)") for v in (1, 3, 8)))
def zone_taxon_vintages(spark, d):
    p, out = load(spark, d, "part"), None
    common = [F.col("p_type").alias("sp_cat"), F.col("p_brand").alias("sp_common"), F.col("p_name").alias("sp_scientific"), F.col("p_partkey").alias("taxon_id"), F.lit("WORMS").alias("taxon_authority"), F.col("p_retailprice").alias("area_km2"), F.lit(0.5).alias("avg_suit")]
    part, mmpa = F.col("p_size").cast("double") / 100, [(F.col("p_partkey") % 3 == 0).alias("is_mmpa"), F.lit(False).alias("is_mbta")]
    own = {
        1: [F.col("p_partkey").alias("mdl_seq"), F.lit("EN").alias("rl_code"), part.alias("rl_score")],
        3: [F.col("p_partkey").alias("mdl_seq"), F.lit("EN").alias("rl_code"), (part * 100).alias("er_score"), *mmpa],
        8: [F.concat(F.lit("k"), F.col("p_partkey").cast("string")).alias("mdl_key"), F.lit("EN").alias("er_code"), part.alias("er_score"), *mmpa],
    }
    for v, columns in own.items():
        x = species.normalise_vintage(p.select(*common, *columns)).select(F.lit(v).alias("vintage"), "taxon_id", "er_score", "is_mmpa", "mdl_key", r6("suit_er_area"))
        out = x if out is None else out.unionByName(x)
    return out


# ---- scores
_LABEL = "replace(regexp_replace(regexp_replace(metric_key, 'extrisk_', ''), '_ecoregion_rescaled', ''), '_', ' ')"
_SCORES = ctes("metric", "cell_metric", "zone", "zone_cell", "zone_metric")


@query(_SCORES + f""", s AS (SELECT metric_key, sum(value * pct_covered) / sum(pct_covered) AS score FROM metric JOIN cell_metric USING (metric_seq) JOIN (SELECT cell_id, pct_covered FROM zone JOIN zone_cell USING (zone_seq) WHERE val = 'NATION_3') c USING (cell_id) GROUP BY 1)
SELECT {_LABEL} AS component, round(score, 6) AS score, 1 AS even FROM s""")
def scores_for_cells(spark, d):
    cat = catalog(spark, d)
    return species.scores_for_cells(cat, species.zone_cells(cat, "programarea_key", "NATION_3")).select("component", r6("score"), "even")


@query(_SCORES + f"SELECT {_LABEL} AS component, zm.value AS score, 1 AS even FROM zone JOIN zone_metric zm USING (zone_seq) JOIN metric USING (metric_seq) WHERE val = 'NATION_3'")
def scores_for_pra(spark, d):
    return species.scores_for_zone(catalog(spark, d), "NATION_3")


@query(_SCORES + "SELECT round(avg(zm.value), 6) AS mean_score FROM zone JOIN zone_metric zm USING (zone_seq) WHERE val = 'NATION_3'")
def mean_score(spark, d):
    return species.mean_score(species.scores_for_zone(catalog(spark, d), "NATION_3")).select(r6("mean_score"))


@query(_SCORES + "SELECT cell_id, 100 AS pct_covered FROM zone JOIN zone_cell USING (zone_seq) WHERE val = 'NATION_3'")
def cells_in_pra(spark, d):
    return species.cells_in_zone(catalog(spark, d), "NATION_3")


@query("SELECT n_name AS component, sum(n_nationkey + 1.0) OVER w AS ymax, cast(sum(n_nationkey + 1.0) OVER w - (n_nationkey + 1.0) AS DOUBLE) AS ymin, cast(n_regionkey AS DOUBLE) AS xmax FROM (SELECT n_name, n_nationkey::DOUBLE AS n_nationkey, n_regionkey FROM nation) WINDOW w AS (ORDER BY n_name)")
def flower_petals(spark, d):
    n = load(spark, d, "nation").select(F.col("n_name").alias("component"), (F.col("n_nationkey") + 1).alias("even"), F.col("n_regionkey").alias("score"))
    return species.petals(n, "component", "score", "even").select("component", "ymax", "ymin", "xmax")


@query(ctes("taxon") + "SELECT taxon_id, mdl_key, er_score FROM (SELECT taxon_id, ms_merge_key AS mdl_key, er_score FROM taxon) ORDER BY er_score DESC, mdl_key LIMIT 10")
def topk_species(spark, d):
    return species.top(view(spark, d, "taxon").withColumnRenamed("ms_merge_key", "mdl_key"), 10, "er_score").select("taxon_id", "mdl_key", "er_score")


# ---- identity
@query(ctes("taxon") + """SELECT taxon_id, CASE WHEN extrisk_code IS NULL THEN 1 WHEN split_part(extrisk_code, ':', 1) IN ('NMFS', 'FWS')
 THEN greatest(CASE split_part(extrisk_code, ':', 2) WHEN 'EN' THEN 100 WHEN 'TN' THEN 50 ELSE 1 END, CASE WHEN is_mmpa THEN 20 ELSE 0 END, CASE WHEN is_mbta THEN 10 ELSE 0 END)
 ELSE CASE split_part(extrisk_code, ':', 2) WHEN 'CR' THEN 50 WHEN 'EN' THEN 25 WHEN 'VU' THEN 5 WHEN 'NT' THEN 2 ELSE 1 END END AS er FROM taxon""")
def er_score(spark, d):
    return view(spark, d, "taxon").select("taxon_id", keys.er_score(F.col("extrisk_code"), F.col("is_mmpa"), F.col("is_mbta")).alias("er"))


_STATUS = "CASE p_partkey % 5 WHEN 0 THEN 'ESA Endangered; MMPA' WHEN 1 THEN 'ESA Endangered - Foreign' WHEN 2 THEN 'ESA Threatened' WHEN 3 THEN 'MMPA Depleted' ELSE NULL END"


@query(f"SELECT taxon_id, CASE WHEN s LIKE '%ESA Endangered%' AND s NOT LIKE '%ESA Endangered - Foreign%' THEN 'EN' WHEN s LIKE '%ESA Threatened%' THEN 'TN' ELSE 'LC' END AS code, coalesce(s LIKE '%MMPA%', false) AS is_mmpa FROM (SELECT p_partkey AS taxon_id, {_STATUS} AS s FROM part)")
def noaa_status(spark, d):
    s = load(spark, d, "part").selectExpr("p_partkey AS taxon_id", f"{_STATUS} AS s")
    return s.select("taxon_id", keys.noaa_code(F.col("s")).alias("code"), keys.noaa_mmpa(F.col("s")).alias("is_mmpa"))


_KEY = "CASE p_partkey % 3 WHEN 0 THEN 'ms_merge|WORMS:' || cast(p_partkey AS {s}) || CASE WHEN p_partkey % 2 = 0 THEN ':x' ELSE '' END WHEN 1 THEN 'am|' || p_name || '|annual' ELSE 'rng|' || p_name END"


@query("SELECT k, split_part(k, '|', 1) AS ds_key, nullif(split_part(k, '|', 2), '') AS sp_id, nullif(split_part(k, '|', 3), '') AS interval_key, CASE WHEN k LIKE 'ms_merge|%' THEN split_part(split_part(k, '|', 2), ':', 1) END AS authority, CASE WHEN k LIKE 'ms_merge|%' THEN substr(split_part(k, '|', 2), strpos(split_part(k, '|', 2), ':') + 1) END AS taxon_id FROM (SELECT " + _KEY.format(s="VARCHAR") + " AS k FROM part)")
def mdl_key_parse(spark, d):
    k = load(spark, d, "part").selectExpr(_KEY.format(s="STRING") + " AS k")
    p = keys.parse_key(F.col("k"))
    return k.select("k", *[c.alias({"interval": "interval_key"}.get(n, n)) for n, c in p.items()])


@query("SELECT p_partkey, 'am' AS ds, 'bl|' || p_name || '|annual' AS raw_key, 'ms_merge|WORMS:' || cast(p_partkey AS VARCHAR) AS merged_key FROM part")
def mdl_key_build(spark, d):
    p = load(spark, d, "part")
    return p.select("p_partkey", keys.normalize_ds_key(F.lit("am_0.05")).alias("ds"), keys.raw_key(F.lit("bl"), F.col("p_name"), F.lit("annual")).alias("raw_key"), keys.merged_key(F.lit("worms"), F.col("p_partkey")).alias("merged_key"))


@query("""WITH pub AS (SELECT 'NATION_' || r_regionkey * 3 AS mdl_key, cast(r_regionkey * 2 + 1 AS bigint) AS mdl_id FROM region), new AS (SELECT n_name AS mdl_key FROM nation n WHERE NOT EXISTS (SELECT 1 FROM pub WHERE pub.mdl_key = n.n_name))
SELECT mdl_key, mdl_id FROM pub UNION ALL SELECT mdl_key, (SELECT max(mdl_id) FROM pub) + row_number() OVER (ORDER BY mdl_key) FROM new""")
def assign_mdl_id(spark, d):
    published = load(spark, d, "region").selectExpr("'NATION_' || cast(r_regionkey * 3 AS string) AS mdl_key", "cast(r_regionkey * 2 + 1 AS bigint) AS mdl_id")
    return identity.assign_mdl_id(load(spark, d, "nation").select(F.col("n_name").alias("mdl_key")), published)


@query("SELECT p_partkey AS taxon_id, 'Genus ' || replace(p_name, ' ', '') || ' minor' AS name, 'Genus ' || replace(p_name, ' ', '') AS binomial FROM part")
def clean_sci_name(spark, d):
    x = F.concat(F.lit("  Genus  "), F.regexp_replace("p_name", " ", ""), F.lit(" (=other)  ssp. minor "))
    return load(spark, d, "part").select(F.col("p_partkey").alias("taxon_id"), keys.clean_name(x).alias("name"), keys.clean_name(x, True).alias("binomial"))


@query("""WITH d AS (SELECT c_custkey AS itis_id, 'NATION_' || (c_custkey % 40) AS name FROM customer), i AS (SELECT DISTINCT o_custkey AS itis_id, cast(o_orderkey % 3 AS bigint) AS a FROM orders WHERE o_custkey % 2 = 0), w AS (SELECT n_name AS name, cast(n_nationkey + 7 AS bigint) AS b FROM nation)
SELECT d.itis_id, d.name, coalesce(i.a, w.b) AS worms_id FROM d LEFT JOIN i USING (itis_id) LEFT JOIN w USING (name)""")
def match_taxa_cascade(spark, d):
    t = load(spark, d, "customer").selectExpr("c_custkey AS itis_id", "'NATION_' || cast(c_custkey % 40 AS string) AS name")
    i = load(spark, d, "orders").selectExpr("CASE WHEN o_custkey % 2 = 0 THEN o_custkey END AS taxonID", "cast(o_orderkey % 3 AS bigint) AS acceptedNameUsageID")
    w = load(spark, d, "nation").selectExpr("n_name AS scientificName", "cast(n_nationkey + 7 AS bigint) AS acceptedNameUsageID")
    return identity.match_taxa(t, i, w).select("itis_id", "name", "worms_id")


@query("SELECT DISTINCT 'NATION_' || (c_custkey % 40) AS ds_key, (c_custkey % 40) < 25 AS is_scored FROM customer")
def dataset_is_scored(spark, d):
    ds = load(spark, d, "customer").selectExpr("'NATION_' || cast(c_custkey % 40 AS string) AS ds_key").distinct()
    return identity.dataset_is_scored(ds, load(spark, d, "nation").select(F.col("n_name").alias("ds_key")))


@query("""WITH w AS (SELECT p_partkey AS taxon_id, CASE WHEN p_partkey % 2 = 0 THEN p_partkey * 10 END AS am, CASE WHEN p_partkey % 3 = 0 THEN p_partkey * 10 + 1 END AS bl, p_partkey AS mdl_seq FROM part)
SELECT taxon_id, 'am' AS ds_key, am AS mdl_seq FROM w WHERE am IS NOT NULL UNION ALL SELECT taxon_id, 'bl', bl FROM w WHERE bl IS NOT NULL UNION ALL SELECT taxon_id, 'ms_merge', mdl_seq FROM w""")
def taxon_unpivot(spark, d):
    w = load(spark, d, "part").selectExpr("p_partkey AS taxon_id", "CASE WHEN p_partkey % 2 = 0 THEN p_partkey * 10 END AS am", "CASE WHEN p_partkey % 3 = 0 THEN p_partkey * 10 + 1 END AS bl", "p_partkey AS mdl_seq")
    return identity.taxon_unpivot(w, ["am", "bl"])


_REG = "WITH o AS (SELECT 'c' || (c_custkey % 7) AS ds_key, 'cog' AS asset_type, 'model' AS representation, c_name AS mdl_key FROM customer), n AS (SELECT 'c' || (c_custkey % 4) AS ds_key, 'cog' AS asset_type, 'model' AS representation, c_name || '_v2' AS mdl_key FROM customer)"


@query(_REG + " SELECT * FROM n UNION ALL SELECT * FROM o WHERE (ds_key, asset_type, representation) NOT IN (SELECT ds_key, asset_type, representation FROM n)")
def registry_merge(spark, d):
    c = load(spark, d, "customer")
    o = c.selectExpr("'c' || cast(c_custkey % 7 AS string) AS ds_key", "'cog' AS asset_type", "'model' AS representation", "c_name AS mdl_key")
    n = c.selectExpr("'c' || cast(c_custkey % 4 AS string) AS ds_key", "'cog' AS asset_type", "'model' AS representation", "c_name || '_v2' AS mdl_key")
    return identity.registry_merge(o, n)


@query("""WITH r AS (SELECT 'pra_' || n_nationkey AS zone_set_key, 'pra' || n_regionkey AS zone_type, 'v' || n_nationkey || ' v1' || n_nationkey AS versions, n_nationkey < 5 AS canonical FROM nation), w AS (SELECT DISTINCT 'pra' || n_regionkey AS zone_type, v.version FROM nation, (VALUES ('v1'), ('v12'), ('v99')) v(version)),
j AS (SELECT w.zone_type, w.version, count(*) FILTER (WHERE list_contains(string_split(versions, ' '), w.version)) AS n, max(zone_set_key) FILTER (WHERE list_contains(string_split(versions, ' '), w.version)) AS k, count(*) FILTER (WHERE canonical) AS m, max(zone_set_key) FILTER (WHERE canonical) AS c FROM w LEFT JOIN r USING (zone_type) GROUP BY 1, 2)
SELECT zone_type, version, CASE WHEN n = 1 THEN k WHEN m = 1 THEN c END AS zone_set_key FROM j""")
def zone_set_resolve(spark, d):
    n = load(spark, d, "nation")
    k, s = F.col("n_nationkey").cast("string"), F.lit
    r = n.select(F.concat(s("pra_"), k).alias("zone_set_key"), F.concat(s("pra"), F.col("n_regionkey").cast("string")).alias("zone_type"), F.concat(s("v"), k, s(" v1"), k).alias("versions"), (F.col("n_nationkey") < 5).alias("canonical"))
    w = n.select(F.concat(s("pra"), F.col("n_regionkey").cast("string")).alias("zone_type"), F.explode(F.array(*map(s, ("v1", "v12", "v99")))).alias("version")).distinct()
    return identity.zone_set_resolve(r, w)


@query("""WITH z AS (SELECT c_mktsegment AS tbl, CASE WHEN c_nationkey < 20 THEN 'set' || c_nationkey % 4 END AS zone_set_key, count(*) AS n FROM customer GROUP BY 1, 2)
SELECT tbl, zone_set_key, n FROM (SELECT *, row_number() OVER (PARTITION BY zone_set_key ORDER BY n DESC, tbl) AS r FROM z) WHERE zone_set_key IS NULL OR r = 1""")
def zone_collapse(spark, d):
    z = load(spark, d, "customer").select(F.col("c_mktsegment").alias("tbl"), F.expr("CASE WHEN c_nationkey < 20 THEN 'set' || cast(c_nationkey % 4 AS string) END").alias("zone_set_key"))
    return identity.zone_collapse(z.groupBy("tbl", "zone_set_key").agg(F.count("*").alias("n")))


# ---- grid
_CELL = "o_orderkey * 97 % 6224618 + 1"
_G = grid.GRIDS["usa05"]


@query(f"WITH c AS (SELECT o_orderkey, {_CELL} AS id FROM orders), x AS (SELECT *, 141.1::DOUBLE + ((id - 1) % 3103 + 0.5::DOUBLE) * 0.05::DOUBLE AS l FROM c) SELECT o_orderkey, round(CASE WHEN l >= 180 THEN l - 360 ELSE l END, 6) AS lon, round(82.6::DOUBLE - ((id - 1) // 3103 + 0.5::DOUBLE) * 0.05::DOUBLE, 6) AS lat FROM x")
def cell_lonlat(spark, d):
    c = load(spark, d, "orders").selectExpr("o_orderkey", f"{_CELL} AS id")
    return c.select("o_orderkey", F.round(grid.cell_lon(F.col("id"), _G), 6).alias("lon"), F.round(grid.cell_lat(F.col("id"), _G), 6).alias("lat"))


@query(f"SELECT o_orderkey, {_CELL} AS cell_id FROM orders")
def cell_from_lonlat(spark, d):
    c = load(spark, d, "orders").selectExpr("o_orderkey", f"{_CELL} AS id")
    return c.select("o_orderkey", grid.cell_from_lonlat(grid.cell_lon(F.col("id"), _G), grid.cell_lat(F.col("id"), _G), _G).alias("cell_id"))


@query(f"SELECT o_orderkey, cast((({_CELL}) - 1) // 7200 // 50 * 144 + (({_CELL}) - 1) % 7200 // 50 AS bigint) AS tile FROM orders")
def tile_ids(spark, d):
    return load(spark, d, "orders").select("o_orderkey", grid.tile(F.expr(_CELL), 7200).alias("tile"))


_TILED = "l_suppkey * 3 + 1"


@query(f"SELECT cast((cell_id - 1) // 7200 // 50 * 144 + (cell_id - 1) % 7200 // 50 AS bigint) AS tile, cell_id, max(val) AS val FROM (SELECT cast({_TILED} AS bigint) AS cell_id, l_quantity * 2 AS val FROM lineitem) WHERE cell_id IN (3 * 3 + 1, 57 * 3 + 1) GROUP BY 1, 2")
def tile_prune_scan(spark, d):
    """Writes the cells by tile, then reads two of them through the tiles they lie in."""
    b = load(spark, d, "lineitem").selectExpr(f"cast({_TILED} AS bigint) AS cell_id", "cast(l_quantity * 2 AS double) AS val").groupBy("cell_id").agg(F.max("val").alias("val"))
    b = b.withColumn("mdl_key", F.lit("m")).withColumn("tile", grid.tile(F.col("cell_id"), 7200))
    path = scratch_path(spark, "tiles")
    files.write_parquet(b, path, partition_by=["tile"])
    cat = Catalog({"cell_model": spark.read.parquet(path), "cell_grid": cell_grid(spark, "global05")})
    wanted = [3 * 3 + 1, 57 * 3 + 1]
    src, _, val = species._source(cat, grid.tiles_of(wanted, cat.tile_width()))
    return src.where(F.col("cell_id").isin(wanted)).select(F.col("tile").cast("long").alias("tile"), "cell_id", F.col(val).alias("val"))


_LON = "cast(c_custkey * 53 % 360 AS double) - 180"
_EXT = "WITH p AS (SELECT c_nationkey AS zone, {lon} AS lon FROM customer WHERE c_nationkey < 12 OR abs(cast(c_custkey * 53 % 360 AS double) - 180) > 150), e AS (SELECT zone, min(lon) AS a, max(lon) AS b, min(CASE WHEN lon < 0 THEN lon + 360 ELSE lon END) AS c, max(CASE WHEN lon < 0 THEN lon + 360 ELSE lon END) AS d FROM p GROUP BY 1)".replace("{lon}", _LON)


@query(_EXT + " SELECT zone, CASE WHEN d - c < b - a AND d - c < 350 THEN c ELSE a END AS xmin, CASE WHEN d - c < b - a AND d - c < 350 THEN d ELSE b END AS xmax, (CASE WHEN d - c < b - a AND d - c < 350 THEN d - c ELSE b - a END) >= 350 AS globe FROM e")
def lon_span(spark, d):
    p = load(spark, d, "customer").selectExpr("c_nationkey AS zone", f"{_LON} AS lon").selectExpr("zone", "CASE WHEN zone < 12 OR abs(lon) > 150 THEN lon END AS lon")
    lo, hi = grid.lon_span()
    out = p.groupBy("zone").agg(*grid.lon_span_aggs(F.col("lon"))).select("zone", lo.alias("xmin"), hi.alias("xmax")).where("xmin IS NOT NULL")
    return out.withColumn("globe", grid.spans_globe(F.col("xmin"), F.col("xmax")))


_LL = "cast(c_custkey * 53 % 360 AS double) - 179.75 AS lon, cast(c_custkey * 31 % 178 AS double) - 88.75 AS lat"


@query(f"SELECT c_custkey, cast(floor((90 - lat) / 0.5) * 720 + least(719, floor((lon + 180) / 0.5)) + 1 AS bigint) AS i FROM (SELECT c_custkey, {_LL} FROM customer)")
def cell_i_grid(spark, d):
    return load(spark, d, "customer").selectExpr("c_custkey", *_LL.replace(", cast", "|cast").split("|")).select("c_custkey", grid.cell_i_grid(F.col("lon"), F.col("lat"), 0.5).alias("i"))


@query("SELECT o_orderkey, CASE WHEN a <= 1e4 THEN 'very_rare' WHEN a <= 1e5 THEN 'rare' WHEN a <= 1e6 THEN 'common' ELSE 'very_common' END AS rarity FROM (SELECT o_orderkey, o_totalprice * o_totalprice / 1e4 AS a FROM orders)")
def rarity_class(spark, d):
    return load(spark, d, "orders").select("o_orderkey", grid.rarity_class(F.col("o_totalprice") * F.col("o_totalprice") / 1e4).alias("rarity"))


@query(f"WITH p AS (SELECT c_nationkey AS zone, radians({_LON}) AS r, radians(cast(c_custkey * 31 % 178 AS double) - 88.75) AS q FROM customer), s AS (SELECT zone, sum(cos(q) * cos(r)) AS x, sum(cos(q) * sin(r)) AS y, sum(sin(q)) AS z FROM p GROUP BY 1) SELECT zone, round(degrees(atan2(y, x)), 4) AS lon, round(degrees(atan2(z, sqrt(x * x + y * y))), 4) AS lat FROM s")
def sphere_centroid(spark, d):
    p = load(spark, d, "customer").selectExpr("c_nationkey AS zone", f"{_LON} AS lon", "cast(c_custkey * 31 % 178 AS double) - 88.75 AS lat")
    lon, lat = grid.sphere_centroid()
    return p.groupBy("zone").agg(*grid.sphere_sums(F.col("lon"), F.col("lat"), F.lit(1.0))).select("zone", F.round(lon, 4).alias("lon"), F.round(lat, 4).alias("lat"))


@query(f"WITH p AS (SELECT c_custkey, {_LL} FROM customer) SELECT c_custkey, round(degrees(acos(least(1, greatest(-1, cos(radians(10)) * cos(radians(lat)) * cos(radians(lon - 20)) + sin(radians(10)) * sin(radians(lat)))))), 4) AS deg FROM p")
def angular_distance(spark, d):
    p = load(spark, d, "customer").selectExpr("c_custkey", *_LL.replace(", cast", "|cast").split("|"))
    return p.select("c_custkey", F.round(grid.angular_distance(F.lit(20.0), F.lit(10.0), F.col("lon"), F.col("lat")), 4).alias("deg"))


# ---- validation
_AB = "WITH a AS (SELECT o_custkey AS k, max(o_totalprice) AS s FROM orders GROUP BY 1), b AS (SELECT c_custkey AS k, c_acctbal AS s FROM customer), j AS (SELECT k, a.s AS score_a, b.s AS score_b, b.s - a.s AS delta FROM a JOIN b USING (k))"


def _delta(spark, d):
    a = load(spark, d, "orders").groupBy(F.col("o_custkey").alias("k")).agg(F.max("o_totalprice").alias("score"))
    b = load(spark, d, "customer").selectExpr("c_custkey AS k", "c_acctbal AS score")
    return validate.score_delta(a, b, "k")


@query(_AB + " SELECT k, score_a, score_b, round(delta, 6) AS delta FROM j")
def score_delta(spark, d):
    return _delta(spark, d).select("k", "score_a", "score_b", r6("delta"))


@query(_AB + " SELECT count(*) AS n, round(avg(abs(delta)), 4) AS mean_abs, round(max(abs(delta)), 4) AS max_abs, round(sqrt(avg(delta * delta)), 4) AS rmse FROM j")
def score_delta_summary(spark, d):
    return validate.score_delta_summary(_delta(spark, d)).select("n", *[F.round(c, 4).alias(c) for c in ("mean_abs", "max_abs", "rmse")])


_ZAB = ctes("zone", "metric", "zone_metric", "zone_metric2") + ", a AS (SELECT val AS zone_key, metric_key, value AS s FROM zone JOIN zone_metric USING (zone_seq) JOIN metric USING (metric_seq)), b AS (SELECT val AS zone_key, metric_key, value AS s FROM zone JOIN zone_metric2 USING (zone_seq) JOIN metric USING (metric_seq))"


def _zones(spark, d):
    from ..sources.catalog import Catalog

    c = catalog(spark, d)
    return validate.zone_metric_scores(c), validate.zone_metric_scores(Catalog(c.tables | {"zone_metric": view(spark, d, "zone_metric2")}))


@query(_ZAB + ", j AS (SELECT metric_key, a.s AS x, b.s AS y, b.s - a.s AS d FROM a JOIN b USING (zone_key, metric_key)) SELECT metric_key, count(*) AS n_zones, round(avg(x), 4) AS mean_a, round(avg(y), 4) AS mean_b, round(avg(d), 4) AS mean_delta, round(avg(abs(d)), 4) AS mean_abs_delta, max(abs(d)) AS max_abs_delta, round(covar_samp(x, y) / nullif(stddev_samp(x) * stddev_samp(y), 0), 4) AS cor FROM j GROUP BY 1")
def zone_score_delta(spark, d):
    return validate.zone_score_delta(*_zones(spark, d)).select("metric_key", "n_zones", *[F.round(c, 4).alias(c) for c in ("mean_a", "mean_b", "mean_delta", "mean_abs_delta")], "max_abs_delta", F.round("cor", 4).alias("cor"))


@query(_ZAB + " SELECT 'a' AS side, 'zone_key' AS kind, zone_key AS key FROM (SELECT DISTINCT zone_key FROM a EXCEPT SELECT zone_key FROM b) UNION ALL SELECT 'b', 'zone_key', zone_key FROM (SELECT DISTINCT zone_key FROM b EXCEPT SELECT zone_key FROM a)")
def zone_set_diff(spark, d):
    return validate.set_differences(*_zones(spark, d))


@query(ctes("cell") + " SELECT round_even(sum(CASE WHEN cell_id % 3 = 0 THEN area_km2 ELSE 0 END) * 100 / sum(area_km2), 1) AS pct_marine FROM cell")
def pct_marine(spark, d):
    c = view(spark, d, "cell")
    return validate.pct_marine(c, c.where("cell_id % 3 = 0"), "area_km2")


@query(ctes("zone") + " SELECT cast(NULL AS VARCHAR) AS zone_set_key, tbl, fld, count(*) AS n FROM zone GROUP BY 2, 3")
def zone_units(spark, d):
    return releases.zone_units(catalog(spark, d))


@query(ctes("metric", "cell_metric") + " SELECT metric_seq, metric_key FROM metric WHERE metric_seq IN (SELECT metric_seq FROM cell_metric)")
def cell_metrics(spark, d):
    return releases.cell_metrics(catalog(spark, d))


@query(ctes("b") + " SELECT count(*) AS n_rows, count(DISTINCT ms_merge_key) AS n_models, min(val) AS val_min, max(val) AS val_max FROM b")
def report_summary(spark, d):
    return fingerprint.summary(view(spark, d, "b").withColumnRenamed("ms_merge_key", "mdl_key"))


# ---- content addressing
@query("WITH s AS (SELECT o_custkey % 50 AS mdl, o_orderkey % 7 AS cell_id, o_orderkey % 3 AS val FROM orders), g AS (SELECT mdl, string_agg(cell_id || ':' || val, ',' ORDER BY cell_id, val) AS c, count(*) AS n FROM s GROUP BY 1) SELECT n, count(*) AS models FROM g GROUP BY c, n")
def fingerprint_groups(spark, d):
    s = load(spark, d, "orders").selectExpr("o_custkey % 50 AS mdl", "o_orderkey % 7 AS cell_id", "o_orderkey % 3 AS val")
    return fingerprint.content_hashes(s, ["mdl"], ["cell_id", "val"]).groupBy("content_hash", "n").agg(F.count("*").alias("models")).select("n", "models")


_ROW = """'{"c_nationkey":' || c_nationkey || ',"c_mktsegment":"' || c_mktsegment || '"}'"""
_LANE = "bit_xor(('0x' || substr(m, {a}, 8))::BIGINT) AS lane{k}"


@query(f"WITH g AS (SELECT {_ROW} AS r, count(*) AS n FROM customer GROUP BY 1), h AS (SELECT n, md5(r || chr(31) || n) AS m FROM g) SELECT cast(sum(n) AS BIGINT) AS n_rows, count(*) AS n_groups, {', '.join(_LANE.format(a=8 * k + 1, k=k) for k in range(4))} FROM h")
def parquet_digest(spark, d):
    return fingerprint.digest_lanes(load(spark, d, "customer").select("c_nationkey", "c_mktsegment"))


@query("WITH a AS (SELECT c_custkey * 2 AS name, c_custkey % 2 AS x FROM customer), b AS (SELECT p_partkey AS name, CASE WHEN p_size < 10 THEN -1 ELSE p_partkey % 4 // 2 END AS x FROM part) SELECT name, CASE WHEN b.x IS NULL THEN 'missing' WHEN a.x IS NULL THEN 'extra' WHEN a.x = b.x THEN 'same' ELSE 'changed' END AS status FROM a FULL JOIN b USING (name)")
def sync_plan(spark, d):
    a = load(spark, d, "customer").selectExpr("c_custkey * 2 AS name", "c_custkey % 2 AS digest")
    b = load(spark, d, "part").selectExpr("p_partkey AS name", "CASE WHEN p_size < 10 THEN -1 ELSE p_partkey % 4 div 2 END AS digest")
    return fingerprint.sync_plan(a, b).select("name", "status")


@query("WITH o AS (SELECT 'v' || (p_partkey % 3) || '/' || p_type || '/' || p_partkey || '.tif' AS key, cast(p_size AS bigint) AS size FROM part), e AS (SELECT '' AS dir, size FROM o UNION ALL SELECT split_part(key, '/', 1), size FROM o UNION ALL SELECT split_part(key, '/', 1) || '/' || split_part(key, '/', 2), size FROM o) SELECT dir, count(*) AS n_files, cast(sum(size) AS BIGINT) AS bytes FROM e GROUP BY 1")
def storage_rollup(spark, d):
    o = load(spark, d, "part").selectExpr("'2024-01-01 00:00:00 ' || cast(p_size AS string) || ' v' || cast(p_partkey % 3 AS string) || '/' || p_type || '/' || cast(p_partkey AS string) || '.tif' AS line")
    return files.storage_rollup(files.listing(o))


@query("SELECT event_id, 'e_' || (event_id % 10) || '_' || event_type || '_x' AS name, rtrim(translate(base64(encode(event_type)), '+/', '-_'), '=') AS b64, strftime(ts, '%Y-%m-%dT00:00:00Z') AS day, regexp_replace(event_type, '[^A-Za-z0-9]+', '_', 'g') AS slug FROM events")
def event_names(spark, d):
    e = load(spark, d, "events")
    raw = F.concat((F.col("event_id") % 10).cast("string"), F.lit("--"), F.upper("event_type"), F.lit(" X!"))
    return e.select("event_id", keys.event_name(raw).alias("name"), keys.base64url(F.col("event_type")).alias("b64"), keys.iso_day(F.col("ts")).alias("day"), keys.slug(F.concat(F.lit("-"), F.col("event_type"), F.lit("!"))).alias("slug"))


# ---- spatial
_RECT = "SELECT n_nationkey AS k, n_nationkey * 0.7::DOUBLE AS x0, n_regionkey * 1.3::DOUBLE AS y0, n_nationkey * 0.7::DOUBLE + 2.25::DOUBLE AS x1, n_regionkey * 1.3::DOUBLE + 1.5::DOUBLE AS y1 FROM nation"


@query(f"WITH r AS ({_RECT}), c AS (SELECT range AS i FROM range(40)), j AS (SELECT k, y.i * 100 + x.i + 1 AS cell_id, greatest(0, least(x1, x.i + 1) - greatest(x0, x.i)) * greatest(0, least(y1, y.i + 1) - greatest(y0, y.i)) AS fraction FROM r, c x, c y) SELECT k, cell_id, round(fraction, 6) AS fraction FROM j WHERE fraction > 1e-9")
def polygon_coverage_rect(spark, d):
    n = load(spark, d, "nation").selectExpr("n_nationkey AS k", "n_nationkey * 0.7D AS x0", "n_regionkey * 1.3D AS y0", "n_nationkey * 0.7D + 2.25D AS x1", "n_regionkey * 1.3D + 1.5D AS y1")
    return spatial.rectangle_coverage(n, ["k"], 1.0, 100).where("fraction > 1e-9").select("k", "cell_id", r6("fraction"))


_POINT = "cast({k} * 37 % 360 AS double) - 179.5 AS lon, cast({k} * 17 % 150 AS double) - 74.25 AS lat"


@query(f"""WITH t AS (SELECT cast(n_nationkey AS bigint) AS id, {_POINT.format(k='n_nationkey')} FROM nation), s AS (SELECT s_suppkey AS src_id, {_POINT.format(k='s_suppkey')}, s_acctbal AS val FROM supplier),
p AS (SELECT id, src_id, val, sqrt(greatest(0, 2 - 2 * (cos(radians(t.lat)) * cos(radians(s.lat)) * cos(radians(t.lon - s.lon)) + sin(radians(t.lat)) * sin(radians(s.lat))))) AS dist FROM t, s),
n AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY round(dist, 9), src_id) AS r FROM p), w AS (SELECT id, val, CASE WHEN dist > 1e-7 THEN 1 / (dist * dist) ELSE 1e12 END AS w FROM n WHERE r <= 8)
SELECT id, round(sum(w * val) / sum(w), 2) AS val FROM w GROUP BY 1""")
def idw_knn(spark, d):
    t = load(spark, d, "nation").selectExpr("cast(n_nationkey AS bigint) AS id", *_POINT.format(k="n_nationkey").replace(", cast", "|cast").split("|"))
    s = load(spark, d, "supplier").selectExpr("s_suppkey AS src_id", *_POINT.format(k="s_suppkey").replace(", cast", "|cast").split("|"), "s_acctbal AS val")
    near = spatial.nearest(t, s, 8).withColumn("dist", F.when(F.col("dist") > 1e-7, F.col("dist")).otherwise(0.0))
    return spatial.idw(spatial.weights(near), s.select("src_id", "val")).select("id", F.round("val", 2).alias("val"))


@query("""WITH src AS (SELECT cast(s_suppkey % 10 AS bigint) AS col, cast(s_suppkey // 10 AS bigint) AS row, s_acctbal AS val FROM supplier WHERE s_suppkey < 100), t AS (SELECT cast(n_nationkey AS bigint) AS id, n_nationkey * 0.3125::DOUBLE AS x, n_regionkey * 1.25::DOUBLE AS y FROM nation),
n AS (SELECT id, floor(x) + i AS c, floor(y) + j AS r, (CASE WHEN i = 1 THEN x - floor(x) ELSE 1 - x + floor(x) END) * (CASE WHEN j = 1 THEN y - floor(y) ELSE 1 - y + floor(y) END) AS w FROM t, (VALUES (0), (1)) a(i), (VALUES (0), (1)) b(j))
SELECT id, round(sum(w * val) / sum(w), 4) AS val FROM n JOIN src ON src.col = n.c AND src.row = n.r WHERE w > 0 GROUP BY 1""")
def bilinear_resample(spark, d):
    src = load(spark, d, "supplier").selectExpr("s_suppkey % 10 AS col", "s_suppkey div 10 AS row", "s_acctbal AS val")
    t = load(spark, d, "nation").selectExpr("cast(n_nationkey AS bigint) AS id", "n_nationkey * 0.3125D AS x", "n_regionkey * 1.25D AS y")
    return spatial.bilinear(t, src).select("id", F.round("val", 4).alias("val"))


# two rectangles a zone that overlap, laid over the dateline on the half-degree grid
_HALF = grid.Grid(720, 360, -180.0, 90.0, 0.5, False)
_TWO = "SELECT n_nationkey AS k, 176 + n_nationkey * 0.25::DOUBLE AS x0, 178 + n_nationkey * 0.25::DOUBLE AS x1, 177.25 + n_nationkey * 0.25::DOUBLE AS u0, 179.4 + n_nationkey * 0.25::DOUBLE AS u1, n_regionkey * 1.3::DOUBLE AS y0, n_regionkey * 1.3::DOUBLE + 1.1 AS y1, n_regionkey * 1.3::DOUBLE + 0.6 AS v0, n_regionkey * 1.3::DOUBLE + 2.2 AS v1 FROM nation"


@query(f"""WITH r AS ({_TWO}), c AS (SELECT k, a.i AS c, b.i AS r, 175 + a.i * 0.5 AS l, 9 - b.i * 0.5 AS t, x0, x1, u0, u1, y0, y1, v0, v1 FROM r, range(30) a(i), range(20) b(i)),
o AS (SELECT k, c, r, greatest(0, least(x1, l + 0.5) - greatest(x0, l)) * greatest(0, least(y1, t) - greatest(y0, t - 0.5)) + greatest(0, least(u1, l + 0.5) - greatest(u0, l)) * greatest(0, least(v1, t) - greatest(v0, t - 0.5))
  - greatest(0, least(x1, u1, l + 0.5) - greatest(x0, u0, l)) * greatest(0, least(y1, v1, t) - greatest(y0, v0, t - 0.5)) AS area FROM c)
SELECT k, cast((r + 162) * 720 + (c + 710) % 720 + 1 AS bigint) AS cell_id, round(area / 0.25, 6) AS fraction FROM o WHERE area > 1e-9""")
def polygon_union(spark, d):
    n = load(spark, d, "nation").selectExpr("n_nationkey AS k", "n_nationkey * 0.25D AS o", "n_regionkey * 1.3D AS y")
    ring = "array({x0} + o, y + {y0}, {x1} + o, y + {y0}, {x1} + o, y + {y1}, {x0} + o, y + {y1})"
    parts = "array(struct(1L AS part, {a} AS xy), struct(2L AS part, {b} AS xy))".format(a=ring.format(x0="176D", x1="178D", y0="0D", y1="1.1D"), b=ring.format(x0="177.25D", x1="179.4D", y0="0.6D", y1="2.2D"))
    rings = n.select("k", F.explode(F.expr(parts)).alias("p")).select("k", "p.part", F.lit(False).alias("is_hole"), "p.xy")
    return spatial.coverage(rings, _HALF, "k").where("fraction > 4e-9").select("k", "cell_id", r6("fraction"))


_FINE = "cast({k} * 7919 % 36000 AS double) / 100 - 179.995 AS lon, cast({k} * 104729 % 17000 AS double) / 100 - 84.995 AS lat"
_XYZ = "cos(radians(lat)) * cos(radians(lon)) AS x, cos(radians(lat)) * sin(radians(lon)) AS y, sin(radians(lat)) AS z"


@query(f"""WITH t AS (SELECT *, {_XYZ} FROM (SELECT cast(n_nationkey AS bigint) AS id, {_POINT.format(k='n_nationkey')} FROM nation)), s AS (SELECT *, {_XYZ} FROM (SELECT o_orderkey AS src_id, {_FINE.format(k='o_orderkey')} FROM orders)),
p AS (SELECT id, src_id, sqrt((t.x - s.x) * (t.x - s.x) + (t.y - s.y) * (t.y - s.y) + (t.z - s.z) * (t.z - s.z)) AS dist FROM t, s)
SELECT id, src_id, round(dist, 6) AS dist FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY round(dist, 9), src_id) AS r FROM p) WHERE r <= 8""")
def nearest_orders(spark, d):
    split = lambda x: x.replace(", cast", "|cast").split("|")
    t = load(spark, d, "nation").selectExpr("cast(n_nationkey AS bigint) AS id", *split(_POINT.format(k="n_nationkey")))
    s = load(spark, d, "orders").selectExpr("o_orderkey AS src_id", *split(_FINE.format(k="o_orderkey")))
    return spatial.nearest(t, s, 8).select("id", "src_id", r6("dist"))
