"""The domain's tables as views over the driver's tables: the same select lists for Spark and for SQL text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..sources.catalog import Catalog

_B = (
    "'ms_merge|WORMS:' || cast(l_partkey as string) AS ms_merge_key",
    "CASE WHEN l_partkey % 5 = 0 OR l_returnflag = 'A' THEN 'am' WHEN l_returnflag = 'N' THEN 'rng' ELSE 'ch' END AS ds_key",
    "cast(l_suppkey % 100 + 1 AS bigint) AS cell_id",
    "cast(l_quantity * 2 AS double) AS val",
)
#: name -> (source, select list, tail of the statement)
VIEWS: dict[str, tuple[str, tuple[str, ...], str]] = {
    "b": ("lineitem", _B, ""),
    "taxon": (
        "part",
        (
            "p_partkey AS taxon_id", "'ms_merge|WORMS:' || cast(p_partkey as string) AS ms_merge_key", "cast(p_size * 2 AS double) AS er_score", "lower(p_type) AS sp_cat",
            "p_name AS scientific_name", "p_brand AS common_name", "'WORMS' AS taxon_authority",
            "CASE p_partkey % 6 WHEN 0 THEN 'NMFS:EN' WHEN 1 THEN 'NMFS:TN' WHEN 2 THEN 'FWS:LC' WHEN 3 THEN 'IUCN:CR' WHEN 4 THEN 'IUCN:NT' ELSE NULL END AS extrisk_code",
            "p_partkey % 3 = 0 AS is_mmpa", "p_partkey % 4 = 0 AS is_mbta", "p_partkey % 7 <> 0 AS is_valid_usa", "p_partkey % 11 <> 0 AS is_marine",
        ),
        "",
    ),
    "us_cells": ("supplier", ("DISTINCT cast(s_suppkey % 100 + 1 AS bigint) AS cell_id",), "WHERE (s_suppkey % 100 + 1) % 5 = 0"),
    "cell": ("supplier", ("DISTINCT cast(s_suppkey % 100 + 1 AS bigint) AS cell_id", "cast(10 + (s_suppkey % 100 + 1) % 7 AS double) AS area_km2"), ""),
    "zone": ("nation", ("n_nationkey AS zone_seq", "'nation' AS tbl", "'programarea_key' AS fld", "n_name AS val"), ""),
    "zone_cell": ("supplier", ("s_nationkey AS zone_seq", "cast(s_suppkey % 100 + 1 AS bigint) AS cell_id", "cast(max(s_suppkey * 37 % 100 + 1) AS double) AS pct_covered"), "GROUP BY s_nationkey, s_suppkey % 100 + 1"),
    "metric": ("orders", ("DISTINCT cast(substr(o_orderpriority, 1, 1) AS int) AS metric_seq", "'extrisk_' || lower(substr(o_orderpriority, 3)) || '_ecoregion_rescaled' AS metric_key"), ""),
    "cell_metric": ("orders", ("cast(o_custkey % 100 + 1 AS bigint) AS cell_id", "cast(substr(o_orderpriority, 1, 1) AS int) AS metric_seq", "cast(floor(max(o_totalprice) / 1000) AS double) AS value"), "GROUP BY o_custkey % 100 + 1, cast(substr(o_orderpriority, 1, 1) AS int)"),
    "zone_metric": ("orders", ("cast(o_custkey % 25 AS int) AS zone_seq", "cast(substr(o_orderpriority, 1, 1) AS int) AS metric_seq", "cast(floor(max(o_totalprice) / 1000) AS double) AS value"), "GROUP BY cast(o_custkey % 25 AS int), cast(substr(o_orderpriority, 1, 1) AS int)"),
    "zone_metric2": ("orders", ("cast(o_custkey % 23 AS int) AS zone_seq", "cast(substr(o_orderpriority, 1, 1) AS int) AS metric_seq", "cast(floor(min(o_totalprice) / 100) AS double) AS value"), "GROUP BY cast(o_custkey % 23 AS int), cast(substr(o_orderpriority, 1, 1) AS int)"),
}


def text(name: str) -> str:
    source, columns, tail = VIEWS[name]
    return f"SELECT {', '.join(columns)} FROM {source} {tail}".strip()


def ctes(*names: str) -> str:
    """WITH clause for SQL text."""
    return "WITH " + ",\n".join(f"{n} AS ({text(n)})" for n in names).replace("as string", "as varchar")


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    source, columns, tail = VIEWS[name]
    return spark.sql(f"SELECT {', '.join(columns)} FROM {{{source}}} {tail}", **{source: load(spark, sf_dir, source)})


def flags(b: DataFrame) -> DataFrame:
    from pyspark.sql import functions as F

    return b.groupBy("ms_merge_key").agg(F.bool_or(F.col("ds_key") == "am").alias("has_am"), F.bool_or(F.col("ds_key") != "am").alias("has_range"))


def catalog(spark: SparkSession, sf_dir: str) -> Catalog:
    from pyspark.sql import functions as F

    names = ("cell", "taxon", "zone", "zone_cell", "metric", "cell_metric", "zone_metric")
    tables = {n: view(spark, sf_dir, n) for n in names}
    tables["model_cell"] = view(spark, sf_dir, "b").groupBy(F.col("ms_merge_key").alias("mdl_key"), "cell_id").agg(F.max("val").alias("val"))
    return Catalog(tables)
