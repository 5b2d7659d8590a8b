"""Named tables of a release, schema resolution over its generations, source choice."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.grid import grid

VIEWS = ("cell", "taxon", "model", "zone", "zone_cell", "zone_taxon", "metric", "cell_metric", "zone_metric", "dataset", "cell_grid")


class Catalog:
    """{name: DataFrame}; only schemas are looked at, never data."""

    def __init__(self, tables: dict[str, DataFrame]) -> None:
        self.tables = tables

    @classmethod
    def attach(cls, spark: SparkSession, base: str, names: tuple[str, ...] = VIEWS, register: bool = False) -> Catalog:
        """The release under base: {name}.parquet, and model_cell partitioned by mdl_id joined to model."""
        tables = {}
        for name in names:
            try:
                tables[name] = spark.read.parquet(f"{base}/{name}.parquet")
            except Exception as e:  # a release has the tables it has
                if "PATH_NOT_FOUND" not in str(e):
                    raise
        for name in ("cell_metric", "zone_metric", "zone"):
            if name in tables and "val" in tables[name].columns:
                tables[name] = tables[name].withColumn("value", F.col("val"))
        for name in ("model_cell", "cell_model"):
            try:
                df = spark.read.option("mergeSchema", True).parquet(f"{base}/{name}")
            except Exception as e:
                if "PATH_NOT_FOUND" not in str(e):
                    raise
                continue
            tables[name] = df.join(tables["model"], "mdl_id") if name == "model_cell" and "mdl_id" in df.columns and "model" in tables else df
        if register:
            for name, df in tables.items():
                df.createOrReplaceTempView(name)
        return cls(tables)

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self.tables:
            raise KeyError(f"no table {name!r} in this release")
        return self.tables[name]

    def __contains__(self, name: str) -> bool:
        return name in self.tables

    def column(self, table: str, what: str, *candidates: str, optional: bool = False) -> str | None:
        for c in candidates:
            if c in self[table].columns:
                return c
        if optional:
            return None
        raise ValueError(f"cannot resolve the {what} column of {table}: none of {', '.join(candidates)}")

    def value(self, table: str) -> str:
        for c in ("val", "value"):
            if c in self[table].columns:
                return c
        raise ValueError(f"{table} has neither val nor value")

    def species_columns(self, cells: str | None = "model_cell") -> dict[str, str | None]:
        """valid, marine, key of taxon; key and value of the cell table (not touched if None)."""
        out = {
            "valid": self.column("taxon", "validity", "is_valid_usa", "is_ok"),
            "tkey": self.column("taxon", "model key", "ms_merge_key", "mdl_key", "mdl_seq"),
            "marine": self.column("taxon", "marine", "is_marine", optional=True) if "is_valid_usa" in self["taxon"].columns else None,
        }
        if cells:
            out |= {"mkey": self.column(cells, "model key", "mdl_key", "mdl_seq", "ms_merge_key"), "val": self.value(cells)}
        return out

    def exclude(self, name: str, *columns: str) -> DataFrame:
        """All columns of a table but these."""
        return self[name].drop(*columns)

    def tile_width(self) -> int:
        if "cell_grid" in self:
            row = self["cell_grid"].select("ncol").first()
            if row:
                return int(row[0])
        return 7200


def cell_grid(spark: SparkSession, name: str) -> DataFrame:
    """The one-row table that tells the width of the grid that cell ids are of."""
    g = grid(name)
    return spark.createDataFrame([(name, g.ncol, g.nrow)], "grid_id string, ncol int, nrow int")


def write_cell_grid(spark: SparkSession, base: str, name: str) -> DataFrame:
    out = cell_grid(spark, name)
    out.coalesce(1).write.mode("overwrite").parquet(f"{base}/cell_grid.parquet")
    return out


def require_spark(spark: SparkSession, least: str) -> None:
    """The engine's version floor."""
    number = lambda v: [int(x) for x in re.findall(r"\d+", v)[:3]]
    if number(spark.version) < number(least):
        raise ValueError(f"Spark {least} or later is needed, this is {spark.version}")


def content_index(lines: DataFrame, grid_id: str, column: str = "line") -> DataFrame:
    """hash: the distinct content hashes of a store's listing under cog/{grid}/."""
    found = F.regexp_extract(column, rf"cog/{re.escape(grid_id)}/([0-9a-f]{{16}})\.tif$", 1)
    return lines.select(found.alias("hash")).where("hash <> ''").distinct()


def pages(total: int, size: int | None) -> list[tuple[int, int]]:
    """(offset from 1, rows) of the requests that fetch `total` rows, `size` at a time; one without a size."""
    if total < 0 or (size is not None and size < 1):
        raise ValueError("total must not be negative, size at least 1")
    return [(1, total)] if size is None else [(a + 1, min(size, total - a)) for a in range(0, total, size)]
