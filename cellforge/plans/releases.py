"""The release registry: versions, access, manifests and addresses of what a release serves."""

from __future__ import annotations

import json
import re
import time
from collections.abc import Callable, Mapping
from urllib.parse import quote

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.identity import zone_collapse, zone_set_resolve
from ..sources.catalog import Catalog

#: States and access classes of a release, tables that a manifest lists, its required keys and id fields.
STATES = ("released", "prerelease", "retired")
ACCESS = ("public", "restricted")
TABLES = ("cell", "taxon", "model", "model_asset", "metric", "cell_metric", "zone", "zone_cell", "zone_metric", "zone_taxon", "dataset", "taxon_model", "listing", "native_asset")
REQUIRED = ("ver", "status", "grid_id", "id_field", "capabilities", "tables")
ID_FIELDS = ("mdl_seq", "mdl_key")


class Restricted(ValueError):
    """The release exists, but is not shown here."""


def is_version(v: str) -> bool:
    return re.fullmatch(r"v[0-9]+[a-z]?", v) is not None


def default_access(status: str) -> str:
    """What follows from a state alone: only what is out, or was, is public."""
    return "public" if status in ("released", "retired") else "restricted"


class Registry:
    """Versions under a base address; fetch(address) gives a text, which is kept for `ttl` seconds."""

    def __init__(self, base: str, fetch: Callable[[str], str], ttl: float = 300.0, preview: str | None = None, clock: Callable[[], float] = time.monotonic) -> None:
        self.base, self.fetch, self.ttl, self.preview, self.clock = base.rstrip("/"), fetch, ttl, preview, clock
        self.held: dict[str, tuple[float, str]] = {}

    def text(self, path: str, refresh: bool = False) -> str:
        at, now = self.held.get(path), self.clock()
        if refresh or at is None or now - at[0] > self.ttl:
            self.held[path] = at = now, self.fetch(f"{self.base}/{path}")
        return at[1]

    def latest(self, refresh: bool = False) -> str:
        first = self.text("latest.txt", refresh).strip().split("\n")[0].strip()
        if not is_version(first):
            raise ValueError(f"latest.txt names no version: {first!r}")
        return first

    def versions(self, refresh: bool = False) -> list[dict]:
        """Every version with its state and access, newest first."""
        found = json.loads(self.text("versions.json", refresh))
        found = found["versions"] if isinstance(found, dict) else found
        out = []
        for v in found:
            if not {"ver", "status"} <= set(v):
                raise ValueError("versions.json: every version needs ver and status")
            if v["status"] not in STATES:
                raise ValueError(f"versions.json: unknown status {v['status']!r}")
            access = v.get("access") or default_access(v["status"])
            if access not in ACCESS:
                raise ValueError(f"versions.json: unknown access {access!r}")
            out.append(v | {"access": access})
        return sorted(out, key=lambda v: (-int(re.sub(r"\D", "", v["ver"])), v["ver"]))

    def _one(self, ver: str, refresh: bool = False) -> dict:
        known = {v["ver"]: v for v in self.versions(refresh)}
        if ver not in known:
            raise ValueError(f"unknown version {ver}; known: {', '.join(known)}")
        return known[ver]

    def resolve(self, ver: str | None = None, states: tuple[str, ...] = STATES, access: tuple[str, ...] = ACCESS, refresh: bool = False) -> str:
        """A version's name; none or `latest` is what latest.txt says, which a prerelease never is unless named."""
        ver = (ver or "").strip()
        if ver in ("", "latest"):
            return self.latest(refresh)
        if not is_version(ver):
            raise ValueError(f"{ver!r} is no version name")
        v = self._one(ver, refresh)
        if v["status"] not in states:
            raise ValueError(f"version {ver} is {v['status']}, wanted: {', '.join(states)}")
        if v["access"] not in access:
            raise Restricted(f"version {ver} is {v['access']}" + (f"; see {self.preview}" if self.preview else ""))
        return ver

    def access(self, ver: str) -> str:
        return self._one(ver)["access"]

    def manifest(self, ver: str | None = None) -> dict:
        ver = self.resolve(ver)
        return validate_manifest(json.loads(self.text(f"{ver}/manifest.json")), ver)


def validate_manifest(m: dict, ver: str | None = None) -> dict:
    """m, if it has what readers rely on; an absent capability must never look like a present one."""
    if not isinstance(m, dict):
        raise ValueError("a manifest is an object")
    lacks = [k for k in REQUIRED if k not in m]
    if lacks:
        raise ValueError(f"manifest lacks {', '.join(lacks)}")
    if not isinstance(m["capabilities"], dict) or not m["capabilities"]:
        raise ValueError("manifest capabilities must be an object with entries")
    if m["id_field"] not in ID_FIELDS:
        raise ValueError(f"manifest id_field is {m['id_field']!r}, not one of {', '.join(ID_FIELDS)}")
    if ver is not None and m["ver"] != ver:
        raise ValueError(f"the manifest of {ver} says {m['ver']}")
    return m


def can(m: dict, what: str) -> bool:
    return m.get("capabilities", {}).get(what) is True


def cell_metrics(cat: Catalog, described: DataFrame | None = None) -> DataFrame:
    """Metrics that have cell values, by metric_seq; described adds columns by metric_key and drops none."""
    extra = [c for c in ("description",) if c in cat["metric"].columns]
    out = cat["metric"].join(cat["cell_metric"].select("metric_seq").distinct(), "metric_seq", "left_semi").select("metric_seq", "metric_key", *extra)
    return out.join(described, "metric_key", "left") if described is not None else out


def zone_units(cat: Catalog, version: str | None = None, zone_sets: DataFrame | None = None) -> DataFrame:
    """One row a spatial unit: zone_set_key, tbl, fld, n; the largest table of a set stands for it.

    A release without zone_set_key takes it from the registry of zone sets by (field, version).
    """
    z = cat["zone"]
    if "zone_set_key" in z.columns:
        d = z.groupBy("zone_set_key", "tbl", "fld").agg(F.count("*").alias("n"))
    else:
        d = z.groupBy("tbl", "fld").agg(F.count("*").alias("n"))
        if zone_sets is None:
            return d.withColumn("zone_set_key", F.lit(None).cast("string")).select("zone_set_key", "tbl", "fld", "n")
        kind = F.regexp_replace("fld", "_key$", "")
        sets = zone_set_resolve(zone_sets, d.select(kind.alias("zone_type"), F.lit(version).alias("version")).distinct()).select("zone_type", "zone_set_key")
        d = d.withColumn("zone_type", kind).join(sets, "zone_type", "left").select("zone_set_key", "tbl", "fld", "n")
    return zone_collapse(d)


def build_manifest(cat: Catalog, ver: str, base: str, grid_id: str, status: str = "released", access: str | None = None, described: DataFrame | None = None, capabilities: Mapping[str, bool] | None = None, zone_sets: DataFrame | None = None, tiles: Mapping[str, str] | None = None, extra: Mapping | None = None) -> dict:
    """The manifest of a release from its tables; what is collected is a row a metric and a row a spatial unit."""
    access = access or default_access(status)
    if access not in ACCESS:
        raise ValueError(f"access is {access!r}, not one of {', '.join(ACCESS)}")
    for k, v in (capabilities or {}).items():
        if not isinstance(k, str) or not k or not isinstance(v, bool):
            raise ValueError("capabilities are named booleans")
    metrics = [r.asDict() for r in cell_metrics(cat, described).orderBy("metric_seq").drop("metric_seq").collect()] if "metric" in cat and "cell_metric" in cat else []
    zones = [r.asDict() for r in zone_units(cat, ver, zone_sets).orderBy("fld", "tbl").collect()] if "zone" in cat else []
    for z in zones:
        if tiles and z["zone_set_key"] in tiles:
            z["tiles"] = tiles[z["zone_set_key"]]
    fields = {z["fld"] for z in zones}
    found = {
        "cell_species_list": "cell_model" in cat, "native_representation": "native_asset" in cat, "programareas": "programarea_key" in fields, "planareas": "planarea_key" in fields,
        "zone_taxon": "zone_taxon" in cat, "score_cogs": described is not None and any(m.get("cog") is not None for m in metrics),
    }
    id_field = "mdl_key" if "model" in cat and "mdl_key" in cat["model"].columns else "mdl_seq"
    tables = {t: f"{base.rstrip('/')}/{ver}/tables/{t}.parquet" for t in TABLES if t in cat}
    m = {"ver": ver, "status": status, "access": access, "grid_id": grid_id, "id_field": id_field, "capabilities": found | dict(capabilities or {}), "tables": tables, "metrics": metrics, "zones": zones}
    return validate_manifest(m | dict(extra or {}), ver)


def app_url(base: str, ver: str, app: str) -> str:
    if app not in ("scores", "species"):
        raise ValueError(f"unknown app {app!r}")
    if not is_version(ver):
        raise ValueError(f"{ver!r} is no version name")
    return f"{base.rstrip('/')}/{ver}/{app}/"


def product_urls(ver: str, app_base: str, docs_base: str, home: str, preview: str, access: str = "public") -> dict[str, str]:
    """Addresses of a version's pages; those of a restricted one lie behind the preview."""
    if access not in ACCESS:
        raise ValueError(f"unknown access {access!r}")
    if access == "restricted":
        return {"scores": app_url(preview, ver, "scores"), "species": app_url(preview, ver, "species"), "docs": f"{preview.rstrip('/')}/docs/{ver}/", "home": home}
    app_url(app_base, ver, "scores")
    return {a: f"{app_base.rstrip('/')}/{a}/?ver={ver}" for a in ("scores", "species")} | {"docs": f"{docs_base.rstrip('/')}/{ver}/", "home": home}


def canonical_sql(sql: str) -> str:
    return " ".join(sql.split())


def tile_url(base: str, sql: str | None = None, mdl_key: str | None = None, colormap: str = "spectral_r", rescale: tuple[float, float] | None = None, color: str | None = None, mtime: str | None = None) -> str:
    """Address of map tiles of a model, by its key, or of a statement; a flat colour takes the place of a colour map."""
    if (sql is None) == (mdl_key is None) or not (sql or mdl_key):
        raise ValueError("give either sql or mdl_key")
    import base64

    parts = [("mdl_key", quote(mdl_key, safe=""))] if mdl_key else [("sql", base64.urlsafe_b64encode(canonical_sql(sql).encode()).decode().rstrip("="))]
    if color is not None:
        if not re.fullmatch("#?[0-9A-Fa-f]{6}([0-9A-Fa-f]{2})?", color):
            raise ValueError(f"{color!r} is no colour")
        parts.append(("color", color.lstrip("#")))
    else:
        parts.append(("colormap", colormap))
        if rescale is not None:
            parts.append(("rescale", ",".join(f"{x:g}" for x in rescale)))
    if mtime is not None:
        parts.append(("mtime", mtime))
    return f"{base.rstrip('/')}/tiles/{{z}}/{{x}}/{{y}}.png?" + "&".join(f"{k}={v}" for k, v in parts)


def tracked(send: Callable[[dict], None], event: str, run: Callable[[], object], **params):
    """run(), with its rows (of local results), milliseconds and outcome sent; a failure is sent and raised again, one of send is not."""
    began = time.perf_counter()

    def tell(**said) -> None:
        try:
            send({"event": event} | params | said | {"ms": (time.perf_counter() - began) * 1000})
        except Exception:  # noqa: BLE001 - a log must not break the query
            pass

    try:
        out = run()
    except Exception as e:
        tell(status="error", error=str(e))
        raise
    tell(status="ok", n_rows=None if isinstance(out, DataFrame) or not hasattr(out, "__len__") else len(out))
    return out
