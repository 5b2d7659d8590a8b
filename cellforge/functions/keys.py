"""Keys, names, codes and labels as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Taxonomic authorities of merged keys; risk codes by authority.
AUTHORITIES = ("WORMS", "BOTW", "ITIS", "GBIF", "SLB")
RISK_CODES = ("NMFS:EN", "NMFS:TN", "NMFS:LC", "FWS:EN", "FWS:TN", "FWS:LC", "IUCN:CR", "IUCN:EN", "IUCN:VU", "IUCN:NT", "IUCN:LC", "IUCN:DD")


def _require(ok: Column, value: Column, message: str) -> Column:
    return F.when(ok, value).otherwise(F.raise_error(F.concat(F.lit(message), F.coalesce(value.cast("string"), F.lit("null")))))


def normalize_ds_key(ds: Column) -> Column:
    return F.regexp_replace(ds, r"^am_0\.05$", "am")


def raw_key(ds: Column, sp: Column, interval: Column | None = None) -> Column:
    ds = _require(F.coalesce((ds != "") & ~ds.contains("|"), F.lit(False)), ds, "bad dataset key: ")
    parts = [ds, F.lit("|"), sp.cast("string")]
    return F.concat(*parts, F.lit("|"), interval) if interval is not None else F.concat(*parts)


def merged_key(authority: Column, taxon_id: Column) -> Column:
    a = F.upper(authority)
    return F.concat(F.lit("ms_merge|"), _require(F.coalesce(a.isin(*AUTHORITIES), F.lit(False)), a, "unknown authority: "), F.lit(":"), taxon_id.cast("string"))


def parse_key(key: Column) -> dict[str, Column]:
    """ds_key, sp_id, interval and, of merged keys, authority and taxon_id."""
    part = lambda n: F.try_element_at(F.split(key, r"\|"), F.lit(n))
    merged = part(1) == "ms_merge"
    return {
        "ds_key": part(1), "sp_id": part(2), "interval": part(3),
        "authority": F.when(merged, F.try_element_at(F.split(part(2), ":"), F.lit(1))),
        "taxon_id": F.when(merged & part(2).contains(":"), F.regexp_extract(part(2), "^[^:]*:(.*)$", 1)),
    }


#: Fixed values in clean_name, noaa_code, noaa_mmpa, er_score and component_label: name patterns, status phrases, risk weights, label patterns.
def clean_name(name: Column, binomial: bool = False) -> Column:
    x = F.regexp_replace(name, r"\s*\(=[^)]*\)", "")
    x = F.regexp_replace(x, r"\s+(ssp|spp|subsp|var)\.?\s+", " ")
    x = F.trim(F.regexp_replace(x, r"\s+", " "))
    return F.concat_ws(" ", F.slice(F.split(x, " "), 1, 2)) if binomial else x


def noaa_code(status: Column) -> Column:
    return F.when(status.rlike("ESA Endangered(?! - Foreign)"), "EN").when(status.rlike("ESA Threatened"), "TN").otherwise("LC")


def noaa_mmpa(status: Column) -> Column:
    return F.coalesce(status.contains("MMPA"), F.lit(False))


def er_score(code: Column, mmpa: Column, mbta: Column) -> Column:
    """Extinction risk 1..100; US authorities take the largest of status and protections, a null flag makes it null."""
    code = F.when(code.isNull() | code.isin(*RISK_CODES), code).otherwise(F.raise_error(F.concat(F.lit("unrecognised risk code: "), code)))
    authority, status = F.split_part(code, F.lit(":"), F.lit(1)), F.split_part(code, F.lit(":"), F.lit(2))
    us = F.when(status == "EN", 100).when(status == "TN", 50).when(status == "LC", 1).otherwise(0)
    flags = F.greatest(F.when(mmpa, 20).otherwise(0), F.when(mbta, 10).otherwise(0))
    us = F.when(mmpa.isNotNull() & mbta.isNotNull(), F.greatest(us, flags))
    iucn = F.when(status == "CR", 50).when(status == "EN", 25).when(status == "VU", 5).when(status == "NT", 2).otherwise(1)
    return F.when(code.isNull(), 1).when(authority.isin("NMFS", "FWS"), us).otherwise(iucn)


def component_label(metric: Column) -> Column:
    """First `extrisk_`, first `_ecoregion_rescaled` gone, then the first underscore a blank."""
    for pattern, to in (("extrisk_", ""), ("_ecoregion_rescaled", ""), ("_", " ")):
        metric = F.regexp_replace(metric, f"^(.*?){pattern}", f"$1{to}")
    return metric


def slug(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, "[^A-Za-z0-9]+", "_"), "^_+|_+$", "")


def event_name(text: Column) -> Column:
    x = F.regexp_replace(F.regexp_replace(F.lower(text), "[^a-z0-9_]+", "_"), "_+", "_")
    x = F.regexp_replace(x, "^_|_$", "")
    return F.substring(F.when(x.rlike("^[a-z]"), x).otherwise(F.concat(F.lit("e_"), x)), 1, 40)


def base64url(text: Column) -> Column:
    return F.regexp_replace(F.translate(F.base64(F.encode(text, "UTF-8")), "+/\r\n", "-_"), "=+$", "")


def iso_day(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM-dd'T'00:00:00'Z'")


def mtime(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMdd'T'HHmmss'Z'")


def file_size(n: Column) -> Column:
    k = 1024.0
    return F.when(n < k, F.format_string("%d B", n.cast("long"))).when(n < k**2, F.format_string("%.1f KB", n / k)).when(n < k**3, F.format_string("%.1f MB", n / k**2)).otherwise(F.format_string("%.1f GB", n / k**3))


def client_ip(cf: Column, forwarded: Column, remote: Column) -> Column:
    some = lambda c: F.when(F.trim(c) != "", F.trim(c))
    return F.coalesce(some(cf), some(F.split_part(forwarded, F.lit(","), F.lit(1))), some(remote))


def zone_set_key(kind: Column, vintage: Column) -> Column:
    return F.concat(kind, F.lit("_"), _require(F.coalesce(vintage.rlike("^[0-9]{4}-[0-9]{2}$"), F.lit(False)), vintage, "bad vintage: "))


def content_key(grid: Column, digest: Column, ext: str = "tif") -> Column:
    return F.format_string(f"cog/%s/%s.{ext}", grid, digest)


def content_url(grid: Column, digest: Column, base: str, ext: str = "tif") -> Column:
    return F.concat(F.lit(base.rstrip("/") + "/"), content_key(grid, digest, ext))


def escape_html(text: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        text = F.replace(text, F.lit(a), F.lit(b))
    return text


def encoded_hash(digest: Column, encoding: Column) -> Column:
    return F.lower(F.lpad(F.hex(F.xxhash64(F.concat(digest, F.lit("|"), encoding))), 16, "0"))
