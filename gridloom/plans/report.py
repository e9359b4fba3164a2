"""Reports from computed sites: fixed sentences whose every number is traced back to the input."""

from __future__ import annotations

import json
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.functions.numbers import NUMERAL, numerals_of, plain_numeral

# Verdicts, provenance, caveats and the report's sentences.
VERDICTS = [(70, "strong"), (50, "workable"), (30, "marginal"), (0, "poor")]
PROVENANCE = {"imagery_window": "2026-01-01/2026-04-30", "landcover_source": "ESA WorldCover 2021 v200", "dem_source": "Copernicus GLO-30"}
CAVEATS = [
    "Composite imagery, Jan-Apr 2026 - not a single date.",
    "Flood exposure is a proxy from elevation and water distance, not a hydrological model.",
    "Distances are straight-line, not along-road.",
    "Thresholds are v1 defaults, not certified site-planning standards.",
]
TITLE = "# Shelter siting assessment — Region {region}"
NOTHING = "No candidate sites met the minimum contiguous area and score thresholds in the area analysed. This is a result, not a failure: the exclusion rules removed all qualifying ground."
BEST = "{n} candidate site(s) identified. The highest-ranked is {verdict}, scoring {score} over {area_ha} ha."
TABLE = ["| Rank | Score | Area (ha) | Mean slope (deg) | Road (m) | Water (m) | Cover |", "|---|---|---|---|---|---|---|"]
ROW = "| {rank} | {score} | {area_ha} | {mean_slope_deg} | {dist_road_m} | {dist_water_m} | {dominant_landcover} |"
DETAIL = [
    "**Site {rank} — {verdict}** (score {score}, {area_ha} ha)",
    "Located at {lat}, {lon}, on ground classified as {dominant_landcover} at a mean elevation of {mean_elevation_m} m.",
    "Mean slope {mean_slope_deg}° (maximum {max_slope_deg}°). Nearest drivable road {dist_road_m} m; nearest perennial water {dist_water_m} m.",
]
SOURCES = {"imagery_window": "Imagery window", "landcover_source": "Land cover", "dem_source": "Elevation"}
CLOSING = "Outputs are *candidate sites for assessment* — decision support, not certified site planning."


def verdict(score: float) -> str:
    return next((word for floor, word in VERDICTS if score >= floor), VERDICTS[-1][1])


def payload(region: str, sites: DataFrame) -> dict:
    """The sites document; ranked sites are a handful by construction."""
    rows = [r.asDict() for r in sites.orderBy("rank").collect()]
    for r in rows:
        r["dist_road_m"], r["dist_water_m"] = int(r["dist_road_m"]), int(r["dist_water_m"])
    return {"region": region, **PROVENANCE, "caveats": CAVEATS, "sites": rows}


def payload_table(region: str, sites: DataFrame) -> DataFrame:
    """The same as one row of JSON, for a distributed write."""
    fields = {k: F.lit(v).alias(k) for k, v in PROVENANCE.items()}
    ordered = F.array_sort(F.collect_list(F.struct(*sites.columns)))
    return sites.agg(ordered.alias("sites")).select(F.to_json(F.struct(F.lit(region).alias("region"), *fields.values(), F.array(*map(F.lit, CAVEATS)).alias("caveats"), "sites")).alias("value"))


def render(document: dict) -> str:
    sites = document.get("sites", [])
    lines = [TITLE.format(region=document.get("region", "?")), "", "## Verdict", ""]
    if sites:
        lines += [BEST.format(n=len(sites), verdict=verdict(sites[0]["score"]), **{k: sites[0][k] for k in ("score", "area_ha")}), "", "## Ranked sites", "", *TABLE]
        lines += [ROW.format(**s) for s in sites]
        lines += ["", "## Site detail", ""]
        for s in sites:
            lines += ["\n".join([d.format(verdict=verdict(s["score"]), **s) for d in DETAIL] + (["Cautions: " + "; ".join(s["flags"]) + "."] if s["flags"] else [])), ""]
    else:
        lines += [NOTHING, ""]
    lines += ["## Data provenance", "", *[f"- {label}: {document[k]}" for k, label in SOURCES.items() if k in document]]
    if caveats := document.get("caveats"):
        lines += ["", "## What these numbers do not mean", "", *[f"- {c}" for c in caveats]]
    return "\n".join([*lines, "", "---", "", CLOSING])


def invented(text: str, document: dict) -> list[str]:
    """Numerals of a text that the document doesn't hold."""
    return sorted({plain_numeral(m) for m in re.findall(NUMERAL, text)} - numerals_of(document))


def invented_in(reports: DataFrame, allowed: DataFrame) -> DataFrame:
    """The same over many: reports (id, numeral) without a match in allowed (id, numeral)."""
    return reports.distinct().join(allowed.distinct(), ["id", "numeral"], "left_anti")


def write(document: dict, path: str) -> str:
    """Verifies, then writes; a report with invented numbers is never written."""
    text = render(document)
    if found := invented(text, document):
        raise ValueError(f"numbers absent from the input: {found}")
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    return text


def summarise(document: dict) -> str:
    sites = document.get("sites", [])
    if not sites:
        return "no candidate sites met the minimum area and score"
    lines = [f"{len(sites)} candidate site(s):"]
    for s in sites:
        lines.append(f"  #{s['rank']}  score {s['score']:5.1f}  {s['area_ha']:6.2f} ha  slope {s['mean_slope_deg']:4.1f} deg  road {s['dist_road_m'] / 1000:4.1f} km  water {s['dist_water_m'] / 1000:4.1f} km  {s['dominant_landcover']}")
        lines += [f"        ! {flag}" for flag in s["flags"]]
    return "\n".join(lines)


def dumps(document: dict) -> str:
    return json.dumps(document, indent=2)
