"""Vulnerability feed pages, landed as JSON."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The record layout of the public vulnerability feed.
CVSS = "struct<version:string,vectorString:string,baseScore:float,baseSeverity:string>"
METRIC = f"struct<source:string,type:string,cvssData:{CVSS},exploitabilityScore:float,impactScore:float>"
TEXT = "struct<lang:string,value:string>"
CPE_MATCH = "struct<vulnerable:boolean,criteria:string,matchCriteriaId:string>"
NODE = f"struct<operator:string,negate:boolean,cpeMatch:array<{CPE_MATCH}>>"
CVE_TYPE = (
    "struct<id:string,sourceIdentifier:string,published:string,lastModified:string,vulnStatus:string,"
    f"descriptions:array<{TEXT}>,metrics:map<string,array<{METRIC}>>,"
    f"weaknesses:array<struct<source:string,type:string,description:array<{TEXT}>>>,"
    f"configurations:array<struct<nodes:array<{NODE}>>>,"
    "references:array<struct<url:string,source:string,tags:array<string>>>>"
)
PAGE_SCHEMA = f"totalResults bigint, resultsPerPage bigint, startIndex bigint, vulnerabilities array<struct<cve:{CVE_TYPE}>>"
RESULTS_PER_PAGE = 2000


def read_cve_pages(pages: DataFrame, results_per_page: int = RESULTS_PER_PAGE, max_pages: int | None = None) -> DataFrame:
    """Records of landed feed pages (column ``payload``).

    Page ``n`` starts at ``n * results_per_page``; the first page is always read, further ones up
    to the feed's total. ``max_pages`` is a limit that a caller may set. A feed without records gives an empty frame with the same columns.
    """
    parsed = pages.select(F.from_json("payload", PAGE_SCHEMA).alias("p")).select("p.*")
    start = F.coalesce(F.col("startIndex"), F.lit(0))
    wanted = (start == 0) | (start < F.col("totalResults"))
    if max_pages is not None:
        wanted = wanted & (start < max_pages * results_per_page)
    return (
        parsed.where(wanted)
        .select(F.explode("vulnerabilities").alias("v"))
        .where(F.col("v.cve").isNotNull())
        .select("v.cve.*")
    )


def published_between(cves: DataFrame, start: datetime | None, end: datetime | None) -> DataFrame:
    """Records published in a closed interval; either end may be open."""
    published = F.try_to_timestamp("published")
    kept = cves
    if start is not None:
        kept = kept.where(published >= F.lit(start.isoformat(sep=" ")).cast("timestamp"))
    if end is not None:
        kept = kept.where(published <= F.lit(end.isoformat(sep=" ")).cast("timestamp"))
    return kept


def filter_cves(cves: DataFrame, params: Mapping[str, object | None]) -> DataFrame:
    """Keep records that meet every parameter given; parameters that are null are ignored."""
    kept = cves
    for name, value in params.items():
        if value is not None:
            kept = kept.where(_predicate(name, value))
    return kept


def _predicate(name: str, value: object) -> Column:
    text = str(value)
    metrics = F.flatten(F.map_values("metrics"))
    matches = F.flatten(F.transform(F.flatten(F.transform("configurations", lambda c: c["nodes"])), lambda n: n["cpeMatch"]))
    if name == "cvssV3Severity":
        return F.exists(
            metrics,
            lambda m: m["cvssData"]["version"].startswith("3")
            & (F.upper(m["cvssData"]["baseSeverity"]) == text.upper()),
        )
    if name == "cvssV2Severity":
        return F.exists(
            metrics,
            lambda m: m["cvssData"]["version"].startswith("2")
            & (F.upper(m["cvssData"]["baseSeverity"]) == text.upper()),
        )
    if name in ("cvssV2Metrics", "cvssV3Metrics"):
        generation = "2" if name == "cvssV2Metrics" else "3"
        return F.exists(
            metrics,
            lambda m: m["cvssData"]["version"].startswith(generation) & F.contains(m["cvssData"]["vectorString"], F.lit(text)),
        )
    if name == "keywordSearch":
        return F.exists("descriptions", lambda d: F.contains(F.lower(d["value"]), F.lit(text.lower())))
    if name == "cveId":
        return F.col("id") == text
    if name == "cpeMatchString":
        return F.exists(matches, lambda m: m["criteria"].startswith(text))
    if name == "isVulnerable":
        wanted = text.lower() in ("true", "1", "yes")
        return F.coalesce(F.exists(matches, lambda m: m["vulnerable"]), F.lit(False)) == F.lit(wanted)
    raise ValueError(f"unknown feed parameter {name!r}")


def cve_scores(cves: DataFrame) -> DataFrame:
    """One row per record and score: metric family, version, base score and severity, and its CPE count."""
    cpe_count = F.aggregate(
        F.flatten(F.transform("configurations", lambda c: c["nodes"])),
        F.lit(0),
        lambda n, node: n + F.coalesce(F.size(node["cpeMatch"]), F.lit(0)),
    )
    return (
        cves.select("id", cpe_count.alias("cpe_count"), F.explode("metrics").alias("metric_family", "entries"))
        .select("id", "cpe_count", "metric_family", F.explode("entries").alias("m"))
        .select(
            "id",
            "metric_family",
            F.col("m.cvssData.version").alias("cvss_version"),
            F.col("m.cvssData.baseScore").alias("base_score"),
            F.col("m.cvssData.baseSeverity").alias("severity"),
            "cpe_count",
        )
    )
