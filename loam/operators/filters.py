"""Row selections used by the rollups (all push down or stay in codegen)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loam.functions.text import any_like, like, not_like, request_list, text_eq, text_ne

# Texture patterns that disqualify a representative texture group.
EXCLUDED_TEXTURE_PATTERNS = ["%PM%", "%DOM", "%MPT%", "%MUCK", "%PEAT%", "%br%", "%wb%"]


def _as_frame(spark, values: Iterable[str] | DataFrame, col: str) -> DataFrame:
    if isinstance(values, DataFrame):
        return values.select(F.col(col))
    return spark.createDataFrame([(v,) for v in values], f"{col} string")


def filter_area(legend: DataFrame, areas: Iterable[str] | DataFrame | str | None = None,
                case_sensitive: bool = False) -> DataFrame:
    """Keep legend rows of the requested survey areas.

    A list or ``;``-separated text holds LIKE patterns under the case rule
    (an area without wildcards matches itself): one predicate on the legend.
    A table of areas is an equi-join under the case rule, whatever its size.
    """
    if areas is None:
        return legend
    if not isinstance(areas, DataFrame):
        return legend.filter(any_like("areasymbol", request_list(areas), case_sensitive))
    fold = (lambda c: c) if case_sensitive else F.lower
    req = areas.select(fold(F.col("areasymbol")).alias("_area")).distinct()
    return legend.join(req, fold(F.col("areasymbol")) == F.col("_area"), "left_semi")


def unmatched_requests(values: DataFrame, col: str, requests: Iterable[str] | str, case_sensitive: bool = False) -> DataFrame:
    """Requests (names or LIKE patterns) that match no value of ``col``, as they stand, under the name ``col``.

    One aggregate over the column: a flag per request.
    """
    asked = request_list(requests)
    if not asked:
        return values.select(col).limit(0)
    hit = [F.struct(F.lit(r).alias(col), F.coalesce(F.bool_or(like(col, r, case_sensitive)), F.lit(False)).alias("_hit")) for r in asked]
    return values.agg(F.array(*hit).alias("_r")).select(F.inline("_r")).where(~F.col("_hit")).select(col)


def requested_areas(legend: DataFrame, areas: Iterable[str] | DataFrame | str | None = None,
                    case_sensitive: bool = False) -> DataFrame:
    """The ``areasymbol`` list a caller asked for: matching legend areas, and requests (patterns too) that match none as they stand."""
    have = filter_area(legend, areas, case_sensitive).select("areasymbol")
    if areas is None:
        return have.distinct()
    if not isinstance(areas, DataFrame):
        return have.distinct().union(unmatched_requests(legend, "areasymbol", areas, case_sensitive))
    fold = (lambda c: c) if case_sensitive else F.lower
    known = have.select(fold(F.col("areasymbol")).alias("_known")).distinct()
    missing = areas.select(F.col("areasymbol").alias("_area")).join(known, fold(F.col("_area")) == F.col("_known"), "left_anti")
    return have.union(missing).distinct()


def filter_mukeys(df: DataFrame, mukeys: DataFrame | Iterable[str] | None) -> DataFrame:
    """Map-unit selection by a key DataFrame (never a literal IN list)."""
    if mukeys is None:
        return df
    keys = _as_frame(df.sparkSession, mukeys, "mukey").distinct()
    return df.join(keys, "mukey", "left_semi")


def restrict_to_mapunits(mapunits: DataFrame, component: DataFrame, *children: DataFrame):
    """Push a map-unit selection down: components of the selected map units, and children rows
    (keyed by ``cokey``) of those components.

    Left-semi joins only; a small selection is broadcast by Spark's size check,
    so the big child tables are filtered before they are shuffled.
    """
    comps = component.join(mapunits.select("mukey"), "mukey", "left_semi")
    keys = comps.select("cokey")
    return (comps, *[c.join(keys, "cokey", "left_semi") for c in children])


def filter_major(component: DataFrame, case_sensitive: bool = False) -> DataFrame:
    return component.filter(text_eq("majcompflag", "Yes", case_sensitive))


def filter_horizon_depth(chorizon: DataFrame, top: int, bottom: int) -> DataFrame:
    """Horizons overlapping (top, bottom) with a known top depth."""
    return chorizon.filter(
        (F.col("hzdepb_r") > F.lit(top)) & (F.col("hzdept_r") < F.lit(bottom)) & F.col("hzdept_r").isNotNull()
    )


def filter_mineral_horizon(chorizon: DataFrame, case_sensitive: bool = False) -> DataFrame:
    """Drop organic ('O') and bedrock ('r') horizons; a NULL name is dropped too."""
    return chorizon.filter(not_like("hzname", "%O%", case_sensitive) & not_like("hzname", "%r%", case_sensitive))


def profile_horizon_keep(case_sensitive: bool = False):
    """Min/Max rule: organic horizon dropped only if it starts above 10 cm; 'r' dropped; NULL name kept."""
    code = (
        F.when(like("hzname", "%O%", case_sensitive) & (F.col("hzdept_r") < 10), F.lit(2))
        .when(like("hzname", "%r%", case_sensitive), F.lit(2))
        .otherwise(F.lit(1))
    )
    return code == 1


def filter_profile_horizon(chorizon: DataFrame, case_sensitive: bool = False) -> DataFrame:
    return chorizon.filter(profile_horizon_keep(case_sensitive))


def filter_texture(chtexturegrp: DataFrame, case_sensitive: bool = False) -> DataFrame:
    """Representative texture rows whose texture matches none of the excluded patterns."""
    cond = text_eq("rvindicator", "yes", case_sensitive)
    for pat in EXCLUDED_TEXTURE_PATTERNS:
        cond = cond & not_like("texture", pat, case_sensitive)
    return chtexturegrp.filter(cond)


def resolve_rules(cointerp: DataFrame, requests: Iterable[str] | str, case_sensitive: bool = False) -> list[str]:
    """Rule names that the requests (LIKE patterns under the case rule) match, sorted.

    One aggregate over the name column; as many names come to the driver as
    the survey has rules.  The names then filter the ratings exactly, so that
    the filter reaches the scan.
    """
    names = cointerp.select("mrulename").filter(any_like("mrulename", request_list(requests), case_sensitive)).distinct()
    return sorted(r.mrulename for r in names.collect())


def filter_rule(cointerp: DataFrame, rules: Iterable[str], overall: bool = True) -> DataFrame:
    """Rows of the rules named exactly (see :func:`resolve_rules`): depth 0 (overall rating) or the sub-rules."""
    rules = list(rules)
    depth = F.col("ruledepth") == 0 if overall else F.col("ruledepth") != 0
    return cointerp.filter(F.col("mrulename").isin(rules) & depth)


def filter_reason(cointerp_sub: DataFrame, case_sensitive: bool = False) -> DataFrame:
    """Sub-rule rows that carry a reason: class not starting with 'Not'."""
    return cointerp_sub.filter(not_like("interphrc", "Not%", case_sensitive))


def filter_reason_components(component: DataFrame, case_sensitive: bool = False) -> DataFrame:
    """Components that may give reasons: not a miscellaneous area (NULL kind dropped)."""
    return component.filter(text_ne("compkind", "miscellaneous area", case_sensitive))
