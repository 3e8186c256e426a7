"""Registered queries.

``PLANS[name](tables)`` builds the query over a tables object (attributes
``legend, mapunit, component, ...`` plus ``report_lines(form)`` and
``catalog_lines()``): either the in-plan fixture derived from the driver
tables (``SoilFixture``) or stored soil tables (``SoilTables``).
``QUERIES[name](spark, sf_dir)`` binds a plan to the fixture of ``sf_dir``,
so every query reads the given tables and its work grows with them.
Parameters (depth range, property codes, rule names) are fixed per query,
as a user of the batch tools would set them.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loam.functions.text import unescape_entities
from loam.operators import aoi as A
from loam.operators import bookkeeping as B
from loam.operators import interps as I
from loam.operators import properties as P
from loam.operators import reports as R
from loam.operators import summaries as S
from loam.operators.filters import filter_area, filter_mukeys, requested_areas, resolve_rules, restrict_to_mapunits
from loam.operators.joins import mapunit_frame, polygon_attribute_join, polygon_extract
from loam.session import ensure_checkpoint_dir, stored
from loam.sources import reports as RS
from loam.sources.catalog import catalog_frame, property_catalog, resolve_property
from loam.sources.fixtures import SoilFixture
from loam.sources.rejects import all_rejects, report_channel
from loam.sources.soil_tables import read_soil_tables, write_soil_tables

QueryFn = Callable[[SparkSession, str], DataFrame]
PlanFn = Callable[[object], DataFrame]

TOP, BOTTOM = 0, 100
MULTI_PROPS = ["claytotal_r", "om_r"]
COMPONENT_PROPS = ["drainagecl", "hydgrp", "tfact"]
CATALOG_LABELS = ["Total Sand - Rep Value", "Hydrologic Group"]
RULE_NAMES = ["ENG - Dwellings", "AGR - Corn Suitability"]
RULE_REQUEST = "eng - dwell%; No Such Rule"
AREA_REQUEST = "nc00%; NC021; zz999"
COVERAGE_AREAS = "NC001; nc003; NC01%; ZZ999"
COVERAGE_PATTERNS = "nc01_; ZZ%; XX___; zz999"
GRID_CELL = 25.0


def _mu(t) -> DataFrame:
    return mapunit_frame(t.legend, t.mapunit)


# ---- properties ---------------------------------------------------------------
def p_prop_dom_comp_cat(t):
    return P.prop_dom_comp_cat(_mu(t), t.component, "drainagecl")


def p_prop_dom_cond(t):
    return P.prop_dom_cond(_mu(t), t.component, "drainagecl")


def p_prop_weighted_avg(t):
    return P.prop_weighted_avg(_mu(t), t.component, t.chorizon, t.chtexturegrp, "claytotal_r", TOP, BOTTOM)


def p_prop_dom_comp_num(t):
    return P.prop_dom_comp_num(_mu(t), t.component, t.chorizon, t.chtexturegrp, "claytotal_r", TOP, BOTTOM)


def p_prop_min(t):
    return P.prop_min_max(_mu(t), t.component, t.chorizon, "claytotal_r", "MIN")


def p_prop_max(t):
    return P.prop_min_max(_mu(t), t.component, t.chorizon, "om_r", "MAX")


def p_prop_multi(t):
    return P.prop_multi("Weighted Average", _mu(t), t.component, t.chorizon, t.chtexturegrp, MULTI_PROPS, 0, 50)


def p_prop_multi_dom_comp(t):
    return P.prop_multi("Dominant Component (Category)", _mu(t), t.component, t.chorizon, t.chtexturegrp,
                        COMPONENT_PROPS)


def p_prop_multi_dom_comp_num(t):
    return P.prop_multi("Dominant Component (Numeric)", _mu(t), t.component, t.chorizon, t.chtexturegrp,
                        MULTI_PROPS, 0, 50)


def p_prop_multi_dom_cond(t):
    return P.prop_multi("Dominant Condition", _mu(t), t.component, t.chorizon, t.chtexturegrp, COMPONENT_PROPS)


def p_prop_multi_min_max(t):
    return P.prop_multi("Min\\Max", _mu(t), t.component, t.chorizon, t.chtexturegrp, MULTI_PROPS, stat="MIN")


def p_prop_catalog_any(t):
    """Properties looked up by label: a horizon one by weighted average, a component one by dominant component."""
    asked = t.legend.sparkSession.createDataFrame([(lab,) for lab in CATALOG_LABELS], "label string")
    spark = asked.sparkSession
    code = {r.label: r.code for r in resolve_property(asked, catalog_frame(spark)).collect()}
    horizon, comp = (code[lab] for lab in CATALOG_LABELS)
    wide = P.prop_weighted_avg(_mu(t), t.component, t.chorizon, t.chtexturegrp, horizon, TOP, BOTTOM)
    cat = P.prop_dom_comp_cat(_mu(t), t.component, comp).select("mukey", comp)
    return wide.join(cat, "mukey", "left").select(*P.KEY_COLS, horizon, comp)


def p_filter_area_like(t):
    """Areas by pattern and by name, any case; and a name that no area has."""
    return filter_area(t.legend, AREA_REQUEST).select("lkey", "areasymbol")


# ---- interpretations ------------------------------------------------------------
def p_interp_dom_comp(t):
    return I.interp_dom_comp(_mu(t), t.component, t.cointerp, RULE_NAMES)


def p_interp_dom_cond(t):
    return I.interp_dom_cond(_mu(t), t.component, t.cointerp, RULE_NAMES)


def p_interp_weighted_avg(t):
    return I.interp_weighted_avg(_mu(t), t.component, t.cointerp, RULE_NAMES)


def p_interp_rule_like(t):
    """Rules by LIKE pattern, any case."""
    return I.interp_weighted_avg(_mu(t), t.component, t.cointerp, resolve_rules(t.cointerp, RULE_REQUEST))


def p_interp_reasons_all(t):
    return I.interp_reasons_all(t.component, t.cointerp, RULE_NAMES)


def p_reasons_unescaped(t):
    """Reason lists as the AOI tool writes them: escaped by the service, undone here."""
    reasons = I.interp_reasons_all(t.component, t.cointerp, RULE_NAMES)
    escaped = F.replace(F.replace("reason", F.lit("&"), F.lit("&amp;")), F.lit("-"), F.lit("&lt;-&gt;"))
    return reasons.withColumn("escaped", escaped).select("mukey", "mrulename", "escaped", unescape_entities("escaped").alias("reason"))


# ---- map-unit summaries -----------------------------------------------------------
def p_hydric_counts(t):
    return S.hydric_counts(_mu(t), t.component)


def p_hydric_rating(t):
    return S.hydric_rating(_mu(t), t.component)


def p_stored_hydric_rating(t):
    """Soil tables written and read again, rolled up, the result written and read again."""
    spark = t.legend.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/loam-stored-{uuid.uuid4().hex}"
    names = ("legend", "mapunit", "component")
    write_soil_tables({n: getattr(t, n) for n in names}, path, by_area=True)
    stored = read_soil_tables(spark, path, names)
    rated = S.hydric_rating(mapunit_frame(stored["legend"], stored["mapunit"]), stored["component"])
    B.write_result(rated, path + "/result")
    return spark.read.schema(rated.schema).parquet(path + "/result")


def p_parent_material(t):
    return S.parent_material(_mu(t), t.component, t.copmgrp, general=False)


def p_parent_material_general(t):
    return S.parent_material(_mu(t), t.component, t.copmgrp, general=True)


def p_muaggatt_extract(t):
    return S.muaggatt_extract(_mu(t), t.muaggatt)


# ---- text reports -------------------------------------------------------------------
def _project_framed(t):
    return RS.report_extract(t.report_lines("project"))


def _area_framed(t):
    return RS.report_extract(t.report_lines("area"), min_lines=2)


def p_report_extract(t):
    return _project_framed(t)


def p_report_merge_ratings(t):
    return R.merge_ratings_wide(RS.report_parse_project_wide(_project_framed(t)))


def p_report_rejects(t):
    return R.drop_malformed(_project_framed(t))


def p_report_rejects_area(t):
    """Lines of area reports that their parse leaves out, the header among them."""
    return R.drop_malformed(_area_framed(t), "area")


def p_reject_channel(t):
    """Rejects of both report forms in one table."""
    return all_rejects(report_channel(R.drop_malformed(_project_framed(t)), "project"),
                       report_channel(R.drop_malformed(_area_framed(t), "area"), "area"))


def p_report_parse_area(t):
    return RS.report_parse_area(_area_framed(t))


def p_report_parse_area_batch(t):
    return RS.report_parse_area_batch(_area_framed(t))


def p_report_single_kind(t):
    return R.single_kind(_area_framed(t))


def p_report_key_reconcile(t):
    keys = RS.report_parse_area(_area_framed(t)).withColumnRenamed("report_id", "areasymbol")
    return R.key_reconcile(keys, t.mupolygon)


# ---- area of interest ---------------------------------------------------------------------
def _clipped(t):
    return A.aoi_clip(t.mupolygon, t.aoi_points, GRID_CELL)


def p_aoi_ring(t):
    return A.aoi_ring(t.aoi_points)


def p_aoi_clip(t):
    return _clipped(t)


def p_aoi_clip_holes(t):
    """Polygons with holes and parts against a triangle or an L per AOI."""
    return A.aoi_clip(t.mupolygon_shapes, t.aoi_shapes, GRID_CELL, single_part=False).select(
        "aoi_id", "poly_id", "mukey", "areasymbol", "area")


def _aoi_keys(t):
    """The key list, found once for all the branches of a rollup that it selects."""
    return stored(A.aoi_keys(t.mupolygon, t.aoi_points, GRID_CELL))


def _aoi_tables(t, child=None):
    """(map units, components, child rows) inside any AOI.

    Map units and components are stored: each is found in one pass, and small
    ones are broadcast to the child tables, which are then cut before any shuffle.
    """
    mus = stored(filter_mukeys(_mu(t), _aoi_keys(t)))
    comps = stored(restrict_to_mapunits(mus, t.component)[0])
    kids = [getattr(t, child).join(comps.select("cokey"), "cokey", "left_semi")] if child else []
    return (mus, comps, *kids)


def p_aoi_clip_dropped(t):
    """What the clip to one part leaves out: the pairs whose clip falls into several parts."""
    return A.aoi_clip_dropped(t.mupolygon_shapes, t.aoi_shapes, GRID_CELL)


def p_aoi_mukeys(t):
    return _aoi_keys(t)


def p_aoi_prop_weighted_avg(t):
    """The AOI property tool: weighted average for the map units inside any AOI."""
    mus, comps, hz = _aoi_tables(t, child="chorizon")
    return P.prop_weighted_avg(mus, comps, hz, t.chtexturegrp, "claytotal_r", TOP, BOTTOM, selected=True)


def p_aoi_prop_dom_cond(t):
    """The AOI property tool: dominant condition."""
    mus, comps = _aoi_tables(t)
    return P.prop_dom_cond(mus, comps, "drainagecl")


def p_aoi_prop_dom_comp(t):
    """The AOI property tool: dominant component."""
    mus, comps = _aoi_tables(t)
    return P.prop_dom_comp_cat(mus, comps, "drainagecl")


def p_aoi_prop_min(t):
    """The AOI property tool: profile minimum."""
    mus, comps, hz = _aoi_tables(t, child="chorizon")
    return P.prop_min_max(mus, comps, hz, "claytotal_r", "MIN")


def p_aoi_prop_multi(t):
    """The AOI property tool: weighted averages of several properties."""
    mus, comps, hz = _aoi_tables(t, child="chorizon")
    return P.prop_multi("Weighted Average", mus, comps, hz, t.chtexturegrp, MULTI_PROPS, 0, 50, selected=True)


def p_aoi_interp_dom_cond(t):
    """The AOI interpretation tool: dominant condition, both rules."""
    mus, comps, ci = _aoi_tables(t, child="cointerp")
    return I.interp_dom_cond(mus, comps, ci, RULE_NAMES)


def p_aoi_interp_dom_comp(t):
    """The AOI interpretation tool: dominant component, both rules."""
    mus, comps, ci = _aoi_tables(t, child="cointerp")
    return I.interp_dom_comp(mus, comps, ci, RULE_NAMES)


def p_aoi_interp_weighted_avg(t):
    """The AOI interpretation tool: weighted average, both rules."""
    mus, comps, ci = _aoi_tables(t, child="cointerp")
    return I.interp_weighted_avg(mus, comps, ci, RULE_NAMES)


# ---- bookkeeping ----------------------------------------------------------------------------
def p_coverage_report(t):
    parsed = RS.report_parse_area(_area_framed(t)).withColumnRenamed("report_id", "areasymbol")
    return B.coverage_report(t.sacatalog, ["area report"], parsed, "request")


def p_coverage_requests(t):
    """Areas as a user lists them (any case, one unknown) without a parsed area report."""
    parsed = RS.report_parse_area(_area_framed(t)).withColumnRenamed("report_id", "areasymbol")
    return B.coverage_report(requested_areas(t.legend, COVERAGE_AREAS), ["area report"], parsed, "request")


def p_coverage_patterns(t):
    """Areas asked for by pattern: those without a parsed report, and patterns that match no area."""
    parsed = RS.report_parse_area(_area_framed(t)).withColumnRenamed("report_id", "areasymbol")
    return B.coverage_report(requested_areas(t.legend, COVERAGE_PATTERNS), ["area report"], parsed, "request")


def p_legend_breaks_numeric(t):
    return B.legend_breaks(p_prop_weighted_avg(t), "claytotal_r")


def p_legend_breaks_text(t):
    return B.legend_breaks(p_interp_weighted_avg(t), "class")


def p_sample_features(t):
    return B.sample_features(_mu(t), "int_mukey", 50)


def p_dedupe_last(t):
    rows = p_report_parse_area_batch(t).select(
        F.col("str_mukey").alias("mukey"), "line_no", "report_id", "rating", "class", "kind")
    return B.dedupe_last(rows, "mukey", "line_no")


def p_property_catalog(t):
    return property_catalog(t.catalog_lines())


def p_polygon_attribute_join(t):
    return polygon_attribute_join(t.mupolygon, S.hydric_rating(_mu(t), t.component))


def p_polygon_extract(t):
    return polygon_extract(t.mupolygon, p_report_merge_ratings(t))


PLANS: dict[str, PlanFn] = {
    "prop_dom_comp_cat": p_prop_dom_comp_cat,
    "prop_dom_cond": p_prop_dom_cond,
    "prop_weighted_avg": p_prop_weighted_avg,
    "prop_dom_comp_num": p_prop_dom_comp_num,
    "prop_min": p_prop_min,
    "prop_max": p_prop_max,
    "prop_multi": p_prop_multi,
    "prop_multi_dom_comp": p_prop_multi_dom_comp,
    "prop_multi_dom_comp_num": p_prop_multi_dom_comp_num,
    "prop_multi_dom_cond": p_prop_multi_dom_cond,
    "prop_multi_min_max": p_prop_multi_min_max,
    "prop_catalog_any": p_prop_catalog_any,
    "filter_area_like": p_filter_area_like,
    "interp_rule_like": p_interp_rule_like,
    "interp_dom_comp": p_interp_dom_comp,
    "interp_dom_cond": p_interp_dom_cond,
    "interp_weighted_avg": p_interp_weighted_avg,
    "interp_reasons_all": p_interp_reasons_all,
    "reasons_unescaped": p_reasons_unescaped,
    "hydric_counts": p_hydric_counts,
    "hydric_rating": p_hydric_rating,
    "stored_hydric_rating": p_stored_hydric_rating,
    "parent_material": p_parent_material,
    "parent_material_general": p_parent_material_general,
    "muaggatt_extract": p_muaggatt_extract,
    "report_extract": p_report_extract,
    "report_merge_ratings": p_report_merge_ratings,
    "report_rejects": p_report_rejects,
    "report_rejects_area": p_report_rejects_area,
    "reject_channel": p_reject_channel,
    "report_parse_area": p_report_parse_area,
    "report_parse_area_batch": p_report_parse_area_batch,
    "report_single_kind": p_report_single_kind,
    "report_key_reconcile": p_report_key_reconcile,
    "aoi_ring": p_aoi_ring,
    "aoi_clip": p_aoi_clip,
    "aoi_mukeys": p_aoi_mukeys,
    "aoi_clip_holes": p_aoi_clip_holes,
    "aoi_clip_dropped": p_aoi_clip_dropped,
    "aoi_prop_dom_cond": p_aoi_prop_dom_cond,
    "aoi_prop_dom_comp": p_aoi_prop_dom_comp,
    "aoi_prop_min": p_aoi_prop_min,
    "aoi_prop_multi": p_aoi_prop_multi,
    "aoi_interp_dom_cond": p_aoi_interp_dom_cond,
    "aoi_interp_dom_comp": p_aoi_interp_dom_comp,
    "aoi_interp_weighted_avg": p_aoi_interp_weighted_avg,
    "coverage_requests": p_coverage_requests,
    "coverage_patterns": p_coverage_patterns,
    "aoi_prop_weighted_avg": p_aoi_prop_weighted_avg,
    "coverage_report": p_coverage_report,
    "legend_breaks_numeric": p_legend_breaks_numeric,
    "legend_breaks_text": p_legend_breaks_text,
    "sample_features": p_sample_features,
    "dedupe_last": p_dedupe_last,
    "property_catalog": p_property_catalog,
    "polygon_attribute_join": p_polygon_attribute_join,
    "polygon_extract": p_polygon_extract,
}


def _bind(plan: PlanFn) -> QueryFn:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plan(SoilFixture(spark, sf_dir))

    query.__name__ = "q_" + plan.__name__[2:]
    query.__doc__ = plan.__doc__
    return query


QUERIES: dict[str, QueryFn] = {name: _bind(plan) for name, plan in PLANS.items()}
q_prop_weighted_avg = QUERIES["prop_weighted_avg"]
