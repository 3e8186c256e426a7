"""Batch tools: many properties or rules for many survey areas, one table per request.

The reference runs one remote query per area x property (or rule).  Here a
tool call is one Spark plan over all requested areas and requests: the wide
(or all-rules) result is checkpointed once into the shared checkpoint folder,
and each request's table is a projection of it.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loam.functions.text import report_rule_name, request_list, unescape_entities
from loam.operators import interps as I
from loam.operators import properties as P
from loam.operators import reports as R
from loam.operators import summaries as S
from loam.operators.aoi import DEFAULT_GRID_CELL, aoi_keys
from loam.operators.bookkeeping import coverage_report, table_name, unique_names, write_result
from loam.operators.filters import filter_area, filter_mukeys, requested_areas, resolve_rules, restrict_to_mapunits
from loam.operators.joins import mapunit_frame
from loam.session import materialize
from loam.sources import reports as RS
from loam.sources.catalog import PROPERTY_LABELS, catalog_frame, resolve_property

PROPERTY_METHODS = ["Dominant Component (Category)", "Dominant Component (Numeric)", "Dominant Condition",
                    "Weighted Average", "Min\\Max"]
INTERP_METHODS = ["Dominant Component", "Dominant Condition", "Weighted Average"]
INTERP_ROLLUPS = {"Dominant Component": I.interp_dom_comp, "Dominant Condition": I.interp_dom_cond,
                  "Weighted Average": I.interp_weighted_avg}


def resolve_labels(spark, labels: Sequence[str], catalog: DataFrame | None = None) -> list[tuple[str, str]]:
    """Request labels -> (label, code); an unknown label stops the tool, as in the reference.

    ``catalog`` is a table of labels and codes; by default the fixed catalogue.
    """
    if catalog is None:
        lookup = dict(PROPERTY_LABELS)
    else:
        asked = spark.createDataFrame([(lab,) for lab in dict.fromkeys(labels)], "label string")
        lookup = {r.label: r.code for r in resolve_property(asked, catalog).collect() if r.code is not None}
    unknown = [lab for lab in labels if lab not in lookup]
    if unknown:
        raise ValueError(f"unknown property label(s): {unknown}")
    return [(lab, lookup[lab]) for lab in labels]


def selected_tables(tables, areas=None, mukeys: DataFrame | Iterable[str] | None = None, child: str | None = None):
    """(map units, components, child rows) of a selection by areas or map-unit keys."""
    mu = filter_mukeys(mapunit_frame(filter_area(tables.legend, areas), tables.mapunit), mukeys)
    kids = [getattr(tables, child)] if child else []
    if areas is None and mukeys is None:
        return (mu, tables.component, *kids)
    return (mu, *restrict_to_mapunits(mu, tables.component, *kids))


def run_property_tool(tables, out_dir: str, labels: Sequence[str], method: str, top: int = 0, bottom: int = 100,
                      stat: str = "MIN", areas=None, mukeys=None, catalog: DataFrame | None = None) -> dict[str, str]:
    """Write one table per requested property; returns {label: path}. Also writes ``coverage``.

    All properties come from one plan; ``areas`` (names or LIKE patterns) or
    ``mukeys`` (an AOI's key list) select map units.
    """
    if method not in PROPERTY_METHODS:
        raise ValueError(f"unable to determine aggregation method: {method}")
    spark = tables.legend.sparkSession
    props = resolve_labels(spark, labels, catalog)
    mu, comp, hz = selected_tables(tables, areas, mukeys, "chorizon")
    codes = list(dict.fromkeys(c for _, c in props))
    wide = materialize(P.prop_multi(method, mu, comp, hz, tables.chtexturegrp, codes, top, bottom, stat,
                                    selected=areas is not None or mukeys is not None))
    names = unique_names(labels, [table_name(lab, method, top, bottom, stat) for lab in labels])
    paths = {}
    for label, code in props:
        paths[label] = f"{out_dir.rstrip('/')}/{names[label]}"
        write_result(wide.select(*P.KEY_COLS, code), paths[label])
    answered = wide.select("areasymbol", F.explode(F.array(*[F.lit(lab) for lab in labels])).alias("request"))
    _write_coverage(requested_areas(tables.legend, areas), list(labels), answered, out_dir)
    return paths


def run_interp_tool(tables, out_dir: str, rules: Sequence[str] | str, method: str, areas=None, mukeys=None,
                    reason_chars: int | None = None, unescape: bool | None = None) -> dict[str, str]:
    """Write one table per rule that the requests match (all in one plan); returns {rule: path}.

    ``rules`` is a list or ``;``-separated text of names or LIKE patterns.
    Requests that match no rule show in ``coverage`` for every area.  Reasons
    stay as they come for requests by area; for a key list (an AOI's) their
    XML entities are undone, unless ``unescape`` says otherwise.
    """
    if method not in INTERP_METHODS:
        raise ValueError(f"unable to determine aggregation method: {method}")
    asked = request_list(rules)
    found = resolve_rules(tables.cointerp, asked)
    mu, comp, ci = selected_tables(tables, areas, mukeys, "cointerp")
    wanted = found + [r for r in asked if not resolve_rules_matches(found, r)]
    paths: dict[str, str] = {}
    answered = None
    if found:
        plain = (mukeys is not None) if unescape is None else unescape
        allrules = INTERP_ROLLUPS[method](mu, comp, ci, found, reason_chars=reason_chars)
        allrules = materialize(allrules.withColumn("reason", unescape_entities("reason")) if plain else allrules)
        names = unique_names(found, [table_name(r, method) for r in found])
        for rule in found:
            paths[rule] = f"{out_dir.rstrip('/')}/{names[rule]}"
            write_result(allrules.filter(F.col("mrulename") == rule).drop("mrulename"), paths[rule])
        answered = allrules.select("areasymbol", F.col("mrulename").alias("request"))
    _write_coverage(requested_areas(tables.legend, areas), wanted, answered, out_dir)
    return paths


def resolve_rules_matches(found: Sequence[str], request: str) -> bool:
    """Whether a request (LIKE pattern, any case) matched one of the rules found."""
    pattern = "".join(".*" if c == "%" else "." if c == "_" else re.escape(c) for c in request)
    return any(re.fullmatch(pattern, r, re.IGNORECASE | re.DOTALL) for r in found)


def run_summary_tool(tables, out_dir: str, kind: str, areas=None, mukeys=None) -> str:
    """Write ``hydric``, ``parent_material``, ``parent_material_general`` or ``muaggatt`` for the selection; returns the path."""
    mu, comp = selected_tables(tables, areas, mukeys)
    if kind == "hydric":
        out = S.hydric_rating(mu, comp)
    elif kind in ("parent_material", "parent_material_general"):
        out = S.parent_material(mu, comp, tables.copmgrp, general=kind.endswith("general"))
    elif kind == "muaggatt":
        out = S.muaggatt_extract(mu, tables.muaggatt)
    else:
        raise ValueError(f"unknown summary: {kind}")
    path = f"{out_dir.rstrip('/')}/tbl_{kind}"
    write_result(out, path)
    answered = mu.select("areasymbol").distinct().withColumn("request", F.lit(kind))
    _write_coverage(requested_areas(tables.legend, areas), [kind], answered, out_dir)
    return path


def run_aoi_tool(tables, points: DataFrame, out_dir: str, requests: Sequence[str] | str, method: str, kind: str = "property",
                 grid_cell: float = DEFAULT_GRID_CELL, **options) -> dict[str, str]:
    """The AOI tools end to end: outline points in, one table per property label or rule out; returns {request: path}.

    The key list of the map units inside any AOI is found once from
    ``tables.mupolygon`` and written as ``aoi_mukeys``; ``kind`` is
    ``property`` or ``interp``, ``options`` go to that tool.
    """
    tools = {"property": run_property_tool, "interp": run_interp_tool}
    if kind not in tools:
        raise ValueError(f"unknown tool: {kind}")
    keys = materialize(aoi_keys(tables.mupolygon, points, grid_cell))
    write_result(keys, f"{out_dir.rstrip('/')}/aoi_mukeys")
    return tools[kind](tables, out_dir, requests, method, mukeys=keys.select("mukey"), **options)


def run_report_tool(lines: DataFrame, out_dir: str, rule: str, form: str = "area") -> dict[str, str]:
    """Write the ratings of report lines, the rejected lines and the coverage; returns {'ratings': path, 'rejects': path}.

    ``form`` is ``area`` (one kind of rating, the last line of a key wins),
    ``batch`` (the area form line by line, with a text key) or ``project``
    (both kinds merged per map unit); the table is named after the rule.
    ``coverage`` lists the reports without any rating.
    """
    name = table_name(report_rule_name(rule), "Dominant Condition") + "_rt"
    base = out_dir.rstrip("/")
    parse = {"project": lambda f: R.merge_ratings_wide(RS.report_parse_project_wide(f)), "area": RS.report_parse_area,
             "batch": RS.report_parse_area_batch}.get(form)
    if parse is None:
        raise ValueError(f"unknown report form: {form}")
    framed = RS.report_extract(lines, min_lines=None if form == "project" else 2)
    ratings = materialize(parse(framed))
    paths = {"ratings": f"{base}/{name}", "rejects": f"{base}/{name}_rejects"}
    write_result(ratings, paths["ratings"])
    write_result(R.drop_malformed(framed, "project" if form == "project" else "area"), paths["rejects"], "line_no")
    reports = lines.select(F.col("report_id").alias("areasymbol")).distinct()
    answered = ratings.select(F.col("report_id").alias("areasymbol"), F.lit(rule).alias("request"))
    _write_coverage(reports, [rule], answered, out_dir)
    return paths


def _write_coverage(areas: DataFrame, requests: list[str], answered: DataFrame | None, out_dir: str) -> None:
    if answered is None:
        answered = areas.select("areasymbol", F.lit("").alias("request")).limit(0)
    miss = coverage_report(areas, requests, answered, "request")
    miss.write.mode("overwrite").parquet(f"{out_dir.rstrip('/')}/coverage")


__all__ = ["catalog_frame", "resolve_labels", "run_aoi_tool", "run_interp_tool", "run_property_tool", "run_report_tool",
           "run_summary_tool", "selected_tables"]
