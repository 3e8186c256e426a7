"""Oracle SQL (DuckDB) for each registered query.

Written independently of the Spark operators: windows and QUALIFY where the
Spark side uses grouped aggregates, and exact scaled-integer arithmetic for
the decimal chain of the weighted rollups (half-up rounding at each cast:
ratio to 1e-8, weight to 1e-2, weight x mean to 1e-8, result to 1e-2).
"""

from __future__ import annotations

from loam.functions.parent_material import parent_material_case_sql
from loam.plans.fixture_sql import report_lines_sql, with_fixture
from loam.plans.registry import BOTTOM, MULTI_PROPS, RULE_NAMES, TOP

MU = (
    "SELECT l.areasymbol, m.musym, m.muname, m.mukey, CAST(m.mukey AS BIGINT) AS int_mukey "
    "FROM mapunit m JOIN legend l ON m.lkey = l.lkey"
)
MU_COLS = "mu.areasymbol, mu.musym, mu.muname, mu.mukey, mu.int_mukey"
TEXTURE_OK = " AND ".join(
    f"lower(x.texture) NOT LIKE '{p.lower()}'" for p in ["%PM%", "%DOM", "%MPT%", "%MUCK", "%PEAT%", "%br%", "%wb%"]
)


def _dom(cols: str = "") -> str:
    extra = (", " + cols) if cols else ""
    return (
        f"SELECT mukey, cokey{extra} FROM component "
        "QUALIFY row_number() OVER (PARTITION BY mukey ORDER BY comppct_r DESC NULLS LAST, cokey) = 1"
    )


def _weighted_sql(props: list[str], top: int, bottom: int, dominant_only: bool) -> str:
    vals = ", ".join(f"CAST(round(coalesce(h.{p}, 0) * 100) AS BIGINT) AS v_{p}" for p in props)
    sums = ", ".join(
        f"SUM(((2 * CAST(hz.t AS HUGEINT) * 100000000 + ct.tt) // (2 * ct.tt)) * hz.v_{p}) AS m_{p}" for p in props
    )
    tots = ", ".join(f"SUM((2 * CAST(wt.w AS HUGEINT) * cm.m_{p} + 10000) // 20000) AS ps_{p}" for p in props)
    res = ", ".join(f"CAST((2 * ps_{p} + 1000000) // 2000000 AS DOUBLE) / 100.0 AS {p}" for p in props)
    out = ", ".join(f"res.{p}" for p in props)
    if dominant_only:
        comps = f"SELECT d.mukey, d.cokey, d.comppct_r FROM ({_dom('comppct_r, majcompflag')}) d " \
                "WHERE lower(d.majcompflag) = 'yes'"
    else:
        comps = "SELECT mukey, cokey, comppct_r FROM component WHERE lower(majcompflag) = 'yes'"
    ctes = [
        ("mu", MU),
        ("mj", f"SELECT mukey, cokey, comppct_r AS p, SUM(comppct_r) OVER (PARTITION BY mukey) AS s FROM ({comps})"),
        ("wt", "SELECT mukey, cokey, CASE WHEN p = s THEN 100 "
               "ELSE (2 * ((2 * CAST(p AS HUGEINT) * 100000000 + s) // (2 * s)) + 1000000) // 2000000 END AS w "
               "FROM mj"),
        ("hz", f"SELECT h.cokey, (CASE WHEN h.hzdepb_r > {bottom} THEN {bottom} ELSE h.hzdepb_r END) - "
               f"(CASE WHEN h.hzdept_r < {top} THEN {top} ELSE h.hzdept_r END) AS t, {vals} "
               "FROM chorizon h JOIN chtexturegrp x ON h.chkey = x.chkey "
               f"WHERE lower(x.rvindicator) = 'yes' AND {TEXTURE_OK} "
               "AND lower(h.hzname) NOT LIKE '%o%' AND lower(h.hzname) NOT LIKE '%r%' "
               f"AND h.hzdepb_r > {top} AND h.hzdept_r < {bottom} AND h.hzdept_r IS NOT NULL"),
        ("ct", "SELECT cokey, SUM(t) AS tt FROM hz GROUP BY cokey"),
        ("cm", f"SELECT hz.cokey, {sums} FROM hz JOIN ct USING (cokey) GROUP BY hz.cokey"),
        ("tot", f"SELECT wt.mukey, {tots} FROM wt JOIN cm USING (cokey) GROUP BY wt.mukey"),
        ("res", f"SELECT mukey, {res} FROM tot"),
    ]
    sql = f"SELECT {MU_COLS}, {out} FROM mu LEFT JOIN res USING (mukey)"
    return with_fixture(sql, ["mapunit", "legend", "component", "chorizon", "chtexturegrp"], ctes)


def _prop_dom_comp_cat() -> str:
    sql = f"SELECT {MU_COLS}, dom.drainagecl FROM mu JOIN dom USING (mukey)"
    return with_fixture(sql, ["mapunit", "legend", "component"], [("mu", MU), ("dom", _dom("drainagecl"))])


def _prop_dom_cond() -> str:
    ctes = [
        ("mu", MU),
        ("pv", "SELECT mukey, drainagecl AS v, SUM(DISTINCT comppct_r) AS s FROM component GROUP BY mukey, drainagecl"),
        ("best", "SELECT mukey, v FROM pv QUALIFY row_number() OVER "
                 "(PARTITION BY mukey ORDER BY s DESC NULLS LAST, v ASC NULLS LAST) = 1"),
    ]
    sql = f"SELECT {MU_COLS}, best.v AS drainagecl FROM mu JOIN best USING (mukey)"
    return with_fixture(sql, ["mapunit", "legend", "component"], ctes)


def _prop_min_max(prop: str, stat: str) -> str:
    ctes = [
        ("mu", MU),
        ("dom", _dom()),
        ("pc", f"SELECT cokey, {stat}({prop}) AS v FROM chorizon WHERE CASE "
               "WHEN lower(hzname) LIKE '%o%' AND hzdept_r < 10 THEN 2 WHEN lower(hzname) LIKE '%r%' THEN 2 "
               "ELSE 1 END = 1 GROUP BY cokey"),
    ]
    sql = f"SELECT {MU_COLS}, pc.v AS {prop} FROM mu JOIN dom USING (mukey) LEFT JOIN pc USING (cokey)"
    return with_fixture(sql, ["mapunit", "legend", "component", "chorizon"], ctes)


RULES_IN = "(" + ", ".join(f"'{r}'" for r in RULE_NAMES) + ")"
RULES_LIST = "[" + ", ".join(f"'{r}'" for r in RULE_NAMES) + "]"
ROUND2 = "floor(({x}) * 100.0 + 0.5 + 1e-9) / 100.0"
INTERP_TABLES = ["mapunit", "legend", "component", "cointerp"]


def _reasons_dominant_cte() -> str:
    return (
        "SELECT mukey, mrulename, string_agg(interphrc, '; ' ORDER BY interphr DESC NULLS LAST, "
        "interphrc) AS reason FROM (SELECT DISTINCT dom.mukey, ci.mrulename, ci.interphrc, ci.interphr "
        "FROM dom JOIN component c ON c.cokey = dom.cokey JOIN cointerp ci ON ci.cokey = dom.cokey "
        "WHERE lower(c.compkind) != 'miscellaneous area' AND ci.ruledepth != 0 "
        f"AND lower(ci.interphrc) NOT LIKE 'not%' AND ci.mrulename IN {RULES_IN}) GROUP BY mukey, mrulename"
    )


def _reasons_all_cte() -> str:
    return (
        "SELECT mukey, mrulename, string_agg(interphrc, '; ' ORDER BY interphrc) AS reason "
        "FROM (SELECT DISTINCT c.mukey, ci.mrulename, ci.interphrc FROM component c "
        "JOIN cointerp ci ON ci.cokey = c.cokey WHERE lower(c.compkind) != 'miscellaneous area' "
        f"AND ci.ruledepth != 0 AND lower(ci.interphrc) NOT LIKE 'not%' AND ci.mrulename IN {RULES_IN}) "
        "GROUP BY mukey, mrulename"
    )


def _interp_dom_comp() -> str:
    ctes = [
        ("dom!", _dom("compkind")),
        ("d0!", f"SELECT cokey, mrulename, interphr, interphrc FROM cointerp WHERE ruledepth = 0 "
                f"AND mrulename IN {RULES_IN}"),
        ("sub!", "SELECT cokey, mrulename, interphr, interphrc FROM cointerp WHERE ruledepth != 0 "
                 f"AND lower(interphrc) NOT LIKE 'not%' AND mrulename IN {RULES_IN}"),
        ("rd!", "SELECT mukey, mrulename, string_agg(interphrc, '; ' ORDER BY interphr DESC NULLS LAST, interphrc) AS reason "
                "FROM (SELECT DISTINCT dom.mukey, sub.mrulename, sub.interphrc, sub.interphr FROM sub JOIN dom USING (cokey) "
                "WHERE lower(dom.compkind) != 'miscellaneous area') GROUP BY mukey, mrulename"),
        ("mu!", f"SELECT *, unnest({RULES_LIST}) AS mrulename FROM ({MU})"),
    ]
    sql = (
        f"SELECT {MU_COLS}, mu.mrulename, d0.interphr AS rating, d0.interphrc AS \"class\", rd.reason "
        "FROM mu JOIN dom ON dom.mukey = mu.mukey "
        "LEFT JOIN d0 ON d0.cokey = dom.cokey AND d0.mrulename = mu.mrulename "
        "LEFT JOIN rd ON rd.mukey = mu.mukey AND rd.mrulename = mu.mrulename"
    )
    return with_fixture(sql, INTERP_TABLES, ctes)


def _interp_dom_cond() -> str:
    rows = (f"SELECT c.mukey, c.comppct_r, ci.mrulename, ci.interphr, ci.interphrc FROM cointerp ci "
            f"JOIN component c ON c.cokey = ci.cokey WHERE ci.ruledepth = 0 AND ci.mrulename IN {RULES_IN}")
    ctes = [
        ("mu", MU), ("dom", _dom()), ("rws", rows),
        ("grp", "SELECT mukey, mrulename, interphrc, interphr, SUM(comppct_r) AS s FROM rws "
                "GROUP BY mukey, mrulename, interphrc, interphr"),
        ("rt", "SELECT mukey, mrulename, " + ROUND2.format(x="cavg") + " AS rating FROM ("
               "SELECT mukey, mrulename, AVG(interphr) OVER (PARTITION BY mukey, mrulename, interphrc) AS cavg, "
               "s, interphr, interphrc FROM grp) QUALIFY row_number() OVER (PARTITION BY mukey, mrulename "
               "ORDER BY s DESC NULLS LAST, interphr ASC NULLS LAST, interphrc ASC NULLS LAST) = 1"),
        ("cl", "SELECT mukey, mrulename, interphrc AS cls FROM (SELECT mukey, mrulename, interphrc, "
               "SUM(DISTINCT comppct_r) AS cs FROM rws GROUP BY mukey, mrulename, interphrc) "
               "QUALIFY row_number() OVER (PARTITION BY mukey, mrulename ORDER BY cs DESC NULLS LAST, "
               "interphrc ASC NULLS LAST) = 1"),
        ("rules", f"SELECT unnest({RULES_LIST}) AS mrulename"),
        ("rd", _reasons_dominant_cte()),
    ]
    sql = (
        f"SELECT {MU_COLS}, r.mrulename, rt.rating, cl.cls AS \"class\", rd.reason "
        "FROM mu JOIN dom ON dom.mukey = mu.mukey CROSS JOIN rules r "
        "LEFT JOIN rt ON rt.mukey = mu.mukey AND rt.mrulename = r.mrulename "
        "LEFT JOIN cl ON cl.mukey = mu.mukey AND cl.mrulename = r.mrulename "
        "LEFT JOIN rd ON rd.mukey = mu.mukey AND rd.mrulename = r.mrulename"
    )
    return with_fixture(sql, INTERP_TABLES, ctes)


def _band_sql(ratio: str, design: str) -> str:
    from loam.functions.interp_bins import LIMITATION_LABELS, SUITABILITY_LABELS

    parts = []
    for name, labels in (("suitability", SUITABILITY_LABELS), ("limitation", LIMITATION_LABELS)):
        d = f"{design} = '{name}'"
        parts += [
            f"WHEN {d} AND {ratio} <= 0 THEN '{labels[0]}'",
            f"WHEN {d} AND {ratio} > 0.001 AND {ratio} <= 0.333 THEN '{labels[1]}'",
            f"WHEN {d} AND {ratio} > 0.334 AND {ratio} <= 0.666 THEN '{labels[2]}'",
            f"WHEN {d} AND {ratio} > 0.667 AND {ratio} <= 0.999 THEN '{labels[3]}'",
            f"WHEN {d} AND {ratio} = 1 THEN '{labels[4]}'",
        ]
    return " ".join(parts)


def _interp_weighted_avg() -> str:
    ctes = [
        ("mu", MU),
        ("agg", "SELECT c.mukey, ci.mrulename, " + ROUND2.format(x="SUM(ci.interphr * c.comppct_r)") + " AS rr, "
                + ROUND2.format(x="SUM(CASE WHEN ci.interphr IS NOT NULL THEN c.comppct_r END)") + " AS sc, "
                "CASE MIN(ci.ruledesign) WHEN 1 THEN 'limitation' WHEN 2 THEN 'suitability' END AS design "
                "FROM cointerp ci JOIN component c ON c.cokey = ci.cokey "
                f"WHERE ci.ruledepth = 0 AND ci.mrulename IN {RULES_IN} GROUP BY c.mukey, ci.mrulename"),
        ("sc2", "SELECT mukey, mrulename, rr, design, CASE WHEN sc = 0 THEN NULL ELSE "
                + ROUND2.format(x="rr / sc") + " END AS ratio FROM agg"),
        ("rules", f"SELECT unnest({RULES_LIST}) AS mrulename"),
        ("ra", _reasons_all_cte()),
    ]
    cls = "CASE WHEN sc2.rr IS NULL THEN 'Not Rated' " + _band_sql("sc2.ratio", "sc2.design") + " END"
    sql = (
        f"SELECT {MU_COLS}, r.mrulename, coalesce(sc2.ratio, 99.0) AS rating, {cls} AS \"class\", ra.reason "
        "FROM mu JOIN (SELECT DISTINCT mukey FROM component) hc ON hc.mukey = mu.mukey CROSS JOIN rules r "
        "LEFT JOIN sc2 ON sc2.mukey = mu.mukey AND sc2.mrulename = r.mrulename "
        "LEFT JOIN ra ON ra.mukey = mu.mukey AND ra.mrulename = r.mrulename"
    )
    return with_fixture(sql, INTERP_TABLES, ctes)


def _interp_reasons_all() -> str:
    return with_fixture("SELECT mukey, mrulename, reason FROM ra", ["component", "cointerp"],
                        [("ra", _reasons_all_cte())])


def _reasons_unescaped() -> str:
    return with_fixture("SELECT mukey, mrulename, replace(replace(reason, '&', '&amp;'), '-', '&lt;-&gt;') AS escaped, "
                        "replace(reason, '-', '<->') AS reason FROM ra", ["component", "cointerp"], [("ra", _reasons_all_cte())])


HYDRIC_COUNTS_SQL = (
    "SELECT mukey, COUNT(*) AS comp_count, "
    "COUNT(*) FILTER (WHERE lower(majcompflag) = 'yes') AS count_maj_comp, "
    "COUNT(*) FILTER (WHERE lower(hydricrating) = 'yes') AS all_hydric, "
    "COUNT(*) FILTER (WHERE lower(majcompflag) = 'yes' AND lower(hydricrating) = 'yes') AS maj_hydric, "
    "COUNT(*) FILTER (WHERE lower(majcompflag) = 'yes' AND lower(hydricrating) != 'yes') AS maj_not_hydric, "
    "COUNT(*) FILTER (WHERE lower(majcompflag) != 'yes' AND lower(hydricrating) = 'yes') AS hydric_inclusions, "
    "COUNT(*) FILTER (WHERE lower(hydricrating) != 'yes') AS all_not_hydric, "
    "COUNT(*) FILTER (WHERE hydricrating IS NULL) AS hydric_null FROM component GROUP BY mukey"
)
HC_COLS = ["comp_count", "count_maj_comp", "all_hydric", "maj_hydric", "maj_not_hydric", "hydric_inclusions",
           "all_not_hydric", "hydric_null"]


def _hydric_counts() -> str:
    cols = ", ".join(f"coalesce(hc.{c}, 0) AS {c}" for c in HC_COLS)
    sql = f"SELECT {MU_COLS}, {cols} FROM mu LEFT JOIN hc USING (mukey)"
    return with_fixture(sql, ["mapunit", "legend", "component"], [("mu", MU), ("hc", HYDRIC_COUNTS_SQL)])


def _hydric_rating() -> str:
    cols = ", ".join(f"coalesce(hc.{c}, 0) AS {c}" for c in HC_COLS)
    rating = (
        "CASE WHEN comp_count = all_not_hydric + hydric_null THEN 'Nonhydric' "
        "WHEN comp_count = all_hydric THEN 'Hydric' "
        "WHEN comp_count != all_hydric AND count_maj_comp = maj_hydric THEN 'Predominantly Hydric' "
        "WHEN hydric_inclusions >= 0.5 AND maj_hydric < 0.5 THEN 'Predominantly Nonhydric' "
        "WHEN maj_not_hydric >= 0.5 AND maj_hydric >= 0.5 THEN 'Partially Hydric' ELSE 'Error' END"
    )
    sql = (f"SELECT areasymbol, musym, muname, mukey, int_mukey, {rating} AS hydric_rating FROM "
           f"(SELECT {MU_COLS}, {cols} FROM mu LEFT JOIN hc USING (mukey))")
    return with_fixture(sql, ["mapunit", "legend", "component"], [("mu", MU), ("hc", HYDRIC_COUNTS_SQL)])


def _parent_material(general: bool) -> str:
    name = parent_material_case_sql("pm.pmgroupname") if general else "pm.pmgroupname"
    ctes = [
        ("mu", MU), ("dom", _dom("compname, comppct_r")),
        ("pm", "SELECT cokey, pmgroupname FROM copmgrp "
               "QUALIFY row_number() OVER (PARTITION BY cokey ORDER BY pmgroupname ASC NULLS LAST) = 1"),
    ]
    sql = (f"SELECT {MU_COLS}, dom.compname, dom.comppct_r, {name} AS pmgroupname "
           "FROM mu JOIN dom ON dom.mukey = mu.mukey JOIN pm ON pm.cokey = dom.cokey")
    return with_fixture(sql, ["mapunit", "legend", "component", "copmgrp"], ctes)


def _muaggatt_extract() -> str:
    from loam.schemas import MUAGGATT_COLUMNS, MUAGGATT_FLOAT, MUAGGATT_INT

    cols = []
    for c in MUAGGATT_COLUMNS:
        if c == "mukey":
            cols.append("a.mukey")
        elif c in MUAGGATT_FLOAT:
            cols.append(f"TRY_CAST(a.{c} AS DOUBLE) AS {c}")
        elif c in MUAGGATT_INT:
            cols.append(f"TRY_CAST(a.{c} AS INTEGER) AS {c}")
        else:
            cols.append(f"nullif(a.{c}, '') AS {c}")
    sql = (f"SELECT {', '.join(cols)} FROM mapunit m JOIN legend l ON m.lkey = l.lkey "
           "JOIN muaggatt a ON a.mukey = m.mukey")
    return with_fixture(sql, ["mapunit", "legend", "muaggatt"])


PROJECT_RE = r"^([^|]*)\|([^|]*)\|([^|]*)\|([^|]*)\|([^|]*)\|(.*)$"


def _framed_ctes(form: str, min_lines: int = 0) -> list[tuple[str, str]]:
    ctes = [
        ("rl", report_lines_sql(form)),
        ("t", r"SELECT report_id, line_no, regexp_replace(line, '^\s+|\s+$', '', 'g') AS line FROM rl"),
        ("t1", "SELECT *, MIN(CASE WHEN line LIKE '%START%' THEN line_no END) OVER (PARTITION BY report_id) AS s "
               "FROM t"),
        ("t2", "SELECT *, MIN(CASE WHEN line = 'STOP' AND line_no > s THEN line_no END) "
               "OVER (PARTITION BY report_id) AS e FROM t1"),
        ("fr0", "SELECT report_id, line_no, line FROM t2 WHERE s IS NOT NULL AND line_no > s "
                "AND (e IS NULL OR line_no < e)"),
    ]
    if min_lines:
        ctes.append(("framed", "SELECT report_id, line_no, line FROM fr0 QUALIFY COUNT(*) OVER "
                               f"(PARTITION BY report_id) >= {min_lines}"))
    else:
        ctes.append(("framed", "SELECT * FROM fr0"))
    return ctes


def _project_parsed_ctes() -> list[tuple[str, str]]:
    return _framed_ctes("project") + [
        ("pc", "SELECT report_id, line_no, line, replace(line, '\"', '') AS l FROM framed"),
        ("pr", "SELECT report_id, line_no, line, l, CASE WHEN l LIKE '%non-mlra map unit%' THEN 'non_mlra' "
               "WHEN l LIKE '%mmu%' THEN 'mlra' END AS route, "
               f"regexp_matches(l, '{PROJECT_RE}') AS m, "
               f"regexp_extract(l, '{PROJECT_RE}', ['k', 's', 'rating', 'cls', 'mukind', 'kind']) AS p FROM pc"),
        ("pv", "SELECT report_id, line_no, line, route, m AND TRY_CAST(p.k AS BIGINT) IS NOT NULL AS ok, "
               "CASE WHEN m THEN p.k ELSE split_part(l, '|', 1) END AS mukey, p.rating, p.cls, p.mukind, p.kind "
               "FROM pr WHERE route IS NOT NULL"),
        ("lastv", "SELECT * FROM pv WHERE ok QUALIFY row_number() OVER "
                  "(PARTITION BY report_id, route, mukey ORDER BY line_no DESC) = 1"),
    ]


def _report_extract() -> str:
    return with_fixture("SELECT report_id, line_no, line FROM framed", ["legend"], _framed_ctes("project"))


def _report_merge_ratings() -> str:
    sql = (
        "SELECT n.report_id, n.mukey, CAST(n.mukey AS BIGINT) AS int_mukey, n.rating AS n_rating, "
        "n.cls AS n_class, n.mukind AS n_type, n.kind AS n_kind, coalesce(m.rating, 'UNK') AS m_rating, "
        "coalesce(m.cls, 'UNK') AS m_class, coalesce(m.mukind, 'UNK') AS m_type, coalesce(m.kind, 'UNK') AS m_kind "
        "FROM (SELECT * FROM lastv WHERE route = 'non_mlra') n "
        "LEFT JOIN (SELECT * FROM lastv WHERE route = 'mlra') m ON m.report_id = n.report_id AND m.mukey = n.mukey"
    )
    return with_fixture(sql, ["legend"], _project_parsed_ctes())


def _report_rejects() -> str:
    sql = ("SELECT report_id, line_no, line, CASE WHEN TRY_CAST(mukey AS BIGINT) IS NULL THEN 'non-numeric key' "
           "ELSE 'too few fields' END AS reason FROM pv WHERE NOT ok")
    return with_fixture(sql, ["legend"], _project_parsed_ctes())


def _area_parsed_ctes() -> list[tuple[str, str]]:
    return _framed_ctes("area", 2) + [
        ("ac", "SELECT report_id, line_no, replace(line, '\"', '') AS l FROM framed"),
        ("ap", "SELECT report_id, line_no, l, string_split(l, '|') AS p FROM ac"),
        ("av", "SELECT report_id, line_no, l, p[1] AS mukey, p[2] AS musym, p[3] AS rating, p[4] AS cls, "
               "p[5] AS kind, len(p) >= 5 AND TRY_CAST(p[1] AS BIGINT) IS NOT NULL AS ok FROM ap"),
    ]


def _report_parse_area_sql() -> str:
    return ("SELECT report_id, mukey, CAST(mukey AS BIGINT) AS int_mukey, rating, cls AS \"class\", kind FROM av "
            "WHERE ok QUALIFY row_number() OVER (PARTITION BY report_id, mukey ORDER BY line_no DESC) = 1")


def _report_parse_area() -> str:
    return with_fixture(_report_parse_area_sql(), ["legend"], _area_parsed_ctes())


def _report_parse_area_batch() -> str:
    sql = ("SELECT report_id, line_no, TRY_CAST(mukey AS BIGINT) AS mukey, musym, rating, cls AS \"class\", kind, "
           "mukey AS str_mukey FROM av WHERE regexp_matches(l, '^[0-9]')")
    return with_fixture(sql, ["legend"], _area_parsed_ctes())


def _report_single_kind() -> str:
    sql = ("SELECT report_id, CASE WHEN COUNT(DISTINCT k) = 1 THEN MIN(k) END AS kind FROM (SELECT report_id, "
           "CASE WHEN line LIKE '%Limitation%' THEN 'Limitation' WHEN line LIKE '%Suitability%' THEN 'Suitability' "
           "END AS k FROM framed) GROUP BY report_id")
    return with_fixture(sql, ["legend"], _framed_ctes("area", 2))


def _report_key_reconcile() -> str:
    ctes = _area_parsed_ctes() + [("rk", _report_parse_area_sql())]
    sql = ("SELECT coalesce(r.report_id, p.areasymbol) AS areasymbol, coalesce(r.mukey, p.mukey) AS mukey, "
           "CASE WHEN p.mukey IS NULL THEN 'report_only' ELSE 'local_only' END AS side "
           "FROM (SELECT DISTINCT report_id, mukey FROM rk) r FULL OUTER JOIN "
           "(SELECT DISTINCT areasymbol, mukey FROM mupolygon) p ON r.report_id = p.areasymbol AND r.mukey = p.mukey "
           "WHERE r.mukey IS NULL OR p.mukey IS NULL")
    return with_fixture(sql, ["legend", "mapunit", "mupolygon"], ctes)


AOI_BOX = ("SELECT aoi_id, MIN(x) AS ax0, MAX(x) AS ax1, MIN(y) AS ay0, MAX(y) AS ay1 FROM aoi_points "
           "GROUP BY aoi_id")
POLY_BOX = (
    "SELECT poly_id, mukey, areasymbol, list_min(xs) AS x0, list_max(xs) AS x1, list_min(ys) AS y0, "
    "list_max(ys) AS y1 FROM (SELECT poly_id, mukey, areasymbol, "
    "list_transform(string_split(regexp_extract(wkt, '\\(\\(([^()]*)\\)', 1), ', '), "
    "lambda p: CAST(split_part(p, ' ', 1) AS DOUBLE)) AS xs, "
    "list_transform(string_split(regexp_extract(wkt, '\\(\\(([^()]*)\\)', 1), ', '), "
    "lambda p: CAST(split_part(p, ' ', 2) AS DOUBLE)) AS ys FROM mupolygon)"
)
CLIP_SQL = (
    "SELECT aoi_id, poly_id, mukey, areasymbol, (cx1 - cx0) * (cy1 - cy0) AS area, cx0 AS minx, cy0 AS miny, "
    "cx1 AS maxx, cy1 AS maxy FROM (SELECT a.aoi_id, p.poly_id, p.mukey, p.areasymbol, "
    "greatest(p.x0, a.ax0) AS cx0, least(p.x1, a.ax1) AS cx1, greatest(p.y0, a.ay0) AS cy0, "
    "least(p.y1, a.ay1) AS cy1 FROM pbox p, abox a) WHERE cx1 > cx0 AND cy1 > cy0"
)
AOI_TABLES = ["mapunit", "legend", "mupolygon", "aoi_points"]


def _aoi_ring() -> str:
    sql = ("SELECT aoi_id, COUNT(*) AS n_points, 'POLYGON ((' || string_agg(CAST(x AS VARCHAR) || ' ' || "
           "CAST(y AS VARCHAR), ', ' ORDER BY seq) || ', ' || arg_min(CAST(x AS VARCHAR) || ' ' || "
           "CAST(y AS VARCHAR), seq) || '))' AS wkt FROM aoi_points GROUP BY aoi_id")
    return with_fixture(sql, ["aoi_points"])


def _aoi_ctes() -> list[tuple[str, str]]:
    return [("abox", AOI_BOX), ("pbox", POLY_BOX), ("clip", CLIP_SQL)]


def _aoi_clip() -> str:
    n = lambda c: f"CAST({c} AS VARCHAR)"
    pt = lambda x, y: f"{n(x)} || ' ' || {n(y)}"
    ring = " || ', ' || ".join([pt("minx", "miny"), pt("maxx", "miny"), pt("maxx", "maxy"), pt("minx", "maxy"),
                                pt("minx", "miny")])
    return with_fixture(f"SELECT *, 'POLYGON ((' || {ring} || '))' AS wkt FROM clip", AOI_TABLES, _aoi_ctes())


def _aoi_piece_ctes() -> list[tuple[str, str]]:
    """Closed formulas: a box against a right triangle (half-plane sums) or an L (box minus its notch)."""
    key = "CAST(mukey AS BIGINT)"
    x, y = f"({key} % 500) * 10", f"({key} // 500) * 10"
    box = lambda cond, dx, dy, w, h, sign: (
        f"SELECT areasymbol, mukey, {sign} AS sg, CAST({x} + {dx} AS DOUBLE) AS x0, CAST({y} + {dy} AS DOUBLE) AS y0, "
        f"CAST({x} + {dx + w} AS DOUBLE) AS x1, CAST({y} + {dy + h} AS DOUBLE) AS y1 FROM mu WHERE {key} % 3 {cond}")
    boxes = " UNION ALL ".join([box("= 0", 0, 0, 12, 12, 1), box("= 1", 0, 0, 12, 12, 1), box("= 1", 3, 3, 6, 6, -1),
                                box("= 2", 0, 0, 4, 4, 1), box("= 2", 6, 2, 5, 9, 1)])

    def corner_area(u: str, v: str) -> str:
        # area of [0, u] x [0, v] below x + y = 150
        cu, cv = f"greatest({u}, 0)", f"greatest({v}, 0)"
        q = lambda e: f"greatest({e}, 0) * greatest({e}, 0)"
        return f"((22500 - {q(f'150 - {cu}')} - {q(f'150 - {cv}')} + {q(f'150 - {cu} - {cv}')}) / 2)"

    u0, u1, v0, v1 = "(x0 - ax)", "(x1 - ax)", "(y0 - ay)", "(y1 - ay)"
    triangle = (f"({corner_area(u1, v1)} - {corner_area(u0, v1)} - {corner_area(u1, v0)} + {corner_area(u0, v0)})")
    over = lambda w0, w1, h0, h1: (
        f"(greatest(least({u1}, {w1}) - greatest({u0}, {w0}), 0) * "
        f"greatest(least({v1}, {h1}) - greatest({v0}, {h0}), 0))")
    bent = f"({over(0, 200, 0, 130)} - {over(80, 200, 60, 130)})"
    return [
        ("mu", "SELECT areasymbol, mukey FROM mapunit JOIN legend USING (lkey)"),
        ("box", boxes),
        ("shape", "SELECT CAST(r_regionkey AS INTEGER) AS aoi_id, r_regionkey * 100 + 3.5::DOUBLE AS ax, "
                  "r_regionkey * 40 + 1.5::DOUBLE AS ay FROM region"),
        ("piece", f"SELECT aoi_id, areasymbol, mukey, sg * CASE WHEN aoi_id % 2 = 0 THEN {triangle} ELSE {bent} END "
                  "AS a FROM box, shape"),
    ]


def _aoi_clip_holes() -> str:
    sql = ("SELECT aoi_id, mukey || '.s' AS poly_id, mukey, areasymbol, sum(a) AS area FROM piece "
           "GROUP BY aoi_id, mukey, areasymbol HAVING sum(a) > 0")
    return with_fixture(sql, ["mapunit", "legend"], _aoi_piece_ctes())


def _aoi_clip_dropped() -> str:
    """Two-part shapes with both parts in the AOI, and holed boxes whose hole reaches across a sharp corner of a triangle.

    A box in a triangle or an L is one piece, a holed box in an L too.
    """
    key = "CAST(mukey AS BIGINT)"
    across = lambda a, b, h, k: f"{a} >= {h} + 3 AND {a} < {h} + 9 AND ax + ay + 150 - ({k} + 9) < {h} + 9 AND {b} + 150 > {k} + 9"
    x, y = f"({key} % 500) * 10", f"({key} // 500) * 10"
    sql = ("SELECT aoi_id, mukey || '.s' AS poly_id, mukey, areasymbol, sum(a) AS area, CAST(2 AS INTEGER) AS parts "
           f"FROM piece JOIN shape USING (aoi_id) WHERE ({key} % 3 = 2 AND a > 0) OR ({key} % 3 = 1 AND aoi_id % 2 = 0 "
           f"AND (({across('ay', 'ax', y, x)}) OR ({across('ax', 'ay', x, y)}))) "
           "GROUP BY aoi_id, mukey, areasymbol HAVING count(*) = 2")
    return with_fixture(sql, ["mapunit", "legend"], _aoi_piece_ctes())


def _aoi_mukeys() -> str:
    return with_fixture("SELECT DISTINCT aoi_id, mukey FROM clip", AOI_TABLES, _aoi_ctes())


def _aoi_prop_weighted_avg() -> str:
    inner = _weighted_sql(["claytotal_r"], TOP, BOTTOM, dominant_only=False)
    keys = with_fixture("SELECT DISTINCT mukey FROM clip", AOI_TABLES, _aoi_ctes())
    return f"SELECT * FROM ({inner}) w WHERE w.mukey IN ({keys})"


def _in_aoi(inner: str) -> str:
    keys = with_fixture("SELECT DISTINCT mukey FROM clip", AOI_TABLES, _aoi_ctes())
    return f"SELECT * FROM ({inner}) w WHERE w.mukey IN ({keys})"


def _prop_multi_dom_comp() -> str:
    cols = "drainagecl, hydgrp, tfact"
    sql = f"SELECT {MU_COLS}, {cols} FROM mu JOIN dom USING (mukey)"
    return with_fixture(sql, ["mapunit", "legend", "component"], [("mu", MU), ("dom", _dom(cols))])


def _prop_multi_dom_cond() -> str:
    ctes = [("mu", MU)]
    for c in ("drainagecl", "hydgrp", "tfact"):
        ctes.append((f"best_{c}", f"SELECT mukey, {c} FROM (SELECT mukey, {c}, SUM(DISTINCT comppct_r) AS s FROM component "
                     f"GROUP BY mukey, {c}) QUALIFY row_number() OVER (PARTITION BY mukey "
                     f"ORDER BY s DESC NULLS LAST, {c} ASC NULLS LAST) = 1"))
    sql = (f"SELECT {MU_COLS}, drainagecl, hydgrp, tfact FROM mu JOIN best_drainagecl USING (mukey) "
           "JOIN best_hydgrp USING (mukey) JOIN best_tfact USING (mukey)")
    return with_fixture(sql, ["mapunit", "legend", "component"], ctes)


def _prop_multi_min_max() -> str:
    return (f"SELECT a.*, b.om_r FROM ({_prop_min_max('claytotal_r', 'MIN')}) a "
            f"JOIN ({_prop_min_max('om_r', 'MIN')}) b USING (mukey)")


def _prop_catalog_any() -> str:
    dom = with_fixture("SELECT mukey, hydgrp FROM dom", ["component"], [("dom", _dom("hydgrp"))])
    return (f"SELECT w.*, d.hydgrp FROM ({_weighted_sql(['sandtotal_r'], TOP, BOTTOM, dominant_only=False)}) w "
            f"LEFT JOIN ({dom}) d USING (mukey)")


def _filter_area_like() -> str:
    return with_fixture("SELECT lkey, areasymbol FROM legend WHERE areasymbol ILIKE 'nc00%' OR "
                        "lower(areasymbol) = 'nc021'", ["legend"])


def _interp_rule_like() -> str:
    return f"SELECT * FROM ({_interp_weighted_avg()}) WHERE lower(mrulename) LIKE 'eng - dwell%'"


def _coverage_requests() -> str:
    ctes = _area_parsed_ctes() + [("rk", _report_parse_area_sql())]
    sql = ("SELECT areasymbol, 'area report' AS request FROM (SELECT areasymbol FROM legend WHERE "
           "upper(areasymbol) IN ('NC001', 'NC003') OR areasymbol LIKE 'NC01%' UNION SELECT 'ZZ999') "
           "WHERE areasymbol NOT IN (SELECT report_id FROM rk)")
    return with_fixture(sql, ["legend"], ctes)


def _coverage_patterns() -> str:
    ctes = _area_parsed_ctes() + [("rk", _report_parse_area_sql())]
    sql = ("SELECT areasymbol, 'area report' AS request FROM (SELECT areasymbol FROM legend WHERE areasymbol LIKE 'NC01_' "
           "UNION ALL SELECT unnest(['ZZ%', 'XX___', 'zz999'])) WHERE areasymbol NOT IN (SELECT report_id FROM rk)")
    return with_fixture(sql, ["legend"], ctes)


def _report_rejects_area() -> str:
    sql = ("SELECT f.report_id, f.line_no, f.line, CASE WHEN TRY_CAST(mukey AS BIGINT) IS NULL THEN 'non-numeric key' "
           "ELSE 'too few fields' END AS reason FROM av JOIN framed f USING (report_id, line_no) WHERE NOT ok")
    return with_fixture(sql, ["legend"], _area_parsed_ctes())


def _reject_channel() -> str:
    part = lambda sql, form: (f"SELECT 'report {form}' AS decoder, report_id AS source, line_no AS position, line AS record, "  # noqa: E731
                              f"reason FROM ({sql})")
    return f"{part(_report_rejects(), 'project')} UNION ALL {part(_report_rejects_area(), 'area')}"


def _coverage_report() -> str:
    ctes = _area_parsed_ctes() + [("rk", _report_parse_area_sql())]
    sql = ("SELECT s.areasymbol, 'area report' AS request FROM sacatalog s "
           "WHERE s.areasymbol NOT IN (SELECT report_id FROM rk)")
    return with_fixture(sql, ["legend", "sacatalog"], ctes)


def _legend_breaks_numeric() -> str:
    inner = _weighted_sql(["claytotal_r"], TOP, BOTTOM, dominant_only=False)
    return f"SELECT DISTINCT coalesce(round(claytotal_r, 3), -1.0) AS break_value FROM ({inner})"


def _legend_breaks_text() -> str:
    return f"SELECT DISTINCT coalesce(\"class\", ' Not Rated') AS break_value FROM ({_interp_weighted_avg()})"


def _sample_features() -> str:
    sql = "SELECT * FROM mu ORDER BY md5(CAST(int_mukey AS VARCHAR) || '|0'), int_mukey LIMIT 50"
    return with_fixture(sql, ["mapunit", "legend"], [("mu", MU)])


def _dedupe_last() -> str:
    batch = _report_parse_area_batch()
    return (f"SELECT str_mukey AS mukey, line_no, report_id, rating, \"class\", kind FROM ({batch}) "
            "QUALIFY row_number() OVER (PARTITION BY str_mukey ORDER BY line_no DESC) = 1")


def _property_catalog() -> str:
    lines = ("SELECT CAST(p_partkey AS BIGINT) AS line_no, replace(replace(lower(p_type) || '_' || "
             "CAST(p_partkey % 13 AS VARCHAR) || ',' || p_type || '  #' || CAST(p_size % 7 AS VARCHAR), '  ', ' '), "
             "'#', 'no. ') AS l FROM part")
    return (f"SELECT label, arg_max(code, line_no) AS code FROM (SELECT line_no, split_part(l, ',', 1) AS code, "
            f"substring(l, strpos(l, ',') + 1) AS label FROM ({lines}) WHERE strpos(l, ',') > 0) GROUP BY label")


def _polygon_attribute_join() -> str:
    hr = _hydric_rating()
    return (f"SELECT p.areasymbol, p.mukey, p.poly_id, p.wkt, h.musym, h.muname, h.int_mukey, h.hydric_rating "
            f"FROM ({with_fixture('SELECT * FROM mupolygon', ['mapunit', 'legend', 'mupolygon'])}) p "
            f"LEFT JOIN ({hr}) h ON h.mukey = p.mukey")


def _polygon_extract() -> str:
    merged = _report_merge_ratings()
    return (f"SELECT * FROM ({with_fixture('SELECT * FROM mupolygon', ['mapunit', 'legend', 'mupolygon'])}) p "
            f"WHERE p.mukey IN (SELECT mukey FROM ({merged}))")


def oracle_sql() -> dict[str, str]:
    return {
        "prop_dom_comp_cat": _prop_dom_comp_cat(),
        "prop_dom_cond": _prop_dom_cond(),
        "prop_weighted_avg": _weighted_sql(["claytotal_r"], TOP, BOTTOM, dominant_only=False),
        "prop_dom_comp_num": _weighted_sql(["claytotal_r"], TOP, BOTTOM, dominant_only=True),
        "prop_min": _prop_min_max("claytotal_r", "MIN"),
        "prop_max": _prop_min_max("om_r", "MAX"),
        "prop_multi": _weighted_sql(MULTI_PROPS, 0, 50, dominant_only=False),
        "prop_multi_dom_comp": _prop_multi_dom_comp(),
        "prop_multi_dom_comp_num": _weighted_sql(MULTI_PROPS, 0, 50, dominant_only=True),
        "prop_multi_dom_cond": _prop_multi_dom_cond(),
        "prop_multi_min_max": _prop_multi_min_max(),
        "prop_catalog_any": _prop_catalog_any(),
        "filter_area_like": _filter_area_like(),
        "interp_rule_like": _interp_rule_like(),
        "aoi_clip_holes": _aoi_clip_holes(),
        "aoi_clip_dropped": _aoi_clip_dropped(),
        "aoi_prop_dom_cond": _in_aoi(_prop_dom_cond()),
        "aoi_prop_dom_comp": _in_aoi(_prop_dom_comp_cat()),
        "aoi_prop_min": _in_aoi(_prop_min_max("claytotal_r", "MIN")),
        "aoi_prop_multi": _in_aoi(_weighted_sql(MULTI_PROPS, 0, 50, dominant_only=False)),
        "aoi_interp_dom_cond": _in_aoi(_interp_dom_cond()),
        "aoi_interp_dom_comp": _in_aoi(_interp_dom_comp()),
        "aoi_interp_weighted_avg": _in_aoi(_interp_weighted_avg()),
        "coverage_requests": _coverage_requests(),
        "coverage_patterns": _coverage_patterns(),
        "report_rejects_area": _report_rejects_area(),
        "reject_channel": _reject_channel(),
        "interp_dom_comp": _interp_dom_comp(),
        "interp_dom_cond": _interp_dom_cond(),
        "interp_weighted_avg": _interp_weighted_avg(),
        "interp_reasons_all": _interp_reasons_all(),
        "hydric_counts": _hydric_counts(),
        "hydric_rating": _hydric_rating(),
        "stored_hydric_rating": _hydric_rating(),
        "reasons_unescaped": _reasons_unescaped(),
        "parent_material": _parent_material(False),
        "parent_material_general": _parent_material(True),
        "muaggatt_extract": _muaggatt_extract(),
        "report_extract": _report_extract(),
        "report_merge_ratings": _report_merge_ratings(),
        "report_rejects": _report_rejects(),
        "report_parse_area": _report_parse_area(),
        "report_parse_area_batch": _report_parse_area_batch(),
        "report_single_kind": _report_single_kind(),
        "report_key_reconcile": _report_key_reconcile(),
        "aoi_ring": _aoi_ring(),
        "aoi_clip": _aoi_clip(),
        "aoi_mukeys": _aoi_mukeys(),
        "aoi_prop_weighted_avg": _aoi_prop_weighted_avg(),
        "coverage_report": _coverage_report(),
        "legend_breaks_numeric": _legend_breaks_numeric(),
        "legend_breaks_text": _legend_breaks_text(),
        "sample_features": _sample_features(),
        "dedupe_last": _dedupe_last(),
        "property_catalog": _property_catalog(),
        "polygon_attribute_join": _polygon_attribute_join(),
        "polygon_extract": _polygon_extract(),
    }


__all__ = ["oracle_sql", "parent_material_case_sql", "RULE_NAMES"]
