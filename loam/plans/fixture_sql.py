"""DuckDB SQL for the soil fixture (independent of the Spark derivation).

Each entry is the body of a CTE over the driver views (nation, orders,
customer, lineitem, part, region).  ``with_fixture`` prepends the CTEs a
query needs, so an oracle statement reads only the given tables.
"""

from __future__ import annotations

from loam.schemas import MUAGGATT_FLOAT, MUAGGATT_INT, MUAGGATT_TEXT
from loam.sources.fixtures import (
    HYDGRP,
    PM_NAMES,
    RULES,
    SUBRULE_CLASSES,
    TEXTURES,
)


def _list(values) -> str:
    return "[" + ", ".join("NULL" if v is None else "'" + v.replace("'", "''") + "'" for v in values) + "]"


def _muaggatt_sql() -> str:
    cols = ["CAST(o_orderkey AS VARCHAR) AS mukey"]
    for idx, name in enumerate(MUAGGATT_FLOAT):
        cols.append(
            f"CASE WHEN (o_orderkey + {idx}) % 11 = 0 THEN 'n/a' ELSE "
            f"CAST((o_orderkey * {idx + 3}) % 10007 AS VARCHAR) || '.' || CAST((o_orderkey + {idx}) % 10 AS VARCHAR) "
            f"END AS {name}"
        )
    for idx, name in enumerate(MUAGGATT_INT):
        cols.append(
            f"CASE WHEN (o_orderkey + {idx + 5}) % 11 = 0 THEN 'n/a' ELSE "
            f"CAST((o_custkey + {idx * 7}) % 250 AS VARCHAR) END AS {name}"
        )
    text_src = {
        "mustatus": "o_orderstatus",
        "flodfreqdcd": "o_orderpriority",
        "hydclprs": "substring(o_orderpriority, 1, 1)",
        "musym": "'a' || CAST(o_orderkey % 97 AS VARCHAR)",
        "muname": "'attributes of ' || CAST(o_orderkey AS VARCHAR)",
    }
    for name in MUAGGATT_TEXT:
        src = text_src.get(name, f"'{name[:3]}-' || CAST(o_orderkey % 7 AS VARCHAR)")
        cols.append(f"CASE WHEN (o_orderkey + {len(name)}) % 13 = 0 THEN NULL ELSE {src} END AS {name}")
    return "SELECT " + ", ".join(cols) + " FROM orders"


def _cointerp_sql() -> str:
    parts = []
    for rule, design in RULES:
        score = "k" if design == 1 else "(10 - k)"
        null0 = "(l_returnflag = 'R' AND l_linenumber >= 6)"
        names = ["Not limited", "Somewhat limited", "Very limited"] if design == 1 else \
            ["Not suited", "Poorly suited", "Well suited"]
        parts.append(
            f"SELECT cokey, '{rule}' AS mrulename, 0 AS ruledepth, {design} AS ruledesign, "
            f"CASE WHEN {null0} THEN NULL ELSE CAST({score} AS DOUBLE) / 10.0 END AS interphr, "
            f"CASE WHEN {null0} THEN 'Not rated' WHEN {score} = 0 THEN '{names[0]}' "
            f"WHEN {score} <= 5 THEN '{names[1]}' ELSE '{names[2]}' END AS interphrc FROM lp"
        )
        for n in (1, 2, 3):
            parts.append(
                f"SELECT cokey, '{rule}', {n}, {design}, CAST((p_size * {n}) % 11 AS DOUBLE) / 10.0, "
                f"{_list(SUBRULE_CLASSES)}[(p_size + {n} * l_linenumber) % 5 + 1] FROM lp"
            )
    return " UNION ALL ".join(parts)


FIXTURE_CTES: dict[str, str] = {
    "legend": (
        "SELECT CAST(n_nationkey AS VARCHAR) AS lkey, "
        "'NC' || lpad(CAST(n_nationkey AS VARCHAR), 3, '0') AS areasymbol FROM nation"
    ),
    "sacatalog": "SELECT areasymbol FROM legend",
    "mapunit": (
        "SELECT CAST(o_orderkey AS VARCHAR) AS mukey, CAST(c_nationkey AS VARCHAR) AS lkey, "
        "substring(o_orderpriority, 1, 1) || o_orderstatus AS musym, "
        "o_orderpriority || ' ' || o_orderstatus AS muname "
        "FROM orders JOIN customer ON o_custkey = c_custkey"
    ),
    "lp": (
        "SELECT l.*, p_name, p_type, p_size, "
        "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, "
        "CAST(round(l_extendedprice * 100) AS BIGINT)) AS cokey, "
        "CAST(round(abs(l_discount) * 100) AS INTEGER) AS k "
        "FROM lineitem l JOIN part ON l_partkey = p_partkey"
    ),
    "component": (
        "SELECT cokey, CAST(l_orderkey AS VARCHAR) AS mukey, p_name AS compname, "
        "CAST(l_quantity AS INTEGER) AS comppct_r, "
        "CASE WHEN l_linestatus = 'F' THEN 'Yes' ELSE 'No' END AS majcompflag, "
        "CASE l_returnflag WHEN 'A' THEN 'Yes' WHEN 'N' THEN 'No' ELSE NULL END AS hydricrating, "
        "CASE p_size % 10 WHEN 0 THEN 'miscellaneous area' WHEN 1 THEN NULL ELSE 'series' END AS compkind, "
        "CASE WHEN p_type LIKE '%PROMO%' THEN NULL ELSE p_type END AS drainagecl, "
        f"{_list(HYDGRP)}[(p_size + l_linenumber) % 6 + 1] AS hydgrp, "
        "CASE WHEN p_size % 5 = 0 THEN NULL ELSE CAST(p_size % 6 AS DOUBLE) END AS tfact FROM lp"
    ),
    "hb": (
        "SELECT cokey, k, p_size, l_linenumber, i, cokey || ':' || CAST(i AS VARCHAR) AS chkey, "
        "CASE WHEN i = 0 THEN ['Oi', NULL, 'Ap', 'Ap', 'Ap'][p_size % 5 + 1] WHEN i = 1 THEN 'Bt' "
        "ELSE ['Cr', 'R', 'C'][p_size % 3 + 1] END AS hzname, "
        "CASE WHEN i = 2 AND p_size % 13 = 0 THEN NULL ELSE i * (10 + 5 * l_linenumber) END AS hzdept_r, "
        "(i + 1) * (10 + 5 * l_linenumber) AS hzdepb_r, "
        "CASE WHEN (p_size + i) % 7 = 0 THEN NULL ELSE CAST(k * 4 + i * 20 + p_size AS DOUBLE) / 4.0 END "
        "AS claytotal_r, "
        "CASE WHEN (p_size + 2 * i) % 9 = 0 THEN NULL ELSE CAST(l_linenumber * 8 + i * 3 + p_size % 8 AS DOUBLE) "
        "/ 8.0 END AS om_r, "
        "CASE WHEN (p_size + 3 * i) % 8 = 0 THEN NULL ELSE CAST(l_linenumber * 6 + i * 8 + p_size AS DOUBLE) / 2.0 END "
        "AS sandtotal_r "
        "FROM lp, (SELECT unnest([0, 1, 2]) AS i) AS h"
    ),
    "chorizon": (
        "SELECT chkey, cokey, hzname, CAST(hzdept_r AS INTEGER) AS hzdept_r, CAST(hzdepb_r AS INTEGER) AS hzdepb_r, "
        "claytotal_r, om_r, sandtotal_r FROM hb"
    ),
    "chtexturegrp": (
        f"SELECT chkey, 'Yes' AS rvindicator, {_list(TEXTURES)}[(l_linenumber * 3 + i + p_size) % 11 + 1] AS texture "
        "FROM hb UNION ALL SELECT chkey, 'No', 'L' FROM hb WHERE (p_size + i) % 3 = 0 "
        "UNION ALL SELECT chkey, 'Yes', 'CL' FROM hb WHERE l_linenumber = 7 AND i = 1"
    ),
    "cointerp": _cointerp_sql(),
    "copmgrp": (
        f"SELECT cokey, {_list(PM_NAMES)}[p_size % 8 + 1] AS pmgroupname FROM lp "
        "UNION ALL SELECT cokey, 'Colluvium' FROM lp WHERE l_linenumber = 7"
    ),
    "muaggatt": _muaggatt_sql(),
    "mupolygon": (
        "SELECT areasymbol, mukey, mukey || '.' || CAST(part AS VARCHAR) AS poly_id, "
        "'POLYGON ((' || concat_ws(', ', x0 || ' ' || y0, (x0 + s) || ' ' || y0, (x0 + s) || ' ' || (y0 + s), "
        "x0 || ' ' || (y0 + s), x0 || ' ' || y0) || '))' AS wkt FROM ("
        "SELECT areasymbol, mukey, 1 AS part, (CAST(mukey AS BIGINT) % 500) * 10 AS x0, "
        "(CAST(mukey AS BIGINT) // 500) * 10 AS y0, 12 AS s FROM mapunit JOIN legend USING (lkey) "
        "UNION ALL SELECT areasymbol, mukey, 2, (CAST(mukey AS BIGINT) % 500) * 10 + 4, "
        "(CAST(mukey AS BIGINT) // 500) * 10 + 4, 3 FROM mapunit JOIN legend USING (lkey) "
        "WHERE CAST(mukey AS BIGINT) % 10 = 0)"
    ),
    "aoi_box": (
        "SELECT CAST(r_regionkey AS INTEGER) AS aoi_id, "
        "CAST(CASE WHEN r_regionkey = 4 THEN 100000.0 ELSE r_regionkey * 100 + 3.5 END AS DOUBLE) AS ax0, "
        "CAST(CASE WHEN r_regionkey = 4 THEN 100000.0 ELSE r_regionkey * 50 + 1.5 END AS DOUBLE) AS ay0 FROM region"
    ),
    "aoi_points": (
        "SELECT aoi_id, seq, x, y FROM ("
        "SELECT aoi_id, 1 AS seq, ax0 AS x, ay0 AS y FROM aoi_box UNION ALL "
        "SELECT aoi_id, 2, ax0 + 250, ay0 FROM aoi_box UNION ALL "
        "SELECT aoi_id, 3, ax0 + 250, ay0 + 120 FROM aoi_box UNION ALL "
        "SELECT aoi_id, 4, ax0, ay0 + 120 FROM aoi_box)"
    ),
}

def report_lines_sql(form: str) -> str:
    from loam.sources.fixtures import REPORT_STOP_LINE as BIG

    kind = ("CASE WHEN c_nationkey % 11 = 4 THEN CASE WHEN o_orderkey % 2 = 0 THEN 'Suitability' ELSE 'Limitation' "
            "END WHEN c_nationkey % 5 = 2 THEN 'Suitability' ELSE 'Limitation' END")
    mukey = "CAST(o_orderkey AS VARCHAR)"
    musym = "substring(o_orderpriority, 1, 1) || o_orderstatus"
    r1 = "'0.' || lpad(CAST(o_orderkey % 100 AS VARCHAR), 2, '0')"
    r2 = "'0.' || lpad(CAST((o_orderkey * 7) % 100 AS VARCHAR), 2, '0')"
    c1 = "['Not limited', 'Somewhat limited', 'Very limited, wet'][o_orderkey % 3 + 1]"
    src = "FROM orders JOIN customer ON o_custkey = c_custkey"
    rid = "'NC' || lpad(CAST(c_nationkey AS VARCHAR), 3, '0')"
    if form == "project":
        recs = [
            f"SELECT {rid}, o_orderkey * 4, '\"' || {mukey} || '\"|' || {musym} || '|' || {r1} || '|' || {c1} "
            f"|| '|non-mlra map unit|' || {kind} {src}",
            f"SELECT {rid}, o_orderkey * 4 + 1, {mukey} || '|' || {musym} || '|' || {r2} || '|Somewhat limited|mmu|' "
            f"|| {kind} {src} WHERE o_orderkey % 3 != 0",
            f"SELECT {rid}, o_orderkey * 4 + 2, {mukey} || '|' || {musym} || '|0.99|Very limited, wet|non-mlra map unit|'"
            f" || {kind} {src} WHERE o_orderkey % 50 = 0",
            f"SELECT {rid}, o_orderkey * 4 + 3, {mukey} || '|non-mlra map unit' {src} WHERE o_orderkey % 97 = 0",
        ]
        header = "mukey|musym|rating|class|mukind|kind"
    else:
        recs = [
            f"SELECT {rid}, o_orderkey * 4, '\"' || {mukey} || '\"|\"' || {musym} || '\"|' || {r1} || '|' || {c1} "
            f"|| '|' || {kind} {src}",
            f"SELECT {rid}, o_orderkey * 4 + 2, {mukey} || '|' || {musym} || '|0.99|Very limited, wet|' || {kind} {src} "
            "WHERE o_orderkey % 50 = 0",
            f"SELECT {rid}, o_orderkey * 4 + 3, {mukey} || '|' || {musym} {src} WHERE o_orderkey % 97 = 0",
        ]
        header = "mukey|musym|rating|class|kind"
    frame = [
        "SELECT areasymbol, -3, 'Interpretation report ' || areasymbol FROM legend",
        "SELECT areasymbol, -2, '' FROM legend",
        "SELECT areasymbol, -1, CASE WHEN CAST(lkey AS INTEGER) % 7 = 3 THEN 'BEGIN' ELSE '  <b>START</b> ' END "
        "FROM legend",
        f"SELECT areasymbol, 0, '{header}' FROM legend",
        f"SELECT areasymbol, {BIG}, 'STOP ' FROM legend",
        f"SELECT areasymbol, {BIG + 1}, 'end of report' FROM legend",
    ]
    body = " UNION ALL ".join(frame + recs)
    return f"SELECT col0 AS report_id, CAST(col1 AS BIGINT) AS line_no, col2 AS line FROM ({body}) AS t(col0, col1, col2)"


# CTEs each fixture table depends on (must precede it).
_DEPS = {
    "sacatalog": ["legend"],
    "component": ["lp"],
    "hb": ["lp"],
    "chorizon": ["hb"],
    "chtexturegrp": ["hb"],
    "cointerp": ["lp"],
    "copmgrp": ["lp"],
    "mupolygon": ["mapunit", "legend"],
    "aoi_points": ["aoi_box"],
}


def _closure(names) -> list[str]:
    order: list[str] = []

    def visit(n):
        for d in _DEPS.get(n, []):
            visit(d)
        if n not in order:
            order.append(n)

    for n in names:
        visit(n)
    return order


def with_fixture(sql: str, tables, extra_ctes: list[tuple[str, str]] | None = None) -> str:
    """Prepend the fixture CTEs ``tables`` (plus dependencies) and ``extra_ctes`` to ``sql``.

    An extra CTE whose name ends in ``!`` is materialised, so that no join order reaches into it.
    """
    ctes = [f"{n} AS ({FIXTURE_CTES[n]})" for n in _closure(tables)]
    ctes += [f"{n.rstrip('!')} AS {'MATERIALIZED ' * n.endswith('!')}({body})" for n, body in (extra_ctes or [])]
    return "WITH " + ",\n".join(ctes) + "\n" + sql
