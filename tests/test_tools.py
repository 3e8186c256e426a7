"""Batch tools write one table per request, equal to the direct operators."""

import os

import pytest

from loam.operators import interps as I
from loam.operators import properties as P
from loam.operators.joins import mapunit_frame
from loam.plans.tools import run_aoi_tool, resolve_labels, run_interp_tool, run_property_tool, run_report_tool, run_summary_tool
from loam.sources.fixtures import SoilFixture

SF = "/root/testdata/sf0.001"


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_property_tool_weighted(spark, scratch):
    fx = SoilFixture(spark, SF)
    labels = ["Total Clay - Rep Value", "Organic Matter - Rep Value"]
    paths = run_property_tool(fx, scratch, labels, "Weighted Average", 0, 50)
    assert os.path.basename(paths[labels[0]]) == "tbl_Total_Clay_Rep_Value_wtd_avg_0_50"
    mu = mapunit_frame(fx.legend, fx.mapunit)
    want = P.prop_weighted_avg(mu, fx.component, fx.chorizon, fx.chtexturegrp, "claytotal_r", 0, 50)
    assert _rows(spark.read.parquet(paths[labels[0]])) == _rows(want)
    assert spark.read.parquet(os.path.join(scratch, "coverage")).count() == 0


def test_interp_tool_and_unknown_label(spark, scratch):
    fx = SoilFixture(spark, SF)
    rules = ["ENG - Dwellings", "AGR - Corn Suitability"]
    paths = run_interp_tool(fx, scratch, rules, "Dominant Condition", areas=["NC001", "NC002"])
    mu = mapunit_frame(fx.legend.filter("areasymbol in ('NC001', 'NC002')"), fx.mapunit)
    want = I.interp_dom_cond(mu, fx.component, fx.cointerp, rules).filter("mrulename = 'ENG - Dwellings'")
    assert _rows(spark.read.parquet(paths["ENG - Dwellings"])) == _rows(want.drop("mrulename"))
    with pytest.raises(ValueError):
        resolve_labels(spark, ["Not A Property"])


def test_interp_tool_takes_text_patterns_and_unknown_areas(spark, scratch):
    fx = SoilFixture(spark, SF)
    paths = run_interp_tool(fx, scratch, "eng - dwell%; no such rule", "Weighted Average", areas=["nc001", "ZZ999"])
    assert list(paths) == ["ENG - Dwellings"]
    assert os.path.basename(paths["ENG - Dwellings"]) == "tbl_ENG_Dwellings_wtd_avg"
    mu = mapunit_frame(fx.legend.filter("areasymbol = 'NC001'"), fx.mapunit)
    want = I.interp_weighted_avg(mu, fx.component, fx.cointerp, ["ENG - Dwellings"]).drop("mrulename")
    assert _rows(spark.read.parquet(paths["ENG - Dwellings"]).drop("reason")) == _rows(want.drop("reason"))
    missing = sorted(tuple(r) for r in spark.read.parquet(os.path.join(scratch, "coverage")).collect())
    assert missing == [("NC001", "no such rule"), ("ZZ999", "ENG - Dwellings"), ("ZZ999", "no such rule")]


def test_property_tool_one_plan_for_every_method(spark, scratch):
    fx = SoilFixture(spark, SF)
    cases = [
        ("Min\\Max", ["Total Clay - Rep Value", "Organic Matter - Rep Value"]),
        ("Dominant Component (Numeric)", ["Total Clay - Rep Value", "Total Sand - Rep Value"]),
        ("Dominant Condition", ["Drainage Class", "Hydrologic Group"]),
        ("Dominant Component (Category)", ["Drainage Class", "t Factor"]),
    ]
    for i, (method, labels) in enumerate(cases):
        out = f"{scratch}/{i}"
        paths = run_property_tool(fx, out, labels, method, 0, 50, "MAX", areas="NC001; NC002")
        assert set(paths) == set(labels)
        for path in paths.values():
            assert spark.read.parquet(path).count() > 0
    with pytest.raises(ValueError, match="component property"):
        run_property_tool(fx, scratch + "/x", ["Hydrologic Group"], "Weighted Average")


def test_three_properties_read_the_horizons_once(spark, scratch):
    from loam.sources.soil_tables import SoilTables, write_soil_tables

    fx = SoilFixture(spark, SF)
    names = ("legend", "mapunit", "component", "chorizon", "chtexturegrp")
    write_soil_tables({n: getattr(fx, n) for n in names}, scratch, files=2)
    st = SoilTables(spark, scratch)
    mu = mapunit_frame(st.legend, st.mapunit)
    props = ["claytotal_r", "om_r", "sandtotal_r"]
    for method in ("Weighted Average", "Min\\Max"):
        df = P.prop_multi(method, mu, st.component, st.chorizon, st.chtexturegrp, props, 0, 50)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        final = plan[plan.index("Final Plan") :].split("Initial Plan")[0]
        scans = [line for line in final.splitlines() if "FileScan" in line and "hzname#" in line.split("]")[0]]
        assert len(scans) == 1


def test_summary_and_report_tools(spark, scratch):
    from loam.operators import reports as R
    from loam.operators import summaries as S
    from loam.sources import reports as RS

    fx = SoilFixture(spark, SF)
    mu = mapunit_frame(fx.legend, fx.mapunit)
    want = {"hydric": S.hydric_rating(mu, fx.component), "muaggatt": S.muaggatt_extract(mu, fx.muaggatt),
            "parent_material": S.parent_material(mu, fx.component, fx.copmgrp, general=False)}
    for kind, df in want.items():
        path = run_summary_tool(fx, scratch, kind)
        assert os.path.basename(path) == "tbl_" + kind and _rows(spark.read.parquet(path)) == _rows(df)
    with pytest.raises(ValueError):
        run_summary_tool(fx, scratch, "other")
    paths = run_report_tool(fx.report_lines("project"), scratch, "NSSC:ENG - Roads{:} x", "project")
    assert os.path.basename(paths["ratings"]) == "tbl_ENG_Roads_x_dom_cond_rt"
    framed = RS.report_extract(fx.report_lines("project"))
    assert spark.read.parquet(paths["rejects"]).count() == R.drop_malformed(framed).count() > 0
    area = run_report_tool(fx.report_lines("area"), scratch, "ENG - Area")
    assert spark.read.parquet(area["ratings"]).count() > 0


def test_area_reports_have_rejects_and_coverage(spark, scratch):
    lines = [("A", i, x) for i, x in enumerate(["START", "mukey|musym|rating|class|kind", "1|a|0.5|Good|Limitation", "12|ab", "abc|x|1|y|z",
                                                "1|a|0.6|Fair|Limitation", "STOP"])] + [("B", 0, "nothing here")]
    df = spark.createDataFrame(lines, "report_id string, line_no long, line string")
    for form, ratings in (("area", [("1", "0.6")]), ("batch", [("1", "0.5"), ("1", "0.6"), ("12", None)])):
        out = f"{scratch}/{form}"
        paths = run_report_tool(df, out, "ENG - Area", form)
        got = spark.read.parquet(paths["ratings"]).collect()
        assert sorted((str(r.mukey), r.rating) for r in got) == ratings
        rejects = [(r.line_no, r.reason) for r in spark.read.parquet(paths["rejects"]).orderBy("line_no").collect()]
        assert rejects == [(1, "non-numeric key"), (3, "too few fields"), (4, "non-numeric key")]
        assert [tuple(r) for r in spark.read.parquet(out + "/coverage").collect()] == [("B", "ENG - Area")]
    with pytest.raises(ValueError):
        run_report_tool(df, scratch, "x", "other")


def test_aoi_tool_end_to_end(spark, scratch):
    from loam.operators import aoi as A

    fx = SoilFixture(spark, SF)
    paths = run_aoi_tool(fx, fx.aoi_points, scratch, ["Total Clay - Rep Value"], "Weighted Average", grid_cell=25.0, top=0, bottom=50)
    keys = {r.mukey for r in A.aoi_mukeys(A.aoi_clip(fx.mupolygon, fx.aoi_points, 25.0)).collect()}
    (path,) = paths.values()
    assert {r.mukey for r in spark.read.parquet(path).collect()} == keys
    with pytest.raises(ValueError):
        run_aoi_tool(fx, fx.aoi_points, scratch, [], "x", kind="other")
