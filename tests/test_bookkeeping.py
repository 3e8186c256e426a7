"""Dedupe, coverage, legend breaks, sampling, naming, writing, catalogue, text helpers."""

import os

import pytest
from pyspark.sql import functions as F

from loam.operators import bookkeeping as B
from loam.operators.filters import requested_areas
from loam.sources.catalog import PROPERTY_LABELS, catalog_frame, property_catalog, resolve_property


def test_dedupe_last(spark):
    df = spark.createDataFrame([("1", 1, "a"), ("1", 3, "c"), ("1", 2, "b"), ("2", 1, "x")],
                               "mukey string, n int, v string")
    got = sorted(tuple(r) for r in B.dedupe_last(df, "mukey", "n").collect())
    assert got == [("1", 3, "c"), ("2", 1, "x")]


def test_coverage_report(spark):
    areas = spark.createDataFrame([("A",), ("B",)], "areasymbol string")
    result = spark.createDataFrame([("A", "r1", 1)], "areasymbol string, mrulename string, x int")
    got = sorted(tuple(r) for r in B.coverage_report(areas, ["r1", "r2"], result, "mrulename").collect())
    assert got == [("A", "r2"), ("B", "r1"), ("B", "r2")]


def test_legend_breaks(spark):
    df = spark.createDataFrame([(1.23456, "a"), (None, None), (1.23456, "b")], "v double, c string")
    assert [r.break_value for r in B.legend_breaks(df, "v").collect()] == [-1.0, 1.235]
    assert [r.break_value for r in B.legend_breaks(df, "c").collect()] == [" Not Rated", "a", "b"]


def test_sample_features_exact_and_stable(spark):
    df = spark.range(1000).select(F.col("id").alias("fid"))
    a = [r.fid for r in B.sample_features(df, "fid", 50, seed=3).collect()]
    b = [r.fid for r in B.sample_features(df.repartition(5), "fid", 50, seed=3).collect()]
    assert len(a) == 50 == len(set(a)) and sorted(a) == sorted(b)
    assert B.sample_features(df.limit(10), "fid", 50).count() == 10
    wide = [r.fid for r in B.sample_features(spark.range(3_000_000).select(F.col("id").alias("fid")), "fid", 50).collect()]
    assert len({i % 1000003 for i in wide}) >= 49


def test_table_name():
    assert B.table_name("Total Clay - Rep Value", "Weighted Average", 0, 100) == "tbl_Total_Clay_Rep_Value_wtd_avg_0_100"
    assert B.table_name("pH 1:1 water", "Min\\Max", stat="max") == "tbl_pH_1_1_water_min_max_MAX"
    assert B.table_name("0.1 bar H2O", "Dominant Condition") == "tbl_x0_1_bar_H2O_dom_cond"
    # rules have no depth range; names that clean to one text stay apart
    assert B.table_name("R-1", "Weighted Average") == "tbl_R_1_wtd_avg"
    names = B.unique_names(["R-1", "R 1", "S"], [B.table_name(r, "Weighted Average") for r in ("R-1", "R 1", "S")])
    assert len(set(names.values())) == 3 and names["S"] == "tbl_S_wtd_avg"


def test_write_result_roundtrip(spark, scratch):
    df = spark.createDataFrame([("2", 1.0), ("1", 2.0)], "mukey string, v double")
    path = os.path.join(scratch, "out")
    B.write_result(df.coalesce(1), path)
    assert [r.mukey for r in spark.read.parquet(path).collect()] == ["1", "2"]


def test_property_catalog_cleaning(spark):
    lines = spark.createDataFrame([(1, "a_r,Label  #4"), (2, "b_r,Other"), (3, "c_r,Label #4"), (4, "nocomma")],
                                  "line_no bigint, line string")
    got = [tuple(r) for r in property_catalog(lines).collect()]
    assert got == [("Label no. 4", "c_r"), ("Other", "b_r")]


def test_resolve_property(spark):
    assert len(PROPERTY_LABELS) == 70
    req = spark.createDataFrame([("Total Clay - Rep Value",), ("Kf ",), ("nonsense",)], "label string")
    got = {r.label: r.code for r in resolve_property(req, catalog_frame(spark)).collect()}
    assert got == {"Total Clay - Rep Value": "claytotal_r", "Kf ": "kffact", "nonsense": None}


def test_text_helpers(spark):
    from loam.functions.text import any_like, report_rule_name, request_list, text_eq, unescape_entities

    assert report_rule_name("NSSC:ENG - Roads{:} and \"Streets\"") == "ENG - Roads; and Streets"
    assert report_rule_name("ENG - Roads{:} Streets") == "ENG - Roads; Streets"
    # the service tools keep a prefix and only read {:} as ;
    assert request_list(" NSSC:A{:} b ; 'C';; C") == ["NSSC:A; b", "C"]
    df = spark.createDataFrame([("a &amp;lt; b &gt; c", "YES"), (None, "no")], "t string, f string")
    got = df.select(unescape_entities("t").alias("t"), text_eq("f", "Yes").alias("y"), any_like("f", ["n%"]).alias("n")).collect()
    assert [tuple(r) for r in got] == [("a &lt; b > c", True, False), (None, False, True)]


def test_flag_filter_reaches_the_scan(spark, scratch):
    from loam.operators.filters import filter_major

    spark.createDataFrame([("c", "yes"), ("d", "No")], "cokey string, majcompflag string").write.parquet(scratch + "/c")
    df = filter_major(spark.read.parquet(scratch + "/c"))
    assert [r.cokey for r in df.collect()] == ["c"]
    assert "In(majcompflag" in df._jdf.queryExecution().executedPlan().toString()


def test_tabular_xml_and_lenient_cast(spark, scratch):
    from loam.sources.tabular import cast_columns_lenient, read_tabular_xml

    path = os.path.join(scratch, "resp.xml")
    with open(path, "w") as f:
        f.write("<NewDataSet><Table><mukey>1</mukey><v>2.5</v><n>x</n></Table>"
                "<Table><mukey>2</mukey><n>7</n></Table></NewDataSet>")
    df = read_tabular_xml(spark, path, ["mukey", "v", "n"])
    typed = cast_columns_lenient(df, ["mukey"], ["v"], ["n"])
    got = sorted(tuple(r) for r in typed.collect())
    assert got == [("1", 2.5, None), ("2", None, 7)]


def test_soil_tables_roundtrip(spark, scratch):
    from loam.sources.fixtures import SoilFixture
    from loam.sources.soil_tables import SoilTables, fixture_tables, write_soil_tables

    fx = SoilFixture(spark, "/root/testdata/sf0.001")
    write_soil_tables(fixture_tables(fx), scratch)
    st = SoilTables(spark, scratch)
    assert st.component.count() == fx.component.count()
    assert st.report_lines("area").count() == fx.report_lines("area").count()
    with pytest.raises(AttributeError):
        st.nonexistent


def test_soil_tables_by_uri_with_every_property(spark, scratch):
    from loam.operators import properties as P
    from loam.operators.joins import mapunit_frame
    from loam.schemas import HORIZON_PROPERTIES, property_level
    from loam.sources.fixtures import SoilFixture
    from loam.sources.soil_tables import SoilTables, read_soil_tables, write_soil_tables

    fx = SoilFixture(spark, "/root/testdata/sf0.001")
    names = ("legend", "mapunit", "component", "chorizon", "chtexturegrp")
    write_soil_tables({n: getattr(fx, n) for n in names}, scratch + "/db", files=2, rows_per_file=2000)
    st = SoilTables(spark, "file://" + scratch + "/db")
    assert len(HORIZON_PROPERTIES) + 11 == 70 and set(HORIZON_PROPERTIES) < set(st.chorizon.columns)
    mu = mapunit_frame(st.legend, st.mapunit)
    wide = P.prop_weighted_avg(mu, st.component, st.chorizon, st.chtexturegrp, ["sandtotal_r", "ksat_r"], 0, 100)
    assert wide.filter("sandtotal_r > 0").count() > 0
    assert property_level("hydgrp") == "component" and property_level("ksat_r") == "horizon"
    with pytest.raises(ValueError, match="hydgrp is a component property"):
        P.prop_weighted_avg(mu, st.component, st.chorizon, st.chtexturegrp, "hydgrp", 0, 100)
    with pytest.raises(ValueError, match="ksat_r is a horizon property"):
        P.prop_dom_cond(mu, st.component, "ksat_r")
    with pytest.raises(FileNotFoundError):
        read_soil_tables(spark, "file://" + scratch + "/nothing")
    with pytest.raises(FileNotFoundError):
        read_soil_tables(spark, scratch + "/db", ["legend", "cointerp"])


def test_tables_by_area_read_only_their_folders(spark, scratch):
    from loam.operators import properties as P
    from loam.operators.joins import mapunit_frame
    from loam.sources.fixtures import SoilFixture
    from loam.sources.soil_tables import SoilTables, write_soil_tables

    fx = SoilFixture(spark, "/root/testdata/sf0.001")
    names = ("legend", "mapunit", "component", "chorizon", "chtexturegrp", "cointerp", "copmgrp")
    write_soil_tables({n: getattr(fx, n) for n in names}, scratch, files=3, by_area=True)
    every, two = SoilTables(spark, scratch), SoilTables(spark, scratch, ["NC001", "NC003"])
    for n in names:
        assert getattr(every, n).count() == getattr(fx, n).count()
    legend = two.legend.filter("areasymbol in ('NC001', 'NC003')")
    got = P.prop_weighted_avg(mapunit_frame(legend, two.mapunit), two.component, two.chorizon, two.chtexturegrp, "om_r", 0, 100)
    whole = P.prop_weighted_avg(mapunit_frame(fx.legend, fx.mapunit), fx.component, fx.chorizon, fx.chtexturegrp, "om_r", 0, 100)
    want = whole.filter("areasymbol in ('NC001', 'NC003')")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    plan = two.chorizon._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [areasymbol" in plan


def test_checkpoint_folder_must_be_shared_on_a_cluster():
    from loam.session import ensure_checkpoint_dir

    class Conf:
        def get(self, key, default):
            return default

    class Session:
        conf = Conf()
        sparkContext = type("Context", (), {"master": "spark://head:7077"})()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())


def test_filter_area_equality_and_like(spark):
    from loam.operators.filters import filter_area, requested_areas

    legend = spark.createDataFrame([("1", "IA001"), ("2", "IA015"), ("3", "MN001")], "lkey string, areasymbol string")
    eq = sorted(r.areasymbol for r in filter_area(legend, "IA001; MN001").collect())
    like = sorted(r.areasymbol for r in filter_area(legend, ["ia0%"]).collect())
    assert eq == ["IA001", "MN001"] and like == ["IA001", "IA015"]
    assert filter_area(legend, ["ia001"], case_sensitive=True).count() == 0
    wanted = spark.createDataFrame([("mn001",), ("zz999",)], "areasymbol string")
    assert [r.areasymbol for r in filter_area(legend, wanted).collect()] == ["MN001"]
    for request in (wanted, "mn001; zz999", ["MN%", "zz999"]):
        assert sorted(r.areasymbol for r in requested_areas(legend, request).collect()) == ["MN001", "zz999"]
    assert filter_area(legend, None).count() == 3


def test_restrict_to_mapunits(spark):
    from helpers import comp, hz, mapunits, table

    from loam.operators.filters import restrict_to_mapunits

    mu = mapunits(spark, ["m1"])
    c = table(spark, "component", [comp("c1", "m1", 50), comp("c2", "m2", 50)])
    h = table(spark, "chorizon", [hz("h1", "c1", 0, 10), hz("h2", "c2", 0, 10), hz("h3", "c9", 0, 10)])
    comps, hzs = restrict_to_mapunits(mu, c, h)
    assert [r.cokey for r in comps.collect()] == ["c1"]
    assert [r.chkey for r in hzs.collect()] == ["h1"]


def test_cluster_conf(spark):
    from loam.session import cluster_conf

    conf = cluster_conf(100 * 2**40)
    assert int(conf["spark.sql.shuffle.partitions"]) == 409600
    assert cluster_conf(1)["spark.sql.shuffle.partitions"] == "200"
    for k, v in conf.items():
        if k != "spark.sql.shuffle.partitions":
            spark.conf.set(k, v)
    assert spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"


def test_requests_without_a_match_are_listed_patterns_too(spark):
    legend = spark.createDataFrame([("1", "NC001"), ("2", "NC002")], "lkey string, areasymbol string")
    got = sorted(r.areasymbol for r in requested_areas(legend, "NC001;ZZ%;ZZ999;nc00_;N_X").collect())
    assert got == ["NC001", "NC002", "N_X", "ZZ%", "ZZ999"]
    assert sorted(r.areasymbol for r in requested_areas(legend.limit(0), ["A%", "B"]).collect()) == ["A%", "B"]
    assert requested_areas(legend, "").count() == 0


def test_partial_writes_keep_other_areas_and_survive_a_failure(spark, scratch):
    path = scratch + "/t"
    rows = lambda *r: spark.createDataFrame(list(r), "mukey string, v int, areasymbol string")
    read = lambda: sorted(tuple(r) for r in B.read_areas(spark, path, rows(("1", 1, "A")).schema).collect())
    B.write_areas(rows(("1", 1, "A"), ("2", 2, "B"), ("3", 3, "C")), path, ["A", "B", "C"], "one")
    B.write_areas(rows(("2", 20, "B"), ("4", 40, "D")), path, ["B", "C", "D"], "two")   # overlaps; C has no rows now
    want = [("1", 1, "A"), ("2", 20, "B"), ("4", 40, "D")]
    assert read() == want
    B.write_areas(rows(("2", 20, "B"), ("4", 40, "D")), path, ["B", "C", "D"], "two")   # the same again
    assert read() == want
    failing = rows(("1", 9, "A"), ("2", 9, "B")).withColumn("v", F.when(F.col("mukey") == "2", F.raise_error(F.lit("lost"))).otherwise(F.col("v")))
    for bad, areas in ((failing, ["A", "B"]), (rows(("1", 9, "A"), ("5", 9, "E")), ["A"])):
        with pytest.raises(Exception, match="lost|not asked for"):
            B.write_areas(bad, path, areas, "three")
        assert read() == want
    marks = sorted(tuple(r) for r in B.finished_runs(spark, path).collect())
    assert marks == [("one", "A", 1), ("one", "B", 1), ("one", "C", 1), ("two", "B", 1), ("two", "C", 0), ("two", "D", 1)]


def test_broken_xml_records_are_listed(spark, scratch):
    from loam.sources.tabular import read_tabular_xml, tabular_xml_rejects

    text = "<r><Table><a>1</a><b>x</b></Table><Table><a>2</a><b>y</Table><Table><a>3</a></Table></r>"
    with open(scratch + "/x.xml", "w") as f:
        f.write(text)
    good = read_tabular_xml(spark, scratch + "/x.xml", ["a", "b"])
    assert sorted((r.a, r.b) for r in good.collect()) == [("1", "x"), ("3", None)]
    bad = tabular_xml_rejects(spark, scratch + "/x.xml", ["a", "b"]).collect()
    assert [(r.decoder, r.position, r.reason) for r in bad] == [("tabular xml", None, "not well-formed")]
    assert bad[0].source.endswith("x.xml") and "<a>2</a>" in bad[0].record
