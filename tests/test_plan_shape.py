"""Shapes of plans that keep shuffles, memory and time in proportion to the input."""

from helpers import F, comp, hz, mapunits, rows, table

from loam.operators import interps as I
from loam.operators import properties as P
from loam.session import stored


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df):
    return [line for line in plan(df).splitlines() if "Exchange hashpartitioning" in line]


def rated(spark):
    component = table(spark, "component", [comp("c1", "1", 60), comp("c2", "1", 40)])
    schema = "cokey string, mrulename string, ruledepth int, ruledesign int, interphr double, interphrc string"
    ci = spark.createDataFrame([("c1", "R", 0, 1, 0.5, "b"), ("c2", "R", 0, 1, 0.1, "a"), ("c1", "R", 1, 1, 0.2, "Slope")], schema)
    return mapunits(spark, ["1"]), component, ci


def test_dominant_condition_of_ratings_gathers_no_rows(spark):
    found = I.interp_dom_cond(*rated(spark), ["R"])
    assert "collect_" not in plan(found)
    assert [(r["rating"], r["class"], r["reason"]) for r in rows(found, ["mukey"])] == [(0.5, "b", "Slope")]


def test_weighted_ratings_gather_distinct_reasons_only(spark):
    found = I.interp_weighted_avg(*rated(spark), ["R"])
    assert "collect_set" not in plan(found)
    assert [(r["rating"], r["reason"]) for r in rows(found, ["mukey"])] == [(0.34, "Slope")]


def test_dominant_condition_moves_components_once(spark):
    component = table(spark, "component", [comp("c1", "1", 60, drain="wet"), comp("c2", "1", 40, drain="dry"), comp("c3", "1", 40, drain="dry")])
    found = P.prop_dom_cond(mapunits(spark, ["1"]), component, ["drainagecl", "compname"])
    assert not [line for line in exchanges(found) if "_prop" in line]
    assert [r["drainagecl"] for r in rows(found, ["mukey"])] == ["wet"]  # the repeated 40 counts once


def test_component_means_move_horizons_once(spark):
    hzs = table(spark, "chorizon", [hz("h1", "c1", 0, 10, clay=10.0), hz("h2", "c1", 10, 40, clay=30.0)])
    tex = spark.createDataFrame([("h1", "Yes", "L"), ("h2", "Yes", "L")], "chkey string, rvindicator string, texture string")
    means = P.component_mean(P.usable_horizons(hzs, tex, ["claytotal_r"], 0, 100), ["claytotal_r"])
    assert not [line for line in exchanges(means) if "_thk_int" in line]
    assert [float(r["claytotal_r"]) for r in means.collect()] == [25.0]


def test_stored_selection_has_its_size(spark):
    big = spark.range(1 << 22).select(F.col("id").cast("string").alias("k"))
    few = big.filter(F.rand(3) < 0.00001)
    assert "BroadcastHashJoin" in plan(big.join(stored(few), "k", "left_semi"))
