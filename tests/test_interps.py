"""Interpretation rollups on hand-computed tables (Q7, Q8, bands, reasons)."""

import pytest
from helpers import comp, mapunits, table

from loam.functions.interp_bins import LIMITATION_LABELS
from loam.operators import interps as I

R1 = "ENG - Test"


def _ci(cokey, depth, value, cls, design=1, rule=R1):
    return (cokey, rule, depth, design, value, cls)


def _base(spark):
    mu = mapunits(spark, ["m1", "m2", "m3", "m4"])
    c = table(spark, "component", [
        comp("c1", "m1", 60), comp("c2", "m1", 40),
        comp("c3", "m2", 0),
        comp("c4", "m3", 50),
    ])
    ci = table(spark, "cointerp", [
        _ci("c1", 0, 0.5, "Somewhat limited"), _ci("c2", 0, 1.0, "Very limited"),
        _ci("c1", 1, 0.8, "Slope"), _ci("c1", 2, 0.2, "Ponding"), _ci("c1", 3, 0.8, "Slope"),
        _ci("c1", 1, 0.9, "Not limiting"), _ci("c2", 1, 0.3, "Wetness"),
        _ci("c3", 0, 0.5, "Somewhat limited"),
        _ci("c4", 0, None, "Not rated"),
    ])
    return mu, c, ci


def _by_mukey(df):
    return {r.mukey: r for r in df.collect()}


def test_weighted_average(spark):
    mu, c, ci = _base(spark)
    out = _by_mukey(I.interp_weighted_avg(mu, c, ci, [R1]))
    assert set(out) == {"m1", "m2", "m3"}  # m4 has no component
    assert out["m1"].rating == pytest.approx(0.7)
    assert out["m1"]["class"] == LIMITATION_LABELS[3] == "Moderately limited "
    assert out["m1"].reason == "Ponding; Slope; Wetness"
    # Q8: zero percent -> no division error, rating 99 and no class
    assert out["m2"].rating == 99.0 and out["m2"]["class"] is None
    # no rated value -> Not Rated, 99
    assert out["m3"].rating == 99.0 and out["m3"]["class"] == "Not Rated"


def test_dominant_component(spark):
    mu, c, ci = _base(spark)
    out = _by_mukey(I.interp_dom_comp(mu, c, ci, [R1]))
    assert out["m1"].rating == 0.5 and out["m1"]["class"] == "Somewhat limited"
    # distinct (class, value) of the dominant component, value DESC then class
    assert out["m1"].reason == "Slope; Ponding"
    assert out["m3"].rating is None and out["m3"].reason is None


def test_dominant_condition(spark):
    mu, c, ci = _base(spark)
    extra = table(spark, "component", [comp("d1", "m5", 30), comp("d2", "m5", 30), comp("d3", "m5", 50)])
    ci2 = ci.unionByName(table(spark, "cointerp", [
        _ci("d1", 0, 0.2, "Somewhat limited"), _ci("d2", 0, 0.4, "Somewhat limited"), _ci("d3", 0, 1.0, "Very limited"),
    ]))
    mu2 = mapunits(spark, ["m1", "m5"])
    out = _by_mukey(I.interp_dom_cond(mu2, c.unionByName(extra), ci2, [R1]))
    assert out["m1"].rating == 0.5 and out["m1"]["class"] == "Somewhat limited"
    # m5 rating: groups (Somewhat,0.2)=30, (Somewhat,0.4)=30, (Very,1.0)=50 -> top group is Very -> 1.0
    # m5 class: distinct percents Somewhat {30} = 30, Very = 50 -> Very limited
    assert out["m5"].rating == 1.0 and out["m5"]["class"] == "Very limited"


def test_dominant_condition_rating_is_class_mean(spark):
    mu = mapunits(spark, ["m1"])
    c = table(spark, "component", [comp("a", "m1", 40), comp("b", "m1", 35), comp("c", "m1", 25)])
    ci = table(spark, "cointerp", [_ci("a", 0, 0.1, "Slight"), _ci("b", 0, 0.25, "Slight"), _ci("c", 0, 0.9, "Severe")])
    out = I.interp_dom_cond(mu, c, ci, [R1]).collect()[0]
    # top group (Slight, 0.1); mean of the distinct Slight values (0.1 + 0.25) / 2 = 0.175 -> 0.18 (half up)
    assert out.rating == 0.18
    # classes: Slight 40+35 = 75 beats Severe 25
    assert out["class"] == "Slight"


def test_duplicate_overall_rows_raise(spark):
    """Q7: two depth-0 rows for one component and rule is an error, as in the scalar subquery."""
    mu, c, ci = _base(spark)
    dup = ci.unionByName(table(spark, "cointerp", [_ci("c1", 0, 0.7, "Very limited")]))
    with pytest.raises(Exception):
        I.interp_dom_comp(mu, c, dup, [R1]).collect()


def test_reason_is_whole_unless_cut(spark):
    mu = mapunits(spark, ["m1"])
    c = table(spark, "component", [comp("c1", "m1", 100)])
    rows = [_ci("c1", 0, 0.5, "Somewhat limited")] + [_ci("c1", i + 1, i / 1000, f"{i:04d}" + "x" * 60)
                                                       for i in range(40)]
    out = I.interp_weighted_avg(mu, c, table(spark, "cointerp", rows), [R1]).collect()[0]
    assert out.reason.count("; ") == 39 and out.reason.startswith("0000")
    cut = I.interp_weighted_avg(mu, c, table(spark, "cointerp", rows), [R1], reason_chars=I.SERVICE_REASON_CHARS)
    assert cut.collect()[0].reason == out.reason[:1000]


def test_suitability_bands(spark):
    from pyspark.sql import functions as F

    from loam.functions.interp_bins import interp_class_bins

    df = spark.createDataFrame([(x,) for x in [0.0, 0.2, 0.5, 0.8, 1.0, 1.5]], "r double")
    got = [r.c for r in df.select(interp_class_bins(F.lit(1.0), F.col("r"), F.lit("suitability")).alias("c"))
           .collect()]
    assert got == ["Not suited", "Poorly suited", "Moderately suited", "Moderately well suited", "Well suited", None]
