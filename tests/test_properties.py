"""Property rollups on tiny hand-computed soil tables (quirks Q2-Q6 of SURVEY 2.12)."""

import pytest
from helpers import col, comp, hz, mapunits, table

from loam.operators import properties as P
from loam.operators.dominant import dominant_component


def _tex(spark, chkeys, extra=()):
    return table(spark, "chtexturegrp", [(k, "Yes", "L") for k in chkeys] + list(extra))


def test_dominant_component_ties_and_nulls(spark):
    c = table(spark, "component", [
        comp("b", "m1", 50), comp("a", "m1", 50), comp("c", "m1", 40),
        comp("x", "m2", None), comp("y", "m2", 10),
        comp("z", "m3", None),
    ])
    d = {r.mukey: r.cokey for r in dominant_component(c).collect()}
    assert d == {"m1": "a", "m2": "y", "m3": "z"}


def test_weighted_average_hand_computed(spark):
    mu = mapunits(spark, ["m1", "m2", "m3"])
    c = table(spark, "component", [
        comp("c1", "m1", 60), comp("c2", "m1", 30), comp("c3", "m1", 10, major="No"),
        comp("c4", "m2", 100, major="No"),
        comp("c5", "m3", 50), comp("c6", "m3", 50),
    ])
    h = table(spark, "chorizon", [
        hz("h1", "c1", 0, 20, clay=10.0), hz("h2", "c1", 20, 50, clay=20.0), hz("h3", "c1", 50, 150, clay=40.0),
        hz("h4", "c2", 0, 40, clay=None), hz("h5", "c2", 40, 100, clay=30.0),
        hz("h6", "c3", 0, 100, clay=99.0), hz("h7", "c4", 0, 100, clay=99.0),
        hz("h8", "c6", 0, 100, clay=50.0),
    ])
    t = _tex(spark, [f"h{i}" for i in range(1, 9)])
    out = P.prop_weighted_avg(mu, c, h, t, "claytotal_r", 0, 100)
    # m1: weights 60/90 -> 0.67, 30/90 -> 0.33; means 28 and 18 (NULL counts as 0)
    # m2: no major component -> NULL but kept; m3: c5 has no horizons yet takes half the weight (Q2)
    assert col(out, "claytotal_r") == [pytest.approx(24.70), None, pytest.approx(25.0)]


def test_weighted_average_filters(spark):
    mu = mapunits(spark, ["m1"])
    c = table(spark, "component", [comp("c1", "m1", 100)])
    h = table(spark, "chorizon", [
        hz("h1", "c1", 0, 10, name="Oi", clay=90.0),        # organic: dropped
        hz("h2", "c1", 10, 30, name="Ap", clay=10.0),
        hz("h3", "c1", 30, 50, name="Bt", clay=30.0),
        hz("h4", "c1", 50, 70, name="R", clay=90.0),         # 'r' (case-insensitive): dropped
        hz("h5", "c1", 70, 80, name=None, clay=90.0),        # NULL name: dropped
        hz("h6", "c1", None, 90, name="C", clay=90.0),       # NULL top depth: dropped
        hz("h7", "c1", 80, 90, name="C", clay=90.0),         # texture MUCK: dropped
        hz("h8", "c1", 90, 100, name="C", clay=90.0),        # no representative texture: dropped
    ])
    t = table(spark, "chtexturegrp", [(f"h{i}", "yes", "SIL") for i in range(1, 7)]
              + [("h7", "Yes", "MUCK"), ("h8", "No", "L")])
    out = P.prop_weighted_avg(mu, c, h, t, "claytotal_r", 0, 100)
    assert col(out, "claytotal_r") == [pytest.approx(20.0)]
    strict = P.prop_weighted_avg(mu, c, h, t, "claytotal_r", 0, 100, case_sensitive=True)
    # case-sensitive (Q1 alternative): bedrock 'R' survives '%r%', so h4 counts: 3 x 0.33333333 x value
    assert col(strict, "claytotal_r") == [pytest.approx(43.33)]


def test_repeated_texture_rows_repeat_the_horizon(spark):
    """Q6: two representative texture rows count a horizon twice (thickness and value)."""
    mu = mapunits(spark, ["m1"])
    c = table(spark, "component", [comp("c1", "m1", 100)])
    h = table(spark, "chorizon", [hz("h1", "c1", 0, 50, clay=10.0), hz("h2", "c1", 50, 100, clay=40.0)])
    t = _tex(spark, ["h1", "h2"], extra=[("h1", "Yes", "CL")])
    out = P.prop_weighted_avg(mu, c, h, t, "claytotal_r", 0, 100)
    # rows (50,10) (50,10) (50,40): 3 x 0.33333333 x value = 19.9999998 -> 20.00 (25.00 without the copy)
    assert col(out, "claytotal_r") == [pytest.approx(20.0)]


def test_value_over_decimal_range_raises(spark):
    mu = mapunits(spark, ["m1"])
    c = table(spark, "component", [comp("c1", "m1", 100)])
    h = table(spark, "chorizon", [hz("h1", "c1", 0, 50, clay=1000.0)])
    with pytest.raises(Exception):
        P.prop_weighted_avg(mu, c, h, _tex(spark, ["h1"]), "claytotal_r", 0, 100).collect()


def test_dominant_component_numeric_needs_major(spark):
    """Q5: a minor dominant component gives NULL."""
    mu = mapunits(spark, ["m1", "m2"])
    c = table(spark, "component", [
        comp("c1", "m1", 60), comp("c2", "m1", 40),
        comp("c3", "m2", 70, major="No"), comp("c4", "m2", 30),
    ])
    h = table(spark, "chorizon", [hz("h1", "c1", 0, 100, clay=28.0), hz("h2", "c2", 0, 100, clay=1.0),
                                  hz("h3", "c3", 0, 100, clay=5.0), hz("h4", "c4", 0, 100, clay=7.0)])
    out = P.prop_dom_comp_num(mu, c, h, _tex(spark, ["h1", "h2", "h3", "h4"]), "claytotal_r", 0, 100)
    assert col(out, "claytotal_r") == [pytest.approx(28.0), None]


def test_min_max_profile_rule(spark):
    mu = mapunits(spark, ["m1", "m2"])
    c = table(spark, "component", [comp("c1", "m1", 60), comp("c2", "m1", 40), comp("c3", "m2", 10)])
    h = table(spark, "chorizon", [
        hz("h1", "c1", 0, 5, name="Oi", clay=1.0),    # organic near the surface: dropped
        hz("h2", "c1", 15, 20, name="Oa", clay=2.0),  # organic deeper than 10: kept
        hz("h3", "c1", 20, 40, name=None, clay=5.0),  # NULL name: kept
        hz("h4", "c1", 40, 60, name="R", clay=99.0),  # bedrock: dropped
        hz("h5", "c1", 60, 80, name="Bt", clay=40.0),
        hz("h6", "c2", 0, 10, name="A", clay=0.5),    # not the dominant component
    ])
    lo = P.prop_min_max(mu, c, h, "claytotal_r", "MIN")
    hi = P.prop_min_max(mu, c, h, "claytotal_r", "max")
    assert col(lo, "claytotal_r") == [2.0, None]
    assert col(hi, "claytotal_r") == [40.0, None]


def test_dominant_condition_distinct_percent_and_ties(spark):
    mu = mapunits(spark, ["m1", "m2", "m3"])
    c = table(spark, "component", [
        comp("a1", "m1", 20, drain="A"), comp("a2", "m1", 20, drain="A"), comp("a3", "m1", 30, drain="B"),
        comp("a4", "m1", 35, drain=None),
        comp("b1", "m2", 30, drain="B"), comp("b2", "m2", 30, drain="A"),
        comp("c1", "m3", 30, drain=None), comp("c2", "m3", 30, drain="B"),
    ])
    out = P.prop_dom_cond(mu, c, "drainagecl")
    # m1: distinct percents A=20, B=30, NULL=35 -> NULL wins (Q3); ties go to the smallest value, NULL last (Q4)
    assert col(out, "drainagecl") == [None, "A", "B"]
    plain = P.prop_dom_cond(mu, c, "drainagecl", distinct_pct=False)
    assert col(plain, "drainagecl") == ["A", "A", "B"]


def test_dom_comp_cat_drops_units_without_components(spark):
    mu = mapunits(spark, ["m1", "m2"])
    c = table(spark, "component", [comp("c1", "m1", 60, drain="Well"), comp("c2", "m1", 70, drain="Poor")])
    out = P.prop_dom_comp_cat(mu, c, "drainagecl")
    assert [(r.mukey, r.drainagecl) for r in out.collect()] == [("m1", "Poor")]


def test_prop_multi_matches_single_runs(spark):
    mu = mapunits(spark, ["m1"])
    c = table(spark, "component", [comp("c1", "m1", 70), comp("c2", "m1", 30)])
    h = table(spark, "chorizon", [hz("h1", "c1", 0, 30, clay=12.0, om=2.375), hz("h2", "c1", 30, 60, clay=24.0, om=1.0),
                                  hz("h3", "c2", 0, 60, clay=33.0, om=None)])
    t = _tex(spark, ["h1", "h2", "h3"])
    wide = P.prop_multi("Weighted Average", mu, c, h, t, ["claytotal_r", "om_r"], 0, 50).collect()[0]
    for p in ["claytotal_r", "om_r"]:
        single = P.prop_weighted_avg(mu, c, h, t, p, 0, 50).collect()[0]
        assert wide[p] == single[p]
