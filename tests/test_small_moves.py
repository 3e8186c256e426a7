"""Rollups of large tables move few and short rows, and give the same results for odd keys and texts."""

from contextlib import contextmanager

from helpers import comp, hz, mapunits, rows, table
from test_plan_shape import exchanges, rated

from loam.operators import bookkeeping as B
from loam.operators import interps as I
from loam.operators import properties as P
from loam.operators.dominant import dominant_component


@contextmanager
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.set(key, "-1")
    try:
        yield
    finally:
        spark.conf.unset(key)


def ci(cokey, depth, value, cls, design=1, rule="R"):
    return (cokey, rule, depth, design, value, cls)


def odd(spark):
    """Components without key or rows, repeated ones, classes with any sign in them."""
    component = table(spark, "component", [
        comp("c1", "1", 60), comp("c1", "1", 60), comp("c2", "1", 40), comp(None, "2", 50), comp("c4", "3", 10),
        comp("c5", None, 10), comp("c6", "4", 30, kind="Miscellaneous area"), comp("c7", "4", None)])
    ratings = table(spark, "cointerp", [
        ci("c1", 0, 0.5, "b"), ci("c2", 0, 1e-7, "a|:"), ci("c2", 0, 1e-7, "a|:"), ci("c1", 1, 0.2, "x|:\x01y"), ci("c2", 1, 0.3, "\x02a\x02b\x01\x01"),
        ci("c2", 2, None, ""), ci("c2", 3, 0.1, "Not much"), ci(None, 0, 1.0, "z"), ci("c4", 1, 0.4, "Slope"), ci("c5", 0, 1.0, "c"),
        ci("c6", 0, 0.25, "d", design=2), ci("c6", 1, 0.9, "Misc"), ci("c7", 0, 0.75, "e", design=None), ci("c9", 0, 0.75, "e"), ci("c1", 0, 0.5, "b", rule="S")])
    return mapunits(spark, ["1", "2", "3", "4", "5"]), component, ratings


def test_weighted_ratings_move_by_component_and_map_unit_once(spark):
    with no_broadcast(spark):
        moved = exchanges(I.interp_weighted_avg(*rated(spark), ["R", "S"]))
    keys = [line.split("hashpartitioning(")[1].split(", 8)")[0] for line in moved]
    assert not [k for k in keys if "mrulename" in k or "cokey" in k]  # no text keys, no shuffle by rule
    assert sum("mukey" in k for k in keys) == 2  # components' rows, map units


def test_weighted_ratings_of_odd_rows(spark):
    mu, component, ratings = odd(spark)
    got = rows(I.interp_weighted_avg(mu, component, ratings, ["R", "S", "S"]), ["mukey", "mrulename"])
    found = [(r["mukey"], r["mrulename"], r["rating"], r["class"], r["reason"]) for r in got]
    # 60 x 0.5 twice, 40 x 1e-7 twice, over 200; map unit 2 has no component key, 3 no rating, 5 no component
    why = "; ".join(sorted(["", "\x02a\x02b\x01\x01", "x|:\x01y"]))
    none = (99.0, "Not Rated", None)
    assert found == [
        ("1", "R", 0.3, "Slightly limited ", why), ("1", "S", 0.5, "Somewhat limited ", None), ("1", "S", 0.5, "Somewhat limited ", None),
        ("2", "R", *none), ("2", "S", *none), ("2", "S", *none), ("3", "R", *none[:2], "Slope"), ("3", "S", *none), ("3", "S", *none),
        ("4", "R", 0.25, "Poorly suited", None), ("4", "S", *none), ("4", "S", *none)]


def test_no_rules_no_rows(spark):
    for rollup in (I.interp_weighted_avg, I.interp_dom_cond):
        assert rollup(*rated(spark), []).collect() == []


def test_text_breaks_move_short_rows_too(spark):
    with no_broadcast(spark):
        breaks = B.legend_breaks(I.interp_weighted_avg(*rated(spark), ["R"]), "class")
        assert not [line for line in exchanges(breaks) if "mrulename" in line or "cokey" in line]
        assert [r.break_value for r in breaks.collect()] == ["Somewhat limited "]


def test_dominant_condition_moves_components_and_ratings_once(spark):
    with no_broadcast(spark):
        found = I.interp_dom_cond(*rated(spark), ["R", "S"])
        moved = exchanges(found)
    keys = [line.split("hashpartitioning(")[1].split(", 8)")[0] for line in moved]
    assert not [k for k in keys if "mrulename" in k or "cokey" in k]
    assert sum("_k1" in k for k in keys) == 2 and sum("mukey" in k for k in keys) == 3  # of components, texts, map units


def test_dominant_condition_of_odd_rows(spark):
    mu, component, ratings = odd(spark)
    more = table(spark, "component", [comp(None, "5", 90), comp("c8", "5", 80)])
    extra = table(spark, "cointerp", [
        ci("c1", 2, 0.2, "a"), ci("c1", 3, None, "n"), ci("c1", 3, 0.2, "a"), ci("c1", 4, 0.9, "\x02b|;"), ci("c8", 0, 0.5, "b"), ci("c7", 0, None, None), ci("c7", 0, 0.5, "")])
    got = rows(I.interp_dom_cond(mu, component.unionByName(more), ratings.unionByName(extra), ["R", "S", "S"]), ["mukey", "mrulename"])
    found = [(r["mukey"], r["mrulename"], r["rating"], r["class"], r["reason"]) for r in got]
    # map units 2 and 5 have a dominant component without key: not reported
    why = "\x02b|;; a; x|:\x01y; n"
    assert found == [
        ("1", "R", 0.5, "b", why), ("1", "S", 0.5, "b", None), ("1", "S", 0.5, "b", None),
        ("3", "R", None, None, "Slope"), ("3", "S", None, None, None), ("3", "S", None, None, None),
        ("4", "R", 0.25, "d", None), ("4", "S", None, None, None), ("4", "S", None, None, None)]


def test_weighted_averages_move_by_short_keys(spark):
    component = table(spark, "component", [comp("c1", "1", 60), comp("c2", "1", 40)])
    hzs = table(spark, "chorizon", [hz("h1", "c1", 0, 10, clay=10.0)])
    tex = table(spark, "chtexturegrp", [("h1", "Yes", "L")])
    with no_broadcast(spark):
        moved = exchanges(P.prop_weighted_avg(mapunits(spark, ["1"]), component, hzs, tex, "claytotal_r", 0, 100))
    keys = [line.split("hashpartitioning(")[1].split(", 8)")[0] for line in moved]
    assert not [k for k in keys if "chkey" in k or "cokey" in k]
    assert sum("mukey" in k for k in keys) == 2  # components with their means, map units


def test_weighted_average_of_odd_rows(spark):
    component = table(spark, "component", [
        comp("c1", "1", 60), comp("c1", "1", 60), comp("c2", "1", 40), comp(None, "2", 50), comp("c4", "3", 10), comp("c5", None, 10), comp("c6", "4", None)])
    hzs = table(spark, "chorizon", [
        hz("h1", "c1", 0, 10, clay=10.0), hz("h2", "c1", 10, 30, clay=40.0), hz("h3", "c2", 0, 20, clay=None), hz(None, "c2", 0, 20, clay=9.0),
        hz("h4", None, 0, 20, clay=9.0), hz("h5", "c4", 0, 20, clay=5000.0), hz("h6", "c6", 0, 20, clay=7.0), hz("h1", "c9", 0, 10, clay=1.0)])
    tex = table(spark, "chtexturegrp", [
        ("h1", "Yes", "L"), ("h2", "Yes", "L"), ("h2", "yes", "SIL"), ("h2", "No", "L"), ("h3", "Yes", "L"), (None, "Yes", "L"), ("h4", "Yes", "L"), ("h6", "Yes", "L")])
    got = rows(P.prop_weighted_avg(mapunits(spark, ["1", "2", "3", "4", "5"]), component, hzs, tex, "claytotal_r", 0, 100), ["mukey"])
    # c1: (10 x 10 + 20 x 40 x 2) / 50 = 34, twice at 60 of 160 (0.38); the 5000 of h5 has no texture row, so it does not count
    assert [(r["mukey"], r["claytotal_r"]) for r in got] == [("1", 25.84), ("2", None), ("3", None), ("4", None), ("5", None)]


def test_dominant_component_moves_its_key_once(spark):
    component = table(spark, "component", [comp("c2", "1", 60, drain="wet"), comp("c1", "1", 60, drain="dry"), comp("c0", "1", None), comp("c3", "2", None)])
    found = dominant_component(component, ["drainagecl", "comppct_r"])
    assert "min_by" not in found._jdf.queryExecution().executedPlan().toString()  # which keeps what it picks beside the order
    assert [tuple(r) for r in found.orderBy("mukey").collect()] == [("1", "c1", "dry", 60), ("2", "c3", None, None)]
