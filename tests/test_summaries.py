"""Hydric rating, parent material and map-unit attributes (Q9, Q10)."""

from helpers import comp, mapunits, table

from loam.operators import summaries as S


def test_hydric_rating_rules(spark):
    mu = mapunits(spark, [f"m{i}" for i in range(1, 8)])
    c = table(spark, "component", [
        comp("a1", "m2", 50, hydric="Yes"), comp("a2", "m2", 50, major="No", hydric="yes"),
        comp("b1", "m3", 80, hydric="Yes"), comp("b2", "m3", 20, major="No", hydric="No"),
        comp("c1", "m4", 60, major="No", hydric="Yes"), comp("c2", "m4", 40, major="No", hydric="No"),
        comp("d1", "m5", 70, hydric="No"), comp("d2", "m5", 30, major="No", hydric="Yes"),
        comp("e1", "m6", 50, hydric="Yes"), comp("e2", "m6", 50, hydric="No"),
        comp("f1", "m7", 50, hydric=None), comp("f2", "m7", 50, hydric="Yes"),
    ])
    got = {r.mukey: r.hydric_rating for r in S.hydric_rating(mu, c).collect()}
    assert got == {
        "m1": "Nonhydric",                 # no component: 0 = 0 + 0
        "m2": "Hydric",
        "m3": "Predominantly Hydric",
        "m4": "Predominantly Hydric",      # Q9: no major component, 0 = 0
        "m5": "Predominantly Nonhydric",
        "m6": "Partially Hydric",
        "m7": "Error",
    }


def test_hydric_counts_add_up(spark):
    mu = mapunits(spark, ["m1"])
    c = table(spark, "component", [comp("a", "m1", 10, hydric="Yes"), comp("b", "m1", 10, major="No", hydric=None),
                                   comp("c", "m1", 10, major="No", hydric="No")])
    r = S.hydric_counts(mu, c).collect()[0]
    assert r.comp_count == r.all_hydric + r.all_not_hydric + r.hydric_null == 3
    assert r.count_maj_comp == r.maj_hydric + r.maj_not_hydric == 1


def test_parent_material_general_first_match(spark):
    mu = mapunits(spark, ["m1", "m2", "m3", "m4", "m5"])
    c = table(spark, "component", [comp(f"c{i}", f"m{i}", 50) for i in range(1, 6)])
    g = table(spark, "copmgrp", [
        ("c1", "calcareous LOESS"), ("c2", "Volcanic ash over till"), ("c3", None), ("c4", "Moon dust"),
        ("c5", "Till"), ("c5", "Alluvium"),
    ])
    got = {r.mukey: r.pmgroupname for r in S.parent_material(mu, c, g, general=True).collect()}
    assert got == {
        "m1": "Eolian Deposits (nonvolcanic)",
        "m2": "Glacial and Periglacial Deposits",  # '%Till%' comes before the volcanic rules
        "m3": "NULL",
        "m4": "NULL",
        "m5": "Waterlaid (or Transported) Deposits",  # Q10: smallest name ('Alluvium') of the component
    }
    raw = {r.mukey: r.pmgroupname for r in S.parent_material(mu, c, g).collect()}
    assert raw["m5"] == "Alluvium" and raw["m3"] is None


def test_muaggatt_lenient_casts(spark):
    from loam.schemas import SOIL_SCHEMAS

    mu = mapunits(spark, ["m1"])
    names = [f.name for f in SOIL_SCHEMAS["muaggatt"].fields]
    row = {n: "x" for n in names}
    row.update(mukey="m1", slopegraddcp="12.5", slopegradwta="n/a", brockdepmin="40", wtdepannmin="4.5",
               mustatus="")
    ma = spark.createDataFrame([tuple(row[n] for n in names)], SOIL_SCHEMAS["muaggatt"])
    r = S.muaggatt_extract(mu, ma).collect()[0]
    assert r.slopegraddcp == 12.5 and r.slopegradwta is None and r.brockdepmin == 40
    assert r.mustatus is None and r.musym == "x" and list(r.asDict())[-1] == "mukey"


def test_general_names_are_found_once_per_name(spark):
    """The rules stand above the distinct names in the plan, not on every row."""
    rows = spark.createDataFrame([("m", "Loess"), ("n", "Loess"), ("o", None), ("p", "loess over till")], "mukey string, pmgroupname string")
    got = S.generalised(rows)
    assert sorted(r.mukey for r in got.collect()) == ["m", "n", "o", "p"]
    plan = got._jdf.queryExecution().optimizedPlan().toString().splitlines()
    rules = next(i for i, line in enumerate(plan) if "CASE WHEN" in line)
    assert plan[rules].count("CASE WHEN") == 1 and "Aggregate [" in "".join(plan[rules : rules + 2])
