"""Soil property rollups: horizon -> component -> map unit.

Output of every method: ``areasymbol, musym, muname, mukey, int_mukey, <prop>``
(one row per map unit).  The reference sends one query per area and property;
here one plan covers every area (and, for ``prop_multi``, every property).

Decimal chain of the weighted methods (our definition, SURVEY 7.3):
thickness and value are ``decimal(5,2)``; ``thickness / sum_thickness`` is
``decimal(13,8)``; times value ``decimal(19,10)``; the component mean is its
sum; the component weight is ``decimal(12,2)``; weight x mean is
``decimal(38,8)``; the map-unit value is cast to ``decimal(5,2)`` and emitted
as DOUBLE.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loam.functions.keys import HASHED, hashed
from loam.functions.numeric import dec52
from loam.operators.dominant import dominant_component, dominance_order
from loam.operators.filters import (
    filter_horizon_depth,
    filter_major,
    filter_mineral_horizon,
    filter_profile_horizon,
    filter_texture,
)
from loam.schemas import COMPONENT_PROPERTIES, HORIZON_PROPERTIES, property_level

KEY_COLS = ["areasymbol", "musym", "muname", "mukey", "int_mukey"]


# ---------------------------------------------------------------------------
# dominant component / dominant condition (component-level columns)
# ---------------------------------------------------------------------------
def _codes(prop: str | Sequence[str], level: str) -> list[str]:
    """Property codes of a request; a catalogue code of the other table is refused."""
    codes = [prop] if isinstance(prop, str) else list(prop)
    for c in codes:
        if c in (HORIZON_PROPERTIES if level == "component" else COMPONENT_PROPERTIES):
            raise ValueError(f"{c} is a {property_level(c)} property; this method needs a {level} property")
    return codes


def prop_dom_comp_cat(mapunits: DataFrame, component: DataFrame, prop: str | Sequence[str]) -> DataFrame:
    """Component columns of the dominant component (map units without components are absent); one or several."""
    props = _codes(prop, "component")
    dom = dominant_component(component, props)
    return mapunits.join(dom.select("mukey", *props), "mukey", "inner").select(*KEY_COLS, *props)


def prop_dom_cond(mapunits: DataFrame, component: DataFrame, prop: str | Sequence[str],
                  distinct_pct: bool = True) -> DataFrame:
    """Most extensive value of a component column per map unit; several columns from one component scan.

    Percent is summed over *distinct* (value, percent) pairs (SURVEY Q3;
    ``distinct_pct=False`` sums plainly).  NULL is a candidate value.  Ties go
    to the smallest value, NULL last (Q4).
    """
    props = _codes(prop, "component")
    types = dict(component.select(*props).dtypes)
    # one row per component and column, values side by side by type, so that ties compare as what they are
    texts = [p for p in props if types[p] == "string"]
    value = [F.struct(F.lit(i).alias("_prop"),
                      (F.col(p) if p in texts else F.lit(None).cast("string")).alias("_text"),
                      (F.lit(None).cast("double") if p in texts else F.col(p).cast("double")).alias("_number"))
             for i, p in enumerate(props)]
    # components move once, by map unit; one sort there (which spills) serves the sums and the pick
    dealt = component.filter(F.col("mukey").isNotNull()).select("mukey", "comppct_r", *props).repartition("mukey")
    long = dealt.select("mukey", "comppct_r", F.inline(F.array(*value)))
    same = Window.partitionBy("mukey", "_prop", "_text", "_number")
    if distinct_pct:
        again = F.lag("comppct_r").over(same.orderBy("comppct_r")) == F.col("comppct_r")
        long = long.withColumn("_counts", ~F.coalesce(again, F.lit(False)))
    pct = F.when(F.col("_counts"), F.col("comppct_r")) if distinct_pct else F.col("comppct_r")
    per_value = long.withColumn("_pct", F.sum(pct).over(same))
    empty = F.col("_text").isNull() & F.col("_number").isNull()
    order = F.struct(F.col("_pct").isNull(), -F.col("_pct"), empty, F.col("_text"), F.col("_number"))
    picked = [F.min_by(F.col("_text" if p in texts else "_number"), F.when(F.col("_prop") == i, order)).cast(types[p])
              .alias(p) for i, p in enumerate(props)]
    best = per_value.groupBy("mukey").agg(*picked)
    return mapunits.join(best, "mukey", "inner").select(*KEY_COLS, *props)


# ---------------------------------------------------------------------------
# weighted average building blocks
# ---------------------------------------------------------------------------
def depth_clip(top: int, bottom: int):
    """(clipped top, clipped bottom) of a horizon against the depth range."""
    t = F.when(F.col("hzdept_r") < F.lit(top), F.lit(top)).otherwise(F.col("hzdept_r"))
    b = F.when(F.col("hzdepb_r") > F.lit(bottom), F.lit(bottom)).otherwise(F.col("hzdepb_r"))
    return t, b


def usable_horizons(chorizon: DataFrame, chtexturegrp: DataFrame, props: Sequence[str], top: int, bottom: int,
                    case_sensitive: bool = False, selected: bool = False) -> DataFrame:
    """Horizon rows that enter a weighted rollup, with clipped thickness, decimal values and a multiplicity.

    Several representative texture rows repeat the horizon (SURVEY Q6): the
    texture rows are counted per horizon first (``_ntex``), so each horizon
    enters the join once and carries its count.  Both sides meet by a hash of
    the horizon's key, and go on with one of the component's (:data:`HASHED`);
    texture rows that carry their component's key (bucketed tables) meet the
    horizons by the keys as they are, so in the same partition.
    NULL values count as 0 (Q2).
    """
    stored = "cokey" in chtexturegrp.columns
    by = ["cokey", "chkey"] if stored else ["chkey"]
    hz = chorizon.select("chkey", "cokey", "hzname", "hzdept_r", "hzdepb_r", *props)
    hz = filter_mineral_horizon(filter_horizon_depth(hz, top, bottom), case_sensitive)
    tex = filter_texture(chtexturegrp.select(*by, "rvindicator", "texture"), case_sensitive)
    if selected:
        # the horizons are few: texture rows of others go before the shuffle (a broadcast by Spark's size check)
        tex = tex.join(hz.select(*by), by, "left_semi")
    component = ["cokey"] if stored else HASHED
    if not stored:
        by = ["_h1", "_h2"]
        tex = tex.filter(F.col("chkey").isNotNull()).select(*hashed("chkey", by)).repartition(*by)
        hz = hz.filter(F.col("chkey").isNotNull()).select(*hashed("chkey", by), *hashed("cokey"), "hzdept_r", "hzdepb_r", *props)
    t, b = depth_clip(top, bottom)
    hz = hz.select(*dict.fromkeys([*by, *component]), (b - t).alias("_thk_int"), *props)
    tex_n = tex.groupBy(*by).agg(F.count(F.lit(1)).alias("_ntex"))
    # a value out of range raises here, so only for a horizon that counts
    return hz.join(tex_n, by, "inner").select(
        *component, "_thk_int", dec52(F.col("_thk_int")).alias("thickness"),
        *[dec52(F.coalesce(F.col(p), F.lit(0))).alias(p) for p in props], "_ntex",
    )


def _component_key(rows: DataFrame) -> list[str]:
    return ["cokey"] if "cokey" in rows.columns else HASHED


def thickness_total(rows: DataFrame, count: str = "_ntex") -> DataFrame:
    """Per component: total clipped thickness (each row counted with its multiplicity) as decimal(5,2)."""
    return rows.groupBy(*_component_key(rows)).agg(dec52(F.sum(F.col("_thk_int") * F.col(count))).alias("sum_thickness"))


MEAN_TYPE = "decimal(29,10)"  # sum of decimal(19,10) terms
SLICE_TYPE = "decimal(15,2)"  # a value times its multiplicity


def component_mean(rows: DataFrame, props: Sequence[str]) -> DataFrame:
    """Per component: sum over horizon rows of (thickness / total thickness) x value.

    The rows move once, by component; there the total is a window and the mean
    an aggregate, both on that one partitioning.
    """
    key = _component_key(rows)
    total = dec52(F.sum(F.col("_thk_int") * F.col("_ntex")).over(Window.partitionBy(*key)))
    ratio = dec52(F.col("_thk_int")) / F.col("sum_thickness")
    value = {p: (F.col(p) * F.col("_ntex").cast("int")).cast(SLICE_TYPE) for p in props}
    return rows.withColumn("sum_thickness", total).groupBy(*key).agg(
        *[F.sum(ratio * value[p]).cast(MEAN_TYPE).alias(p) for p in props]
    )


def component_weight(pct: str = "comppct_r", sum_pct: str = "_sum_pct"):
    """Share of a component's percent among the components of its map unit (a column expression).

    Exactly 1 when it is alone (``pct = sum``), else
    ``cast(cast(pct as decimal(5,2)) / cast(sum as decimal(5,2)) as decimal(5,2))``.
    """
    return F.when(F.col(pct) == F.col(sum_pct), F.lit(1)).otherwise(dec52(dec52(F.col(pct)) / dec52(F.col(sum_pct))))


def mapunit_total(comps: DataFrame, means: DataFrame, props: Sequence[str]) -> DataFrame:
    """Per map unit: decimal(5,2) of sum(weight x component mean), as DOUBLE.

    ``comps`` are the weighted components (mukey, cokey, comppct_r); all of
    them share the weight, also those without usable horizons (SURVEY Q2).
    ``means`` are by component key or by its hash.  Components move by that key
    to their means, then by map unit once: there the percent total is a window.
    """
    key = _component_key(means)
    there = comps.filter(F.col("mukey").isNotNull())
    c = there.select("mukey", *(["cokey"] if key == ["cokey"] else hashed("cokey")), "comppct_r")
    whole = Window.partitionBy("mukey")
    j = c.join(means, key, "left").withColumn("_sum_pct", F.sum("comppct_r").over(whole)).withColumn("_w", component_weight())
    return j.groupBy("mukey").agg(*[dec52(F.sum(F.col("_w") * F.col(p))).cast("double").alias(p) for p in props])


def _weighted(mapunits: DataFrame, comps: DataFrame, chorizon: DataFrame, chtexturegrp: DataFrame,
              prop: str | Sequence[str], top: int, bottom: int, case_sensitive: bool, selected: bool) -> DataFrame:
    props = _codes(prop, "horizon")
    rows = usable_horizons(chorizon, chtexturegrp, props, top, bottom, case_sensitive, selected)
    means = component_mean(rows, props)
    totals = mapunit_total(comps, means, props)
    # every selected map unit is kept; units with nothing usable get NULL
    return mapunits.join(totals, "mukey", "left").select(*KEY_COLS, *props)


def prop_weighted_avg(mapunits: DataFrame, component: DataFrame, chorizon: DataFrame, chtexturegrp: DataFrame,
                      prop: str | Sequence[str], top: int, bottom: int, case_sensitive: bool = False,
                      selected: bool = False) -> DataFrame:
    """Component-percent weighted, thickness-weighted average over the major components.

    Several properties share one horizon scan and one thickness.  ``selected``
    says that component and chorizon hold a selection of the map units.
    """
    majors = filter_major(component.select("mukey", "cokey", "comppct_r", "majcompflag"), case_sensitive)
    return _weighted(mapunits, majors, chorizon, chtexturegrp, prop, top, bottom, case_sensitive, selected)


def prop_dom_comp_num(mapunits: DataFrame, component: DataFrame, chorizon: DataFrame, chtexturegrp: DataFrame,
                      prop: str | Sequence[str], top: int, bottom: int, case_sensitive: bool = False,
                      selected: bool = False) -> DataFrame:
    """Thickness-weighted average on the dominant component, NULL unless it is major; one or several."""
    dom = dominant_component(component, ["comppct_r", "majcompflag"])
    majors = filter_major(dom, case_sensitive)
    return _weighted(mapunits, majors, chorizon, chtexturegrp, prop, top, bottom, case_sensitive, selected)


def prop_min_max(mapunits: DataFrame, component: DataFrame, chorizon: DataFrame, prop: str | Sequence[str],
                 stat: str = "MIN", case_sensitive: bool = False) -> DataFrame:
    """MIN or MAX of horizon columns over the dominant component's whole profile; one or several.

    Horizons are reduced to one row per component first (partial
    aggregation), then joined to the dominant components.
    """
    props = _codes(prop, "horizon")
    agg = F.min if stat.upper() == "MIN" else F.max
    hz = filter_profile_horizon(chorizon.select("cokey", "hzname", "hzdept_r", *props), case_sensitive)
    per_comp = hz.groupBy("cokey").agg(*[agg(p).alias(p) for p in props])
    dom = dominant_component(component)
    vals = dom.join(per_comp, "cokey", "left").select("mukey", *props)
    return mapunits.join(vals, "mukey", "inner").select(*KEY_COLS, *props)


def prop_multi(method: str, mapunits: DataFrame, component: DataFrame, chorizon: DataFrame, chtexturegrp: DataFrame,
               props: Sequence[str], top: int = 0, bottom: int = 100, stat: str = "MIN",
               case_sensitive: bool = False, selected: bool = False) -> DataFrame:
    """Wide table of several properties by one method of the property tools, in one plan."""
    props = list(props)
    if method == "Dominant Component (Category)":
        return prop_dom_comp_cat(mapunits, component, props)
    if method == "Dominant Condition":
        return prop_dom_cond(mapunits, component, props)
    if method == "Min\\Max":
        return prop_min_max(mapunits, component, chorizon, props, stat, case_sensitive)
    weighted = {"Weighted Average": prop_weighted_avg, "Dominant Component (Numeric)": prop_dom_comp_num}.get(method)
    if weighted is None:
        raise ValueError(f"unable to determine aggregation method: {method}")
    return weighted(mapunits, component, chorizon, chtexturegrp, props, top, bottom, case_sensitive, selected)


__all__ = [
    "prop_dom_comp_cat", "prop_dom_cond", "prop_weighted_avg", "prop_dom_comp_num", "prop_multi", "prop_min_max",
    "depth_clip", "usable_horizons", "thickness_total", "component_mean", "component_weight", "mapunit_total",
    "dominance_order",
]
