"""Invariants over the fixture."""

import pytest
from pyspark.sql import functions as F

from loam.operators import properties as P
from loam.operators.joins import mapunit_frame
from loam.plans.registry import PLANS
from loam.sources.fixtures import SoilFixture

SF = "/root/testdata/sf0.001"
PER_MAPUNIT = ["prop_dom_comp_cat", "prop_dom_cond", "prop_weighted_avg", "prop_dom_comp_num", "prop_min",
               "prop_max", "prop_multi", "hydric_counts", "hydric_rating", "parent_material",
               "parent_material_general", "muaggatt_extract"]
PER_MAPUNIT_RULE = ["interp_dom_comp", "interp_dom_cond", "interp_weighted_avg", "interp_reasons_all"]


@pytest.fixture(scope="module")
def fx(spark):
    return SoilFixture(spark, SF)


@pytest.mark.parametrize("name", PER_MAPUNIT + PER_MAPUNIT_RULE)
def test_one_row_per_key(fx, name):
    df = PLANS[name](fx)
    keys = ["mukey"] + (["mrulename"] if name in PER_MAPUNIT_RULE else [])
    assert df.count() == df.select(*keys).distinct().count() > 0


def test_min_not_above_max(fx):
    mu = mapunit_frame(fx.legend, fx.mapunit)
    lo = P.prop_min_max(mu, fx.component, fx.chorizon, "claytotal_r", "MIN").withColumnRenamed("claytotal_r", "lo")
    hi = P.prop_min_max(mu, fx.component, fx.chorizon, "claytotal_r", "MAX").select("mukey", F.col("claytotal_r")
                                                                                   .alias("hi"))
    j = lo.join(hi, "mukey")
    assert j.filter(F.col("lo") > F.col("hi")).count() == 0
    assert j.filter(F.col("lo").isNull() != F.col("hi").isNull()).count() == 0


def test_weighted_value_within_range(fx):
    """Weights sum to at most 1.01 and values are >= 0, so the result lies in [0, 1.01 x largest value]."""
    mu = mapunit_frame(fx.legend, fx.mapunit)
    out = P.prop_weighted_avg(mu, fx.component, fx.chorizon, fx.chtexturegrp, "claytotal_r", 0, 100)
    top = (fx.chorizon.join(fx.component.select("cokey", "mukey"), "cokey")
           .groupBy("mukey").agg(F.max("claytotal_r").alias("vmax")))
    j = out.join(top, "mukey", "left")
    assert j.filter((F.col("claytotal_r") < 0) | (F.col("claytotal_r") > F.col("vmax") * 1.01 + 0.01)).count() == 0
