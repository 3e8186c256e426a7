"""Tiny hand-made soil tables for unit tests."""

from pyspark.sql import functions as F

from loam.schemas import SOIL_SCHEMAS


# columns that the short row makers below fill; the other columns of the stored tables are NULL
FILLED = {
    "component": ["cokey", "mukey", "compname", "comppct_r", "majcompflag", "hydricrating", "compkind", "drainagecl"],
    "chorizon": ["chkey", "cokey", "hzname", "hzdept_r", "hzdepb_r", "claytotal_r", "om_r"],
}


def table(spark, name, rows):
    schema = SOIL_SCHEMAS[name]
    names = FILLED.get(name, schema.names)
    return spark.createDataFrame([tuple(dict(zip(names, r)).get(c) for c in schema.names) for r in rows], schema)


def mapunits(spark, keys, area="AA001"):
    legend = table(spark, "legend", [("1", area)])
    mapunit = table(spark, "mapunit", [(k, "1", "s" + k, "name " + k) for k in keys])
    from loam.operators.joins import mapunit_frame

    return mapunit_frame(legend, mapunit)


def comp(cokey, mukey, pct, major="Yes", hydric=None, kind="series", drain=None, name=None):
    return (cokey, mukey, name or cokey, pct, major, hydric, kind, drain)


def hz(chkey, cokey, top, bottom, name="Bt", clay=None, om=None):
    return (chkey, cokey, name, top, bottom, clay, om)


def rows(df, order):
    return [r.asDict() for r in df.orderBy(*order).collect()]


def col(df, c, order="mukey"):
    return [r[c] for r in df.orderBy(order).select(c).collect()]


__all__ = ["table", "mapunits", "comp", "hz", "rows", "col", "F"]
