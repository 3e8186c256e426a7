"""Declared schemas of the soil tables (no inference pass over the data)."""

from __future__ import annotations

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

# Muaggatt columns in output order, and those converted to
# floating point and to integer.
MUAGGATT_COLUMNS = ["musym", "muname", "mustatus", "slopegraddcp", "slopegradwta", "brockdepmin", "wtdepannmin",
                    "wtdepaprjunmin", "flodfreqdcd", "flodfreqmax", "pondfreqprs", "aws025wta", "aws050wta",
                    "aws0100wta", "aws0150wta", "drclassdcd", "drclasswettest", "hydgrpdcd", "iccdcd", "iccdcdpct",
                    "niccdcd", "niccdcdpct", "engdwobdcd", "engdwbdcd", "engdwbll", "engdwbml", "engstafdcd",
                    "engstafll", "engstafml", "engsldcd", "engsldcp", "englrsdcd", "engcmssdcd", "engcmssmp",
                    "urbrecptdcd", "urbrecptwta", "forpehrtdcp", "hydclprs", "awmmfpwwta", "mukey"]
MUAGGATT_FLOAT = ["slopegraddcp", "slopegradwta", "aws025wta", "aws050wta", "aws0100wta", "aws0150wta",
                  "urbrecptwta", "awmmfpwwta"]
MUAGGATT_INT = ["brockdepmin", "wtdepannmin", "wtdepaprjunmin", "iccdcdpct", "niccdcdpct"]
MUAGGATT_TEXT = [c for c in MUAGGATT_COLUMNS if c not in MUAGGATT_FLOAT + MUAGGATT_INT + ["mukey"]]

# The active (label, property code) pairs of the property tools,
# in their original order.  Labels keep their trailing blanks.
PROPERTY_LABELS = [
    ("0.1 bar H2O - Rep Value", "wtenthbar_r"),
    ("0.33 bar H2O - Rep Value", "wthirdbar_r"),
    ("15 bar H2O - Rep Value", "wfifteenbar_r"),
    ("Available Water Capacity - Rep Value", "awc_r"),
    ("Bray 1 Phosphate - Rep Value", "pbray1_r"),
    ("Bulk Density 0.1 bar H2O - Rep Value", "dbtenthbar_r"),
    ("Bulk Density 0.33 bar H2O - Rep Value", "dbthirdbar_r"),
    ("Bulk Density 15 bar H2O - Rep Value", "dbfifteenbar_r"),
    ("Bulk Density oven dry - Rep Value", "dbovendry_r"),
    ("CaCO3 Clay - Rep Value", "claysizedcarb_r"),
    ("Calcium Carbonate - Rep Value", "caco3_r"),
    ("Cation Exchange Capcity - Rep Value", "cec7_r"),
    ("Coarse Sand - Rep Value", "sandco_r"),
    ("Coarse Silt - Rep Value", "siltco_r"),
    ("Corrosion of Steel", "corsteel"),
    ("Corrosion of Concrete", "corcon"),
    ("Drainage Class", "drainagecl"),
    ("Effective Cation Exchange Capcity - Rep Value", "ecec_r"),
    ("Electrial Conductivity 1:5 by volume - Rep Value", "ec15_r"),
    ("Electrical Conductivity - Rep Value", "ec_r"),
    ("Exchangeable Sodium Percentage - Rep Value", "esp_r"),
    ("Extract Aluminum - Rep Value", "extral_r"),
    ("Extractable Acidity - Rep Value", "extracid_r"),
    ("Fine Sand - Rep Value", "sandfine_r"),
    ("Fine Silt - Rep Value", "siltfine_r"),
    ("Free Iron - Rep Value", "freeiron_r"),
    ("Gypsum - Rep Value", "gypsum_r"),
    ("Hydrologic Group", "hydgrp"),
    ("Kf ", "kffact"),
    ("Ki ", "kifact"),
    ("Kr ", "krfact"),
    ("Kw ", "kwfact"),
    ("LEP - Rep Value", "lep_r"),
    ("Liquid Limit - Rep Value", "ll_r"),
    ("Medium Sand - Rep Value", "sandmed_r"),
    ("Organic Matter - Rep Value", "om_r"),
    ("Oxalate Aluminum - Rep Value", "aloxalate_r"),
    ("Oxalate Iron - Rep Value", "feoxalate_r"),
    ("Oxalate Phosphate - Rep Value", "poxalate_r"),
    ("Plasticity Index - Rep Value", "pi_r"),
    ("Rock Fragments 3 - 10 cm - Rep Value", "frag3to10_r"),
    ("Rock Fragments > 10 cm - Rep Value", "fraggt10_r"),
    ("Rubbed Fiber % - Rep Value", "fiberrubbedpct_r"),
    ("Satiated H2O - Rep Value", "wsatiated_r"),
    ("Saturated Hydraulic Conductivity - Rep Value", "ksat_r"),
    ("Sodium Adsorption Ratio - Rep Value", "sar_r"),
    ("Sum of Bases - Rep Value", "sumbases_r"),
    ("Taxonomic Class Name", "taxclname"),
    ("Taxonomic Order", "taxorder"),
    ("Taxonomic Suborder", "taxsuborder"),
    ("Taxonomic Temperature Regime", "taxtempregime"),
    ("Total Clay - Rep Value", "claytotal_r"),
    ("Total Phosphate - Rep Value", "ptotal_r"),
    ("Total Rock Fragment Volume - Rep Value", "fragvoltot_r"),
    ("Total Sand - Rep Value", "sandtotal_r"),
    ("Total Silt - Rep Value", "silttotal_r"),
    ("Unrubbed Fiber % - Rep Value", "fiberunrubbedpct_r"),
    ("Very Coarse Sand - Rep Value", "sandvc_r"),
    ("Very Fine Sand - Rep Value", "sandvf_r"),
    ("Water Soluble Phosphate - Rep Value", "ph2osoluble_r"),
    ("Wind Erodibility Group", "weg"),
    ("Wind Erodibility Index", "wei"),
    ("no. 10 sieve - Rep Value", "sieveno10_r"),
    ("no. 200 sieve - Rep Value", "sieveno200_r"),
    ("no. 4 sieve - Rep Value", "sieveno4_r"),
    ("no. 40 sieve - Rep Value", "sieveno40_r"),
    ("pH .01M CaCl2 - Rep Value", "ph01mcacl2_r"),
    ("pH 1:1 water - Rep Value", "ph1to1h2o_r"),
    ("pH Oxidized - Rep Value", "phoxidized_r"),
    ("t Factor", "tfact"),
]

# The property codes that hold text; they belong to the component.
TEXT_PROPERTIES = ["weg", "taxclname", "taxorder", "taxsuborder", "taxtempregime", "corsteel", "drainagecl",
                   "hydgrp", "corcon"]
# Numeric properties of the component; every other code is a horizon column.
COMPONENT_NUMBERS = ["tfact", "wei"]

COMPONENT_PROPERTIES = [c for _, c in PROPERTY_LABELS if c in TEXT_PROPERTIES + COMPONENT_NUMBERS]
HORIZON_PROPERTIES = [c for _, c in PROPERTY_LABELS if c not in COMPONENT_PROPERTIES]


def property_level(code: str) -> str:
    """``component`` or ``horizon``: the table that holds a property code of the catalogue."""
    if code in COMPONENT_PROPERTIES:
        return "component"
    if code in HORIZON_PROPERTIES:
        return "horizon"
    raise ValueError(f"unknown property code: {code}")


def _s(*cols) -> StructType:
    return StructType([StructField(n, t, True) for n, t in cols])


S, I, D, L = StringType(), IntegerType(), DoubleType(), LongType()

SOIL_SCHEMAS: dict[str, StructType] = {
    "sacatalog": _s(("areasymbol", S)),
    "legend": _s(("lkey", S), ("areasymbol", S)),
    "mapunit": _s(("mukey", S), ("lkey", S), ("musym", S), ("muname", S)),
    "component": _s(("cokey", S), ("mukey", S), ("compname", S), ("comppct_r", I), ("majcompflag", S),
                    ("hydricrating", S), ("compkind", S),
                    *[(c, S if c in TEXT_PROPERTIES else D) for c in COMPONENT_PROPERTIES]),
    "chorizon": _s(("chkey", S), ("cokey", S), ("hzname", S), ("hzdept_r", I), ("hzdepb_r", I),
                   *[(c, D) for c in HORIZON_PROPERTIES]),
    "chtexturegrp": _s(("chkey", S), ("rvindicator", S), ("texture", S)),
    "cointerp": _s(("cokey", S), ("mrulename", S), ("ruledepth", I), ("ruledesign", I), ("interphr", D),
                   ("interphrc", S)),
    "copmgrp": _s(("cokey", S), ("pmgroupname", S)),
    # raw text as a tabular response holds it; muaggatt_extract types it
    "muaggatt": _s(("mukey", S), *[(c, S) for c in MUAGGATT_FLOAT + MUAGGATT_INT + MUAGGATT_TEXT]),
    "mupolygon": _s(("areasymbol", S), ("mukey", S), ("poly_id", S), ("wkt", S)),
    "mupolygon_shapes": _s(("areasymbol", S), ("mukey", S), ("poly_id", S), ("wkt", S)),
    "aoi_points": _s(("aoi_id", I), ("seq", I), ("x", D), ("y", D)),
    "aoi_shapes": _s(("aoi_id", I), ("seq", I), ("x", D), ("y", D)),
    "report_lines_project": _s(("report_id", S), ("line_no", L), ("line", S)),
    "report_lines_area": _s(("report_id", S), ("line_no", L), ("line", S)),
    "catalog_lines": _s(("line_no", L), ("line", S)),
}
