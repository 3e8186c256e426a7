"""Map-unit summaries: hydric rating, parent material, pre-aggregated attributes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loam.functions.hydric import HYDRIC_COUNT_COLUMNS, hydric_rating as hydric_rating_expr
from loam.functions.parent_material import parent_material_general
from loam.functions.text import text_eq, text_ne
from loam.operators.dominant import dominant_component
from loam.schemas import MUAGGATT_COLUMNS, MUAGGATT_FLOAT, MUAGGATT_INT
from loam.sources.tabular import cast_columns_lenient

KEY_COLS = ["areasymbol", "musym", "muname", "mukey", "int_mukey"]


def hydric_counts(mapunits: DataFrame, component: DataFrame, case_sensitive: bool = False) -> DataFrame:
    """Eight component counts per map unit (a map unit without components has zeros).

    Components are counted per map unit before the join (partial
    aggregation), so the shuffle carries one row per map unit per task.
    ``!=`` excludes NULL, as in SQL.
    """
    maj = text_eq("majcompflag", "Yes", case_sensitive)
    not_maj = text_ne("majcompflag", "Yes", case_sensitive)
    hyd = text_eq("hydricrating", "Yes", case_sensitive)
    not_hyd = text_ne("hydricrating", "Yes", case_sensitive)
    counts = component.groupBy("mukey").agg(
        F.count(F.lit(1)).alias("comp_count"),
        F.count_if(maj).alias("count_maj_comp"),
        F.count_if(hyd).alias("all_hydric"),
        F.count_if(maj & hyd).alias("maj_hydric"),
        F.count_if(maj & not_hyd).alias("maj_not_hydric"),
        F.count_if(not_maj & hyd).alias("hydric_inclusions"),
        F.count_if(not_hyd).alias("all_not_hydric"),
        F.count_if(F.col("hydricrating").isNull()).alias("hydric_null"),
    )
    out = mapunits.join(counts, "mukey", "left")
    return out.select(*KEY_COLS, *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in HYDRIC_COUNT_COLUMNS])


def hydric_rating(mapunits: DataFrame, component: DataFrame, case_sensitive: bool = False) -> DataFrame:
    """Hydric rating per map unit: Nonhydric / Hydric / Predominantly ... / Partially Hydric / Error."""
    counts = hydric_counts(mapunits, component, case_sensitive)
    return counts.select(*KEY_COLS, hydric_rating_expr().alias("hydric_rating"))


def parent_material(mapunits: DataFrame, component: DataFrame, copmgrp: DataFrame, general: bool = False,
                    case_sensitive: bool = False) -> DataFrame:
    """Parent-material group of the dominant component, one row per map unit.

    Several groups per component: the smallest name wins (SURVEY Q10), NULL
    only when all are NULL.  Map units whose dominant component has no group
    row are absent (inner join).  ``general`` maps the name to one of ten
    broad groups (default text 'NULL').
    """
    per_comp = copmgrp.groupBy("cokey").agg(F.min("pmgroupname").alias("pmgroupname"))
    dom = dominant_component(component, ["compname", "comppct_r"])
    rows = dom.join(per_comp, "cokey", "inner")
    if general:
        rows = generalised(rows, case_sensitive)
    return mapunits.join(rows, "mukey", "inner").select(*KEY_COLS, "compname", "comppct_r", "pmgroupname")


def generalised(rows: DataFrame, case_sensitive: bool = False) -> DataFrame:
    """``rows`` with ``pmgroupname`` replaced by its broad group.

    The rules are tried once per distinct name, not per row; the dictionary of
    names is joined back (broadcast where Spark finds it small).
    """
    names = rows.select(F.col("pmgroupname").alias("_name")).distinct()
    groups = names.select("_name", parent_material_general(F.col("_name"), case_sensitive).alias("_group"))
    others = [c for c in rows.columns if c != "pmgroupname"]
    return rows.join(groups, F.col("pmgroupname").eqNullSafe(F.col("_name"))).select(*others, F.col("_group").alias("pmgroupname"))


def muaggatt_extract(mapunits: DataFrame, muaggatt: DataFrame, columns: Sequence[str] = MUAGGATT_COLUMNS) -> DataFrame:
    """Typed map-unit attributes of the selected map units (text -> DOUBLE / INT, bad text -> NULL).

    Symbol and name are the attribute table's own.
    """
    joined = muaggatt.join(mapunits.select("mukey"), "mukey", "left_semi")
    text_cols = [c for c in columns if c not in MUAGGATT_FLOAT + MUAGGATT_INT]
    typed = cast_columns_lenient(joined, text_cols, MUAGGATT_FLOAT, MUAGGATT_INT)
    return typed.select(*columns)
