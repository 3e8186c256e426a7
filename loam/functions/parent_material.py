"""Generalisation of parent-material group names into ten broad groups."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loam.functions.text import like

# Ordered (LIKE pattern, group) rules; the first match wins and a
# name matching none (or NULL) becomes the text 'NULL'.
PM_GROUP_RULES = [
    ("%Calcareous loess%", "Eolian Deposits (nonvolcanic)"),
    ("%Eolian deposits%", "Eolian Deposits (nonvolcanic)"),
    ("%Eolian sands%", "Eolian Deposits (nonvolcanic)"),
    ("%Loess%", "Eolian Deposits (nonvolcanic)"),
    ("%Noncalcareous loess%", "Eolian Deposits (nonvolcanic)"),
    ("%Ablation till%", "Glacial and Periglacial Deposits"),
    ("%Basal till%", "Glacial and Periglacial Deposits"),
    ("%Cryoturbate%", "Glacial and Periglacial Deposits"),
    ("%Drift%", "Glacial and Periglacial Deposits"),
    ("%Flow till%", "Glacial and Periglacial Deposits"),
    ("%Glaciofluvial deposits%", "Glacial and Periglacial Deposits"),
    ("%Glaciolacustrine deposits%", "Glacial and Periglacial Deposits"),
    ("%Glaciomarine deposits%", "Glacial and Periglacial Deposits"),
    ("%Lodgment till%", "Glacial and Periglacial Deposits"),
    ("%Melt-out till%", "Glacial and Periglacial Deposits"),
    ("%Outwash%", "Glacial and Periglacial Deposits"),
    ("%Solifluction deposits%", "Glacial and Periglacial Deposits"),
    ("%Subglacial till%", "Glacial and Periglacial Deposits"),
    ("%Supraglacial meltout till%", "Glacial and Periglacial Deposits"),
    ("%Supraglacial till%", "Glacial and Periglacial Deposits"),
    ("%Till%", "Glacial and Periglacial Deposits"),
    ("%Bauxite%", "In-Place Deposits (nontransported)"),
    ("%Grus%", "In-Place Deposits (nontransported)"),
    ("%Residuum%", "In-Place Deposits (nontransported)"),
    ("%Saprolite%", "In-Place Deposits (nontransported)"),
    ("%Colluvium%", "Mass Movement Deposits"),
    ("%Complex landslide deposits%", "Mass Movement Deposits"),
    ("%Creep deposits%", "Mass Movement Deposits"),
    ("%Debris avalanche deposits%", "Mass Movement Deposits"),
    ("%Debris flow deposits%", "Mass Movement Deposits"),
    ("%Debris slide deposits%", "Mass Movement Deposits"),
    ("%Debris spread deposits%", "Mass Movement Deposits"),
    ("%Debris topple deposits%", "Mass Movement Deposits"),
    ("%Earth spread deposits%", "Mass Movement Deposits"),
    ("%Earthflow deposits%", "Mass Movement Deposits"),
    ("%Flow deposits%", "Mass Movement Deposits"),
    ("%Lateral spread deposits%", "Mass Movement Deposits"),
    ("%Mass movement deposits%", "Mass Movement Deposits"),
    ("%Mudflow deposits%", "Mass Movement Deposits"),
    ("%Rock spread deposits%", "Mass Movement Deposits"),
    ("%Rock topple deposits%", "Mass Movement Deposits"),
    ("%Rockfall avalanche deposits%", "Mass Movement Deposits"),
    ("%Rockfall deposits%", "Mass Movement Deposits"),
    ("%Rotational earth slide deposits%", "Mass Movement Deposits"),
    ("%Rotational slide deposits%", "Mass Movement Deposits"),
    ("%Sand flow deposits%", "Mass Movement Deposits"),
    ("%Scree%", "Mass Movement Deposits"),
    ("%Slide deposits%", "Mass Movement Deposits"),
    ("%Talus%", "Mass Movement Deposits"),
    ("%Topple deposits%", "Mass Movement Deposits"),
    ("%Diamicton%", "Miscellaneous Deposits"),
    ("%mixed%", "Miscellaneous Deposits"),
    ("%Coprogenic material%", "Organic Deposits"),
    ("%Grassy organic material%", "Organic Deposits"),
    ("%Herbaceous organic material%", "Organic Deposits"),
    ("%Mossy organic material%", "Organic Deposits"),
    ("%Organic material%", "Organic Deposits"),
    ("%Woody organic material%", "Organic Deposits"),
    ("%Acidic volcanic ash%", "Volcanic Deposits (unconsolidated; eolian and mass movement)"),
    ("%Andesitic volcanic ash%", "Volcanic Deposits (unconsolidated; eolian and mass movement)"),
    ("%Ash flow%", "Volcanic Deposits (unconsolidated; eolian and mass movement)"),
    ("%Basaltic volcanic ash%", "Volcanic Deposits (unconsolidated; eolian and mass movement)"),
    ("%Basic volcanic ash%", "Volcanic Deposits (unconsolidated; eolian and mass movement)"),
    ("%Cinders%", "Volcanic Deposits (unconsolidated; eolian and mass movement)"),
    ("%Lahar deposits%", "Volcanic Deposits (unconsolidated; eolian and mass movement)"),
    ("%Pumice%", "Volcanic Deposits (unconsolidated; eolian and mass movement)"),
    ("%Pyroclastic flow%", "Volcanic Deposits (unconsolidated; eolian and mass movement)"),
    ("%Pyroclastic surge%", "Volcanic Deposits (unconsolidated; eolian and mass movement)"),
    ("%Scoria%", "Volcanic Deposits (unconsolidated; eolian and mass movement)"),
    ("%Tephra%", "Volcanic Deposits (unconsolidated; eolian and mass movement)"),
    ("%tuff%", "Volcanic Deposits (unconsolidated; eolian and mass movement)"),
    ("%tuff-breccia%", "Volcanic Deposits (unconsolidated; eolian and mass movement)"),
    ("%Volcanic ash%", "Volcanic Deposits (unconsolidated; eolian and mass movement)"),
    ("%Alluvium%", "Waterlaid (or Transported) Deposits"),
    ("%Backswamp deposits%", "Waterlaid (or Transported) Deposits"),
    ("%Beach sand%", "Waterlaid (or Transported) Deposits"),
    ("%Diatomaceous earth%", "Waterlaid (or Transported) Deposits"),
    ("%Estuarine deposits%", "Waterlaid (or Transported) Deposits"),
    ("%Fluviomarine deposits%", "Waterlaid (or Transported) Deposits"),
    ("%Greensands%", "Waterlaid (or Transported) Deposits"),
    ("%Lacustrine deposits%", "Waterlaid (or Transported) Deposits"),
    ("%Lagoonal deposits%", "Waterlaid (or Transported) Deposits"),
    ("%Marine deposits%", "Waterlaid (or Transported) Deposits"),
    ("%Marl%", "Waterlaid (or Transported) Deposits"),
    ("%Overbank deposits%", "Waterlaid (or Transported) Deposits"),
    ("%Pedisediment%", "Waterlaid (or Transported) Deposits"),
    ("%Slope alluvium%", "Waterlaid (or Transported) Deposits"),
    ("%Valley side alluvium%", "Waterlaid (or Transported) Deposits"),
    ("%Coal extraction mine spoil%", "Anthropogenic Deposits"),
    ("%Dredge spoils%", "Anthropogenic Deposits"),
    ("%Human-transported material%", "Anthropogenic Deposits"),
    ("%Metal ore extraction mine spoil%", "Anthropogenic Deposits"),
    ("%Mine spoil or earthy fill%", "Anthropogenic Deposits"),
    ("%aa%", "Miscoded - should be pmorigin"),
    ("%breccia-basic%", "Miscoded - should be pmorigin"),
    ("%conglomerate%", "Miscoded - should be pmorigin"),
    ("%dolomite%", "Miscoded - should be pmorigin"),
    ("%igneous%", "Miscoded - should be pmorigin"),
    ("%limestone%", "Miscoded - should be pmorigin"),
    ("%limestone-shale%", "Miscoded - should be pmorigin"),
    ("%metamorphic%", "Miscoded - should be pmorigin"),
    ("%quartzite%", "Miscoded - should be pmorigin"),
    ("%sandstone%", "Miscoded - should be pmorigin"),
    ("%sedimentary%", "Miscoded - should be pmorigin"),
    ("%serpentine%", "Miscoded - should be pmorigin"),
    ("%shale%", "Miscoded - should be pmorigin"),
    ("%shale-calcareous%", "Miscoded - should be pmorigin"),
    ("%siltstone%", "Miscoded - should be pmorigin"),
    ("%NULL%", "NULL"),
]
PM_DEFAULT = "NULL"


def parent_material_general(col: Column | str, case_sensitive: bool = False) -> Column:
    """First-match generalisation as one CASE expression (stays in codegen)."""
    c = F.col(col) if isinstance(col, str) else col
    out = None
    for pattern, group in PM_GROUP_RULES:
        cond = like(c, pattern, case_sensitive)
        out = F.when(cond, F.lit(group)) if out is None else out.when(cond, F.lit(group))
    return out.otherwise(F.lit(PM_DEFAULT))


def parent_material_case_sql(col: str, case_sensitive: bool = False) -> str:
    """The same rules as a SQL CASE text (used by the DuckDB oracle)."""
    subject = col if case_sensitive else f"lower({col})"
    parts = []
    for pattern, group in PM_GROUP_RULES:
        pat = pattern if case_sensitive else pattern.lower()
        parts.append(f"WHEN {subject} LIKE '{pat}' THEN '{group}'")
    return "CASE " + " ".join(parts) + f" ELSE '{PM_DEFAULT}' END"
