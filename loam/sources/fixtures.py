"""Soil-shaped test tables derived from the driver's TPC-H-like parquet tables.

The driver tables hold no soil data, so these functions derive the soil
hierarchy (legend, mapunit, component, chorizon, chtexturegrp, cointerp,
copmgrp, muaggatt, mupolygon, aoi_points) from them with plain DataFrame
expressions.  Every derived table grows with the source tables.  Numeric
values are chosen to be exact binary fractions so that Spark and the DuckDB
oracle agree bit for bit.

The rules are documented in FIXTURES.md section 2; ``loam.plans.fixture_sql``
is the independent DuckDB version of the same rules.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loam.schemas import MUAGGATT_FLOAT, MUAGGATT_INT, MUAGGATT_TEXT
from loam.session import sf_table

# Fixed fixture vocabularies (test data, not reference values).
TEXTURES = ["SIL", "L", "MPT", "SIL", "MUCK", "CL", "S", "GR-SPM", "BR", "SIC", None]
RULES = [("ENG - Dwellings", 1), ("AGR - Corn Suitability", 2)]
HYDGRP = ["A", "B", "C", "D", "A/D", None]
SUBRULE_CLASSES = ["Slope", "Depth to saturated zone", "Shrink-swell", "Not limiting", "Flooding & ponding"]
PM_NAMES = [
    "Loess",
    "Till",
    "Residuum",
    "Alluvium",
    "Volcanic ash over till",
    "Herbaceous organic material",
    "Unknown sediments",
    None,
]

def _pick(idx: Column, values: list) -> Column:
    """values[idx] as a literal array lookup (NULL entries allowed)."""
    arr = F.array(*[F.lit(v).cast("string") for v in values])
    return F.element_at(arr, idx.cast("int") + 1)


class SoilFixture:
    """Lazily derived soil tables for one driver scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def _t(self, name: str) -> DataFrame:
        return sf_table(self.spark, self.sf_dir, name)

    # ---- area / map unit level -------------------------------------------------
    @cached_property
    def legend(self) -> DataFrame:
        n = self._t("nation")
        return n.select(
            F.col("n_nationkey").cast("string").alias("lkey"),
            F.concat(F.lit("NC"), F.lpad(F.col("n_nationkey").cast("string"), 3, "0")).alias("areasymbol"),
        )

    @cached_property
    def sacatalog(self) -> DataFrame:
        return self.legend.select("areasymbol")

    def _orders_nation(self) -> DataFrame:
        o = self._t("orders")
        c = self._t("customer").select("c_custkey", "c_nationkey")
        return o.join(c, o.o_custkey == c.c_custkey, "inner")

    @cached_property
    def mapunit(self) -> DataFrame:
        return self._orders_nation().select(
            F.col("o_orderkey").cast("string").alias("mukey"),
            F.col("c_nationkey").cast("string").alias("lkey"),
            F.concat(F.substring("o_orderpriority", 1, 1), F.col("o_orderstatus")).alias("musym"),
            F.concat_ws(" ", "o_orderpriority", "o_orderstatus").alias("muname"),
        )

    # ---- component level -------------------------------------------------------
    @cached_property
    def _lineitem_part(self) -> DataFrame:
        li = self._t("lineitem")
        p = self._t("part").select("p_partkey", "p_name", "p_type", "p_size")
        # the four source keys repeat once at sf0.001; the price in cents makes the key unique
        cokey = F.concat_ws("-", *[F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey",
                                                                       "l_suppkey")],
                            F.round(F.col("l_extendedprice") * 100).cast("bigint").cast("string"))
        return li.join(p, li.l_partkey == p.p_partkey, "inner").select(
            "*", cokey.alias("cokey"), F.round(F.abs(F.col("l_discount")) * 100).cast("int").alias("k")
        )

    @cached_property
    def component(self) -> DataFrame:
        lp = self._lineitem_part
        return lp.select(
            "cokey",
            F.col("l_orderkey").cast("string").alias("mukey"),
            F.col("p_name").alias("compname"),
            F.col("l_quantity").cast("int").alias("comppct_r"),
            F.when(F.col("l_linestatus") == "F", "Yes").otherwise("No").alias("majcompflag"),
            F.when(F.col("l_returnflag") == "A", "Yes").when(F.col("l_returnflag") == "N", "No")
            .otherwise(F.lit(None).cast("string")).alias("hydricrating"),
            F.when(F.col("p_size") % 10 == 0, "miscellaneous area")
            .when(F.col("p_size") % 10 == 1, F.lit(None).cast("string"))
            .otherwise("series").alias("compkind"),
            F.when(F.col("p_type").contains("PROMO"), F.lit(None).cast("string"))
            .otherwise(F.col("p_type")).alias("drainagecl"),
            _pick((F.col("p_size") + F.col("l_linenumber")) % 6, HYDGRP).alias("hydgrp"),
            F.when(F.col("p_size") % 5 == 0, F.lit(None).cast("double"))
            .otherwise((F.col("p_size") % 6).cast("double")).alias("tfact"),
        )

    # ---- horizon level ---------------------------------------------------------
    @cached_property
    def _horizon_base(self) -> DataFrame:
        lp = self._lineitem_part
        i = F.col("i")
        step = F.lit(10) + F.lit(5) * F.col("l_linenumber")
        hzname = (
            F.when(i == 0, _pick(F.col("p_size") % 5, ["Oi", None, "Ap", "Ap", "Ap"]))
            .when(i == 1, F.lit("Bt"))
            .otherwise(_pick(F.col("p_size") % 3, ["Cr", "R", "C"]))
        )
        return lp.select(
            "cokey", "k", "p_size", "l_linenumber", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("i")
        ).select(
            "*",
            F.concat(F.col("cokey"), F.lit(":"), i.cast("string")).alias("chkey"),
            hzname.alias("hzname"),
            F.when((i == 2) & (F.col("p_size") % 13 == 0), F.lit(None).cast("int"))
            .otherwise((i * step).cast("int")).alias("hzdept_r"),
            ((i + 1) * step).cast("int").alias("hzdepb_r"),
            F.when((F.col("p_size") + i) % 7 == 0, F.lit(None).cast("double"))
            .otherwise((F.col("k") * 4 + i * 20 + F.col("p_size")).cast("double") / F.lit(4.0))
            .alias("claytotal_r"),
            F.when((F.col("p_size") + 2 * i) % 9 == 0, F.lit(None).cast("double"))
            .otherwise((F.col("l_linenumber") * 8 + i * 3 + F.col("p_size") % 8).cast("double") / F.lit(8.0))
            .alias("om_r"),
            F.when((F.col("p_size") + 3 * i) % 8 == 0, F.lit(None).cast("double"))
            .otherwise((F.col("l_linenumber") * 6 + i * 8 + F.col("p_size")).cast("double") / F.lit(2.0))
            .alias("sandtotal_r"),
        )

    @cached_property
    def chorizon(self) -> DataFrame:
        return self._horizon_base.select("chkey", "cokey", "hzname", "hzdept_r", "hzdepb_r", "claytotal_r", "om_r",
                                         "sandtotal_r")

    @cached_property
    def chtexturegrp(self) -> DataFrame:
        h = self._horizon_base
        i = F.col("i")
        rv = F.struct(
            F.lit("Yes").alias("rvindicator"),
            _pick((F.col("l_linenumber") * 3 + i + F.col("p_size")) % 11, TEXTURES).alias("texture"),
        )
        other = F.when((F.col("p_size") + i) % 3 == 0, F.struct(F.lit("No").alias("rvindicator"),
                                                                 F.lit("L").alias("texture")))
        dup = F.when((F.col("l_linenumber") == 7) & (i == 1),
                     F.struct(F.lit("Yes").alias("rvindicator"), F.lit("CL").alias("texture")))
        return (
            h.select("chkey", F.explode(F.array(rv, other, dup)).alias("t"))
            .filter(F.col("t").isNotNull())
            .select("chkey", "t.rvindicator", "t.texture")
        )

    # ---- interpretations -------------------------------------------------------
    @cached_property
    def cointerp(self) -> DataFrame:
        lp = self._lineitem_part
        k = F.col("k")
        null0 = (F.col("l_returnflag") == "R") & (F.col("l_linenumber") >= 6)
        rows = []
        for rule, design in RULES:
            score = k if design == 1 else (F.lit(10) - k)
            top_val = F.when(null0, F.lit(None).cast("double")).otherwise(score.cast("double") / F.lit(10.0))
            if design == 1:
                names = ["Not limited", "Somewhat limited", "Very limited"]
            else:
                names = ["Not suited", "Poorly suited", "Well suited"]
            top_cls = (
                F.when(null0, F.lit("Not rated"))
                .when(score == 0, F.lit(names[0]))
                .when(score <= 5, F.lit(names[1]))
                .otherwise(F.lit(names[2]))
            )
            rows.append(F.struct(F.lit(rule).alias("mrulename"), F.lit(0).alias("ruledepth"),
                                 F.lit(design).alias("ruledesign"), top_val.alias("interphr"),
                                 top_cls.alias("interphrc")))
            for n in (1, 2, 3):
                val = ((F.col("p_size") * n) % 11).cast("double") / F.lit(10.0)
                cls = _pick((F.col("p_size") + n * F.col("l_linenumber")) % 5, SUBRULE_CLASSES)
                rows.append(F.struct(F.lit(rule).alias("mrulename"), F.lit(n).alias("ruledepth"),
                                     F.lit(design).alias("ruledesign"), val.alias("interphr"),
                                     cls.alias("interphrc")))
        return lp.select("cokey", F.inline(F.array(*rows)))

    @cached_property
    def copmgrp(self) -> DataFrame:
        lp = self._lineitem_part
        first = F.struct(_pick(F.col("p_size") % 8, PM_NAMES).alias("pmgroupname"))
        second = F.when(F.col("l_linenumber") == 7, F.struct(F.lit("Colluvium").alias("pmgroupname")))
        return (
            lp.select("cokey", F.explode(F.array(first, second)).alias("g"))
            .filter(F.col("g").isNotNull())
            .select("cokey", "g.pmgroupname")
        )

    # ---- map unit attributes and geometry ---------------------------------------
    @cached_property
    def muaggatt(self) -> DataFrame:
        """Pre-aggregated attributes as raw text (what a tabular response holds)."""
        o = self._t("orders")
        key = F.col("o_orderkey")
        cols = [F.col("o_orderkey").cast("string").alias("mukey")]
        for idx, name in enumerate(MUAGGATT_FLOAT):
            txt = F.concat(((key * (idx + 3)) % 10007).cast("string"), F.lit("."), ((key + idx) % 10).cast("string"))
            cols.append(F.when((key + idx) % 11 == 0, F.lit("n/a")).otherwise(txt).alias(name))
        for idx, name in enumerate(MUAGGATT_INT):
            txt = ((F.col("o_custkey") + idx * 7) % 250).cast("string")
            cols.append(F.when((key + idx + 5) % 11 == 0, F.lit("n/a")).otherwise(txt).alias(name))
        text_src = {
            "mustatus": F.col("o_orderstatus"),
            "flodfreqdcd": F.col("o_orderpriority"),
            "hydclprs": F.substring("o_orderpriority", 1, 1),
            # not the map unit's own symbol and name: a rollup must not mix them up
            "musym": F.concat(F.lit("a"), (key % 97).cast("string")),
            "muname": F.concat(F.lit("attributes of "), key.cast("string")),
        }
        for name in MUAGGATT_TEXT:
            src = text_src.get(name, F.concat(F.lit(name[:3] + "-"), (key % 7).cast("string")))
            cols.append(F.when((key + len(name)) % 13 == 0, F.lit(None).cast("string")).otherwise(src).alias(name))
        return o.select(*cols)

    @cached_property
    def mupolygon(self) -> DataFrame:
        """Integer boxes as WKT; neighbours overlap; every 10th map unit has a second small box."""
        mu = self.mapunit.join(self.legend, "lkey")
        key = F.col("mukey").cast("bigint")
        x0 = (key % 500) * 10
        y0 = F.floor(key / 500).cast("bigint") * 10

        def box(ax: Column, ay: Column, size: int) -> Column:
            xs = [ax, ax + size, ax + size, ax, ax]
            ys = [ay, ay, ay + size, ay + size, ay]
            pts = [F.concat_ws(" ", x.cast("string"), y.cast("string")) for x, y in zip(xs, ys)]
            return F.concat(F.lit("POLYGON (("), F.concat_ws(", ", *pts), F.lit("))"))

        big = F.struct(F.lit(1).alias("part"), box(x0, y0, 12).alias("wkt"))
        small = F.when(key % 10 == 0, F.struct(F.lit(2).alias("part"), box(x0 + 4, y0 + 4, 3).alias("wkt")))
        return (
            mu.select("areasymbol", "mukey", F.explode(F.array(big, small)).alias("g"))
            .filter(F.col("g").isNotNull())
            .select("areasymbol", "mukey", F.concat(F.col("mukey"), F.lit("."), F.col("g.part").cast("string"))
                    .alias("poly_id"), F.col("g.wkt").alias("wkt"))
        )

    @cached_property
    def aoi_points(self) -> DataFrame:
        """One axis-aligned box AOI per region; the last region's box lies off the map."""
        r = self._t("region")
        rk = F.col("r_regionkey").cast("double")
        far = F.col("r_regionkey") == 4
        ax0 = F.when(far, F.lit(100000.0)).otherwise(rk * 100 + 3.5)
        ay0 = F.when(far, F.lit(100000.0)).otherwise(rk * 50 + 1.5)
        ax1 = ax0 + 250
        ay1 = ay0 + 120
        pts = F.array(
            F.struct(F.lit(1).alias("seq"), ax0.alias("x"), ay0.alias("y")),
            F.struct(F.lit(2).alias("seq"), ax1.alias("x"), ay0.alias("y")),
            F.struct(F.lit(3).alias("seq"), ax1.alias("x"), ay1.alias("y")),
            F.struct(F.lit(4).alias("seq"), ax0.alias("x"), ay1.alias("y")),
        )
        return r.select(F.col("r_regionkey").cast("int").alias("aoi_id"), F.inline(pts))

    @cached_property
    def mupolygon_shapes(self) -> DataFrame:
        """Polygons with a hole (key % 3 = 1), of two parts (key % 3 = 2), and plain boxes."""
        mu = self.mapunit.join(self.legend, "lkey")
        key = F.col("mukey").cast("bigint")
        x0 = (key % 500) * 10
        y0 = F.floor(key / 500).cast("bigint") * 10

        def ring(ax: Column, ay: Column, w: int, h: int, hole: bool = False) -> Column:
            pts = [(ax, ay), (ax + w, ay), (ax + w, ay + h), (ax, ay + h), (ax, ay)]
            pts = pts[::-1] if hole else pts
            return F.concat(F.lit("("), F.concat_ws(", ", *[F.concat_ws(" ", x.cast("string"), y.cast("string"))
                                                            for x, y in pts]), F.lit(")"))

        wkt = (
            F.when(key % 3 == 1, F.concat(F.lit("POLYGON ("), ring(x0, y0, 12, 12), F.lit(", "),
                                          ring(x0 + 3, y0 + 3, 6, 6, hole=True), F.lit(")")))
            .when(key % 3 == 2, F.concat(F.lit("MULTIPOLYGON (("), ring(x0, y0, 4, 4), F.lit("), ("),
                                         ring(x0 + 6, y0 + 2, 5, 9), F.lit("))")))
            .otherwise(F.concat(F.lit("POLYGON ("), ring(x0, y0, 12, 12), F.lit(")")))
        )
        return mu.select("areasymbol", "mukey", F.concat(F.col("mukey"), F.lit(".s")).alias("poly_id"),
                         wkt.alias("wkt"))

    @cached_property
    def aoi_shapes(self) -> DataFrame:
        """Per region a right triangle (even id) or an L (odd id, not convex); legs along the axes."""
        r = self._t("region")
        ax0 = F.col("r_regionkey").cast("double") * 100 + 3.5
        ay0 = F.col("r_regionkey").cast("double") * 40 + 1.5

        def outline(*corners: tuple[float, float]) -> Column:
            return F.array(*[F.struct(F.lit(i + 1).alias("seq"), (ax0 + dx).alias("x"), (ay0 + dy).alias("y"))
                             for i, (dx, dy) in enumerate(corners)])

        triangle = outline((0, 0), (150, 0), (0, 150))
        bent = outline((0, 0), (200, 0), (200, 60), (80, 60), (80, 130), (0, 130))
        key = F.col("r_regionkey").cast("int")
        return r.select(key.alias("aoi_id"), F.inline(F.when(key % 2 == 0, triangle).otherwise(bent)))

    # ---- text reports ------------------------------------------------------------
    def report_lines(self, form: str = "project") -> DataFrame:
        """Report text per survey area as (report_id, line_no, line).

        Noise lines, a START line (missing in areas with lkey % 7 = 3), a
        header, one record per map unit, an MLRA record for most map units
        (project form), a later repeat of some keys, short records, a class
        holding a comma, and mixed kinds in areas with lkey % 11 = 4.
        """
        on = self._orders_nation()
        key = F.col("o_orderkey")
        nk = F.col("c_nationkey")
        mukey = key.cast("string")
        musym = F.concat(F.substring("o_orderpriority", 1, 1), F.col("o_orderstatus"))
        kind = (
            F.when(nk % 11 == 4, F.when(key % 2 == 0, F.lit("Suitability")).otherwise(F.lit("Limitation")))
            .when(nk % 5 == 2, F.lit("Suitability"))
            .otherwise(F.lit("Limitation"))
        )
        rating1 = F.concat(F.lit("0."), F.lpad((key % 100).cast("string"), 2, "0"))
        rating2 = F.concat(F.lit("0."), F.lpad(((key * 7) % 100).cast("string"), 2, "0"))
        class1 = F.element_at(F.array(F.lit("Not limited"), F.lit("Somewhat limited"), F.lit("Very limited, wet")),
                              (key % 3).cast("int") + 1)
        q = F.lit('"')

        def rec(offset: int, line: Column) -> Column:
            return F.struct((key * 4 + offset).alias("line_no"), line.alias("line"))

        if form == "project":
            recs = [
                rec(0, F.concat_ws("|", F.concat(q, mukey, q), musym, rating1, class1, F.lit("non-mlra map unit"),
                                   kind)),
                rec(1, F.when(key % 3 != 0, F.concat_ws("|", mukey, musym, rating2, F.lit("Somewhat limited"),
                                                        F.lit("mmu"), kind))),
                rec(2, F.when(key % 50 == 0, F.concat_ws("|", mukey, musym, F.lit("0.99"), F.lit("Very limited, wet"),
                                                         F.lit("non-mlra map unit"), kind))),
                rec(3, F.when(key % 97 == 0, F.concat(mukey, F.lit("|non-mlra map unit")))),
            ]
            header = "mukey|musym|rating|class|mukind|kind"
        else:
            recs = [
                rec(0, F.concat_ws("|", F.concat(q, mukey, q), F.concat(q, musym, q), rating1, class1, kind)),
                rec(2, F.when(key % 50 == 0, F.concat_ws("|", mukey, musym, F.lit("0.99"), F.lit("Very limited, wet"),
                                                         kind))),
                rec(3, F.when(key % 97 == 0, F.concat(mukey, F.lit("|"), musym))),
            ]
            header = "mukey|musym|rating|class|kind"
        area = F.concat(F.lit("NC"), F.lpad(nk.cast("string"), 3, "0"))
        records = (
            on.select(area.alias("report_id"), F.explode(F.array(*recs)).alias("r"))
            .select("report_id", "r.line_no", "r.line")
            .filter(F.col("line").isNotNull())
        )
        lk = F.col("lkey").cast("int")
        def fl(n: int, text: Column) -> Column:
            return F.struct(F.lit(n).cast("bigint").alias("line_no"), text.alias("line"))

        frame = F.array(
            fl(-3, F.concat(F.lit("Interpretation report "), F.col("areasymbol"))),
            fl(-2, F.lit("")),
            fl(-1, F.when(lk % 7 == 3, F.lit("BEGIN")).otherwise(F.lit("  <b>START</b> "))),
            fl(0, F.lit(header)),
            fl(REPORT_STOP_LINE, F.lit("STOP ")),
            fl(REPORT_STOP_LINE + 1, F.lit("end of report")),
        )
        frames = self.legend.select(F.col("areasymbol").alias("report_id"), F.inline(frame))
        return frames.unionByName(records)

    def catalog_lines(self) -> DataFrame:
        """``code,label`` lines (labels repeat; double blanks and '#' to clean) from the part table."""
        p = self._t("part")
        line = F.concat(F.lower("p_type"), F.lit("_"), (F.col("p_partkey") % 13).cast("string"), F.lit(","),
                        F.col("p_type"), F.lit("  #"), (F.col("p_size") % 7).cast("string"))
        return p.select(F.col("p_partkey").cast("bigint").alias("line_no"), line.alias("line"))

    def tables(self) -> dict[str, DataFrame]:
        return {
            name: getattr(self, name)
            for name in ("sacatalog", "legend", "mapunit", "component", "chorizon", "chtexturegrp", "cointerp",
                         "copmgrp", "muaggatt", "mupolygon", "aoi_points", "mupolygon_shapes", "aoi_shapes")
        }


REPORT_STOP_LINE = 9_000_000_000_000_000_000
