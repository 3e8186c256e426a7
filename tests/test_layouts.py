"""Stored layouts: reports read in byte ranges, tables bucketed by component key."""

from pyspark.sql import functions as F

from loam.operators import properties as P
from loam.operators.joins import mapunit_frame
from loam.sources import reports as RS
from loam.sources.fixtures import SoilFixture
from loam.sources.soil_tables import SoilTables, read_bucketed_tables, write_bucketed_tables, write_soil_tables

SF = "/root/testdata/sf0.001"


def test_one_report_over_several_tasks(spark, scratch):
    body = [f"{i}|s{i}|0.{i % 10}|Class {i % 3}|Limitation" for i in range(9_000)]
    texts = {
        "a": "\n".join(["noise", "", "x START x", *body, "STOP", "after", "START again"]) + "\n",
        "b": "\r\n".join(["START", *body[:50]]), "c": "no frame\nSTOP\n", "d": "",
    }
    for name, text in texts.items():
        with open(f"{scratch}/{name}.txt", "w", newline="") as f:
            f.write(text)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "40k")
        lines = RS.read_report_lines(spark, scratch)
        assert lines.select(F.spark_partition_id()).distinct().count() > 1
        name = F.substring_index("report_id", "/", -1)
        got = {}
        for r in lines.withColumn("report_id", name).collect():
            got.setdefault(r.report_id[0], {})[r.line_no] = r.line
        want = {k: dict(enumerate(t.replace("\r\n", "\n").removesuffix("\n").split("\n"))) for k, t in texts.items() if t}
        assert got == want
        framed = RS.report_extract(lines).withColumn("report_id", name)
        assert {(r.report_id[0], r.line) for r in framed.collect()} == {("a", x) for x in body} | {("b", x) for x in body[:50]}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def _shuffles_before_map_units(df):
    """Exchanges of the executed plan by key, without those by map unit or legend key."""
    plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    return [line for line in plan.splitlines() if "Exchange hashpartitioning" in line and "mukey" not in line and "lkey" not in line]


def test_bucketed_tables_roll_up_without_a_shuffle_by_component(spark, scratch):
    fx = SoilFixture(spark, SF)
    names = ("legend", "mapunit", "component", "chorizon", "chtexturegrp")
    tables = {n: getattr(fx, n) for n in names}
    write_soil_tables({n: tables[n] for n in ("legend", "mapunit")}, scratch + "/plain", files=2)
    write_bucketed_tables(tables, scratch + "/buckets", 4)
    st, bk = SoilTables(spark, scratch + "/plain"), read_bucketed_tables(spark, scratch + "/buckets", 4)
    mu = mapunit_frame(st.legend, st.mapunit)
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    try:
        for k in keys:
            spark.conf.set(k, "-1")
        got = P.prop_weighted_avg(mu, bk["component"], bk["chorizon"], bk["chtexturegrp"], "claytotal_r", 0, 100)
        rows = sorted(map(tuple, got.collect()))
        assert _shuffles_before_map_units(got) == []
        plain = P.prop_weighted_avg(mu, fx.component, fx.chorizon, fx.chtexturegrp, "claytotal_r", 0, 100)
        assert rows == sorted(map(tuple, plain.collect())) and _shuffles_before_map_units(plain)
    finally:
        for k in keys:
            spark.conf.unset(k)
        for n in bk:
            spark.sql(f"DROP TABLE IF EXISTS {bk[n]._jdf.queryExecution().analyzed().toString().split('SubqueryAlias ')[1].split()[0]}")
