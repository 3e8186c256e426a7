"""Interpretation rollups: rule ratings of components -> map unit rating, class, reason.

Output of every method: ``areasymbol, musym, muname, mukey, int_mukey,
mrulename, rating, class, reason`` with one row per (map unit having a
component, requested rule).  All requested rules run in one plan; the rule
list is a request parameter and is expanded per map unit with ``explode``
(no join against a rule table).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loam.functions.interp_bins import interp_class_bins, interp_design
from loam.functions.keys import HASHED, hashed
from loam.functions.numeric import round2
from loam.functions.text import not_like, text_ne
from loam.operators.dominant import dominance_columns, dominant_component
from loam.operators.filters import filter_reason, filter_reason_components, filter_rule

KEY_COLS = ["areasymbol", "musym", "muname", "mukey", "int_mukey"]
OUT_COLS = [*KEY_COLS, "mrulename", "rating", "class", "reason"]
#: What the tabular service returns of a reason list; pass it as ``reason_chars`` to cut as it does.
SERVICE_REASON_CHARS = 1000


def _rules_col(rules: Sequence[str]) -> Column:
    return F.explode(F.array(*[F.lit(r) for r in rules])).alias("mrulename")


def _per_rule(mapunits_with_comp: DataFrame, rules: Sequence[str], extra: Sequence[str] = ()) -> DataFrame:
    return mapunits_with_comp.select(*KEY_COLS, *extra, _rules_col(rules))


def _rule_no(rules: Sequence[str]) -> Column:
    """Place of the rule in the request: a number moves and groups cheaper than a name."""
    return F.array_position(F.array(*[F.lit(r) for r in rules]), F.col("mrulename")).cast("int").alias("_rule")


def _rule_name(rules: Sequence[str]) -> Column:
    return F.element_at(F.array(*[F.lit(r) for r in rules]), F.col("_rule")).alias("mrulename")


def rule_facts(cointerp: DataFrame, rules: Sequence[str], case_sensitive: bool = False) -> DataFrame:
    """Rating rows that a rollup needs, from one scan: overall rows (``_overall``) and sub-rules that carry a reason."""
    ci = cointerp.select("cokey", "mrulename", "ruledepth", "ruledesign", "interphr", "interphrc")
    overall = F.col("ruledepth") == 0
    reason = (F.col("ruledepth") != 0) & not_like("interphrc", "Not%", case_sensitive)
    wanted = ci.filter(F.col("mrulename").isin(list(rules)) & (overall | reason))
    return wanted.select("cokey", "mrulename", "ruledesign", "interphr", "interphrc", overall.alias("_overall"))


#: Between the texts of one component, and the sign that stands for it inside a text.
SEP, MARK = "\x01", "\x02"


def _marked(text: Column | str) -> Column:
    """Text in which :data:`SEP` does not occur; :func:`_unmarked` undoes it."""
    return F.replace(F.replace(F.col(text) if isinstance(text, str) else text, F.lit(MARK), F.lit(MARK + "b")), F.lit(SEP), F.lit(MARK + "a"))


def _unmarked(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit(MARK + "a"), F.lit(SEP)), F.lit(MARK + "b"), F.lit(MARK))


def _per_key(rows: DataFrame, col: str) -> DataFrame:
    """One row per :data:`HASHED` key with the sorted texts of a column, :data:`SEP` between them.

    The rows move as they are and are sorted by key, which the join that
    follows needs anyway; a hash aggregate of fine keys would sort twice.
    """
    whole = Window.partitionBy(*HASHED).orderBy(col).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    found = rows.select(*HASHED, F.listagg(col, F.lit(SEP)).over(whole).alias(col))
    return found.groupBy(*HASHED).agg(F.first(col).alias(col))


def _texts(joined: str) -> Column:
    return F.split(joined, SEP)


def _overall_texts(joined: str) -> Column:
    """The overall ratings of sorted texts, which come before reasons; NULL when there are none."""
    return F.when(~_is_reason(F.col(joined)), F.substring_index(joined, SEP + ":", 1))


def _is_reason(text: Column) -> Column:
    """Whether a text tells of a reason (``:rule:...``), not of an overall rating (``rule|...``)."""
    return F.startswith(text, F.lit(":"))


def _after(text: Column, sep: str, n: int) -> Column:
    """What follows the ``n``-th separator; NULL where there are fewer."""
    before = F.substring_index(text, sep, n)
    return F.when(F.length(before) < F.length(text), F.substring(text, F.length(before) + F.lit(2), F.length(text)))


def _blank(col: str) -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def _reason_list(rule: Column, reason_chars: int | None) -> Column:
    """Reasons of a rule (``:rule``) in a component's ``_text``: distinct (value, class), value DESC (NULL last), then class.

    NULL when there are none, which is asked of the text: the list is worked out once, and only where it has reasons.
    """
    start = F.concat(rule, F.lit(":"))
    some = F.contains(F.concat(F.lit(SEP), F.col("_text")), F.concat(F.lit(SEP), start))
    told = F.transform(F.filter(_texts("_text"), lambda t: F.startswith(t, start)), lambda t: _after(t, ":", 2))
    pairs = F.array_distinct(F.transform(told, lambda t: F.struct(F.substring_index(t, ":", 1).try_cast("double").alias("v"), _after(t, ":", 1).alias("c"))))
    keyed = F.transform(pairs, lambda r: F.struct(r["v"].isNull(), ~F.isnan(r["v"]), -r["v"], _unmarked(r["c"]).alias("c")))
    text = F.array_join(F.transform(F.sort_array(keyed), lambda r: r["c"]), "; ")
    return _marked(F.when(some, text if reason_chars is None else F.substring(text, 1, reason_chars)))


def _as_asked(found: DataFrame, rules: Sequence[str]) -> DataFrame:
    """Rows of distinct rules, repeated for a rule that is asked for more than once."""
    if len(set(rules)) == len(rules):
        return found
    again = F.filter(F.array(*[F.lit(r) for r in rules]), lambda r: r == F.col("mrulename"))
    return found.withColumn("mrulename", F.explode(again))


def _talks(case_sensitive: bool) -> Column:
    """Whether a component may give reasons."""
    return F.coalesce(text_ne("compkind", "miscellaneous area", case_sensitive), F.lit(False)).alias("_talks")


def _joined(values: Column, reason_chars: int | None) -> Column:
    """Sorted texts as one list; NULL when there are none."""
    text = F.when(F.size(values) > 0, F.array_join(values, "; "))
    return text if reason_chars is None else F.substring(text, 1, reason_chars)


def _by_value(pairs: Column) -> Column:
    """Classes of distinct (value, class) pairs, value DESC (NULL last), then class."""
    keyed = F.transform(pairs, lambda r: F.struct(r["interphr"].isNull(), -r["interphr"], r["interphrc"].alias("c")))
    return F.transform(F.array_sort(keyed), lambda r: r["c"])


def _listagg(value: str, order_sql: str) -> Column:
    return F.expr(f"listagg({value}, '; ') WITHIN GROUP (ORDER BY {order_sql})")


def _sub_rule_reasons(cointerp: DataFrame, rules: Sequence[str], case_sensitive: bool) -> DataFrame:
    ci = cointerp.select("cokey", "mrulename", "ruledepth", "interphr", "interphrc")
    return filter_reason(filter_rule(ci, rules, overall=False), case_sensitive)


def _cut(col: str, chars: int | None) -> Column:
    return F.col(col) if chars is None else F.substring(col, 1, chars)


def interp_reasons_dominant(dominant: DataFrame, cointerp: DataFrame, rules: Sequence[str],
                            case_sensitive: bool = False, reason_chars: int | None = None) -> DataFrame:
    """Reasons of the dominant component: distinct (class, value), value DESC then class, '; '-joined.

    ``dominant`` has ``mukey, cokey, compkind``.  The list is whole unless ``reason_chars`` says where to cut it.
    """
    comps = filter_reason_components(dominant.select("mukey", "cokey", "compkind"), case_sensitive)
    pairs = (
        _sub_rule_reasons(cointerp, rules, case_sensitive)
        .join(comps.select("mukey", "cokey"), "cokey", "inner")
        .select("mukey", "mrulename", "interphrc", "interphr")
        .distinct()
    )
    agg = pairs.groupBy("mukey", "mrulename").agg(_listagg("interphrc", "interphr DESC NULLS LAST, interphrc")
                                                  .alias("_r"))
    return agg.select("mukey", "mrulename", _cut("_r", reason_chars).alias("reason"))


def interp_reasons_all(component: DataFrame, cointerp: DataFrame, rules: Sequence[str],
                       case_sensitive: bool = False, reason_chars: int | None = None) -> DataFrame:
    """Reasons over all components of the map unit: distinct classes in class order."""
    comps = filter_reason_components(component.select("mukey", "cokey", "compkind"), case_sensitive)
    classes = (
        _sub_rule_reasons(cointerp, rules, case_sensitive)
        .join(comps.select("mukey", "cokey"), "cokey", "inner")
        .select("mukey", "mrulename", "interphrc")
        .distinct()
    )
    agg = classes.groupBy("mukey", "mrulename").agg(_listagg("interphrc", "interphrc").alias("_r"))
    return agg.select("mukey", "mrulename", _cut("_r", reason_chars).alias("reason"))


def _with_component(mapunits: DataFrame, dom: DataFrame) -> DataFrame:
    """Map units that have a component; naming the component's key lets both uses of ``dom`` share its shuffle."""
    return mapunits.join(dom.select("mukey", "cokey").where("cokey is not null"), "mukey", "inner")


def interp_dom_comp(mapunits: DataFrame, component: DataFrame, cointerp: DataFrame, rules: Sequence[str],
                    case_sensitive: bool = False, reason_chars: int | None = None) -> DataFrame:
    """Rating and class of the dominant component's overall row; reasons of the dominant component.

    Ratings and reasons come from one pass over the rows of the dominant
    components.  A second overall row of one raises, as the scalar subquery
    would (SURVEY Q7).
    """
    dom = dominant_component(component, ["compkind"]).select("mukey", "cokey", _talks(case_sensitive))
    rows = rule_facts(cointerp, rules, case_sensitive).join(dom, "cokey")
    over = lambda c: F.when(F.col("_overall"), F.col(c))
    found = rows.groupBy("mukey", "mrulename").agg(
        F.count_if("_overall").alias("_n"), F.max(over("interphr")).alias("_value"), F.max(over("interphrc")).alias("class"),
        F.collect_set(F.when(~F.col("_overall") & F.col("_talks"), F.struct("interphr", "interphrc"))).alias("_reasons"), F.max("cokey").alias("_cokey"),
    )
    several = F.concat(F.lit("more than one overall rating row for component "), F.col("_cokey"), F.lit(", rule "), F.col("mrulename"))
    found = found.select(
        "mukey", "mrulename", F.when(F.col("_n") > 1, F.raise_error(several)).otherwise(F.col("_value")).alias("rating"), "class",
        _joined(_by_value(F.col("_reasons")), reason_chars).alias("reason"),
    )
    base = _per_rule(_with_component(mapunits, dom), rules)
    return base.join(found, ["mukey", "mrulename"], "left").select(*OUT_COLS)


def interp_dom_cond(mapunits: DataFrame, component: DataFrame, cointerp: DataFrame, rules: Sequence[str],
                    case_sensitive: bool = False, reason_chars: int | None = None) -> DataFrame:
    """Dominant condition.

    rating: (class, value) groups ranked by summed percent; the rating is the
    mean of the distinct values of the top group's class, rounded to 2.
    class: distinct (class, percent) pairs summed per class; the top class.
    Ties: larger sum first, then value ascending (NULL last), then class.
    reason: as for the dominant component.

    Components move by map unit, which tells the dominant one, then by their
    key, to which the rating rows move as one short text each
    (``rule|value|class``, or ``:rule:value:reason``).  From there one row per
    component goes to the map unit; reasons go along with the dominant one
    only.  At the map unit two sorts (which spill) serve all sums and picks,
    no hash table of fine keys.
    """
    asked = list(dict.fromkeys(rules))
    no = _rule_no(asked).cast("string")
    facts = rule_facts(cointerp, asked, case_sensitive).filter(F.col("cokey").isNotNull())
    text = F.when(F.col("_overall"), F.concat_ws("|", no, _blank("interphr"), _marked("interphrc"))).otherwise(
        F.concat_ws(":", F.lit(""), no, _blank("interphr"), _marked("interphrc")))
    per_comp = _per_key(facts.select(*hashed("cokey"), text.alias("_text")), "_text")
    # without a map unit there is nothing to report to
    dealt = component.filter(F.col("mukey").isNotNull()).select("mukey", "cokey", "comppct_r", _talks(case_sensitive)).repartition("mukey")
    place = F.row_number().over(Window.partitionBy("mukey").orderBy(*dominance_columns()))
    comps = dealt.withColumn("_dominant", place == 1).filter(F.col("cokey").isNotNull()).select(
        *hashed("cokey"), "mukey", "comppct_r", "_dominant", (F.col("_dominant") & F.col("_talks")).alias("_talks"))
    # the dominant component's texts ``:rule`` or ``:rule:reasons`` also say that its map unit is reported
    every = F.array(*[F.lit(f":{i + 1}") for i in range(len(asked))])
    lists = F.transform(every, lambda i: F.concat_ws(":", i, F.when(F.col("_talks"), _reason_list(i, reason_chars))))
    told = F.concat_ws(SEP, _overall_texts("_text"), F.when(F.col("_dominant"), lists))
    rows = comps.join(per_comp, HASHED, "left").filter("_dominant or _text is not null").select("mukey", "comppct_r", told.alias("_told")).repartition("mukey")
    rows = rows.select("mukey", "comppct_r", F.explode(_texts("_told")).alias("_text")).filter("_text != ''")
    t, said = F.col("_text"), _is_reason(F.col("_text"))
    rows = rows.select(
        "mukey", F.when(said, F.substring_index(_after(t, ":", 1), ":", 1)).otherwise(F.substring_index(t, "|", 1)).cast("int").alias("_rule"),
        F.when(~said, F.col("comppct_r")).alias("comppct_r"), said.alias("_said"), F.when(said, _unmarked(_after(t, ":", 2))).alias("_reason"),
        F.when(~said, F.substring_index(_after(t, "|", 1), "|", 1)).try_cast("double").alias("interphr"), F.when(~said, _unmarked(_after(t, "|", 2))).alias("interphrc"),
    )
    unit = ["mukey", "_rule", "interphrc"]
    # a percent counts once in its class, and a value once in the class's mean
    one = lambda key, then: F.row_number().over(Window.partitionBy(*unit, key).orderBy(then)) == 1
    rows = rows.withColumn("_first_pct", one("comppct_r", "interphr")).withColumn("_first", one("interphr", "comppct_r"))
    whole = Window.partitionBy(*unit)
    rows = rows.withColumn("_s", F.sum("comppct_r").over(Window.partitionBy(*unit, "interphr"))).withColumn(
        "_cavg", F.avg(F.when(F.col("_first"), F.col("interphr"))).over(whole)).withColumn(
        "_cs", F.sum(F.when(F.col("_first_pct"), F.col("comppct_r"))).over(whole))
    none = F.col("interphrc").isNull()
    rated = lambda *order: F.when(~F.col("_said"), F.struct(*order))
    key = rated(F.col("_s").isNull(), -F.col("_s"), F.col("interphr").isNull(), F.col("interphr"), none, F.col("interphrc"))
    found = rows.groupBy("mukey", "_rule").agg(
        F.min_by("_cavg", key).alias("_cavg"),
        F.min_by("interphrc", rated(F.col("_cs").isNull(), -F.col("_cs"), none, F.col("interphrc"))).alias("class"),
        F.max("_reason").alias("reason"), F.bool_or("_said").alias("_said"),
    ).filter("_said").select("mukey", _rule_name(asked), round2(F.col("_cavg")).alias("rating"), "class", "reason")
    return _as_asked(mapunits.join(found, "mukey"), rules).select(*OUT_COLS)


def interp_weighted_avg(mapunits: DataFrame, component: DataFrame, cointerp: DataFrame, rules: Sequence[str],
                        case_sensitive: bool = False, reason_chars: int | None = None) -> DataFrame:
    """Percent-weighted rating: round(sum(value x pct), 2) / round(sum(pct of rated), 2), rounded; NULL -> 99.

    A zero denominator gives NULL (-> 99) instead of an error (SURVEY Q8).
    The class is the band of the rounded ratio for the rule's direction.
    One pass over the rating rows.  They move by component as one short text
    each (``rule|design|value``, or ``:rule:reason``) with a hash for the key,
    and on to the map unit as one row per component; there plain sums by reason
    come first, so that only distinct reasons are gathered.
    """
    asked = list(dict.fromkeys(rules))
    facts = rule_facts(cointerp, asked, case_sensitive).filter(F.col("cokey").isNotNull())
    no = _rule_no(asked).cast("string")
    text = F.when(F.col("_overall"), F.concat_ws("|", no, _blank("ruledesign"), _blank("interphr"))).otherwise(
        F.concat_ws(":", F.lit(""), no, _marked("interphrc")))
    per_comp = _per_key(facts.select(*hashed("cokey"), text.alias("_text")), "_text")
    # components without rating rows stay: their map units are reported
    comps = component.filter(F.col("mukey").isNotNull()).select(*hashed("cokey"), "mukey", "comppct_r", _talks(case_sensitive))
    told = F.when(F.col("_talks"), F.col("_text")).otherwise(_overall_texts("_text"))
    dealt = comps.join(per_comp, HASHED, "left").select("mukey", "comppct_r", told.alias("_told")).repartition("mukey")
    every = F.concat_ws(SEP, *[F.lit(str(i + 1)) for i in range(len(asked))], "_told")
    rows = dealt.select("mukey", "comppct_r", every.alias("_told")).select("mukey", "comppct_r", F.explode(_texts("_told")).alias("_text")).filter("_text != ''")
    t, reason = F.col("_text"), _is_reason(F.col("_text"))
    rows = rows.select(
        "mukey", F.when(reason, F.substring_index(_after(t, ":", 1), ":", 1)).otherwise(F.substring_index(t, "|", 1)).cast("int").alias("_rule"),
        "comppct_r", F.when(~reason, F.substring_index(_after(t, "|", 1), "|", 1)).alias("_design"),
        F.when(~reason, _after(t, "|", 2)).try_cast("double").alias("_value"), F.when(reason, _unmarked(_after(t, ":", 2))).alias("_reason"),
    )
    by_reason = rows.groupBy("mukey", "_rule", "_reason").agg(
        F.sum(F.col("_value") * F.col("comppct_r")).alias("_raw"),
        F.sum(F.when(F.col("_value").isNotNull(), F.col("comppct_r"))).alias("_sc"),
        F.min(F.col("_design").try_cast("int")).alias("_design"), F.count("_design").alias("_n"),
    )
    agg = by_reason.groupBy("mukey", "_rule").agg(
        F.sum("_raw").alias("_raw"), F.sum("_sc").alias("_sc"), F.min("_design").alias("_design"), F.sum("_n").alias("_n"),
        F.collect_list("_reason").alias("_reasons"),
    )
    raw = round2(F.col("_raw"))
    ratio = round2(F.try_divide(raw, round2(F.col("_sc"))))
    scored = agg.select(
        "mukey", _rule_name(asked),
        F.when(F.col("_n") > 0, F.coalesce(ratio, F.lit(99.0))).alias("rating"),
        interp_class_bins(raw, ratio, interp_design(F.col("_design"))).alias("_class"),
        _joined(F.array_sort("_reasons"), reason_chars).alias("reason"),
    )
    # every asked rule has its row; with no overall row for it: rating NULL -> 99, class Not Rated
    return _as_asked(mapunits.join(scored, "mukey"), rules).select(
        *KEY_COLS, "mrulename",
        F.coalesce(F.col("rating"), F.lit(99.0)).alias("rating"),
        F.when(F.col("rating").isNull(), F.lit("Not Rated")).otherwise(F.col("_class")).alias("class"),
        "reason",
    )
