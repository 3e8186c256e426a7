"""Text report framing, parsing, merge and validation (Q14-Q17, Q20)."""

from loam.operators import reports as R
from loam.sources import reports as RS


def _lines(spark, reports):
    rows = [(rid, i, line) for rid, lines in reports.items() for i, line in enumerate(lines)]
    return spark.createDataFrame(rows, "report_id string, line_no bigint, line string")


def test_extract_frames(spark):
    lines = _lines(spark, {
        "a": ["noise", "  xx START yy ", "r1", " r2 ", "STOP", "r3", "START", "r4", "STOP"],
        "b": ["noise", "r1", "STOP"],                       # no START: invalid
        "c": ["START", "only"],                             # no STOP: to the end
        "d": ["START", "STOPPED", " STOP "],                # STOPPED is content; stripped STOP ends
    })
    got = sorted((r.report_id, r.line) for r in RS.report_extract(lines).collect())
    assert got == [("a", "r1"), ("a", "r2"), ("c", "only"), ("d", "STOPPED")]
    two = sorted({r.report_id for r in RS.report_extract(lines, min_lines=2).collect()})
    assert two == ["a"]


def test_project_parse_merge_and_rejects(spark):
    framed = _lines(spark, {"p": [
        '"101"|s|0.5|Somewhat limited|non-mlra map unit|Limitation',
        "101|s|0.7|Very limited|mmu|Limitation",
        "102|s|0.1|Not limited|non-mlra map unit|Limitation|extra",
        "101|s|0.9|Very limited, wet|non-mlra map unit|Limitation",   # later line wins
        "103|non-mlra map unit",                                        # too few fields: rejected (Q20)
        "abc|s|0.1|x|non-mlra map unit|Limitation",                     # non-numeric key: rejected
        "104|s|0.2|x|mmu|Limitation",                                   # MLRA only: dropped by the merge
        "header line",                                                  # neither kind: ignored
    ]})
    merged = {r.mukey: r for r in R.merge_ratings_wide(RS.report_parse_project_wide(framed)).collect()}
    assert set(merged) == {"101", "102"}
    assert merged["101"].n_rating == "0.9" and merged["101"].n_class == "Very limited, wet"
    assert merged["101"].m_rating == "0.7" and merged["101"].int_mukey == 101
    assert merged["102"].n_kind == "Limitation|extra"
    assert (merged["102"].m_rating, merged["102"].m_class, merged["102"].m_type, merged["102"].m_kind) == ("UNK",) * 4
    rej = sorted((r.line_no, r.reason) for r in R.drop_malformed(framed).collect())
    assert rej == [(4, "too few fields"), (5, "non-numeric key")]


def test_area_parse_keeps_comma_and_last_line(spark):
    framed = _lines(spark, {"NC001": [
        '"201"|"A1"|0.5|Very limited, wet|Limitation',
        "202|B|0.1|Not limited|Limitation",
        "201|A1|0.6|Somewhat limited|Limitation",
        "mukey|musym|rating|class|kind",
    ]})
    got = {r.mukey: r for r in RS.report_parse_area(framed).collect()}
    assert got["201"].rating == "0.6" and got["202"]["class"] == "Not limited" and got["202"].int_mukey == 202
    first = RS.report_parse_area(framed.filter("line_no = 0")).collect()[0]
    assert first["class"] == "Very limited, wet"      # Q15: a comma inside a class is kept
    batch = RS.report_parse_area_batch(framed).collect()
    assert len(batch) == 3 and all(r.str_mukey == str(r.mukey) for r in batch)


def test_single_kind_and_reconcile(spark):
    framed = _lines(spark, {"x": ["a|Limitation", "b|Limitation"], "y": ["a|Limitation", "b|Suitability"],
                            "z": ["a|none"]})
    got = {r.report_id: r.kind for r in R.single_kind(framed).collect()}
    assert got == {"x": "Limitation", "y": None, "z": None}
    rep = spark.createDataFrame([("A", "1"), ("A", "2")], "areasymbol string, mukey string")
    loc = spark.createDataFrame([("A", "2"), ("A", "3"), ("B", "1")], "areasymbol string, mukey string")
    diff = sorted(tuple(r) for r in R.key_reconcile(rep, loc).collect())
    assert diff == [("A", "1", "report_only"), ("A", "3", "local_only"), ("B", "1", "local_only")]  # Q17


def test_read_report_files(spark, scratch):
    import os

    os.makedirs(os.path.join(scratch, "rep"))
    with open(os.path.join(scratch, "rep", "a.txt"), "w") as f:
        f.write("noise\r\nSTART\n301|s|0.1|c|non-mlra map unit|Limitation\nSTOP\nafter\n")
    lines = RS.read_report_lines(spark, os.path.join(scratch, "rep"))
    framed = RS.report_extract(lines).collect()
    assert [r.line for r in framed] == ["301|s|0.1|c|non-mlra map unit|Limitation"]
    assert framed[0].report_id.endswith("a.txt")
