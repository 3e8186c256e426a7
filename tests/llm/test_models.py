"""Quality rules and classifier: counts by brute force, held-out accuracy, edge cases."""

import random
import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from loam.llm.common import labelled_rows, table
from loam.llm.quality_classifier import DIM, PLACES, add_contexts, index_entries, quality_classifier, word_places, word_vectors
from loam.llm.quality_rules import base_counts, keep_quality, parse, quality_rules

SF = "/root/testdata/sf0.01"
WORD = r"[^\x20\x09-\x0D]+"


def brute_counts(text):
    words = re.findall(WORD, text or "")
    lines = (text or "").split("\n")
    dup = sum(1 for i, x in enumerate(lines) if re.search(WORD, x) and x in lines[:i])
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in range(i, i + 3)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(covered)


def test_base_counts_match_brute_force():
    r = random.Random(4)
    for _ in range(300):
        text = "".join(r.choice(["a", "b ", "é", " ", "\n", "\n", "\t", "\x0b", "#", "*|", " ", "日本", "\r\n", "\x1f"]) for _ in range(r.randint(0, 80)))
        assert base_counts(text, parse(text)) == brute_counts(text)
    long = "word two three " * 5000
    assert base_counts(long, parse(long)) == (15000, 60000, 0, 0, 15000)


def test_quality_rules_on_driver_rows(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    rows = {r.doc_id: r.text for r in docs.collect()}
    quality = {r.doc_id: r.quality for r in labels.collect()}
    got = {r.doc_id: r for r in quality_rules(docs, labels).collect()}
    assert set(got) == set(rows)
    right = judged = 0
    for i, text in rows.items():
        r, c = got[i], brute_counts(text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == c
        assert r.base_failed == (c[0] < 50 or 100 * c[4] > 50 * c[0])
        assert r.kept == (not r.base_failed and r.probability >= 0.5)
        if i in quality and not r.base_failed:
            judged, right = judged + 1, right + (r.kept == (quality[i] == 1))
    assert right >= 0.97 * judged
    kept = {r.doc_id for r in keep_quality(docs, labels).select("doc_id").collect()}
    assert kept == {i for i, r in got.items() if r.kept}


def test_quality_rules_edge_cases(spark):
    schema, label = "doc_id long, text string", "doc_id long, quality int"
    good = " ".join(f"w{i}" for i in range(60))
    rows = [(1, None), (None, good), (2, good), (2, good), (3, "")]
    df = spark.createDataFrame(rows, schema).withColumn("kept", F.lit("clash"))
    for labelled in ([], [(2, 1)], [(None, 0), (2, None)]):
        got = sorted((r.doc_id or 0, r.n_words, r.base_failed, r.kept, r.probability) for r in quality_rules(df, spark.createDataFrame(labelled, label)).collect())
        assert got == [(0, 60, False, True, 1.0), (1, 0, True, False, 1.0), (2, 60, False, True, 1.0), (2, 60, False, True, 1.0), (3, 0, True, False, 1.0)]
    empty = spark.createDataFrame([], schema)
    assert quality_rules(empty, spark.createDataFrame([], label)).count() == 0


def test_context_sums_match_brute_force(spark):
    texts = ["a b c d e a b", "", None, "x", "b a " * 40, "é ü a"]
    table_ = np.zeros((PLACES, DIM + 1), np.int64)
    add_contexts(table_, texts)
    want = np.zeros_like(table_)
    for text in texts:
        hashes, words, ends = word_places(text or "")
        columns, signs = index_entries(hashes)
        for i in range(len(words)):
            for place in (words[i], ends[i]):
                want[place, DIM] += 1
                for j in range(max(0, i - 2), min(len(words), i + 3)):
                    if j != i:
                        for c, s in zip(columns, signs):
                            want[place, c[j]] += int(s[j])
    assert (table_ == want).all()
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    assert np.array_equal(word_vectors(df.repartition(3)), word_vectors(df.coalesce(1)))


def test_classifier_on_held_out_rows(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    got = {r.doc_id: r for r in quality_classifier(docs, labels).collect()}
    assert len(got) == docs.count()
    quality = {r.doc_id: r.quality for r in labels.collect()}
    held = [i for i in quality if zlib.crc32(str(i).encode()) % 3 == 1]
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i in got)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())
    assert sum(got[i].predicted == quality[i] for i in held) >= 0.95 * len(held)
    # held-out labels are never read
    flipped = labels.withColumn("quality", F.when(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) == 1, 1 - F.col("quality")).otherwise(F.col("quality")))
    again = {r.doc_id: r.score for r in quality_classifier(docs, flipped).collect()}
    assert all(again[i] == got[i].score for i in got)


def test_classifier_edge_cases(spark):
    schema, label = "doc_id long, text string", "doc_id long, quality int"
    df = spark.createDataFrame([(1, None), (None, "a b"), (2, "a b"), (2, "a b")], schema).withColumn("score", F.lit("clash"))
    got = quality_classifier(df, spark.createDataFrame([], label)).collect()
    assert sorted((r.doc_id or 0, r.score, r.predicted, r.held_out) for r in got)[0] == (0, 0.5, 1, False)
    only = quality_classifier(df, spark.createDataFrame([(2, 0), (None, 1)], label)).collect()
    assert {r.score for r in only} == {0.0 if zlib.crc32(b"2") % 3 != 1 else 0.5}
    assert quality_classifier(spark.createDataFrame([], schema), spark.createDataFrame([], label)).count() == 0


def test_sample_is_bounded_by_documents_not_labels(spark):
    """One labelled id that repeats with many texts, and many rows that repeat id and text."""
    rows = [(1, f"text {i}") for i in range(500)] + [(2, "same")] * 300 + [(3, None), (None, "x"), (4, "no label")]
    docs = spark.createDataFrame(rows, "doc long, text string").repartition(7)
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 1), (3, 0), (None, 1), (5, None)], "doc long, label int")
    got = labelled_rows(docs, labels, 50, seed=3).collect()
    assert len(got) == 50 and len({(r.doc, r.text) for r in got}) == 50
    again = labelled_rows(docs.coalesce(1), labels, 50, seed=3).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    everything = labelled_rows(docs, labels, 1000, seed=3).collect()
    assert sorted({(r.doc, r.label) for r in everything}) == [(1, 0), (2, 1), (3, 0)] and len(everything) == 502


def test_quality_rules_fit_without_a_data_frame_of_python_objects(spark, monkeypatch):
    """The sample's vectors come to the driver as one block, and the rows' order among the tasks doesn't matter."""
    from pyspark.sql import functions as F

    from loam.llm import quality_rules as Q

    rows = [(i, " ".join(f"{'good' if i % 2 else 'bad'}{(i * j) % 17}" for j in range(70)), i % 2) for i in range(60)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc long, label int")
    monkeypatch.setattr(type(docs), "toPandas", None)
    one, other = Q.train(docs, labels), Q.train(docs.orderBy(F.desc("doc")).repartition(3), labels)
    assert (one.weights == other.weights).all() and one.bias == other.bias
    assert one.weights.dtype == "float32" and abs(one.weights).max() > 0
    assert Q.train(docs, labels.where("label = 1")) is None and Q.train(docs, labels.limit(0)) is None
