"""Substring dedup by fixed-block anchors: brute force on windows of words."""

import hashlib
import random
import re

import pytest

from loam.llm import substring_dedup as module
from loam.llm.substring_dedup import substring_dedup

DOCS = "doc_id long, text string"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute(rows):
    key = lambda d: -(1 << 63) if d is None else d
    held = {}
    for d, t in rows:
        w = words(t)
        for i in range(len(w) - 12):
            held[tuple(w[i : i + 13])] = min(held.get(tuple(w[i : i + 13]), 1 << 70), key(d))
    for d, t in rows:
        w, gone = words(t), set()
        for i in range(len(w) - 12):
            if held[tuple(w[i : i + 13])] < key(d):
                gone.update(range(i, i + 13))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        yield d, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=lambda t: (t[0] is not None, t[0] or 0, *t[1:]))


def passages(seed, n=300):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(30)] + ["É", "ü", "a,b"]
    some = lambda k: " ".join(r.choice(vocabulary) for _ in range(r.randint(0, k)))
    base = [some(60) for _ in range(40)]
    rows = []
    for _ in range(n):
        parts = [r.choice(base)[r.randint(0, 20) :] if r.random() < 0.6 else some(30) for _ in range(r.randint(0, 4))]
        text = r.choice([" ", "\n", "\t", ""]) + r.choice(["  ", "\r\n", "\x0b"]).join(parts)
        rows.append((None if r.random() < 0.1 else r.randint(-5, 300), None if r.random() < 0.03 else text))
    return rows + rows[:30] + [(400 + i, "a " * 200) for i in range(5)] + [(1000, "z " * 5000), (1001, "y" * 100_000), (1002, "")]


@pytest.mark.parametrize("small", [False, True])
def test_brute_force(spark, monkeypatch, small):
    """Also with tiny batches and buckets, so that copies lie in many of both."""
    if small:
        monkeypatch.setattr(module, "BATCH_WORDS", 300)
        monkeypatch.setattr(module, "BUCKET_ENTRIES", 900)
        monkeypatch.setattr(module, "DOC_SLOTS", 8)
    rows = passages(3)
    df = spark.createDataFrame(rows, DOCS).selectExpr("*", "1 as digest", "2 as places", "3 as _slot", "map(1, 2) as hit")
    got = ordered(substring_dedup(df.repartition(7), texts=True).collect())
    assert got == ordered(brute(rows)) and sum(r[2] > 0 for r in got) > 100


def test_every_offset_of_a_shared_window(spark):
    """A window of exactly 13 words is found wherever it lies against the reference's blocks."""
    run = " ".join(f"s{i}" for i in range(13))
    rows = [(i, " ".join([f"a{i}x{j}" for j in range(i)] + [run] + [f"b{i}x{j}" for j in range(20 - i)])) for i in range(14)]
    got = {r.doc_id: r.n_removed for r in substring_dedup(spark.createDataFrame(rows, DOCS)).collect()}
    assert got == {i: 13 if i else 0 for i in range(14)}


def test_hot_passage_and_copies(spark):
    """A passage in every document and a group of copies: one entry of each batch in a bucket."""
    passage = " ".join(f"p{i}" for i in range(30))
    rows = [(i, f"x{i} y{i} {passage} z{i}") for i in range(400)] + [(1000 + i, f"copy {passage} of {passage}") for i in range(200)]
    got = ordered(substring_dedup(spark.createDataFrame(rows, DOCS), texts=True).collect())
    assert got == ordered(brute(rows))
    assert substring_dedup(spark.createDataFrame([], DOCS)).count() == 0


def test_driver_documents(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    assert ordered(substring_dedup(df, texts=True).collect()) == ordered(brute([tuple(r) for r in df.collect()]))
