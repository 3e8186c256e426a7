"""Merkle manifest: brute force over driver documents and over null, repeated, sparse and extreme ids."""

import hashlib
import random
import zlib

import pytest

from loam.llm.merkle_manifest import merkle_manifest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    fields = (row[k] for k in ("doc_id", "source", "lang", "n_chars", "text"))
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields))


def tree(hashes):
    levels = [hashes]
    while len(levels[-1]) > 1:
        levels.append([h("".join(levels[-1][i : i + 16])) for i in range(0, len(levels[-1]), 16)])
    return levels


def steps(levels, i):
    for level in levels[:-1]:
        at = i // 16 * 16
        run = level[at : at + 16]
        yield "".join(run[: i - at]), "".join(run[i - at + 1 :])
        i //= 16


def brute(rows):
    if not rows:
        return
    by = {}
    for r in rows:
        by.setdefault(r["source"], []).append(r)
    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    for s in sources:
        by[s].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
    trees = {s: tree([leaf(r) for r in by[s]]) for s in sources}
    top = tree([trees[s][-1][0] for s in sources])
    root = top[-1][0]
    for k, s in enumerate(sources):
        for i, r in enumerate(by[s]):
            path = [*steps(trees[s], i), *steps(top, k)]
            f = leaf(r)
            if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0:
                f = leaf({**r, "text": None if r["text"] is None else r["text"].translate(LOWER)})
            for a, b in path:
                f = h(a + f + b)
            yield r["doc_id"], leaf(r), trees[s][-1][0], root, h("".join(a + b for a, b in path)), f, f == root


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=lambda t: (t[0] is not None, t[0] or 0, *t[1:]))


def check(df, rows):
    got = ordered(merkle_manifest(df).collect())
    assert got == ordered(brute(rows))
    return got


def test_driver_documents(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = check(df, [r.asDict() for r in df.collect()])
    assert {r[-1] for r in got} == {True, False}


def test_null_repeated_and_extreme_ids(spark):
    r = random.Random(1)
    rows = []
    for i in range(700):
        x = r.random()
        ident = None if x < 0.2 else 7 if x < 0.4 else r.choice([i, -i, i * 10**15, 2**63 - 1 - i, -(2**63) + i, 63, 64])
        source = "solo" if i == 5 else r.choice([None, "a", "b", "é", "b"])
        rows.append((ident, r.choice(["Ab c", "", None, "É Z", f"T{i}", "x" * 9000]), r.choice(["en", None]), source, r.choice([None, 3])))
    rows += rows[:40] + [(7, "same", "en", "b", 4)] * 50
    df = spark.createDataFrame(rows, SCHEMA)
    names = SCHEMA.replace(" long", "").replace(" string", "").split(", ")
    clash = df.selectExpr("*", "1 as leaf", "2 as pos", "3 as grp", "map(1, 2) as word", "4 as n")
    check(clash, [dict(zip(names, row)) for row in rows])


@pytest.mark.parametrize("n", [0, 1, 16, 17, 257])
def test_sizes(spark, n):
    df = spark.createDataFrame([(i * 3, f"Text {i}", "en", "s", i) for i in range(n)], SCHEMA)
    check(df, [r.asDict() for r in df.collect()])
