"""suffix_dedup against a brute-force pass over all byte strings."""

import hashlib
import random

from pyspark.sql import functions as F

from loam.llm.suffix_dedup import suffix_dedup


def brute(rows, length):
    """{(doc, text): (n_bytes, removed bytes, spans, sha)}; rows sorted the way the operator orders them."""
    seen, out = {}, {}
    for doc, text in rows:
        data = (text or "").encode()
        gone = [False] * len(data)
        for p in range(len(data) - length + 1):
            w = data[p : p + length]
            if w in seen:
                gone[p : p + length] = [True] * length
            else:
                seen[w] = doc
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out[doc] = (len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def corpus(seed):
    r = random.Random(seed)
    words = ["".join(r.choice("abcdeé ") for _ in range(r.randint(1, 9))) for _ in range(60)]
    text = lambda n: " ".join(r.choice(words) for _ in range(n))
    passages = [text(r.randint(10, 80)) for _ in range(6)]
    docs = ["", None, "x" * 450, "ab" * 300, "x" * 99, "x" * 100]
    for _ in range(60):
        parts = [r.choice(passages) if r.random() < 0.4 else text(r.randint(0, 60)) for _ in range(r.randint(1, 6))]
        docs.append("".join(parts))
    docs += [docs[10], docs[11], docs[10] + "!", docs[12][:150] + "zz" + docs[12][150:]]
    return list(enumerate(docs))


def run(spark, rows, **options):
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("id", F.lit("clash"))
    return suffix_dedup(df.repartition(5), **options).collect()


def test_matches_brute_force(spark):
    for seed in (1, 2):
        rows = corpus(seed)
        for length, gram in ((100, 40), (50, 20)):
            got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in run(spark, rows, length=length, gram=gram)}
            assert got == brute(rows, length)


def test_removed_runs_and_nulls(spark):
    same = "The quick brown fox jumps over the lazy dog. " * 3
    rows = [(None, same), (5, same), (5, same), (7, "start " + same + "end"), (8, None)]
    got = sorted(((r.doc_id is not None, r.doc_id or 0), r.n_removed, r.removed) for r in run(spark, rows))
    inner = 100 + (len(same) - 100)
    # inside the first text the second sentence repeats nothing of 100 bytes; the copies go whole, alike
    assert got[1][1:] == got[2][1:] == (len(same), [0, len(same)])
    assert got[3][1:] == (inner, [6, 6 + inner])
    assert got[4][1:] == (0, [])


def test_empty_table(spark):
    assert run(spark, []) == []


def test_many_texts_under_one_id(spark):
    """2,000 texts without an id and 500 under one id, with shared passages: told apart by the whole hash of the text."""
    r = random.Random(9)
    passages = ["".join(r.choice("abcdefgh ") for _ in range(150)) for _ in range(40)]
    some = lambda: "".join(r.choice("abcdefgh ") for _ in range(r.randint(0, 60)))
    texts = [some() + r.choice(passages)[: r.randint(90, 150)] + some() for _ in range(2520)]
    ids = [None] * 2000 + [7] * 500 + list(range(20))
    df = spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string")
    named = df.select("doc_id", "text", F.xxhash64("text").alias("h")).distinct().collect()
    order = sorted(named, key=lambda x: (x.doc_id is not None, x.doc_id or 0, x.h))
    want = brute([((x.doc_id, x.text), x.text) for x in order], 100)
    got = sorted((str(x.doc_id), x.n_bytes, x.n_removed, x.n_spans, x.kept_sha256) for x in suffix_dedup(df.repartition(6)).collect())
    assert got == sorted((str(i), *want[i, t]) for i, t in zip(ids, texts))
    assert sum(x[2] > 0 for x in got) > 2000
