"""Ranked lexical search: integer scores of all documents by brute force, ties, nulls, blocks, pruning."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from loam.llm import lexical_search as module
from loam.llm.lexical_search import Query, lexical_search, search_bucket

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, top=10):
    held = [(d, Counter(terms(t))) for d, t in docs]
    held = [(d, c, sum(c.values())) for d, c in held if c]
    total, df = sum(n for *_, n in held), Counter(t for _, c, _ in held for t in c)
    for item, text in items:
        found = []
        for d, c, n in held:
            m = 10 + (90 * n * len(held)) // total
            score = sum(math.floor(1000 * math.log((2 * len(held) + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
                        for t in set(terms(text)) if c[t])
            if score > 0:
                found.append((-score, d is None, d or 0))
        for rank, (s, null, d) in enumerate(sorted(found)[:top], 1):
            yield item, rank, None if null else d, -s


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=lambda t: (t[0] is not None, t[0] or 0, t[1], str(t)))


def corpus(seed, n=400):
    r = random.Random(seed)
    vocabulary = ["The", "of", "É", "é", "x1", "naïve", "a_b", "q;r", "\x00z"] + [f"w{i}" for i in range(60)]
    some = lambda k: r.choice([" ", ", ", "\n"]).join(r.choice(vocabulary) for _ in range(k))
    docs = [(None if r.random() < 0.1 else r.randint(0, 350), r.choice([None, "", "!?", some(r.randint(1, 80))])) for _ in range(n)]
    docs += [(500 + i, "w1 w2 w3 copies") for i in range(60)] + [(900, "w5 " * 30_000), (901, "w" * 50_000)]
    items = [(i, some(r.randint(1, 30))) for i in range(25)] + [(3, "w1 w2"), (None, "copies w7"), (70, None), (71, "..."), (72, "unheardof")]
    return docs, items


@pytest.mark.parametrize("small", [False, True])
def test_brute_force(spark, monkeypatch, small):
    """Also with tiny blocks of queries, buckets and focus, and texts split in pieces."""
    if small:
        for name, value in (("BLOCK_ITEMS", 7), ("BLOCK_TERMS", 60), ("BUCKET", 16), ("FOCUS", 2), ("PIECE", 50)):
            monkeypatch.setattr(module, name, value)
    docs, items = corpus(2)
    df = spark.createDataFrame(docs, DOCS).selectExpr("*", "1 as norm", "2 as terms", "map(1, 2) as n").repartition(5)
    got = ordered(lexical_search(df, spark.createDataFrame(items, ITEMS).selectExpr("*", "1 as rank")).collect())
    assert got == ordered(brute(docs, items))


def test_empty_tables(spark):
    docs, items = corpus(4, 30)
    some, none = spark.createDataFrame(docs, DOCS), spark.createDataFrame([], DOCS)
    asked, nothing = spark.createDataFrame(items, ITEMS), spark.createDataFrame([], ITEMS)
    for a, b in ((none, asked), (some, nothing), (spark.createDataFrame([(1, None), (2, "- -")], DOCS), asked)):
        assert lexical_search(a, b).count() == 0


def test_short_vectors_are_pruned_and_nothing_is_lost():
    """A bucket below the threshold offers nothing; within a bucket only documents that can reach it are scored."""
    r = np.random.default_rng(1)
    q = Query(np.arange(20), np.arange(20, 0, -1).astype(np.int64), 0, 10)
    offered = []
    keep = q.offer
    q.offer = lambda scores, *rest: (offered.append(len(scores)), keep(scores, *rest))
    every = []
    for scale in (1000, 100, 1):
        width = np.full(50, 8)
        held = np.concatenate([np.sort(r.choice(20, 8, replace=False)) for _ in width])
        impacts = r.integers(1, 10, len(held)) * scale
        starts = np.concatenate(([0], np.cumsum(width)))
        norms = np.sqrt(np.add.reduceat(impacts.astype(float) ** 2, starts[:-1]))
        order = np.argsort(-norms, kind="stable")
        entry = np.concatenate([np.arange(starts[i], starts[i] + 8) for i in order])
        ids = np.arange(50) + len(every)
        search_bucket([q], np.zeros(20, np.int64), ids, np.zeros(50, bool), norms[order], starts, held[entry], impacts[entry])
        scores = np.add.reduceat((20 - held[entry]) * impacts[entry], starts[:-1])
        every += list(zip(-scores, ids))
    assert sorted(every)[:10] == [(-s, i) for s, i in zip(q.scores, q.ids)]
    assert len(offered) == 1
