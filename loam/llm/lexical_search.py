"""Ranked lexical search by length-ordered impact vectors.

A document is a sparse vector of impacts over the terms of the query set, a
query a vector of term weights, the score their inner product.  Vectors are
ordered by length and cut into buckets: a bucket whose greatest length times
the query's is below the query's tenth-best score is skipped (Cauchy-Schwarz),
and inside a bucket the query's heaviest coordinates bound each document's
score.  What survives is scored exactly in 64-bit integers.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

from loam.llm.common import ready, slices, stage

TOP = 10
#: Queries are taken in blocks of so many items and term entries, which go to every task.
BLOCK_ITEMS, BLOCK_TERMS = 1_000, 100_000
#: Vectors per bucket, and coordinates of a query that the filter inside a bucket looks at.
BUCKET, FOCUS = 1_024, 8
#: Bytes of text split into terms at once.
PIECE = 1 << 22

#: Every byte that is no part of a term becomes a blank, A-Z lower case; bytes of non-ASCII characters stay.
_TERM_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


def pieces(text: bytes) -> Iterator[list[bytes]]:
    """Terms of a text, in lists of bounded size (a term is never cut)."""
    text = text.translate(_TERM_BYTES)
    start = 0
    while start < len(text):
        end = text.find(b" ", start + PIECE)
        end = len(text) if end < 0 else end
        yield text[start:end].split()
        start = end


def query_blocks(items: DataFrame) -> Iterator[list[tuple[Row, list[bytes]]]]:
    """The query set in blocks: (item's row, its distinct terms); items without terms are left out."""
    block, size = [], 0
    for row in items.select("item_id", "text").toLocalIterator():
        terms = list(dict.fromkeys(t for part in pieces((row.text or "").encode("utf-8", "surrogatepass")) for t in part))
        if block and (len(block) == BLOCK_ITEMS or size + len(terms) > BLOCK_TERMS):
            yield block
            block, size = [], 0
        if terms:
            block.append((row, terms))
            size += len(terms)
    if block:
        yield block


def _vectors(vocabulary: dict[bytes, int]) -> Callable:
    """Term counts of every text over the vocabulary, with the number of all its terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shuffled = np.random.default_rng(5)
        for whole in batches:
            for batch in slices(whole, 2_000):
                lengths, terms, counts = [], [], []
                for text in batch.column("text").cast(pa.binary()):
                    n, held = 0, Counter()
                    for part in pieces(text.as_py() or b""):
                        n += len(part)
                        held.update(filter(vocabulary.__contains__, part))
                    lengths.append(n)
                    terms.append([vocabulary[t] for t in held])
                    counts.append(list(held.values()))
                salt = shuffled.integers(0, 1 << 31, batch.num_rows, dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(lengths, pa.int64()), pa.array(terms, pa.list_(pa.int32())),
                     pa.array(counts, pa.list_(pa.int64())), pa.array(salt)],
                    names=["doc_id", "n", "terms", "counts", "salt"],
                )

    return run


def _best(scores: np.ndarray, ids: np.ndarray, nulls: np.ndarray, top: int) -> np.ndarray:
    return np.lexsort((ids, nulls, -scores))[:top]


class Query:
    """A query inside a task: its coordinates by falling weight, and its best documents so far."""

    def __init__(self, terms: np.ndarray, weights: np.ndarray, floor: int, top: int):
        order = np.argsort(-weights, kind="stable")
        self.terms, self.weights, self.floor, self.top = terms[order], weights[order], floor, top
        squares = self.weights.astype(np.float64) ** 2
        self.length = math.sqrt(squares.sum())
        self.rest = math.sqrt(squares[FOCUS:].sum())
        self.scores, self.ids, self.nulls = (np.zeros(0, t) for t in (np.int64, np.int64, bool))

    def offer(self, scores: np.ndarray, ids: np.ndarray, nulls: np.ndarray) -> None:
        scores, ids = np.concatenate([self.scores, scores]), np.concatenate([self.ids, ids])
        nulls = np.concatenate([self.nulls, nulls])
        best = _best(scores, ids, nulls, self.top)
        self.scores, self.ids, self.nulls = scores[best], ids[best], nulls[best]
        if len(best) == self.top:
            self.floor = max(self.floor, int(self.scores[-1]))


#: Bounds are in doubles; what they leave out is below the threshold by more than their rounding.
SLACK = 1 + 1e-9


def search_bucket(queries: list[Query], dense: np.ndarray, ids, nulls, norms, starts, terms, impacts) -> None:
    """Offer a bucket's documents (in falling length, in row form) to every query that they can still serve."""
    by_term = np.argsort(terms, kind="stable")
    columns, rows = terms[by_term], np.repeat(np.arange(len(norms)), np.diff(starts))[by_term]
    held = impacts[by_term].astype(np.float64)
    squared = norms**2
    for q in queries:
        if q.length * norms[0] * SLACK < max(q.floor, 1):
            continue
        partial, seen = np.zeros(len(norms)), np.zeros(len(norms))
        focus = q.terms[:FOCUS]
        for a, b, w in zip(np.searchsorted(columns, focus), np.searchsorted(columns, focus, "right"), q.weights[:FOCUS]):
            partial[rows[a:b]] += w * held[a:b]
            seen[rows[a:b]] += held[a:b] ** 2
        bound = partial + q.rest * np.sqrt(np.maximum(squared - seen, 0) + squared * 1e-9)
        stay = np.flatnonzero(bound * SLACK >= max(q.floor, 1))
        if not len(stay):
            continue
        dense[q.terms] = q.weights
        width = starts[stay + 1] - starts[stay]
        ends = np.cumsum(width)
        entry = np.arange(ends[-1]) + np.repeat(starts[stay] - ends + width, width)
        total = np.concatenate(([0], np.cumsum(dense[terms[entry]] * impacts[entry])))
        scores = total[ends] - total[ends - width]
        dense[q.terms] = 0
        good = scores >= max(q.floor, 1)
        if good.any():
            q.offer(scores[good], ids[stay[good]], nulls[stay[good]])


def _search(queries: list[tuple[np.ndarray, np.ndarray]], floors: dict[int, int], size: int, top: int) -> Callable:
    """The best documents of a task's vectors for each query; ``floors`` are scores that ``top`` documents reach already."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here = [Query(t, w, floors.get(i, 0), top) for i, (t, w) in enumerate(queries)]
        dense = np.zeros(size, np.int64)
        for whole in batches:
            for batch in slices(whole, BUCKET):
                nulls = batch.column("doc_id").is_null().to_numpy(zero_copy_only=False)
                ids = batch.column("doc_id").fill_null(0).to_numpy(zero_copy_only=False)
                norms = batch.column("norm").to_numpy()
                width = np.array([len(t) for t in batch.column("terms")], dtype=np.int64)
                terms, impacts = (batch.column(c).flatten().to_numpy() for c in ("terms", "impacts"))
                order = np.argsort(-norms, kind="stable")
                if (order[1:] < order[:-1]).any():  # rows come in falling length; a bucket doesn't rely on it
                    starts = np.cumsum(width) - width
                    entry = np.concatenate([np.arange(starts[i], starts[i] + width[i]) for i in order])
                    nulls, ids, norms, width, terms, impacts = (
                        nulls[order], ids[order], norms[order], width[order], terms[entry], impacts[entry])
                starts = np.concatenate(([0], np.cumsum(width)))
                search_bucket(here, dense, ids, nulls, norms, starts, terms, impacts)
        found = [(i, None if z else int(d), int(s)) for i, q in enumerate(here) for s, d, z in zip(q.scores, q.ids, q.nulls)]
        number, doc, score = zip(*found) if found else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(number, pa.int32()), pa.array(doc, pa.int64()), pa.array(score, pa.int64())],
            names=["item", "doc_id", "score"],
        )

    return run


def _ranked(found: DataFrame, top: int) -> DataFrame:
    """The best ``top`` of each item; tasks keep only their best before the shuffle."""
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def _block_search(docs: DataFrame, block: list[tuple[Row, list[bytes]]], top: int) -> DataFrame:
    spark = docs.sparkSession
    vocabulary = {t: i for i, t in enumerate(dict.fromkeys(t for _, terms in block for t in terms))}
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    vectors = stage(texts.mapInArrow(_vectors(vocabulary), "doc_id long, n long, terms array<int>, counts array<long>, salt int"),
                    "search-counts")
    total = vectors.agg(F.count_if(F.col("n") > 0).alias("n"), F.coalesce(F.sum("n"), F.lit(0)).alias("l")).first()
    df = {r.term: r.df for r in vectors.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df")).collect()}
    weight = lambda t: math.floor(1000 * math.log((2 * total.n + 2) / (2 * df.get(vocabulary[t], 0) + 1)))
    queries = [(np.array([vocabulary[t] for t in terms]), np.array([weight(t) for t in terms], np.int64)) for _, terms in block]

    m = F.expr(f"10 + (90 * n * {total.n}L) div {max(total.l, 1)}L")
    impact = lambda tf: F.call_function("div", F.lit(1_000_000_000).cast("long") * tf, 1000 * tf + 8 * F.col("m"))
    impacts = (
        vectors.where(F.size("terms") > 0).withColumn("m", m)
        .select("doc_id", "salt", "terms", F.transform("counts", impact).alias("impacts"))
        .withColumn("norm", F.sqrt(F.aggregate("impacts", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))))
    )
    # the salt deals copies, which have one length, out over ranges
    ordered = stage(impacts.repartitionByRange(F.desc("norm"), "salt").sortWithinPartitions(F.desc("norm"), "salt").drop("salt"),
                    "search-vectors")
    cut = ordered.agg(F.percentile_approx("norm", 0.99).alias("cut")).first().cut
    schema = "item int, doc_id long, score long"
    longest = ordered.where(F.col("norm") >= F.lit(cut)).mapInArrow(_search(queries, {}, len(vocabulary), top), schema)
    longest = stage(_ranked(longest, top), "search-longest")
    floors = {r["item"]: r.score for r in longest.where(F.col("rank") == top).collect()}
    others = ordered.where(F.col("norm") < F.lit(cut)).mapInArrow(_search(queries, floors, len(vocabulary), top), schema)
    names = spark.createDataFrame([(i, row.item_id) for i, (row, _) in enumerate(block)], "item int, item_id long")
    best = _ranked(longest.drop("rank").unionByName(others), top)
    return best.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")


def lexical_search(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """``item_id, rank, doc_id, score``: each item's ``top`` highest-scoring documents with a score above 0.

    ``docs`` has ``doc_id`` (integers) and ``text``, ``items`` ``item_id`` and
    ``text``; other columns are ignored.  Statistics are counted over all
    documents.  Equal scores rank by ascending ``doc_id``, a null id last; rows
    that repeat an id are documents of their own, as are items.  A null or
    empty text has no terms; items without terms, and without any document
    that shares one, give no rows.  An empty table gives an empty result.

    Queries are taken in blocks (``BLOCK_ITEMS``, ``BLOCK_TERMS``), each held
    against all documents.  The longest hundredth of the vectors is searched
    first; the scores it reaches are where the other tasks start to prune.
    """
    spark = docs.sparkSession
    ready(spark)
    out = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for block in query_blocks(items):
        out = out.unionByName(stage(_block_search(docs, block, top), "search"))
    return out
