"""Quality classifier: random-indexing word vectors pooled per document, a two-layer network, calibrated temperature."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loam.llm.common import labelled_rows, ready
from loam.llm.kernels import mix, prefix_sums, window_hashes, word_bounds

#: Vocabulary places: words are hashed to a fixed table, word ends (last three bytes) to another.
WORD_PLACES, END_PLACES = 1 << 15, 1 << 13
DIM = 32
#: Non-zero entries of an index vector, and words to each side that count as context.
ENTRIES, REACH = 4, 2
#: Bound of the labelled sample that the network is fitted on (documents of least hash of id and text).
MAX_LABELLED = 20_000
HIDDEN = 32
#: Places per row of the summed table.
BLOCK = 1024

_U = np.uint64
PLACES = WORD_PLACES + END_PLACES


def word_places(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash of each word, its place in the word table, its end's place in the end table)."""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
    starts, ends = word_bounds(data)
    if not len(starts):
        none = np.zeros(0, np.int64)
        return np.zeros(0, _U), none, none
    sums = prefix_sums(data)
    word = window_hashes(sums, starts, ends)
    end = window_hashes(sums, np.maximum(starts, ends - 3), ends)
    return word, (word % _U(WORD_PLACES)).astype(np.int64), WORD_PLACES + (end % _U(END_PLACES)).astype(np.int64)


def index_entries(word: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Columns and signs of each word's sparse random index vector, drawn from the word's own hash."""
    r = mix(word * _U(0x9E3779B97F4A7C15))
    columns = [((r >> _U(8 * k)) % _U(DIM)).astype(np.int64) for k in range(ENTRIES)]
    signs = [1.0 - 2.0 * ((r >> _U(40 + k)) & _U(1)).astype(np.float64) for k in range(ENTRIES)]
    return columns, signs


def add_contexts(table: np.ndarray, texts: list[str]) -> None:
    """Add each word's neighbours' index vectors to the word's place and its end's; column DIM counts words."""
    hashes, words, ends, owner = [], [], [], []
    for i, text in enumerate(texts):
        h, w, e = word_places(text or "")
        hashes.append(h)
        words.append(w)
        ends.append(e)
        owner.append(np.full(len(w), i))
    words, ends, owner = np.concatenate(words), np.concatenate(ends), np.concatenate(owner)
    if not len(words):
        return
    columns, signs = index_entries(np.concatenate(hashes))
    flat = np.zeros(PLACES * DIM)
    for reach in range(1, REACH + 1):
        here = np.flatnonzero(owner[reach:] == owner[:-reach])
        for target, neighbour in ((here, here + reach), (here + reach, here)):
            for k in range(ENTRIES):
                column, sign = columns[k][neighbour], signs[k][neighbour]
                for place in (words, ends):
                    flat += np.bincount(place[target] * DIM + column, weights=sign, minlength=PLACES * DIM)
    table[:, :DIM] += np.rint(flat).astype(np.int64).reshape(PLACES, DIM)
    table[:, DIM] += np.bincount(words, minlength=PLACES) + np.bincount(ends, minlength=PLACES)


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One summed table per task, in blocks."""
    table, rows, held, size = np.zeros((PLACES, DIM + 1), np.int64), 0, [], 0
    for batch in batches:
        for text in batch.column("text").to_pylist():
            rows += 1
            held.append(text)
            size += len(text or "")
            if size > 4_000_000:
                add_contexts(table, held)
                held, size = [], 0
    if held:
        add_contexts(table, held)
    if rows:
        for block in range(0, PLACES, BLOCK):
            part = table[block : block + BLOCK]
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([part.tobytes()], pa.binary())], names=["block", "part"])


def _sum_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, part in zip(batch.column("block").to_pylist(), batch.column("part")):
            x = np.frombuffer(part.as_buffer(), np.int64)
            sums[block] = sums[block] + x if block in sums else x
    for block, x in sorted(sums.items()):
        yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([x.tobytes()], pa.binary())], names=["block", "part"])


def word_vectors(docs: DataFrame) -> np.ndarray:
    """Unit context vectors (PLACES x DIM) of all words of ``docs`` (``text``), summed over the whole corpus.

    Each task sums its own rows into one table of fixed size; tables are added
    up by block in parallel.  The result, ``PLACES * DIM`` numbers whatever
    the corpus, comes to the driver.
    """
    summed = (
        docs.select("text")
        .mapInArrow(_contexts, "block int, part binary")
        .repartition("block")
        .mapInArrow(_sum_blocks, "block int, part binary")
    )
    table = np.zeros((PLACES, DIM + 1), np.float64)
    for row in summed.toLocalIterator():
        part = np.frombuffer(row.part, np.int64).reshape(-1, DIM + 1)
        table[row.block : row.block + len(part)] = part
    mean = table[:, :DIM] / np.maximum(1, table[:, DIM:])
    for part in (slice(0, WORD_PLACES), slice(WORD_PLACES, PLACES)):
        n = table[part, DIM:]
        mean[part] -= (mean[part] * n).sum(0) / max(1, n.sum())  # frequent neighbours say little
    mean[table[:, DIM] == 0] = 0
    return (mean / np.maximum(1e-9, np.linalg.norm(mean, axis=1, keepdims=True))).astype(np.float32)


def pooled(vectors: np.ndarray, text: str) -> np.ndarray:
    """Means and spreads of a document's word and end vectors, how far neighbours lie apart, its mean index vector and length."""
    hashes, words, ends = word_places(text or "")
    if not len(words):
        return np.zeros(6 * DIM + 1, np.float32)
    columns, signs = index_entries(hashes)
    own = sum(np.bincount(c, weights=s, minlength=DIM) for c, s in zip(columns, signs)) / len(words)
    w, e = vectors[words], vectors[ends]
    apart = np.abs(w[1:] - w[:-1]).mean(0) if len(w) > 1 else w.std(0)
    length = [np.log(len(words))]
    return np.concatenate((w.mean(0), w.std(0), e.mean(0), e.std(0), apart, own, length)).astype(np.float32)


def _pool(vectors):
    def pool(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [pooled(vectors.value, t).tobytes() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc"), batch.column("label"), pa.array(rows, pa.binary())], names=["doc", "label", "x"])

    return pool


@dataclass
class Network:
    """Two layers and a temperature, on standardised inputs."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.mean) / self.scale @ self.w1 + self.b1) @ self.w2 + self.b2

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(x) / self.temperature, -30, 30)))


def fit_network(x: np.ndarray, y: np.ndarray, held: np.ndarray, epochs: int = 40, seed: int = 11) -> Network:
    """Adam on the rows that aren't held, then the temperature of least loss on the held ones."""
    r = np.random.default_rng(seed)
    fit_x, fit_y = x[~held].astype(np.float64), y[~held].astype(np.float64)
    mean, scale = fit_x.mean(0), fit_x.std(0) + 1e-3
    z = (fit_x - mean) / scale
    params = [r.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], HIDDEN)), np.zeros(HIDDEN), r.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), np.zeros(1)]
    m, v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    t, batch = 0, 128
    for epoch in range(epochs):
        rate = 0.01 * 0.92**epoch
        order = r.permutation(len(z))
        for i in range(0, len(z), batch):
            a, target = z[order[i : i + batch]], fit_y[order[i : i + batch]]
            hidden = np.tanh(a @ params[0] + params[1])
            error = (1 / (1 + np.exp(-np.clip(hidden @ params[2] + params[3], -30, 30))) - target) / len(a)
            back = np.outer(error, params[2]) * (1 - hidden * hidden)
            grads = [a.T @ back + 1e-3 * params[0], back.sum(0), hidden.T @ error + 1e-3 * params[2], error.sum(keepdims=True)]
            t += 1
            for p, g, mm, vv in zip(params, grads, m, v):
                mm += 0.1 * (g - mm)
                vv += 0.001 * (g * g - vv)
                p -= rate * (mm / (1 - 0.9**t)) / (np.sqrt(vv / (1 - 0.999**t)) + 1e-8)
    net = Network(mean, scale, params[0], params[1], params[2], float(params[3][0]), 1.0)
    logits, target = net.logit(x[held]), y[held]
    def loss(t: float) -> float:
        return float(np.mean(np.logaddexp(0, np.where(target == 1, -logits, logits) / t)))
    net.temperature = float(min(np.geomspace(0.25, 8, 60), key=loss)) if held.any() else 1.0
    return net


def train(docs: DataFrame, labels: DataFrame, vectors, max_labelled: int) -> Network | float:
    """The network, or one probability when the labels it may see hold one class at most."""
    learnt = labels.where(F.pmod(F.crc32(F.col("doc").cast("string")), F.lit(3)) != 1)
    rows = (
        labelled_rows(docs, learnt, max_labelled, seed=3)
        .mapInArrow(_pool(vectors), f"doc {docs.schema['doc'].dataType.simpleString()}, label int, x binary")
        .toPandas()
        .sort_values(["doc", "x"])
    )
    y = rows.label.to_numpy(np.int64)
    if len(np.unique(y)) < 2:
        return 0.5 if not len(y) else float(y[0])
    x = np.stack([np.frombuffer(b, np.float32) for b in rows.x])
    held = np.random.default_rng(5).random(len(y)) < 0.2
    if len(np.unique(y[~held])) < 2:
        held[:] = False
    return fit_network(x, y, held)


def _score(vectors, model):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [pooled(vectors.value, t) for t in batch.column("text").to_pylist()]
            p = np.full(len(x), model) if isinstance(model, float) else model.probability(np.stack(x)) if x else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(p, pa.float64())], names=["doc", "score"])

    return score


def quality_classifier(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    max_labelled: int = MAX_LABELLED,
) -> DataFrame:
    """Probability that a document's label is 1, for every document.

    Returns ``id_col, held_out, score, predicted``.  Word vectors are summed
    over all documents (see :func:`word_vectors`); labels are learnt only from
    rows with ``crc32(id as text) % 3 != 1``, at most ``max_labelled`` of them;
    ``held_out`` marks the others.  A score depends on the text alone.

    Two scans read all texts, two look for the labelled ones; vectors travel as one
    broadcast of fixed size, documents are never shuffled.

    Edge cases: null and empty texts get the network's value of an all-zero
    vector; without labels of both classes the score is the one label (0.5
    without any); a null id is not held out; rows are scored one by one, so
    repeated rows repeat; an empty table gives an empty result; other columns
    are ignored.
    """
    ready(docs.sparkSession)
    base = docs.select(docs[id_col].alias("doc"), docs[text_col].alias("text"))
    vectors = docs.sparkSession.sparkContext.broadcast(word_vectors(base))
    known = labels.select(labels[id_col].alias("doc"), labels[label_col].cast("int").alias("label"))
    model = train(base, known, vectors, max_labelled)
    scored = base.mapInArrow(_score(vectors, model), f"doc {docs.schema[id_col].dataType.simpleString()}, score double")
    held = F.coalesce(F.pmod(F.crc32(F.col("doc").cast("string")), F.lit(3)) == 1, F.lit(False))
    return scored.select(
        F.col("doc").alias(id_col),
        held.alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).cast("int").alias("predicted"),
    )
