"""Quality rules: fixed base rules and a calibrated n-gram classifier, scored in Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loam.llm.common import labelled_rows, ready
from loam.llm.kernels import mix, powers, prefix_sums, window_hashes, word_bounds

#: Fixed base rules.
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: Documents with a calibrated probability of good quality below this go.
KEEP_AT = 0.5
#: Bound of the labelled sample that is fitted (documents of least hash of id and text), a documented parameter.
MAX_LABELLED = 4000
#: Hash places of word and of character n-grams.
WORD_PLACES, CHAR_PLACES = 1 << 11, 1 << 11

SYMBOLS = b"#*$%&|<>"
_IS_SYMBOL = np.isin(np.arange(256), np.frombuffer(SYMBOLS, np.uint8))
_U = np.uint64
_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass
class Parsed:
    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    words: np.ndarray
    sums: np.ndarray


def parse(text: str) -> Parsed:
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
    starts, ends = word_bounds(data)
    sums = prefix_sums(data)
    words = window_hashes(sums, starts, ends) if len(starts) else np.zeros(0, _U)
    return Parsed(data, starts, ends, words, sums)


def _windows(words: np.ndarray, size: int) -> np.ndarray:
    h = np.zeros(max(0, len(words) - size + 1), dtype=_U)
    for i in range(size):
        h = h * _U(0xD6E8FEB86659FD93) + words[i : i + len(h)]
    return mix(h)


def base_counts(text: str, p: Parsed) -> tuple[int, int, int, int, int]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) of one text."""
    edge = np.zeros(len(p.data) + 1, dtype=np.int8)
    edge[p.starts] += 1
    edge[p.ends] -= 1
    in_word = np.cumsum(edge[:-1]).astype(bool)
    word_chars = int(np.count_nonzero(in_word & ((p.data & 0xC0) != 0x80)))
    seen, dup = set(), 0
    for line in text.split("\n"):
        if line in seen:
            dup += 1
        elif line.strip("\t\n\x0b\x0c\r "):
            seen.add(line)
    repeat = 0
    if len(p.words) >= 3:
        _, inverse, count = np.unique(_windows(p.words, 3), return_inverse=True, return_counts=True)
        twice = np.flatnonzero(count[inverse] > 1)
        covered = np.zeros(len(p.words), dtype=bool)
        for i in range(3):
            covered[twice + i] = True
        repeat = int(covered.sum())
    return len(p.words), word_chars, int(_IS_SYMBOL[p.data].sum()), dup, repeat


def features(p: Parsed, counts: tuple[int, ...]) -> np.ndarray:
    """Unit-length hashed word (1 and 2) and character (3 and 4 bytes) n-gram vectors, and the base counts' shares."""
    n_words, word_chars, n_symbols, _, repeat = counts
    grams = np.concatenate((p.words, _windows(p.words, 2)))
    parts = [np.bincount((grams % _U(WORD_PLACES)).astype(np.int64), minlength=WORD_PLACES)]
    char = np.zeros(CHAR_PLACES)
    inverse = powers(len(p.sums))[1]
    for n in (3, 4):
        if len(p.data) >= n:
            h = mix(((p.sums[n:] - p.sums[:-n]) * inverse[: len(p.sums) - n]) + _U(n))
            char += np.bincount((h % _U(CHAR_PLACES)).astype(np.int64), minlength=CHAR_PLACES)
    parts.append(char)
    parts = [np.sqrt(x) / max(1.0, np.sqrt(x.sum())) for x in parts]
    upper = np.count_nonzero((p.data >= 65) & (p.data <= 90))
    share = np.array([n_symbols / max(1, len(p.data)), upper / max(1, len(p.data)), repeat / max(1, n_words)])
    parts.append(np.minimum(1.0, 3 * share))
    return np.concatenate(parts).astype(np.float32)


def _labelled_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for text in batch.column("text").to_pylist():
            p = parse(text)
            rows.append(features(p, base_counts(text, p)).astype(np.float16).tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary()), batch.column("label"), batch.column("fold")], names=["x", "label", "fold"])


@dataclass
class Model:
    """Logistic regression with Platt calibration; ``probability`` is of good quality."""

    weights: np.ndarray
    bias: float
    slope: float
    offset: float

    def probability(self, x: np.ndarray) -> np.ndarray:
        margin = self.slope * (x @ self.weights + self.bias) + self.offset
        return 1 / (1 + np.exp(-np.clip(margin, -30, 30)))


def fit_logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1e-4, steps: int = 250, rate: float = 0.5) -> tuple[np.ndarray, float]:
    """Weights and bias by Adam on the whole matrix; classes count alike."""
    share = np.where(y == 1, 0.5 / max(1, y.sum()), 0.5 / max(1, (1 - y).sum())).astype(np.float32)
    w, b = np.zeros(x.shape[1], np.float32), 0.0
    m, v = np.zeros(x.shape[1] + 1), np.zeros(x.shape[1] + 1)
    for t in range(1, steps + 1):
        error = (1 / (1 + np.exp(-np.clip(x @ w + b, -30, 30))) - y) * share
        g = np.append(x.T @ error.astype(np.float32) + penalty * w, error.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        step = rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        w, b = (w - step[:-1]).astype(np.float32), b - step[-1]
        rate *= 0.99
    return w, float(b)


def vectors_of(packed: pa.BinaryArray) -> np.ndarray:
    """Rows of 16-bit floats, as they lie in ``packed`` (no nulls, all of one length)."""
    held = np.frombuffer(packed.buffers()[1], np.int32)[packed.offset : packed.offset + len(packed) + 1]
    return np.frombuffer(packed.buffers()[2], np.uint8)[held[0] : held[-1]].view(np.float16).reshape(len(packed), -1)


def train(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> Model | None:
    """Fit on at most ``max_labelled`` labelled documents; None when a class is missing.

    ``docs`` has ``doc, text``; ``labels`` has ``doc, label``.  A fifth of the
    rows (by hash) is kept for the calibration.
    """
    rows = (
        labelled_rows(docs.where("text is not null"), labels, max_labelled, seed=7)
        .withColumn("fold", F.pmod(F.xxhash64("doc"), F.lit(1000)))
        .mapInArrow(_labelled_features, "x binary, label int, fold long")
        .toArrow()
        .combine_chunks()
    )
    # the vectors stay 16-bit and in one block until a part of them is fitted: the driver holds them once
    rows = rows.sort_by([("fold", "ascending"), ("x", "ascending")])
    y, fold = rows.column("label").to_numpy().astype(np.float32), rows.column("fold").to_numpy() % 5
    if len(np.unique(y)) < 2:
        return None
    x = vectors_of(rows.column("x").combine_chunks())
    del rows
    fitted = fold != 0
    if len(np.unique(y[fitted])) < 2 or len(np.unique(y[~fitted])) < 2:
        fitted = np.ones(len(y), bool)
        held = fitted
    else:
        held = ~fitted
    w, b = fit_logistic(x[fitted].astype(np.float32), y[fitted])
    # Platt scaling on the held rows as they are, with smoothed targets
    z = x[held].astype(np.float32) @ w + b
    good = y[held].sum()
    target = np.where(y[held] == 1, (good + 1) / (good + 2), 1 / (held.sum() - good + 2))
    slope, offset = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(slope * z + offset, -30, 30)))
        d, h = p - target, p * (1 - p) + 1e-6
        grad = np.array([(d * z).sum() + 1e-3 * (slope - 1), d.sum()])
        hess = np.array([[(h * z * z).sum() + 1e-3, (h * z).sum()], [(h * z).sum(), h.sum() + 1e-6]])
        move = np.linalg.solve(hess, grad)
        slope, offset = max(1e-3, slope - np.clip(move[0], -0.5, 0.5)), offset - np.clip(move[1], -2, 2)
    return Model(w, b, float(slope), float(offset))


def _score(model: Model | None, min_words: int, max_repeat: int, keep_at: float):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, failed, probability = [], [], []
            for text in batch.column("text").to_pylist():
                text = text or ""
                p = parse(text)
                counts = base_counts(text, p)
                found.append(counts)
                failed.append(counts[0] < min_words or 100 * counts[4] > max_repeat * counts[0])
                probability.append(1.0 if model is None else float(model.probability(features(p, counts))))
            columns = [pa.array([c[i] for c in found], pa.int64()) for i in range(len(_COUNTS))]
            kept = [not f and q >= keep_at for f, q in zip(failed, probability)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), *columns, pa.array(failed, pa.bool_()), pa.array(probability, pa.float64()), pa.array(kept, pa.bool_())],
                names=["doc", *_COUNTS, "base_failed", "probability", "kept"],
            )

    return score


def quality_rules(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    min_words: int = MIN_WORDS,
    max_repeat_percent: int = MAX_REPEAT_PERCENT,
    keep_at: float = KEEP_AT,
    max_labelled: int = MAX_LABELLED,
    train_docs: DataFrame | None = None,
) -> DataFrame:
    """Base counts, base rules and the classifier's verdict for every document.

    Returns ``id_col, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, probability, kept``.  ``kept`` is false where
    a base rule fails, else whether the calibrated probability of good quality
    reaches ``keep_at``.  The labelled documents are looked up in
    ``train_docs`` (``docs`` by default).

    Two scans fit the model on a bounded labelled sample (vectors of 16-bit
    floats come to the driver, the documents don't), one scan scores; nothing
    is shuffled but the labels' least hashes and the texts of the sample.  Each text is read whole, in
    Arrow batches.

    Edge cases: a null text has no words and fails; with labels of one class
    only, or none, the base rules decide alone (probability 1); rows are judged
    one by one, so repeated rows repeat and null ids stay; an empty table gives
    an empty result; other columns are ignored.
    """
    ready(docs.sparkSession)
    source = docs if train_docs is None else train_docs
    model = train(
        source.select(source[id_col].alias("doc"), source[text_col].alias("text")),
        labels.select(labels[id_col].alias("doc"), labels[label_col].cast("int").alias("label")),
        max_labelled,
    )
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"doc {kind}, {', '.join(f'{c} long' for c in _COUNTS)}, base_failed boolean, probability double, kept boolean"
    return (
        docs.select(docs[id_col].alias("doc"), docs[text_col].alias("text"))
        .mapInArrow(_score(model, min_words, max_repeat_percent, keep_at), schema)
        .withColumnRenamed("doc", id_col)
    )


def _kept_rows(model, columns, text_at, min_words, max_repeat, keep_at):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            mask = []
            for text in batch.column(text_at).to_pylist():
                text = text or ""
                p = parse(text)
                c = base_counts(text, p)
                bad = c[0] < min_words or 100 * c[4] > max_repeat * c[0]
                mask.append(not bad and (model is None or float(model.probability(features(p, c))) >= keep_at))
            yield batch.filter(pa.array(mask, pa.bool_()))

    return rows


def keep_quality(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    train_docs: DataFrame | None = None,
) -> DataFrame:
    """``docs`` without the rows that :func:`quality_rules` (as by default) rejects; all columns kept, one pass."""
    ready(docs.sparkSession)
    source = docs if train_docs is None else train_docs
    model = train(
        source.select(source[id_col].alias("doc"), source[text_col].alias("text")),
        labels.select(labels[id_col].alias("doc"), labels[label_col].cast("int").alias("label")),
    )
    at = docs.columns.index(text_col)
    return docs.mapInArrow(_kept_rows(model, docs.columns, at, MIN_WORDS, MAX_REPEAT_PERCENT, KEEP_AT), docs.schema)
