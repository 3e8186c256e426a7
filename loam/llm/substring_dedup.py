"""Passages that an earlier document holds too, by fixed-block anchors.

Every text is cut into non-overlapping reference blocks of seven words; a
window of 13 words holds one of them whole, wherever it starts.  All rolling
seven-word windows of the corpus are held against the blocks.  A hit is then
extended: the 13-word windows around it are compared over the corpus, and
their union is the maximal repeats.

Both comparisons are one exchange of hashes.  A task takes its documents in
batches of about a million words, sends each distinct hash of a batch once, to
the bucket that its value names, and the bucket answers the batches with
positions.  A passage held by a third of all documents therefore costs its
bucket one entry per batch, not one per document.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loam.llm.common import ready, slices, slot_of, slots, stage
from loam.llm.kernels import mix, prefix_sums, window_hashes, word_bounds

WINDOW = 13
#: Words per reference block: a window holds a whole block at whatever offset.
BLOCK = (WINDOW + 1) // 2
#: Words that a task hashes before it sends them, and hash entries that a bucket gets on average.
BATCH_WORDS, BUCKET_ENTRIES = 1 << 20, 1_500_000
#: Bytes of text hashed at once.
PIECE = 1 << 20
#: Rows of the broadcast prefilter of documents (one long each): a bound, not a cap on the data.
DOC_SLOTS = 1 << 19

_U = np.uint64
_NULL_ID = -(1 << 63)
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_SENT = "bucket long, uid long, one binary, two binary, three binary, four binary"
_FOUND = "doc_id long, digest binary, places binary"


def hashed_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, one after another, and where each text's words start (and the end)."""
    counts, hashes = np.zeros(len(texts) + 1, np.int64), [np.zeros(0, np.uint64)]
    group, members, size = [], [], 0

    def flush() -> None:
        data = np.frombuffer(b" ".join(group), dtype=np.uint8)
        starts, ends = word_bounds(data)
        if len(starts):
            hashes.append(window_hashes(prefix_sums(data), starts, ends))
        offsets = np.cumsum([0] + [len(g) + 1 for g in group])
        np.add.at(counts, np.array(members) + 1, np.diff(np.searchsorted(starts, offsets)))

    for i, text in enumerate(texts):
        at = 0
        while at < len(text):
            space = _SPACE.search(text, at + PIECE)
            end = space.start() if space else len(text)
            group.append(text[at:end])
            members.append(i)
            size += end - at
            at = end
            if size >= PIECE:
                flush()
                group, members, size = [], [], 0
    if group:
        flush()
    return np.concatenate(hashes), np.cumsum(counts)


def run_hashes(words: np.ndarray, at: np.ndarray | None, size: int) -> np.ndarray:
    """Hash of the ``size`` words from each place of ``at``; of every place that has so many after it, if None."""
    n = max(len(words) - size + 1, 0) if at is None else len(at)
    h = np.full(n, _U(size), dtype=np.uint64)
    for i in range(size):
        h = h * _U(0xD6E8FEB86659FD93) + (words[i : n + i] if at is None else words[at + i])
    return mix(h)


# ---------------------------------------------------------------------------
# packing
# ---------------------------------------------------------------------------
def planes(values: np.ndarray) -> bytes:
    """The bytes of an array, all first bytes before all second ones: sorted or small numbers then compress well."""
    return values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()


def unplanes(data: bytes, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.frombuffer(data, np.uint8).reshape(width, -1).T.copy().view(kind).ravel()


def _sent(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64(), pa.int64(), *[pa.binary()] * 4]
    columns = list(zip(*rows)) if rows else [[]] * 6
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["bucket", "uid", "one", "two", "three", "four"])


def bucket_of(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each key by ranges of its value, and the next 32 bits of the key's place within its bucket."""
    place = (keys >> _U(32)) * _U(buckets) + (((keys & _U(0xFFFFFFFF)) * _U(buckets)) >> _U(32))
    return (place >> _U(32)).astype(np.int64), (place & _U(0xFFFFFFFF)).astype(np.uint32)


def _groups(ordered_new: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start of each group, group of each row) from the flags of rows that open a group."""
    starts = np.flatnonzero(ordered_new)
    return starts, np.cumsum(ordered_new) - 1


# ---------------------------------------------------------------------------
# first exchange: rolling windows against reference blocks
# ---------------------------------------------------------------------------
def block_rows(batch: Batch, buckets: int) -> list[tuple]:
    words, starts = batch.words, batch.starts
    keys = run_hashes(words, None, BLOCK)
    place = np.arange(len(keys))
    doc = batch.doc_of(place)
    ok = place + BLOCK <= starts[doc + 1]
    keys, place, doc = keys[ok], place[ok], doc[ok]
    aligned = (place - starts[doc]) % BLOCK == 0
    order = np.argsort(keys, kind="stable")
    keys, place, aligned = keys[order], place[order].astype(np.uint32), aligned[order]
    first, group = _groups(np.concatenate(([True], keys[1:] != keys[:-1]))[: len(keys)])
    several = np.diff(np.append(first, len(keys))) > 1
    held = np.logical_or.reduceat(aligned, first) if len(first) else several
    settled = place[(several & held)[group]]
    linked = (several & ~held)[group]
    linked[first] = False
    links = np.stack([place[linked], place[first][group[linked]]])
    bucket, low = bucket_of(keys[first], buckets)
    flags = several.astype(np.uint8) + 2 * held.astype(np.uint8)
    rows = []
    for a, b in _runs(bucket):
        rows.append((int(bucket[a]), batch.uid, planes(low[a:b]), planes(place[first[a:b]]), flags[a:b].tobytes(), None))
    return [*rows, batch.own(settled, links)]


def block_judge(table: pa.Table) -> pa.Table:
    """Windows that occur more than once and at least once as a reference block: their places, by batch."""
    if table.column("bucket")[0].as_py() < 0:
        return _answers([], table)
    low = [unplanes(v.as_py(), np.uint32) for v in table.column("one")]
    place = [unplanes(v.as_py(), np.uint32) for v in table.column("two")]
    flags = np.concatenate([np.frombuffer(v.as_py(), np.uint8) for v in table.column("three")])
    row = np.repeat(np.arange(len(low), dtype=np.int32), [len(x) for x in low])
    keys = np.concatenate(low)
    order = np.argsort(keys, kind="stable")
    first, group = _groups(np.concatenate(([True], keys[order][1:] != keys[order][:-1])))
    times = np.add.reduceat((1 + (flags & 1)).astype(np.int64)[order], first)
    held = np.bitwise_or.reduceat(flags[order], first) & 2 > 0
    found = np.zeros(len(keys), bool)
    found[order] = ((times > 1) & held)[group]
    found &= flags != 3  # a batch knows these itself
    return _answers(_by_row(found, row, np.concatenate(place)), table)


# ---------------------------------------------------------------------------
# second exchange: the 13-word windows around the hits, and the least document that holds each
# ---------------------------------------------------------------------------
def window_rows(batch: Batch, buckets: int) -> list[tuple]:
    words, starts = batch.words, batch.starts
    edge = np.zeros(len(words) + 2, np.int64)
    for i, hits in enumerate(batch.hits):
        low = np.maximum(hits.astype(np.int64) - (WINDOW - BLOCK), 0)
        high = np.minimum(hits.astype(np.int64), starts[i + 1] - starts[i] - WINDOW)
        ok = low <= high
        np.add.at(edge, starts[i] + low[ok], 1)
        np.add.at(edge, starts[i] + high[ok] + 1, -1)
    place = np.flatnonzero(np.cumsum(edge) > 0)
    keys = run_hashes(words, place, WINDOW)
    more = run_hashes(mix(words ^ _U(0x9E3779B97F4A7C15)), place, WINDOW).astype(np.uint32)
    ids = batch.ids[batch.doc_of(place)]
    order = np.lexsort((ids, more, keys))
    keys, more, ids, place = keys[order], more[order], ids[order], place[order].astype(np.uint32)
    first, group = _groups(np.concatenate(([True], (keys[1:] != keys[:-1]) | (more[1:] != more[:-1])))[: len(keys)])
    same = ids == ids[first][group]
    settled = place[~same]
    same[first] = False
    links = np.stack([place[same], place[first][group[same]]])
    bucket, _ = bucket_of(keys[first], buckets)
    rows = []
    for a, b in _runs(bucket):
        at = first[a:b]
        rows.append((int(bucket[a]), batch.uid, planes(keys[at]), planes(place[at]), planes(ids[at]), planes(more[at])))
    return [*rows, batch.own(settled, links)]


def window_judge(table: pa.Table) -> pa.Table:
    """Windows that a smaller document holds too: their places, by batch."""
    if table.column("bucket")[0].as_py() < 0:
        return _answers([], table)
    one, place, ids, more = ([unplanes(v.as_py(), kind) for v in table.column(c)]
                             for c, kind in (("one", np.uint64), ("two", np.uint32), ("three", np.int64), ("four", np.uint32)))
    row = np.repeat(np.arange(len(one), dtype=np.int32), [len(x) for x in one])
    keys, ids, more = np.concatenate(one), np.concatenate(ids), np.concatenate(more)
    order = np.lexsort((ids, more, keys))
    k, m = keys[order], more[order]
    first, group = _groups(np.concatenate(([True], (k[1:] != k[:-1]) | (m[1:] != m[:-1]))))
    found = np.zeros(len(keys), bool)
    found[order] = ids[order] > ids[order][first][group]
    return _answers(_by_row(found, row, np.concatenate(place)), table)


# ---------------------------------------------------------------------------
# the exchange
# ---------------------------------------------------------------------------
class Batch:
    """Documents that a task sends together."""

    def __init__(self, rows: list[tuple]):
        self.words, self.starts = hashed_words([r[2] or b"" for r in rows])
        self.ids = np.array([_NULL_ID if r[0] is None else r[0] for r in rows], np.int64)
        self.known = np.array([r[0] is not None for r in rows], bool)
        self.digests = b"".join(r[1] for r in rows)
        self.hits = [np.frombuffer(r[3], np.uint32) for r in rows] if len(rows[0]) > 3 else []
        name = hashlib.blake2b(self.ids.tobytes() + self.known.tobytes() + self.digests, digest_size=8).digest()
        self.uid = int.from_bytes(name, "big") >> 1

    def doc_of(self, place: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, place, side="right") - 1

    def own(self, settled: np.ndarray, links: np.ndarray) -> tuple:
        """The row that the batch keeps for itself: its documents, places settled already and places that follow another's."""
        docs = np.concatenate([self.ids, self.known.astype(np.int64), self.starts])
        return (-1 - self.uid, self.uid, docs.tobytes(), self.digests, planes(np.sort(settled).astype(np.uint32)),
                planes(links.astype(np.uint32).ravel()))


def _runs(bucket: np.ndarray) -> Iterator[tuple[int, int]]:
    edges = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1], [True])))
    yield from zip(edges[:-1], edges[1:]) if len(bucket) else ()


def _by_row(found: np.ndarray, row: np.ndarray, place: np.ndarray) -> list[tuple[int, bytes]]:
    rows, places = row[found], place[found]
    return [(int(rows[a]), planes(places[a:b])) for a, b in _runs(rows)]


def _answers(found: list[tuple[int, bytes]], table: pa.Table) -> pa.Table:
    """Places per batch; a batch's own row passes as it is."""
    if table.column("bucket")[0].as_py() < 0:
        return table
    uids = table.column("uid").to_pylist()
    return pa.Table.from_batches([_sent([(0, uids[r], places, None, None, None) for r, places in found])])


def resolve(table: pa.Table) -> pa.Table:
    """A batch's own row and the answers to it -> the places of each of its documents that has any."""
    own = [r for r in table.to_pylist() if r["bucket"] < 0]
    if not own:
        raise ValueError("answers for a batch that no longer exists: its documents were read in another order")
    docs = np.frombuffer(own[0]["one"], np.int64)
    n = (len(docs) - 1) // 3
    ids, known, starts = docs[:n], docs[n : 2 * n], docs[2 * n :]
    answers = [unplanes(v.as_py(), np.uint32) for v, b in zip(table.column("one"), table.column("bucket")) if b.as_py() >= 0]
    links = unplanes(own[0]["four"], np.uint32).reshape(2, -1)
    answered = np.concatenate([np.zeros(0, np.uint32), *answers])
    places = np.unique(np.concatenate([answered, unplanes(own[0]["three"], np.uint32), links[0][np.isin(links[1], answered)]]))
    out = []
    edges = np.searchsorted(places, starts)
    for i in np.flatnonzero(np.diff(edges)):
        at = places[edges[i] : edges[i + 1]] - np.uint32(starts[i])
        out.append((int(ids[i]) if known[i] else None, own[0]["two"][16 * i : 16 * i + 16], at.tobytes()))
    columns = list(zip(*out)) if out else [[]] * 3
    return pa.table([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.binary(), pa.binary()))], names=["doc_id", "digest", "places"])


def exchange(texts: DataFrame, rows_of: Callable, judge: Callable, buckets: int) -> DataFrame:
    """``doc_id, digest, places`` of the documents with places that a bucket found (see the module's head).

    ``texts`` has ``doc_id, digest, text`` and, for the second exchange, ``places``.
    """

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for whole in batches:
            for batch in slices(whole):
                held.extend(zip(*[batch.column(c).to_pylist() for c in batch.schema.names]))
                size += batch.column("text").nbytes
                if size >= 6 * BATCH_WORDS:
                    yield _sent(rows_of(Batch(held), buckets))
                    held, size = [], 0
        if held:
            yield _sent(rows_of(Batch(held), buckets))

    sent = texts.withColumn("text", F.col("text").cast("binary")).mapInArrow(send, _SENT)
    answered = sent.groupBy("bucket").applyInArrow(judge, _SENT)
    return answered.groupBy("uid").applyInArrow(resolve, _FOUND)


# ---------------------------------------------------------------------------
# documents
# ---------------------------------------------------------------------------
def _removed(texts: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole):
                out = []
                for doc, text, places in zip(*[batch.column(c).to_pylist() for c in ("doc_id", "text", "places")]):
                    words = (text or b"").split()
                    kept = words
                    if places is not None:
                        edge = np.zeros(len(words) + 1, np.int64)
                        starts = np.frombuffer(places, np.uint32).astype(np.int64)
                        edge[starts] += 1
                        np.subtract.at(edge, starts + WINDOW, 1)
                        kept = [w for w, c in zip(words, np.cumsum(edge)) if not c]
                    left = b" ".join(kept)
                    row = (doc, len(words), len(words) - len(kept), hashlib.sha256(left).hexdigest())
                    out.append((*row, left.decode("utf-8", "replace")) if texts else row)
                types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()][: 5 if texts else 4]
                names = ["doc_id", "n_words", "n_removed", "kept_sha256", "text"][: len(types)]
                columns = list(zip(*out)) if out else [[]] * len(types)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    return run


def _with_places(docs: DataFrame, found: DataFrame, how: str) -> DataFrame:
    """``docs`` with the ``places`` of their id and digest; texts that a prefilter rules out are not shuffled."""
    key = ["doc_id", "digest"]
    near = slots(found, *key, n=DOC_SLOTS).withColumn("hit", F.lit(True))
    marked = docs.withColumn("_slot", slot_of(*key, n=DOC_SLOTS)).join(near, "_slot", "left")
    right = found.withColumnRenamed("doc_id", "id2").withColumnRenamed("digest", "digest2")
    joined = marked.where("hit").join(right, F.col("doc_id").eqNullSafe(F.col("id2")) & (F.col("digest") == F.col("digest2")), how)
    joined = joined.select(*key, "text", "places")
    if how == "inner":
        return joined
    return marked.where("hit is null").select(*key, "text", F.lit(None).cast("binary").alias("places")).unionByName(joined)


def substring_dedup(docs: DataFrame, texts: bool = False) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` (and ``text``, the kept words, with ``texts``) of every row.

    ``docs`` has ``doc_id`` (integers) and ``text``; other columns are ignored.
    A word goes when a window of 13 words around it also starts in a document
    of smaller id, both as they stand in the input.  A null id counts as
    smaller than any other; rows of one id (null ids too) take nothing from
    one another, and repeated rows all come out.  Null, empty and texts of
    fewer than 13 words lose nothing.  An empty table gives an empty result.

    Windows are compared by 96 bits of hash.  Memory of a task: a batch, or
    the words of one document if that is longer.
    """
    spark = docs.sparkSession
    ready(spark)
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.unhex(F.md5(F.coalesce(F.col("text"), F.lit("")))).alias("digest"), "text")
    words = (base.agg(F.sum(F.octet_length("text")).alias("n")).first().n or 0) // 6
    hits = stage(exchange(base, block_rows, block_judge, 1 + words // BUCKET_ENTRIES).dropDuplicates(["doc_id", "digest"]), "blocks")
    around = (hits.agg(F.sum(F.octet_length("places")).alias("n")).first().n or 0) // 4 * BLOCK
    hit_texts = _with_places(base, hits, "inner")
    covered = stage(exchange(hit_texts, window_rows, window_judge, 1 + min(words, around) // BUCKET_ENTRIES)
                    .dropDuplicates(["doc_id", "digest"]), "windows")
    final = _with_places(base, covered, "left").withColumn("text", F.col("text").cast("binary"))
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" + (", text string" if texts else "")
    return final.mapInArrow(_removed(texts), schema)
