"""Repeated byte strings over a whole corpus, by prefix-free parsing.

Rolling-hash triggers parse every text into phrases, the phrases of the whole
corpus form a dictionary, and the sorted dictionary and the sorted parse give
the part of the corpus's suffix order that the question needs: which starts
share their first ``length`` bytes, and which of them comes first.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loam.llm.common import ready, slot_of, slots, stage
from loam.llm.kernels import OTHER_VALUES, mix, powers, prefix_sums, window_hashes

#: Rows of the broadcast prefilter of documents (one long each): a bound, not a cap on the data.
DOC_SLOTS = 1 << 19
#: Bytes hashed at a trigger.
GRAM = 40

_NULL_ID = -(1 << 63)
_PARSE = "id long, h long, place long, phrase long, trigger int, cores long"


def trigger_groups(s: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Parse one text: (first start, last start, trigger, trigger's hash) of each phrase.

    The trigger of a window of ``length`` bytes is its ``gram``-byte string of
    least rolling hash, leftmost when equal; so equal windows have it at the
    same place, and neighbouring windows with one trigger form a phrase.
    """
    n = len(s) - 1
    h = mix((s[gram:] - s[:-gram]) * powers(n + 1)[1][: n - gram + 1])
    # low 7 bits: offset of the least hash from the window's start
    low = (h >> np.uint64(7)) << np.uint64(7)
    width, wanted = 1, length - gram + 1
    while 2 * width <= wanted:
        low = np.minimum(low[:-width], low[width:] + np.uint64(width))
        width *= 2
    if width < wanted:
        low = np.minimum(low[: len(low) - (wanted - width)], low[wanted - width :] + np.uint64(wanted - width))
    at = np.arange(len(low)) + (low & np.uint64(127)).astype(np.int64)
    first = np.concatenate(([0], np.flatnonzero(np.diff(at)) + 1))
    last = np.concatenate((first[1:] - 1, [len(at) - 1]))
    return first, last, at[first], h[at[first]]


#: A place packs, from high to low: a position, 7 bits of the trigger's offset, 7 of the number of starts; so rows stay
#: slim.  A document is an id and the hash ``h`` of its text; documents sort by both, starts of one by place.
_POS, _OFF, _RUN = 14, 7, 0


def _pos_of(place):
    return F.shiftright(place, _POS)


def _bits(place, low: int):
    return F.shiftright(place, low).bitwiseAND(F.lit(127)).cast("int")


def _repeats_in_batch(keys: np.ndarray, ids: np.ndarray, hashes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Rows that some earlier row of the same key in this batch precedes (map-side combine)."""
    order = np.lexsort((at, hashes, ids, keys))
    k, i, h, a = keys[order], ids[order], hashes[order], at[order]
    new = np.concatenate(([True], k[1:] != k[:-1]))
    head = np.flatnonzero(new)[np.cumsum(new) - 1]
    later = np.zeros(len(keys), dtype=bool)
    later[order] = (i != i[head]) | (h != h[head]) | (a != a[head])
    return later


def _as_int64(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64) if x.dtype == np.uint64 else x.astype(np.int64)


def _parse(length: int, gram: int):
    half = (length - gram) // 2

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Phrases of each text; those that repeat inside the batch come out as ready runs (no starts in the place, their number as phrase)."""
        for batch in batches:
            parts = []
            for i, h, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                data = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
                if len(data) < length:
                    continue
                s = prefix_sums(data)
                first, last, at, th = trigger_groups(s, length, gram)
                phrase = window_hashes(s, first, last + length) + (at - first).astype(np.uint64) * np.uint64(0xA24BAED4963EE407)
                before, after = at - first >= half, at - last <= half
                left = window_hashes(s, np.maximum(at - half, 0), at + gram) >> np.uint64(33)
                right = window_hashes(s, at, np.minimum(at + gram + half, len(data))) >> np.uint64(33)
                cores = (left + np.uint64(1)) * before.astype(np.uint64) << np.uint64(32) | (right + np.uint64(1)) * after.astype(np.uint64)
                place = (first << _POS) + ((at - first) << _OFF) + (last - first + 1)
                parts.append((np.full(len(first), i), np.full(len(first), h), place, phrase, th >> np.uint64(32), cores))
            if not parts:
                continue
            ids, hashes, place, phrase, trigger, cores = (np.concatenate(x) for x in zip(*parts))
            trigger = trigger.astype(np.uint32).view(np.int32)
            later = _repeats_in_batch(phrase, ids, hashes, place)
            # neighbouring ready phrases of one text become one row, dealt out by the text and not by the phrase
            r_id, r_h, r_at, r_n = ids[later], hashes[later], place[later] >> _POS, place[later] & 127
            if len(r_id):
                apart = (r_id[1:] != r_id[:-1]) | (r_h[1:] != r_h[:-1]) | (r_at[1:] != r_at[:-1] + r_n[:-1])
                new = np.concatenate(([True], apart))
                head = np.flatnonzero(new)
                r_n = np.add.reduceat(r_n, head)
                r_id, r_h, r_at = r_id[head], r_h[head], r_at[head]
            spread = mix(r_h.view(np.uint64) + r_at.astype(np.uint64)).astype(np.uint32).view(np.int32)
            keep = ~later
            none = np.zeros(len(r_id), np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate((ids[keep], r_id))),
                    pa.array(np.concatenate((hashes[keep], r_h))),
                    pa.array(np.concatenate((place[keep], r_at << _POS))),
                    pa.array(np.concatenate((_as_int64(phrase[keep]), r_n))),
                    pa.array(np.concatenate((trigger[keep], spread))),
                    pa.array(np.concatenate((_as_int64(cores[keep]), none))),
                ],
                names=["id", "h", "place", "phrase", "trigger", "cores"],
            )

    return parse


def _suffixes(length: int):
    def suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The first ``length`` bytes of each start in each given phrase, as two hashes."""
        for batch in batches:
            for i, h, text, phrases in zip(*(batch.column(c).to_pylist() for c in ("id", "h", "text", "phrases"))):
                data = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
                starts = np.concatenate([np.arange(p["pos"], p["pos"] + p["starts"]) for p in phrases])
                starts = starts[starts + length <= len(data)]
                one = window_hashes(prefix_sums(data), starts, starts + length)
                two = window_hashes(prefix_sums(data, OTHER_VALUES), starts, starts + length)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(_as_int64(one)),
                        pa.array(_as_int64(two)),
                        pa.array(np.full(len(starts), i)),
                        pa.array(np.full(len(starts), h)),
                        pa.array(starts << _POS),
                    ],
                    names=["one", "two", "id", "h", "place"],
                )

    return suffixes


def _cut(length: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Texts without the bytes their repeated starts cover."""
        for batch in batches:
            out = {"doc": [], "n_bytes": [], "n_removed": [], "n_spans": [], "kept_sha256": [], "removed": []}
            for doc, text, repeats in zip(*(batch.column(c).to_pylist() for c in ("doc", "text", "repeats"))):
                data = text.encode("utf-8", "surrogatepass")
                edges = np.zeros(len(data) + 1, dtype=np.int32)
                for r in repeats or ():
                    edges[r["pos"]] += 1
                    edges[r["pos"] + r["starts"] - 1 + length] -= 1
                gone = np.cumsum(edges)[: len(data)] > 0
                turn = np.flatnonzero(np.diff(np.concatenate(([False], gone, [False])).astype(np.int8)))
                kept = np.frombuffer(data, dtype=np.uint8)[~gone].tobytes()
                out["doc"].append(doc)
                out["n_bytes"].append(len(data))
                out["n_removed"].append(int(gone.sum()))
                out["n_spans"].append(len(turn) // 2)
                out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
                out["removed"].append(turn.tolist())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(out["doc"], batch.schema.field("doc").type),
                    *(pa.array(out[c], pa.int64()) for c in ("n_bytes", "n_removed", "n_spans")),
                    pa.array(out["kept_sha256"], pa.string()),
                    pa.array(out["removed"], pa.list_(pa.int64())),
                ],
                names=list(out),
            )

    return cut


def repeated_starts(docs: DataFrame, length: int = 100, gram: int = GRAM) -> DataFrame:
    """Runs of starts whose next ``length`` bytes also start earlier.

    ``docs`` has ``id`` (long), ``h`` (a hash of the text) and ``text``; returns ``id, h, place, starts``, where ``place``
    packs the first start's position.

    The parse: one row per phrase occurrence with a hash of all the bytes its
    starts need.  Equal rows next to each other in (trigger, phrase, place)
    order are one block of the corpus's suffix order: every one but the first
    repeats as a whole.  The dictionary: where one trigger has several
    phrases, the first occurrence of each is taken apart into its suffixes, and
    equal suffixes next to each other in (suffix, place) order are a block.
    Two windows of one trigger agree in its left or in its right core (the
    trigger with half of the other bytes), so phrases that share neither with
    another are settled before that.
    """
    parse = docs.mapInArrow(_parse(length, gram), _PARSE)
    block = Window.partitionBy("trigger", "phrase").orderBy("id", "h", "place")
    of_trigger = Window.partitionBy("trigger")
    ready_run = _bits("place", _RUN) == 0
    ranked = parse.select(
        "*",
        F.rank().over(block).alias("_rank"),
        (F.min("phrase").over(of_trigger) != F.max("phrase").over(of_trigger)).alias("_several"),
    ).where(ready_run | (F.col("_rank") > 1) | F.col("_several"))
    whole = ready_run | (F.col("_rank") > 1)
    ranked = stage(
        ranked.select(
            "id",
            "h",
            "place",
            F.when(ready_run, F.col("phrase")).otherwise(_bits("place", _RUN)).alias("starts"),
            whole.alias("whole"),
            F.when(~whole, F.col("trigger")).alias("trigger"),
            F.when(~whole, F.col("cores")).alias("cores"),
        ),
        "repeat-phrases",
    )
    half = (length - gram) // 2
    left, right = F.shiftright("cores", 32), F.col("cores").bitwiseAND(F.lit((1 << 32) - 1))
    several = lambda core: F.count(F.lit(1)).over(Window.partitionBy("trigger", core)) > 1
    opened = (
        ranked.where("not whole")
        .select("id", "h", "place", "trigger", left.alias("left"), right.alias("right"))
        .distinct()
        .withColumn("before", (F.col("left") != 0) & several("left"))
        .withColumn("after", (F.col("right") != 0) & several("right"))
        .where("before or after")
    )
    pos, offset, run = _pos_of("place"), _bits("place", _OFF), _bits("place", _RUN)
    # starts at least `half` before the trigger hold its left core, those at most so far before it the right one
    skipped = F.when(F.col("before"), F.lit(0)).otherwise(F.greatest(F.lit(0), offset - half))
    ended = F.when(F.col("after"), run).otherwise(F.least(run, offset - half + 1))
    open_phrases = (
        opened.select("id", "h", (pos + skipped).alias("pos"), (ended - skipped).alias("starts"))
        .where("starts > 0")
        .groupBy("id", "h")
        .agg(F.collect_list(F.struct("pos", "starts")).alias("phrases"))
    )
    open_phrases = stage(open_phrases, "repeat-open")
    few = docs.withColumn("_slot", slot_of("id", "h", n=DOC_SLOTS)).join(
        slots(open_phrases, "id", "h", n=DOC_SLOTS), "_slot", "left_semi"
    )
    texts = few.join(open_phrases, ["id", "h"])
    # rows that repeat id and text give the same suffixes: one of them is enough
    suffixes = texts.dropDuplicates(["id", "h"]).select("id", "h", "text", "phrases").mapInArrow(
        _suffixes(length), "one long, two long, id long, h long, place long"
    )
    first = Window.partitionBy("one", "two").orderBy("id", "h", "place")
    single = suffixes.select("id", "h", "place", F.rank().over(first).alias("_rank")).where("_rank > 1")
    return ranked.where("whole").select("id", "h", "place", "starts").unionByName(
        single.select("id", "h", "place", F.lit(1).cast("long").alias("starts"))
    )


def suffix_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 100, gram: int = GRAM
) -> DataFrame:
    """Remove every byte covered by a ``length``-byte string that also starts earlier.

    Earlier: in a smaller id, or in the same text before; strings are judged on
    the input.  Texts are UTF-8 bytes and no string crosses two of them.
    Returns ``id_col, n_bytes, n_removed, n_spans, kept_sha256, removed``, one
    row per input row; ``removed`` lists start and end of each removed run in turn.

    Shuffled are one slim row per phrase (about ``2 / (length - gram + 2)`` of
    the bytes), the suffixes of the phrases where repeats begin or end, and the
    texts that hold repeats.  Repeats inside an Arrow batch are settled before
    the shuffle, so a group of copies sends a few rows per batch, whatever its
    size.  Hashes stand for strings: 96 bits for phrases, 128 for suffixes.

    Edge cases: null counts as empty; a text shorter than ``length`` stays
    whole; ids are integers, a null id comes before all others; of texts with
    one id (null too) the one with the smaller 64-bit hash comes first; rows that
    repeat id and text are one document and get equal results;
    an empty table gives an empty result; other columns are ignored.
    """
    ready(docs.sparkSession)
    text = F.coalesce(docs[text_col], F.lit(""))
    base = docs.select(
        docs[id_col].alias("doc"),
        F.coalesce(docs[id_col].cast("long"), F.lit(_NULL_ID)).alias("id"),
        F.xxhash64(text).alias("h"),
        text.alias("text"),
    )
    runs = stage(repeated_starts(base.select("id", "h", "text"), length, gram), "repeat-starts")
    per_text = runs.groupBy("id", "h").agg(
        F.collect_list(F.struct(_pos_of("place").alias("pos"), "starts")).alias("repeats")
    )
    marked = base.withColumn("_slot", slot_of("id", "h", n=DOC_SLOTS)).join(
        slots(runs, "id", "h", n=DOC_SLOTS).withColumn("_hit", F.lit(True)), "_slot", "left"
    )
    touched = (
        marked.where("_hit")
        .join(per_text, ["id", "h"], "left")
        .select("doc", "text", "repeats")
    )
    kind = docs.schema[id_col].dataType.simpleString()
    cut = touched.mapInArrow(
        _cut(length),
        f"doc {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, removed array<long>",
    )
    whole = marked.where("_hit is null").select(
        "doc",
        F.octet_length("text").cast("long").alias("n_bytes"),
        F.lit(0).cast("long").alias("n_removed"),
        F.lit(0).cast("long").alias("n_spans"),
        F.sha2("text", 256).alias("kept_sha256"),
        F.array().cast("array<long>").alias("removed"),
    )
    return cut.unionByName(whole).withColumnRenamed("doc", id_col)
