"""SentencePiece encoding and decoding as a relational lattice over the corpus's distinct words.

Texts are cut into words at the places no piece crosses.  The distinct words
are exploded into substrings of bounded length, joined with the piece table,
grouped by word and folded by Spark's ``aggregate``.

The fold depends on the model.  For a unigram model it is Viterbi's: the path
of the greatest sum of scores.  A BPE model's scores are merge ranks, and the
path of their greatest sum is another segmentation than the model's own (for
two words in three of the test corpus), so there the fold runs over the same
lattice in merge order; it gives the library's ids exactly.
"""

from __future__ import annotations

import heapq
import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from functools import lru_cache
from operator import add

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from loam.llm.common import ready, slices, stage
from loam.llm.kernels import prefix_sums, window_hashes
from loam.session import ensure_checkpoint_dir

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
#: Characters of text whose distinct words are numbered together; a longer text is a chunk by itself.
CHUNK_CHARS = 8_000_000
#: Bytes, or numbers, of a chunk that are worked on together: a task's arrays are as large as a block, not as the chunk.
BLOCK = 1 << 18
#: The same for distinct words.
WORDS_BLOCK = 1 << 14
#: Rows sent to a Python worker at once.
ROWS_AT_ONCE = 1_000
#: Hash buckets of words for each shuffle partition, so that partitions fill evenly.
BUCKETS_PER_PARTITION = 16
#: Words up to this length are folded in SQL (places fit one long), longer ones by :func:`merge_long`.
FOLD_CHARS = 60
#: A unigram model's penalty for a character that is no piece, below its least score.
UNKNOWN = 10.0


@dataclass(frozen=True)
class Vocabulary:
    """A model's pieces: ``pieces[i]`` of id ``i``; control, unknown and byte pieces are never matched in a text."""

    pieces: tuple[str, ...]
    scores: tuple[float, ...]
    normal: tuple[bool, ...]
    byte_ids: tuple[int, ...]
    unknown_id: int
    bpe: bool

    @property
    def longest(self) -> int:
        return max(len(p) for p, ok in zip(self.pieces, self.normal) if ok)

    @property
    def pairs(self) -> frozenset[str]:
        """Neighbouring characters that occur in some piece; no piece goes over any other pair."""
        return frozenset(p[i : i + 2] for p, ok in zip(self.pieces, self.normal) if ok for i in range(len(p) - 1))

    @property
    def ids(self) -> dict[str, int]:
        return {p: i for i, (p, ok) in enumerate(zip(self.pieces, self.normal)) if ok}


@lru_cache(maxsize=4)
def load_vocabulary(path: str = MODEL) -> Vocabulary:
    """Read a model file on the driver (its size is fixed); only models that leave texts as they are, but for spaces, are taken."""
    from sentencepiece import sentencepiece_model_pb2 as proto

    model = proto.ModelProto()
    with open(path, "rb") as f:
        model.ParseFromString(f.read())
    spec, kind = model.normalizer_spec, model.trainer_spec.model_type
    if spec.name != "identity" or spec.remove_extra_whitespaces or not spec.add_dummy_prefix or not spec.escape_whitespaces:
        raise ValueError(f"{path}: only models without normalisation are supported")
    if kind not in (1, 2):
        raise ValueError(f"{path}: only unigram and BPE models are supported")
    normal = tuple(p.type in (1, 4) for p in model.pieces)
    at_byte = {p.piece: i for i, p in enumerate(model.pieces) if p.type == 6}
    found = Vocabulary(
        tuple(p.piece for p in model.pieces),
        tuple(p.score for p in model.pieces),
        normal,
        tuple(at_byte[f"<0x{b:02X}>"] for b in range(256)) if len(at_byte) == 256 else (),
        model.trainer_spec.unk_id,
        kind == 2,
    )
    if any(SPACE in p.lstrip(SPACE) or "\n" in p and len(p) > 1 for p, ok in zip(found.pieces, normal) if ok):
        raise ValueError(f"{path}: pieces that go on over a space or a line are not supported")
    return found


_WORDS = re.compile(f"\n|{SPACE}+[^{SPACE}\n]+|{SPACE}+|[^{SPACE}\n]+")


def words_of(text: str) -> list[str]:
    """Words of a text: with their spaces before them; line breaks stand alone."""
    return _WORDS.findall(SPACE + text.replace(" ", SPACE)) if text else []


def units_of(word: str, pairs: frozenset[str]) -> list[str]:
    """A word cut where no piece can go on: its units are encoded apart, with the same result."""
    cuts = [i for i, pair in enumerate(map(add, word, word[1:]), 1) if pair not in pairs]
    return [word[a:b] for a, b in zip([0, *cuts], [*cuts, len(word)])] if cuts else [word]


def merge_long(word: str, vocabulary: Vocabulary) -> list[int]:
    """Ids of one word by merging the best neighbours first (any length, runs of spaces included)."""
    ids, scores = _ids_of(vocabulary), vocabulary.scores
    parts, after = list(word), list(range(1, len(word) + 1))
    before, alive = list(range(-1, len(word) - 1)), [True] * len(word)
    heap: list[tuple[float, int, int, str]] = []

    def offer(i: int) -> None:
        j = after[i]
        if j < len(parts) and (both := parts[i] + parts[j]) in ids:
            heapq.heappush(heap, (-scores[ids[both]], i, j, both))

    for i in range(len(parts)):
        offer(i)
    while heap:
        _, i, j, both = heapq.heappop(heap)
        if not alive[i] or after[i] != j or parts[i] + parts[j] != both:
            continue
        parts[i], alive[j] = both, False
        after[i] = after[j]
        if after[j] < len(parts):
            before[after[j]] = i
        offer(i)
        if before[i] >= 0:
            offer(before[i])
    out: list[int] = []
    for part, ok in zip(parts, alive):
        if ok:
            out += [ids[part]] if part in ids else _fallback(part, vocabulary)
    return out


def viterbi_long(word: str, vocabulary: Vocabulary) -> list[int]:
    """Ids of one word along the path of the greatest sum of scores; of equal ones the longest last piece wins."""
    ids, scores = _ids_of(vocabulary), vocabulary.scores
    unknown = min(scores) - UNKNOWN
    best, back = [0.0] + [-np.inf] * len(word), [0] * (len(word) + 1)
    for end in range(1, len(word) + 1):
        for start in range(max(0, end - vocabulary.longest), end):
            i = ids.get(word[start:end])
            s = scores[i] if i is not None else unknown if end - start == 1 else None
            if s is not None and best[start] + s > best[end]:
                best[end], back[end] = best[start] + s, start
    parts, end = [], len(word)
    while end:
        parts.append(word[back[end] : end])
        end = back[end]
    return [i for p in reversed(parts) for i in ([ids[p]] if p in ids else _fallback(p, vocabulary))]


@lru_cache(maxsize=4)
def _ids_of(vocabulary: Vocabulary) -> dict[str, int]:
    return vocabulary.ids


def _fallback(char: str, vocabulary: Vocabulary) -> list[int]:
    if not vocabulary.byte_ids:
        return [vocabulary.unknown_id]
    return [vocabulary.byte_ids[b] for b in char.encode("utf-8", "surrogatepass")]


# --- numbering the words of a chunk -------------------------------------------------------------


def _blocks(n: int, size: int) -> Iterator[slice]:
    for start in range(0, n, size):
        yield slice(start, min(start + size, n))


def pack(numbers: np.ndarray, ends: np.ndarray | None = None) -> bytes | list[bytes]:
    """Numbers as groups of 7 bits, low group first, the high bit set where more follow; a list of such, cut at ``ends``."""
    parts, cuts, done = [], np.zeros(len(ends) + 1 if ends is not None else 1, np.int64), 0
    for block in _blocks(len(numbers), BLOCK):
        n = numbers[block].astype(np.uint64)
        size = 1 + sum((n >= np.uint64(1 << (7 * k))).astype(np.int64) for k in range(1, 5))
        after = np.cumsum(size)
        out = np.zeros(int(after[-1]), np.uint8)
        for k in range(5):
            has = size > k
            more = (size > k + 1)[has].astype(np.uint8) << 7
            out[(after - size)[has] + k] = ((n[has] >> np.uint64(7 * k)) & np.uint64(127)).astype(np.uint8) | more
        if ends is not None:
            lo, hi = np.searchsorted(ends, [block.start, block.stop], side="right")
            cuts[lo + 1 : hi + 1] = done + after[ends[lo:hi] - block.start - 1]
        parts.append(out.tobytes())
        done += len(out)
    data = b"".join(parts)
    if ends is None:
        return data
    at = cuts.tolist()
    return [data[x:y] for x, y in zip(at, at[1:])]


def unpacked(data: bytes | np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The numbers of :func:`pack`, block by block: where each one's bytes end, and the numbers."""
    b = np.frombuffer(data, np.uint8)
    start = 0
    while start < len(b):
        end = min(start + BLOCK, len(b))
        while b[end - 1] >= 128:
            end += 1
        part = b[start:end]
        last = np.flatnonzero(part < 128)
        first = np.concatenate(([0], last[:-1] + 1))
        place = np.arange(len(part)) - np.repeat(first, last - first + 1)
        yield last + start + 1, np.add.reduceat((part & 127).astype(np.int64) << (7 * place), first)
        start = end


def unpack(data: bytes | np.ndarray) -> np.ndarray:
    return np.concatenate([np.zeros(0, np.int64), *(numbers for _, numbers in unpacked(data))])


def runs(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """``starts[i], starts[i] + 1, ...``, ``sizes[i]`` of them, for every ``i``."""
    after = np.cumsum(sizes)
    return np.repeat(starts - after + sizes, sizes) + np.arange(after[-1] if len(after) else 0)


def word_starts(data: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """Where the words of :func:`words_of` start in the bytes of texts that begin at ``docs`` (spaces already replaced)."""

    def inside(block: slice) -> np.ndarray:
        low = max(block.start - 3, 0)  # the character before the block may be a space or a line break
        part = data[low : block.stop + 2]
        space = np.zeros(len(part), bool)
        space[:-2] = (part[:-2] == 0xE2) & (part[1:-1] == 0x96) & (part[2:] == 0x81)
        first = space.copy()
        first[3:] &= ~space[:-3]
        lines = np.flatnonzero(part == 10)
        first[lines] = True
        first[lines[lines + 1 < len(part)] + 1] = True
        lo, hi = np.searchsorted(docs, [block.start, block.stop])
        first[docs[lo:hi] - low] = True
        return np.flatnonzero(first[block.start - low : block.stop - low]) + block.start

    return np.concatenate([np.zeros(0, np.int64), *map(inside, _blocks(len(data), BLOCK))])


def unit_starts(words: pa.LargeStringArray, pairs: np.ndarray) -> np.ndarray:
    """Where the units of :func:`units_of` start in the bytes of ``words``; ``pairs`` are sorted, first character in the high half."""
    _, bounds = _bytes_of(words)

    def inside(block: slice) -> np.ndarray:
        data, offsets = _bytes_of(words.slice(block.start, block.stop - block.start))
        points = np.frombuffer(data.tobytes().decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass"), np.uint32)
        size = 1 + sum((points >= least).astype(np.int64) for least in (0x80, 0x800, 0x10000))
        pair = points[:-1].astype(np.uint64) << np.uint64(32) | points[1:]
        known = pairs[np.minimum(np.searchsorted(pairs, pair), len(pairs) - 1)] == pair if len(pairs) else np.zeros(len(pair), bool)
        first = np.zeros(len(data), bool)
        first[np.cumsum(size)[:-1][~known]] = True
        first[offsets[:-1]] = True
        return np.flatnonzero(first) + bounds[block.start]

    return np.concatenate([np.zeros(0, np.int64), *map(inside, _blocks(len(words), WORDS_BLOCK))])


def _large(text: str) -> pa.Scalar:
    return pa.scalar(text, pa.large_string())


def _bytes_of(texts: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of ``texts`` (without nulls) and where each begins, with the end."""
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    held = texts.buffers()[2]
    data = np.frombuffer(held, np.uint8) if held is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def _cut_at(data: np.ndarray, starts: np.ndarray) -> pa.DictionaryArray:
    """The texts that begin at ``starts``, as a dictionary in the order of their first occurrence."""
    offsets = np.append(starts, len(data)).astype(np.int64)
    return pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(data)).dictionary_encode()


def _chunks(buckets: int, chunk_chars: int, kind: pa.DataType, pairs: frozenset[str]):
    """Per document its units' numbers in its chunk; per chunk and bucket the distinct units, sorted, and their numbers.

    Units that aren't folded in SQL (see :func:`is_plain`) are in bucket -1.
    """
    names = ["chunk", "doc", "units", "bucket", "words", "numbers"]
    known = np.sort(np.array([ord(p[0]) << 32 | ord(p[1]) for p in pairs], np.uint64))

    def bucket_of(words: pa.LargeStringArray) -> np.ndarray:
        own, bounds = _bytes_of(words)
        return (window_hashes(prefix_sums(own), bounds[:-1], bounds[1:]) % np.uint64(buckets)).astype(np.int32)

    def of_chunk(chunk: int, docs: pa.Array, texts: pa.Array) -> Iterator[pa.RecordBatch]:
        full = pc.not_equal(texts, "")
        spaced = pc.binary_join_element_wise(_large(SPACE), pc.replace_substring(texts, " ", SPACE), _large(""))
        data, offsets = _bytes_of(pc.if_else(full, spaced, _large("")))
        del texts, spaced
        data = np.ascontiguousarray(data)
        starts = word_starts(data, np.unique(offsets[offsets < len(data)])) if len(data) else np.zeros(0, np.int64)
        coded = _cut_at(data, starts)
        at = coded.indices.to_numpy()
        own, bounds = _bytes_of(coded.dictionary)
        own = np.ascontiguousarray(own)
        cuts = unit_starts(coded.dictionary, known) if len(own) else np.zeros(0, np.int64)
        numbered = _cut_at(own, cuts)
        units, first = numbered.indices.to_numpy(), np.searchsorted(cuts, bounds)
        # every word's units one after another
        each = np.diff(first)
        after = np.concatenate(([0], np.cumsum(each[at])))
        placed = [units[runs(first[:-1][at[b]], each[at[b]])] for b in _blocks(len(at), BLOCK)]
        ends = after[np.searchsorted(starts, offsets[1:])]
        del data, starts, coded, at, after
        packed = pack(np.concatenate([units[:0], *placed]), ends)
        del placed
        n = len(packed)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, chunk)), docs, pa.array(packed, pa.binary()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.string()), pa.nulls(n, pa.binary())],
            names=names,
        )
        distinct = numbered.dictionary
        if not len(distinct):
            return
        plain = is_plain(distinct)
        dealt = distinct.filter(pa.array(plain))
        bucket = np.full(len(distinct), -1, np.int32)
        bucket[plain] = np.concatenate([np.zeros(0, np.int32), *(bucket_of(dealt.slice(b.start, WORDS_BLOCK)) for b in _blocks(len(dealt), WORDS_BLOCK))])
        table = pa.table({"bucket": bucket, "word": distinct})
        order = pc.sort_indices(table, [("bucket", "ascending"), ("word", "ascending")]).to_numpy()
        begins = np.flatnonzero(np.diff(bucket[order], prepend=-2))
        ends = np.append(begins[1:], len(order))
        # one text, which shuffles well: the chunk, then the words; a line break stands alone, as the empty line
        words = distinct.take(pa.array(order))
        words = pc.if_else(pc.equal(words, "\n"), _large(""), words)
        lists = pa.LargeListArray.from_arrays(pa.array(np.append(begins, len(order))), words)
        lines = pc.binary_join_element_wise(_large(str(chunk)), pc.binary_join(lists, _large("\n")), _large("\n"))
        m = len(begins)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(m, chunk)), pa.nulls(m, kind), pa.nulls(m, pa.binary()), pa.array(bucket[order][begins]), lines.cast(pa.string()), pa.array(pack(order, ends), pa.binary())],
            names=names,
        )

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, size = TaskContext.get().partitionId() << 32, 0
        held: list[tuple[pa.Array, pa.Array]] = []

        def flush() -> Iterator[pa.RecordBatch]:
            docs, texts = (pa.concat_arrays(parts) for parts in zip(*held))
            held.clear()  # they hold on to the whole batches
            return of_chunk(chunk, docs, texts)

        for batch in (part for whole in batches for part in slices(whole)):
            texts = pc.fill_null(batch.column("text").cast(pa.large_string()), "")
            chars = np.cumsum(pc.utf8_length(texts).to_numpy() + 1)
            row, before = 0, 0
            while row < len(chars):
                end = int(np.searchsorted(chars, before + chunk_chars - size, side="right"))
                if end <= row and size:
                    yield from flush()
                    pa.default_memory_pool().release_unused()
                    chunk, size = chunk + 1, 0
                    continue
                end = max(end, row + 1)
                held.append((batch.column("doc").slice(row, end - row), texts.slice(row, end - row)))
                size += int(chars[end - 1]) - before
                row, before = end, int(chars[end - 1])
        if held:
            yield from flush()
        pa.default_memory_pool().release_unused()  # the worker stays, idle, through the steps that follow

    return chunks


def is_plain(words: pa.LargeStringArray) -> np.ndarray:
    """Whether words are folded in SQL: not the very long ones and not runs of spaces."""
    runs = pc.starts_with(words, SPACE + SPACE)
    return pc.and_not(pc.less_equal(pc.utf8_length(words), FOLD_CHARS), runs).to_numpy(zero_copy_only=False)


# --- the lattice --------------------------------------------------------------------------------


def piece_table(spark: SparkSession, vocabulary: Vocabulary, empty: bool = False) -> DataFrame:
    """``piece, id, score`` of the pieces that texts are matched with; as many rows as the model has, so it is broadcast.

    ``empty`` adds a row for the empty text, without an id.
    """
    rows = [(p, i, float(s)) for i, (p, s, ok) in enumerate(zip(vocabulary.pieces, vocabulary.scores, vocabulary.normal)) if ok]
    rows += [("", None, 0.0)] if empty else []
    return F.broadcast(spark.createDataFrame(rows, "piece string, id int, score double"))


def _merge_fold(edges: Column, length: Column) -> Column:
    """Piece boundaries after merging along ``edges`` (best score first, then from the left).

    A piece is merged when both its ends are boundaries and exactly one boundary lies between them.
    """

    def step(bits: Column, e: Column) -> Column:
        between = bits.bitwiseAND(e["inner"])
        one = (between != 0) & (between.bitwiseAND(between - 1) == 0)
        ends = bits.bitwiseAND(e["ends"]) == e["ends"]
        return F.when(ends & one, bits - between).otherwise(bits)

    every = F.call_function("shiftleft", F.lit(1).cast("long"), (length + 1).cast("int")) - 1
    # the bits become a list inside the fold: outside, the optimizer would put the fold into the list's condition
    return F.aggregate(edges, every, step, lambda bits: _places(bits, length))


def _places(bits: Column, length: Column) -> Column:
    return F.filter(F.sequence(F.lit(0), length), lambda i: F.getbit(bits, i) == 1)


def _viterbi_fold(edges: Column, length: Column) -> Column:
    """Piece boundaries of the path of the greatest sum of scores over ``edges`` (by end, then start)."""
    start = F.transform(F.sequence(F.lit(0), length.cast("int")), lambda i: F.when(i == 0, F.lit(0.0)).otherwise(F.lit(float("-inf"))))
    bits = F.transform(F.sequence(F.lit(0), length.cast("int")), lambda i: F.lit(1).cast("long"))

    def step(state: Column, e: Column) -> Column:
        total = F.element_at(state["best"], e["lo"] + 1) + e["score"]
        better = total > F.element_at(state["best"], e["hi"] + 1)
        path = F.element_at(state["bits"], e["lo"] + 1).bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), e["hi"]))
        put = lambda old, new: F.transform(old, lambda v, i: F.when(better & (i == e["hi"]), new).otherwise(v))
        return F.struct(put(state["best"], total).alias("best"), put(state["bits"], path).alias("bits"))

    return F.aggregate(edges, F.struct(start.alias("best"), bits.alias("bits")), step, lambda s: _places(F.element_at(s["bits"], -1), length))


def encode_words(words: DataFrame, vocabulary: Vocabulary) -> tuple[DataFrame, DataFrame]:
    """``bucket, word, ids`` of distinct ``bucket, word`` rows, which are grouped by ``bucket`` already.

    Two tables: words folded in SQL, which keep that grouping, and the others (very long words, runs of spaces).
    """
    pieces = piece_table(words.sparkSession, vocabulary)
    n = F.length("word")
    plain = (n <= FOLD_CHARS) & ~F.col("word").startswith(SPACE + SPACE)
    least, longest = (2 if vocabulary.bpe else 1), vocabulary.longest
    one = lambda shift: F.call_function("shiftleft", F.lit(1).cast("long"), shift)
    spans = (
        words.where(plain)
        .select("bucket", "word", F.explode(F.sequence(F.lit(0), n - 1)).alias("lo"))
        # size 0 stands for the word itself, so that words without any piece stay
        .select("bucket", "word", "lo", F.explode(F.sequence(F.lit(0), F.least(F.lit(longest), n - F.col("lo")))).alias("size"))
        .where(((F.col("size") == 0) & (F.col("lo") == 0)) | (F.col("size") >= least))
        .select("bucket", "word", "lo", (F.col("lo") + F.col("size")).alias("hi"), F.expr("substring(word, lo + 1, size)").alias("piece"))
    )
    if vocabulary.bpe:
        matched = spans.join(piece_table(words.sparkSession, vocabulary, empty=True), "piece")
        edge = F.struct(
            (-F.col("score")).alias("rank"),
            "lo",
            (one(F.col("hi")) + one(F.col("lo"))).alias("ends"),
            (one(F.col("hi")) - one(F.col("lo") + 1)).alias("inner"),
        )
        real = F.col("id").isNotNull()
        fold = _merge_fold
    else:
        unknown = min(vocabulary.scores) - UNKNOWN
        matched = spans.join(pieces, "piece", "left").where("id is not null or hi - lo <= 1")
        edge = F.struct("hi", "lo", F.coalesce("score", F.lit(unknown)).alias("score"))
        real = F.col("hi") > F.col("lo")
        fold = _viterbi_fold
    folded = (
        matched.groupBy("bucket", "word")
        .agg(F.sort_array(F.collect_list(F.when(real, edge))).alias("edges"))
        .select("bucket", "word", fold(F.col("edges"), n).alias("cuts"))
    )
    parts = folded.select(
        "bucket",
        "word",
        F.posexplode(
            F.transform(
                F.slice("cuts", 1, F.size("cuts") - 1),
                lambda c, i: F.substr("word", c + 1, F.element_at("cuts", (i + 2).cast("int")) - c),
            )
        ).alias("pos", "piece"),
    )
    if vocabulary.byte_ids:
        table = F.array(*[F.lit(i) for i in vocabulary.byte_ids])
        raw = F.hex(F.encode("piece", "utf-8"))
        spelled = F.transform(
            F.sequence(F.lit(1), F.length(raw) - 1, F.lit(2)),
            lambda i: F.element_at(table, F.conv(F.substr(raw, i, F.lit(2)), 16, 10).cast("int") + 1),
        )
    else:
        spelled = F.array(F.lit(vocabulary.unknown_id))
    ids = F.when(F.col("id").isNotNull(), F.array("id")).otherwise(spelled)
    sql = (
        parts.join(pieces, "piece", "left")
        .groupBy("bucket", "word")
        .agg(F.sort_array(F.collect_list(F.struct("pos", ids.alias("ids")))).alias("parts"))
        .select("bucket", "word", F.flatten("parts.ids").alias("ids"))
    )
    one_by_one = merge_long if vocabulary.bpe else viterbi_long

    def long_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [one_by_one(w, vocabulary) for w in batch.column("word").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("bucket"), batch.column("word"), pa.array(found, pa.list_(pa.int32()))], names=["bucket", "word", "ids"])

    rest = words.where(~plain).mapInArrow(long_words, "bucket int, word string, ids array<int>")
    return sql, rest


# --- encoding and decoding ----------------------------------------------------------------------


#: Settings for the steps within buckets: rows grouped by some of a join's keys are not dealt out again by all of
#: them, and lists are collected in a hash table up to the words of a usual partition (sorted and merged beyond).
_SETTINGS = {
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "50000",
}


#: Small batches: the texts that go to a Python worker are held three times over on their way, outside the heap.
_SMALL_BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": str(ROWS_AT_ONCE)}


@contextmanager
def _with(spark: SparkSession, settings: dict[str, str]):
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def _by_chunk(rows: DataFrame, buckets: int) -> DataFrame:
    """``rows`` written into the shared folder, bucketed by chunk, so that the last join doesn't shuffle them."""
    spark = rows.sparkSession
    name = f"loam_pieces_{uuid.uuid4().hex}"
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}"
    rows.write.option("compression", "zstd").option("path", path).bucketBy(buckets, "chunk").saveAsTable(name)
    found = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # the catalogue's entry only: the files stay where they are
    return found


def encode(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    model: str = MODEL,
    chunk_chars: int = CHUNK_CHARS,
    decoded: bool = False,
) -> DataFrame:
    """Piece ids of every whole text: ``id_col, ids, n_ids``, one row per input row, as the model's own encoder gives them.

    With ``decoded`` also ``text``, decoded from the ids in the same pass (see :func:`decode`).

    1. Texts become numbers of words, numbered by chunk (some MB of text) and
       cut where no piece goes on (:func:`units_of`); the chunk's distinct words
       are dealt out by hash bucket, so a word costs one entry per chunk,
       however often it occurs.
    2. Within a bucket the corpus's distinct words go through the lattice
       (:func:`encode_words`).  The bucket's grouping serves every step, there
       is no further shuffle.  Very long words and runs of spaces stay with
       their chunk and are merged there one by one.
    3. Each chunk gets its words' ids back, packed by bucket, and its texts are
       put together.

    Edge cases: null and empty texts have no ids; spaces are kept one by one;
    characters that are no piece become byte pieces (the unknown piece in a
    model without those); words of any length are whole; rows that repeat an id
    are encoded each; an empty table gives an empty result; other columns are
    ignored.
    """
    spark = docs.sparkSession
    ready(spark)
    vocabulary = load_vocabulary(model)
    partitions = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    buckets = partitions * BUCKETS_PER_PARTITION
    kind = docs.schema[id_col].dataType
    base = docs.select(docs[id_col].alias("doc"), docs[text_col].alias("text"))
    rows = base.mapInArrow(
        _chunks(buckets, chunk_chars, to_arrow_type(kind), vocabulary.pairs),
        f"chunk long, doc {kind.simpleString()}, units binary, bucket int, words string, numbers binary",
    )
    with _with(spark, _SMALL_BATCHES):
        staged = _by_chunk(rows, partitions)
    # a task for each bucket: a word's lattice takes far more memory than the word, and all of a task's are held at once
    # (the text is the one column beside the bucket, so that all steps below share one shuffle)
    dealt = staged.where("words is not null and bucket >= 0").select("bucket", "words").repartition(buckets, "bucket")
    lines = F.split("words", "\n")
    rest = F.transform(F.slice(lines, 2, F.size(lines)), lambda w: F.when(w == "", F.lit("\n")).otherwise(w))
    # read the text before the explode: beside it, it would be split again for every word
    read = dealt.select("bucket", F.substring_index("words", "\n", 1).cast("long").alias("chunk"), rest.alias("rest"))
    listed = read.select("bucket", "chunk", F.posexplode("rest").alias("pos", "word"))
    width = 2 if len(vocabulary.pieces) <= 1 << 16 else 4
    digits = lambda i: F.lpad(F.hex(i), 2 * width, "0")
    with _with(spark, _SETTINGS):
        encoded, _ = encode_words(listed.select("bucket", "word").distinct(), vocabulary)
        # by word first: within a bucket, that is what sorting can tell rows apart by
        replies = (
            listed.join(encoded, ["word", "bucket"])
            .groupBy("bucket", "chunk")
            .agg(F.sort_array(F.collect_list(F.struct("pos", "ids"))).alias("found"))
            .select(
                "chunk",
                "bucket",
                F.col("found.pos").alias("pos"),
                F.transform("found.ids", lambda x: F.size(x)).alias("sizes"),
                F.unhex(F.array_join(F.transform(F.flatten("found.ids"), digits), "")).alias("ids"),
            )
        )
        replies = stage(replies, "piece-replies")
    # long words and runs of spaces are not many: they stay in their chunk
    own_words = F.when(F.col("bucket") < 0, F.col("words")).alias("words")
    texts = staged.select("chunk", "doc", "units", "bucket", own_words, "numbers")
    one_by_one = merge_long if vocabulary.bpe else viterbi_long
    spelled = spellings(vocabulary) if decoded else []

    def together(left: pa.Table, right: pa.Table) -> pa.Table:
        """One chunk: number -> ids, then every text's ids."""
        listed = left.filter(pc.is_valid(left.column("bucket")))
        numbered = dict(zip(listed.column("bucket").to_pylist(), listed.column("numbers").to_pylist()))
        number, sizes, ids = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int32)]
        for words, own in zip(listed.column("words").to_pylist(), listed.column("numbers").to_pylist()):
            if words is not None:
                found = [np.array(one_by_one(w, vocabulary), np.int32) for w in words.split("\n")[1:]]
                number.append(unpack(own))
                sizes.append(np.array([len(i) for i in found], np.int64))
                ids += found
        for b, p, s, i in zip(right.column("bucket").to_pylist(), *(right.column(c) for c in ("pos", "sizes", "ids"))):
            number.append(unpack(numbered[b])[p.values.to_numpy()])
            sizes.append(s.values.to_numpy())
            ids.append(np.frombuffer(i.as_buffer(), f">u{width}").astype(np.int32))
        number, sizes, ids = np.concatenate(number), np.concatenate(sizes).astype(np.int64), np.concatenate(ids)
        starts, lengths = np.zeros(len(number), np.int64), np.zeros(len(number), np.int64)
        starts[number], lengths[number] = np.cumsum(sizes) - sizes, sizes
        docs_only = left.filter(pc.is_valid(left.column("units")))
        packed = docs_only.column("units").combine_chunks()
        raw, held = packed.buffers()[2], np.frombuffer(packed.buffers()[1], np.int32)[packed.offset : packed.offset + len(packed) + 1]
        data = (np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8))[held[0] : held[-1]]
        held = held - held[0]
        ends, flat, done = np.zeros(len(held), np.int64), [np.zeros(0, np.int32)], 0
        for stops, u in unpacked(data):
            size = lengths[u]
            after = np.cumsum(size)
            flat.append(ids[runs(starts[u], size)])
            # a document's numbers end where its bytes do
            lo, hi = np.searchsorted(held, [stops[0] - 1, stops[-1]], side="right")
            ends[lo:hi] = done + after[np.searchsorted(stops, held[lo:hi], side="right") - 1]
            done += int(after[-1])
        flat = np.concatenate(flat)
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()))
        found = {"doc": docs_only.column("doc"), "ids": lists, "n_ids": pa.array(np.diff(ends), pa.int64())}
        if decoded:
            found["text"] = pa.array([decode_ids(flat[x:y], spelled) for x, y in zip(ends, ends[1:])], pa.string())
        pa.default_memory_pool().release_unused()
        return pa.table(found)

    joined = texts.groupBy("chunk").cogroup(replies.groupBy("chunk"))
    schema = f"doc {kind.simpleString()}, ids array<int>, n_ids long" + ", text string" * decoded
    return joined.applyInArrow(together, schema).withColumnRenamed("doc", id_col)


def decode_ids(ids: list[int] | np.ndarray, spelled: list[bytes]) -> str:
    """Text of piece ids: bytes joined, the leading space of the whole dropped, malformed bytes replaced."""
    text = b"".join(map(spelled.__getitem__, ids.tolist() if isinstance(ids, np.ndarray) else ids)).decode("utf-8", "replace")
    return text[1:] if text.startswith(" ") else text


def spellings(vocabulary: Vocabulary) -> list[bytes]:
    """Bytes that each id stands for (control pieces: none)."""
    raw = {i: bytes([b]) for b, i in enumerate(vocabulary.byte_ids)}
    out = []
    for i, (p, ok) in enumerate(zip(vocabulary.pieces, vocabulary.normal)):
        if i == vocabulary.unknown_id:
            out.append(" ⁇ ".encode())
        else:
            out.append(p.replace(SPACE, " ").encode() if ok else raw.get(i, b""))
    return out


def decode(encoded: DataFrame, ids_col: str = "ids", text_col: str = "text", model: str = MODEL) -> DataFrame:
    """``encoded`` with the text of each row's ids as ``text_col`` (replaced where there is one).

    A map over rows against the piece table (as many entries as the model
    has); no shuffle.  A null list gives a null text, an empty one an empty text.
    """
    ready(encoded.sparkSession)
    spelled = spellings(load_vocabulary(model))
    rest = [c for c in encoded.columns if c != text_col]
    source = encoded.select(*[encoded[c] for c in rest])
    schema = source.withColumn(text_col, F.lit("")).schema

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole)):
            found = [None if not i.is_valid else decode_ids(i.values.to_numpy().tolist(), spelled) for i in batch.column(ids_col)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.string())], names=[*batch.schema.names, text_col])

    return source.mapInArrow(texts, schema)
