"""Exact Jaccard self-join of documents on word shingles, by universe partitioning.

Sets with Jaccard similarity of at least the threshold differ in few elements.
Hashing the universe of shingles into more segments than that leaves, for each
such pair, a segment in which both sets are equal; a shared segment makes a
candidate, which is then verified exactly.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loam.llm.common import once, ready, row_name, slices, slot_of, slots, stage, without
from loam.llm.components import components, with_links
from loam.llm.kernels import lowered, mix, shingles, word_hashes

SHINGLE = 4
PERCENT = 85
#: Rows of the broadcast prefilter of texts to verify: a bound, not a cap on the data.
DOC_SLOTS = 1 << 19
#: 64-bit words of the parity sketch that every set has.
SKETCH = 8
#: Candidate pairs of larger sets are held against wide sketches, which grow with the sets, before elements are moved.
WIDE_FROM = 600
#: Candidate pairs per block of that step.
BLOCK_PAIRS = 500_000

_U = np.uint64


@lru_cache(maxsize=None)
def band_floors(percent: int, upto: int = 1 << 40) -> tuple[int, ...]:
    """Least set size of each size band: linked sets lie in one band or in two neighbouring ones."""
    floors = [1]
    while floors[-1] < upto:
        floors.append(floors[-1] * 100 // percent + 1)
    return tuple(floors)


def segment_count(band: int, percent: int) -> int:
    """One more than the elements in which two linked sets of this band (or it and the one below) can differ."""
    top = band_floors(percent)[band + 1] - 1
    return 2 * top * (100 - percent) // (100 + percent) + 1


def extra_count(segments: int) -> int:
    """Segments indexed with their one-deletion neighbourhoods, to make up for skipped empty ones."""
    return max(1, segments // 40)


def signatures(sh: np.ndarray, percent: int) -> np.ndarray:
    """Index entries of one set of shingle hashes, in its own band and the one above.

    Allocation by cost: an empty segment is the dearest entry of all (every
    set of the band that lacks it would share it), so it has none.  What that
    loses is bought back by the first segments, which are also indexed with
    each of their elements left out: a pair may differ there by one element.
    A set that lacks more takes as many more of them as it needs, and beyond
    the last one begins again with two elements left out.  Of two linked sets
    the one that needs less then finds the other's entries, whatever that took.
    """
    n = len(sh)
    floors = band_floors(percent)
    own = int(np.searchsorted(floors, n, side="right")) - 1
    out = []
    place, value = mix(sh ^ _U(0x6A09E667F3BCC909)), mix(sh ^ _U(0xBB67AE8584CAA73B))
    for band in (own, own + 1):
        m = segment_count(band, percent)
        if m < 2:
            continue  # linked sets are equal here
        seg = (place % _U(m)).astype(np.int64)
        order = np.argsort(seg, kind="stable")
        sizes = np.bincount(seg, minlength=m)
        ends = np.cumsum(sizes)
        sums = np.concatenate(([_U(0)], np.cumsum(value[order])))
        total = sums[ends] - sums[ends - sizes]
        salt = mix(np.arange(m, dtype=np.uint64) + _U((band * 0x9E3779B97F4A7C15) % (1 << 64)))
        out.append(mix(total ^ salt)[sizes > 0])
        steps = neighbourhoods(sizes, extra_count(m))
        dropped = order[: ends[min(steps, m) - 1]]
        dropped = dropped[sizes[seg[dropped]] > 1]
        out.append(mix((total[seg[dropped]] - value[dropped]) ^ salt[seg[dropped]]))
        for level, last in deeper(steps, m):
            for s in np.flatnonzero(sizes[:last] > level):
                held = value[order[ends[s] - sizes[s] : ends[s]]]
                left_out = np.array([sum(int(v) for v in c) % (1 << 64) for c in combinations(held, level)], np.uint64)
                out.append(mix((total[s] - left_out) ^ salt[s]))
    return np.unique(np.concatenate(out)) if out else np.zeros(0, np.uint64)


def neighbourhoods(sizes: np.ndarray, least: int) -> int:
    """How many segments a set indexes with elements left out (counting on from the first again, one element more each round).

    To leave a set without a shared entry, a partner must differ in every
    filled segment, and in ``k + 1`` elements (or all) where up to ``k`` are
    left out; as many segments are taken as make that more than a link allows.
    """
    m, need = len(sizes), len(sizes) - np.count_nonzero(sizes)
    taken, level = 0, 1
    while True:
        gain = np.cumsum(sizes > level)
        if gain[-1] >= need or level >= sizes.max():
            return max(least, taken + int(np.searchsorted(gain, need)) + 1 if need > 0 else 0)
        need -= gain[-1]
        taken, level = taken + m, level + 1


def deeper(steps: int, m: int) -> Iterator[tuple[int, int]]:
    """(elements left out, segments) of the rounds after the first."""
    for level in range(2, (steps - 1) // m + 2):
        yield level, min(m, steps - (level - 1) * m)


def set_key(sh: np.ndarray) -> int:
    """A 64-bit name of a set of shingles."""
    return int(mix(np.array([mix(sh ^ _U(0x3C6EF372FE94F82B)).sum() + _U(len(sh))], np.uint64)).view(np.int64)[0])


def parity_sketch(sh: np.ndarray, words: int = SKETCH) -> np.ndarray:
    """Parity of the elements in each of ``64 * words`` places; sets differ by at least the bits that differ."""
    bits = np.bincount((mix(sh ^ _U(0xA54FF53A5F1D36F1)) % _U(64 * words)).astype(np.int64), minlength=64 * words)
    return np.packbits((bits & 1).astype(np.uint8)).view(np.int64)


def _sets(texts, size):
    for text in texts:
        yield shingles(word_hashes(lowered(text)), size) if text else np.zeros(0, np.uint64)


def _describe(size: int):
    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Set size, key and parity sketch of each text."""
        for batch in batches:
            for part in slices(batch):
                n, keys, sketch = [], [], []
                for sh in _sets(part.column("text").to_pylist(), size):
                    n.append(len(sh))
                    keys.append(set_key(sh) if len(sh) else None)
                    sketch.append(parity_sketch(sh).tolist() if len(sh) else None)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc"), pa.array(n, pa.int64()), pa.array(keys, pa.int64()), pa.array(sketch, pa.list_(pa.int64()))],
                    names=["doc", "n", "key", "sketch"],
                )

    return describe


def _index(size: int, percent: int):
    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Index entries of each text's set; equal sets of one task give theirs once (map-side combine)."""
        done: set[int] = set()
        for batch in batches:
            for part in slices(batch):
                sigs, keys = [], []
                for sh in _sets(part.column("text").to_pylist(), size):
                    key = set_key(sh) if len(sh) else None
                    if key is None or key in done:
                        continue
                    done.add(key)
                    s = signatures(sh, percent)
                    sigs.append(s)
                    keys.append(np.full(len(s), key))
                if sigs:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(sigs).view(np.int64)), pa.array(np.concatenate(keys))], names=["sig", "key"]
                    )

    return index


def wide_words(n: int) -> int:
    """64-bit words of a set's wide sketch: a power of two, with about two bits for each element."""
    return max(SKETCH, 1 << max(0, (n // 32 - 1)).bit_length())


def _fold_to(sketches: np.ndarray, words: int) -> np.ndarray:
    """Wide sketches (rows) as they would be with fewer words."""
    return np.bitwise_xor.reduce(sketches.reshape(len(sketches), -1, words), axis=1)


def _may_link_wide(percent: int):
    def check(pairs: pa.Table, sketches: pa.Table) -> pa.Table:
        """Pairs of one block whose wide sketches leave room for a link."""
        keys, first = np.unique(sketches.column("key").to_numpy(), return_index=True)
        store = sketches.column("items").combine_chunks()
        flat, offsets = store.values.to_numpy().view(np.uint64), store.offsets.to_numpy()
        start, words = offsets[:-1][first], np.diff(offsets)[first]
        a, b = (np.searchsorted(keys, pairs.column(c).to_numpy()) for c in ("a", "b"))
        room = (100 - percent) * (pairs.column("n_a").to_numpy() + pairs.column("n_b").to_numpy())
        keep = np.zeros(len(a), dtype=bool)
        shapes = words[a].astype(np.int64) << 32 | words[b]
        for shape in np.unique(shapes):
            wa, wb = int(shape >> 32), int(shape & 0xFFFFFFFF)
            least = min(wa, wb)
            rows = np.flatnonzero(shapes == shape)
            for part in np.array_split(rows, 1 + len(rows) * max(wa, wb) // 4_000_000):
                x = flat[start[a[part]][:, None] + np.arange(wa)]
                y = flat[start[b[part]][:, None] + np.arange(wb)]
                differing = np.bitwise_count(_fold_to(x, least) ^ _fold_to(y, least)).sum(axis=1, dtype=np.int64)
                keep[part] = (100 + percent) * differing <= room[part]
        return pairs.filter(pa.array(keep)).drop_columns(["block"])

    return check


def _elements(size: int, wide: bool = False):
    def elements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Key and sorted shingle hashes (or the wide sketch) of each text."""
        for batch in batches:
            for part in slices(batch, 100):
                sets = [sh for sh in _sets(part.column("text").to_pylist(), size) if len(sh)]
                items = [parity_sketch(sh, wide_words(len(sh))) if wide else sh.view(np.int64) for sh in sets]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([set_key(sh) for sh in sets], pa.int64()), pa.array(items, pa.list_(pa.int64()))],
                    names=["key", "items"],
                )

    return elements


class _Verifier:
    """Exact check of candidate pairs of keys."""

    def __init__(self, docs: DataFrame, nodes: DataFrame, size: int, percent: int):
        self.docs, self.nodes, self.size, self.percent = docs, nodes, size, percent

    def may_link(self, a: str, b: str):
        """Whether sizes and parity sketches of struct columns ``a`` and ``b`` leave room for a link.

        The sketches' differing bits are a lower bound of the elements in
        which the sets differ, so no linked pair fails.
        """
        n_a, n_b = F.col(f"{a}.n"), F.col(f"{b}.n")
        differing = sum(
            F.bit_count(F.col(f"{a}.sketch")[i].bitwiseXOR(F.col(f"{b}.sketch")[i])) for i in range(SKETCH)
        )
        return (100 * F.least(n_a, n_b) >= self.percent * F.greatest(n_a, n_b)) & (
            (100 + self.percent) * differing <= (100 - self.percent) * (n_a + n_b)
        )

    def __call__(self, pairs: DataFrame, name: str) -> DataFrame:
        """The pairs (``a``, ``b``, with set sizes ``n_a``, ``n_b``) whose sets are linked."""
        near = stage(pairs.distinct(), f"{name}-near")
        large = F.greatest("n_a", "n_b") > WIDE_FROM
        wide = near.where(large).count()
        if wide:
            near = stage(near.where(~large).unionByName(self._nearer(near.where(large), wide)), f"{name}-nearer")
        items = self._items(near)
        side = lambda c: items.select(F.col("key").alias(c), F.col("items").alias(f"items_{c}"))
        joined = near.join(side("b"), "b").join(side("a"), "a")
        shared = F.size(F.array_intersect("items_a", "items_b"))
        linked = 100 * shared >= self.percent * (F.col("n_a") + F.col("n_b") - shared)
        return stage(joined.where(linked).select("a", "b").distinct(), f"{name}-links")

    def _items(self, pairs: DataFrame, wide: bool = False) -> DataFrame:
        """``key, items`` (elements or wide sketch) of the sets in ``pairs``; only texts that may be needed are read."""
        keys = pairs.select(F.col("a").alias("key")).union(pairs.select("b")).distinct()
        chosen = self.nodes.join(keys, "key", "left_semi")
        texts = self.docs.withColumn("_slot", slot_of("doc", n=DOC_SLOTS)).join(
            slots(chosen, "doc", n=DOC_SLOTS), "_slot", "left_semi"
        )
        return (
            texts.select("text")
            .mapInArrow(_elements(self.size, wide), "key long, items array<long>")
            .join(keys, "key", "left_semi")
        )

    def _nearer(self, pairs: DataFrame, count: int) -> DataFrame:
        """``pairs`` (``count`` of them) that wide sketches leave room for.

        A block join: keys fall into as many groups as the number of pairs
        asks for, a block holds the pairs of two groups, and a sketch goes to
        the blocks of its group; so sketches are sent a few times each, and not
        once for each pair.
        """
        groups = max(2, math.ceil(math.sqrt(count / BLOCK_PAIRS)))
        group = lambda c: F.pmod(F.xxhash64(c), F.lit(groups)).cast("int")
        blocked = pairs.withColumn("block", group("a") * groups + group("b"))
        every = F.sequence(F.lit(0), F.lit(groups - 1))
        blocks = F.concat(
            F.transform(every, lambda i: group("key") * groups + i), F.transform(every, lambda i: i * groups + group("key"))
        )
        sketches = self._items(pairs, wide=True).withColumn("block", F.explode(F.array_distinct(blocks)))
        return blocked.groupBy("block").cogroup(sketches.groupBy("block")).applyInArrow(
            _may_link_wide(self.percent), "a long, n_a long, b long, n_b long"
        )


def ngram_roots(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """(described documents, components of the links between distinct sets).

    ``docs`` has ``doc`` and ``text``.  The first has ``doc, n, key`` per row;
    equal sets share a key.  The second has ``node, root``, both keys, for every
    linked set but the one of least key in its component.

    In a bucket (one index entry), every set is first paired with the bucket's
    hub only: the set that shares the most buckets with others, so of a family
    of near copies the one with the fewest changes.  Sets that this leaves
    outside the hub's component are then paired with all sets of the bucket
    that lie in another component.  So a family of ``k`` near copies costs
    about ``k`` pairs, and no link between components is lost.  Both joins hold
    the pair against sizes and sketches before it becomes a row.  The links of
    the second step then join components of the first, whose own links are not
    followed again.
    """
    kind = docs.schema["doc"].dataType.simpleString()
    described = stage(docs.mapInArrow(_describe(size), f"doc {kind}, n long, key long, sketch array<long>"), "jaccard-sets")
    nodes = described.where("key is not null").groupBy("key").agg(
        F.min("doc").alias("doc"), F.first("n").alias("n"), F.first("sketch").alias("sketch")
    )
    verify = _Verifier(docs, nodes, size, percent)
    index = docs.select("text").mapInArrow(_index(size, percent), "sig long, key long")
    bucket = Window.partitionBy("sig")
    several = F.min("key").over(bucket) != F.max("key").over(bucket)
    entries = stage(
        index.withColumn("_several", several).where("_several").select("sig", "key").distinct(), "jaccard-buckets"
    )
    sizes = entries.groupBy("sig").count()
    rank = entries.join(sizes, "sig").groupBy("key").agg(F.sum("count").alias("rank"))
    members = stage(
        entries.join(rank.join(nodes, "key"), "key").select("sig", "rank", F.struct("key", "n", "sketch").alias("set")),
        "jaccard-members",
    )
    hubs = members.groupBy("sig").agg(F.max_by("set", F.struct("rank", "set.key")).alias("hub"))
    stars = members.join(hubs, "sig").where((F.col("set.key") != F.col("hub.key")) & verify.may_link("set", "hub"))
    pair = lambda x, y: [
        F.when(F.col(f"{x}.key") < F.col(f"{y}.key"), F.col(f"{x}.{c}")).otherwise(F.col(f"{y}.{c}")).alias(n)
        for c, n in (("key", "a"), ("n", "n_a"))
    ] + [
        F.when(F.col(f"{x}.key") < F.col(f"{y}.key"), F.col(f"{y}.{c}")).otherwise(F.col(f"{x}.{c}")).alias(n)
        for c, n in (("key", "b"), ("n", "n_b"))
    ]
    links = verify(stars.select(*pair("set", "hub")), "jaccard-stars")
    roots = components(links, "jaccard-star-parts")
    placed = stage(
        members.join(roots, F.col("set.key") == F.col("node"), "left").select(
            "sig", "rank", "set", F.coalesce("root", "set.key").alias("part")
        ),
        "jaccard-placed",
    )
    hub_part = placed.groupBy("sig").agg(F.max_by("part", F.struct("rank", "set.key")).alias("hub_part"))
    stray = placed.join(hub_part, "sig").where("part <> hub_part").select("sig", "set", "part")
    rest = placed.select("sig", F.col("set").alias("other"), F.col("part").alias("other_part"))
    apart = (F.col("s.sig") == F.col("r.sig")) & (F.col("part") != F.col("other_part")) & verify.may_link("set", "other")
    cross = stray.alias("s").join(rest.alias("r"), apart)
    more = verify(cross.select(*pair("set", "other")), "jaccard-cross")
    return described, with_links(roots, more, "jaccard-parts")


def ngram_jaccard_join(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE, percent: int = PERCENT
) -> DataFrame:
    """Near-duplicate classes: components of the links ``100 * |A and B| >= percent * |A or B|``.

    A document's set holds its distinct ``size``-word shingles (words between
    ASCII white space, A-Z lower-cased); with fewer words, the whole sequence.
    Returns ``id_col, n_shingles, component_id``, one row per input row;
    ``component_id`` is the least id reachable by links, itself included.

    Copies share a set and enter the join once; see :func:`ngram_roots` for
    the pairs, :func:`signatures` for the index.  Candidates are first held
    against sizes and 512-bit parity sketches (a lower bound of the elements
    in which the sets differ), then verified on the whole sets.  Sets and
    shingles are named by 64-bit hashes.

    Edge cases: null and empty texts, and texts without words, have an empty
    set and are linked with nothing; a null id is never the least unless the
    class has no other; rows that repeat an id are documents of their own; an
    empty table gives an empty result; other columns are ignored.
    """
    ready(docs.sparkSession)
    base = docs.select(docs[id_col].alias("doc"), F.coalesce(docs[text_col], F.lit("")).alias("text"))
    described, roots = ngram_roots(base, size, percent)
    classed = (
        described.select("doc", "n", "key")
        .join(roots, F.col("key") == F.col("node"), "left")
        .select("doc", "n", "key", F.coalesce("root", "key").alias("class"))
    )
    classed = classed.where("key is not null")
    least = classed.groupBy("class").agg(F.min("doc").alias("component_id"), F.count(F.lit(1)).alias("members"))
    # a document alone in its class needs no join
    large = least.where("members > 1").select(F.col("class").alias("_class"), "component_id")
    joined = classed.join(large, F.col("class") == F.col("_class"), "left").select(
        "doc", "n", F.when(F.col("_class").isNull(), F.col("doc")).otherwise(F.col("component_id")).alias("component_id")
    )
    empty = described.where("key is null").select("doc", "n", F.col("doc").alias("component_id"))
    return joined.unionByName(empty).select(F.col("doc").alias(id_col), F.col("n").alias("n_shingles"), "component_id")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one document of each class of :func:`ngram_jaccard_join`, the one of least id; all columns kept.

    Rows are judged by id and text together: of rows that share an id, one may
    go and the others stay.  A null id comes after all others, and of equal ids
    the least SHA-256 of the text stays.  Of rows that repeat the id and the
    text of the one that stays, the least by its columns in order does.  Rows
    without words are in no class and stay.
    """
    sha = F.sha2(F.coalesce(docs[text_col], F.lit("")), 256)
    whole = F.struct(docs[id_col].isNull().alias("absent"), docs[id_col].alias("id"), sha.alias("sha"))
    classes = ngram_jaccard_join(docs.select(whole.alias("row"), docs[text_col].alias("text")), "row", "text", **options)
    name = row_name(F.col("row.id"), F.col("row.sha")).alias("key")
    kept = F.col("row").eqNullSafe(F.col("component_id")).alias("kept")
    judged = stage(
        classes.where("n_shingles > 0").groupBy(name, kept).count().where("not kept or count > 1"), "jaccard-judged"
    )
    key = row_name(F.col(id_col), F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256))
    left = without(docs, key, judged.where("not kept").select("key"))
    return once(left, key, judged.where("kept").select("key"))
