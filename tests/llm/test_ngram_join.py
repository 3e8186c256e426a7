"""ngram_jaccard_join against all pairs by brute force."""

import random
import re

from pyspark.sql import functions as F

from loam.llm.ngram_join import band_floors, deeper, drop_near_duplicates, neighbourhoods, ngram_jaccard_join, segment_count, signatures
import numpy as np


def shingle_set(text, size=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1)))


def brute(rows, percent=85):
    sets = {d: shingle_set(t) for d, t in rows}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            shared = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * shared >= percent * (len(sets[a]) + len(sets[b]) - shared):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d)) for d in ids}


def corpus(seed):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)] + ["Éa", "ÄB", "X"]
    docs = ["", None, " \n\t ", "one", "One two", "one TWO", "one two three"]
    for _ in range(45):
        words = [r.choice(vocabulary) for _ in range(r.choice([5, 8, 12, 30, 60, 150, 400]))]
        docs.append(" ".join(words))
        for _ in range(r.randint(0, 4)):
            words = list(words)
            for _ in range(r.randint(0, max(1, len(words) // 25))):
                i = r.randrange(len(words))
                words[i : i + 1] = r.choice([[], [r.choice(vocabulary)], [words[i], "new"]])
            docs.append("\n".join(words).upper() if r.random() < 0.2 else " ".join(words))
    r.shuffle(docs)
    return list(enumerate(docs))


def run(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("key", F.lit("clash")).repartition(4)
    return ngram_jaccard_join(df).collect()


def test_matches_all_pairs(spark):
    rows = corpus(3)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in run(spark, rows)} == brute(rows)


def test_index_shares_an_entry_for_every_linked_pair():
    r = np.random.default_rng(5)
    for _ in range(400):
        n = int(r.integers(7, 300))
        common = r.integers(1, 1 << 62, n, dtype=np.uint64)
        most = int(n * 100 // 85 - n)
        extra = r.integers(1, 1 << 62, int(r.integers(0, most + 1)), dtype=np.uint64)
        cut = int(r.integers(0, len(extra) + 1))
        a, b = np.unique(np.concatenate((common, extra[:cut]))), np.unique(np.concatenate((common, extra[cut:])))
        shared = len(np.intersect1d(a, b))
        assert 100 * shared >= 85 * (len(a) + len(b) - shared)
        if len(extra):
            assert np.intersect1d(signatures(a, 85), signatures(b, 85)).size


def test_wide_sketches_never_lose_a_link():
    """The block check against true distances, with sets on both sides of a change of sketch size."""
    import pyarrow as pa

    from loam.llm.ngram_join import _may_link_wide, parity_sketch, wide_words

    r = np.random.default_rng(8)
    pairs, items, linked = [], {}, []
    for i in range(120):
        n = int(r.integers(600, 2200))
        common = r.integers(1, 1 << 62, n, dtype=np.uint64)
        extra = r.integers(1, 1 << 62, int(n * r.uniform(0, 0.6)), dtype=np.uint64)
        cut = int(r.integers(0, len(extra) + 1))
        a, b = np.unique(np.concatenate((common, extra[:cut]))), np.unique(np.concatenate((common, extra[cut:])))
        items[2 * i], items[2 * i + 1] = a, b
        pairs.append({"a": 2 * i, "n_a": len(a), "b": 2 * i + 1, "n_b": len(b), "block": 0})
        shared = len(np.intersect1d(a, b))
        linked.append(100 * shared >= 85 * (len(a) + len(b) - shared))
    sketches = pa.table({"key": pa.array(list(items), pa.int64()), "items": pa.array([parity_sketch(x, wide_words(len(x))) for x in items.values()], pa.list_(pa.int64()))})
    kept = set(_may_link_wide(85)(pa.Table.from_pylist(pairs), sketches).column("a").to_pylist())
    assert {2 * i for i, yes in enumerate(linked) if yes} <= kept
    assert len(kept) < 100 and sum(linked) > 10


def test_long_sets_match_all_pairs(spark):
    r = random.Random(12)
    rows = []
    for k in range(6):
        words = [f"v{r.randrange(5000)}" for _ in range(r.randint(900, 1500))]
        for _ in range(5):
            copy = list(words)
            for _ in range(r.randint(0, 45)):
                copy[r.randrange(len(copy))] = f"n{r.randrange(5000)}"
            rows.append((len(rows), " ".join(copy[: len(copy) - r.randint(0, 60)])))
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in run(spark, rows)}
    assert got == brute(rows)
    assert len({c for _, c in got.values()}) < len(rows)


def test_bands_hold_linked_sizes():
    floors = band_floors(85)
    for n in range(1, 3000):
        band = np.searchsorted(floors, n, side="right") - 1
        assert n * 100 // 85 < floors[band + 2]
    assert segment_count(0, 85) == 1


def test_null_ids_repeats_and_empty_table(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(None, text), (4, text), (4, text), (9, text + " more"), (2, None), (2, "")]
    got = sorted((r.doc_id or 0, r.n_shingles, r.component_id) for r in run(spark, rows))
    assert got == [(0, 37, 4), (2, 0, 2), (2, 0, 2), (4, 37, 4), (4, 37, 4), (9, 38, 4)]
    assert run(spark, []) == []


def test_one_document_of_each_class_stays(spark):
    rows = corpus(4)
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n", F.lit(1))
    kept = {r.doc_id for r in drop_near_duplicates(df).collect()}
    assert kept == {d for d, (_, c) in brute(rows).items() if d == c}


def test_near_copies_go_by_id_and_text(spark):
    text = " ".join(f"w{i}" for i in range(60))
    far = " ".join(f"x{i}" for i in range(60))
    lone = " ".join(f"y{i}" for i in range(60))
    rows = [(4, text), (9, text + " more"), (9, far), (None, text + " much more"), (None, lone), (None, lone + " z")]
    rows += [(5, far + " z")] * 3 + [(None, None), (6, ""), (6, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = [tuple(r) for r in drop_near_duplicates(df).collect()]
    left = [(4, text), (5, far + " z"), (None, None), (6, ""), (6, "")]
    order = lambda r: (r[0] or 0, r[1] or "")
    assert sorted((r for r in kept if "y0" not in (r[1] or "")), key=order) == sorted(left, key=order)
    assert len([r for r in kept if r in ((None, lone), (None, lone + " z"))]) == 1 and len(kept) == 6
    apart = spark.createDataFrame([(4, text), (9, text + " more"), (9, lone)], df.schema)
    assert sorted(map(tuple, drop_near_duplicates(apart).collect())) == [(4, text), (9, lone)]


def test_linked_pairs_share_an_entry_at_both_settings_and_sizes():
    """Also sets that lack many segments: with few elements, or crowded into few segments."""
    r = np.random.default_rng(6)
    for percent in (80, 85):
        for k in range(1500):
            n = int(r.integers(4, 40) if k % 2 else r.integers(40, 400))
            common = r.integers(1, 1 << 62, n, dtype=np.uint64)
            extra = r.integers(1, 1 << 62, int(r.integers(1, max(2, n * (100 - percent) // percent + 1))), dtype=np.uint64)
            cut = int(r.integers(0, len(extra) + 1))
            a, b = np.unique(np.concatenate((common, extra[:cut]))), np.unique(np.concatenate((common, extra[cut:])))
            shared = len(np.intersect1d(a, b))
            if 100 * shared >= percent * (len(a) + len(b) - shared):
                assert np.intersect1d(signatures(a, percent), signatures(b, percent)).size


def test_crowded_segments_are_taken_deeper():
    """Steps make up for every empty segment: filled ones count once, and once more per element that may be left out."""
    for sizes in ([0, 0, 9], [5, 0, 0, 0], [1, 1, 1, 3, 0], [2, 2, 2], [0, 7, 1, 0, 1]):
        sizes = np.array(sizes)
        steps = neighbourhoods(sizes, 1)
        levels = [min(len(sizes), steps)] + [last for _, last in deeper(steps, len(sizes))]
        assert np.count_nonzero(sizes) + sum(int((sizes[:last] > k).sum()) for k, last in enumerate(levels, 1)) >= len(sizes)


def test_unrelated_sets_share_no_entry():
    """No bucket grows with the number of unrelated sets."""
    r = np.random.default_rng(7)
    for percent in (80, 85):
        entries = [signatures(np.unique(r.integers(1, 1 << 62, int(r.integers(150, 400)), dtype=np.uint64)), percent) for _ in range(3000)]
        counts = np.unique(np.concatenate(entries), return_counts=True)[1]
        assert counts.max() == 1


def test_wide_sketches_are_made_for_large_sets_only(spark, monkeypatch):
    """Without a pair of large sets, the texts aren't read again for sketches that none would use."""
    from loam.llm import ngram_join as N

    names = []

    def noted(df, name):
        names.append(name)
        return stage_before(df, name)

    stage_before = N.stage
    monkeypatch.setattr(N, "stage", noted)
    for length, wide in ((60, False), (2 * N.WIDE_FROM, True)):
        names.clear()
        words = [f"w{i}" for i in range(length)]
        texts = [" ".join(words), " ".join([*words[:-1], "other"]), "nothing like the two before it"]
        got = N.ngram_jaccard_join(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
        assert {r.doc_id: r.component_id for r in got} == {0: 0, 1: 0, 2: 2}
        assert ("jaccard-stars-nearer" in names) == wide


def test_links_of_the_first_step_are_followed_once(spark, monkeypatch):
    """The second step's components are worked out over links between components only."""
    from loam.llm import components as C

    given, before = {}, C.components

    def noted(links, name="links"):
        given[name] = links.where("a <> b").count()
        return before(links, name)

    monkeypatch.setattr(C, "components", noted)
    rows = corpus(4)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in run(spark, rows)} == brute(rows)
    assert given["jaccard-parts"] == 0  # no family of near copies here needs the second step
