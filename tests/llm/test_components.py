"""Connected components against a plain union-find, and how often their links are gone over."""

import random

from loam.llm import components as C


def plain(pairs):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in pairs:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return {x: find(x) for x in list(root) if find(x) != x}


def table(spark, pairs):
    return spark.createDataFrame(pairs, "a long, b long")


def found(df):
    rows = df.collect()
    assert len({r.node for r in rows}) == len(rows)
    return {r.node: r.root for r in rows}


def counted(monkeypatch):
    rounds, before = [], C._large_star

    def noted(links):
        rounds.append(links.count())
        return before(links)

    monkeypatch.setattr(C, "_large_star", noted)
    return rounds


def graph(seed):
    r = random.Random(seed)
    pairs = [(r.randrange(300), r.randrange(300)) for _ in range(130)]  # loops and repeats among them
    chain = r.sample(range(1000, 1060), 60)
    return pairs + pairs[:20] + list(zip(chain, chain[1:])) + [(2000, 2000 + i) for i in range(1, 40)]


def test_matches_union_find(spark):
    pairs = graph(1)
    assert found(C.components(table(spark, pairs), "test-parts")) == plain(pairs)
    assert found(C.components(table(spark, [(5, 5)]), "test-parts")) == {}


def test_further_links_join_components(spark):
    pairs, r = graph(2), random.Random(3)
    for cut in (0, 60, len(pairs)):
        further = pairs[cut:] + ([(r.randrange(300), r.randrange(3000)) for _ in range(25)] if cut else [])
        roots = C.components(table(spark, pairs[:cut]), "test-parts")
        assert found(C.with_links(roots, table(spark, further), "test-all")) == plain(pairs[:cut] + further)


def test_links_that_point_at_roots_take_no_round(spark, monkeypatch):
    rounds = counted(monkeypatch)
    pairs = [(1, i) for i in range(2, 30)] + [(i, 100) for i in range(101, 130)]
    assert found(C.components(table(spark, pairs), "test-parts")) == plain(pairs)
    assert rounds == []
    pairs = [(29, i) for i in range(29)]  # at the greatest: one round, and none to see that nothing changes
    assert found(C.components(table(spark, pairs), "test-parts")) == plain(pairs)
    assert rounds == [29]


def test_further_links_are_followed_alone(spark, monkeypatch):
    """The links within the components of before aren't gone over again."""
    pairs = [(10 * k + 1, 10 * k + i) for k in range(20) for i in range(2, 9)]
    roots = C.components(table(spark, pairs), "test-parts")
    rounds = counted(monkeypatch)
    further = [(8, 15), (12, 27), (33, 48), (34, 41)]
    assert found(C.with_links(roots, table(spark, further), "test-all")) == plain(pairs + further)
    assert rounds and max(rounds) <= len(further)
