"""Exact dedup, mixing, line dedup and URL filter: brute force on small tables, edge cases."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from loam.llm.exact_dedup import drop_exact_duplicates, exact_dedup
from loam.llm.line_dedup import html_lines, line_dedup, url_host
from loam.llm.mixing import mix_sources, mixed_documents
from loam.llm.url_filter import labelled_urls, rule_of, split_url, url_filter

DOCS = "doc_id long, text string, source string"


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def texts(seed, n=200):
    r = random.Random(seed)
    base = ["", None, "a", "A", "É", "é", "x" * 100 + "1", "x" * 100 + "2", "X" * 100 + "1", "long " * 5000]
    base += ["".join(r.choice("abcÀ ") for _ in range(r.randint(1, 9))) for _ in range(40)]
    return [(i, r.choice(base), r.choice(["s1", "s2", "Z", None, "é"])) for i in range(n)]


# --- exact dedup


def test_exact_dedup_matches_brute_force(spark):
    rows = texts(1)
    df = spark.createDataFrame(rows, DOCS).withColumn("keep_id", F.lit("clash")).withColumn("_sha", F.lit(1))
    groups = defaultdict(list)
    for i, t, _ in rows:
        groups[lower(t)].append(i)
    for digest in (False, True):
        got = {r.doc_id: r for r in exact_dedup(df, digest=digest).collect()}
        assert len(got) == len(rows)
        for i, t, _ in rows:
            same = groups[lower(t)]
            r = got[i]
            assert (r.keep_id, r.group_size, r.kept) == (max(same), len(same), i == max(same))
            if digest or len(same) > 1:
                assert r.text_sha256 == hashlib.sha256(lower(t).encode()).hexdigest()


def test_exact_dedup_nulls_repeats_and_empty_table(spark):
    rows = [(None, "q", "s"), (3, "Q", "s"), (3, "q", "s"), (None, "alone", "s"), (3, "other", "s")]
    got = sorted((r.doc_id or -1, r.keep_id or -1, r.group_size, r.kept) for r in exact_dedup(spark.createDataFrame(rows, DOCS)).collect())
    assert got == [(-1, -1, 1, True), (-1, 3, 3, False), (3, 3, 1, True), (3, 3, 3, True), (3, 3, 3, True)]
    kept = drop_exact_duplicates(spark.createDataFrame(rows, DOCS)).select("doc_id", "text").collect()
    assert sorted((r.doc_id or -1, r.text) for r in kept) == [(-1, "alone"), (3, "Q"), (3, "other"), (3, "q")]
    empty = spark.createDataFrame([], DOCS)
    assert exact_dedup(empty).count() == 0 and drop_exact_duplicates(empty).count() == 0


def test_one_row_of_each_text_stays(spark):
    rows = [(None, "q", "s"), (3, "Q", "s"), (3, "q", "s"), (None, "alone", "s"), (None, "alone", "t"), (3, "other", "s")]
    kept = drop_exact_duplicates(spark.createDataFrame(rows, DOCS), single=True).collect()
    assert sorted((r.doc_id or -1, r.text, r.source) for r in kept) == [(-1, "alone", "s"), (3, "Q", "s"), (3, "other", "s")]
    text_ids = spark.createDataFrame([(None, "q"), ("", "q")], "doc_id string, text string")
    assert [r.doc_id for r in drop_exact_duplicates(text_ids, single=True).collect()] == [""]


# --- mixing


def brute_targets(sizes, weights=(3, 1, 2), share=1.5, cap=2.0):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, out = share * sum(sizes.values()), set(names), {}
    while open_:
        level = left / sum(w[s] for s in open_)
        over = {s for s in open_ if level * w[s] > cap * sizes[s]}
        if not over:
            return out | {s: level * w[s] for s in open_}
        for s in over:
            out[s] = cap * sizes[s]
            left -= out[s]
        open_ -= over
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_mix_meets_targets_exactly(spark, seed):
    rows = texts(seed)
    df = spark.createDataFrame(rows, DOCS).withColumn("size", F.lit("clash")).withColumn("_key", F.lit(0))
    size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t, _ in rows}
    sizes = Counter()
    for i, _, s in rows:
        sizes[s] += size[i]
    targets = brute_targets(dict(sizes))
    source = {i: s for i, _, s in rows}
    got = mix_sources(df).collect()
    taken = Counter()
    assert len(got) == len(rows)
    for r in got:
        s = source[r.doc_id]
        assert r.size == size[r.doc_id] and r.source_size == sizes[s] and abs(r.target - targets[s]) < 1e-6
        assert 0 <= r.taken <= 2 * r.size and r.copies in (0, 1, 2)
        taken[s] += r.taken
    for s, t in targets.items():
        assert abs(taken[s] - t) <= 0.5
    again = mix_sources(df.repartition(7)).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))


def test_mix_edge_cases(spark):
    assert mix_sources(spark.createDataFrame([], DOCS)).count() == 0
    rows = [(1, None, "a"), (2, "", None)]
    assert {(r.size, r.target, r.taken) for r in mix_sources(spark.createDataFrame(rows, DOCS)).collect()} == {(0, 0.0, 0)}
    rows = [(None, "a b c", "a"), (5, "d e", "a"), (5, "d e", "a")]
    got = mix_sources(spark.createDataFrame(rows, DOCS)).collect()
    assert sum(r.taken for r in got) == 11  # 1.5 * 7, rounded up


def test_mixed_documents_are_whole(spark):
    rows = texts(5)
    df = spark.createDataFrame(rows, DOCS).withColumn("copies", F.lit("clash"))
    copies = {r.doc_id: r.copies for r in mix_sources(df).collect()}
    got = Counter((r.doc_id, r.text, r.source) for r in mixed_documents(df).collect())
    assert got == Counter({row: copies[row[0]] for row in rows if copies[row[0]]})
    assert mixed_documents(df).columns == df.columns


def test_mixed_documents_with_null_and_repeated_ids(spark):
    rows = [(None, f"n{i} b c", "a") for i in range(40)] + [(7, f"r{i} e", "b") for i in range(40)] + [(8, "x y", "b")] * 9
    df = spark.createDataFrame(rows, DOCS)
    want = Counter()
    for r in mix_sources(df).collect():
        want[r.doc_id] += r.copies
    got = Counter(r.doc_id for r in mixed_documents(df).collect())
    assert got == want and got[None] and got[7] and got[8]
    most = Counter(rows)
    out = [(r.doc_id, r.text, r.source) for r in mixed_documents(df.repartition(3)).collect()]
    assert all(n <= 2 * most[r] for r, n in Counter(out).items())


# --- line dedup


def test_line_dedup_matches_brute_force(spark):
    r = random.Random(2)
    common = ["Menu", "Contact us", " Copyright "]
    rows = []
    for i in range(120):
        host = r.choice(["a.org", "b.org", "c.org", None] + ["one%d.org" % i])
        lines = [r.choice(common) for _ in range(r.randint(0, 3))] + ["text %d" % r.randrange(60) for _ in range(r.randint(0, 5))]
        rows.append((i, host, None if i == 7 else "\n".join(lines + ["", "  "])))
    pages, held = Counter(), Counter()
    for _, host, text in rows:
        pages[host] += 1
        for line in {x.strip(" ") for x in (text or "").split("\n")} - {""}:
            held[host, line] += 1
    df = spark.createDataFrame(rows, "page_id long, host string, text string").withColumn("n_lines", F.lit("clash"))
    got = {x.page_id: x for x in line_dedup(df, ratio=0.3, spread=1.0).collect()}
    dropped = 0

    def boilerplate(n, of):
        p = n / of
        low = (p + 0.5 / of - math.sqrt(p * (1 - p) / of + 0.25 / of**2)) / (1 + 1 / of)
        assert abs(low - 0.3) > 1e-9
        return n > 1 and low > 0.3

    for i, host, text in rows:
        lines = [x for x in (y.strip(" ") for y in (text or "").split("\n")) if x]
        stay = [x for x in lines if not boilerplate(held[host, x], pages[host])]
        dropped += len(lines) - len(stay)
        assert (got[i].host, got[i].n_lines, got[i].n_dropped, got[i].text) == (host, len(lines), len(lines) - len(stay), "\n".join(stay))
    assert dropped
    assert line_dedup(spark.createDataFrame([], df.schema)).count() == 0


def test_one_rule_for_hosts_of_every_size(spark):
    """A footer on every page goes on hosts of any size; a sentence on two pages stays on those of more than five."""
    sizes = (1, 2, 3, 4, 5, 6, 10, 19, 20, 25, 200)
    rows = [(1000 * n + i, f"h{n}", "footer\n" + ("twice" if i < 2 else f"own {i}")) for n in sizes for i in range(n)]
    got = line_dedup(spark.createDataFrame(rows, "page_id long, host string, text string")).collect()
    for n in sizes:
        texts = [r.text for r in got if r.host == f"h{n}"]
        assert sum("footer" in t for t in texts) == (n == 1)
        assert sum("twice" in t for t in texts) == (1 if n == 1 else 2 if n > 5 else 0)


def test_line_dedup_trims_tabs_and_carriage_returns(spark):
    menu = ["Menu", "\tMenu", "Menu\r", " \t Menu \x0b\x0c\r"]
    rows = [(i, "a.org", f"{menu[i % 4]}\n\t\n\r\ntext {i}\r\n\t") for i in range(8)]
    got = line_dedup(spark.createDataFrame(rows, "page_id long, host string, text string"), ratio=0.5).collect()
    assert sorted((r.page_id, r.n_lines, r.n_dropped, r.text) for r in got) == [(i, 2, 1, f"text {i}") for i in range(8)]


def test_html_lines_and_host(spark):
    df = spark.range(1).select(
        html_lines(F.lit("<p>a</p><script>var x='<p>';</script>b<!-- c --><br>d")).alias("t"),
        url_host(F.lit("HTTPS://User.Example.org:80/a?b")).alias("h"),
        url_host(F.lit("nohost")).alias("n"),
    )
    row = df.first()
    assert [x for x in row.t.split("\n") if x] == ["a", "b", "d"]
    assert (row.h, row.n) == ("user.example.org:80", "")


# --- URL filter


def brute_split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return lower(host), re.match(r"[^?#]*", rest[len(host) :])[0]


def brute_rule(host, path):
    best = None
    for rule in ("com/", "example.com/en/", "www.example.com/en/", "net/es/", "net/fr/"):
        name, rest = rule.split("/", 1)
        if (host == name or host.endswith("." + name)) and path.startswith("/" + rest) and len(rule) > len(best or ""):
            best = rule
    return best


URLS = [
    None, "", "no host", "http://", "http://X.COM", "http://x.com/", "http://x.com?q=/", "https://www.example.com/en/1?x#y",
    "http://a.www.example.com/en/", "http://awww.example.com/en/", "http://EXAMPLE.com/en/a", "http://example.com/EN/a",
    "http://b.net/es/", "http://b.net/es", "http://net/fr/1", "http://anet/fr/1", "ftp://h.net/fr/a://b", "http://h.net?a/es/",
    "http://münchen.net/es/ü", "x\ny://q.net/es/z", "http://com/", "http://example.com", "http://" + "a" * 5000 + ".net/fr/",
]


def test_url_rules_match_brute_force(spark):
    df = spark.createDataFrame([(i, u) for i, u in enumerate(URLS)], "page_id long, url string").withColumn("host", F.lit("clash"))
    got = {r.page_id: r for r in url_filter(df).collect()}
    verdict = {"com/": "allow", "example.com/en/": "block", "www.example.com/en/": "allow", "net/es/": "block", "net/fr/": "block"}
    for i, u in enumerate(URLS):
        host, path = brute_split(u)
        rule = brute_rule(host, path)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule), u
        assert got[i].verdict == (verdict[rule] if rule else "block" if got[i].score >= 0.5 else "allow")


def test_url_classifier_on_unseen_urls(spark):
    bad = ["http://mega-casino.example.org/fr/1", "https://www.free-spam.example.net/de/2", "http://pills-cheap.example.io/a", "http://adult-xxx.example.org/de/9"]
    good = ["http://www.ththea.example.org/de/1", "https://blog.reinou.example.net/en/2", "http://villages.example.io/a", "http://m.estion.example.org/fr/9"]
    df = spark.createDataFrame(list(enumerate(bad + good)), "page_id long, url string")
    verdicts = {r.page_id: r.verdict for r in url_filter(df).collect()}
    got = {u: verdicts[i] for i, u in enumerate(bad + good)}
    assert [got[u] for u in bad] == ["block"] * 4 and [got[u] for u in good] == ["allow"] * 4


def test_url_filter_edge_cases(spark):
    schema = "page_id long, url string"
    assert url_filter(spark.createDataFrame([], schema)).count() == 0
    rows = [(1, "http://casino.example.org/"), (1, "http://casino.example.org/")]
    one_class = labelled_urls(spark).where("label = 1")
    got = url_filter(spark.createDataFrame(rows, schema), one_class).collect()
    assert [(r.score, r.verdict) for r in got] == [(0.0, "allow")] * 2
    assert spark.range(1).select(rule_of(*split_url(F.lit("http://a.net/es/")))).first()[0] == "net/es/"
