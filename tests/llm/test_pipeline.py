"""The pipeline's stages one after another, each against a brute-force version on its own input."""

import re
from collections import Counter

import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from loam.llm.common import stage, table, without
from loam.llm.exact_dedup import drop_exact_duplicates
from loam.llm.mixing import mix_sources, mixed_documents
from loam.llm.quality_rules import quality_rules
from loam.llm.sentencepiece_codec import MODEL
from .test_native_operators import lower
from .test_ngram_join import shingle_set

SF = "/root/testdata/sf0.001"


def near_classes(rows):
    sets = {d: shingle_set(t, 5) for d, t in rows.items()}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if sets[a] and sets[b] and min(len(sets[a]), len(sets[b])) >= 0.8 * max(len(sets[a]), len(sets[b])):
                shared = len(sets[a] & sets[b])
                if 100 * shared >= 80 * (len(sets[a]) + len(sets[b]) - shared):
                    x, y = find(a), find(b)
                    root[max(x, y)] = min(x, y)
    return {d: find(d) for d in ids}


def test_null_and_repeated_ids_go_through_every_stage(spark):
    """Every text of such rows gets out as often as the mix takes it."""
    docs = table(spark, SF, "documents")
    spare = [r.asDict() for r in corpus_pipeline.exact(spark, corpus_pipeline.quality(spark, docs, SF), SF).collect()]
    own = [" ".join(reversed(r["text"].split())) + f" own{i}" for i, r in enumerate(spare[:60])]
    odd = [spare[i] | {"doc_id": None, "text": own[i]} for i in range(20)]
    odd += [spare[i] | {"doc_id": None, "text": own[i], "source": None, "lang": None, "n_chars": None} for i in range(20, 25)]
    odd += [spare[i] | {"doc_id": 7_000_000, "text": own[i]} for i in range(25, 45)]  # one id, many texts
    odd += [spare[45] | {"doc_id": 7_000_001, "text": own[45]}] * 30  # one row, many times
    odd += [spare[46] | {"doc_id": None, "text": own[46]}] * 3
    odd += [spare[47] | {"doc_id": None, "text": None}] * 2
    docs = stage(docs.unionByName(spark.createDataFrame(odd, docs.schema)), "test-odd")
    row = lambda r: (r.doc_id, r.text, r.source)
    for name, function in corpus_pipeline.STAGES:
        before = docs.collect()
        docs = stage(function(spark, docs, SF), f"test-{name}")
        rows = docs.collect()
        if name == "exact_dedup":
            assert Counter(lower(r.text) for r in rows) == Counter({lower(r.text): 1 for r in before})
            assert {own[45], own[46]} <= {r.text for r in rows}
        elif name == "mix_sources":
            told = mix_sources(stage(spark.createDataFrame(before, docs.schema), "test-before")).collect()
            want, got = Counter(), Counter((r.doc_id, len(re.findall(r"[^\x20\x09-\x0D]+", r.text))) for r in rows)
            for r in told:
                want[r.doc_id, r.size] += r.copies
            assert got == +want
            most = Counter(map(row, before))
            assert all(n <= 2 * most[r] for r, n in Counter(map(row, rows)).items())
            assert sum(r.doc_id is None for r in rows) and sum(r.doc_id == 7_000_000 for r in rows)
        elif name == "sentencepiece":
            assert Counter(r.doc_id for r in rows) == Counter(r.doc_id for r in before)


def test_every_stage_against_brute_force(spark):
    docs = table(spark, SF, "documents")
    columns = docs.columns
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "exact_dedup", "ngram_jaccard_join", "mix_sources", "sentencepiece"]
    for name, function in corpus_pipeline.STAGES:
        before = {r.doc_id: r.text for r in docs.collect()}
        out = stage(function(spark, docs, SF), f"test-{name}")
        rows = out.collect()
        if name != "sentencepiece":
            assert out.columns == columns
            ids = Counter(r.doc_id for r in rows)
            assert all(r.text == before[r.doc_id] for r in rows)
        if name == "quality_rules":
            kept = {r.doc_id for r in quality_rules(docs, table(spark, SF, "labels")).where("kept").collect()}
            assert ids == Counter(kept)
        elif name == "exact_dedup":
            last = {}
            for d in sorted(before):
                last[lower(before[d])] = d
            assert ids == Counter(last.values())
        elif name == "ngram_jaccard_join":
            assert ids == Counter(d for d, c in near_classes(before).items() if d == c)
        elif name == "mix_sources":
            assert ids == Counter({r.doc_id: r.copies for r in mix_sources(docs).collect() if r.copies})
        else:
            own = sentencepiece.SentencePieceProcessor(model_file=MODEL)
            counted = Counter(r.doc_id for r in docs.select("doc_id").collect())
            assert Counter(r.doc_id for r in rows) == counted
            assert all(r.ids == own.encode(before[r.doc_id]) for r in rows)
        docs = out
    assert corpus_pipeline.run(spark, SF).count() == len(rows)


def test_extra_columns_keep_their_values(spark):
    """Columns under the helpers' own names, and a map column, come out as they went in."""
    rows = [(1, "a b c", "s", 5, 6, 7, {"k": 1}), (2, "A B C", "s", 8, 9, 10, {"k": 2}), (2, "A B C", "s", 8, 9, 10, {"k": 2}), (3, "d e", "s", 11, 12, 13, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, _slot int, row int, _mix_row int, key map<string,int>")
    kept = sorted(tuple(r) for r in drop_exact_duplicates(df, single=True).collect())
    assert kept == [rows[1], rows[3]]
    assert {tuple(r)[:6] for r in mixed_documents(df).collect()} <= {r[:6] for r in rows}
    gone = sorted(tuple(r) for r in without(df, F.col("doc_id"), spark.createDataFrame([(2,)], "slot long")).collect())
    assert gone == [rows[0], rows[3]]
