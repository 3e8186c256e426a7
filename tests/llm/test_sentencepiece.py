"""Encoding against the library's own encoder, decoding against the texts, the Viterbi fold against a plain search."""

import random

import sentencepiece
from pyspark.sql import functions as F

from loam.llm import sentencepiece_codec as S
from loam.llm.common import stage, table

SF = "/root/testdata/sf0.001"


def library():
    return sentencepiece.SentencePieceProcessor(model_file=S.MODEL)


def test_driver_texts_match_the_library(spark):
    own = library()
    docs = table(spark, SF, "documents").select("doc_id", "text")
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = S.encode(docs.repartition(3), decoded=True).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, S.decode(S.encode(docs)).collect()))
    assert len(got) == len(texts)
    for r in got:
        assert r.ids == own.encode(texts[r.doc_id]) and r.n_ids == len(r.ids) and r.text == texts[r.doc_id]


def test_odd_texts_match_the_library(spark):
    own = library()
    texts = ["", None, " ", "  a  b   ", " " * 17, " " * 40 + "z", "a\x00b\r\n\n x\t", "日本語𝔘 é ½ ﬁ", "<s> </s> <0x41> <unk>",
             "x" * 300, "ab12" * 60 + " end", "☃" * 70, "\n", "¬ word", "word " * 3000, "=" * 65 + "-" * 33]
    rows = [(i, t) for i, t in enumerate(texts)] + [(0, "same id"), (None, "no id"), (None, "no id")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("ids", F.lit("clash")).withColumn("chunk", F.lit(1))
    for chunk_chars in (S.CHUNK_CHARS, 20):
        got = sorted(((r.doc_id is None, r.doc_id or 0), r.ids) for r in S.encode(df, chunk_chars=chunk_chars).collect())
        want = sorted(((i is None, i or 0), own.encode(t or "")) for i, t in rows)
        assert got == want
    back = {r.doc_id: r.text for r in S.decode(S.encode(df.where("doc_id > 0"))).collect()}
    assert back == {i: t or "" for i, t in rows if i}
    assert S.encode(df.limit(0)).count() == 0


def test_long_words_match_the_library():
    own, vocabulary = library(), S.load_vocabulary()
    r = random.Random(3)
    pieces = [p for p, ok in zip(vocabulary.pieces, vocabulary.normal) if ok and S.SPACE not in p and p != "\n"]
    for _ in range(200):
        word = "".join(r.choice(pieces) for _ in range(r.randint(1, 40)))
        assert S.merge_long(S.SPACE + word, vocabulary) == own.encode(word)


def tiny_unigram():
    pieces = ["<unk>", "▁", "a", "b", "c", "ab", "bc", "▁a", "abc", "cab", "▁ab", "ca"]
    scores = [0.0, -2.0, -3.0, -3.5, -3.25, -4.0, -5.5, -4.5, -7.25, -6.0, -5.0, -7.0]
    return S.Vocabulary(tuple(pieces), tuple(scores), tuple(p != "<unk>" for p in pieces), (), 0, False)


def brute(word, vocabulary):
    """Greatest sum of scores over all segmentations."""
    ids = vocabulary.ids
    low = min(vocabulary.scores) - S.UNKNOWN

    def best(rest):
        if not rest:
            return 0.0
        options = []
        for n in range(1, len(rest) + 1):
            p = rest[:n]
            s = vocabulary.scores[ids[p]] if p in ids else low if n == 1 else None
            if s is not None:
                options.append(s + best(rest[n:]))
        return max(options)

    return best(word)


def test_viterbi_fold_finds_the_best_path(spark):
    vocabulary = tiny_unigram()
    r = random.Random(1)
    words = sorted({"▁" + "".join(r.choice("abcx") for _ in range(r.randint(0, 9))) for _ in range(60)} | {"▁▁ab", "abc"})
    df = spark.createDataFrame([(i % 4, w) for i, w in enumerate(words)], "bucket int, word string").repartition(4, "bucket")
    got = {x.word: x.ids for part in S.encode_words(df, vocabulary) for x in part.collect()}
    low = min(vocabulary.scores) - S.UNKNOWN
    assert set(got) == set(words)
    for w in words:
        assert abs(sum(vocabulary.scores[i] if i else low for i in got[w]) - brute(w, vocabulary)) < 1e-9
        assert len(got[w]) == len(S.viterbi_long(w, vocabulary))


def test_numbers_pack_and_unpack():
    import numpy as np

    for n in (0, 1, 500):
        x = np.random.default_rng(n).integers(0, [1, 2, 200, 70_000, 2**31][n % 5] if n else 1, n)
        assert (S.unpack(S.pack(x)) == x).all()
    edge = np.array([0, 127, 128, 16383, 16384, 2**21 - 1, 2**21, 2**28, 2**31])
    assert (S.unpack(S.pack(edge)) == edge).all()


def test_words_and_units_by_position_are_those_of_each_text():
    """Cutting the bytes of many texts at once gives the words and units that the plain functions give one by one."""
    import numpy as np
    import pyarrow as pa

    pairs = S.load_vocabulary().pairs
    known = np.sort(np.array([ord(p[0]) << 32 | ord(p[1]) for p in pairs], np.uint64))
    r = random.Random(5)
    texts = ["".join(r.choice("ab \n▁é𝔘the") for _ in range(r.randint(1, 30))) for _ in range(300)] + [" ", "\n", "a ", "▁", "☃" * 70]
    spaced = [S.SPACE + t.replace(" ", S.SPACE) for t in texts]
    data, offsets = S._bytes_of(pa.array(spaced, pa.large_string()))
    cut = S._cut_at(data, S.word_starts(data, offsets[:-1])).cast(pa.large_string())
    words = [w for t in texts for w in S.words_of(t)]
    assert cut.to_pylist() == words
    data, _ = S._bytes_of(cut)
    units = S._cut_at(data, S.unit_starts(cut, known)).cast(pa.large_string()).to_pylist()
    assert units == [u for w in words for u in S.units_of(w, pairs)]


def test_words_are_dealt_out_once(spark, monkeypatch):
    """The words of the chunks go through one shuffle, long ones and runs of spaces through none."""
    plans = []

    def noted(df, name):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return stage(df, name)

    monkeypatch.setattr(S, "stage", noted)
    texts = ["a plain text", " " * 9 + "x", "y" * 200]
    rows = S.encode(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {r.doc_id: r.ids for r in rows} == dict(enumerate(library().encode(texts)))
    (plan,) = plans
    assert plan.count("RepartitionByExpression") == 2  # both sides of one join, the same rows
    assert "Union" not in plan and "MapInArrow" not in plan


def test_blocks_give_the_same_as_the_whole(monkeypatch):
    """Numbers, words and units are those of the whole arrays wherever a block ends."""
    import numpy as np
    import pyarrow as pa

    r, rng = random.Random(8), np.random.default_rng(8)
    known = np.sort(np.array([ord(p[0]) << 32 | ord(p[1]) for p in S.load_vocabulary().pairs], np.uint64))
    texts = ["".join(r.choice("ab \n▁é𝔘the") for _ in range(r.randint(1, 30))) for _ in range(60)] + [" " * 9, "\n\n", "▁", "☃" * 7]
    numbers = rng.integers(0, 2 ** rng.integers(1, 31, 500))
    ends = np.sort(np.append(rng.integers(0, 501, 40), [0, 0, 500, 500]))
    data, offsets = S._bytes_of(pa.array([S.SPACE + t.replace(" ", S.SPACE) for t in texts], pa.large_string()))
    whole = S.pack(numbers), S.pack(numbers, ends), S.word_starts(data, offsets[:-1])
    cut = S._cut_at(data, whole[2]).dictionary
    units = S.unit_starts(cut, known)
    for size in (1, 2, 3, 5, 64):
        monkeypatch.setattr(S, "BLOCK", size)
        monkeypatch.setattr(S, "WORDS_BLOCK", size)
        assert S.pack(numbers) == whole[0] and S.pack(numbers, ends) == whole[1]
        assert b"".join(whole[1]) == whole[0] and (S.unpack(whole[0]) == numbers).all()
        stops = np.concatenate([x for x, _ in S.unpacked(whole[0])])
        assert (stops == np.flatnonzero(np.frombuffer(whole[0], np.uint8) < 128) + 1).all()
        assert (S.word_starts(data, offsets[:-1]) == whole[2]).all()
        assert (S.unit_starts(cut, known) == units).all()


def test_memory_of_a_chunk_is_bounded(monkeypatch):
    """Arrays made on the way are of a block's size: a whole chunk takes a few times its text."""
    import tracemalloc
    from types import SimpleNamespace

    import numpy as np
    import pyarrow as pa

    monkeypatch.setattr(S, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    r = random.Random(9)
    words = ["".join(r.choice("etaoinshr") for _ in range(r.randint(2, 7))) for _ in range(20_000)]
    texts = [" ".join(r.choices(words, k=1_000)) for _ in range(1_400)]
    batch = pa.record_batch([pa.array(range(len(texts))), pa.array(texts)], names=["doc", "text"])
    chars = sum(map(len, texts))
    assert S.CHUNK_CHARS * 0.9 < chars < S.CHUNK_CHARS
    chunks = S._chunks(128, S.CHUNK_CHARS, pa.int64(), S.load_vocabulary().pairs)
    tracemalloc.start()
    first, second = chunks(iter([batch]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert first.num_rows == len(texts) and set(second.column("bucket").to_pylist()) <= set(range(-1, 128))
    assert peak < 12 * chars, peak
    assert S.unpack(first.column("units")[3].as_py()).size >= 1_000


def test_every_bucket_is_a_task(spark, monkeypatch):
    """The lattices of one task are held in memory at once, so a task gets one bucket."""
    plans = []
    monkeypatch.setattr(S, "stage", lambda df, name: (plans.append(df._jdf.queryExecution().optimizedPlan().toString()), stage(df, name))[1])
    S.encode(spark.createDataFrame([(1, "a b")], "doc_id long, text string"))
    partitions = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = [line for line in plans[0].splitlines() if "RepartitionByExpression" in line]
    assert dealt and all(line.rstrip().endswith(f", {partitions * S.BUCKETS_PER_PARTITION}") for line in dealt)
