"""Streaming report ingestion gives the batch result and survives a restart."""

import os

from loam.streaming.reports import stream_report_ratings


def _write(folder, name, lines):
    with open(os.path.join(folder, name), "w") as f:
        f.write("\n".join(lines) + "\n")


def test_stream_matches_batch_and_restarts(spark, scratch):
    src, out, ckpt = (os.path.join(scratch, d) for d in ("in", "out", "ckpt"))
    os.makedirs(src)
    _write(src, "a.txt", ["x", "START", "1|s|0.1|c|non-mlra map unit|Limitation", "1|s|0.2|d|mmu|Limitation",
                          "STOP"])
    q = stream_report_ratings(spark, src, out, ckpt)
    q.awaitTermination(120)
    _write(src, "b.txt", ["START", "2|s|0.3|e|non-mlra map unit|Suitability", "STOP"])
    q = stream_report_ratings(spark, src, out, ckpt)   # restart from the checkpoint: only b.txt is new
    q.awaitTermination(120)
    rows = sorted((r.mukey, r.n_rating, r.m_rating) for r in spark.read.parquet(out).collect())
    assert rows == [("1", "0.1", "0.2"), ("2", "0.3", "UNK")]
