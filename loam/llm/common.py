"""Helpers shared by the operators: text rules, shared-folder staging, bounded prefilters."""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loam.session import ensure_checkpoint_dir, ship_package

#: A word: a run of characters other than ASCII white space (fixed value).
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(text: Column) -> Column:
    """``text`` with A-Z lower-cased and every other character as it is.

    Pure ASCII text takes Spark's fast ``lower``; the rest is translated.
    """
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, LOWER)
    )


def word_count(text: Column) -> Column:
    """Words of ``text`` as a long, null counting as no text."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, name: str, partition_by: Iterable[str] = ()) -> DataFrame:
    """Write ``df`` as Parquet into the shared checkpoint folder and read it back.

    Cuts lineage so that a lost executor repeats only what comes later, and
    fixes the rows of anything whose plan Spark might otherwise run twice.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/loam-{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def slots(keys: DataFrame, *cols: str, n: int) -> DataFrame:
    """Broadcastable prefilter: the distinct hash slots of ``cols``, at most ``n`` rows of one long.

    A semi-join on :func:`slot_of` keeps every row whose key is in ``keys``
    and some others (never drops one), so an exact step must follow.  The
    size bound ``n`` holds whatever the input, hence the broadcast hint.
    """
    return F.broadcast(keys.select(slot_of(*cols, n=n).alias("_slot")).distinct())


def slot_of(*cols: str | Column, n: int) -> Column:
    return F.pmod(F.xxhash64(*cols), F.lit(n))


def fresh(name: str, taken: Iterable[str]) -> str:
    """``name``, or as many underscores after it as make it differ from all ``taken`` ones."""
    used = {c.lower() for c in taken}
    while name.lower() in used:
        name += "_"
    return name


def _packed(docs: DataFrame, key: Column, n: int) -> DataFrame:
    """``row`` (all columns), ``key`` and its ``slot``: no name of the caller's can clash."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    return docs.select(whole.alias("row"), key.alias("key")).withColumn("slot", slot_of("key", n=n))


def without(docs: DataFrame, key: Column, gone: DataFrame, n: int = 1 << 19) -> DataFrame:
    """``docs`` without the rows whose ``key`` is in ``gone`` (one column); null keys stay.

    Rows whose slot no key of ``gone`` has pass at once; only the others, with
    their texts, are shuffled for the exact anti-join.
    """
    gone = stage(gone.select(F.col(gone.columns[0]).alias("key")).where("key is not null").distinct(), "gone")
    near = slots(gone, "key", n=n).select(F.col("_slot").alias("slot"), F.lit(True).alias("hit"))
    marked = _packed(docs, key, n).join(near, "slot", "left")
    sure = marked.where("hit is null").select("row.*")
    # not an anti-join: the optimizer would move that below the prefilter, to all rows with their texts
    found = gone.withColumn("gone", F.lit(True))
    checked = marked.where("hit").join(found, "key", "left").where("gone is null").select("row.*")
    return sure.unionByName(checked)


def row_name(key: Column, sha: Column) -> Column:
    """A row's id and text digest as one text; a null id is an id of its own."""
    return F.concat_ws("|", F.coalesce(F.concat(F.lit("="), key.cast("string")), F.lit("")), sha)


def once(docs: DataFrame, key: Column, repeated: DataFrame, n: int = 1 << 19) -> DataFrame:
    """``docs`` with one row of each ``key`` in ``repeated`` (one column), the least by its columns in order.

    Rows that share a key must be repeats of one another.  Only rows whose slot
    a key of ``repeated`` has are grouped, combined before the shuffle.
    """
    near = slots(repeated, repeated.columns[0], n=n).select(F.col("_slot").alias("slot"), F.lit(True).alias("hit"))
    marked = _packed(docs, key, n).join(near, "slot", "left")
    # maps have no order; their rows are ordered by their JSON text
    has_map = "map<" in docs.schema.simpleString()
    least = F.min_by("row", F.to_json("row")) if has_map else F.min("row")
    found = marked.where("hit").groupBy("key").agg(least.alias("row"))
    return marked.where("hit is null").select("row.*").unionByName(found.select("row.*"))


def labelled_rows(docs: DataFrame, labels: DataFrame, bound: int, seed: int) -> DataFrame:
    """At most ``bound`` rows of ``docs`` (``doc, text``) that carry a label (``doc, label``): ``doc, label, text``.

    The bound is on what is fitted, not on the labels: an id may repeat among
    the documents.  Rows that repeat id and text count once; of two labels of
    one id the smaller counts.  Ids and text hashes, a few bytes each, decide
    (least hash of both), and only the chosen texts are moved.
    """
    known = labels.where("doc is not null and label is not null").groupBy("doc").agg(F.min("label").alias("label"))
    known = known.orderBy(F.xxhash64(F.col("doc"), F.lit(seed)), "doc").limit(bound)
    hashed = docs.withColumn("sha", F.xxhash64("text"))
    seen = hashed.join(F.broadcast(known), "doc").select("doc", "label", "sha").distinct()
    chosen = seen.orderBy(F.xxhash64(F.col("doc"), F.col("sha"), F.lit(seed)), "doc", "sha").limit(bound)
    found = hashed.join(F.broadcast(chosen), ["doc", "sha"])
    return found.groupBy("doc", "sha").agg(F.first("label").alias("label"), F.first("text").alias("text")).drop("sha")


def slices(batch: pa.RecordBatch, rows: int = 500) -> Iterator[pa.RecordBatch]:
    """A batch in small parts, so that what a task makes of it stays small too."""
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)


def ready(spark: SparkSession) -> None:
    """Make this package importable on the Python workers."""
    ship_package(spark)


def crc_fold(doc_id) -> int:
    """crc32 of the id as text, modulo 3 (1: held out)."""
    return zlib.crc32(str(doc_id).encode()) % 3
