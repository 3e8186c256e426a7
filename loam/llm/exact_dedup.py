"""Exact duplicates by progressive refinement: length, prefix hash, full hash."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loam.llm.common import ascii_lower, once, row_name, slot_of, slots, stage, without

#: Rows of the broadcast prefilters (one long each): a fixed bound, not a cap on the data.
LENGTH_SLOTS = 1 << 16
PREFIX_SLOTS = 1 << 18
#: A group with more than this part of all rows is hot; groups don't overlap, so at most as many are.
HOT_PART = 4096


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    prefix_chars: int = 64,
    digest: bool = False,
) -> DataFrame:
    """Groups of equal texts (equal after lower-casing A-Z; null counts as empty).

    Returns ``id_col, keep_id, group_size, kept, text_sha256``, one row per
    input row.  The row with the largest id stays.  ``text_sha256`` is null
    for rows that an earlier step already proved unique, unless ``digest``.

    1. Rows are counted by byte length (lower-casing A-Z keeps it).
    2. Rows whose length occurs twice are counted by (length, prefix hash).
    3. Rows whose (length, prefix hash) occurs twice get a SHA-256 of the
       whole text and are grouped by it.

    Steps 2 and 3 choose their rows by a broadcast semi-join on a fixed number
    of hash slots (see :func:`slots`), so texts never cross the network; only
    ids and hashes are shuffled.  Counts are combined before each shuffle; rows
    of hot groups get their group's result from a broadcast of at most
    ``HOT_PART`` groups, so no key of the last join holds a large part of the rows.

    Edge cases: null and empty texts are equal to one another; a null id is
    smaller than any other and stays only when its group has no other id;
    rows that repeat id and text are judged alike (all stay or all go); an
    empty table gives an empty result; other columns of ``docs`` are ignored.
    """
    raw = F.coalesce(docs[text_col], F.lit(""))
    base = docs.select(docs[id_col].alias("_id"), raw.alias("_text"), F.octet_length(raw).alias("_len"))
    prefix = F.xxhash64(ascii_lower(F.substring("_text", 1, prefix_chars)))

    lengths = base.groupBy("_len").count().where("count > 1")
    by_len = slots(lengths, "_len", n=LENGTH_SLOTS)
    second = (
        base.withColumn("_slot", slot_of("_len", n=LENGTH_SLOTS))
        .join(by_len, "_slot", "left_semi")
        .withColumn("_ph", prefix)
    )
    prefixes = second.groupBy("_len", "_ph").count().where("count > 1")
    by_prefix = slots(prefixes, "_len", "_ph", n=PREFIX_SLOTS).withColumn("_hit", F.lit(True))

    rows = base.withColumn("_ph", prefix).withColumn("_slot", slot_of("_len", "_ph", n=PREFIX_SLOTS))
    rows = rows.join(by_prefix, "_slot", "left")
    full = F.sha2(ascii_lower(F.col("_text")), 256)
    third = rows.select(
        "_id",
        "_hit",
        (full if digest else F.when(F.col("_hit"), full)).alias("_sha"),
    )
    groups = (
        third.where("_hit")
        .groupBy("_sha")
        .agg(F.max("_id").alias("_keep"), F.count(F.lit(1)).alias("_n"))
        .where("_n > 1")
        .select(F.col("_sha").alias("_key"), "_keep", "_n")
    )
    hot_group = F.col("_n") * HOT_PART > base.count()
    hot = groups.where(hot_group).select(
        F.col("_key").alias("_sha"), F.col("_keep").alias("_hot_keep"), F.col("_n").alias("_hot_n")
    )
    # rows that need no group any more take a key of their own, so that they don't meet in one partition
    alone = F.concat(F.lit("alone "), F.coalesce(F.col("_id").cast("string"), F.lit("")))
    key = F.when(F.col("_hit") & F.col("_hot_n").isNull(), F.col("_sha")).otherwise(alone)
    return (
        third.join(F.broadcast(hot), "_sha", "left")
        .withColumn("_key", key)
        .join(groups.where(~hot_group), "_key", "left")
        .withColumn("_keep", F.coalesce("_hot_keep", "_keep"))
        .withColumn("_n", F.coalesce("_hot_n", "_n"))
        .select(
            F.col("_id").alias(id_col),
            F.when(F.col("_n").isNull(), F.col("_id")).otherwise(F.col("_keep")).alias("keep_id"),
            F.coalesce("_n", F.lit(1)).cast("long").alias("group_size"),
            (F.col("_n").isNull() | F.col("_id").eqNullSafe(F.col("_keep"))).alias("kept"),
            F.col("_sha").alias("text_sha256"),
        )
    )


def drop_exact_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", single: bool = False
) -> DataFrame:
    """``docs`` without the rows that :func:`exact_dedup` drops; all columns kept.

    A row goes by its id and text together, so rows that share an id with a
    dropped one but not its text stay.  Rows that repeat the id and the text
    that stay are all kept; with ``single`` one of them is (the least by its
    columns in order), so that every text stays once, null ids included.
    """
    verdict = exact_dedup(docs, id_col, text_col).where("group_size > 1")
    name = row_name(F.col(id_col), F.col("text_sha256")).alias("key")
    judged = stage(verdict.groupBy(name, "kept").count().where("not kept or count > 1"), "exact-judged")
    sha = F.sha2(ascii_lower(F.coalesce(F.col(text_col), F.lit(""))), 256)
    kept = without(docs, row_name(F.col(id_col), sha), judged.where("not kept").select("key"))
    return once(kept, row_name(F.col(id_col), sha), judged.where("kept").select("key")) if single else kept
