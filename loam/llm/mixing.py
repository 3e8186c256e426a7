"""Mixing sources to target weights: hash-random order, prefix sums, exact cut per source."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loam.llm.common import fresh, stage, word_count

#: Hex digits of the random key that name its range: 16 ** 3 ranges per source.
RANGE_DIGITS = 3


def random_key(id_col: Column, seed: int) -> Column:
    """64 hash-random bits of a document's id, as hex text."""
    return F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), F.coalesce(id_col.cast("string"), F.lit("")))), 1, 16)


def _ranked(sources: DataFrame) -> DataFrame:
    """Add ``_rank`` (0, 1, ...): sources in code-point order, null last.

    Distributed: a range partition per task, each numbered by itself, then
    shifted by the sizes of the partitions before it.
    """
    order = [F.col("_null").asc(), F.col("_src").asc()]
    parts = stage(
        sources.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()),
        "mix-sources",
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    shift = parts.groupBy("_part").count().select(
        "_part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_shift")
    )
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(*order)) - 1
    return parts.withColumn("_rank", inside).join(shift, "_part").withColumn(
        "_rank", (F.col("_rank") + F.col("_shift")).cast("long")
    ).drop("_part", "_shift")


def source_targets(sizes: DataFrame, weights: Sequence[int], share: float, cap: float) -> DataFrame:
    """Per source ``_target``: ``share`` of all words by weight, at most ``cap`` times the source.

    Water filling: while a source is above its limit it is set to it and the
    rest is shared again; each round is one aggregate of one row.
    """
    w = F.element_at(
        F.array(*[F.lit(int(x)) for x in weights]), (F.col("_rank") % len(weights)).cast("int") + 1
    ).cast("double")
    ranked = stage(_ranked(sizes).withColumn("_w", w), "mix-ranks")
    limit = F.lit(float(cap)) * F.col("_size")
    total = ranked.agg(F.coalesce(F.sum("_size"), F.lit(0))).first()[0]
    wanted, level, seen = share * total, 0.0, None
    while True:
        over = limit < F.lit(level) * F.col("_w")
        full, left, n = ranked.agg(
            F.coalesce(F.sum(F.when(over, limit)), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~over, F.col("_w"))), F.lit(0.0)),
            F.count_if(over),
        ).first()
        if n == seen or left == 0:
            break
        seen, level = n, (wanted - full) / left
    return ranked.withColumn("_target", F.least(limit, F.lit(level) * F.col("_w")) if total else F.lit(0.0))


def mix_sources(
    docs: DataFrame,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    weights: Sequence[int] = (3, 1, 2),
    share: float = 1.5,
    cap: float = 2.0,
    seed: int = 17,
    row_col: str | None = None,
) -> DataFrame:
    """How many words of each document a weighted mix takes.

    Returns ``id_col, size, source_size, target, taken, copies`` for every row,
    and ``row_col``, a unique name of each row, if there is one.
    Sources (code-point order, null last) weigh ``weights``, repeating, and
    share ``share`` of all words; no target exceeds ``cap`` times its source.

    Every document gets a hash-random key of its id.  Within a source, rows
    are cut into fixed ranges of that key (uniform, so evenly filled, and a
    hot source is spread over 4,096 tasks); ranges give sums, sums give each
    range's start, and a window inside a range gives each document's.  A
    source's budget is its target rounded to words: whole epochs first, then
    documents in key order until the budget is met; the document that the cut
    falls into gives the words before it.  ``copies`` is the same in whole
    documents (the cut one counts when half of it or more is taken).

    Edge cases: a null or empty text has size 0 and is never taken; a null
    source is a source; null ids share one key and are ordered by size; rows
    that repeat an id are taken one after another (with ``row_col`` by text
    hash, then by it); an empty table gives an empty result; other columns are
    ignored.
    """
    ties = {"_digest": F.xxhash64(docs[text_col]), "_row": docs[row_col]} if row_col else {}
    base = docs.select(
        docs[id_col].alias("_id"),
        docs[source_col].isNull().alias("_null"),
        F.coalesce(docs[source_col].cast("string"), F.lit("")).alias("_src"),
        word_count(docs[text_col]).alias("_words"),
        random_key(docs[id_col], seed).alias("_key"),
        *[c.alias(n) for n, c in ties.items()],
    ).withColumn("_range", F.substring("_key", 1, RANGE_DIGITS))
    ranges = stage(base.groupBy("_null", "_src", "_range").agg(F.sum("_words").alias("_sum")), "mix-ranges")
    sizes = ranges.groupBy("_null", "_src").agg(F.sum("_sum").alias("_size"))
    targets = source_targets(sizes, weights, share, cap)
    budget = F.round("_target").cast("long")
    epochs = F.when(F.col("_size") > 0, F.floor(F.col("_budget") / F.col("_size"))).otherwise(F.lit(0)).cast("long")
    plan = (
        targets.withColumn("_budget", budget)
        .withColumn("_epochs", epochs)
        .withColumn("_rest", F.col("_budget") - F.col("_epochs") * F.col("_size"))
        .select("_null", "_src", "_size", "_target", "_epochs", "_rest")
    )
    source = ["_null", "_src"]
    earlier = Window.partitionBy(*source).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranges.withColumn("_start", F.coalesce(F.sum("_sum").over(earlier), F.lit(0))).drop("_sum")
    starts = starts.join(plan, source)
    inside = (
        Window.partitionBy(*source, "_range")
        .orderBy("_key", "_id", "_words", *ties)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    rows = base.withColumn("_end", F.sum("_words").over(inside)).join(starts, [*source, "_range"])
    first = F.col("_start") + F.col("_end") - F.col("_words")
    part = F.greatest(F.lit(0), F.least(F.col("_words"), F.col("_rest") - first))
    return rows.select(
        F.col("_id").alias(id_col),
        F.col("_words").alias("size"),
        F.col("_size").alias("source_size"),
        F.col("_target").alias("target"),
        (F.col("_epochs") * F.col("_words") + part).cast("long").alias("taken"),
        (F.col("_epochs") + F.when((part > 0) & (2 * part >= F.col("_words")), 1).otherwise(0))
        .cast("int")
        .alias("copies"),
        *([F.col("_row").alias(row_col)] if row_col else []),
    )


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """``docs`` repeated as :func:`mix_sources` says (whole documents, all columns).

    Rows without words and rows that the mix leaves out go.  Rows are numbered
    and meet their copies by number, so ids may be null or repeated; the
    numbered rows are written first, which fixes the numbers.
    """
    number = fresh("_mix_row", docs.columns)
    rows = stage(docs.withColumn(number, F.monotonically_increasing_id()), "mix-rows")
    taken = mix_sources(rows, id_col, **options, row_col=number).where("copies > 0").select(
        F.col(number).alias("taken_row"), F.sequence(F.lit(1), "copies").alias("copies")
    )
    packed = rows.select(F.col(number).alias("row_number"), F.struct(*[rows[c] for c in docs.columns]).alias("row"))
    joined = packed.join(taken, F.col("row_number") == F.col("taken_row"))
    return joined.select("row", F.explode("copies")).select("row.*")
