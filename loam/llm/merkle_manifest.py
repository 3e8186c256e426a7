"""Merkle manifest of a dataset: leaf coordinates by bitmap rank, levels by slot arrays.

Leaves are ordered by id within their source without sorting the rows.  Each
source's ids are a compressed bitmap (its non-empty 64-bit words), merged by
``bit_or``; a directory of counts over the words, of fan-out 4,096, gives the
rows before each word, and the popcount of a word's lower bits gives the place
within it.  Sixteen neighbours then meet by key in one slot array, which is
hashed into the next level's node.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loam.llm.common import ascii_lower, stage

#: Nodes hashed into one (fixed value).
FAN = 16
#: Bits of an id within a bitmap word, and bits per level of the count directory.
WORD_BITS, DIRECTORY_BITS, DIRECTORY_LEVELS = 6, 12, 5
#: The word of rows without an id: below every word of a 64-bit id, at every directory level.
NULL_WORD = -(1 << 62)
#: Rows repeating an id and a leaf are numbered in so many parts.
SALTS = 4096
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def encoded(value: Column) -> Column:
    """``-`` for null, else UTF-8 byte count, ``:``, value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(**changed: Column) -> Column:
    """The leaf of a row; ``changed`` replaces columns."""
    return F.sha2(F.concat(*[encoded(changed.get(c, F.col(c))) for c in FIELDS]), 256)


def tampered(doc_id: Column) -> Column:
    """Whether the row is tampered with: 5 divides the crc32 of the decimal id (never of a null id)."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def _before(counts: DataFrame, within: list[str], order: list[str], name: str) -> DataFrame:
    """``counts`` (``n``) with the sum of the rows before each in its group; groups are small by construction."""
    earlier = Window.partitionBy(*within).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn(name, F.coalesce(F.sum("n").over(earlier), F.lit(0)))


def bitmap_words(leaves: DataFrame) -> DataFrame:
    """``grp, word, n, bits``: the bitmap words of each group's ids, with the rows that fall into each."""
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("low"))
    return leaves.groupBy("grp", "word").agg(
        F.count(F.lit(1)).alias("n"), F.bit_or(F.when(F.col("word") != NULL_WORD, bit)).alias("bits")
    )


def directory(words: DataFrame) -> DataFrame:
    """``words`` with ``first``, the rows of the group in earlier words, and ``total``, the rows of the group.

    Counts are summed up the levels and prefix sums come down again; a window
    holds the children of one node, at most 4,096 rows.
    """
    levels = [words.select("grp", F.col("word").alias("node"), "n")]
    for _ in range(DIRECTORY_LEVELS - 1):
        up = levels[-1].groupBy("grp", F.shiftright("node", DIRECTORY_BITS).alias("node"))
        levels.append(up.agg(F.sum("n").alias("n")))
    totals = levels[-1].groupBy("grp").agg(F.sum("n").alias("total"))
    known = _before(levels[-1], ["grp"], ["node"], "first").join(totals, "grp").select("grp", "node", "first", "total")
    for level in reversed(levels[:-1]):
        known = known.withColumnRenamed("node", "parent").withColumnRenamed("first", "base")
        level = _before(level.withColumn("parent", F.shiftright("node", DIRECTORY_BITS)), ["grp", "parent"], ["node"], "prefix")
        known = level.join(known, ["grp", "parent"]).select(
            "grp", "node", (F.col("base") + F.col("prefix")).alias("first"), "total"
        )
    return words.join(known.withColumnRenamed("node", "word"), ["grp", "word"])


def positions(leaves: DataFrame) -> DataFrame:
    """``leaves`` with ``pos``, the place in its group by id (nulls first), then leaf, and ``n``, the group's rows.

    Where ids are unique a row's place is its rank in the bitmap.  Words in
    which an id repeats are known by more rows than bits; only their rows are
    counted by leaf prefix, leaf and salt, so no group of copies is one task's.
    """
    words = stage(directory(bitmap_words(leaves)), "merkle-words")
    clean = F.coalesce(F.col("n") == F.bit_count("bits"), F.lit(False))
    rank = F.bit_count(F.col("bits").bitwiseAND(F.bitwise_not(F.call_function("shiftleft", F.lit(-1).cast("long"), F.col("low")))))
    plain = leaves.join(words.where(clean), ["grp", "word"]).select(
        *leaves.columns, (F.col("first") + rank).alias("pos"), F.col("total").alias("n")
    )
    again = leaves.join(words.where(~clean).select("grp", "word", "first", "total"), ["grp", "word"])
    again = again.withColumn("prefix", F.substring("leaf", 1, 4))
    one, part = ["grp", "word", "low"], ["grp", "word", "low", "prefix"]
    number = F.count(F.lit(1)).alias("n")
    ids = _before(again.groupBy(*one).agg(number), one[:2], ["low"], "ids")
    parts = _before(again.groupBy(*part).agg(number), one, ["prefix"], "parts")
    rows = _before(again.groupBy(*part, "leaf", "salt").agg(number), part, ["leaf", "salt"], "copies")
    within = F.row_number().over(Window.partitionBy(*part, "leaf", "salt").orderBy("leaf")) - 1
    repeats = (
        again.withColumn("within", within)
        .join(ids.drop("n"), one).join(parts.drop("n"), part).join(rows.drop("n"), [*part, "leaf", "salt"])
        .select(*leaves.columns, (F.col("first") + F.col("ids") + F.col("parts") + F.col("copies") + F.col("within")).alias("pos"),
                F.col("total").alias("n"))
    )
    return plain.unionByName(repeats)


def climb(nodes: DataFrame, name: str) -> tuple[list[DataFrame], DataFrame]:
    """All levels of every group's tree: (slot arrays by level, ``grp, h`` of each top).

    ``nodes`` has ``grp, pos, n, h`` and a ``tag`` carried by the lowest level.
    A slot array holds at most 16 nodes; a lone node is its own top.
    """
    levels, tops = [], None
    while True:
        tag = ["tag"] if "tag" in nodes.columns else []
        slot = F.struct((F.col("pos") % FAN).cast("int").alias("slot"), "h", *tag)
        runs = nodes.groupBy("grp", F.expr(f"pos div {FAN}").alias("run")).agg(
            F.max("n").alias("n"), F.array_sort(F.collect_list(slot)).alias("slots")
        )
        joined = F.array_join(F.transform("slots", lambda s: s["h"]), "")
        up = F.when(F.col("n") > 1, F.sha2(joined, 256)).otherwise(F.element_at("slots", 1)["h"])
        runs = stage(runs.withColumn("up", up), name)
        levels.append(runs)
        done = runs.where(F.col("n") <= FAN).select("grp", F.col("up").alias("h"))
        tops = done if tops is None else tops.unionByName(done)
        more = runs.where(F.col("n") > FAN)
        if more.isEmpty():
            return levels, tops
        nodes = more.select("grp", F.col("run").alias("pos"), F.expr(f"(n + {FAN - 1}) div {FAN}").alias("n"), F.col("up").alias("h"))


def descend(levels: list[DataFrame], top_paths: DataFrame) -> DataFrame:
    """``grp, node, path, ...`` of every lowest node; ``path`` lists the left and right siblings up to the top's own path.

    ``top_paths`` has ``grp, path`` and columns that are handed down.  A
    parent's path meets its slot array once, and sixteen rows come out.
    """
    handed = [c for c in top_paths.columns if c not in ("grp", "path")]
    known = None
    for runs in reversed(levels):
        parents = runs.where(F.col("n") <= FAN).join(top_paths, "grp")
        if known is not None:
            parents = parents.unionByName(runs.where(F.col("n") > FAN).join(known, ["grp", "run"]))
        each = parents.select("grp", "run", "n", "path", *handed, F.transform("slots", lambda s: s["h"]).alias("hs"),
                              F.posexplode("slots").alias("i", "node"))
        step = F.struct(F.array_join(F.slice("hs", F.lit(1), F.col("i")), "").alias("l"),
                        F.array_join(F.slice("hs", F.col("i") + 2, F.lit(FAN)), "").alias("r"))
        path = F.when(F.col("n") > 1, F.concat(F.array(step), F.col("path"))).otherwise(F.col("path"))
        known = each.select("grp", (F.col("run") * FAN + F.col("i")).alias("run"), "node", path.alias("path"), *handed)
        if runs is not levels[0]:
            known = known.drop("node")
    return known


def in_order(tops: DataFrame) -> DataFrame:
    """``tops`` with ``pos``, its place by ``grp`` in code-point order: ranges, then the rows of earlier ranges."""
    parts = stage(tops.repartitionByRange("grp").withColumn("part", F.spark_partition_id()), "merkle-sources")
    earlier = _before(parts.groupBy("part").agg(F.count(F.lit(1)).alias("n")), [], ["part"], "base").drop("n")
    place = F.row_number().over(Window.partitionBy("part").orderBy("grp")) - 1
    return parts.withColumn("place", place).join(earlier, "part").select(
        *tops.columns, (F.col("base") + F.col("place")).alias("pos")
    )


def merkle_manifest(docs: DataFrame) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` of every row.

    ``docs`` has ``doc_id`` (integers), ``source, lang, n_chars, text``; other
    columns are ignored.  A leaf is the digest of the five columns, a subroot
    that of a source, the root that of the subroots; ``proof_sha256`` is the
    digest of all siblings on the way up.  ``folded_root`` is recomputed from
    the leaf of the tampered row (see :func:`tampered`) and the siblings.

    Rows without an id come first in their source and are never tampered
    with; rows repeating an id follow one another by leaf, and rows repeating
    a leaf too are leaves of their own.  A null source is a source, the first.
    An empty table gives an empty result.
    """
    grp = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit(""))
    ident = F.col("doc_id").cast("long")
    leaves = docs.select(
        grp.alias("grp"), ident.alias("doc_id"), leaf_hash(doc_id=ident).alias("leaf"),
        F.when(tampered(ident), leaf_hash(doc_id=ident, text=ascii_lower(F.col("text")))).alias("other"),
        F.coalesce(F.shiftright(ident, WORD_BITS), F.lit(NULL_WORD)).alias("word"),
        F.coalesce(ident.bitwiseAND(F.lit((1 << WORD_BITS) - 1)), F.lit(0)).cast("int").alias("low"),
        F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int").alias("salt"),
    )
    placed = positions(stage(leaves, "merkle-leaves"))
    nodes = placed.select("grp", "pos", "n", F.col("leaf").alias("h"), F.struct("doc_id", "other").alias("tag"))
    levels, tops = climb(nodes, "merkle-level")

    tops = stage(in_order(tops), "merkle-subroots")
    source_nodes = tops.select(F.lit(0).alias("grp"), "pos", F.lit(tops.count()).cast("long").alias("n"), "h", F.col("grp").alias("tag"))
    source_levels, top = climb(source_nodes, "merkle-top")
    row = top.first()
    root = F.lit(row.h if row else None).cast("string")

    nothing = F.array().cast("array<struct<l:string,r:string>>")
    sources = descend(source_levels, top.select("grp", nothing.alias("path")))
    paths = stage(sources.select(F.col("node.tag").alias("grp"), "path", F.col("node.h").alias("subroot")), "merkle-paths")
    found = descend(levels, paths).select("node.tag.*", F.col("node.h").alias("leaf"), "subroot", "path")
    folded = F.aggregate("path", F.coalesce("other", "leaf"), lambda h, s: F.sha2(F.concat(s["l"], h, s["r"]), 256))
    proof = F.sha2(F.array_join(F.transform("path", lambda s: F.concat(s["l"], s["r"])), ""), 256)
    out = found.select("doc_id", "leaf", "subroot", root.alias("root"), proof.alias("proof_sha256"), folded.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
