"""Sharding by proportional stratified interleaving.

Main path: DataFrame functions only. Rows of each source are put in a seeded random
order; a row's fractional rank in its source says where it stands in the whole. Sorting
all rows by fractional rank mixes the sources evenly at every point, so equal cuts give
shards of one size, each with the mixture of the whole. Ranks of a source begin at its own share
of a step, and these shares are spread evenly over the sources in a random order, so that many
sources of few rows don't stand at the same points but fill the whole as evenly.

Ranks come from counts: the random key is uniform, so its leading part deals each source
(and later the whole) into small slices; a window ranks inside a slice and the counts of
the slices before give the rest. No window ever holds a source or the whole table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagweave.llm.common import materialize, whole_text


def _ranked(rows: DataFrame, stratum: str, slice_of: Column, order: list[str], name: str) -> DataFrame:
    """Add ``name`` (from 0, gapless in the stratum, which is never null) and ``total``, by slices that ascend with ``order``."""
    rows = rows.withColumn("slice", slice_of)
    counts = rows.groupBy(stratum, "slice").agg(F.count("*").alias("n"))
    # one row for each slice: a bounded number a stratum
    own = Window.partitionBy(stratum)
    before = F.coalesce(F.sum("n").over(own.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = counts.select(F.col(stratum).alias("of"), F.col("slice").alias("nth"), before.alias("before"), F.sum("n").over(own).alias("total"))
    out = rows.join(counts, (F.col(stratum) == F.col("of")) & (F.col("slice") == F.col("nth")))
    inside = Window.partitionBy(stratum, "slice").orderBy(*order)
    return out.withColumn(name, F.row_number().over(inside) - 1 + F.col("before")).drop("slice", "of", "nth", "before")


def shard(
    docs: DataFrame, shards: int = 8, seed: int = 20240229, id_column: str = "doc_id",
    source_column: str = "source", text_column: str = "text", rows_a_slice: int = 4_000,
) -> DataFrame:
    """Deal all rows into ``shards`` shards of equal row counts (at most one apart), each with the mixture of sources.

    Returns doc_id, size (UTF-8 bytes of the text plus 1; null text: 1), text_crc32, source, law ``rows``,
    shard, slot (gapless from 0 in its shard) and grown_shard (null: only the law ``key`` has one).

    Null sources form a stratum of their own; null ids are dealt by their text. Rows that repeat in all that counts
    are dealt one by one, in any order among themselves: each takes a slot. Fewer rows than shards leave the last
    shards empty; no rows, no shards. Other columns aren't read, whatever their names. Reads the text once, whatever
    its length; what is shuffled has no text.
    """
    data = whole_text(docs, text_column).cast("binary")
    rows = docs.select(
        docs[id_column].alias("doc_id"), docs[source_column].cast("string").alias("source"),
        F.coalesce(F.concat(F.lit("is "), docs[source_column].cast("string")), F.lit("null")).alias("stratum"),
        (F.octet_length(data).cast("long") + 1).alias("size"), F.crc32(data).alias("text_crc32"),
    )
    rows = materialize(rows.withColumn("number", F.monotonically_increasing_id()), "shard-rows")
    # rows that are all alike would have one key and meet in one slice: their numbers in the table tell them apart
    alike = rows.groupBy("doc_id", "text_crc32", "size").count().where("count > 1")
    if alike.isEmpty():
        twin = F.lit(None).cast("long")
    else:
        alike = alike.select(F.col("doc_id").alias("id2"), F.col("text_crc32").alias("crc2"), F.col("size").alias("size2"))
        rows = rows.join(alike, F.col("doc_id").eqNullSafe(F.col("id2")) & (F.col("text_crc32") == F.col("crc2")) & (F.col("size") == F.col("size2")), "left")
        twin = F.when(F.col("size2").isNotNull(), F.col("number"))
    rows = rows.select("doc_id", "source", "stratum", "size", "text_crc32", F.xxhash64(F.lit(seed), "doc_id", "text_crc32", "size", twin).alias("key"))
    n = rows.count()
    slices = max(1, -(-n // rows_a_slice))
    part = lambda u: F.least(F.floor(u * slices), F.lit(slices - 1)).cast("long")
    # the order of the keys must be the order of their slices: no negative keys
    rows = rows.withColumn("key", F.shiftrightunsigned("key", 1))
    uniform = F.col("key").cast("double") / float(1 << 63)
    rows = _ranked(rows, "stratum", part(uniform), ["key", "doc_id", "size", "text_crc32"], "rank")
    strata = rows.select(F.col("stratum").alias("of_stratum"), F.lit("all").alias("all")).distinct()
    strata = strata.withColumn("key", F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.lit("begin"), "of_stratum"), 1))
    strata = _ranked(strata, "all", part(uniform), ["key", "of_stratum"], "nth_stratum")
    strata = strata.select("of_stratum", ((F.col("nth_stratum") * 2 + 1) / (F.col("total") * 2)).alias("begin"))
    rows = rows.join(strata, F.col("stratum") == F.col("of_stratum"))
    rows = rows.withColumn("fraction", (F.col("rank") + F.col("begin")) / F.col("total")).drop("rank", "total", "begin", "of_stratum")
    rows = rows.withColumn("stratum", F.lit("all"))
    rows = _ranked(rows, "stratum", part(F.col("fraction")), ["fraction", "key", "source", "doc_id", "size", "text_crc32"], "place")
    at = F.expr(f"(place * {shards}L) div {max(n, 1)}L")
    first = F.expr(f"(shard * {max(n, 1)}L + {shards - 1}L) div {shards}L")
    return rows.withColumn("shard", at.cast("int")).select(
        "doc_id", "size", "text_crc32", "source", F.lit("rows").alias("law"), "shard",
        (F.col("place") - first).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
