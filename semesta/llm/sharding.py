"""Proportional stratified interleaving into equal shards, with DataFrame functions only.

Rows are ordered by a seeded hash within their source; the row at place r of n gets the fraction
(r + 0.5) / n. Rows sorted by fraction are cut into runs of equal length, so every shard holds each source
in its share of the whole, give or take a row, and shards differ by a row at most.

No task sees a whole source or the whole table. A rank is the number of rows in earlier buckets plus the
place in the own one: the source rank in buckets of the hash, the rank of fractions in buckets of the
fraction. Both are even by construction, whatever the sizes of the sources; the counts that are summed
before them are one row per bucket.

Null text has no bytes; null sources together are one source. Rows of equal hash are ordered by id, size and
checksum; rows equal in all of these can be swapped without any change of the result. An empty table gives
an empty one. Only the columns named are read, so others may have any name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from semesta.llm.common import whole

#: Buckets that a rank is put together from.
BUCKETS = 4096
#: Bytes counted for a row besides its text.
ROW_BYTES = 16
SEED = 7


def _ranked(rows: DataFrame, group: list[str], order: list[str], rank: str) -> DataFrame:
    """``rank`` (from 0) and ``of`` (rows in all) of each row within its group; ``bucket`` orders coarsely."""
    counts = rows.groupBy(*group, "bucket").agg(F.count(F.lit(1)).alias("here"))
    # At most BUCKETS rows a window.
    buckets = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    earlier = buckets.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        *group,
        "bucket",
        F.coalesce(F.sum("here").over(earlier), F.lit(0)).alias("before"),
        F.sum("here").over(buckets).alias("of"),
    )
    placed = Window.partitionBy(*group, "bucket").orderBy(*order)
    numbered = rows.withColumn("place", F.row_number().over(placed) - 1)
    return (
        numbered.join(starts, [*group, "bucket"])
        .withColumn(rank, F.col("before") + F.col("place"))
        .drop("before", "place", "bucket")
    )


def interleave(
    docs: DataFrame, shards: int, *, key: str = "doc_id", source: str = "source", text: str = "text", seed: int = SEED
) -> DataFrame:
    """(doc_id, source, size, text_crc32, shard, slot): where each row goes; slots run from 0 in every shard."""
    rows = docs.select(
        F.col(key).alias("doc_id"),
        # Null and the empty name stay apart: a null has no length.
        F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit("")).alias("stratum"),
        (F.octet_length(whole(F.col(text))) + F.lit(ROW_BYTES)).cast("long").alias("size"),
        F.crc32(whole(F.col(text)).cast("binary")).alias("text_crc32"),
    ).withColumn("drawn", F.xxhash64("doc_id", "size", "text_crc32", F.lit(seed)))
    bits = BUCKETS.bit_length() - 1
    order = ["drawn", "doc_id", "size", "text_crc32"]
    by_source = _ranked(
        rows.withColumn("bucket", F.shiftright("drawn", 64 - bits)), ["stratum"], order, "source_rank"
    ).withColumn("fraction", (F.col("source_rank") + 0.5) / F.col("of")).drop("of")
    overall = _ranked(
        by_source.withColumn("bucket", F.floor(F.col("fraction") * BUCKETS)), [], ["fraction", "stratum", *order], "at"
    )
    shard = F.expr(f"CAST(`at` * {shards} DIV `of` AS INT)")
    first = F.expr(f"(shard * `of` + {shards - 1}) DIV {shards}")
    return overall.withColumn("shard", shard).select(
        "doc_id",
        F.when(F.col("stratum") != "", F.substring("stratum", 2, 1 << 30)).alias("source"),
        "size",
        "text_crc32",
        "shard",
        (F.col("at") - first).alias("slot"),
    )
