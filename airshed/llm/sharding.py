"""Contiguous shards of equal bytes: prefix sums of sizes along one order, cut at equal targets.

The order is doc_id (null first), then size, then CRC-32 of the text; rows equal in all of them are
alike in every result. The table's small columns are written in ranges of that order; the ranges'
totals, summed along them, give where each range begins, and a running sum within gives where each
document begins and ends. A document goes to the shard in which its middle byte falls, so a shard
differs from the target by half a document at either end and no document is cut. One that is larger
than a whole target may leave a neighbouring shard empty. Copies of a text are documents of their own
and lie where their ids put them. A null text has no bytes, as an empty one; both have size 1.
SQL functions only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airshed.llm.order import ROWS, ranges, running
from airshed.session import settle

SHARDS = 16


def size_of(text: str) -> Column:
    """UTF-8 bytes of a text and one more, so that empty ones count."""
    return F.coalesce(F.octet_length(text).cast("long"), F.lit(0).cast("long")) + 1


def crc_of(text: str) -> Column:
    """Unsigned CRC-32 of a text's UTF-8 bytes; 0 for null, as for an empty text."""
    return F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary"))


def placed(df: DataFrame, size: str, order: Sequence[str], shards: int = SHARDS, rows: int = ROWS) -> DataFrame:
    """``df`` with ``shard`` (0 to ``shards`` - 1) and ``slot`` (gapless from 0 in the shard).

    ``size`` names a column of positive longs. Columns of ``df`` called shard or slot, in any case, are
    given up for the new ones. An empty table has no shards.
    """
    taken = {"shard", "slot", "__row", "__range", "__end", "__place"}
    df = df.select(*[c for c in df.columns if c.lower() not in taken])
    table = ranges(df, order, "shard-ranges", rows)
    total = table.agg(F.sum(size)).first()[0] or 1
    at = running(table, [], order, {"__end": F.col(size), "__place": F.lit(1).cast("long")})
    # Twice the middle byte, so that it stays whole.
    shard = F.expr(f"cast(((__end * 2 - `{size}`) * {shards}) div {2 * total} as int)")
    at = settle(at.select(*df.columns, shard.alias("shard"), (F.col("__place") - 1).alias("__place")), "shard-places")
    firsts = at.groupBy("shard").agg(F.min("__place").alias("__first"))
    return at.join(F.broadcast(firsts), "shard").select(
        *df.columns, "shard", (F.col("__place") - F.col("__first")).alias("slot")
    )


def digest(docs: DataFrame) -> DataFrame:
    """The contract's columns for every document, by the law ``bytes``; one more shard moves the cuts, so
    ``grown_shard`` is null."""
    small = docs.select(F.col("doc_id").cast("long").alias("doc_id"), size_of("text").alias("size"), crc_of("text").alias("text_crc32"))
    out = placed(small, "size", ["doc_id", "size", "text_crc32"])
    return out.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def write(docs: DataFrame, path: str, shards: int = SHARDS, rows: int = ROWS) -> None:
    """Whole documents into folders ``shard=0`` and so on under ``path``, in order within each file.

    A folder's files follow each other in the order of their names; running it again replaces them.
    """
    wide = docs.withColumn("__size", size_of("text")).withColumn("__crc", crc_of("text"))
    out = placed(wide, "__size", ["doc_id", "__size", "__crc"], shards, rows).drop("__size", "__crc")
    (
        out.repartitionByRange(max(shards, docs.sparkSession.sparkContext.defaultParallelism), "shard", "slot")
        .sortWithinPartitions("shard", "slot")
        .write.mode("overwrite")
        .partitionBy("shard")
        .parquet(path)
    )
