"""Reproducible shuffle into shards: a Feistel permutation with cycle walking over global row numbers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch


def feistel(rows: np.ndarray, n: int, seed: int = 42, rounds: int = 6) -> np.ndarray:
    """A pseudo-random permutation of 0..n-1, applied to ``rows``.

    A balanced Feistel network permutes the smallest even-bit power-of-two
    domain that holds n; values that land at n or above walk on along their
    cycle until they come back below n, which keeps the map one to one.
    """
    half = max(1, ((max(n, 2) - 1).bit_length() + 1) // 2)
    low = np.uint64((1 << half) - 1)
    h = np.uint64(half)
    keys = np.random.default_rng(seed).integers(1, 2**63, rounds, dtype=np.uint64)

    def once(x: np.ndarray) -> np.ndarray:
        left, right = x >> h, x & low
        for k in keys:
            f = (right + k) * np.uint64(0x9E3779B97F4A7C15)
            f ^= f >> np.uint64(29)
            f *= np.uint64(0xBF58476D1CE4E5B9)
            f ^= f >> np.uint64(32)
            left, right = right, (left ^ f) & low
        return (left << h) | right

    out = once(rows.astype(np.uint64))
    while len(over := np.flatnonzero(out >= np.uint64(n))):
        out[over] = once(out[over])
    return out.astype(np.int64)


def number_rows(df: DataFrame, order: list[str], scratch: Scratch) -> tuple[DataFrame, int]:
    """``df`` with ``global_row`` 0..n-1 in the order of ``order`` (nulls first), and n.

    Rows are dealt by ranges and written with their range's number, so that the
    numbers do not change when a task runs again. Rows alike in all of ``order``
    are interchangeable; a random last key spreads them over ranges.
    """
    salt, part = "_salt", "_part"
    ranged = df.withColumn(salt, F.rand(11)).repartitionByRange(*order, salt)
    kept = scratch.table(ranged.withColumn(part, F.spark_partition_id()), "numbered")
    counts = kept.groupBy(part).agg(F.count("*").alias("_n"))
    # One row for each range: bounded by the number of partitions.
    before = F.sum("_n").over(Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select(part, F.coalesce(before, F.lit(0)).alias("_offset"))
    total = counts.agg(F.sum("_n")).first()[0] or 0
    rank = F.row_number().over(Window.partitionBy(part).orderBy(*order, salt)) - 1
    out = kept.withColumn("_rank", rank).join(F.broadcast(offsets), part)
    return out.withColumn("global_row", F.col("_offset") + F.col("_rank")).drop(part, salt, "_rank", "_offset"), total


def feistel_shards(df: DataFrame, order: list[str], n_shards: int, seed: int = 42) -> DataFrame:
    """Each row of ``df`` with ``global_row``, ``permuted``, ``shard`` and ``slot``.

    The permuted number p gives shard p mod n_shards and slot p div n_shards,
    so counts differ by one at most, slots have no gaps, and both can be
    computed for any row number alone. An empty table gives no rows.
    """
    scratch = Scratch(df.sparkSession)
    numbered, n = number_rows(df, order, scratch)

    @F.arrow_udf("long")
    def permute(rows: pa.Array) -> pa.Array:
        return pa.array(feistel(rows.to_numpy(zero_copy_only=False), n, seed))

    out = numbered.withColumn("permuted", permute("global_row"))
    return out.withColumn("shard", (F.col("permuted") % n_shards).cast("int")).withColumn(
        "slot", F.floor(F.col("permuted") / n_shards).cast("long")
    )


def shard_digest(docs: DataFrame, n_shards: int = 24, seed: int = 42) -> DataFrame:
    """One row per document: its size, checksum, shard and slot under the law ``rows``.

    The order is doc_id (null first), then size, checksum and a hash of the
    text, so repeated rows are interchangeable and all get slots. A null text
    has size 8 and checksum 0. Extra columns are not read. Texts that are equal
    are rows like others: with one row more or less as the law, a group of
    copies cannot stay together.
    """
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.xxhash64(text).alias("_text"),
    )
    out = feistel_shards(rows, ["doc_id", "size", "text_crc32", "_text"], n_shards, seed)
    return out.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "global_row",
    )
