"""Exact dedup over an extendible-hash index kept in shared files. DataFrame and SQL functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, join_unique

#: The characters [\x20\x09-\x0D], which equality ignores.
SPACES = (" ", "\t", "\n", "\x0b", "\x0c", "\r")
#: Directory bits at most: 65,536 buckets, small enough to send to every task.
MAX_DEPTH = 16
#: Rows of a key that one compare task takes before a key's rows are salted.
COMPARE_ROWS = 512


def squeeze(text: Column) -> Column:
    """Text without white space; null counts as empty."""
    out = F.coalesce(text, F.lit(""))
    for c in SPACES:
        out = F.replace(out, F.lit(c), F.lit(""))
    return out


def sha_key(norm: Column) -> Column:
    return F.unhex(F.sha2(norm.cast("binary"), 256))


def directory(slots: DataFrame, capacity: int) -> DataFrame:
    """The extendible-hash directory: (slot, bucket) for every slot in use, of (slot, n).

    A slot is the first MAX_DEPTH bits of a key. All slots start in one bucket;
    while a bucket holds more than ``capacity`` entries, the directory doubles
    and the overfull buckets split by one bit more. So a slot's bucket is that
    of the first depth at which its prefix fits, which needs no loop: the table
    has at most 2**MAX_DEPTH rows.
    """
    held = [F.sum("n").over(Window.partitionBy(F.expr(f"slot div {1 << (MAX_DEPTH - d)}"))) for d in range(MAX_DEPTH)]
    sums = slots.coalesce(1).select("slot", *[h.alias(f"n{d}") for d, h in enumerate(held)])
    depth = F.coalesce(*[F.when(F.col(f"n{d}") <= capacity, F.lit(d)) for d in range(MAX_DEPTH)], F.lit(MAX_DEPTH))
    # The bucket's first slot, then its depth: in the order of the keys.
    first = F.expr(f"(slot div cast(pow(2, {MAX_DEPTH} - depth) as int)) * cast(pow(2, {MAX_DEPTH} - depth) as int)")
    return sums.select("slot", depth.alias("depth")).select("slot", (first * (MAX_DEPTH + 1) + F.col("depth")).alias("bucket"))


def slot_of(key: Column) -> Column:
    return F.conv(F.substring(F.hex(key), 1, MAX_DEPTH // 4), 16, 10).cast("int")


def exact_dedup(
    docs: DataFrame,
    capacity: int | None = None,
    key_of: Callable[[Column], Column] = sha_key,
) -> DataFrame:
    """One row per document: (doc_id, keep_id, group_size, kept, text_sha256, bucket, chain).

    Texts are equal when they are equal without white space; null counts as
    empty. Of equal texts the row with most code points stays, then the
    smallest doc_id (a null id counts as largest). Rows that repeat an id in
    one group all carry the id that stays. An empty table gives no rows; other
    columns are not read.

    1. Each row becomes an entry (key of the squeezed text, id, length). Entries
       of one key that stand in the same file part are one run, so that a hot
       key sends few rows.
    2. The directory splits overfull buckets by the runs' counts. Runs go to
       their bucket through it; a bucket's owner task makes its records (key,
       count, row that stays) and writes them, sorted, to the shared folder.
    3. Rows of keys with two or more entries have their bytes compared with the
       record's head, found through the directory; rows that differ go to the
       next record of the key's chain, until none is left. Hot keys are salted,
       so no task gets a whole group.
    4. Every entry looks its record up by slot, bucket, key and chain.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark)
    norm = squeeze(F.col("text"))
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    points = F.length(F.coalesce("text", F.lit(""))).cast("long").alias("points")
    entries = source.select("doc_id", key_of(norm).alias("key"), points, F.sha2(norm.cast("binary"), 256).alias("text_sha256"))
    entries = scratch.table(entries.withColumn("slot", slot_of(F.col("key"))).withColumn("part", F.spark_partition_id()), "entries")
    by_id = F.coalesce("doc_id", F.lit(2**63 - 1))
    best = F.min(F.struct((-F.col("points")).alias("points"), by_id.alias("id"))).alias("best")
    runs = scratch.table(entries.groupBy("part", "slot", "key").agg(F.count("*").alias("n"), best), "runs")
    n = runs.count()
    room = capacity or max(1024, n >> (MAX_DEPTH - 2))
    slots = F.broadcast(scratch.table(directory(runs.groupBy("slot").agg(F.count("*").alias("n")), room), "directory"))
    owned = runs.join(slots, "slot").repartition("bucket")
    index = owned.groupBy("bucket", "key").agg(F.sum("n").alias("group_size"), F.min("best").alias("best"))
    index = scratch.table(index.sortWithinPartitions("bucket", "key"), "index")

    shared = index.filter("group_size > 1").select("bucket", "key", "group_size", "best")
    n_shared = shared.count()
    few = n_shared <= 100_000
    # Ids of equal rows only; their texts are read again, as the index holds no texts.
    texts = source.select("doc_id", points, key_of(norm).alias("key"), norm.alias("norm")).withColumn("slot", slot_of(F.col("key"))).join(slots, "slot").drop("slot")
    members = texts.join(F.broadcast(shared) if few else shared, ["bucket", "key"]).withColumn("salts", F.ceil(F.col("group_size") / COMPARE_ROWS).cast("int"))
    members = members.withColumn("salt", F.pmod(F.xxhash64("doc_id", "points"), F.col("salts")).cast("int"))
    chained = None
    if n_shared:
        is_head = (by_id == F.col("best.id")) & (F.col("points") == -F.col("best.points"))
        members = scratch.table(members, "members")
        heads = members.filter(is_head).groupBy("bucket", "key").agg(F.min("norm").alias("head"), F.first("salts").alias("salts"))
        heads = heads.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).drop("salts")
        rest = members.join(heads, ["bucket", "key", "salt"]).filter("norm <> head").drop("head")
        rest = scratch.table(rest.select("doc_id", "points", "key", "norm"), "rest0")
        if not rest.isEmpty():
            chained = _chain(entries.drop("part"), members.select("doc_id", "points", "key", "norm"), rest, scratch)
        scratch.drop("members")
    if chained is None:
        keyed = entries.drop("part").withColumn("chain", F.lit(0))
        groups = index.withColumn("chain", F.lit(0))
    else:
        keyed = scratch.table(chained.withColumn("slot", slot_of(F.col("key"))), "chained")
        groups = keyed.groupBy("key", "chain").agg(F.count("*").alias("group_size"), best).join(index.select("bucket", "key"), "key")
    out = join_unique(keyed.join(slots, "slot").drop("slot"), groups, ["bucket", "key", "chain"], "group_size")
    keep = F.when(F.col("best.id") == 2**63 - 1, None).otherwise(F.col("best.id"))
    return out.select("doc_id", keep.alias("keep_id"), "group_size", (by_id == F.col("best.id")).alias("kept"), "text_sha256", "bucket", "chain")


def _chain(entries: DataFrame, members: DataFrame, rest: DataFrame, scratch: Scratch) -> DataFrame:
    """Entries with their place in the key's chain, for keys whose bytes differ.

    Each pass takes the least of the texts left of a key as the next record's
    head and gives its equals that place; the loop ends when no text is left,
    after as many passes as a key has different texts.
    """
    texts, k = members.join(rest.select("key").distinct(), "key", "left_semi"), 0
    placed = None
    while True:
        heads = texts.groupBy("key").agg(F.min("norm").alias("head"))
        judged = texts.join(heads, "key")
        now = scratch.table(judged.filter("norm = head").select("doc_id", "points", "key", F.sha2(F.col("norm").cast("binary"), 256).alias("text_sha256"), F.lit(k).alias("chain")), f"chain{k}")
        placed = now if placed is None else placed.unionByName(now)
        texts = scratch.table(judged.filter("norm <> head").drop("head"), f"left{k}")
        if texts.isEmpty():
            break
        k += 1
    plain = entries.join(rest.select("key").distinct(), "key", "left_anti").withColumn("chain", F.lit(0))
    return plain.drop("slot").unionByName(placed.select("doc_id", "key", "points", "text_sha256", "chain"))
